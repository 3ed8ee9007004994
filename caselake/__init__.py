"""Safety-report analytics on Spark."""
