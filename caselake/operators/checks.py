"""Q01-Q06: data-quality rules, each a DataFrame of (rule, violations)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _count(rule: str, bad: DataFrame) -> DataFrame:
    return bad.agg(F.count("*").alias("violations")).select(F.lit(rule).alias("rule"), "violations")


def not_null(df: DataFrame, column: str, rule: str = "") -> DataFrame:
    return _count(rule or f"not_null:{column}", df.where(F.col(column).isNull()))


def unique(df: DataFrame, *columns: str, rule: str = "") -> DataFrame:
    """Q01, Q03: keys found twice or more; a single null key doesn't count."""
    rows = df if len(columns) > 1 else df.where(F.col(columns[0]).isNotNull())
    return _count(rule or f"unique:{','.join(columns)}", rows.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1"))


def accepted_values(df: DataFrame, column: str, values: list, rule: str = "") -> DataFrame:
    """Values found that aren't in the list, each once."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct()
    return _count(rule or f"accepted_values:{column}", found.where(~F.col(column).isin(values)))


def relationships(child: DataFrame, column: str, parent: DataFrame, key: str, rule: str = "") -> DataFrame:
    """Q02: child rows whose filled key has no parent."""
    keys = parent.select(F.col(key).alias(column)).where(F.col(column).isNotNull()).distinct()
    return _count(rule or f"relationships:{column}", child.where(F.col(column).isNotNull()).join(keys, column, "left_anti"))


def expression_is_true(df: DataFrame, expression: str, rule: str = "") -> DataFrame:
    """Q04: rows where the expression isn't true."""
    return _count(rule or f"expression:{expression}", df.where(f"not coalesce({expression}, false)"))


def equal_rowcount(a: DataFrame, b: DataFrame, rule: str = "equal_rowcount") -> DataFrame:
    """Q05: the difference in rows."""
    n = a.agg(F.count("*").alias("n")).crossJoin(b.agg(F.count("*").alias("m")))
    return n.select(F.lit(rule).alias("rule"), F.abs(F.col("n") - F.col("m")).alias("violations"))


def seed_pieces_exist(seed: DataFrame, totals: DataFrame) -> DataFrame:
    """Q06: seed pieces that no string holds."""
    return seed.join(totals, "piece", "left_anti").select("piece")


def identities_complete(resolved: DataFrame, identity: DataFrame) -> DataFrame:
    """Q06: resolved strings without an identity row."""
    return resolved.where("prod_ai_resolved is not null").select("prod_ai_resolved").subtract(identity.select("prod_ai_resolved"))


def seed_pieces_win(seed: DataFrame, identities: DataFrame) -> DataFrame:
    """Q06: seed pieces resolved by another rule."""
    return seed.select("piece").join(identities.select("piece", "rule"), "piece", "left").where(~F.col("rule").eqNullSafe(F.lit("seed")))


def report(*rules: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionAll, rules)
