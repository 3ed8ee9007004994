"""Disproportionality measures of 2x2 tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

Z = 1.96
NAN = float("nan")


def _scorable(table: DataFrame) -> DataFrame:
    return table.where("a >= 3 and b > 0 and c > 0 and d > 0").select("identity_key", "reaction_pt", "a", "b", "c", "d")


def _doubles() -> tuple[Column, ...]:
    return tuple(F.col(x).cast("double") for x in "abcd")


def _interval(value: Column, spread: Column, name: str) -> list[Column]:
    return [value.alias(name), F.exp(F.log(value) - Z * spread).alias(f"{name}_lower"), F.exp(F.log(value) + Z * spread).alias(f"{name}_upper")]


def prr(table: DataFrame) -> DataFrame:
    """Proportional reporting ratio, its interval, Yates' chi-square floored at 0, Evans' criterion."""
    a, b, c, d = _doubles()
    value = (a / (a + b)) / (c / (c + d))
    spread = F.sqrt(1 / a - 1 / (a + b) + 1 / c - 1 / (c + d))
    gap = F.greatest(F.abs(a * d - b * c) - (a + b + c + d) / 2, F.lit(0.0))
    chi = (a + b + c + d) * gap * gap / ((a + b) * (c + d) * (a + c) * (b + d))
    scored = _scorable(table).select("*", *_interval(value, spread, "prr"), chi.alias("chi_square"))
    return scored.withColumn("is_evans_signal", (F.col("prr") >= 2) & (F.col("chi_square") >= 4) & (F.col("a") >= 3))


def ror(table: DataFrame) -> DataFrame:
    """Reporting odds ratio and its interval."""
    a, b, c, d = _doubles()
    return _scorable(table).select("*", *_interval(a * d / (b * c), F.sqrt(1 / a + 1 / b + 1 / c + 1 / d), "ror"))


def _information(suffix: str) -> list[tuple[str, Column]]:
    """n, expected count, information component and its lower bound; NaN where there are no reports."""
    a, b, c, d = (F.col(f"{x}{suffix}").cast("double") for x in "abcd")
    n = a + b + c + d
    expected = F.when(n > 0, (a + b) * (a + c) / n).otherwise(NAN)
    ic = F.log2((a + 0.5) / (expected + 0.5))
    low = ic - 3.3 * F.pow(a + 0.5, F.lit(-0.5)) - 2 * F.pow(a + 0.5, F.lit(-1.5))
    return [(f"n{suffix}", n.cast("long")), (f"expected{suffix}", expected), (f"ic{suffix}", ic), (f"ic025{suffix}", low)]


def peaks(series: DataFrame) -> DataFrame:
    """The quarter with most reports of each pair; the earliest of equals."""
    order = W.partitionBy("identity_key", "reaction_pt").orderBy(F.col("n_cases").desc(), F.col("report_quarter").asc_nulls_last())
    top = series.withColumn("rk", F.row_number().over(order)).where("rk = 1")
    return top.select("identity_key", "reaction_pt", F.col("n_cases").alias("peak_quarter_n"), F.col("report_quarter").alias("peak_quarter"))


def signals(table: DataFrame, series: DataFrame) -> DataFrame:
    """Information components of every pair, with and without lawyers, and its peak quarter."""
    scored = table.select("*", *(c.alias(name) for s in ("", "_nolw") for name, c in _information(s)), ((F.col("a") - F.col("a_nolw")).cast("double") / F.col("a")).alias("pct_lw"))
    joined = scored.join(peaks(series), ["identity_key", "reaction_pt"], "left")
    return joined.withColumn("peak_quarter_share", F.col("peak_quarter_n").cast("double") / F.col("a"))
