"""Cleaning, the case versions to keep, and the validation gate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CHILDREN = ("drug", "reac", "indi", "outc", "rpsr", "ther")


def clean(df: DataFrame, table: str, deleted: DataFrame | None = None) -> DataFrame:
    """Distinct rows; demo rows need a caseid that isn't retracted."""
    df = df.distinct()
    if table != "demo":
        return df
    df = df.where(F.col("caseid").isNotNull())
    return df if deleted is None else df.join(deleted.where("caseid is not null"), "caseid", "left_anti").select(*df.columns)


def _version():
    return F.coalesce(F.col("caseversion").try_cast("long"), F.lit(0))


def _richness(df: DataFrame):
    """P20: how many columns are filled."""
    return reduce(lambda a, b: a + b, (F.col(f"`{c}`").isNotNull().cast("int") for c in df.columns))


def keep_list(demo: DataFrame, children: dict[str, DataFrame]) -> DataFrame:
    """(caseid, primaryid) of the row that stands for each case.

    The largest version wins; ties go to the report with most child rows, then most filled fields, then
    the smallest id.  Only tied reports are counted in the child tables.
    """
    ranked = demo.select("caseid", "primaryid", _version().alias("v"), _richness(demo).alias("filled"))
    top = ranked.withColumn("best", F.max("v").over(W.partitionBy("caseid"))).where("v = best")
    top = top.withColumn("n", F.count("*").over(W.partitionBy("caseid")))
    tied = top.where("n > 1").select("primaryid").distinct()
    counts = [children[c].select("primaryid").join(tied, "primaryid", "left_semi") for c in CHILDREN if c in children]
    rows = reduce(DataFrame.unionAll, counts).groupBy("primaryid").agg(F.count("*").alias("child_rows"))
    order = W.partitionBy("caseid").orderBy(
        F.coalesce("child_rows", F.lit(0)).desc(), F.col("filled").desc(), F.col("primaryid").try_cast("long").asc_nulls_last(), F.col("primaryid").asc()
    )
    return top.join(rows, "primaryid", "left").withColumn("rk", F.row_number().over(order)).where("rk = 1").select("caseid", "primaryid")


def dedup(tables: dict[str, DataFrame], keep: DataFrame) -> dict[str, DataFrame]:
    """The kept rows: demo by both ids and one row a report (the fullest), children by report."""
    demo = tables["demo"]
    kept = demo.distinct().join(keep, ["caseid", "primaryid"], "left_semi")
    # the least of (fewest gaps, then values) by report, carried as one struct: no name is added to the row's own
    row = F.struct((-_richness(demo)).alias("gaps"), *(F.struct(F.col(f"`{c}`").isNull().alias("gap"), F.col(f"`{c}`").alias("value")).alias(f"c{i}") for i, c in enumerate(demo.columns)))
    least = kept.select("primaryid", row.alias("row")).groupBy("primaryid").agg(F.min("row").alias("row"))
    out = {"demo": least.select(*(F.col(f"row.c{i}.value").alias(c) for i, c in enumerate(demo.columns)))}
    ids = keep.select("primaryid").distinct()
    for name, df in tables.items():
        if name != "demo":
            out[name] = df.distinct().join(ids, "primaryid", "left_semi").select(*df.columns)
    return out


def validate(merged: dict[str, DataFrame], deduped: dict[str, DataFrame], deleted: DataFrame) -> DataFrame:
    """(check, passed, value) of the five invariants, then drop shares and orphans as information."""
    before, after = merged["demo"], deduped["demo"]
    cases = after.select("caseid").distinct()
    largest = before.groupBy("caseid").agg(F.max(_version()).alias("largest"))
    one = lambda c: after.agg((F.count("*") - F.countDistinct(c)).alias("value"))
    checks = [
        ("one_row_per_primaryid", one("primaryid")),
        ("one_row_per_caseid", one("caseid")),
        ("every_case_survives", before.join(cases, "caseid", "left_anti").agg(F.countDistinct("caseid").alias("value"))),
        ("max_caseversion_kept", after.join(largest, "caseid").where(_version() != F.col("largest")).agg(F.count("*").alias("value"))),
        ("no_deleted_cases", after.join(deleted, "caseid", "left_semi").agg(F.count("*").alias("value"))),
    ]
    rows = [df.select(F.lit(name).alias("check"), (F.col("value") == 0).alias("passed"), F.col("value").cast("double").alias("value")) for name, df in checks]
    for name in deduped:
        n = merged[name].agg(F.count("*").alias("n")).crossJoin(deduped[name].agg(F.count("*").alias("m")))
        dropped = F.when(F.col("n") > 0, 100.0 * (F.col("n") - F.col("m")) / F.col("n")).otherwise(0.0)
        rows.append(n.select(F.lit(f"dropped_pct_{name}").alias("check"), F.lit(None).cast("boolean").alias("passed"), F.round(dropped, 1).alias("value")))
        if name != "demo":
            orphans = deduped[name].join(after, "primaryid", "left_anti").agg(F.count("*").cast("double").alias("value"))
            rows.append(orphans.select(F.lit(f"orphans_{name}").alias("check"), F.lit(None).cast("boolean").alias("passed"), "value"))
    return reduce(DataFrame.unionAll, rows)
