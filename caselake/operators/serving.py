"""Parameterised lookups on the serving tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIRST_QUARTER = date(2004, 1, 1)


def search(dim_drug: DataFrame, text: str, most: int = 20) -> DataFrame:
    """Drugs with signals whose label holds ``text`` in any case; % and _ are wildcards."""
    pattern = "%" + text.replace("\\", "\\\\") + "%"
    found = dim_drug.where(F.col("drug_label").ilike(pattern) & (F.col("n_signals") > 0))
    return found.select("drug_key", "drug_label", "n_ingredients", "n_signals").orderBy("n_ingredients", "drug_label", "drug_key").limit(most)


def lookup(dim_drug: DataFrame, drug_key: str) -> DataFrame:
    """The drug of a key; no row if there is none."""
    return dim_drug.where(F.col("drug_key") == drug_key).select("identity_key", "drug_label").limit(1)


def drug_signals(signals: DataFrame, identity_key: str, most: int = 50) -> DataFrame:
    """A drug's signals, strongest first."""
    rows = signals.where((F.col("identity_key") == identity_key) & (F.col("ic025") > 0))
    return rows.select("reaction_pt", "a", "expected", "ic", "ic025", "pct_lw", "peak_quarter", "peak_quarter_share").orderBy(F.desc("ic025"), "reaction_pt").limit(most)


def pair_detail(signals: DataFrame, series: DataFrame, identity_key: str, reaction_pt: str) -> tuple[DataFrame, DataFrame]:
    """A pair's measures and its quarters."""
    own = (F.col("identity_key") == identity_key) & (F.col("reaction_pt") == reaction_pt)
    return signals.where(own).drop("identity_key"), series.where(own).select("report_quarter", "n_cases", "n_cases_nolw").orderBy("report_quarter")


def quarter_series(series: DataFrame, identity_key: str, reaction_pt: str, first: date = FIRST_QUARTER) -> DataFrame:
    """Every quarter from the first to the last of all pairs, zeros where the pair has no reports."""
    last = series.agg(F.max("report_quarter").alias("last"))
    quarters = last.select(F.explode(F.sequence(F.lit(first), F.col("last"), F.expr("interval 3 months"))).alias("report_quarter"))
    _, own = pair_detail(series, series, identity_key, reaction_pt)
    n, m = F.coalesce("n_cases", F.lit(0)), F.coalesce("n_cases_nolw", F.lit(0))
    label = F.concat(F.year("report_quarter").cast("string"), F.lit(" Q"), F.quarter("report_quarter").cast("string"))
    return quarters.join(own, "report_quarter", "left").select("report_quarter", label.alias("label"), n.alias("n"), m.alias("n_nolw"), (n - m).alias("n_lw"))


def cases_before(series: DataFrame, identity_key: str, reaction_pt: str, first: date = FIRST_QUARTER) -> DataFrame:
    """A pair's reports before the series begins."""
    own = series.where((F.col("identity_key") == identity_key) & (F.col("reaction_pt") == reaction_pt))
    return own.agg(F.coalesce(F.sum(F.when(F.year("report_quarter") < first.year, F.col("n_cases"))), F.lit(0)).alias("n_before"))


def as_dicts(rows: DataFrame) -> list[dict]:
    """Rows of a bounded lookup as dictionaries."""
    return [r.asDict() for r in rows.collect()]
