"""Dimensions and the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import surrogate_key

# Outcome codes, their labels and their flags.
OUTCOMES = {
    "DE": ("Death", "has_death"), "HO": ("Hospitalization", "has_hospitalization"), "LT": ("Life-Threatening", "has_life_threatening"),
    "DS": ("Disability", "has_disability"), "CA": ("Congenital Anomaly", "has_congenital_anomaly"), "RI": ("Required Intervention", "has_required_intervention"),
}
GROUP = ("age_group", "sex", "reporter_country")


def dim_drug(identity: DataFrame, signals: DataFrame) -> DataFrame:
    counts = signals.groupBy("identity_key").agg(F.count_if(F.col("ic025") > 0).alias("n_signals"))
    label = F.max_by("prod_ai_resolved", F.struct("n_rows", "prod_ai_resolved"))
    status = F.when(F.bool_or(F.col("status") == "unmatched"), "unmatched").otherwise("matched")
    drugs = identity.where("identity_key is not null").groupBy("identity_key").agg(label.alias("drug_label"), status.alias("status"), F.any_value("n_ingredients", True).alias("n_ingredients"))
    joined = drugs.join(counts, "identity_key", "left")
    return joined.select(surrogate_key(F.col("identity_key")).alias("drug_key"), "identity_key", "drug_label", "status", "n_ingredients", F.coalesce("n_signals", F.lit(0)).alias("n_signals"))


def dim_reaction(pairs: DataFrame) -> DataFrame:
    return pairs.select("reaction_pt").distinct().select(surrogate_key(F.col("reaction_pt")).alias("reaction_key"), "reaction_pt")


def dim_outcome(outcomes: DataFrame) -> DataFrame:
    label = F.lit("Other")
    for code, (name, _) in OUTCOMES.items():
        label = F.when(F.col("outcome_code") == code, name).otherwise(label)
    return outcomes.select("outcome_code").distinct().select(surrogate_key(F.col("outcome_code")).alias("outcome_key"), "outcome_code", label.alias("outcome_desc"))


def dim_demographics(demo: DataFrame) -> DataFrame:
    return demo.select(*GROUP).distinct().select(surrogate_key(*map(F.col, GROUP)).alias("demographics_key"), *GROUP)


def outcome_flags(outcomes: DataFrame) -> DataFrame:
    """One row a report with a flag for each kind of outcome, before any join multiplies rows."""
    code = F.col("outcome_code")
    flags = [F.max(F.when(code == k, 1).otherwise(0)).alias(flag) for k, (_, flag) in OUTCOMES.items()]
    return outcomes.groupBy("primaryid").agg(*flags, F.max(F.when(~code.isin(*OUTCOMES), 1).otherwise(0)).alias("has_other_outcome"))


def fact(pairs: DataFrame, demo: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Case x drug x reaction; reports without demographics are left out."""
    flags = outcome_flags(outcomes)
    names = [c for c in flags.columns if c != "primaryid"]
    rows = pairs.join(demo.select("primaryid", "event_dt", *GROUP), "primaryid").join(flags, "primaryid", "left")
    return rows.select(
        "primaryid", F.when(F.col("identity_key").isNotNull(), surrogate_key(F.col("identity_key"))).alias("drug_key"),
        surrogate_key(F.col("reaction_pt")).alias("reaction_key"), surrogate_key(*map(F.col, GROUP)).alias("demographics_key"),
        "identity_key", "reaction_pt", "event_dt", *(F.coalesce(c, F.lit(0)).alias(c) for c in names),
    )
