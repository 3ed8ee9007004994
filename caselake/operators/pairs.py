"""Case triples, the 2x2 table of every pair, and pair-quarter counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRIPLE = ("primaryid", "identity_key", "reaction_pt")

# Years in a unit of age, as multiplier and divisor.
AGE_UNITS = {"YR": (1, 1), "DEC": (10, 1), "MON": (1, 12), "WK": (1, 52), "DY": (1, 365), "HR": (1, 8760)}


def demographics(demo: DataFrame) -> DataFrame:
    """Age in years, age group and sex label of each report."""
    age = F.lit(None).cast("double")
    for unit, (times, by) in AGE_UNITS.items():
        age = F.when(F.col("age_cod") == unit, F.col("age").cast("double") * times / by).otherwise(age)
    years = F.col("age_years")
    group = (
        F.when((years < 0) | (years > 120), "Unknown").when(years < 18, "0-17").when(years < 45, "18-44").when(years < 65, "45-64").when(years >= 65, "65+").otherwise("Unknown")
    )
    sex = F.when(F.upper("sex") == "M", "Male").when(F.upper("sex") == "F", "Female").otherwise("Unknown")
    return demo.withColumn("age_years", age).select(
        "primaryid", "age_years", "init_fda_dt", "fda_dt", group.alias("age_group"), sex.alias("sex"), "reporter_country", "event_dt", "occp_cod"
    )


def case_pairs(resolved: DataFrame, identity: DataFrame, reactions: DataFrame, demo: DataFrame) -> DataFrame:
    """Distinct (report, identity, reaction) of primary suspects, with lawyer flag and quarter.

    Reports without a known identity or demographics stay, with nulls there.
    """
    suspects = resolved.where("role_cod = 'PS'").select("primaryid", "prod_ai_resolved")
    keys = identity.select("prod_ai_resolved", "identity_key")
    when = demo.select(
        "primaryid", F.coalesce(F.col("occp_cod") == "LW", F.lit(False)).alias("lw"), F.trunc(F.coalesce("init_fda_dt", "fda_dt"), "quarter").alias("report_quarter")
    )
    # strings are resolved and repeats dropped before reactions multiply the rows
    named = suspects.join(keys, "prod_ai_resolved", "left").select("primaryid", "identity_key").distinct()
    return (
        named.join(reactions.select("primaryid", "reaction_pt").distinct(), "primaryid")
        .join(when, "primaryid", "left")
        .select(*TRIPLE, F.coalesce("lw", F.lit(False)).alias("is_lw"), "report_quarter")
        .distinct()
    )


def _cases(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Distinct reports for each key, all and without lawyers, from one pre-aggregation."""
    grain = df.groupBy(*keys, "primaryid").agg(F.min(F.col("is_lw").cast("int")).alias("lw"))
    total = [F.count("*").alias(name), F.sum(1 - F.col("lw")).alias(f"{name}_nolw")]
    return (grain.groupBy(*keys) if keys else grain.groupBy()).agg(*total)


def contingency(pairs: DataFrame) -> DataFrame:
    """A, b, c, d of every (identity, reaction), and the same without lawyers' reports.

    Reaction and overall totals include reports without identity.
    """
    known = pairs.where("identity_key is not null")
    a = _cases(known, ["identity_key", "reaction_pt"], "a")
    drug, reaction, every = _cases(known, ["identity_key"], "drug"), _cases(pairs, ["reaction_pt"], "reac"), _cases(pairs, [], "every")
    rows = a.join(drug, "identity_key").join(reaction, "reaction_pt").crossJoin(F.broadcast(every))  # one row
    cells = []
    for s in ("", "_nolw"):
        n, d, r, t = (F.col(f"{x}{s}") for x in ("a", "drug", "reac", "every"))
        cells += [n.alias(f"a{s}"), (d - n).alias(f"b{s}"), (r - n).alias(f"c{s}"), (t - d - r + n).alias(f"d{s}")]
    return rows.select("identity_key", "reaction_pt", *cells)


def pair_quarters(pairs: DataFrame) -> DataFrame:
    """Reports a quarter for every pair; quarters without reports have no row."""
    grown = _cases(pairs.where("identity_key is not null"), ["identity_key", "reaction_pt", "report_quarter"], "n_cases")
    return grown
