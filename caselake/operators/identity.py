"""From free-text names to ingredient-set identities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import pieces

# Pieces that name no ingredient.
PLACEHOLDERS = (
    "COSMETICS", "UNSPECIFIED INGREDIENT", "DEVICE", "INVESTIGATIONAL PRODUCT", "VITAMINS", "HERBALS",
    "MINERALS", "DIETARY SUPPLEMENT", "AMINO ACIDS", "INFLUENZA VIRUS VACCINE",
)
LEAST_SUPPORT, PURE, MOSTLY = 5, 0.95, 0.8


def band(support: Column, purity: Column) -> Column:
    return F.when(support < LEAST_SUPPORT, "low_support").when(purity >= PURE, "pure").when(purity >= MOSTLY, "mostly").otherwise("ambiguous")


def name_lookup(drug: DataFrame, name: str = "drugname_clean") -> DataFrame:
    """The commonest ingredient string of each name, its support and how pure it is."""
    known = drug.where(F.col("prod_ai").isNotNull() & F.col(name).isNotNull()).groupBy(name, "prod_ai").agg(F.count("*").alias("n"))
    purity = F.max("n").cast("double") / F.sum("n").cast("double")
    # equal counts: the larger string, so that the result doesn't depend on row order
    modal = F.max_by("prod_ai", F.struct("n", "prod_ai"))
    found = known.groupBy(name).agg(modal.alias("modal_ai"), F.sum("n").alias("support"), purity.alias("purity"), F.count("prod_ai").alias("n_ai"))
    return found.select(name, "modal_ai", "support", band(F.col("support"), F.col("purity")).alias("band"), "purity", "n_ai")


def resolve(drug: DataFrame, lookup: DataFrame) -> DataFrame:
    """The reported ingredient string, or the lookup's where the name is pure; and which of them it was."""
    known = lookup.select("drugname_clean", "band", "modal_ai")
    reported, pure = F.col("prod_ai").isNotNull(), F.col("band") == "pure"
    return (
        drug.join(known, "drugname_clean", "left")
        .withColumn("prod_ai_resolved", F.when(reported, F.col("prod_ai")).when(pure, F.col("modal_ai")))
        .withColumn("prod_ai_source", F.when(reported, "reported").when(pure, "lookup"))
        .drop("modal_ai")
    )


def strings(resolved: DataFrame) -> DataFrame:
    """The distinct resolved strings and their rows: later steps work on these, weighted by n."""
    return resolved.where("prod_ai_resolved is not null").groupBy("prod_ai_resolved").agg(F.count("*").alias("n"))


def piece_totals(by_string: DataFrame) -> DataFrame:
    """Pieces and the rows behind them; a piece repeated inside a string counts each time."""
    return by_string.select(F.explode(pieces(F.col("prod_ai_resolved"))).alias("piece"), "n").groupBy("piece").agg(F.sum("n").alias("n_rows"))


def placeholder(piece: Column) -> Column:
    return piece.like("% NOS") | piece.isin(*PLACEHOLDERS)


def piece_identity(totals: DataFrame, seed: DataFrame, rxcui: DataFrame, related: DataFrame) -> DataFrame:
    """The identity of each piece by the first rule that speaks.

    Seed map; a single ingredient in the vocabulary; the one of several whose name is the piece (else
    ambiguous); placeholders; the piece itself.  Each rule speaks once a piece, so one row is left.
    """
    matches = rxcui.where("rxcui is not null").join(related, "rxcui").select("piece", "in_rxcui", "in_name").distinct()
    exact = F.upper("in_name") == F.col("piece")
    found = matches.groupBy("piece").agg(
        F.count("*").alias("n_ins"), F.min("in_rxcui").alias("only"),
        F.count(F.when(exact, F.col("in_rxcui"))).alias("n_exact"), F.min(F.when(exact, F.col("in_rxcui"))).alias("exact"),
    )
    seeded = seed.select("piece", F.col("identity").alias("s_identity"), F.col("identity_source").alias("s_source"), F.col("tty").alias("s_tty"), F.lit(True).alias("seeded"))
    rows = totals.join(found, "piece", "left").join(seeded, "piece", "left")
    ladder = [  # (condition, identity, source, tty, status, rule, rank)
        (F.col("seeded"), F.col("s_identity"), F.col("s_source"), F.col("s_tty"), "matched", "seed", 1),
        (F.col("n_ins") == 1, F.concat(F.lit("rxcui:"), "only"), F.lit("rxnorm"), F.lit("IN"), "matched", "rxnav_in", 2),
        ((F.col("n_ins") > 1) & (F.col("n_exact") == 1), F.concat(F.lit("rxcui:"), "exact"), F.lit("rxnorm"), F.lit("IN"), "matched", "name_pick", 3),
        (F.col("n_ins") > 1, None, None, None, "ambiguous", "name_pick", 3),
        (placeholder(F.col("piece")), None, None, None, "non_specific", "placeholder", 4),
        (F.lit(True), F.concat(F.lit("local:"), "piece"), F.lit("local"), None, "unmatched", "local", 6),
    ]

    def pick(at: int, kind: str) -> Column:
        out = F.when(F.lit(False), F.lit(None))
        for rung in ladder:
            value = rung[at]
            out = out.when(F.coalesce(rung[0], F.lit(False)), value if isinstance(value, Column) else F.lit(value))
        return out.cast(kind)

    names = (("identity", 1, "string"), ("identity_source", 2, "string"), ("tty", 3, "string"), ("status", 4, "string"), ("rule", 5, "string"), ("rule_rank", 6, "int"))
    return rows.select("piece", *(pick(at, kind).alias(name) for name, at, kind in names), "n_rows")


def string_identity(by_string: DataFrame, identities: DataFrame) -> DataFrame:
    """Status, sorted identity set and key of each string; the worst status of its pieces counts."""
    rows = by_string.select("prod_ai_resolved", "n", F.explode(pieces(F.col("prod_ai_resolved"))).alias("piece"))
    any_of = lambda s: F.bool_or(F.col("status") == s).alias(s)
    rolled = rows.join(identities.select("piece", "identity", "status"), "piece").groupBy("prod_ai_resolved", "n").agg(
        any_of("ambiguous"), any_of("non_specific"), any_of("unmatched"), F.array_sort(F.collect_set("identity")).alias("raw_set")
    )
    status = (
        F.when(F.col("prod_ai_resolved").like("% OR %") | F.col("ambiguous"), "ambiguous")
        .when(F.col("non_specific"), "non_specific")
        .when(F.col("unmatched"), "unmatched")
        .otherwise("matched")
    )
    whole = rolled.withColumn("status", status).withColumn("identity_set", F.when(F.col("status").isin("matched", "unmatched"), F.col("raw_set")))
    return whole.select(
        "prod_ai_resolved", F.col("n").alias("n_rows"), "status", "identity_set",
        F.array_join("identity_set", "|").alias("identity_key"), F.size("identity_set").alias("n_ingredients"),
    )
