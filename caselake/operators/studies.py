"""Analysis queries over the warehouse; each entry holds the DataFrame form and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..shared import stage
from .identity import band, name_lookup, placeholder

# Rows from which a name or string counts as head, upper-mid or mid.
STRATA = ((1000, "head"), (40, "upper-mid"), (3, "mid"))
_STRATUM = "case when n >= 1000 then 'head' when n >= 40 then 'upper-mid' when n >= 3 then 'mid' else 'tail' end"


def stratum(n: Column) -> Column:
    out = F.lit("tail")
    for least, name in reversed(STRATA):
        out = F.when(n >= least, name).otherwise(out)
    return out


def tagged_families(resolved: DataFrame, ladder: list[tuple[str, list[str]]]) -> DataFrame:
    """Rows of each piece in each family, where a family is the first whose patterns match; by source."""
    counts = resolved.where("prod_ai_resolved is not null").groupBy("prod_ai_resolved", "prod_ai_source").agg(F.count("*").alias("n"))
    rows = counts.select("prod_ai_source", "n", F.explode(F.split("prod_ai_resolved", r"\\")).alias("raw")).withColumn("piece", F.upper(F.trim("raw")))
    family = F.lit(None).cast("string")
    for name, patterns in reversed(ladder):
        hit = F.lit(False)
        for p in patterns:
            hit = hit | F.col("piece").like(p)
        family = F.when(hit, name).otherwise(family)
    by = lambda s: F.sum(F.when(F.col("prod_ai_source") == s, F.col("n")))
    rows = rows.withColumn("family", family).where("family is not null")
    return rows.groupBy("family", "piece").agg(F.sum("n").alias("n_rows"), by("reported").alias("n_reported"), by("lookup").alias("n_lookup"))


def name_ranks(drug: DataFrame) -> DataFrame:
    """Names by frequency with rank, running sum and running share.

    Names are dealt to ranges in order of frequency; each range is ranked by itself and moved by what the ranges before
    it hold, so no task sees all names.  Only one row a range meets in one task."""
    counts = drug.where("role_cod = 'PS' and drugname is not null and drugname <> ''").groupBy("drugname").agg(F.count("*").alias("n"))
    n = int(drug.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = stage(counts.repartitionByRange(n, F.desc("n"), "drugname").withColumn("part", F.spark_partition_id()), "ranges")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sizes = ranges.groupBy("part").agg(F.count("*").alias("k"), F.sum("n").alias("s"))
    moved = sizes.select("part", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("k0"), F.coalesce(F.sum("s").over(before), F.lit(0)).alias("s0"), F.sum("s").over(W.partitionBy()).alias("total"))
    order = W.partitionBy("part").orderBy(F.desc("n"), "drugname")
    ranked = ranges.select("part", "drugname", "n", F.row_number().over(order).alias("k"), F.sum("n").over(order).alias("s")).join(F.broadcast(moved), "part")  # a row a range
    return ranked.select("drugname", "n", (F.col("k0") + F.col("k")).cast("int").alias("rk"), (F.col("s0") + F.col("s")).alias("cum_n"), ((F.col("s0") + F.col("s")).cast("double") / F.col("total")).alias("cum_pct"))


def name_totals(drug: DataFrame) -> DataFrame:
    """Distinct names and names met once."""
    counts = drug.where("role_cod = 'PS' and drugname is not null and drugname <> ''").groupBy("drugname").agg(F.count("*").alias("n"))
    return counts.agg(F.count("*").alias("distinct_names"), F.count_if(F.col("n") == 1).alias("singletons"))


def _shares(rows: DataFrame, digits: int) -> DataFrame:
    """Names and rows by stratum and band, and their share of all rows."""
    out = rows.groupBy(stratum(F.col("n")).alias("stratum"), "band").agg(F.count("*").alias("names"), F.sum("n").alias("n_rows"))
    return out.withColumn("pct_rows", F.round(F.col("n_rows").cast("double") * 100 / F.sum("n_rows").over(W.partitionBy()), digits))


def residual(resolved: DataFrame) -> DataFrame:
    """Unreported primary suspects by stratum and band."""
    rows = resolved.where("role_cod = 'PS' and prod_ai is null").groupBy("drugname", F.coalesce("band", F.lit("no_match")).alias("band"))
    return _shares(rows.agg(F.count("*").alias("n")), 2)


def qualifiers(drug: DataFrame) -> DataFrame:
    """Parenthesised parts of names and how often they occur."""
    rows = drug.where("role_cod = 'PS'").select("drugname", F.explode(F.regexp_extract_all("drugname", F.lit(r"\(([^()]*)\)"), F.lit(1))).alias("raw"))
    return rows.groupBy(F.upper(F.trim("raw")).alias("qualifier")).agg(F.count("*").alias("n_rows"), F.countDistinct("drugname").alias("n_names"))


def fill_rate(drug: DataFrame, demo: DataFrame) -> DataFrame:
    """Share of primary suspects with ingredients, by year."""
    rows = drug.where("role_cod = 'PS'").join(demo.select("primaryid", F.year("fda_dt").alias("yr")), "primaryid")
    n, k = F.count("*"), F.count("prod_ai")
    return rows.groupBy("yr").agg(n.alias("total_rows"), k.alias("fill_count"), F.round(k.cast("double") * 100 / n, 1).alias("fill_pct"))


def lookup_coverage(drug: DataFrame, name: str = "drugname") -> DataFrame:
    """Unreported primary suspects by stratum and the band that a lookup by ``name`` gives them."""
    known = name_lookup(drug, name).select(name, "support", "purity")
    target = drug.where("prod_ai is null and role_cod = 'PS'").groupBy(*{"drugname", name}).agg(F.count("*").alias("n"))
    rated = F.when(F.col("support").isNull(), "no_match").otherwise(band(F.col("support"), F.col("purity")))
    return _shares(target.join(known, name, "left").select("n", rated.alias("band")), 1)


def piece_weights(drug: DataFrame) -> DataFrame:
    """Rows behind each filled piece; a piece counts once a string."""
    counts = drug.where("prod_ai is not null").groupBy("prod_ai").agg(F.count("*").alias("n_rows"))
    rows = counts.select("prod_ai", "n_rows", F.explode(F.split("prod_ai", r"\\")).alias("raw")).select("prod_ai", "n_rows", F.upper(F.trim("raw")).alias("piece"))
    return rows.where("piece <> ''").distinct().groupBy("piece").agg(F.sum("n_rows").alias("n_rows"))


def top_pieces(drug: DataFrame, most: int = 20) -> DataFrame:
    """Z08."""
    return piece_weights(drug).orderBy(F.desc("n_rows"), "piece").limit(most)


def unmatched_pieces(drug: DataFrame, rxcui: DataFrame, most: int = 30) -> DataFrame:
    """Fetched pieces without a match, heaviest first."""
    ids = rxcui.groupBy("piece").agg(F.count("rxcui").alias("n_ids")).where("n_ids = 0")
    return ids.join(piece_weights(drug), "piece").select("piece", "n_rows").orderBy(F.desc("n_rows"), "piece").limit(most)


def term_classes(drug: DataFrame, rxcui: DataFrame, properties: DataFrame) -> DataFrame:
    """Pieces and rows by class of the matched term."""
    tty = F.col("tty")
    kind = F.when(tty.isin("IN", "PIN", "IN/PIN"), "ingredient").when(tty == "MIN", "multi").when(tty == "BN", "brand").when(tty.isin("SCD", "SBD"), "product").otherwise("other")
    rows = rxcui.join(properties, "rxcui").join(piece_weights(drug), "piece").select(kind.alias("tty_class"), "piece", "n_rows").distinct()
    return rows.groupBy("tty_class").agg(F.count("*").alias("n_pieces"), F.sum("n_rows").alias("n_rows"))


def collapses(drug: DataFrame, rxcui: DataFrame, related: DataFrame) -> DataFrame:
    """Pieces with several ids, by whether these lead to one ingredient."""
    rows = rxcui.join(related, "rxcui").join(piece_weights(drug), "piece").groupBy("piece", "n_rows")
    found = rows.agg(F.countDistinct("rxcui").alias("n_ids"), F.countDistinct("in_rxcui").alias("n_ins")).where("n_ids > 1")
    return found.groupBy((F.col("n_ins") == 1).alias("collapses")).agg(F.count("*").alias("n_pieces"), F.sum("n_rows").alias("n_rows"))


def _exact(rxcui: DataFrame, properties: DataFrame) -> DataFrame:
    """Pieces that are a matched term's name."""
    return rxcui.join(properties, (rxcui["rxcui"] == properties["rxcui"]) & (rxcui["piece"] == F.upper(properties["rxcui_name"]))).select("piece").distinct()


def containment(drug: DataFrame, rxcui: DataFrame, related: DataFrame, properties: DataFrame) -> DataFrame:
    """Normalised matches, by whether some ingredient's name isn't part of the piece."""
    normal = rxcui.where("rxcui is not null").join(_exact(rxcui, properties), "piece", "left_anti")
    rows = normal.join(related, "rxcui").withColumn("found", F.contains(F.lower("piece"), F.lower("in_name"))).join(piece_weights(drug), "piece")
    found = rows.groupBy("piece", "n_rows").agg(F.bool_and("found").alias("all_found"))
    return found.groupBy((~F.col("all_found")).alias("flagged")).agg(F.count("*").alias("n_pieces"), F.sum("n_rows").alias("n_rows"))


def string_status(drug: DataFrame, rxcui: DataFrame, properties: DataFrame) -> DataFrame:
    """Status of each reported string, the worst of its pieces."""
    flags = rxcui.where("rxcui is not null").select("piece").distinct().withColumn("matched", F.lit(True))
    exact = _exact(rxcui, properties).withColumn("exact", F.lit(True))
    rank = F.when(F.col("exact"), 0).when(F.col("matched"), 1).when(placeholder(F.col("piece")), 2).otherwise(3)
    status = piece_weights(drug).join(flags, "piece", "left").join(exact, "piece", "left").select("piece", rank.alias("rank"))
    counts = drug.where("prod_ai is not null").groupBy("prod_ai").agg(F.count("*").alias("n_rows"))
    rows = counts.select("prod_ai", "n_rows", F.explode(F.split("prod_ai", r"\\")).alias("raw")).withColumn("piece", F.upper(F.trim("raw")))
    worst = rows.join(status, "piece").groupBy("prod_ai", "n_rows").agg(F.max("rank").alias("worst"))
    label = F.element_at(F.array(*map(F.lit, ("exact", "normalized", "non_specific", "no_match"))), F.col("worst") + 1)
    return worst.select("prod_ai", "n_rows", stratum(F.col("n_rows")).alias("stratum"), F.when(F.col("prod_ai").like("% OR %"), "ambiguous").otherwise(label).alias("status"))


def top_unmatched_strings(statuses: DataFrame, most: int = 20) -> DataFrame:
    return statuses.where("status = 'no_match'").orderBy(F.desc("n_rows"), "prod_ai").limit(most)


def match_histogram(rxcui: DataFrame) -> DataFrame:
    """How many pieces have how many ids, from two up."""
    counts = rxcui.groupBy("piece").agg(F.count("rxcui").alias("n")).where("n > 1")
    return counts.groupBy("n").agg(F.count("*").alias("group_n"))


FAMILIES = [("warm", ["%HOT%", "%RED%"]), ("cool", ["%COLD%", "%BLUE%"]), ("goods", ["%WIDGET%"])]
_PIECES = r"(select piece, sum(n_rows)::bigint as n_rows from (select distinct prod_ai, n_rows, piece from (select prod_ai, n_rows, upper(trim(unnest(string_split(prod_ai, '\')))) as piece from (select prod_ai, count(*) as n_rows from drug where prod_ai is not null group by 1)) where piece <> '') group by 1)"
_PROPERTIES = "(select rxcui, in_name as rxcui_name, case in_rxcui when '101' then 'IN' when '102' then 'BN' when '104' then 'MIN' else 'SCD' end as tty from related)"


def _properties(w) -> DataFrame:
    tty = F.when(F.col("in_rxcui") == "101", "IN").when(F.col("in_rxcui") == "102", "BN").when(F.col("in_rxcui") == "104", "MIN").otherwise("SCD")
    return w["related"].select("rxcui", F.col("in_name").alias("rxcui_name"), tty.alias("tty"))


_BANDS = "(values ('low_support', 0, 5, 0.0, 1.1), ('ambiguous', 5, 1e18, 0.0, 0.8), ('mostly', 5, 1e18, 0.8, 0.95), ('pure', 5, 1e18, 0.95, 1.1)) graded(band, s0, s1, p0, p1)"
_STRATA = "(values ('tail', 1, 3), ('mid', 3, 40), ('upper-mid', 40, 1000), ('head', 1000, 1e18)) layer(stratum, n0, n1)"


def _coverage_sql(name: str) -> str:
    """Both the bands and the strata as tables of limits; shares of the one total."""
    return (
        f"select * from (with asked as (select drugname, any_value({name}) as key, count(*) as n from drug where prod_ai is null and role_cod = 'PS' group by drugname), "
        f"seen as (select key, sum(k) as support, max(k) / sum(k) as purity from (select {name} as key, count(*) as k from drug where prod_ai is not null group by {name}, prod_ai) group by key), "
        f"known as (select key, band from seen join {_BANDS} on support >= s0 and support < s1 and purity >= p0 and purity < p1) "
        f"select stratum, coalesce(band, 'no_match') as band, count(*) as names, sum(n)::bigint as n_rows, round(100 * sum(n) / (select sum(n) from asked), 1) as pct_rows "
        f"from asked join {_STRATA} on n >= n0 and n < n1 left join known using (key) group by all)"
    )


_EXACT = f"(select distinct r.piece from rxcui r join {_PROPERTIES} p on p.rxcui = r.rxcui and r.piece = upper(p.rxcui_name))"

_STATUS = (
        rf"select prod_ai, n as n_rows, {_STRATUM} as stratum, case when prod_ai like '% OR %' then 'ambiguous' when bool_or(s = 3) then 'no_match' when bool_or(s = 2) then 'non_specific' when bool_or(s = 1) then 'normalized' else 'exact' end as status from (select prod_ai, n, case when piece in (select piece from {_EXACT}) then 0 when piece in (select piece from rxcui where rxcui is not null) then 1 when piece like '% NOS' then 2 else 3 end as s "
        r"from (select prod_ai, n, upper(trim(unnest(string_split(prod_ai, '\')))) as piece from (select prod_ai, count(*) as n from drug where prod_ai is not null group by 1)) where piece <> '') group by 1, 2"
)

#: name: (DataFrame form over a warehouse, SQL over its relations)
STUDIES: dict[str, tuple[Callable, str]] = {
    "z01_tagged_families": (
        lambda w: tagged_families(w["resolved"], FAMILIES),
        r"select family, piece, sum(n)::bigint as n_rows, (sum(n) filter (where prod_ai_source = 'reported'))::bigint as n_reported, (sum(n) filter (where prod_ai_source = 'lookup'))::bigint as n_lookup from (select *, case when piece like '%HOT%' or piece like '%RED%' then 'warm' when piece like '%COLD%' or piece like '%BLUE%' then 'cool' when piece like '%WIDGET%' then 'goods' end as family "
        r"from (select prod_ai_source, n, upper(trim(unnest(string_split(prod_ai_resolved, '\')))) as piece from (select prod_ai_resolved, prod_ai_source, count(*) as n from resolved where prod_ai_resolved is not null group by 1, 2))) where family is not null group by 1, 2",
    ),
    "z02_name_ranks": (
        lambda w: name_ranks(w["stg_drug"]).select("drugname", "n", "rk", "cum_n", F.round("cum_pct", 6).alias("cum_pct")),
        "select * from (with counts as (select drugname, count(*) as n from drug where role_cod = 'PS' group by 1) select x.drugname, x.n, count(*)::int as rk, sum(y.n)::bigint as cum_n, round(sum(y.n) / (select sum(n) from counts), 6) as cum_pct "
        "from counts x join counts y on y.n > x.n or (y.n = x.n and y.drugname <= x.drugname) group by 1, 2)",
    ),
    "z02_name_totals": (lambda w: name_totals(w["stg_drug"]), "select count(*) as distinct_names, count_if(n = 1)::bigint as singletons from (select drugname, count(*) as n from drug where role_cod = 'PS' group by 1)"),
    "z03_residual": (
        lambda w: residual(w["resolved"]),
        f"select {_STRATUM} as stratum, band, count(*) as names, sum(n)::bigint as n_rows, round(sum(n) * 100 / sum(sum(n)) over (), 2) as pct_rows from (select drugname, coalesce(band, 'no_match') as band, count(*) as n from resolved where role_cod = 'PS' and prod_ai is null group by 1, 2) group by 1, 2",
    ),
    "z04_qualifiers": (lambda w: qualifiers(w["stg_drug"]), r"select upper(trim(raw)) as qualifier, count(*) as n_rows, count(distinct drugname) as n_names from (select drugname, unnest(regexp_extract_all(drugname, '\(([^()]*)\)', 1)) as raw from drug where role_cod = 'PS') group by 1"),
    "z05_fill_rate": (lambda w: fill_rate(w["stg_drug"], w["stg_demo"]), "select year(fda_dt)::int as yr, count(*) as total_rows, count(prod_ai) as fill_count, round(100.0 * count(prod_ai) / count(*), 1)::double as fill_pct from drug join stg_demo using (primaryid) where role_cod = 'PS' group by 1"),
    "z06_cleaned_coverage": (lambda w: lookup_coverage(w["stg_drug"], "drugname_clean"), _coverage_sql("drugname_clean")),
    "z07_coverage": (lambda w: lookup_coverage(w["stg_drug"]), _coverage_sql("drugname")),
    "z08_top_pieces": (lambda w: top_pieces(w["stg_drug"]), f"select piece, n_rows from {_PIECES} order by n_rows desc, piece limit 20"),
    "z09_unmatched_pieces": (lambda w: unmatched_pieces(w["stg_drug"], w["rxcui"]), f"select piece, n_rows from (select piece from rxcui group by 1 having count(rxcui) = 0) join {_PIECES} using (piece) order by 2 desc, 1 limit 30"),
    "z10_term_classes": (
        lambda w: term_classes(w["stg_drug"], w["rxcui"], _properties(w)),
        f"select tty_class, count(*) as n_pieces, sum(n_rows)::bigint as n_rows from (select distinct case when tty in ('IN', 'PIN') then 'ingredient' when tty = 'MIN' then 'multi' when tty = 'BN' then 'brand' else 'product' end as tty_class, piece, n_rows from rxcui join {_PROPERTIES} using (rxcui) join {_PIECES} using (piece)) group by 1",
    ),
    "z11_collapses": (
        lambda w: collapses(w["stg_drug"], w["rxcui"], w["related"]),
        f"select n_ins = 1 as collapses, count(*) as n_pieces, sum(n_rows)::bigint as n_rows from (select piece, n_rows, count(distinct in_rxcui) as n_ins from rxcui join related using (rxcui) join {_PIECES} using (piece) group by 1, 2 having count(distinct rxcui) > 1) group by 1",
    ),
    "z12_containment": (
        lambda w: containment(w["stg_drug"], w["rxcui"], w["related"], _properties(w)),
        f"select not all_found as flagged, count(*) as n_pieces, sum(n_rows)::bigint as n_rows from (select piece, n_rows, bool_and(contains(lower(piece), lower(in_name))) as all_found from rxcui join related using (rxcui) join {_PIECES} using (piece) where piece not in (select piece from {_EXACT}) group by 1, 2) group by 1",
    ),
    "z13_string_status": (lambda w: string_status(w["stg_drug"], w["rxcui"], _properties(w)), _STATUS),
    "z13_top_unmatched": (lambda w: top_unmatched_strings(string_status(w["stg_drug"], w["rxcui"], _properties(w))), f"select * from ({_STATUS}) where status = 'no_match' order by n_rows desc, prod_ai limit 20"),
    "z14_match_histogram": (lambda w: match_histogram(w["rxcui"]), "select n, count(*) as group_n from (select piece, count(rxcui) as n from rxcui group by 1 having count(rxcui) > 1) group by 1"),
}
