"""Registered queries of the report-analytics engine and their SQL twins, keyed by operator id."""

from __future__ import annotations

from collections.abc import Callable
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_name
from ..operators import checks, serving, staging, studies, versions
from ..shared import stage
from . import ingest, relational
from .adapters import oracle, sources, table, warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


def _built(name: str, relation: str, columns: str, sql_columns: str | None = None, where: str = "") -> None:
    """A query that shows one relation of the warehouse."""
    exprs = [c.strip() for c in columns.split(";")]
    body = f"select {', '.join(c.strip() for c in (sql_columns or columns).split(';'))} from {relation}{where}"
    register(name, oracle(body))(lambda spark, d: warehouse(spark, d)[relation].selectExpr(*exprs))


def _rounded(*names: str) -> str:
    return "; ".join(f"round({n}, 6) as {n}" for n in names)


# --- the warehouse (D07-D25, A04, A08, A10, A12, J02-J07, W06, N05, F19) ----------------------

_built("d25_stage_demo", "stg_demo", "primaryid; caseid; caseversion; event_dt; fda_dt; init_fda_dt; cast(age as double) as age; age_cod; sex; occp_cod; reporter_country", "primaryid; caseid; caseversion; event_dt; fda_dt; init_fda_dt; age::double as age; age_cod; sex; occp_cod; reporter_country")
register("d08_clean_name", oracle("select primaryid, drug_seq, drugname, drugname_clean, prod_ai from drug"))(lambda s, d: warehouse(s, d)["stg_drug"].select("primaryid", "drug_seq", "drugname", "drugname_clean", "prod_ai"))
_built("d09_name_lookup", "lookup", "drugname_clean; modal_ai; support; band; round(purity, 6) as purity; n_ai")
_built("d10_resolve", "resolved", "primaryid; drug_seq; role_cod; drugname; band; prod_ai_resolved; prod_ai_source")
_built("d11_pieces", "pieces", "piece; n_rows")
_built("d12_piece_identity", "piece_identity", "piece; identity; identity_source; tty; status; rule; rule_rank; n_rows")
_built("d13_string_identity", "string_identity", "prod_ai_resolved; n_rows; status; identity_key; n_ingredients")
_built("d14_case_pairs", "pairs", "primaryid; identity_key; reaction_pt; is_lw; report_quarter")
_built("d15_demographics", "demographics", "primaryid; round(age_years, 6) as age_years; age_group; sex; reporter_country; event_dt; occp_cod")
_built("d16_contingency", "contingency", "identity_key; reaction_pt; a; a_nolw; b; b_nolw; c; c_nolw; d; d_nolw")
_built("d21_pair_quarters", "pair_quarters", "identity_key; reaction_pt; report_quarter; n_cases; n_cases_nolw")
_SIGNAL = "identity_key; reaction_pt; a; b; c; d; n; " + _rounded("expected", "ic", "ic025") + "; a_nolw; n_nolw; " + _rounded("expected_nolw", "ic_nolw", "ic025_nolw", "pct_lw") + "; peak_quarter_n; peak_quarter; " + _rounded("peak_quarter_share")
_built("signals", "signals", _SIGNAL)
QUERIES["d20_d22_signals"], ORACLE_SQL["d20_d22_signals"] = QUERIES["signals"], ORACLE_SQL["signals"]
_built("d23_dim_drug", "dim_drug", "drug_key; identity_key; drug_label; status; n_ingredients; n_signals")

_CI = "exp(ln({v}) - 1.96 * {s})"
_PRR, _PRR_S = "(a::double / (a + b)) / (c::double / (c + d))", "sqrt(1.0::double / a - 1.0::double / (a + b) + 1.0::double / c - 1.0::double / (c + d))"
_E = "((a + b)::double * (a + c) / (a + b + c + d))"
#: Yates: the same gap in every cell, over the four expected counts.
_CHI = f"power(greatest(abs(a - {_E}) - 0.5, 0), 2) * (1 / {_E} + 1 / (a + b - {_E}) + 1 / (a + c - {_E}) + 1 / (d - a + {_E}))"
_ROR, _ROR_S = "(a::double * d) / (b::double * c)", "sqrt(1.0::double / a + 1.0::double / b + 1.0::double / c + 1.0::double / d)"
_SCORED = "from contingency where a >= 3 and b > 0 and c > 0 and d > 0"
register(
    "d17_d18_prr",
    oracle(f"select identity_key, reaction_pt, a, b, c, d, round({_PRR}, 6) as prr, round(exp(ln({_PRR}) - 1.96 * {_PRR_S}), 6) as prr_lower, round(exp(ln({_PRR}) + 1.96 * {_PRR_S}), 6) as prr_upper, round({_CHI}, 6) as chi_square, {_PRR} >= 2 and {_CHI} >= 4 and a >= 3 as is_evans_signal {_SCORED}"),
)(lambda s, d: _round(warehouse(s, d)["prr"]))
register("d19_ror", oracle(f"select identity_key, reaction_pt, a, b, c, d, round({_ROR}, 6) as ror, round(exp(ln({_ROR}) - 1.96 * {_ROR_S}), 6) as ror_lower, round(exp(ln({_ROR}) + 1.96 * {_ROR_S}), 6) as ror_upper {_SCORED}"))(lambda s, d: _round(warehouse(s, d)["ror"]))


def _round(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes))


_built("d23_dim_reaction", "dim_reaction", "reaction_key; reaction_pt")
ORACLE_SQL["d23_dim_reaction"] = oracle("select distinct md5(reaction_pt) as reaction_key, reaction_pt from pairs")
_built("d23_dim_outcome", "dim_outcome", "outcome_key; outcome_code; outcome_desc")
ORACLE_SQL["d23_dim_outcome"] = oracle("select distinct md5(outcome_code) as outcome_key, outcome_code, case outcome_code when 'DE' then 'Death' when 'HO' then 'Hospitalization' else 'Other' end as outcome_desc from outc")
_KEY3 = "md5(coalesce(age_group, '_dbt_utils_surrogate_key_null_') || '-' || coalesce(sex, '_dbt_utils_surrogate_key_null_') || '-' || coalesce(reporter_country, '_dbt_utils_surrogate_key_null_'))"
_built("d23_dim_demographics", "dim_demographics", "demographics_key; age_group; sex; reporter_country")
ORACLE_SQL["d23_dim_demographics"] = oracle(f"select distinct {_KEY3} as demographics_key, age_group, sex, reporter_country from demographics")
_built("d24_fact", "fact", "primaryid; drug_key; reaction_key; demographics_key; identity_key; reaction_pt; event_dt; has_death; has_hospitalization; has_life_threatening; has_disability; has_congenital_anomaly; has_required_intervention; has_other_outcome")
ORACLE_SQL["d24_fact"] = oracle(
    f"select p.primaryid, md5(identity_key) as drug_key, md5(reaction_pt) as reaction_key, {_KEY3} as demographics_key, identity_key, reaction_pt, event_dt, coalesce(de, 0) as has_death, coalesce(ho, 0) as has_hospitalization, 0 as has_life_threatening, 0 as has_disability, 0 as has_congenital_anomaly, 0 as has_required_intervention, coalesce(ot, 0) as has_other_outcome "
    "from pairs p join demographics e on e.primaryid = p.primaryid left join (select primaryid, max((outcome_code = 'DE')::int) as de, max((outcome_code = 'HO')::int) as ho, max((outcome_code = 'OT')::int) as ot from outc group by 1) o on o.primaryid = p.primaryid"
)

#: What the name cleaner makes of each kind of name: (kind, text around the upper-cased name, what is left).
_NAMES = (
    (0, "{} (RABBIT)", "{} RABBIT"), (1, "{} ( I-131 )", "{} I-131"), (2, "{} (UNCLOSED", "{}"), (3, "{} . ;", "{}"), (4, "{}  TABLETS", "{}"), (5, "{} 0.5/2 %", "{}"), (6, "{} 2B", "{} 2B"), (7, "(ALL {})", None),
    (8, "{} (X) (HORSE) Y", "{} HORSE Y"), (9, "{} SOLUTION FOR INJECTION", "{}"), (10, "{} 10 MG CAPSULE", "{}"), (11, "{} CAPLETS 10 MCG", "{} CAPLETS"), (12, "{} LU 177,", "{} LU 177"), (13, "{}", "{}"),
)


@register(
    "d08_clean_rules",
    "select p_partkey, case p_partkey % 14 " + " ".join(f"when {k} then " + ("null" if out is None else f"replace('{out}', '{{}}', upper(p_name))") for k, _, out in _NAMES) + " end as cleaned from part",
)
def _clean_rules(spark: SparkSession, d: str) -> DataFrame:
    form = F.element_at(F.array(*(F.lit(raw) for _, raw, _ in _NAMES)), (F.col("p_partkey") % 14 + 1).cast("int"))
    return table(spark, d, "part").select("p_partkey", clean_name(F.replace(form, F.lit("{}"), F.upper("p_name"))).alias("cleaned"))


# --- staging of the other tables (D25, N02) -----------------------------------------------------

_DAY = "case length({0}) when 8 then try_strptime({0}, '%Y%m%d')::date when 6 then try_strptime({0} || '01', '%Y%m%d')::date when 4 then try_strptime({0} || '0101', '%Y%m%d')::date end as {0}"
register("d25_stage_indi", oracle("select primaryid, try_cast(indi_drug_seq as int) as indi_drug_seq, indi_pt from indi"))(lambda s, d: staging.stage_indi(sources(s, d)["indi"]).drop("caseid"))
register("d25_stage_rpsr", oracle("select primaryid, caseid, rpsr_cod from rpsr"))(lambda s, d: staging.stage_rpsr(sources(s, d)["rpsr"]))
register("d25_stage_ther", oracle(f"select primaryid, try_cast(dsg_drug_seq as int) as dsg_drug_seq, {_DAY.format('start_dt')}, {_DAY.format('end_dt')}, dur::double as dur, dur_cod from ther"))(
    lambda s, d: staging.stage_ther(sources(s, d)["ther"]).drop("caseid").withColumn("dur", F.col("dur").cast("double"))
)
register("d25_stage_reac", oracle("select primaryid, reaction_pt from reac"))(lambda s, d: staging.stage_reac(sources(s, d)["reac"]).drop("caseid"))
register("d25_stage_outc", oracle("select primaryid, outcome_code from outc"))(lambda s, d: staging.stage_outc(sources(s, d)["outc"]).drop("caseid"))

for _name, (_make, _sql) in ingest.QUERIES.items():
    register(_name, _sql)(_make)

# --- versions and checks (D03-D06, W01-W04, J08-J11, P20, Q01-Q06) ---------------------------


def _merged(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    s = sources(spark, d)
    return {name: s[name] for name in ("demo", *versions.CHILDREN)}


def _retracted(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").where("c_custkey % 11 = 3").select(F.col("c_custkey").cast("string").alias("caseid"))


_CLEAN = "cleaned as (select distinct * from demo where caseid is not null and caseid not in (select c_custkey::varchar from customer where c_custkey % 11 = 3))"
_KEEP = (
    "ranked as (select primaryid, caseid, coalesce(try_cast(caseversion as bigint), 0) as v, (primaryid is not null)::int + (caseid is not null)::int + (caseversion is not null)::int + (fda_dt is not null)::int + (init_fda_dt is not null)::int + (event_dt is not null)::int + (age is not null)::int + (age_cod is not null)::int + (sex is not null)::int + (occp_cod is not null)::int + (reporter_country is not null)::int as filled from cleaned), "
    "children as (select primaryid, count(*) as n from (select primaryid from drug union all select primaryid from reac union all select primaryid from outc union all select primaryid from indi union all select primaryid from rpsr union all select primaryid from ther) group by 1), "
    "keep as (select caseid, primaryid from (select * from ranked qualify v = max(v) over (partition by caseid)) left join children using (primaryid) qualify row_number() over (partition by caseid order by coalesce(n, 0) desc, filled desc, try_cast(primaryid as bigint), primaryid) = 1)"
)


def _versions(body: str) -> str:
    return oracle("").rstrip() + f", {_CLEAN}, {_KEEP} {body}"


def _cleaned(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    merged = _merged(spark, d)
    return merged | {"demo": versions.clean(merged["demo"], "demo", _retracted(spark, d))}


register("d03_clean", _versions("select primaryid, caseid, caseversion from cleaned"))(lambda s, d: _cleaned(s, d)["demo"].select("primaryid", "caseid", "caseversion"))
register("d05_keep_list", _versions("select caseid, primaryid from keep"))(lambda s, d: versions.keep_list(_cleaned(s, d)["demo"], _cleaned(s, d)))


@register("d05_dedup_children", _versions("select primaryid, reaction_pt as pt from reac semi join keep using (primaryid)"))
def _dedup_children(spark: SparkSession, d: str) -> DataFrame:
    t = _cleaned(spark, d)
    return versions.dedup(t, versions.keep_list(t["demo"], t))["reac"].select("primaryid", "pt")


def _kept_sql(name: str, rows: str) -> str:
    """Share of a table's rows dropped, and its kept rows without a report."""
    kept = f"(select distinct * from {rows} semi join keep using (primaryid))"
    return (
        f"union all select 'dropped_pct_{name}', null, round(100.0 * ((select count(*) from {rows}) - (select count(*) from {kept})) / (select count(*) from {rows}), 1)::double "
        f"union all select 'orphans_{name}', null, (select count(*)::double from {kept} anti join keep using (primaryid))"
    )


@register(
    "d06_validate",
    _versions(
        "select 'one_row_per_primaryid' as \"check\", count(*) = count(distinct primaryid) as passed, (count(*) - count(distinct primaryid))::double as value from keep "
        "union all select 'one_row_per_caseid', count(*) = count(distinct caseid), (count(*) - count(distinct caseid))::double from keep "
        "union all select 'every_case_survives', count(distinct caseid) = 0, count(distinct caseid)::double from cleaned where caseid not in (select caseid from keep) "
        "union all select 'max_caseversion_kept', count(*) = 0, count(*)::double from keep join ranked using (caseid, primaryid) join (select caseid, max(v) as top from ranked group by 1) using (caseid) where v <> top "
        "union all select 'no_deleted_cases', count(*) = 0, count(*)::double from keep where caseid in (select c_custkey::varchar from customer where c_custkey % 11 = 3) "
        "union all select 'dropped_pct_demo', null, round(100.0 * ((select count(*) from cleaned) - (select count(*) from keep)) / (select count(*) from cleaned), 1)::double "
        + _kept_sql("drug", "(select primaryid, drug_seq, role_cod, drugname, prod_ai from drug)") + _kept_sql("reac", "reac").replace("union", " union", 1) + _kept_sql("outc", "(select *, 1 as one from outc)").replace("union", " union", 1)
        + "".join(_kept_sql(name, name).replace("union", " union", 1) for name in ("indi", "rpsr", "ther"))
    ),
)
def _validate(spark: SparkSession, d: str) -> DataFrame:
    t = _cleaned(spark, d)
    t["demo"] = stage(t["demo"], "cleaned")
    kept = versions.dedup(t, stage(versions.keep_list(t["demo"], t), "keep"))
    return versions.validate(t, {name: stage(df, f"kept-{name}") for name, df in kept.items()}, _retracted(spark, d))


@register(
    "q01_q05_checks",
    oracle(
        "select 'unique:identity_key,reaction_pt' as rule, count(*) as violations from (select 1 from contingency group by identity_key, reaction_pt having count(*) > 1) "
        "union all select 'not_null:report_quarter', count(*) from pairs where report_quarter is null "
        "union all select 'accepted_values:outcome_code', count(distinct outcome_code) from outc where outcome_code not in ('DE', 'HO') "
        "union all select 'relationships:identity_key', count(*) from pairs where identity_key is not null and identity_key not in (select identity_key from dim_drug) "
        "union all select 'expression:ic025 <= ic and a_nolw <= a', count(*) from signals where not (ic025 <= ic and a_nolw <= a) "
        "union all select 'equal_rowcount', abs((select count(*) from contingency) - (select count(*) from signals))"
    ),
)
def _rules(spark: SparkSession, d: str) -> DataFrame:
    w = warehouse(spark, d)
    return checks.report(
        checks.unique(w["contingency"], "identity_key", "reaction_pt"),
        checks.not_null(w["pairs"], "report_quarter"),
        checks.accepted_values(w["stg_outc"], "outcome_code", ["DE", "HO"]),
        checks.relationships(w["pairs"], "identity_key", w["dim_drug"], "identity_key"),
        checks.expression_is_true(w["signals"], "ic025 <= ic and a_nolw <= a"),
        checks.equal_rowcount(w["contingency"], w["signals"]),
    )


register("q06_seed_pieces_exist", oracle("select piece from seed where piece not in (select piece from pieces)"))(lambda s, d: checks.seed_pieces_exist(warehouse(s, d)["seed"], warehouse(s, d)["pieces"]))
register("q06_identities_complete", oracle("select prod_ai_resolved from resolved where prod_ai_resolved is not null except select prod_ai_resolved from string_identity"))(lambda s, d: checks.identities_complete(warehouse(s, d)["resolved"], warehouse(s, d)["string_identity"]))
register("q06_seed_pieces_win", oracle("select s.piece, i.rule from seed s left join piece_identity i using (piece) where i.rule is distinct from 'seed'"))(lambda s, d: checks.seed_pieces_win(warehouse(s, d)["seed"], warehouse(s, d)["piece_identity"]))

# --- serving (V01-V07) -----------------------------------------------------------------------

_DRUG, _REACTION = "local:ANVIL|local:HOT", "STANDARD"
_KEYSQL = f"identity_key = '{_DRUG}' and reaction_pt = '{_REACTION}'"
register("v01_search", oracle("select drug_key, drug_label, n_ingredients, n_signals from dim_drug where drug_label ilike '%co%' and n_signals > 0 order by n_ingredients, drug_label, drug_key limit 20"))(lambda s, d: serving.search(warehouse(s, d)["dim_drug"], "co"))
register("v02_lookup", oracle(f"select identity_key, drug_label from dim_drug where drug_key = md5('{_DRUG}')"))(lambda s, d: serving.lookup(warehouse(s, d)["dim_drug"], md5(_DRUG.encode()).hexdigest()))
register("v03_drug_signals", oracle(f"select reaction_pt, a, round(ic025, 6) as ic025, round(pct_lw, 6) as pct_lw, peak_quarter from signals where identity_key = '{_DRUG}' and ic025 > 0 order by signals.ic025 desc, reaction_pt limit 50"))(
    lambda s, d: serving.drug_signals(warehouse(s, d)["signals"], _DRUG).selectExpr("reaction_pt", "a", "round(ic025, 6) as ic025", "round(pct_lw, 6) as pct_lw", "peak_quarter")
)
register("v04_pair_detail", oracle(f"select report_quarter, n_cases, n_cases_nolw from pair_quarters where {_KEYSQL}"))(lambda s, d: serving.pair_detail(warehouse(s, d)["signals"], warehouse(s, d)["pair_quarters"], _DRUG, _REACTION)[1])
_MEASURES = "; ".join(c for c in _SIGNAL.split("; ") if c != "identity_key")
register("v04_pair_measures", oracle(f"select {_MEASURES.replace(';', ',')} from signals where {_KEYSQL}"))(lambda s, d: serving.pair_detail(warehouse(s, d)["signals"], warehouse(s, d)["pair_quarters"], _DRUG, _REACTION)[0].selectExpr(*_MEASURES.split("; ")))


def _rows_as_dicts(spark: SparkSession, d: str) -> DataFrame:
    """The dictionaries of a bounded lookup, as the service hands them out."""
    found = serving.as_dicts(serving.drug_signals(warehouse(spark, d)["signals"], _DRUG))
    return spark.createDataFrame([(r["reaction_pt"], r["a"], len(r)) for r in found], "reaction_pt string, a long, n_fields int")


register("v07_rows_as_dicts", oracle(f"select reaction_pt, a, 8::int as n_fields from signals where identity_key = '{_DRUG}' and ic025 > 0"))(_rows_as_dicts)
register("v05_quarter_series", oracle(f"select q::date as report_quarter, year(q) || ' Q' || quarter(q) as label, coalesce(n_cases, 0) as n, coalesce(n_cases_nolw, 0) as n_nolw, coalesce(n_cases, 0) - coalesce(n_cases_nolw, 0) as n_lw from (select unnest(generate_series(date '1996-01-01', (select max(report_quarter) from pair_quarters), interval 3 month)) as q) left join (select * from pair_quarters where {_KEYSQL}) p on p.report_quarter = q::date"))(
    lambda s, d: _series(warehouse(s, d)["pair_quarters"])
)
register("v06_cases_before", oracle(f"select coalesce(sum(n_cases) filter (where year(report_quarter) < 2004), 0)::bigint as n_before from pair_quarters where {_KEYSQL}"))(lambda s, d: serving.cases_before(warehouse(s, d)["pair_quarters"], _DRUG, _REACTION))


def _series(quarters: DataFrame) -> DataFrame:
    from datetime import date

    return serving.quarter_series(quarters, _DRUG, _REACTION, date(1996, 1, 1))


# --- studies (Z01-Z14) -----------------------------------------------------------------------

for _name, (_make, _sql) in studies.STUDIES.items():
    register(_name, oracle(_sql))(lambda s, d, make=_make: make(warehouse(s, d)))

# --- single operators ------------------------------------------------------------------------

for _name, (_make, _tables, _sql) in relational.QUERIES.items():
    register(_name, _sql)(lambda s, d, make=_make, tables=_tables: make(*(table(s, d, t) for t in tables)))
