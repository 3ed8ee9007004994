"""Typed staging of the canonical tables and the vocabulary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_name, partial_date

DECIMAL = "decimal(18,3)"


def _has(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _int(c: Column) -> Column:
    return c.try_cast("int")


def stage_demo(raw: DataFrame) -> DataFrame:
    text = lambda c: _has(raw, c).alias(c)
    return raw.select(
        "primaryid", "caseid",
        F.coalesce(_has(raw, "caseversion").try_cast("int"), F.lit(0)).alias("caseversion"),
        text("i_f_code"),
        *(partial_date(_has(raw, c)).alias(c) for c in ("event_dt", "fda_dt", "init_fda_dt", "death_dt")),
        _has(raw, "age").try_cast(DECIMAL).alias("age"), text("age_cod"), text("age_grp"), text("sex"),
        _has(raw, "wt").try_cast(DECIMAL).alias("wt"),
        *(text(c) for c in ("wt_cod", "rept_cod", "occp_cod", "reporter_country", "occr_country", "mfr_sndr")),
    )


def stage_drug(raw: DataFrame) -> DataFrame:
    text = lambda c: _has(raw, c).alias(c)
    name = F.upper(F.trim(_has(raw, "drugname")))
    return raw.select(
        "primaryid", text("caseid"), _int(_has(raw, "drug_seq")).alias("drug_seq"), text("role_cod"),
        name.alias("drugname"), clean_name(name).alias("drugname_clean"), text("route"),
        _has(raw, "dose_amt").try_cast("double").alias("dose_amt"),
        *(text(c) for c in ("dose_unit", "dose_form", "dose_freq")),
        F.nullif(F.upper(F.trim(_has(raw, "prod_ai"))), F.lit("")).alias("prod_ai"), text("nda_num"),
        F.coalesce(_has(raw, "lot_num"), _has(raw, "lot_nbr")).alias("lot_number"), text("dechal"), text("rechal"),
        partial_date(_has(raw, "exp_dt")).alias("exp_dt"),
    )


def stage_reac(raw: DataFrame) -> DataFrame:
    return raw.select("primaryid", "caseid", F.col("pt").alias("reaction_pt"))


def stage_outc(raw: DataFrame) -> DataFrame:
    return raw.select("primaryid", "caseid", F.coalesce(_has(raw, "outc_cod"), _has(raw, "outc_code")).alias("outcome_code"))


def stage_indi(raw: DataFrame) -> DataFrame:
    return raw.select("primaryid", "caseid", _int(F.col("indi_drug_seq")).alias("indi_drug_seq"), "indi_pt")


def stage_rpsr(raw: DataFrame) -> DataFrame:
    return raw.select("primaryid", "caseid", "rpsr_cod")


def stage_ther(raw: DataFrame) -> DataFrame:
    return raw.select(
        "primaryid", "caseid", _int(F.col("dsg_drug_seq")).alias("dsg_drug_seq"),
        partial_date(F.col("start_dt")).alias("start_dt"), partial_date(F.col("end_dt")).alias("end_dt"),
        F.col("dur").try_cast(DECIMAL).alias("dur"), "dur_cod",
    )


def stage_rxcui(raw: DataFrame) -> DataFrame:
    """(piece, rxnorm_version, rxcui): one row a match, one with a null rxcui for a piece without."""
    return raw.select("piece", "rxnorm_version", F.explode_outer("response.idGroup.rxnormId").alias("rxcui"))


def stage_properties(raw: DataFrame) -> DataFrame:
    found = F.col("response.properties")
    return raw.select(found["rxcui"].alias("rxcui"), found["name"].alias("rxcui_name"), found["tty"].alias("tty"))


def stage_related(raw: DataFrame) -> DataFrame:
    groups = raw.select("rxcui", F.explode("response.relatedGroup.conceptGroup").alias("g"))
    concepts = groups.select("rxcui", F.explode("g.conceptProperties").alias("c"))
    return concepts.select("rxcui", F.col("c.rxcui").alias("in_rxcui"), F.col("c.name").alias("in_name"), F.col("c.tty").alias("in_tty"))
