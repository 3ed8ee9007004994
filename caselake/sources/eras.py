"""Quarters, and the canonical column names of each era of extracts."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame

TABLES = ("demo", "drug", "reac", "indi", "outc", "rpsr", "ther")
FIRST_YEAR = 2004
_QUARTER = re.compile(r"\d{4}q[1-4]", re.IGNORECASE)

# Old names and canonical names, with the quarter from which the old name is gone.
RENAMES = {
    "demo": [("isr", "primaryid", (2012, 4)), ("case", "caseid", (2012, 4)), ("foll_seq", "caseversion", (2012, 4)), ("i_f_cod", "i_f_code", (2012, 4)), ("gndr_cod", "sex", (2014, 3))],
    "drug": [("isr", "primaryid", (2012, 4))],
    "indi": [("isr", "primaryid", (2012, 4)), ("drug_seq", "indi_drug_seq", (2012, 4))],
    "outc": [("isr", "primaryid", (2012, 4))],
    "reac": [("isr", "primaryid", (2012, 4))],
    "rpsr": [("isr", "primaryid", (2012, 4))],
    "ther": [("isr", "primaryid", (2012, 4)), ("drug_seq", "dsg_drug_seq", (2012, 4))],
}
# Names of one odd quarter.
ODD = {(2012, 4): {"drug": [("lot_nbr", "lot_num")], "outc": [("outc_code", "outc_cod")]}}


def quarter_key(quarter: str) -> tuple[int, int]:
    if not _QUARTER.fullmatch(quarter):
        raise ValueError(f"not a quarter: {quarter!r}")
    return int(quarter[:4]), int(quarter[-1])


def quarters(until: date | None = None) -> list[str]:
    """Every quarter from the first year to the end of the current (or given) year."""
    last = (until or date.today()).year
    return [f"{y}q{q}" for y in range(FIRST_YEAR, last + 1) for q in range(1, 5)]


def archive_name(quarter: str) -> str:
    """The published archive's name: an older prefix up to the third quarter of 2012."""
    prefix = "aers" if quarter_key(quarter) <= (2012, 3) else "faers"
    return f"{prefix}_ascii_{quarter.lower()}.zip"


def rename_map(table: str, quarter: str) -> dict[str, str]:
    """Lower-cased raw name to canonical name."""
    at = quarter_key(quarter)
    names = {old: new for old, new, until in RENAMES.get(table, []) if at < until}
    return names | dict(ODD.get(at, {}).get(table, []))


def canonical(df: DataFrame, table: str, quarter: str) -> DataFrame:
    """``df`` under canonical names; all other names lower-cased."""
    names = rename_map(table, quarter)
    return df.toDF(*(names.get(c.strip().lower(), c.strip().lower()) for c in df.columns))
