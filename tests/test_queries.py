"""Registered queries against their SQL twins in DuckDB, on the smallest tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__
from caselake.plans import catalogue

CHEAP = [n for n in catalogue.ORACLE_SQL if not n.startswith(("z", "q", "v"))]


def norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return "nan" if isinstance(v, float) and math.isnan(v) else v


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in os.listdir(sf_dir):
        con.execute(f"create view {t.split('.')[0]} as select * from '{sf_dir}/{t}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = catalogue.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = duck.execute(catalogue.ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert columns == sorted(names)
    assert got == sorted((tuple(norm(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=repr)


def test_entry_runs(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_validation_gate(spark, sf_dir):
    rows = {r.check: r for r in catalogue.QUERIES["d06_validate"](spark, sf_dir).collect()}
    assert all(rows[c].passed for c in ("one_row_per_primaryid", "one_row_per_caseid", "every_case_survives", "max_caseversion_kept", "no_deleted_cases"))
