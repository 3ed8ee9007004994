"""Queries of the source layer.  Archives, seeds and responses are written from the two fixed-size tables (nations and
regions), so their size doesn't grow; line repair runs over a whole table."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import staging
from ..shared import new_path
from ..sources import extracts

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {}


def _add(name: str, sql: str):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = (f, sql)
        return f

    return add


def _put(spark: SparkSession, path: str, body: bytes) -> str:
    """A small file on whatever file system the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(body))
    out.close()
    return path


def _rows(spark: SparkSession, d: str, name: str, key: str) -> list:
    """The rows of a table of fixed size: 25 nations, 5 regions."""
    return spark.read.parquet(f"{d}/{name}.parquet").orderBy(key).collect()


def _archives(spark: SparkSession, d: str) -> dict[str, str]:
    """Two quarters of two eras: CRLF and LF, two members, glued lines, blank fields, spaces in headers, bytes that aren't UTF-8."""
    nations = _rows(spark, d, "nation", "n_nationkey")
    line = lambda n: f"{n.n_nationkey}${n.n_regionkey}$1${n.n_name}${1990 + n.n_regionkey}".encode()
    old, new = [n for n in nations if n.n_nationkey % 2 == 0], [n for n in nations if n.n_nationkey % 2 == 1]
    head, tail = old[: len(old) // 2], old[len(old) // 2 :]
    blank = [line(n) + (b"$ " if i % 3 == 0 else b"") for i, n in enumerate(head)]
    glued = [b"$".join(line(n) for n in tail[i : i + 2]) for i in range(0, len(tail), 2)]
    folder, out = new_path(spark, "archives"), {}
    contents = {
        "2012q3": {
            "ascii/DEMO12Q3.TXT": b"\r\n".join([b"ISR$CASE$FOLL_SEQ$GNDR_COD$EVENT_DT ", *blank, b""]) + b"\r\n",
            "ascii/demo12q3_b.txt": b"\n".join([b"ISR$CASE$FOLL_SEQ$GNDR_COD$EVENT_DT", *glued]),
            "readme.txt": b"none of the tables",
        },
        "2014q4": {
            "ASCII/DEMO14Q4.txt": b"\n".join([b"primaryid$caseid$sex$lit_ref", *(f"{n.n_nationkey}${n.n_regionkey}${n.n_name}".encode() + (b"$\xff" if i % 2 else b"") for i, n in enumerate(new))]),
            "deleted/DELETE14Q4.txt": b"\n 3 \r\n4\r\n\n3\n",
        },
    }
    for quarter, members in contents.items():
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
            for name, body in members.items():
                z.writestr(name, body)
        out[quarter] = _put(spark, f"{folder}/{quarter.upper()}.zip", packed.getvalue())
    return out


@_add(
    "s03_s06_d02_d04_ingest",
    """select case n_nationkey % 2 when 0 then '2012q3' else '2014q4' end as quarter, n_nationkey::varchar as primaryid, n_regionkey::varchar as caseid, case n_nationkey % 2 when 0 then '1' end as caseversion,
    n_name as sex, case n_nationkey % 2 when 0 then (1990 + n_regionkey)::varchar end as event_dt, case when n_nationkey % 4 = 3 then chr(65533) end as lit_ref from nation""",
)
def _ingest(spark: SparkSession, d: str) -> DataFrame:
    return extracts.read_archives(spark, _archives(spark, d), "demo")


@_add("s07_retractions", "select unnest(['3', '4']) as caseid")
def _retractions(spark: SparkSession, d: str) -> DataFrame:
    return extracts.read_deleted(spark, _archives(spark, d))


@_add(
    "d01_repair",
    """select c_custkey::varchar as id, c_name as a, c_mktsegment as b from customer
    union all select 'g' || c_custkey, c_name, c_mktsegment from customer where c_custkey % 4 = 1 union all select 'h' || c_custkey, c_name, c_mktsegment from customer where c_custkey % 12 = 1""",
)
def _repair(spark: SparkSession, d: str) -> DataFrame:
    """A whole table as lines of three fields: plain, with a blank field more, glued in twos and threes, glued with a rest that is cut."""
    c = spark.read.parquet(f"{d}/customer.parquet")
    name, key = F.array("c_name", "c_mktsegment"), F.col("c_custkey").cast("string")
    glue = lambda mark: F.concat(F.array(F.concat(F.lit(mark), key)), name)
    own, kind = F.concat(F.array(key), name), F.col("c_custkey") % 4
    line = F.when(kind == 0, F.concat(own, F.array(F.lit(" ")))).when(F.col("c_custkey") % 12 == 1, F.concat(own, glue("g"), glue("h"), F.array(F.lit("cut"), F.lit("off"))))
    line = line.when(kind == 1, F.concat(own, glue("g"))).otherwise(own)
    return c.select(F.explode(extracts.repaired(line, 3)).alias("f")).select(F.get("f", F.lit(0)).alias("id"), F.get("f", F.lit(1)).alias("a"), F.get("f", F.lit(2)).alias("b"))


@_add("s09_s15_s17_union_readback", "select count(*) as n, count(s_name)::bigint as named, 2::bigint as writes, (select count(*) from region) as kept from (select c_custkey as k, null as s_name from customer union all select s_suppkey, s_name from supplier)")
def _union_readback(spark: SparkSession, d: str) -> DataFrame:
    """Two tables with different columns are written, counted as read back and united by name; a third write finds its table and leaves it."""
    folder = new_path(spark, "written")
    a = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("k"))
    b = spark.read.parquet(f"{d}/supplier.parquet").select("s_name", F.col("s_suppkey").alias("k"))
    writes = sum(extracts.write_table(df, f"{folder}/{name}") == df.count() for name, df in (("a", a), ("b", b)))
    r = spark.read.parquet(f"{d}/region.parquet")
    extracts.write_table(r, f"{folder}/r")
    kept = extracts.write_table(r.where("r_regionkey = 0"), f"{folder}/r")
    both = extracts.read_union(spark, f"{folder}/a", f"{folder}/b")
    return both.agg(F.count("*").alias("n"), F.count("s_name").alias("named")).select("n", "named", F.lit(writes).cast("long").alias("writes"), F.lit(kept).cast("long").alias("kept"))


@_add("s18_sorted_export", "select s_suppkey, s_name, (select count(*) from supplier) as n from supplier")
def _sorted_export(spark: SparkSession, d: str) -> DataFrame:
    """Exported twice over the same place: the second table stands there, in order inside its files."""
    path = new_path(spark, "export")
    s = spark.read.parquet(f"{d}/supplier.parquet")
    extracts.export_sorted(s.where("s_suppkey < 5"), path, "s_nationkey", "s_suppkey")
    n = extracts.export_sorted(s, path, "s_nationkey", "s_suppkey")
    return spark.read.parquet(path).select("s_suppkey", "s_name", F.lit(n).cast("long").alias("n"))


def _responses(spark: SparkSession, d: str) -> str:
    folder = new_path(spark, "vocabulary")
    nations = _rows(spark, d, "nation", "n_nationkey")
    for r in _rows(spark, d, "region", "r_regionkey"):
        own = [{"rxcui": str(n.n_nationkey), "name": n.n_name, "tty": "IN" if n.n_nationkey % 2 else "PIN"} for n in nations if n.n_regionkey == r.r_regionkey]
        groups = [{"tty": "IN", "conceptProperties": [c for c in own if c["tty"] == "IN"]}, {"tty": "BN"}, {"tty": "PIN", "conceptProperties": [c for c in own if c["tty"] == "PIN"]}]
        key = str(r.r_regionkey)
        _put(spark, f"{folder}/related/{key}.json", json.dumps({"rxcui": key, "response": {"relatedGroup": {"conceptGroup": groups if r.r_regionkey else None}}}, indent=1).encode())
        _put(spark, f"{folder}/properties/{key}.json", json.dumps({"rxcui": key, "response": {"properties": {"rxcui": key, "name": r.r_name, "tty": "IN"}}}).encode())
        found = [c["rxcui"] for c in own] if r.r_regionkey != 1 else None
        _put(spark, f"{folder}/rxcui/{key}.json", json.dumps({"piece": r.r_name, "rxnorm_version": "v1", "response": {"idGroup": {"rxnormId": found} if found else {}}}).encode())
    return folder


@_add("s11_n02_stage_related", "select n_regionkey::varchar as rxcui, n_nationkey::varchar as in_rxcui, n_name as in_name, case n_nationkey % 2 when 1 then 'IN' else 'PIN' end as in_tty from nation where n_regionkey <> 0")
def _related(spark: SparkSession, d: str) -> DataFrame:
    return staging.stage_related(extracts.read_vocabulary(spark, "related", f"{_responses(spark, d)}/related"))


@_add("s11_stage_properties", "select r_regionkey::varchar as rxcui, r_name as rxcui_name, 'IN' as tty from region")
def _properties(spark: SparkSession, d: str) -> DataFrame:
    return staging.stage_properties(extracts.read_vocabulary(spark, "properties", f"{_responses(spark, d)}/properties"))


@_add("s11_stage_rxcui", "select r_name as piece, 'v1' as rxnorm_version, case when r_regionkey <> 1 then n_nationkey::varchar end as rxcui from region join nation on n_regionkey = r_regionkey where r_regionkey <> 1 or n_nationkey = 1")
def _rxcui(spark: SparkSession, d: str) -> DataFrame:
    return staging.stage_rxcui(extracts.read_vocabulary(spark, "rxcui", f"{_responses(spark, d)}/rxcui"))


@_add("s12_seed", "select n_name as piece, 'local:' || n_nationkey as identity, 'local' as identity_source, null::varchar as tty, case n_nationkey % 2 when 0 then 'a, \"b\"' end as family, n_regionkey::varchar as note from nation")
def _seed(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "seed")
    lines = [f'{n.n_name},local:{n.n_nationkey},local,,{chr(34) + "a, " + chr(34) * 2 + "b" + chr(34) * 3 if n.n_nationkey % 2 == 0 else ""},{n.n_regionkey}' for n in _rows(spark, d, "nation", "n_nationkey")]
    return extracts.read_seed(spark, _put(spark, f"{path}/seed.csv", "\n".join([",".join(extracts.SEED_COLUMNS), *lines]).encode()))
