"""Reading raw extracts (S03-S13, D01, D04) and writing tables."""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .eras import quarter_key, rename_map

DELIMITER = "$"
WIDE_DELIMITER = "\uff04"
# Records whose text holds a delimiter: (quarter, table, first field), and the two fields to join.
EMBEDDED = {("2012Q1", "DEMO", "8129732"): (9, 10)}


class BrokenExtract(ValueError):
    """Raised when line ends are inconsistent."""


def check_line_ends(raw: bytes) -> None:
    """Carriage returns must be absent, or come with every newline."""
    cr, lf, both = raw.count(b"\r"), raw.count(b"\n"), raw.count(b"\r\n")
    if cr and not cr == lf == both:
        raise BrokenExtract(f"bare line ends: {cr} CR, {lf} LF, {both} CRLF")


def members(archive: bytes, table: str) -> list[bytes]:
    """The archive's members that hold ``table``, e.g. DEMO12Q4.TXT in any folder and case."""
    with zipfile.ZipFile(io.BytesIO(archive)) as z:
        return [z.read(n) for n in sorted(z.namelist()) if _holds(table, n)]


def _holds(table: str, member: str) -> bool:
    if table == "deleted":
        return "delet" in member.lower() and member.lower().endswith(".txt")
    return bool(re.search(rf"(^|/){re.escape(table)}\d{{2}}q[1-4][^/]*\.txt$", member, re.IGNORECASE))


LINES_SCHEMA = "path string, member string, header string, line string"
LINES_A_BATCH = 20_000


def _member_lines(table: str, headers_only: bool):
    """A map from (path, content) of archives to the lines of ``table``'s members, streamed; line ends are checked on the way."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as z:
                    for name in sorted(n for n in z.namelist() if _holds(table, n)):
                        with z.open(name) as raw:
                            yield from _lines(path, name, raw, table == "deleted", headers_only)

    return rows


def _lines(path: str, name: str, raw, bare: bool, headers_only: bool) -> Iterator[pa.RecordBatch]:
    as_text = lambda b: b.rstrip(b"\n").removesuffix(b"\r").decode(errors="replace")
    pack = lambda lines: pa.RecordBatch.from_arrays([pa.array([v] * len(lines), pa.string()) for v in (path, name, header)] + [pa.array(lines, pa.string())], names=["path", "member", "header", "line"])
    header, held, cr, lf, both = None if bare else as_text(raw.readline()), [], 0, 0, 0
    if headers_only:
        yield pack([""])
        return
    for line in raw:
        cr, lf, both = cr + line.count(b"\r"), lf + line.endswith(b"\n"), both + line.endswith(b"\r\n")
        held.append(as_text(line))
        if len(held) == LINES_A_BATCH:
            yield pack(held)
            held = []
    if cr and not bare and not cr == lf == both:
        raise BrokenExtract(f"{path} {name}: bare line ends: {cr} CR, {lf} LF, {both} CRLF")
    if held:
        yield pack(held)


def archive_lines(spark: SparkSession, paths: list[str], table: str, headers_only: bool = False) -> DataFrame:
    """(path, member, header, line) of ``table``'s members in zip archives; a task reads one archive at a time.

    Bytes that aren't UTF-8 become U+FFFD.  The member ``deleted`` is the list of retractions, without a header."""
    archives = spark.read.format("binaryFile").load(paths).select("path", "content")
    return archives.mapInArrow(_member_lines(table, headers_only), LINES_SCHEMA)


def _quarter_of(archives: dict[str, str]) -> Column:
    """The quarter of a row's ``path``: the key of the archive whose path ends alike."""
    name = lambda path: path.rstrip("/").rsplit("/", 1)[-1]
    if len({name(p) for p in archives.values()}) < len(archives):
        raise ValueError("archives need names of their own")
    known = F.create_map(*(F.lit(x) for quarter, path in archives.items() for x in (name(path), quarter.lower())))
    return F.element_at(known, F.element_at(F.split("path", "/"), -1))


def read_archives(spark: SparkSession, archives: dict[str, str], table: str) -> DataFrame:
    """One canonical table from the archives of many quarters ({quarter: path}), every column a string.

    Members may differ in header and era: each line's fields go to the canonical names of its own header.  Only the
    distinct headers reach the driver.  A column that a quarter lacks is null there; ``quarter`` is added."""
    for quarter in archives:
        quarter_key(quarter)
    paths, quarter = list(archives.values()), _quarter_of(archives)
    heads = archive_lines(spark, paths, table, headers_only=True).select(quarter.alias("quarter"), "header").distinct().collect()
    if not heads:
        raise BrokenExtract(f"no member of any archive holds {table}")
    names = {(r.quarter, r.header): [rename_map(table, r.quarter).get(h.strip().lower(), h.strip().lower()) for h in r.header.split(DELIMITER)] for r in heads}
    key = F.concat_ws("\n", "quarter", "header")
    by_key = lambda values: F.element_at(F.create_map(*(F.lit(x) for k, v in values.items() for x in ("\n".join(k), v))), key)
    columns = list(dict.fromkeys(c for found in names.values() for c in found))
    lines = archive_lines(spark, paths, table).withColumn("quarter", quarter).where("line <> ''")
    fixes = [((F.col("quarter") == q.lower()), first, at) for (q, t, first), at in EMBEDDED.items() if t == table.upper()]
    rows = lines.withColumn("f", F.explode(repaired(F.split("line", r"\$", -1), by_key({k: len(v) for k, v in names.items()}), fixes)))
    place = lambda c: by_key({k: v.index(c) if c in v else -1 for k, v in names.items()})
    field = lambda c: F.when(place(c) >= 0, F.nullif(F.get("f", F.greatest(place(c), F.lit(0))), F.lit("")))
    return rows.select("quarter", *(field(c).alias(c) for c in columns))


def read_deleted(spark: SparkSession, archives: dict[str, str]) -> DataFrame:
    """The distinct retracted case ids of all archives."""
    return _case_ids(archive_lines(spark, list(archives.values()), "deleted").select("line"))


def _case_ids(lines: DataFrame) -> DataFrame:
    return lines.select(F.regexp_replace("line", r"^\s+|\s+$", "").alias("caseid")).where("caseid <> ''").distinct()


def repaired(fields: Column, width: int | Column, fixes: list[tuple[Column, str, tuple[int, int]]] = ()) -> Column:
    """The records of a split line: itself, glued records parted, or an embedded delimiter restored.

    A line with one extra blank field stays; one of two headers' width or more is parted after each header's
    width, what is left over staying with the last record; a known record, (condition, first field, places), gets two
    fields rejoined; all others raise."""
    size = F.size(fields)
    w = F.lit(width) if isinstance(width, int) else width
    whole = F.floor(size / w).cast("int")
    parts = F.transform(F.sequence(F.lit(0), whole - 1), lambda i: F.slice(fields, i * w + 1, F.when(i == whole - 1, size).otherwise(w)))
    out = F.when(size <= w, F.array(fields)).when((size == w + 1) & (F.trim(F.element_at(fields, -1)) == ""), F.array(fields))
    out = out.when(whole >= 2, parts)
    for here, first, (i, j) in fixes:
        joined = F.concat(F.get(fields, F.lit(i)), F.lit(WIDE_DELIMITER), F.get(fields, F.lit(j)))
        fixed = F.concat(F.slice(fields, 1, i), F.array(joined), F.slice(fields, i + 2, j - i - 1), F.slice(fields, F.lit(j + 2), F.greatest(size - j - 1, F.lit(0))))
        out = out.when(here & (F.get(fields, F.lit(0)) == first), F.array(fixed))
    line = F.array_join(fields, DELIMITER)
    return out.otherwise(F.raise_error(F.concat(F.lit("no repair for line: "), line)).cast("array<array<string>>"))


def read_delimited(spark: SparkSession, path: str, header: list[str], table: str = "", quarter: str = "") -> DataFrame:
    """An unpacked ``$``-delimited text with repaired lines; every column a string, short lines filled with null."""
    names = [h.strip() for h in header]
    fixes = [(F.lit(True), first, at) for (q, t, first), at in EMBEDDED.items() if (q, t) == (quarter.upper(), table.upper())]
    lines = spark.read.text(path, lineSep="\n").select(F.regexp_replace("value", r"\r$", "").alias("line"))
    lines = lines.where((F.col("line") != "") & (F.col("line") != DELIMITER.join(header)))
    records = lines.select(F.explode(repaired(F.split("line", r"\$", -1), len(names), fixes)).alias("f"))
    return records.select(*(F.nullif(F.get("f", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)))


def read_retractions(spark: SparkSession, *paths: str) -> DataFrame:
    """The distinct case ids of unpacked retraction lists; blank lines don't count."""
    return _case_ids(spark.read.text(list(paths), lineSep="\n").withColumnRenamed("value", "line"))


def read_union(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files joined by column name, absent columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (spark.read.parquet(p) for p in paths))


_CONCEPT = T.StructType([T.StructField(c, T.StringType()) for c in ("rxcui", "name", "tty")])
VOCABULARY = {
    "rxcui": T.StructType().add("piece", "string").add("rxnorm_version", "string").add("response", T.StructType().add("idGroup", T.StructType().add("rxnormId", T.ArrayType(T.StringType())))),
    "properties": T.StructType().add("rxcui", "string").add("response", T.StructType().add("properties", _CONCEPT)),
    "related": T.StructType().add("rxcui", "string").add(
        "response", T.StructType().add("relatedGroup", T.StructType().add("conceptGroup", T.ArrayType(T.StructType().add("conceptProperties", T.ArrayType(_CONCEPT)))))
    ),
}
SEED_COLUMNS = ("piece", "identity", "identity_source", "tty", "family", "note")


def read_vocabulary(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """A folder of vocabulary responses, one JSON document a file, under a declared schema."""
    return spark.read.schema(VOCABULARY[kind]).option("multiLine", True).option("pathGlobFilter", "*.json").json(path)


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """The seed map; every column a string, empty ones null."""
    return spark.read.schema(", ".join(f"{c} string" for c in SEED_COLUMNS)).csv(path, header=True, escape='"')


def location(root: str, name: str, remote_root: str | None = None) -> str:
    """A table's place under the local root, or under the object store's (e.g. s3a://bucket)."""
    return f"{(remote_root or root).rstrip('/')}/{name}.parquet"


def object_store_options(endpoint: str, key: str, secret: str) -> dict[str, str]:
    """Hadoop settings for an S3-compatible store; interface only, untested here without a network."""
    return {"fs.s3a.endpoint": endpoint, "fs.s3a.access.key": key, "fs.s3a.secret.key": secret, "fs.s3a.path.style.access": "true"}


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def write_table(df: DataFrame, path: str, replace: bool = False) -> int:
    """Zstd Parquet, skipped if it exists; returns the rows read back, which must be the rows written.

    The rows are counted while they are written; the read-back comes from the files' footers."""
    spark = df.sparkSession
    if replace or not _exists(spark, path):
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
        counted.write.mode("overwrite" if replace else "errorifexists").option("compression", "zstd").parquet(path)
        found = spark.read.parquet(path).count()
        if found != seen.get["n"]:
            raise RuntimeError(f"{path}: {found} rows read back, {seen.get['n']} written")
        return found
    return spark.read.parquet(path).count()


def export_sorted(df: DataFrame, path: str, *keys: str) -> int:
    """A table clustered by its lookup keys, written beside its place, counted, then moved there.

    The table in place is moved aside first and deleted last: after a crash it is found under its own name or as ``.old``."""
    spark = df.sparkSession
    path = path.rstrip("/")
    partial, old = f"{path}.part-{uuid.uuid4().hex}", f"{path}.old"
    rows = write_table(df.repartitionByRange(*keys).sortWithinPartitions(*keys), partial, replace=True)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    files = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(fs_path(path)):
        files.delete(fs_path(old), True)
        files.rename(fs_path(path), fs_path(old))
    if not files.rename(fs_path(partial), fs_path(path)):
        raise RuntimeError(f"{partial} could not be moved to {path}")
    files.delete(fs_path(old), True)
    return rows
