"""Tables written to the folder that driver and executors share: they cut lineage and are read many times."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: list[str] = []
_SCOPES: list[list[DataFrame]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by the session; a temporary one only where driver and executors are one process.

    On a cluster a machine's own folder would hold a part of each table only, so a session without a named folder is refused."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get().rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _LOCAL_DIRS:
        _LOCAL_DIRS.append(tempfile.mkdtemp(prefix="caselake-"))
        atexit.register(shutil.rmtree, _LOCAL_DIRS[0], ignore_errors=True)
    return _LOCAL_DIRS[0]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/caselake/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, lost executors lose nothing."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._staged_path = path
    if _SCOPES:
        _SCOPES[-1].append(back)
    return back


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def is_staged(table: DataFrame) -> bool:
    """Does the table's folder still exist?"""
    files, target = _files(table.sparkSession, table._staged_path)
    return files.exists(target)


def drop_staged(*tables: DataFrame | None) -> None:
    """Delete staged tables that no later plan reads."""
    for table in tables:
        path = getattr(table, "_staged_path", None)
        if path:
            files, target = _files(table.sparkSession, path)
            files.delete(target, True)


def release(spark: SparkSession) -> None:
    """Delete everything that this application has staged; results that read it can't be computed any more."""
    files, target = _files(spark, f"{shared_dir(spark)}/caselake/{spark.sparkContext.applicationId}")
    files.delete(target, True)


class scope:
    """``with scope() as tables``: what is staged inside goes at the end, but for what ``tables.keep`` names."""

    def __enter__(self) -> scope:
        self.kept: list[DataFrame] = []
        _SCOPES.append([])
        return self

    def keep(self, *tables: DataFrame) -> None:
        """Leave these staged tables to the enclosing scope, or to the end of the application."""
        self.kept += tables

    def __exit__(self, *_) -> None:
        kept = {t._staged_path for t in self.kept}
        inside = _SCOPES.pop()
        drop_staged(*(t for t in inside if t._staged_path not in kept))
        if _SCOPES:
            _SCOPES[-1].extend(t for t in inside if t._staged_path in kept)
