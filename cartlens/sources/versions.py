"""A set of tables that is replaced as a whole.

Every write goes to a new folder; when all its tables are complete, a manifest of
a few bytes is swapped in by one atomic rename. Readers resolve the manifest
first, so they see the old set or the new one, never a mixture, and a write that
fails midway leaves the old set as it was.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

MANIFEST = "_current"


class NoTables(LookupError):
    """There is no complete set of tables in the folder."""


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current(spark: SparkSession, folder: str) -> dict:
    """The manifest: ``version`` and ``tables``."""
    jvm, at, fs = _files(spark, f"{folder}/{MANIFEST}")
    if not fs.exists(at):
        raise NoTables(folder)
    stream = fs.open(at)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def write_set(tables: dict[str, DataFrame], folder: str) -> str:
    """Write all tables as a new version and make it the current one; returns the version."""
    spark = next(iter(tables.values())).sparkSession
    version = f"v-{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{version}/{name}")
    jvm, new, fs = _files(spark, f"{folder}/{version}/{MANIFEST}")
    stream = fs.create(new)
    try:
        stream.write(bytearray(json.dumps({"version": version, "tables": sorted(tables)}).encode()))
    finally:
        stream.close()
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(f"{folder}/{MANIFEST}")
    rename = getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(new, target, how)
    return version


def read_set(spark: SparkSession, folder: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """Tables of the current version (all of them, or ``names``); all come from one version."""
    now = current(spark, folder)
    missing = set(names or []) - set(now["tables"])
    if missing:
        raise NoTables(f"{folder}: no {', '.join(sorted(missing))}")
    return {n: spark.read.parquet(f"{folder}/{now['version']}/{n}") for n in names or now["tables"]}


def drop_old(spark: SparkSession, folder: str) -> int:
    """Remove the folders of all versions but the current one (no reader may still use them); returns how many."""
    keep = current(spark, folder)["version"]
    _, at, fs = _files(spark, folder)
    old = [s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith("v-") and s.getPath().getName() != keep]
    return sum(fs.delete(p, True) for p in old)
