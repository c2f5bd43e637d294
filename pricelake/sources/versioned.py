"""Keyed Parquet tables in versions: new directories first, a pointer last.

    <path>/data/v=<name>/<column>=<value>/...   partitions, each written once
    <path>/manifest/<name>                      which directory holds each partition
    <path>/current/<n>                          the pointer, holding a name: the highest n is the table

A version writes only the partitions it touches, into a directory of its own, then
the list of all partitions, then its pointer. The pointer is a file that only one
writer can create, so a version is there whole or not at all: a job that is lost
before that leaves the old version as it was, and a reader keeps the version it
began with. Nothing that is read is ever overwritten. ``vacuum`` removes what no
kept version names. Partition columns are dates or integers.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pricelake.sources import sinks


class VersionConflict(RuntimeError):
    """Another writer has switched the table to the same version first."""


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = sinks._filesystem(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def _pointers(spark: SparkSession, path: str) -> dict[int, str]:
    """Every pointer taken so far; one whose writer was lost in between is empty."""
    out = {}
    for n in sorted(int(n) for n in _names(spark, f"{path}/current") if n.isdigit()):
        fs, p = sinks._filesystem(spark, f"{path}/current/{n}")
        stream = fs.open(p)
        out[n] = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
    return out


def versions(spark: SparkSession, path: str) -> dict[int, str]:
    """The versions that were switched to, oldest first: number and name."""
    return {n: name for n, name in _pointers(spark, path).items() if name}


def _manifest(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema("part string, v string").parquet(f"{path}/manifest/{name}")


def read(spark: SparkSession, path: str, partition_col: str, schema: StructType | None = None,
         version: int | None = None, parts: Sequence[str] | None = None) -> DataFrame | None:
    """The table at its newest (or a given) version; None where there is none.

    ``parts`` limits it to those partitions: no other directory is listed.
    """
    known = versions(spark, path)
    if not known:
        return None
    held = _manifest(spark, path, known[max(known) if version is None else version])
    if parts is not None:
        held = held.filter(F.col("part").isin(list(parts)))
    dirs = [f"{path}/data/v={r['v']}/{partition_col}={r['part']}" for r in held.collect()]      # one row a partition
    if not dirs:
        return None if schema is None else spark.createDataFrame([], schema)
    r = spark.read.option("basePath", f"{path}/data")
    if schema is None:
        return r.parquet(*dirs).drop("v")
    stored = StructType([f for f in schema.fields if f.name != partition_col] + [schema[partition_col]])
    return r.schema(stored).parquet(*dirs).select(*schema.names)


def _part_text(partition_col: str):
    return F.coalesce(F.col(partition_col).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")).alias("part")


def replace_partitions(spark: SparkSession, path: str, rows: DataFrame, partition_col: str,
                       sort_within: Sequence[str] = (), emptied: Sequence[str] = ()) -> int:
    """A new version in which the partitions of ``rows`` hold ``rows``, those of
    ``emptied`` that have none are gone, and all others are as before. Returns the
    rows written."""
    known = versions(spark, path)
    number = max(_pointers(spark, path), default=0) + 1
    name = f"{number}-{uuid.uuid4().hex[:8]}"            # a lost attempt's directory is never written again
    n = sinks.write_table(rows, f"{path}/data/v={name}", "overwrite", [partition_col], sort_within, guard_empty=False)
    new = [d.split("=", 1)[1] for d in _names(spark, f"{path}/data/v={name}") if d.startswith(f"{partition_col}=")]
    manifest = spark.createDataFrame([(d, name) for d in new], "part string, v string")
    if known:
        manifest = _manifest(spark, path, known[max(known)]).filter(~F.col("part").isin([*new, *emptied])).unionByName(manifest)
    manifest.coalesce(1).write.parquet(f"{path}/manifest/{name}")        # one short row a partition
    switch(spark, path, number, name)
    return n


def switch(spark: SparkSession, path: str, number: int, name: str) -> None:
    """Make the version ``name`` the table; fails if another writer took the number."""
    fs, p = sinks._filesystem(spark, f"{path}/current/{number}")
    try:
        out = fs.create(p, False)
    except Exception as e:
        raise VersionConflict(f"{path}: version {number} is taken") from e
    out.write(name.encode())
    out.close()


def upsert(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], partition_col: str,
           order: Sequence[str] | None = None, sort_within: Sequence[str] = ()) -> int:
    """A new version with ``batch`` merged in by ``keys``; returns the rows written.

    Batch rows replace stored rows of their key; with ``order`` the newest of both
    stays. The batch is computed once, into the shared checkpoint folder; only the
    partitions it touches are listed, read and written, each once.
    """
    batch = sinks.staged_copy(spark, batch, "version-batch")
    touched = [r["part"] for r in batch.select(_part_text(partition_col)).distinct().collect()]
    if not touched:
        return 0
    target = read(spark, path, partition_col, batch.schema, parts=touched)
    merged = batch
    if target is not None:
        merged = sinks.upsert_latest(target, batch, keys, order) if order else sinks.upsert(target, batch, keys)
    return replace_partitions(spark, path, merged, partition_col, sort_within)


def drop(spark: SparkSession, path: str) -> None:
    """Forget the table: its pointers go, first of all, then its files."""
    for sub in ("current", "manifest", "data"):
        fs, p = sinks._filesystem(spark, f"{path}/{sub}")
        fs.delete(p, True)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove the partition directories that none of the last ``keep`` versions
    names, and older manifests and pointers; returns the directories removed. Not
    while a writer is at work: its directories are not named yet."""
    known = versions(spark, path)
    kept, old = list(known)[-keep:], list(known)[:-keep]
    named = {(r["v"], r["part"]) for n in kept for r in _manifest(spark, path, known[n]).collect()}      # one row a partition
    gone = []
    for v in (d for d in _names(spark, f"{path}/data") if d.startswith("v=")):
        parts = [d for d in _names(spark, f"{path}/data/{v}") if "=" in d]
        free = [d for d in parts if (v[2:], d.split("=", 1)[1]) not in named]
        gone += [f"{v}/{d}" for d in free] if len(free) < len(parts) else [v]
    manifests = [m for m in _names(spark, f"{path}/manifest") if m not in {known[n] for n in kept}]
    for sub in [*(f"current/{n}" for n in old), *(f"manifest/{m}" for m in manifests), *(f"data/{d}" for d in gone)]:
        fs, p = sinks._filesystem(spark, f"{path}/{sub}")
        fs.delete(p, True)
    return gone
