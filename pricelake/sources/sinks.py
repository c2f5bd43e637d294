"""Sinks: Parquet tables written by path, keyed upsert, schema guard, row counts.

There is no transactional table format here, so the rules are: never
overwrite a path in static mode while reading it; replace only the touched
partitions (dynamic partition overwrite); and cut the lineage of anything
read back from the target (a copy in the shared checkpoint folder) before
overwriting the target.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pricelake.session import scratch_path


class SchemaChangeError(ValueError):
    pass


def check_schema(target: StructType, batch: StructType) -> None:
    """Fail when the batch's columns or types differ from the target's
    (``on_schema_change='fail'``); nullability is not compared."""
    t = [(f.name, f.dataType.simpleString()) for f in target.fields]
    b = [(f.name, f.dataType.simpleString()) for f in batch.fields]
    if t != b:
        raise SchemaChangeError(f"schema change: target {t} vs batch {b}")


def _filesystem(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _filesystem(spark, path)
    return bool(fs.exists(p))


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``; None if there is none, or none of its partitions
    holds a file yet."""
    if not table_exists(spark, path):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None


def ensure_table(spark: SparkSession, path: str, schema: StructType,
                 partition_by: Sequence[str] = ()) -> None:
    """Create an empty Parquet table at ``path`` when none is there."""
    if table_exists(spark, path):
        return
    w = spark.createDataFrame([], schema).write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "append",
                partition_by: Sequence[str] = (), sort_within: Sequence[str] = (),
                cluster_partitions: bool = True, guard_empty: bool = True) -> int:
    """Write ``df`` and return the number of rows written (0 = nothing written).

    ``mode``: append | overwrite (whole table) | overwrite_partitions (only
    the partitions present in ``df``). Rows are counted with an observation
    on the write itself, not a second pass. Rows are range-partitioned by
    (partition columns, sort columns) before the write: a date holding a
    third of all rows is split over several tasks by the sampled range
    bounds, small dates share a task, and every task writes few files.

    ``guard_empty`` first asks whether ``df`` has a row (a ``limit 1`` job) so
    an empty batch writes nothing and an empty result never truncates a
    table. On a plan with a shuffle that job runs the map side once more, so
    callers that know the answer (a fresh scratch path, an input already
    checked) pass ``guard_empty=False``.
    """
    if guard_empty and df.isEmpty():
        return 0
    out = df
    if partition_by and cluster_partitions:
        out = out.repartitionByRange(*partition_by, *sort_within)
    if sort_within:
        out = out.sortWithinPartitions(*sort_within)
    # observed above the range exchange, so its sampling job is not counted
    obs = Observation(f"write_{uuid.uuid4().hex[:8]}")
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = out.write
    if mode == "overwrite_partitions":
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:                              # the whole table, whatever the session's partition mode
        w = w.mode(mode).option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return int(obs.get["rows"])


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keyed merge: batch rows replace target rows with the same key, the rest
    of the target stays, new keys are inserted. (Anti join + union.)"""
    keys = list(keys)
    kept = target.join(batch.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def upsert_latest(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                  order: Sequence[str]) -> DataFrame:
    """Keyed merge that keeps the newest version by ``order``, so a re-delivered
    older batch cannot overwrite a newer stored row."""
    from pricelake.operators.dedup import keep_latest
    return keep_latest(target.unionByName(batch.select(*target.columns)), list(keys),
                       list(order)[:1], list(order)[1:])


def staged_copy(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once: written to the shared checkpoint folder and read back."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def within(df: DataFrame, col: str, bounds: Row, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Rows whose ``col`` lies in the literal bounds: prunes partitions at planning."""
    return df.filter((F.col(col) >= F.lit(bounds[lo])) & (F.col(col) <= F.lit(bounds[hi])))


def upsert_table(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
                 partition_col: str = "price_date", schema_guard: bool = True,
                 order: Sequence[str] | None = None) -> int:
    """Upsert ``batch`` into the partitioned Parquet table at ``path``.

    The batch is computed once, into the shared checkpoint folder. Its first and
    last partition value (one small aggregate) bound the target's scan as
    literals, so only partitions in that range are listed, and a semi join
    keeps those it touches. The merged partitions are staged as a copy in the
    same folder (so the overwrite never reads the files it replaces, and a lost
    executor can recompute from the copy), then written back with dynamic
    partition overwrite. Returns rows written. Batch rows replace the target
    rows of their ``keys``; with ``order`` the newest version per key stays.
    """
    batch = staged_copy(spark, batch, "upsert-batch")
    bounds = batch.agg(F.min(partition_col).alias("lo"), F.max(partition_col).alias("hi"),
                       F.count(F.lit(1)).alias("n")).first()
    if not bounds["n"]:
        return 0
    sort = ["asset_id"] if "asset_id" in batch.columns else []
    target = stored(spark, path)
    if target is None:
        return write_table(batch, path, "overwrite", [partition_col], sort, guard_empty=False)
    target = target.select(*batch.columns) if set(target.columns) == set(batch.columns) \
        else target
    if schema_guard:
        check_schema(target.schema, batch.schema)
    touched = batch.select(partition_col).distinct()
    scope = within(target, partition_col, bounds).join(touched, partition_col, "left_semi")
    merged = upsert_latest(scope, batch, keys, order) if order else upsert(scope, batch, keys)
    staged = staged_copy(spark, merged.select(*batch.columns), "upsert")
    return write_table(staged, path, "overwrite_partitions", [partition_col], sort,
                       guard_empty=False)


def replace_series(spark: SparkSession, path: str, rows: DataFrame, series: DataFrame, partition_col: str = "price_date",
                   key: str = "asset_id") -> int:
    """Replace all that the table at ``path`` holds of the keys in ``series`` by ``rows``.

    Only the partitions in which they have or get rows are rewritten (found from two
    columns of the table); one that is left without rows is removed. Returns the
    rows written. Done again after a loss it gives the same table.
    """
    rows = staged_copy(spark, rows, "series-rows")
    target = stored(spark, path)
    if target is None:
        return write_table(rows, path, "overwrite", [partition_col], [key])
    held = target.select(key, partition_col).join(series, key, "left_semi").select(partition_col)
    touched = staged_copy(spark, held.union(rows.select(partition_col)).distinct(), "series-partitions")
    bounds = touched.agg(F.min(partition_col).alias("lo"), F.max(partition_col).alias("hi")).first()
    if bounds["lo"] is None:
        return 0
    others = within(target, partition_col, bounds).join(touched, partition_col, "left_semi").join(series, key, "left_anti")
    merged = staged_copy(spark, others.select(*rows.columns).unionByName(rows), "series")
    n = write_table(merged, path, "overwrite_partitions", [partition_col], [key], guard_empty=False)
    fs, _ = _filesystem(spark, path)
    for r in touched.join(merged.select(partition_col).distinct(), partition_col, "left_anti").collect():      # one row a partition
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{partition_col}={r[0]}"), True)
    return n


def preview(df: DataFrame, order: Sequence[str], n: int = 3) -> DataFrame:
    """First ``n`` rows in an explicit total order (a distributed top-k)."""
    return df.orderBy(*order).limit(n)


def batch_counts(df: DataFrame, key: str = "asset_id") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("price_rows"))
