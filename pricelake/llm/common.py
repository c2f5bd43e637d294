"""Helpers shared by the operators: reading tables, staging, size-checked joins."""

from __future__ import annotations

import ctypes
import ctypes.util
import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import pricelake
from pricelake.session import scratch_path

#: A staged side of a join is broadcast only up to this many bytes (rows x row width).
BROADCAST_BYTES = 16 << 20

#: White space of the word and copy definitions, as a Java/Python regex class body.
WHITE = r"\x20\x09-\x0D"


_BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, and bound
    the rows a worker holds at once unless the session sets them."""
    if spark.conf.get(_BATCH) == "10000":        # Spark's default: texts are long, so take fewer at once
        spark.conf.set(_BATCH, BATCH_ROWS)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = os.path.dirname(os.path.abspath(pricelake.__file__))
    if not os.path.isdir(root):          # already imported from a shipped archive
        return
    path = os.path.join(tempfile.mkdtemp(), "pricelake.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage with files every executor can read, so a lost executor
    never loses intermediate rows, and computes ``df`` once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_staged(left: DataFrame, staged: DataFrame, on, how: str = "left",
                row_bytes: int = 64, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join with a staged table: broadcast while its counted size is within
    ``limit``, else a shuffle join (AQE splits its skewed partitions)."""
    if staged.count() * row_bytes <= limit:
        return left.join(F.broadcast(staged), on, how)
    return left.join(staged.hint("merge"), on, how)


def released(fn):
    """``fn`` over a task's batches, then its memory handed back to the system:
    Spark keeps idle workers, and an allocator keeps what they once used."""
    def run(batches):
        yield from fn(batches)
        pa.default_memory_pool().release_unused()
        libc = ctypes.util.find_library("c")
        if libc and hasattr(trim := ctypes.CDLL(libc), "malloc_trim"):
            trim.malloc_trim(0)
    return run


#: Stands for a null id in joins.
NO_ID = -(1 << 63)


def row_key(id_col: str, text_col: str) -> Column:
    """A row's own key: the SHA-256 of its id (none: empty) and its text (null: empty)."""
    part = [F.coalesce(F.col(f"`{id_col}`").cast("long").cast("string"), F.lit("")), F.lit(":"),
            F.coalesce(F.col(f"`{text_col}`"), F.lit(""))]
    return F.unhex(F.sha2(F.concat(*part), 256))


def any_row() -> Column:
    """One of a group's packed rows, always the same: the least as text."""
    return F.min_by("row", F.col("row").cast("string")).alias("row")


def without(docs: DataFrame, id_col: str, text_col: str, lost: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``row_key`` is among the staged keys
    ``lost.key``; of the rows of a key with ``once`` one stays. Packed rows
    cannot clash with any name."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key(id_col, text_col).alias("key"))
    met = join_staged(rows, lost.select("key", "once"), "key", "left", row_bytes=64)
    kept = met.filter(F.col("once").isNull()).select("row")
    if not lost.filter("once").isEmpty():
        kept = kept.unionByName(met.filter("once").groupBy("key").agg(any_row()).select("row"))
    return kept.select("row.*")


def key_bitmap(keys: DataFrame, col: str, width: int) -> np.ndarray:
    """One bit for each value of the top ``width`` bits of the hashes in ``col``:
    ``2 ** (width - 3)`` bytes, whatever the number of rows."""
    rows = keys.selectExpr(f"shiftrightunsigned(`{col}`, {64 - width}) AS place") \
        .groupBy(F.expr("cast(shiftright(place, 6) AS int)").alias("at")) \
        .agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 AS int)))").alias("b")).toArrow()
    bits = np.zeros(1 << (width - 6), dtype=np.int64)
    bits[rows.column("at").to_numpy()] = rows.column("b").to_numpy()
    return bits.view(np.uint8)               # little-endian: byte k holds places 8k to 8k + 7


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes have their bit set (all of a set's, few others)."""
    place = hashes.view(np.uint64) >> np.uint64(61 - (len(bits).bit_length() - 1))
    return ((bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def sorted_groups(batches):
    """(table, bounds) of whole runs of equal first column, from sorted batches.

    Only the last, unfinished run is carried from batch to batch.
    """
    tail = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if tail is None else pa.concat_tables([tail, t]).combine_chunks()
        if not len(t):
            continue
        key = t.column(0).to_numpy()
        cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
        if len(cuts):
            yield t.slice(0, cuts[-1]).combine_chunks(), np.concatenate([[0], cuts])
            t = t.slice(cuts[-1])
        tail = t
    if tail is not None and len(tail):
        yield tail.combine_chunks(), np.array([0, len(tail)])
