"""Exact deduplication by two-pass Bloom filtering.

Pass 1 folds every row's digest into a blocked counting filter (two bits a
slot: seen, seen again): each task turns its digests into sorted slot lists,
one shuffle brings the lists of a block together, and only the *seen again*
bits stay. Pass 2 tests every row against these bits where it lies: a row with
any clear bit has no copy and passes straight through; only the others, the
copies and a few false positives, shuffle by digest and are grouped exactly.

The filter is broadcast. Its size follows the row count (``SLOTS_PER_ROW`` bits
a row) up to ``MAX_FILTER_BYTES``; beyond that the share of false positives
rises, so more rows take the shuffle, and the result stays exact.

Defined cases: a null text counts as empty, so empty and null texts are copies
of each other; a null ``doc_id`` never becomes ``keep_id`` unless the whole
group has none; rows repeating one ``doc_id`` and text are one group, and
``drop_copies`` keeps one of them, the least as text where other columns differ;
very long texts are digested whole; packed rows keep columns with clashing names
apart; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import WHITE, any_row, join_staged, released, stage

SLOTS_PER_ROW = 10
MAX_FILTER_BYTES = 128 << 20
BLOCK_SLOTS = 1 << 16
PROBES = 3
#: Slots a task holds before it hands on its lists (32 MB).
HELD_CODES = 4 << 20


def normal_text(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{WHITE}]+", " ")


def text_digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the normalised text in UTF-8."""
    return F.sha2(F.encode(normal_text(text), "UTF-8"), 256)


def _blocks(rows: int) -> int:
    most = MAX_FILTER_BYTES * 8 // BLOCK_SLOTS
    return max(1, min(most, -(-rows * SLOTS_PER_ROW // BLOCK_SLOTS)))


def _probe(sha: Column, k: int) -> Column:
    """Slot ``k`` of a digest within its block: four hex digits of the digest."""
    return F.conv(F.substring(sha, 17 + 4 * k, 4), 16, 10).cast("int")


def _block(sha: Column, blocks: int) -> Column:
    return F.pmod(F.conv(F.substring(sha, 1, 12), 16, 10).cast("long"), F.lit(blocks)).cast("int")


def _slot_lists(batches):
    """Per task and block: the slots seen once, and those seen again."""
    held, size = [], 0
    for b in batches:
        block = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64) << 16
        for k in range(PROBES):
            held.append(block | b.column(1 + k).to_numpy(zero_copy_only=False))
        size += len(block) * PROBES
        if size >= HELD_CODES:
            yield _packed(held)
            held, size = [], 0
    if size:
        yield _packed(held)


def _packed(held):
    codes, n = np.unique(np.concatenate(held), return_counts=True)
    block, slot = codes >> 16, (codes & 0xFFFF).astype("<u2")
    cuts = np.flatnonzero(np.diff(block)) + 1
    parts = list(zip(np.split(slot, cuts), np.split(n, cuts), strict=True))
    return pa.RecordBatch.from_pydict({
        "block": pa.array(block[np.concatenate([[0], cuts])], pa.int32()),
        "once": pa.array([s[c == 1].tobytes() for s, c in parts], pa.binary()),
        "again": pa.array([s[c > 1].tobytes() for s, c in parts], pa.binary())})


def _repeat_bits(key, lists):
    """The seen-again bits of one block, from the lists of all tasks."""
    count = np.zeros(BLOCK_SLOTS, np.uint8)
    for once, again in zip(lists.column("once"), lists.column("again"), strict=True):
        s = np.frombuffer(once.as_py(), "<u2")
        count[s] = np.minimum(2, count[s] + 1)
        count[np.frombuffer(again.as_py(), "<u2")] = 2
    words = np.packbits(count == 2, bitorder="little").view("<i8")
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()),
                     "bits": pa.array([words], pa.list_(pa.int64()))})


def repeat_filter(digests: DataFrame, blocks: int) -> DataFrame:
    """(block, bits): bit s is set if slot s was hit twice or more."""
    sha = F.col("sha")
    lists = digests.select(_block(sha, blocks).alias("block"),
                           *[_probe(sha, k).alias(f"s{k}") for k in range(PROBES)]) \
        .mapInArrow(released(_slot_lists), "block int, once binary, again binary")
    return lists.groupBy("block").applyInArrow(_repeat_bits, "block int, bits array<bigint>")


def with_maybe(rows: DataFrame, bits: DataFrame, blocks: int) -> DataFrame:
    """``rows`` (with ``sha``) with ``maybe``: false only where no other row has its digest."""
    sha = F.col("sha")

    def hit(k: int) -> Column:
        at = _probe(sha, k)
        word = F.get(F.col("__bits"), F.shiftright(at, 6))
        return F.getbit(word, at.bitwiseAND(F.lit(63))) == 1

    every = hit(0)
    for k in range(1, PROBES):
        every = every & hit(k)
    small = F.broadcast(bits.select(F.col("block").alias("__block"), F.col("bits").alias("__bits")))
    return (rows.withColumn("__block", _block(sha, blocks)).join(small, "__block", "left")
            .withColumn("maybe", F.coalesce(every, F.lit(False))).drop("__block", "__bits"))


def copy_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """(flag, rows, groups): ``flag`` adds ``maybe`` to rows with ``sha``; rows
    (doc_id, sha, maybe) and the groups of two or more equal texts (sha,
    keep_id, group_size) are staged."""
    digests = stage(docs.select(F.col(id_col).alias("doc_id"), text_digest(F.col(text_col)).alias("sha")), "digests")
    blocks = _blocks(digests.count())
    bits = stage(repeat_filter(digests, blocks), "bloom")
    rows = stage(with_maybe(digests, bits, blocks), "flagged")
    groups = (rows.filter("maybe").groupBy("sha")
              .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
              .filter("group_size > 1"))
    return (lambda df: with_maybe(df, bits, blocks)), rows, stage(groups, "groups")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    _, rows, groups = copy_groups(docs, id_col, text_col)
    one = F.lit(1).cast("long")
    alone = rows.filter(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), one.alias("group_size"), "sha")
    grouped = join_staged(rows.filter("maybe"), groups, "sha", "left", row_bytes=128).select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", one).alias("group_size"), "sha")
    return alone.unionByName(grouped).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the copies, all columns as they were.

    A row that the filter clears passes straight through; the others shuffle by
    digest. Of each group of copies the row with the smallest id stays; where
    several rows share that id, one of them.
    """
    flag, _, groups = copy_groups(docs, id_col, text_col)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("sha"))
    flagged = flag(packed)
    alone = flagged.filter(~F.col("maybe")).select("row")
    tested = join_staged(flagged.filter("maybe"), groups, "sha", "left", row_bytes=128)
    single = tested.filter(F.col("group_size").isNull()).select("row")
    first = (tested.filter(F.col("group_size").isNotNull() & F.col("id").eqNullSafe(F.col("keep_id")))
             .groupBy("sha").agg(any_row()).select("row"))
    return alone.unionByName(single).unionByName(first).select("row.*")
