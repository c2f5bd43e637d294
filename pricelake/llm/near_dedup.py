"""Near-duplicate groups by an LSH forest over MinHash signatures.

1. One pass over the texts: distinct word shingles, a 64-bit name of the set
   (equal sets are one node from here on), and a signature of ``VALUES`` minima, a
   byte each.
2. Forest: every tree has its own order of the signature's values, and sorts the
   nodes by them (one range-partitioned sort of short labels, so a crowded region
   is split over tasks like any other range). A node's candidates in a tree are the
   next ``NEXT`` nodes in its order, those that share the longest prefixes with it:
   in a crowded region they agree on many values, in a sparse one on few, and never
   on fewer than ``LEAST``. A candidate whose label beyond the prefix agrees in
   fewer than ``LINK`` values is dropped.
3. The components of the candidates are blocks, in which every link is confirmed on
   the full sets (``block_links``: linear in a large group of copies).
4. Components of the confirmed links name the groups.

In a tree a pair of similarity s shares the first LEAST values with probability s**3,
and of the 17 others 9 with 0.998 (0.85) or 0.995 (0.8); it is then found unless
NEXT nodes stand between them that share as much. All 24 trees miss it with
probability below 1e-9 (0.85) or 1e-7 (0.8) where fewer do; where m unlike nodes of
similarity q to it do not thin out (a passage that m documents share), the pair needs
a prefix of about log(m / NEXT) / log(1 / q) values instead.

Defined cases: null and empty texts and texts without words have an empty set,
are linked with nothing and stay; fewer words than a shingle make one shingle
of the whole sequence; equal sets are always linked; a null ``doc_id`` takes
part but never names a group unless all its rows have none; rows repeating one
``doc_id`` are separate rows of one group when their sets link, and of each group
one row stays; very long texts are read in blocks of words; packed rows keep columns
with clashing names apart; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm import textvec
from pricelake.llm.block_links import confirmed, set_name
from pricelake.llm.common import join_staged, released, row_key, stage, without
from pricelake.llm.components import components

SHINGLE = 5
TREES, VALUES = 24, 120
#: Values of a label; of a prefix at least; beyond it that must agree; candidates on either side.
LABEL, LEAST, LINK, NEXT = 20, 3, 9, 4

U = np.uint64
_FLIP = textvec.mix(np.arange(1, VALUES + 1, dtype=U) * U(0x9E3779B97F4A7C15))
_ODD = textvec.mix(_FLIP + U(77)) | U(1)
#: The values of each tree's label, in its order.
_ORDER = (np.arange(TREES)[:, None] * (VALUES // TREES) + np.arange(LABEL)) % VALUES


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """VALUES bytes of each non-empty set: a byte of each minimum."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    low = np.empty((len(sets), VALUES), dtype=U)
    for k in range(VALUES):
        low[:, k] = np.minimum.reduceat((flat ^ _FLIP[k]) * _ODD[k], starts)
    return (textvec.mix(low) & U(255)).astype(np.uint8)


def _sign(batches):
    for b in batches:
        ids = b.column(0)
        for lo, hi, data, offsets in textvec.text_chunks(b.column(1)):
            sets = textvec.shingle_sets(data, offsets, SHINGLE)
            n = [len(s) for s in sets]
            full = [s for s in sets if len(s)]
            sigs = iter(signatures(full) if full else ())
            names = iter([set_name(s) for s in full])
            yield pa.RecordBatch.from_pydict({
                "doc_id": ids.slice(lo, hi - lo), "key": b.column(2).slice(lo, hi - lo), "n_shingles": pa.array(n, pa.int64()),
                "node": pa.array([next(names) if k else None for k in n], pa.int64()),
                "sig": pa.array([next(sigs).tobytes() if k else None for k in n], pa.binary())})


def _labels(batches):
    """(label, node): a node's label in each tree, after the tree's number."""
    for b in batches:
        if not b.num_rows:
            continue
        sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(-1, VALUES)
        trees = np.broadcast_to(np.arange(TREES, dtype=np.uint8)[None, :, None], (len(sig), TREES, 1))
        label = np.ascontiguousarray(np.concatenate([trees, sig[:, _ORDER]], axis=2)).reshape(-1, LABEL + 1)
        offsets = np.arange(len(label) + 1, dtype=np.int32) * (LABEL + 1)
        yield pa.RecordBatch.from_arrays([
            pa.Array.from_buffers(pa.binary(), len(label), [None, pa.py_buffer(offsets), pa.py_buffer(label)]),
            pa.array(np.repeat(b.column(0).to_numpy(), TREES))], ["label", "node"])


def neighbours(label: np.ndarray, node: np.ndarray, old: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs of sorted labels: each node with its next NEXT, by the tree's
    number, prefix and agreement. Pairs among the first ``old`` were given before."""
    a, b = [], []
    for d in range(1, min(NEXT, len(label) - 1) + 1):
        same = label[d:] == label[:-d]
        near = same[:, :1 + LEAST].all(axis=1) & (np.count_nonzero(same[:, 1 + LEAST:], axis=1) >= LINK)
        near[:max(0, old - d)] = False
        at = np.flatnonzero(near)
        a.append(node[at])
        b.append(node[at + d])
    z = np.zeros(0, np.int64)
    return np.concatenate([z, *a]), np.concatenate([z, *b])


def _candidates(batches):
    """Candidate edges from sorted (label, node) rows; the last NEXT rows of a batch
    meet the next one's."""
    label, node = np.zeros((0, LABEL + 1), np.uint8), np.zeros(0, np.int64)
    for b in batches:
        if not b.num_rows:
            continue
        new = np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint8).reshape(-1, LABEL + 1)
        old = len(label)
        label, node = np.concatenate([label, new]), np.concatenate([node, b.column(1).to_numpy()])
        x, y = neighbours(label, node, old)
        yield pa.RecordBatch.from_pydict({"a": x, "b": y})
        label, node = label[-NEXT:], node[-NEXT:]


def _grouped(docs: DataFrame, id_col: str, text_col: str, num: int, den: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, key, n_shingles, component_id, named,
    first; of a row in a group ``named`` is true and ``first`` holds the key of
    the group's row with the smallest doc_id (then key), null ids last."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("key"))
    signed = stage(docs.mapInArrow(released(_sign), "doc_id long, key binary, n_shingles long, node long, sig binary"), "signed")
    reps = stage(signed.filter("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first"),
        F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")), "reps")
    forest = reps.select("node", "sig").mapInArrow(released(_labels), "label binary, node long")
    edges = forest.repartitionByRange("label", "node").sortWithinPartitions("label", "node").mapInArrow(released(_candidates), "a long, b long")
    groups = components(confirmed(docs, "text", reps.select("node", "n_shingles"), edges, SHINGLE, num, den))

    # names: the smallest doc_id of all copies of all nodes of a group
    names = reps.select("node", "rep", "first", "copies").join(groups, "node", "left") \
        .filter((F.col("copies") > 1) | F.col("root").isNotNull()) \
        .withColumn("root", F.coalesce("root", "node"))
    least = stage(names.groupBy("root").agg(F.min("rep").alias("component_id"), F.min("first").alias("first"))
                  .select("root", "component_id", F.col("first.key").alias("first")), "least")
    names = stage(join_staged(names.select("node", "root"), least, "root", "inner", row_bytes=72)
                  .select("node", "component_id", "first", F.lit(True).alias("named")), "names")
    return join_staged(signed.select("doc_id", "key", "n_shingles", "node"), names, "node", "left", row_bytes=80)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                num: int = 85, den: int = 100) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents link when their shingle sets' Jaccard similarity is at least
    ``num / den``; ``component_id`` is the smallest doc_id of the group.
    """
    cid = F.when(F.col("named"), F.col("component_id")).otherwise(F.col("doc_id"))
    return _grouped(docs, id_col, text_col, num, den).select(
        "doc_id", "n_shingles", cid.alias("component_id"), F.col("doc_id").eqNullSafe(cid).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each near-duplicate group (of its smallest
    doc_id), all columns as they were."""
    lost = _grouped(docs, id_col, text_col, num, den).filter("named").groupBy("key").agg(
        F.first(F.col("key") == F.col("first")).alias("once"), F.count(F.lit(1)).alias("n")).filter("n > 1 or not once")
    return without(docs, id_col, text_col, stage(lost.select("key", "once"), "lost"))
