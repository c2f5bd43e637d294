"""N-gram Jaccard join by a blocked sparse product of documents by n-grams.

The incidence matrix has a row for every distinct set of word shingles (equal sets
are one node from here on) and a column for every shingle.

1. Two passes over the texts: the sets' names and sizes, then the counts of all
   shingles, by the first 32 bits of their hash (two bytes each travel). A table of at
   most 2 ** ``WIDTH`` bytes holds the level (half powers of two) of the most frequent
   shingle of every place, from ``FREQUENT`` rows on, and all shingles are put into one
   order: by level, then by their hash. Any order gives right results; this one keeps
   a column of many rows only where a set has too few rarer shingles.
2. Pass: of each row only the columns that a link at ``num / den`` cannot avoid are
   kept: the first |x| - ceil(num |x| / den) + 1 in that order. The matrix is dealt
   into column blocks by hash; a cell block (one task's rows, one column block)
   travels as one packed row.
3. A column block is multiplied by its transpose: every two rows of a column, of
   sizes that a link allows, add one to their overlap. Overlaps are summed over the
   column blocks, and a pair below its bound goes: with a the least overlap that its
   sizes need, it must share a - |x| + (columns kept of x) of the kept columns for
   that of its two rows whose kept columns end first.
   A column of over ``LIST`` rows emits no pairs: its rows are tied into one block, with
   at most an edge a row from all such columns of a column block.
4. Pairs and chains make candidate blocks, where links are confirmed on the full
   sets (``block_links``); the components of the links are the classes.

A pair whose shared kept columns are all short has its whole overlap counted; a pair
with a long one is in its chain's block. So no link is lost, and no group emits all
its pairs.

Defined cases: null and empty texts and texts without words have an empty set and
are linked with nothing; fewer words than a shingle make one shingle of the whole
sequence; equal sets are always linked; a null ``doc_id`` takes part but never names
a class unless all its rows have none; rows repeating a ``doc_id`` are rows of their
own; very long texts are read in blocks of words; only the named columns are read,
so further columns with any names do no harm; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm import textvec
from pricelake.llm.block_links import confirmed, set_name
from pricelake.llm.common import join_staged, released, stage
from pricelake.llm.components import Forest, components

SHINGLE = 5
#: Shingles packed at once, and the groups (by their first 8 bits) that they are counted in.
CHUNK, GROUPS = 1 << 21, 256
#: Rows from which a shingle has a level; bits of a place in the table of levels (16 MB); bits of a level.
FREQUENT, WIDTH, LEVEL = 16, 24, 5
#: Kept columns' entries of a column block; rows of a column that emits pairs.
BLOCK_ENTRIES, LIST = 1 << 21, 64

U = np.uint64


def least(num: int, den: int, size: np.ndarray) -> np.ndarray:
    """ceil(num * size / den): the least size of a partner, and the least overlap with it."""
    return -(-num * size // den)


def _name(batches):
    """(doc_id, n, node) of every text."""
    for b in batches:
        for lo, hi, data, offsets in textvec.text_chunks(b.column(1)):
            sets = textvec.shingle_sets(data, offsets, SHINGLE)
            node = [set_name(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array(node, pa.int64())], ["doc_id", "n", "node"])


def _places(batches):
    """(group, places) of a chunk's shingles, packed: how many have each value of the
    second byte, then the third and fourth bytes in order."""
    held, size, done = [], 0, set()

    def packed():
        place = np.sort((np.concatenate(held) >> U(32)).astype(np.uint32))
        cut = np.searchsorted(place, np.arange(1, GROUPS, dtype=np.uint32) << np.uint32(24))
        parts = [(g, x) for g, x in enumerate(np.split(place, cut)) if len(x)]
        data = [np.bincount((x >> 16) & 255, minlength=256).astype(np.uint32).tobytes() + x.astype(np.uint16).tobytes() for _, x in parts]
        return pa.RecordBatch.from_pydict({"group": pa.array([g for g, _ in parts], pa.int32()), "places": pa.array(data, pa.binary())})

    for b in batches:
        for _, _, data, offsets in textvec.text_chunks(b.column(0)):
            for s in textvec.shingle_sets(data, offsets, SHINGLE):
                name = set_name(s) if len(s) else None
                if name is None or name in done:         # copies of one set are one row of the matrix
                    continue
                done.add(name)
                held.append(s)
                size += len(s)
        if size >= CHUNK:
            yield packed()
            held, size = [], 0
    if size:
        yield packed()


def _counted(width: int, bits: int, frequent: int):
    def run(batches):
        """(group, levels) from packed places sorted by group, counted by their first ``bits``."""
        times, now = np.zeros(1 << (bits - 8), np.uint32), None

        def levels():
            at = np.flatnonzero(times >= frequent)
            level = np.minimum((1 << LEVEL) - 1, 1 + (2 * np.log2(times[at] / frequent)).astype(np.int64)).astype(np.uint8)
            out = np.zeros(1 << (width - 8), np.uint8)
            np.maximum.at(out, at >> (bits - width), level)
            return pa.RecordBatch.from_pydict({"group": pa.array([now], pa.int32()), "levels": pa.array([out.tobytes()], pa.binary())})

        for b in batches:
            for k, group in enumerate(b.column(0).to_pylist()):
                if group != now:
                    if now is not None:
                        yield levels()
                        times[:] = 0
                    now = group
                data = b.column(1)[k].as_buffer()
                second = np.frombuffer(data, np.uint32, 256)
                place = np.repeat(np.arange(256) << 16, second) + np.frombuffer(data, np.uint16, offset=second.nbytes)
                np.add.at(times, place >> (32 - bits), np.uint32(1))
        if now is not None:
            yield levels()
    return run


def _levels(docs: DataFrame, total: int) -> np.ndarray:
    """The level of each place; ``total``: shingles of all rows of the matrix."""
    width = min(WIDTH, max(8, (total // 64).bit_length()))
    bits = min(32, max(width, total.bit_length() + 2))
    packed = docs.select("text").mapInArrow(released(_places), "group int, places binary")
    found = packed.repartition("group").sortWithinPartitions("group") \
        .mapInArrow(released(_counted(width, bits, FREQUENT)), "group int, levels binary").toArrow()
    out = np.zeros((GROUPS, 1 << (width - 8)), np.uint8)
    for group, row in zip(found.column("group").to_pylist(), found.column("levels").to_pylist(), strict=True):
        out[group] = np.frombuffer(row, np.uint8)
    return out.ravel()


def _keys(s: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Places of shingles in the order of all shingles: by level, then by hash."""
    level = levels[s >> U(65 - len(levels).bit_length())]
    return (level.astype(U) << U(64 - LEVEL)) | (s >> U(LEVEL))


def _cells(levels: np.ndarray, blocks: int, num: int, den: int):
    def run(batches):
        """Cell blocks: (block, key, node, size, end), the last four packed."""
        held, size, done = [], 0, set()

        def cells():
            key, node, n, end = (np.concatenate(c) for c in zip(*held, strict=True))
            # every key to one column block; rows of a document stay together, which packs well
            block = (textvec.mix(key) % U(blocks)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            cut = np.flatnonzero(np.r_[True, np.diff(block[order]) > 0, True])
            cols = [[x[order[lo:hi]].tobytes() for lo, hi in zip(cut[:-1], cut[1:], strict=True)] for x in (key, node, n, end)]
            return pa.RecordBatch.from_pydict({"block": block[order[cut[:-1]]], **{
                c: pa.array(v, pa.binary()) for c, v in zip(("key", "node", "n", "end"), cols, strict=True)}})

        for b in batches:
            for _, _, data, offsets in textvec.text_chunks(b.column(0)):
                for s in textvec.shingle_sets(data, offsets, SHINGLE):
                    name = set_name(s) if len(s) else None
                    if name is None or name in done:
                        continue
                    done.add(name)
                    k = len(s) + num * len(s) // -den + 1
                    key = np.sort(np.partition(_keys(s, levels), k - 1)[:k])
                    held.append((key, np.full(k, name), np.full(k, len(s), dtype=np.int32), np.full(k, key[-1])))
                    size += k
            if size >= CHUNK // 4:
                yield cells()
                held, size = [], 0
        if size:
            yield cells()
    return run


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few edges with the same components: at most one a node."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    f = Forest(len(ids))
    for x, y in np.unique(at.reshape(2, -1), axis=1).T.tolist():
        f.join(x, y)
    root = np.array([f.root(x) for x in range(len(ids))], dtype=np.int64)
    far = np.flatnonzero(root != np.arange(len(ids)))
    return ids[root[far]], ids[far]


def tied(node: np.ndarray, root: np.ndarray, far: np.ndarray) -> np.ndarray:
    """The root of each node under the spanning edges (sorted by ``far``), else itself."""
    if not len(far):
        return node
    at = np.minimum(np.searchsorted(far, node), len(far) - 1)
    return np.where(far[at] == node, root[at], node)


def column_product(key, node, n, end, num: int, den: int, limit: int = LIST):
    """(pairs, chains) of a column block: pairs (x, y, overlap, bound) and edges."""
    order = np.lexsort((node, key))
    key, node, n, end = key[order], node[order], n[order].astype(np.int64), end[order]
    new = np.r_[True, (key[1:] != key[:-1]) | (node[1:] != node[:-1])] if len(key) else np.zeros(0, bool)
    key, node, n, end = key[new], node[new], n[new], end[new]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.r_[start, len(key)])
    long = np.repeat(size > limit, size)
    chain = np.flatnonzero(long[1:] & (key[1:] == key[:-1]))
    chains = spanning(node[chain], node[chain + 1])
    x, y = [], []
    # the d-th next row of the same column, for all short columns at once
    for d in range(1, min(int(size.max(initial=0)), limit)):
        i = np.flatnonzero((key[d:] == key[:-d]) & ~long[d:])
        if not len(i):
            break
        lo, hi = np.minimum(n[i], n[i + d]), np.maximum(n[i], n[i + d])
        i = i[den * lo >= num * hi]
        x.append(i)
        y.append(i + d)
    if not x:
        z = np.zeros(0, np.int64)
        return (z, z, z, z), chains
    x, y = np.concatenate(x), np.concatenate(y)
    need = least(num, num + den, n[x] + n[y])
    first = np.where(end[x] <= end[y], n[x], n[y])           # the row whose kept columns end first
    bound = need - least(num, den, first) + 1
    a, b = node[x], node[y]                                  # rows of a column are in node order
    order = np.lexsort((b, a))
    a, b, bound = a[order], b[order], bound[order]
    new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, np.int64)
    a, b, both, bound = a[new], b[new], np.diff(np.r_[new, len(a)]), bound[new]
    # a pair that long columns tie into one block anyway needs no row of its own
    apart = tied(a, *chains) != tied(b, *chains)
    return (a[apart], b[apart], both[apart], bound[apart]), chains


def _products(num: int, den: int, limit: int):
    def run(batches):
        """(a, b, overlap, bound) from cell blocks sorted by block; chains have no bound."""
        held, now = [], None

        def product():
            key, node, n, end = (np.concatenate([np.frombuffer(r[c], t) for r in held])
                                 for c, t in enumerate((U, np.int64, np.int32, U)))
            (a, b, both, bound), (c, d) = column_product(key, node, n, end, num, den, limit)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(both), pa.array(bound)], ["a", "b", "overlap", "bound"])
            none = pa.nulls(len(c), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(d), none, none], ["a", "b", "overlap", "bound"])

        for batch in batches:
            blocks = batch.column(0).to_pylist()
            for k, block in enumerate(blocks):
                if block != now and held:
                    yield from product()
                    held = []
                now = block
                held.append([batch.column(c)[k].as_buffer() for c in range(1, 5)])
        if held:
            yield from product()
    return run


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = 80, den: int = 100) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id
    reachable over links with den * |A & B| >= num * |A | B|)."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = stage(docs.mapInArrow(released(_name), "doc_id long, n long, node long"), "named")
    nodes = stage(rows.filter("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n_shingles"), F.count(F.lit(1)).alias("copies")), "nodes")
    total, entries = nodes.agg(F.sum("n_shingles"), F.sum(F.col("n_shingles") * (den - num) / den + 1)).first()
    levels = _levels(docs, total or 0)
    blocks = max(1, math.ceil(float(entries or 0) / BLOCK_ENTRIES))
    cells = docs.select("text").mapInArrow(released(_cells(levels, blocks, num, den)),
                                           "block long, key binary, node binary, n binary, end binary")
    made = stage(cells.repartition(blocks, "block").sortWithinPartitions("block")
                 .mapInArrow(released(_products(num, den, LIST)), "a long, b long, overlap long, bound long"), "products")
    pairs = made.filter("bound is not null").groupBy("a", "b").agg(F.sum("overlap").alias("overlap"), F.min("bound").alias("bound"))
    edges = pairs.filter("overlap >= bound").select("a", "b").unionByName(made.filter("bound is null").select("a", "b"))
    links = confirmed(docs, "text", nodes, edges, SHINGLE, num, den)
    groups = components(links)
    least_id = stage(nodes.join(groups, "node", "inner").groupBy("root").agg(F.min("rep").alias("least")), "least")
    member = join_staged(groups, least_id, "root", "inner", row_bytes=16).select("node", "least")
    # a node's name: the least id of its class, else of its own copies where it has some
    names = stage(nodes.join(member, "node", "left").filter("copies > 1 or least is not null")
                  .select("node", F.coalesce("least", "rep").alias("name"), F.lit(True).alias("named")), "names")
    got = join_staged(rows.select("doc_id", F.col("n").alias("n_shingles"), "node"), names, "node", "left", row_bytes=24)
    return got.select("doc_id", "n_shingles", F.when(F.col("named"), F.col("name")).otherwise(F.col("doc_id")).alias("component_id"))
