"""Confirmed links inside blocks of documents: blocked sparse products.

The input is a table of candidate edges between nodes (a node is a set of word
shingles, named by its hash). Their components are blocks, and every link between
two nodes of a block is looked for on the full sets, as far as it tells something
new: links within what is already one component are never counted.

1. The sets of block nodes are made again from the texts, one per node and task: a
   fixed bitmap of the nodes picks the texts, so other texts never shuffle.
2. A block is dealt into parts of at most ``BLOCK_SHINGLES`` shingles. A part is a
   sparse matrix of its nodes by their shingles; a node's row times the matrix
   counts its overlaps with all others at once. Rows are taken only while more than
   one component is left among the nodes whose row was not taken, so a block of
   copies of one text takes few rows.
3. Of a block in several parts, each part sends one node of its largest
   component; those meet, in groups. What then is not in the block's largest
   component (the visitors) meets every part. The work is linear in a large group
   of copies, however many parts it has, and falls back to all parts against all
   visitors where a block does not hang together.

Nothing is cut: parts bound what a task holds, never what is compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm import textvec
from pricelake.llm.common import in_bitmap, join_staged, key_bitmap, released, sorted_groups, stage
from pricelake.llm.components import components

#: Shingles of a part (eight bytes each), and leaders that meet in one group.
BLOCK_SHINGLES = 1_000_000
LEADERS = 64
#: The bitmap of block nodes: 2 ** BITS bits (4 MB).
BITS = 25

U = np.uint64


def set_name(s: np.ndarray) -> int:
    """64-bit name of a set of shingle hashes: equal sets have equal names."""
    return int(textvec.mix(np.array([textvec.mix(s ^ U(0xA5A5A5A5DEADBEEF)).sum(dtype=U) + U(len(s))])).view(np.int64)[0])


def exact_links(sets: list[np.ndarray], num: int, den: int, labels=None) -> list[tuple[int, int]]:
    """Edges that join all nodes linked by den * |A & B| >= num * |A | B|.

    ``labels`` names components known before; only edges between different ones
    are looked for and returned.
    """
    n = len(sets)
    comp = np.arange(n) if labels is None else np.unique(labels, return_inverse=True)[1].astype(np.int64)
    if n < 2 or (comp == comp[0]).all():
        return []
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), size)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    new = np.r_[True, flat[order][1:] != flat[order][:-1]]
    term = np.empty(len(flat), dtype=np.int64)
    term[order] = np.cumsum(new) - 1
    post, first = owner[order], np.r_[np.flatnonzero(new), len(flat)]
    cut = np.r_[0, np.cumsum(size)]
    todo, out = np.ones(n, dtype=bool), []
    while True:
        left = np.flatnonzero(todo)
        count = np.bincount(comp[left])
        if np.count_nonzero(count) < 2:
            return out
        rest = left[comp[left] != count.argmax()]
        # a row of a small component: links to the largest are seen from here
        i = int(rest[0])
        todo[i] = False
        t = term[cut[i]:cut[i + 1]]
        lo, many = first[t], first[t + 1] - first[t]
        at = np.repeat(lo - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
        both = np.bincount(post[at], minlength=n)
        near = np.flatnonzero((den * both >= num * (size + size[i] - both)) & (comp != comp[i]))
        if len(near):
            found, at = np.unique(comp[near], return_index=True)
            out += [(i, int(j)) for j in near[at]]
            comp[np.isin(comp, found)] = comp[i]


def _sets_of(bits: np.ndarray, shingle: int):
    """(node, grams) of the texts whose set's name is in the bitmap, once a task."""
    def run(batches):
        done = set()
        for b in batches:
            for _, _, data, offsets in textvec.text_chunks(b.column(0)):
                node, grams = [], []
                sets = [s for s in textvec.shingle_sets(data, offsets, shingle) if len(s)]
                names = np.array([set_name(s) for s in sets], dtype=np.int64)
                for k in np.flatnonzero(in_bitmap(bits, names)).tolist():
                    if names[k] not in done:
                        done.add(names[k])
                        node.append(names[k])
                        grams.append(sets[k].tobytes())
                if node:
                    yield pa.RecordBatch.from_pydict({"node": pa.array(node, pa.int64()), "grams": pa.array(grams, pa.binary())})
    return run


def _confirm(num: int, den: int):
    def run(batches):
        """Edges from rows (group, node, label, grams) sorted by group."""
        for t, bounds in sorted_groups(batches):
            a, b = [], []
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                if hi - lo < 2:
                    continue
                node, at = np.unique(t.column(1).slice(lo, hi - lo).to_numpy(), return_index=True)     # one set a node
                label = t.column(2).slice(lo, hi - lo).to_numpy()[at]
                grams = t.column(3).slice(lo, hi - lo).take(pa.array(at))
                sets = [np.frombuffer(g.as_buffer(), U) for g in grams]
                for i, j in exact_links(sets, num, den, label):
                    a.append(node[i])
                    b.append(node[j])
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def _met(sets: DataFrame, groups: DataFrame, num: int, den: int, name: str) -> DataFrame:
    """Staged edges found in the groups (group, node, label)."""
    rows = join_staged(sets, groups, "node", "inner", row_bytes=24)
    return stage(rows.select("group", "node", "label", "grams").repartition("group").sortWithinPartitions("group", "node")
                 .mapInArrow(released(_confirm(num, den)), "a long, b long"), name)


def confirmed(docs: DataFrame, text_col: str, nodes: DataFrame, edges: DataFrame, shingle: int, num: int, den: int) -> DataFrame:
    """Staged edges (a, b) of which the components are those of all links
    den * |A & B| >= num * |A | B| between nodes of one candidate component.

    ``nodes``: staged (node, n_shingles), one row a node; ``edges``: candidates (a, b).
    """
    blocks = components(edges)
    picked = docs.select(text_col).mapInArrow(released(_sets_of(key_bitmap(blocks, "node", BITS), shingle)), "node long, grams binary")
    sized = join_staged(nodes.select("node", "n_shingles"), blocks.withColumnRenamed("root", "block"), "node", "inner", row_bytes=24)
    parts = F.ceil(F.col("total") / BLOCK_SHINGLES).cast("int")
    totals = stage(sized.groupBy("block").agg(F.sum("n_shingles").alias("total")).select("block", parts.alias("parts")), "totals")
    dealt = stage(join_staged(sized, totals, "block", "inner", row_bytes=24).select(
        "node", "block", "parts", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("node"), F.col("parts"))).otherwise(0).cast("int").alias("part")), "dealt")
    group = F.xxhash64("block", "part").alias("group")
    sets = stage(join_staged(picked, dealt.select("node"), "node", "left_semi", row_bytes=24), "sets")
    found = _met(sets, dealt.select(group, "node", F.col("node").alias("label")), num, den, "links")
    large = dealt.filter("parts > 1")
    if large.isEmpty():
        return found

    # several parts: their largest components meet through one node each
    def labelled(edges: DataFrame) -> DataFrame:
        return stage(large.join(components(edges), "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root"), "labels")

    known = labelled(found)
    count = known.groupBy("block", "part", "label").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"))
    lead = count.groupBy("block", "part").agg(F.max(F.struct("n", "node", "label")).alias("l"))
    groups = lead.select(F.xxhash64("block", F.floor(F.col("part") / LEADERS)).alias("group"), "l.node", "l.label")
    found = stage(found.union(_met(sets, stage(groups, "leaders"), num, den, "links")), "links")
    # what is now outside a block's largest component meets every part
    known = labelled(found)
    size = known.groupBy("block", "label").agg(F.count(F.lit(1)).alias("n"))
    main = stage(size.groupBy("block").agg(F.max(F.struct("n", "label")).alias("m")).select("block", F.col("m.label").alias("main")), "main")
    marked = join_staged(known, main, "block", "inner", row_bytes=16)
    visitors = stage(marked.filter("label <> main").select("node", "block", "label", "parts"), "visitors")
    if visitors.isEmpty():
        return found
    weight = join_staged(nodes.select("node", "n_shingles"), visitors.select("node", "block"), "node", "inner", row_bytes=24) \
        .groupBy("block").agg(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("int").alias("vparts"))
    visits = stage(join_staged(visitors, stage(weight, "visits"), "block", "inner", row_bytes=16)
                   .withColumn("v", F.pmod(F.xxhash64("node", F.lit(3)), F.col("vparts")).cast("int")), "visits")
    rounds = visits.select("block", "vparts").distinct()
    hosts = join_staged(known, stage(rounds, "rounds"), "block", "inner", row_bytes=16) \
        .withColumn("v", F.explode(F.sequence(F.lit(0), F.col("vparts") - 1))).select("block", "part", "v", "node", "label")
    guests = visits.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("block", "part", "v", "node", "label")
    met = hosts.union(guests).select(F.xxhash64("block", "part", "v").alias("group"), "node", "label")
    return stage(found.union(_met(sets, stage(met, "meetings"), num, den, "links")), "links")
