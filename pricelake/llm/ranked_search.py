"""Ranked lexical search by NRA: impact-sorted lists, no random access.

1. One pass over the documents keeps, per document, its length in terms and the
   counts of the terms that any item asks for (a fixed bitmap picks them); the
   corpus statistics (documents, lengths, document frequencies) are aggregates of
   all documents.
2. The documents are searched in shards, as they lie in a task, of at most
   ``SHARD_POSTINGS`` postings. A shard's postings make one list per term, sorted
   by falling impact. For each item its lists are read in order, side by side,
   down to a level that falls by ``STEP`` each round. Every document met has an
   interval: the sum of what was read, and that plus what its unread lists may
   still hold at most. An item's reading ends when no unmet document and no
   document outside the first ``k`` can reach the k-th lower bound, and every
   document that can is exact, ties included.
3. The shards' winners (at most ``k`` each and ties never beyond) are merged by
   (score, id): a document's score needs only its own shard.

Items are taken in blocks of about ``BLOCK_TERMS`` (item, term) rows, so what a
task holds of them is bounded; a block is one more read of the postings.

Integers are 64 bit. Defined cases: null and empty texts and texts without a term
are no documents here and no items; rows repeating a ``doc_id`` are documents of
their own; a null ``doc_id`` sorts last among equal scores; rows repeating an item id
are one item with the terms of all of them, null ids are one item; very long
texts are read in blocks; only the named columns are read, so further columns with
any names do no harm; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm import textvec
from pricelake.llm.common import join_staged, released, stage

K = 10
BITS = 22
SHARD_POSTINGS = 1 << 21
BLOCK_TERMS = 1 << 17
STEP = 8
RESULT = "item_id long, rank int, doc_id long, score long"
#: Stands for a null id among a shard's ids: it sorts last.
LAST = np.iinfo(np.int64).max

U = np.uint64


def _item_terms(batches):
    for b in batches:
        for lo, hi, data, offsets in textvec.text_chunks(b.column(1)):
            _, _, h, cut = textvec.words(data, offsets, textvec.ALNUM)
            rows = np.repeat(np.arange(lo, hi), np.diff(cut))
            yield pa.RecordBatch.from_pydict({"item_id": b.column(0).take(pa.array(rows)), "term": pa.array(h.view(np.int64))})


def _asked_counts(bits: np.ndarray):
    mask = U((1 << BITS) - 1)

    def run(batches):
        """(doc_id, n, terms, counts) of the texts that have a term."""
        for b in batches:
            for lo, hi, data, offsets in textvec.text_chunks(b.column(1)):
                _, _, h, cut = textvec.words(data, offsets, textvec.ALNUM)
                n = np.diff(cut)
                at = np.flatnonzero(bits[h & mask])
                doc, h = np.searchsorted(cut, at, side="right") - 1, h[at]
                order = np.lexsort((h, doc))
                doc, h = doc[order], h[order]
                new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])] if len(h) else [])
                count = np.diff(np.r_[new, len(h)])
                ends = np.searchsorted(doc[new], np.arange(hi - lo + 1))
                cols = [b.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(h[new].view(np.int64))),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(count.astype(np.int64)))]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n", "terms", "counts"]).filter(pa.array(n > 0))
    return run


class Lists:
    """A shard's impact-sorted lists: (document, impact) by falling impact per
    term. ``read`` counts the postings read so far."""

    def __init__(self, ids, doc, term, impact, terms: int):
        order = np.lexsort((-impact, term))
        self.ids, self.doc, self.impact = ids, doc[order], impact[order]
        self.first = np.searchsorted(term[order], np.arange(terms + 1))
        self.read = 0

    def top(self, terms: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of an item's best ``k`` documents of this shard."""
        at, end = self.first[terms], self.first[terms + 1]
        low = np.zeros(len(self.ids), dtype=np.int64)
        seen = np.zeros((len(self.ids), len(terms)), dtype=bool)
        alive = np.ones(len(self.ids), dtype=bool)
        head = np.array([w * self.impact[a] if a < e else 0 for a, e, w in zip(at, end, weight, strict=True)], dtype=np.int64)
        level = int(head.max(initial=0))
        while level:
            level //= STEP
            for j in np.flatnonzero(head > level):
                # down to the first posting worth no more than the level
                stop = at[j] + np.searchsorted(-self.impact[at[j]:end[j]], -(level // weight[j]), side="left")
                d = self.doc[at[j]:stop]
                on = alive[d]
                low[d[on]] += weight[j] * self.impact[at[j]:stop][on]
                seen[d[on], j] = True
                self.read += len(d)
                at[j] = stop
                head[j] = weight[j] * self.impact[stop] if stop < end[j] else 0
            met = np.flatnonzero(low > 0)
            kth = int(np.partition(low[met], len(met) - k)[len(met) - k]) if len(met) >= k else 0
            rest = int(head.sum())
            high = low[met] + rest - seen[met] @ head
            can = high >= kth
            if rest and rest >= kth:         # an unmet document may still come in
                continue
            alive[:] = False
            alive[met[can]] = True
            if not rest or (high[can] == low[met[can]]).all():
                break
        best = np.flatnonzero(alive & (low > 0))
        best = best[np.lexsort((self.ids[best], -low[best]))][:k]
        return best, low[best]


def _searcher(items: pa.Table, docs_n: int, docs_l: int, k: int):
    """Winners of each shard for the items (number, term, weight), sorted by number."""
    number, asked, weight = (items.column(c).to_numpy() for c in ("number", "term", "w"))
    vocabulary, term_of = np.unique(asked, return_inverse=True)
    cuts = np.flatnonzero(np.r_[True, number[1:] != number[:-1], True])

    def shard(parts):
        ids = np.concatenate([p[0] for p in parts])
        n = np.concatenate([p[1] for p in parts])
        many = np.concatenate([p[2] for p in parts])
        term, tf = (np.concatenate([p[c] for p in parts]) for c in (3, 4))
        doc = np.repeat(np.arange(len(ids)), many)
        at = np.searchsorted(vocabulary, term)
        hit = np.flatnonzero(vocabulary[np.minimum(at, len(vocabulary) - 1)] == term)
        m = 100 - 90 + (90 * n * docs_n) // docs_l
        tf, doc = tf[hit], doc[hit]
        lists = Lists(ids, doc, at[hit], (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]), len(vocabulary))
        out = []
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            best, score = lists.top(term_of[lo:hi], weight[lo:hi], k)
            out.append((np.full(len(best), number[lo]), ids[best], score))
        which, ids, score = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.RecordBatch.from_pydict({"number": which, "doc_id": pa.array(ids, mask=ids == LAST), "score": score})

    def run(batches):
        parts, size = [], 0
        for b in batches:
            terms, counts = b.column(2), b.column(3)
            parts.append((b.column(0).fill_null(LAST).to_numpy(zero_copy_only=False), b.column(1).to_numpy(),
                          np.diff(terms.offsets.to_numpy()), terms.flatten().to_numpy(), counts.flatten().to_numpy()))
            size += len(parts[-1][3]) + b.num_rows
            if size >= SHARD_POSTINGS:
                yield shard(parts)
                parts, size = [], 0
        if parts:
            yield shard(parts)
    return run


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    items = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
    asked = stage(items.mapInArrow(released(_item_terms), "item_id long, term long").distinct(), "item-terms")
    place = F.col("term").bitwiseAND(F.lit((1 << BITS) - 1)).alias("p")
    bits = np.zeros(1 << BITS, dtype=bool)
    bits[asked.select(place).distinct().toArrow().column(0).to_numpy()] = True       # at most 2 ** BITS

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counted = stage(docs.mapInArrow(released(_asked_counts(bits)), "doc_id long, n long, terms array<bigint>, counts array<bigint>"),
                    "term-counts")
    total = counted.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
    if not total["n"] or asked.isEmpty():
        return spark.createDataFrame([], RESULT)
    df = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * total["n"] + 2.0) / (F.lit(2.0) * F.col("df") + F.lit(1.0)))).cast("long")
    weighed = stage(asked.join(df, "term").select("item_id", "term", weight.alias("w")).filter("w > 0"), "weighed")
    # items by number, so that a null id is a key like others
    named = stage(weighed.groupBy("item_id").agg(F.count(F.lit(1)).alias("terms"))
                  .withColumn("number", F.xxhash64(F.col("item_id").isNull(), F.coalesce("item_id", F.lit(0)))), "items")
    rows = named.agg(F.sum("terms")).first()[0] or 0
    if not rows:
        return spark.createDataFrame([], RESULT)
    blocks = math.ceil(rows / BLOCK_TERMS)
    weighed = weighed.withColumn("number", F.xxhash64(F.col("item_id").isNull(), F.coalesce("item_id", F.lit(0))))
    found = None
    for b in range(blocks):
        block = weighed.filter(F.pmod("number", F.lit(blocks)) == b).select("number", "term", "w").toArrow().sort_by("number")
        if not len(block):
            continue
        won = counted.mapInArrow(released(_searcher(block, total["n"], total["l"], k)), "number long, doc_id long, score long")
        found = won if found is None else found.unionByName(won)
    found = stage(found, "found")
    best = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return join_staged(ranked, named.select("number", "item_id"), "number", "inner", row_bytes=24) \
        .select("item_id", "rank", "doc_id", "score")
