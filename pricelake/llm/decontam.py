"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. Seeds: at every position of a test item the shortest gram, from ``GRAM`` words on,
   that at most ``SHARED`` items hold; a phrase that many items share ("which of the
   following") is a seed only with its continuation, up to ``LONGEST`` words or the
   item's end. So a seed hit makes few pairs, however common the phrase is in the
   documents, while every unedited stretch of ``GRAM`` words of an item's own makes one.
2. A fixed map of the seeds picks the documents' grams and tells how long their
   items are. Passages are the stretches of a document around its hits, by that length
   on either side. Passages and items meet by a join on seeds; a pair goes on with
   at least ``SEED_SHARE`` of half the item's own grams (one at least).
3. A pair whose passage lacks more than half the item's words cannot reach ``SCORE``
   and goes (a score of half means matches for half the words at least). The others'
   words are aligned locally (match 2, mismatch and gap -1); the score is the best
   alignment over that of the whole item, 0 to 1, and a pair at ``SCORE`` or more is
   contaminated: an exact copy has 1, one with a fifth of its words replaced 0.7,
   half an item 0.5.

Words are runs of letters and digits, ASCII letters folded.
Defined cases: null and empty texts have no words and match nothing; items of
fewer words than a gram are no evidence and match nothing; a copy without an unedited
stretch that is a seed is not met (README has the recall by edits); a null item id is
reported as null; rows repeating a ``doc_id`` (or having none) are reported as
one document, as are items repeating an id, but only rows that hold an item
themselves are dropped; of passages that score alike the first is reported; very
long texts are cut into passages, none is dropped; packed rows keep columns with
clashing names apart; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm import textvec
from pricelake.llm.common import join_staged, released, row_key, stage, without

GRAM, LONGEST = 3, 8
SHARED = 8
SEED_SHARE = 0.15
MATCH, MISS, GAP = 2, -1, -1
SCORE = 0.5
BITS = 22


def _text_words(col):
    """(row, word hashes) of every text of a column."""
    for lo, _, data, offsets in textvec.text_chunks(col):
        _, _, h, b = textvec.words(data, offsets, textvec.ALNUM)
        for i in range(len(b) - 1):
            yield lo + i, h[b[i]:b[i + 1]]


def _grams(w: np.ndarray, n: int = GRAM) -> np.ndarray:
    return textvec.ngrams(w, np.array([0, len(w)]), n)[0].view(np.int64)


def _bit(h: np.ndarray) -> np.ndarray:
    return (h.view(np.uint64) >> np.uint64(64 - BITS)).astype(np.int64)


_SEED = pa.struct([("at", pa.int32()), ("n", pa.int32()), ("gram", pa.int64())])


def _items(batches):
    for b in batches:
        ids = b.column(0).to_pylist()
        rows = [(ids[i], w) for i, w in _text_words(b.column(1))]
        yield pa.RecordBatch.from_pydict({
            "item_id": pa.array([i for i, _ in rows], pa.int64()),
            "words": pa.array([w.tobytes() for _, w in rows], pa.binary()),
            "grams": pa.array([[{"at": p, "n": n, "gram": g} for n in range(GRAM, LONGEST + 1) for p, g in enumerate(_grams(w, n).tolist())]
                               for _, w in rows], pa.list_(_SEED))})


_PASSAGE = "pid long, doc_id long, key binary, first long, words binary, hits array<struct<gram bigint, at int>>"


def _passages(shared, lengths: list[int]):
    def run(batches):
        from pyspark import TaskContext
        wide, made = shared.value, TaskContext.get().partitionId() << 36
        kind = pa.list_(pa.struct([("gram", pa.int64()), ("at", pa.int32())]))
        for b in batches:
            ids, keys, out = b.column(0).to_pylist(), b.column(2), []
            for row, w in _text_words(b.column(1)):
                at, gram = [], []
                for n in lengths:
                    g = _grams(w, n)
                    hit = np.flatnonzero(wide[_bit(g)])
                    at.append(hit)
                    gram.append(g[hit])
                at, gram = np.concatenate(at), np.concatenate(gram)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, gram = at[order], gram[order]
                reach = np.int64(1) << wide[_bit(gram)].astype(np.int64)
                far = np.maximum.accumulate(at + LONGEST + reach)
                for part in np.split(np.arange(len(at)), np.flatnonzero(at[1:] - reach[1:] > far[:-1]) + 1):
                    lo, hi = max(0, int((at[part] - reach[part]).min())), int(far[part[-1]])
                    out.append((made, ids[row], keys[row].as_py(), lo, w[lo:hi].tobytes(),
                                [{"gram": int(gram[p]), "at": int(at[p]) - lo} for p in part]))
                    made += 1
            cols = list(zip(*out, strict=True)) or [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), kind)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                             names=["pid", "doc_id", "key", "first", "words", "hits"])
    return run


def smith_waterman(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(best local score, end of that alignment in the text): rows of the matrix
    at a time; a run of gaps along a row is a running maximum."""
    above = np.zeros(len(text) + 1, dtype=np.int64)
    slope = -GAP * np.arange(len(text) + 1)
    best, end = 0, 0
    for x in item:
        row = np.zeros_like(above)
        row[1:] = np.maximum(above[:-1] + np.where(text == x, MATCH, MISS), above[1:] + GAP)
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + slope) - slope
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
        above = row
    return best, end


def _align(batches):
    for b in batches:
        out = []
        for doc, key, item, first, n, text, words in zip(*(c.to_pylist() for c in b.columns), strict=True):
            text, words = np.frombuffer(text, np.uint64), np.frombuffer(words, np.uint64)
            if np.isin(words, text).sum() < SCORE * len(words):
                continue
            best, end = smith_waterman(words, text)
            score = best / (MATCH * len(words))
            if score >= SCORE:
                back = smith_waterman(words[::-1], text[:end][::-1])[1]
                out.append((doc, key, item, score, first + end - back, first + end, n))
        cols = list(zip(*out, strict=True)) or [[]] * 7
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                         names=["doc_id", "key", "item_id", "score", "start_word", "end_word", "seeds"])


def _widths(seeds: DataFrame):
    """By place of 2 ** BITS: 0, or the power of two that covers the longest item
    with a seed there. A fixed size, whatever the items."""
    places = seeds.groupBy(F.shiftrightunsigned("gram", 64 - BITS).cast("int").alias("p")).agg(F.max("words").alias("n")).toArrow()
    wide = np.zeros(1 << BITS, dtype=np.uint8)
    wide[places.column("p").to_numpy()] = np.ceil(np.log2(np.maximum(2, places.column("n").to_numpy())))
    return seeds.sparkSession.sparkContext.broadcast(wide)


def seeds_of(items: DataFrame) -> DataFrame:
    """(row, item_at, gram, n, words): of each position of an item the shortest gram
    that few items hold, else the longest there is."""
    grams = items.select("row", F.expr("octet_length(words) div 8").alias("words"), F.inline("grams"))
    held = grams.groupBy("gram").agg(F.countDistinct("row").alias("items"))
    last = F.col("n") == F.least(F.lit(LONGEST), F.col("words") - F.col("at"))
    good = grams.join(held, "gram").filter((F.col("items") <= SHARED) | last)
    return good.groupBy("row", F.col("at").alias("item_at")).agg(F.min(F.struct("n", "gram", "words")).alias("s")) \
        .select("row", "item_at", "s.gram", "s.n", "s.words")


def _aligned(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str) -> DataFrame:
    """One row per passage and item that align: doc_id, key (of the document's
    row), item_id, score, start_word, end_word, seeds."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("key"))
    items = stage(benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
                  .mapInArrow(released(_items), "item_id long, words binary, grams array<struct<at int, n int, gram bigint>>")
                  .withColumn("row", F.xxhash64("item_id", "words")).dropDuplicates(["row"]), "items")
    seeds = stage(seeds_of(items), "seeds")
    own = seeds.groupBy("row").agg(F.count_if(F.col("n") == GRAM).alias("own"))
    need = F.greatest(F.lit(1), F.floor(F.ceil(F.col("own") / 2) * SEED_SHARE)).alias("need")
    lengths = [r["n"] for r in seeds.select("n").distinct().orderBy("n").collect()]
    reach = items.agg(F.max(F.octet_length("words"))).first()[0] or 0
    if not lengths:
        return items.limit(0).select(F.lit(0).cast("long").alias("doc_id"), F.col("words").alias("key"), "item_id", F.lit(0.0).alias("score"), *[
            F.lit(0).cast("long").alias(c) for c in ("start_word", "end_word", "seeds")])
    wide = _widths(seeds)
    seeds = stage(seeds.join(own.select("row", need), "row").select("row", "gram", "item_at", "need"), "needs")
    passages = stage(docs.mapInArrow(released(_passages(wide, lengths)), _PASSAGE), "passages")
    hits = join_staged(passages.select("pid", F.inline("hits")), seeds, "gram", "inner", row_bytes=40)
    pairs = stage(hits.groupBy("pid", "row").agg(F.countDistinct("item_at").alias("seeds"), F.first("need").alias("need"))
                  .filter("seeds >= need").select("pid", "row", "seeds"), "pairs")
    both = join_staged(passages.select("pid", "doc_id", "key", "first", F.col("words").alias("passage")), pairs, "pid", "inner", row_bytes=32)
    both = join_staged(both, items.select("row", "item_id", "words"), "row", "inner", row_bytes=max(64, reach + 32))
    return both.select("doc_id", "key", "item_id", "first", "seeds", "passage", "words").mapInArrow(
        released(_align), "doc_id long, key binary, item_id long, score double, start_word long, end_word long, seeds long")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per contaminated pair: doc_id, item_id, score, start_word,
    end_word (of the aligned passage in the document), seeds."""
    best = F.max(F.struct("score", (-F.col("start_word")).alias("s"), "end_word", "seeds")).alias("b")
    return _aligned(docs, benchmark, id_col, text_col, item_col, item_text_col).groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "b.score", (-F.col("b.s")).alias("start_word"), "b.end_word", "b.seeds")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a test item, all columns as they were."""
    lost = _aligned(docs, benchmark, id_col, text_col, "item_id", "text").select("key", F.lit(False).alias("once")).distinct()
    return without(docs, id_col, text_col, stage(lost, "lost"))
