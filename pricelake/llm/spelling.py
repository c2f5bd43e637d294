"""Spelling variants by reduced-alphabet generation.

1. Words: one pass over the texts counts the runs of letters of a document, takes
   one letter out of those whose hash says so, and keeps words of ``MIN_LENGTH``
   code points; counts are summed per task, then over all documents.
2. Reduced words: every letter becomes one of ``SYMBOLS`` symbols (its code point
   modulo ``SYMBOLS``). Two words that differ by one edit have reduced words that
   are equal or differ by one edit. For each word the full neighbourhood of its
   reduced word is made (itself, all deletions, replacements and insertions over
   the small alphabet: about 2 * ``SYMBOLS`` a letter instead of 2 * 90), as 64-bit
   hashes from running sums, in linear time.
3. Join: a bitmap of the reduced vocabulary, 32 places a word up to ``MAX_BITS``,
   drops most neighbours before the shuffle; those left are joined to the reduced
   vocabulary. Both sides of every near pair generate each other.
4. Verify: the original strings of a pair differ by exactly one edit.
5. A word's form is its most frequent near word, if ten times as frequent; roots
   follow the forms by pointer doubling (each step multiplies n by ten, so chains
   are short).

A frequent word is one row from the first shuffle on. Defined cases: null and empty
texts have no words; a null ``doc_id`` is the empty string in the hash; repeated
rows count again; very long words are taken in blocks of positions; only the named
columns are read, so further columns with any names do no harm; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm import textvec
from pricelake.llm.common import in_bitmap, key_bitmap, released, stage

# What a run is, which runs lose a code point, which words count.
RUN = r"[A-Za-zÀ-ÿ]+"
CUT_EVERY = 31
MIN_LENGTH = 7
MIN_COUNT = 2
FORM_TIMES = 10

SYMBOLS = 8
MIN_BITS, MAX_BITS, PLACES = 16, 27, 32
#: Words a task counts before it hands the counts on; hashes made at once.
HELD_WORDS, HELD_HASHES = 400_000, 1 << 20

U = np.uint64
_P = 0x9E3779B97F4A7C15 | 1
_STEP, _BACK = U(_P), U(pow(_P, -1, 1 << 64))


def words_of(doc_id, text: str, run) -> Counter:
    """The words of one text with their counts."""
    out = Counter()
    name = "" if doc_id is None else doc_id
    # bytes.lower() folds only A-Z
    for w, n in Counter(run(text.encode().lower().decode())).items():
        h = crc32(f"{name}:{w}".encode())
        if h % CUT_EVERY == 0:
            at = h % len(w)
            w = w[:at] + w[at + 1:]
            if len(w) < MIN_LENGTH:
                continue
        out[w] += n
    return out


def _count(batches):
    # a run shorter than MIN_LENGTH never makes a word
    run = re.compile(RUN[:-1] + f"{{{MIN_LENGTH},}}").findall
    held = Counter()

    def rows():
        return pa.RecordBatch.from_pydict({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})

    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if t:
                for w, n in words_of(i, t, run).items():
                    held[w] += n
                if len(held) > HELD_WORDS:
                    yield rows()
                    held.clear()
    if held:
        yield rows()


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: every word that occurs ``MIN_COUNT`` times."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(released(_count), "word string, n long").groupBy("word") \
        .agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def _symbols(words: list[str]) -> np.ndarray:
    """Symbols 1 to SYMBOLS of words of one length, a row a word."""
    cp = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
    return (cp % SYMBOLS + 1).astype(U)


def _powers(n: int) -> np.ndarray:
    p = np.full(n, _STEP)
    p[0] = U(1)
    return np.cumprod(p)


def _hash(total: np.ndarray) -> np.ndarray:
    return textvec.mix(total).view(np.int64)


def reduced(words: list[str]) -> np.ndarray:
    """Hashes of the reduced words (words of one length)."""
    s = _symbols(words)
    return _hash((s * _powers(s.shape[1])).sum(axis=1, dtype=U))


def neighbourhood(words: list[str]):
    """(row, hash) arrays of all reduced words within one edit of the reduced
    words of ``words`` (of one length), in blocks of positions. Each comes once: of
    edits with one result only the first in a run of equal symbols is made."""
    s = _symbols(words)
    m, n = s.shape
    p = _powers(n + 1)
    pre = np.zeros((m, n + 1), dtype=U)
    np.cumsum(s * p[:n], axis=1, out=pre[:, 1:])
    total = pre[:, -1:]
    every = np.arange(1, SYMBOLS + 1, dtype=U)
    after = np.concatenate([s, np.zeros((m, 1), dtype=U)], axis=1)       # the symbol at a position, 0 at the end
    before = np.concatenate([np.zeros((m, 1), dtype=U), s], axis=1)
    yield np.arange(m), _hash(total[:, 0])
    step = max(1, HELD_HASHES // (m * 2 * SYMBOLS))
    for lo in range(0, n + 1, step):
        at = np.arange(lo, min(lo + step, n + 1))
        put = (pre[:, at] + (total - pre[:, at]) * _STEP)[:, :, None] + every * p[at][:, None]
        made = [(put, every != after[:, at][:, :, None])]
        at = at[at < n]
        if len(at):
            made.append(((total - s[:, at] * p[at])[:, :, None] + every * p[at][:, None], every != s[:, at][:, :, None]))
            made.append((pre[:, at] + (total - pre[:, at + 1]) * _BACK, s[:, at] != before[:, at]))
        for h, new in made:
            row, *rest = np.nonzero(new)
            yield row, _hash(h[(row, *rest)])


def _by_length(b: pa.RecordBatch):
    """(rows, words) of a batch, groups of one length, each of bounded size."""
    words = np.array(b.column(0).to_pylist(), dtype=object)
    size = np.array([len(w) for w in words])
    for n in np.unique(size):
        rows = np.flatnonzero(size == n)
        step = max(1, HELD_HASHES // (2 * SYMBOLS * (int(n) + 1)))
        for lo in range(0, len(rows), step):
            at = rows[lo:lo + step]
            yield at, words[at].tolist()


def _reduce(batches):
    for b in batches:
        if b.num_rows:
            key = np.empty(b.num_rows, dtype=np.int64)
            for at, words in _by_length(b):
                key[at] = reduced(words)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(key)], ["word", "n", "key"])


def _generate(bits: np.ndarray):
    def run(batches):
        for b in batches:
            for at, words in _by_length(b) if b.num_rows else ():
                for row, h in neighbourhood(words):
                    met = np.flatnonzero(in_bitmap(bits, h))
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at[row[met]])), pa.array(h[met])], ["word", "key"])
    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n) of the words that differ by exactly one edit, both ways,
    from staged rows (word, n, key)."""
    width = int(np.clip(int(words.count() * PLACES).bit_length(), MIN_BITS, MAX_BITS))
    made = words.select("word").mapInArrow(released(_generate(key_bitmap(words, "key", width))), "word string, key long")
    met = made.join(words.select("key", F.col("word").alias("near"), F.col("n").alias("near_n")), "key")
    return met.filter(F.levenshtein("word", "near", 1) == 1).select("word", "near", "near_n")


def roots(form: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, from staged (word, form)."""
    at = form.select("word", F.col("form").alias("root"))
    while True:
        # one step of every root doubles the length that has been followed
        nxt = at.select(F.col("word").alias("root"), F.col("root").alias("far"))
        moved = stage(at.join(nxt, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("more")), "roots")
        at = moved.select("word", "root")
        if moved.filter("more").isEmpty():
            return at


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root."""
    words = stage(vocabulary(docs, id_col, text_col).mapInArrow(released(_reduce), "word string, n long, key long"), "words")
    best = near_pairs(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("form"))).alias("best"))
    near = best.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.n")).alias("form_n"))
    known = words.select("word", "n").join(near, "word", "left")
    strong = F.col("form_n") >= FORM_TIMES * F.col("n")
    known = stage(known.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                               F.when(strong, F.col("form")).alias("form"), F.when(strong, F.col("form_n")).alias("form_n")), "forms")
    rooted = roots(known.filter("form is not null").select("word", "form"))
    return known.join(rooted, "word", "left").withColumn("root", F.coalesce("root", "word"))
