"""Quality classifier: hashed word n-gram logistic regression by FTRL-proximal.

Tokens are runs of letters and digits, and runs of punctuation; a feature is a
token or a pair of neighbouring tokens hashed to ``2 ** BITS`` places, its
value the square root of the count, the row scaled to length one. A token that
repeats one of the two before it gives the pair "same, same" as well, whatever
the token. Training
takes at most ``TRAIN_ROWS`` labelled rows, those with the smallest hash of
their id, in ``EPOCHS`` passes in hash order. Features are made where the
texts lie; the bounded, hashed sample meets in one task, which runs the
follow-the-regularised-leader updates. The weights (2 ** BITS + 1 floats) are
broadcast, and a score is one sparse dot product over the whole text.

Defined cases: a null or empty text has only the bias, so its score is the
model's base rate; labels without a quality or a document are not used; of
several labels of one id the smallest counts; without any label, or text, the
score is 0.5; a null ``doc_id`` is scored, is never a label, and is not held
out; repeated rows are scored each; of samples with one hash the smaller id comes
first; very long texts are scored whole, in blocks of words; packed rows keep columns
with clashing names apart; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from pricelake.llm import textvec
from pricelake.llm.common import released, stage

BITS = 18
GRAMS = (1, 2)
TRAIN_ROWS = 12_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 5.0, 1.0, 0.1, 1e-3
ACCEPT = 0.7
#: The hash of the pair "same, same".
SAME = 0x5A17E5A17E5A17E5


def held_out(doc_id: Column) -> Column:
    """True for the rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def features(col: pa.Array):
    """(first row, [(places, values), ...]) for slices of a text column."""
    for lo, _, data, offsets in textvec.text_chunks(col):
        _, _, h, b = textvec.words(data, offsets, textvec.TOKEN, textvec.AS_IS)
        grams = [textvec.ngrams(h, b, n) for n in GRAMS]
        cuts = [np.searchsorted(at, b) for _, at in grams]
        doc = np.repeat(np.arange(len(b) - 1), np.diff(b))
        again = np.zeros(len(h), dtype=bool)
        for back in (1, 2):
            again[back:] |= (h[back:] == h[:-back]) & (doc[back:] == doc[:-back])
        out = []
        for i in range(len(b) - 1):
            same = np.full(np.count_nonzero(again[b[i]:b[i + 1]]), SAME, dtype=np.uint64)
            f = np.concatenate([*(g[c[i]:c[i + 1]] for (g, _), c in zip(grams, cuts, strict=True)), same])
            place, n = np.unique((f >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)
            out.append((place, np.sqrt(n / max(1, n.sum()))))
        yield lo, out


def _featurize(batches):
    for b in batches:
        for lo, rows in features(b.column(2)):
            yield pa.RecordBatch.from_pydict({
                "rank": b.column(0).slice(lo, len(rows)), "label": b.column(1).slice(lo, len(rows)),
                "places": pa.array([p.astype("<i4").tobytes() for p, _ in rows], pa.binary()),
                "vals": pa.array([v.astype("<f4").tobytes() for _, v in rows], pa.binary())})


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> np.ndarray:
    """Weights (the bias last) after EPOCHS passes of FTRL-proximal updates."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(zz, nn):
        return np.where(np.abs(zz) <= L1, 0.0, -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(nn)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for p, v, y in rows:
            p, v = np.append(p, size - 1), np.append(v, 1.0)
            zz, nn = z[p], n[p]
            w = weights(zz, nn)
            g = (1.0 / (1.0 + np.exp(-np.clip(w @ v, -35, 35))) - y) * v
            grown = nn + g * g
            z[p] = zz + g - (np.sqrt(grown) - np.sqrt(nn)) / ALPHA * w
            n[p] = grown
    return weights(z, n)


def _fit(batches):
    rows = []
    for b in batches:
        rows += [(np.frombuffer(p.as_py(), "<i4"), np.frombuffer(v.as_py(), "<f4"), y.as_py())
                 for y, p, v in zip(b.column(1), b.column(2), b.column(3), strict=True)]
    w = ftrl(rows)
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_pydict({"place": at, "weight": w[at]})


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> np.ndarray:
    """Weights learnt from the labelled rows that are not held out."""
    ids = F.col("__id")
    sample = (labels.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__label"))
              .filter(F.col("__id").isNotNull() & F.col("__label").isNotNull() & ~held_out(ids))
              .groupBy("__id").agg(F.min("__label").alias("__label"))
              .withColumn("__rank", F.xxhash64("__id", F.lit(4))).orderBy("__rank", "__id").limit(TRAIN_ROWS))
    sample = stage(sample, "sample")
    rows = (docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(sample), "__id")
            .select("__rank", F.col("__label").cast("int"), "__text")
            .mapInArrow(released(_featurize), "rank long, label int, places binary, vals binary"))
    weights = rows.repartition(1).sortWithinPartitions("rank", "places").mapInArrow(released(_fit), "place long, weight double")
    out = np.zeros((1 << BITS) + 1)
    found = weights.toArrow()            # at most 2 ** BITS + 1 rows
    out[found.column("place").to_numpy()] = found.column("weight").to_numpy()
    return out


def _scorer(shared):
    def run(batches):
        w = shared.value
        for b in batches:
            s = np.concatenate([[w[p] @ v for p, v in rows] for _, rows in features(b.column(1))] or [[]])
            p = 1.0 / (1.0 + np.exp(-np.clip(s + w[-1], -35, 35)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p, pa.float64())], names=["row", "score"])
    return run


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, score): the columns ``keep`` (all) of every row as a struct, with its score."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"),
                         F.col(text_col).alias("text"))
    schema = StructType([packed.schema["row"], StructField("score", DoubleType())])
    return packed.mapInArrow(released(_scorer(shared)), schema)


def drop_rejected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows scored below ACCEPT, all columns as they were."""
    return score(docs, train(docs, labels, id_col, text_col), text_col).filter(F.col("score") >= ACCEPT).select("row.*")
