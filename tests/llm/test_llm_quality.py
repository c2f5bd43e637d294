import random
import zlib

import numpy as np

from pricelake.llm import quality as Q


def world(seed=1, n=900):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("aeioulnrst") for _ in range(r.randint(1, 8)))
    rows, labels = [], []
    for k in range(n):
        good = r.random() < 0.6
        words = [word() for _ in range(r.randint(1, 150))]
        rows.append((k, " ".join(w if good else w.upper() + r.choice(("!!", "***", "")) for w in words)))
        labels.append((k, int(good)))
    return rows, labels


def auc(pairs):
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


def test_held_out_accuracy_and_scores_by_plain_dot_product(spark, make):
    rows, labels = world()
    w = Q.train(make(rows), spark.createDataFrame(labels, "doc_id long, quality int"))
    got = {r.row.doc_id: r.score for r in Q.score(make(rows), w, keep=["doc_id"]).collect()}
    held = [k for k, _ in rows if zlib.crc32(str(k).encode()) % 4 == 2]
    assert len(held) > 100
    assert auc([(got[k], dict(labels)[k]) for k in held]) > 0.98
    import pyarrow as pa
    for k in held[:20]:
        (_, [(p, v)]), = Q.features(pa.array([dict(rows)[k]]))
        assert abs(got[k] - 1 / (1 + np.exp(-(w[p] @ v + w[-1])))) < 1e-9


def test_labels_of_held_out_rows_change_nothing(spark, make):
    rows, labels = world(n=200)
    flipped = [(k, 1 - y if zlib.crc32(str(k).encode()) % 4 == 2 else y) for k, y in labels]
    a = Q.train(make(rows), spark.createDataFrame(labels, "doc_id long, quality int"))
    b = Q.train(make(rows).repartition(5), spark.createDataFrame(flipped, "doc_id long, quality int"))
    assert np.array_equal(a, b)


def test_edge_cases(spark, make):
    rows, labels = world(n=80)
    schema = "doc_id long, quality int"
    labels = spark.createDataFrame([*labels, (1, 0), (None, 1), (5, None), (99999, 1)], schema)
    odd = [(None, "a b"), (7, None), (8, ""), (8, ""), (9, "w " * 300_000)]
    w = Q.train(make(rows + odd), labels)
    got = Q.score(make(odd), w, keep=["doc_id"]).select("row.doc_id", "score").collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    empty = {round(r.score, 12) for r in got if r.doc_id in (7, 8)}
    assert empty == {round(float(1 / (1 + np.exp(-w[-1]))), 12)}
    assert Q.score(make([]), w).count() == 0
    none = Q.train(make(rows), spark.createDataFrame([], schema))
    assert not none.any()
    assert {r.score for r in Q.score(make(odd), none).collect()} == {0.5}


def test_drop_keeps_accepted_rows_whole(spark, make):
    rows, labels = world(n=300)
    labels_df = spark.createDataFrame(labels, "doc_id long, quality int")
    docs = make(rows)
    kept = Q.drop_rejected(docs, labels_df)
    assert kept.columns == docs.columns
    w = Q.train(docs, labels_df)
    want = {r.row.doc_id for r in Q.score(docs, w).collect() if r.score >= Q.ACCEPT}
    assert {r.doc_id for r in kept.collect()} == want


def test_sample_is_bounded(spark, make, monkeypatch):
    monkeypatch.setattr(Q, "TRAIN_ROWS", 10)
    seen = []
    rows, labels = world(n=100)
    monkeypatch.setattr(Q, "stage", lambda df, name: seen.append(df.count()) or df)
    Q.train(make(rows), spark.createDataFrame(labels, "doc_id long, quality int"))
    assert seen == [10]
