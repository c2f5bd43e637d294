import math
import random
import re

import numpy as np
import pytest

from pricelake.llm import ranked_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(t):
    return TERM.findall((t or "").translate(LOW))


def brute(docs, items, k=10):
    docs = [(i, terms(t)) for i, t in docs]
    docs = [(i, t) for i, t in docs if t]
    n_docs, length = len(docs), sum(len(t) for _, t in docs)
    df = {}
    for _, t in docs:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for i, q in asked.items():
        found = []
        for d, t in docs:
            m = 100 - 90 + (90 * len(t) * n_docs) // length
            score = 0
            for x in q:
                tf = t.count(x)
                if tf:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                    score += w * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        found.sort()
        out += [(i, r, f[3], -f[0]) for r, f in enumerate(found[:k], 1)]
    return sorted(out, key=str)


def corpus(seed, n=300):
    r = random.Random(seed)
    words = ["the", "of", "and", "Ärger", "x1", "naïve"] + ["".join(r.choice("abcde") for _ in range(r.randint(1, 4))) for _ in range(120)]
    common = words[:20]
    docs = []
    for i in range(n):
        w = [r.choice(common if r.random() < 0.6 else words) for _ in range(r.randint(1, 60))]
        docs.append((i, r.choice([" ", ", ", "\n"]).join(w)))
    docs += [(1000 + i, docs[5][1]) for i in range(25)]              # equal scores, more than k of them
    items = [(i, " ".join(r.choice(words) for _ in range(r.randint(1, 15)))) for i in range(20)] + [(99, docs[5][1])]
    return docs, items


EDGE = [(2000, None), (2001, ""), (2002, "... !!"), (None, "the of x1"), (None, "the of x1"), (7, "Ärger THE ärger"),
        (2003, "naïve " * 60_000), (2004, "y" * 1_000_000 + " the")]
ASK = [(None, "x1 Ärger"), (200, None), (201, "  ?"), (202, "unknownterm"), (3, "naïve"), (3, "The the THE")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, make, monkeypatch, seed):
    docs, items = corpus(seed)
    docs, items = docs + EDGE, items + ASK
    if seed == 2:
        monkeypatch.setattr(S, "SHARD_POSTINGS", 200)
        monkeypatch.setattr(S, "BLOCK_TERMS", 40)
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, term string")
    got = S.search(make(docs).repartition(3), asked)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items)


def test_reading_stops_before_the_lists_end():
    """Clear winners are settled, scores and all, on the head of a long list."""
    n = 10_000
    doc = np.concatenate([np.arange(n), np.arange(20)])
    term = np.concatenate([np.zeros(n, int), np.ones(20, int)])
    impact = np.concatenate([np.full(20, 500), np.full(n - 20, 10), np.arange(1000, 1020)])
    lists = S.Lists(np.arange(n), doc, term, impact, 2)
    best, score = lists.top(np.array([0, 1]), np.array([1, 50]), 10)
    assert best.tolist() == list(range(19, 9, -1))
    assert score.tolist() == [50 * (1000 + d) + 500 for d in range(19, 9, -1)]
    assert lists.read == 40


def test_empty_tables(spark, make):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert S.search(make([]), some).count() == 0
    assert S.search(make([(1, "a b")]), none).count() == 0
