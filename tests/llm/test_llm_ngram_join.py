import random
import re

import numpy as np
import pyarrow as pa
import pytest

from pricelake.llm import block_links as B
from pricelake.llm import ngram_join as J

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows, num=80, den=100):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                up[root(i)] = root(j)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(k) and rows[j][0] is not None]
        out.append((i, len(sets[k]), min(ids) if ids else None))
    return sorted(out, key=str)


def corpus(seed, groups=25):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(30)]           # stands in documents that are otherwise unlike
    rows = []
    for g in range(groups):
        base = [word() for _ in range(r.randint(30, 160))]
        for _ in range(r.choice([1, 2, 3, 9, 60 if g == 0 else 4])):
            w = list(base)
            for _ in range(r.randint(0, 3)):
                k = r.randrange(len(w))
                w[k:k + r.randint(0, 2)] = [word() for _ in range(r.randint(0, 2))]
            rows.append((len(rows), " ".join(w)))
    for _ in range(60):
        own = [word() for _ in range(r.randint(5, 40))]
        rows.append((len(rows), " ".join(own + passage)))
    rows += [(i + 5000, t) for i, t in rows[:20]]   # exact copies
    r.shuffle(rows)
    return rows


EDGE = [(900, None), (901, ""), (902, " \n\t "), (903, "one two"), (904, "ONE  two"), (905, "one two three"), (906, "a b c d e"),
        (906, "a b c d e"), (None, "a b c d e"), (None, "lonely words only here now"), (None, "lonely words only here now"),
        (907, "same same " * 50), (908, "same same same " * 50), (909, "x" * 600_000 + " y z"), (910, "x" * 600_000 + " y z")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, make, monkeypatch, seed):
    rows = corpus(seed) + EDGE
    if seed == 2:                   # long columns, many column blocks and chunks, blocks in many parts
        monkeypatch.setattr(J, "LIST", 3)
        monkeypatch.setattr(J, "CHUNK", 400)
        monkeypatch.setattr(J, "BLOCK_ENTRIES", 300)
        monkeypatch.setattr(B, "BLOCK_SHINGLES", 400)
        monkeypatch.setattr(B, "LEADERS", 2)
    if seed == 3:                   # a rank for none
        monkeypatch.setattr(J, "FREQUENT", 1 << 40)
        monkeypatch.setattr(J, "LIST", 8)
        monkeypatch.setattr(B, "BLOCK_SHINGLES", 100)
    got = J.classes(make(rows).repartition(4))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("limit", [2, 5, 16, 64])
def test_column_product_loses_no_link(limit):
    """Over all columns, every link is a pair at its bound or in a chain's block."""
    r = random.Random(limit)
    num, den = 80, 100
    sets = []
    for _ in range(30):
        base = np.unique(np.array([r.randrange(1 << 40) for _ in range(r.randint(1, 60))], dtype=np.uint64))
        for _ in range(r.randint(1, 6)):
            keep = base[[r.random() > 0.08 for _ in base]]
            sets.append(np.union1d(keep, np.array([r.randrange(1 << 40) for _ in range(r.randint(0, 3))], dtype=np.uint64)))
    sets = [s for s in sets if len(s)]
    key, node, n, end = [], [], [], []
    for k, s in enumerate(sets):
        m = len(s) - -(-num * len(s) // den) + 1
        key += s[:m].tolist()
        node += [k] * m
        n += [len(s)] * m
        end += [int(s[m - 1])] * m
    (a, b, both, bound), (c, d) = J.column_product(np.array(key, np.uint64), np.array(node), np.array(n, np.int32),
                                                   np.array(end, np.uint64), num, den, limit)
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for x, y in [*zip(a[both >= bound], b[both >= bound], strict=True), *zip(c, d, strict=True)]:
        up[root(x)] = root(y)
    for i in range(len(sets)):
        for j in range(i):
            o = len(np.intersect1d(sets[i], sets[j]))
            if den * o >= num * (len(sets[i]) + len(sets[j]) - o):
                assert root(i) == root(j)
    if limit == 64:
        assert len(a) < len(sets) ** 2 / 8


def test_exact_links_join_what_all_pairs_join():
    r = random.Random(5)
    sets = []
    for _ in range(6):
        base = [r.randrange(1 << 40) for _ in range(40)]
        sets += [np.unique(np.array(r.sample(base, r.randint(25, 40)), dtype=np.uint64)) for _ in range(12)]
    want = [(i, j) for i in range(len(sets)) for j in range(i)
            if 100 * (o := len(np.intersect1d(sets[i], sets[j]))) >= 80 * (len(sets[i]) + len(sets[j]) - o)]
    for labels in (None, np.arange(len(sets)) // 3 * 7):
        def parts(edges, labels=labels):
            up = list(range(len(sets)))

            def root(x):
                while up[x] != x:
                    x = up[x]
                return x
            known = [] if labels is None else [(i, j) for i in range(len(sets)) for j in range(i) if labels[i] == labels[j]]
            for i, j in [*edges, *known]:
                up[max(root(i), root(j))] = min(root(i), root(j))
            return [root(i) for i in range(len(sets))]
        got = B.exact_links(sets, 80, 100, labels)
        assert parts(got) == parts(want)
        assert len(got) < len(sets)


def phrases_in_unlike_texts():
    """Texts of their own words with passages that 40 of them share, and a near copy of one."""
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    passages = [" ".join(word() for _ in range(14)) for _ in range(3)]
    rows = [(k, " ".join([word() for _ in range(70 + k % 7)]) + " " + " ".join(passages[(k + j) % 3] for j in range(2))) for k in range(60)]
    return [*rows, (60, rows[0][1] + " last")]


def test_passages_that_never_repeat_in_a_chunk_join_no_blocks(spark, make, monkeypatch):
    """A shingle of many rows is a late column, however few of its rows a task holds."""
    seen = {}

    def confirmed(docs, text_col, nodes, edges, *rest):
        seen["edges"] = edges.count()
        return B.confirmed(docs, text_col, nodes, edges, *rest)
    monkeypatch.setattr(J, "LIST", 4)
    monkeypatch.setattr(J, "confirmed", confirmed)
    rows = phrases_in_unlike_texts()
    got = J.classes(make(rows).repartition(len(rows), "doc_id"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
    assert seen["edges"] == 1                       # the near copies alone


def test_every_shingle_is_counted():
    """Counts of packed places, of which a chunk holds few, are those of all chunks together."""
    r = np.random.default_rng(4)
    shingles = np.unique(r.integers(0, 1 << 63, 300).astype(np.uint64) << np.uint64(1))
    texts = [shingles[r.random(len(shingles)) < share] for share in (0.02, 0.5, 1, 1, 1)]
    rows = []
    for s in texts:
        place = np.sort((s >> np.uint64(32)).astype(np.uint32))
        for g in range(J.GROUPS):
            x = place[place >> 24 == g]
            if len(x):
                rows.append((g, np.bincount((x >> 16) & 255, minlength=256).astype(np.uint32).tobytes() + x.astype(np.uint16).tobytes()))
    rows.sort(key=lambda x: x[0])
    batch = pa.RecordBatch.from_pydict({"group": pa.array([g for g, _ in rows], pa.int32()), "places": pa.array([d for _, d in rows], pa.binary())})
    width, table = 20, np.zeros((J.GROUPS, 1 << 12), np.uint8)
    for b in J._counted(width, 32, 4)([batch.slice(0, 7), batch.slice(7)]):
        for g, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            table[g] = np.frombuffer(x, np.uint8)
    held = np.array([sum(x in s for s in texts) for x in shingles])
    want = np.zeros(1 << width, np.uint8)
    np.maximum.at(want, (shingles >> np.uint64(64 - width)).astype(np.int64), np.where(held >= 4, 1, 0).astype(np.uint8))
    assert (table.ravel() == want).all()
    keys = J._keys(shingles, table.ravel())
    frequent = table.ravel()[shingles >> np.uint64(64 - width)] > 0
    assert keys[~frequent].max() < keys[frequent].min()
    assert len(np.unique(keys)) == len(shingles)


def test_empty_table(spark, make):
    assert J.classes(make([])).count() == 0
    assert [tuple(r) for r in J.classes(make([(1, None)])).collect()] == [(1, 0, 1)]
