import random
import re

import numpy as np
import pyarrow as pa
import pytest

from pricelake.llm import block_links as B
from pricelake.llm import near_dedup as N
from pricelake.llm import textvec
from pricelake.llm.components import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4)))


def brute(rows, num, den):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and den * both >= num * len(a | sets[j]):
                up[root(i)] = root(j)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(k) and rows[j][0] is not None]
        c = min(ids) if ids else None
        out.append((i, len(sets[k]), c, i == c))
    return sorted(out, key=str)


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    rows = []
    for _ in range(40):
        base = [word() for _ in range(r.randint(40, 160))]
        for _ in range(r.randint(1, 9)):
            w = list(base)
            for _ in range(r.randint(0, 4)):
                w[r.randrange(len(w))] = word()
            rows.append((len(rows), " ".join(w)))
    r.shuffle(rows)
    return rows


EDGE = [(900, None), (901, ""), (902, " \n\t "), (903, "one two"), (904, "ONE  two"), (905, "one two three"),
        (906, "a b c d e"), (906, "a b c d e"), (None, "a b c d e"), (None, "lonely words only here now"),
        (907, "same same " * 50), (908, "same same same " * 50), (909, "x" * 3_000_000 + " y z"), (910, "x" * 3_000_000 + " y z")]


def test_matches_brute_force_at_both_thresholds(make):
    rows = corpus(3) + EDGE
    for num in (85, 80):
        got = sorted((tuple(r) for r in N.near_groups(make(rows), num=num).collect()), key=str)
        assert got == brute(rows, num, 100)


def test_large_group_dealt_into_parts_and_diverse_regions(make, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_SHINGLES", 1500)
    rows = corpus(5)
    r = random.Random(9)
    base = [f"w{k}" for k in range(120)]
    for k in range(60):                  # a dense group around one text
        w = list(base)
        for _ in range(3):
            w[r.randrange(120)] = f"e{r.random()}"
        rows.append((2000 + k, " ".join(w)))
    got = sorted((tuple(x) for x in N.near_groups(make(rows)).collect()), key=str)
    assert got == brute(rows, 85, 100)


def test_neighbours_in_order_share_the_longest_prefixes():
    """Unlike nodes of one region do not part a pair; short prefixes serve sparse regions."""
    r = np.random.default_rng(0)
    label = r.integers(0, 256, (3000, N.LABEL + 1), dtype=np.uint8)
    label[:, 0] = 3
    label[:2000, 1:5] = 7                           # a crowded region: one prefix, unlike beyond
    pair = [(k, k + 1) for k in range(0, 2000, 200)] + [(2500, 2501)]
    for x, y in pair:
        label[y] = label[x]
        label[y, [8, 11, 15]] ^= 1
    label[2501, 5] ^= 1                             # three values only, in a sparse region
    order = np.lexsort(label.T[::-1])
    node = np.arange(3000)
    a, b = N.neighbours(label[order], node[order])
    assert {tuple(sorted(e)) for e in zip(a.tolist(), b.tolist(), strict=True)} == set(pair)
    # in batches the same pairs come once each
    rows = [pa.RecordBatch.from_pydict({"label": [x.tobytes() for x in label[order[k:k + 7]]], "node": node[order[k:k + 7]]})
            for k in range(0, 3000, 7)]
    got = [tuple(sorted(e)) for t in N._candidates(rows) for e in zip(t.column(0).to_pylist(), t.column(1).to_pylist(), strict=True)]
    assert sorted(got) == sorted(pair)


def test_rows_without_or_with_one_id_take_linear_time(make):
    """A third of all rows under null or one repeated id: every text meets its own group only."""
    r = random.Random(2)
    rows = []
    for k in range(900):
        w = [f"g{k // 2}w{j}" for j in range(60)]
        if k % 2:
            w[r.randrange(60)] = "edit"
        rows.append((None if k < 300 else 5 if k < 600 else k, " ".join(w)))
    got = sorted((tuple(x) for x in N.near_groups(make(rows), num=80).collect()), key=str)
    assert got == brute(rows, 80, 100)


def test_empty_table_and_drop(make):
    assert N.near_groups(make([])).count() == 0
    rows = [(1, "a b c d e f g"), (2, "A b c d e f g"), (3, "other words in this one text"), (None, None)]
    kept = N.drop_near_copies(make(rows))
    assert kept.columns == make(rows).columns
    assert sorted((x.doc_id for x in kept.collect()), key=str) == [1, 3, None]


def test_components_of_paths_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(0, 50)] + [(1000, 1000 + k) for k in range(1, 80)] + [(7, 7), (2000, 2001), (2001, 2000)]
    got = components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()
    sets = {}
    for r in got:
        sets.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, sets.values())) == sorted([list(range(51)), list(range(1000, 1080)), [2000, 2001]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block", [64, 1 << 21])
def test_word_hashes_do_not_depend_on_blocks(block, monkeypatch):
    texts = ["Ab  cd\tef", "", None, "é ü ab", "x" * 300 + " y", "cd", " ab\n"]
    want = None
    for b in (1 << 21, block):
        monkeypatch.setattr(textvec, "BLOCK", b)
        rows = []
        for _, _, data, offs in textvec.text_chunks(pa.array(texts), 1 << 20):
            _, _, h, bounds = textvec.words(data, offs)
            rows += [h[bounds[i]:bounds[i + 1]].tolist() for i in range(len(bounds) - 1)]
        assert want in (None, rows)
        want = rows
    assert [len(x) for x in want] == [3, 0, 0, 3, 2, 1, 1]
    assert want[0][0] == want[3][2] == want[6][0] and want[0][1] == want[5][0]


def test_one_row_of_each_group_stays_whatever_the_ids(make):
    say = lambda n, *end: " ".join([f"g{n}w{k}" for k in range(60)] + list(end))
    rows = [(1, say(1)), (None, say(1, "x")), (None, say(2)), (None, say(3)), (None, say(3, "y")), (None, None),
            (7, say(4)), (7, say(5)), (7, say(5, "z")), (2, say(4, "v")), (8, say(6)), (8, say(6)), (8, say(7)), (9, None)]
    kept = sorted(((r.doc_id, r.text) for r in N.drop_near_copies(make(rows)).collect()), key=str)
    texts = [t for _, t in kept]
    assert (1, say(1)) in kept and say(1, "x") not in texts                 # a null id loses to a number
    assert (None, say(2)) in kept                                           # and its namesakes stay
    assert (say(3) in texts) + (say(3, "y") in texts) == 1                  # a group without any id
    assert (2, say(4, "v")) in kept and (7, say(4)) not in kept
    assert ((7, say(5)) in kept) + ((7, say(5, "z")) in kept) == 1          # two texts of a group under one id
    assert kept.count((8, say(6))) == 1 and (8, say(7)) in kept and (9, None) in kept and (None, None) in kept
    assert len(kept) == 9
