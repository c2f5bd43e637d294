import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from pricelake.llm import spelling as S

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(LOW)
            h = crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                n[w] += 1
    n = {w: k for w, k in n.items() if k >= 2}
    form, near = {}, {}
    for w in n:
        hit = [x for x in n if abs(len(x) - len(w)) <= 1 and one_edit(w, x)]
        near[w] = len(hit)
        best = min(hit, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        r = w
        while form[r]:
            r = form[r]
        out.append((w, n[w], near[w], form[w], n[form[w]] if form[w] else None, r))
    return sorted(out)


def corpus(seed):
    r = random.Random(seed)
    part = ["an", "er", "tion", "ea", "É", "ß", "on", "Th", "×q", "aa"]
    base = ["".join(r.choice(part) for _ in range(r.randint(3, 6))) for _ in range(40)]
    def typo(w):
        k = r.randrange(len(w))
        return r.choice([w[:k] + w[k + 1:], w[:k] + r.choice("aeoß") + w[k + 1:], w[:k] + r.choice("aeoß") + w[k:]])
    rows = []
    for i in range(250):
        w = [r.choice(base[:10] if r.random() < 0.7 else base) for _ in range(r.randint(1, 60))]
        w = [typo(x) if r.random() < 0.1 else x for x in w]
        rows.append((i, r.choice([" ", "-", "1", "_"]).join(w)))
    return rows


EDGE = [(900, None), (901, ""), (902, " 12 "), (None, "nameless nameless namelesz"), (None, "nameless namelesz"),
        (903, "z" * 5000 + " " + "z" * 5001), (904, "z" * 5000 + " " + "z" * 5001), (905, "chained " * 1500),
        (906, "chainedx " * 120 + "chainedxy " * 8 + "chainedxyz chainedxyz"), (907, "Ünlocker ünlocker"), (908, "short six")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, make, seed):
    rows = corpus(seed) + EDGE
    got = S.variants(make(rows).repartition(3))
    assert sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in got.collect()) == brute(rows)


def test_counts_are_handed_on_in_parts(monkeypatch):
    rows = [(i, t) for i, t in corpus(3) if i % 7]
    batch = pa.RecordBatch.from_pydict({"i": pa.array([i for i, _ in rows], pa.int64()), "t": [t for _, t in rows]})
    whole = Counter()
    for limit in (10 ** 9, 30):
        monkeypatch.setattr(S, "HELD_WORDS", limit)
        parts = list(S._count([batch]))
        got = Counter()
        for b in parts:
            for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                got[w] += n
        assert whole in (Counter(), got) and (limit > 30) == (len(parts) == 1)
        whole = got


@pytest.mark.parametrize("held", [1 << 20, 40])
def test_neighbourhood_is_whole(monkeypatch, held):
    """Every reduced word within one edit, and no other, has its hash there."""
    monkeypatch.setattr(S, "HELD_HASHES", held)
    r = random.Random(3)
    for n in (1, 2, 5):
        word = "".join(r.choice("aaabcdefghijk") for _ in range(n))
        s = [ord(c) % S.SYMBOLS for c in word]
        edits = {tuple(s)} | {tuple(s[:k] + s[k + 1:]) for k in range(n)}
        edits |= {tuple(s[:k] + [c] + s[k + 1:]) for k in range(n) for c in range(S.SYMBOLS)}
        edits |= {tuple(s[:k] + [c] + s[k:]) for k in range(n + 1) for c in range(S.SYMBOLS)}
        want = {int(S.reduced(["".join(chr(S.SYMBOLS * 8 + c) for c in e)])[0]) for e in edits if e}
        got = np.concatenate([h for _, h in S.neighbourhood([word])]).tolist()
        assert want <= set(got) and len(set(got)) == len(got) == len(edits)


def test_empty_table(spark, make):
    assert S.variants(make([])).count() == 0
