import hashlib
import random
import re

from pricelake.llm import exact_dedup as X


def brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[norm(t)]
        known = [x for x in ids if x is not None]
        keep = min(known) if known else None
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


EDGE = [(3, "a  b\tc"), (1, "a b c"), (2, "A b c"), (4, None), (5, ""), (6, "x"), (6, "x"), (None, "a b c"), (None, "solo"),
        (7, " \n"), (8, " "), (9, "é ü"), (10, "w " * 200_000), (11, "w\n" * 200_000)]


def test_matches_brute_force_with_edge_cases(make):
    rows = EDGE + [(100 + k, f"text {k % 37}") for k in range(500)]
    got = sorted((tuple(r) for r in X.exact_groups(make(rows)).collect()), key=str)
    assert got == brute(rows)


def test_drop_keeps_one_row_of_each_group_and_all_columns(make):
    docs = make(EDGE)
    kept = X.drop_copies(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([1, 2, 4, 6, None, 7, 9, 10], key=str)
    row = next(r for r in kept.collect() if r.doc_id == 2)
    assert row["__lost"] == "__lost2" and row["sha"] == "sha2"


def test_empty_table(make):
    assert X.exact_groups(make([])).count() == 0
    assert X.drop_copies(make([])).count() == 0


def test_filter_never_clears_a_copy_and_clears_most_others(spark, make):
    r = random.Random(1)
    rows = [(k, f"{r.random()}") for k in range(4000)] + [(5000 + k, f"twin {k // 2}") for k in range(400)]
    _, flagged, _ = X.copy_groups(make(rows))
    by = {x.doc_id: x.maybe for x in flagged.collect()}
    assert all(by[5000 + k] for k in range(400))
    assert sum(by[k] for k in range(4000)) < 400


def test_saturated_filter_stays_exact(make, monkeypatch):
    monkeypatch.setattr(X, "SLOTS_PER_ROW", 0)
    rows = [(k, f"t{k % 90}") for k in range(300)]
    got = sorted((tuple(r) for r in X.exact_groups(make(rows)).collect()), key=str)
    assert got == brute(rows)
