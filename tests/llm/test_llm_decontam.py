import random

import numpy as np
import pyarrow as pa
import pytest

from pricelake.llm import decontam as D


def sw(a, b):
    """Plain Smith-Waterman score."""
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (D.MATCH if a[i - 1] == b[j - 1] else D.MISS),
                          h[i - 1][j] + D.GAP, h[i][j - 1] + D.GAP)
            best = max(best, h[i][j])
    return best


def world(seed=2):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    say = lambda n: [r.choice(words) for _ in range(n)]
    items = [(k, say(r.randint(12, 40))) for k in range(12)]
    docs = []
    for k in range(150):
        body = say(r.randint(5, 200))
        if k % 3 == 0:
            item = list(items[k % 12][1])
            for _ in range(len(item) * (k % 5) // 20):
                item[r.randrange(len(item))] = r.choice(words)
            at = r.randrange(len(body) + 1)
            body[at:at] = item
        docs.append((k, body))
    return docs, items


@pytest.fixture()
def bench(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


def test_scores_are_those_of_the_full_alignment(make, bench):
    docs, items = world()
    got = {(r.doc_id, r.item_id): r for r in D.contaminated(
        make([(i, " ".join(w).upper()) for i, w in docs]), bench([(i, ", ".join(w) + "!") for i, w in items])).collect()}
    want = {}
    for i, w in docs:
        for k, v in items:
            s = sw(v, w) / (D.MATCH * len(v))
            if s >= D.SCORE:
                want[i, k] = s
    assert got.keys() == want.keys() and len(want) > 30
    for k, s in want.items():
        assert abs(got[k].score - s) < 1e-12
    for (i, k), r in got.items():
        w = dict(docs)[i][r.start_word:r.end_word]
        assert abs(sw(dict(items)[k], w) / (D.MATCH * len(dict(items)[k])) - r.score) < 1e-12


def test_edge_cases(make, bench):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(1, None), (2, ""), (3, item), (3, item), (None, item), (4, "x " * 100_000 + item + " y" * 100_000),
            (5, "alpha beta"), (6, "clean words that do not match anything at all")]
    items = bench([(1, item), (1, item), (2, None), (3, ""), (4, "alpha beta"), (None, item + " lambda")])
    got = sorted(((r.doc_id, r.item_id) for r in D.contaminated(make(rows), items).collect()), key=str)
    assert got == sorted([(d, i) for d in (3, 4, None) for i in (1, None)], key=str)
    kept = D.drop_contaminated(make(rows), items)
    assert kept.columns == make(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 5, 6]
    assert D.contaminated(make([]), items).count() == 0
    assert D.contaminated(make(rows), bench([])).count() == 0


def test_an_item_in_most_documents_is_still_found(make, bench):
    item = "one common passage that has been copied into very many pages of the web"
    rows = [(k, f"start {k} {item} end {k}") for k in range(300)] + [(1000 + k, f"own words {k} only") for k in range(30)]
    got = {r.doc_id for r in D.contaminated(make(rows), bench([(1, item)])).collect()}
    assert got == set(range(300))


def test_vector_alignment_equals_the_plain_one():
    r = random.Random(4)
    for _ in range(200):
        a = [r.randrange(5) for _ in range(r.randint(1, 12))]
        b = [r.randrange(5) for _ in range(r.randint(1, 15))]
        assert D.smith_waterman(np.array(a), np.array(b))[0] == sw(a, b)


def every_fourth_replaced(words):
    return [f"edit{k}" if k % 4 == 3 else w for k, w in enumerate(words)]


def test_every_fourth_word_replaced_alone_and_beside_an_exact_copy(make, bench):
    item = [f"w{k}" for k in range(40)]
    edited = every_fourth_replaced(item)
    assert sw(item, edited) / (D.MATCH * len(item)) >= D.SCORE
    alone = [(1, " ".join(["before", *edited, "after"])), (3, "clean words that do not match anything at all")]
    exact = (2, " ".join(["start", *item, "end"]))
    items = bench([(7, " ".join(item))])
    assert {r.doc_id for r in D.contaminated(make(alone), items).collect()} == {1}
    assert {r.doc_id for r in D.contaminated(make([*alone, exact]), items).collect()} == {1, 2}
    assert [r.doc_id for r in D.drop_contaminated(make([*alone, exact]), items).collect()] == [3]


def test_short_items_with_edits_are_found_while_three_words_in_a_row_stand(make, bench):
    r = random.Random(6)
    items = [(k, [f"i{k}w{j}" for j in range(10)]) for k in range(60)]
    rows, want = [], set()
    for k, w in items:
        at = set(r.sample(range(10), 3))
        edited = [f"e{k}x{j}" if j in at else x for j, x in enumerate(w)]
        rows += [(k, " ".join(edited)), (1000 + k, " ".join(w))]
        run = any(not at & {j, j + 1, j + 2} for j in range(8))
        want |= {(k, k)} if run and sw(w, edited) / 20 >= D.SCORE else set()
    got = {(x.doc_id, x.item_id) for x in D.contaminated(make(rows), bench([(k, " ".join(w)) for k, w in items])).collect()}
    assert got == want | {(1000 + k, k) for k in range(60)} and len(want) > 20


def test_clean_rows_that_share_an_id_with_a_contaminated_one_stay(make, bench):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    clean = [(None, "clean words of a row without an id"), (None, None), (3, "another text under the same number"), (3, "")]
    kept = D.drop_contaminated(make([*clean, (None, item), (3, f"so {item} it is"), (4, item)]), bench([(1, item)]))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(clean, key=str)


def test_a_phrase_that_all_items_share_makes_no_pairs(spark, make, bench):
    """Items that all begin alike meet only their own copies; results equal full alignment."""
    r = random.Random(11)
    phrase = "which of the following".split()
    items = [(k, phrase + [f"i{k}w{j}" for j in range(r.randint(6, 14))]) for k in range(40)]
    rows = [(k, [f"d{k}x{j}" for j in range(20)] + phrase + [f"d{k}y{j}" for j in range(20)]) for k in range(200)]
    for k, w in items[:20]:
        e = list(w)
        for _ in range(k % 3):
            e[r.randrange(len(e))] = "edited"
        rows.append((1000 + k, ["so", *e, "then"]))
    docs, asked = make([(i, " ".join(w)) for i, w in rows]), bench([(i, " ".join(w)) for i, w in items])
    got = {(x.doc_id, x.item_id) for x in D.contaminated(docs, asked).collect()}
    want = {(i, k) for i, w in rows for k, v in items if 2 * sw(v, w) >= 2 * D.MATCH * len(v) * D.SCORE}
    assert got == want and len(want) == 20
    # no gram of the phrase alone is a seed
    batch = next(D._items([pa.RecordBatch.from_pydict({"i": [k for k, _ in items], "t": [" ".join(w) for _, w in items]})]))
    seeds = D.seeds_of(spark.createDataFrame([(k, b.as_py(), g.as_py()) for k, b, g in zip(range(40), batch.column(1), batch.column(2), strict=True)],
                                             "row long, words binary, grams array<struct<at int, n int, gram bigint>>")).collect()
    assert {x.n for x in seeds if x.item_at == 0} == {5} and {x.n for x in seeds if x.item_at == 4} == {3}


def test_templated_items_all_find_a_copy(make, bench):
    """Items alike but for the last word: a copy of one is a near copy of all."""
    head = [f"t{j}" for j in range(20)]
    items = [(k, [*head, f"end{k}"]) for k in range(30)]
    got = {(x.doc_id, x.item_id) for x in D.contaminated(make([(1, " ".join(["a", *items[3][1], "b"])), (2, "clean text of its own words")]),
                                                          bench([(i, " ".join(w)) for i, w in items])).collect()}
    assert got == {(1, k) for k in range(30)}
