import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pricelake.llm import packing as P


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_every_id_lies_in_one_piece_and_no_window_needs_padding(make, exact):
    rows = [(1, "one two three " * 900), (2, None), (3, ""), (4, "köln straße <|endoftext|> x"), (5, "日本語 テキスト"),
            (5, "日本語 テキスト"), (None, "no id"), (6, "w" * 30_000)] + [(10 + k, "the cat sat " * (k % 40)) for k in range(300)]
    got = P.pack(make(rows).repartition(2)).collect()
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append(r)
        docs[r.doc_id].append(r)
    for ps in seqs.values():
        ps.sort(key=lambda r: r.offset)
        assert [r.offset for r in ps] == list(np.cumsum([0] + [r.length for r in ps])[:-1])
        size = sum(r.length for r in ps)
        assert size <= 2048 and size & (size - 1) == 0
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append([*exact.encode(t or "", add_special_tokens=False).ids, 1])
    for i, texts in want.items():
        pieces = sorted(docs[i], key=lambda r: r.start)
        ids = [int(x) for r in pieces for x in np.frombuffer(r.token_ids, "<u4")]
        assert sorted(ids) == sorted(x for t in texts for x in t)
        if len(texts) == 1:
            assert ids == texts[0] and all(r.doc_tokens == len(ids) for r in pieces)
            assert [r.start for r in pieces] == list(np.cumsum([0] + [r.length for r in pieces])[:-1])


def test_crc_column_is_that_of_the_little_endian_ids(make):
    got = P.pack(make([(1, "some words here")])).withColumn("crc", F.crc32("token_ids")).collect()
    for r in got:
        assert r.crc == zlib.crc32(r.token_ids) and len(r.token_ids) == 4 * r.length


def test_empty_table(make):
    assert P.pack(make([])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 9000), max_size=60))
def test_windows_cover_all_tokens_exactly(lengths):
    windows = P.pack_lengths(lengths)
    seen = defaultdict(list)
    for w in windows:
        size = sum(n for _, _, n in w)
        assert 0 < size <= P.MAX_LEN and size & (size - 1) == 0
        for d, s, n in w:
            seen[d].append((s, n))
    for d, n in enumerate(lengths):
        at = 0
        for s, k in sorted(seen[d]):
            assert s == at
            at += k
        assert at == n


def test_short_documents_stay_whole_and_windows_take_their_tier():
    lengths = [100] * 200 + [900] * 40 + [1500] * 30
    windows = P.pack_lengths(lengths)
    pieces = sum(len(w) for w in windows)
    assert pieces < len(lengths) * 1.5               # most documents are not cut
    assert {sum(n for _, _, n in w) for w in windows} >= {1024, 2048}


def test_step_groups_hold_one_size_and_balance_cost():
    windows = P.pack_lengths([37, 90, 300, 700, 1900, 2048, 5000] * 60)
    groups = defaultdict(list)
    for w, g in zip(windows, P.step_groups(windows), strict=True):
        groups[g].append(w)
    full = []
    for ws in groups.values():
        sizes = {sum(n for _, _, n in w) for w in ws}
        assert len(sizes) == 1
        size = sizes.pop()
        assert len(ws) * size <= P.STEP_TOKENS
        if size == 2048:
            full.append(sum(n * n for w in ws for _, _, n in w) / len(ws))
    assert max(full) < 1.3 * min(full)
