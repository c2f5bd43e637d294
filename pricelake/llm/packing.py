"""Hierarchical multi-length packing of token sequences.

Documents are routed to context tiers (powers of two up to ``max_len``): one of
``n`` tokens belongs to the smallest tier that holds it, and one longer than
the largest tier gives full windows of that tier and a routed rest. Each tier
is packed on its own: its next longest document opens a window, the gap takes
the longest documents of shorter tiers that still fit, and what is left is cut
from the shortest document at hand. So every window is exactly full, whatever
the data; the few tokens at the end of a task are cut at powers of two. No
window needs padding.

Packing needs no shuffle: a task packs the documents it reads, in pools of
``POOL_TOKENS`` tokens, and its sequences carry the task's number. Sequences
of one tier are then put into step groups of ``STEP_TOKENS`` tokens,
dealt there and back over the open groups by falling cost (attention grows with the
squares of its pieces), so that the groups cost about the same.

Defined cases: a null or empty text is the end id alone; a null ``doc_id`` is
kept; repeated rows are separate documents; a very long text is cut into full
windows, whole; only the named columns are read, so further columns with any names do
no harm; an empty table packs to nothing.
"""

from __future__ import annotations

import base64
import bisect
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pricelake.llm.common import released

POOL_TOKENS = 1 << 20
STEP_TOKENS = 1 << 16
MAX_LEN = 2048
MIN_TIER = 128
END_ID = 1
TOKENIZER = "byte_bpe_50k"
_SPECIAL = "<|endoftext|>"
#: Below these characters the two libraries' character classes cannot differ.
_WIDE = re.compile("[\u0250-\U0010ffff]")

SCHEMA = ("doc_id long, start long, length long, token_ids binary, doc_tokens long, "
          "sequence_id long, offset long, tier int, step_group long")


@lru_cache(maxsize=2)
def encoder(name: str = TOKENIZER):
    """ids of a text by the ``tokenizers`` vocabulary ``name``.

    The same vocabulary as ranks gives the same ids several times faster; texts
    with the special token's string or with characters beyond Latin go
    through ``tokenizers`` itself.
    """
    import public_tokenizers as public
    import tiktoken

    with open(public.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding(name, pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @lru_cache(maxsize=1)
    def exact():
        from tokenizers import Tokenizer
        return Tokenizer.from_file(public.path(f"{name}.json"))

    def ids(text: str) -> list[int]:
        if _WIDE.search(text) or _SPECIAL in text:
            return exact().encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return ids


def _tier(n: int, max_len: int) -> int:
    t = MIN_TIER
    while t < n:
        t *= 2
    return min(t, max_len)


class _Pool:
    """Pieces waiting to be packed: (tokens, document, start), ordered by length."""

    def __init__(self):
        self.pieces: list[tuple[int, int, int]] = []

    def add(self, n: int, doc: int, start: int):
        bisect.insort(self.pieces, (n, doc, start))

    def longest(self, room: int):
        """Take the longest piece of at most ``room`` tokens."""
        k = bisect.bisect_right(self.pieces, (room, 1 << 62, 0)) - 1
        return self.pieces.pop(k) if k >= 0 else None

    def tokens(self) -> int:
        return sum(p[0] for p in self.pieces)


def pack_lengths(lengths, max_len: int = MAX_LEN):
    """Windows over documents of the given token counts: lists of (document,
    start, tokens) that fill their tier exactly, the last ones a power of two."""
    windows, pool = [], _Pool()
    left = 0
    for d, n in enumerate(lengths):
        full = n // max_len
        windows += [[(d, k * max_len, max_len)] for k in range(full)]
        if n % max_len:
            pool.add(n % max_len, d, full * max_len)
            left += n % max_len
    while pool.pieces:
        tier = _tier(pool.pieces[-1][0], max_len)
        while tier > left:              # the end: no window of that tier can be filled
            tier //= 2
        window, room = [], tier
        while room:
            p = pool.longest(room)
            if p is None:               # cut the shortest piece at hand to fill the gap
                n, d, s = pool.pieces.pop(0)
                pool.add(n - room, d, s + room)
                p = (room, d, s)
            window.append((p[1], p[2], p[0]))
            room -= p[0]
        windows.append(window)
        left -= tier
    return windows


def step_groups(windows, step_tokens: int = STEP_TOKENS) -> list[int]:
    """A group for each window: windows of one size only, ``step_tokens`` tokens
    each, with balanced attention cost (sum of squared piece lengths)."""
    by_size: dict[int, list[int]] = {}
    for i, w in enumerate(windows):
        by_size.setdefault(sum(p[2] for p in w), []).append(i)
    out, first = [0] * len(windows), 0
    for size in sorted(by_size, reverse=True):
        members = sorted(by_size[size], key=lambda i: -sum(p[2] ** 2 for p in windows[i]))
        seats = max(1, step_tokens // size)
        groups = -(-len(members) // seats)
        for k, i in enumerate(members):          # dealt there and back: equal counts, even cost
            lap, at = divmod(k, groups)
            out[i] = first + (at if lap % 2 == 0 else groups - 1 - at)
        first += groups
    return out


def _packer(max_len: int, tokenizer: str):
    def run(batches):
        from pyspark import TaskContext
        base = TaskContext.get().partitionId() << 36
        ids = encoder(tokenizer)
        docs, held, seq, group = [], 0, 0, 0

        def flush():
            nonlocal seq, group
            windows = pack_lengths([len(a) for _, a in docs], max_len)
            steps = step_groups(windows)
            cols = {k: [] for k in ("doc_id", "start", "length", "token_ids", "doc_tokens",
                                    "sequence_id", "offset", "tier", "step_group")}
            for w, g in zip(windows, steps, strict=True):
                size, offset = sum(p[2] for p in w), 0
                for d, start, n in w:
                    key, a = docs[d]
                    row = (key, start, n, a[start:start + n].tobytes(), len(a), base + seq, offset, size, base + group + g)
                    for c, v in zip(cols.values(), row, strict=True):
                        c.append(v)
                    offset += n
                seq += 1
            group += max(steps, default=-1) + 1
            docs.clear()
            n = len(cols["doc_id"])
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            batch = pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(cols.values(), types, strict=True)], names=list(cols))
            for k in range(0, n, 20_000):
                yield batch.slice(k, 20_000)

        for b in batches:
            for key, text in zip(b.column(0), b.column(1), strict=True):
                a = np.array([*ids(text.as_py() or ""), END_ID], dtype="<u4")
                docs.append((key.as_py(), a))
                held += len(a)
                if held >= POOL_TOKENS:
                    yield from flush()
                    held = 0
        if docs:
            yield from flush()
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_len: int = MAX_LEN,
         tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per piece: its document and place there, its ids (``token_ids``,
    little-endian unsigned 32-bit), its sequence, offset, tier and step group."""
    if max_len & (max_len - 1) or max_len < MIN_TIER:
        raise ValueError("max_len must be a power of two, 128 at least")
    from pyspark.sql import functions as F
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(released(_packer(max_len, tokenizer)), SCHEMA)
