"""Secret scan with multipart credential linking.

Base spans come from three plain patterns (assign, access, hex). A credential
often has further parts that are too weak to report alone: an identifier
(client or account id, user name), a bare high-entropy secret, an endpoint.
They are joined by interval: a weak part is reported only if parts that
complement it lie in its scope, at most ``SCOPE`` characters away and with no
blank line between. A weak secret needs an access key or an identifier, an
identifier needs a secret (base or weak) that is strong or stands by an
endpoint, an endpoint needs both a secret and an access key or identifier.

The join is a merge: the parts of one kind are sorted, so a part's nearest
neighbours on either side decide, in time linear in the text and its parts.

Positions are code points, ends exclusive. Defined cases: null and empty texts
have no spans; a null ``doc_id`` is kept; repeated rows give repeated rows; very
long texts are scanned whole, one at a time; parts that start together are all
reported, in the order of kinds; only the named columns are read, so further
columns with any names do no harm; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import released

# Kinds in their order, and the base patterns.
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "identifier", "secret", "endpoint")
ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE = 6

SCOPE = 300
IDENTIFIER = re.compile(r"(?i:access_?key_?id|client_?id|account(?:_?id)?|app_?id|user_?(?:name|id)?|login)"
                        r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9._@-]{3,})", re.ASCII)
WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}+={0,2}(?![A-Za-z0-9+/_=-])")
#: The alphabet is small: a longer value has no more distinct characters.
FULL = 128
ENDPOINT = re.compile(r"[a-z][a-z0-9+.-]{1,15}://[A-Za-z0-9._~-]+(?::[0-9]+)?[^\s\"'<>]*"
                      r"|(?i:endpoint|host|server)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]+)?")
BLANK = re.compile(r"\n[\x20\t\r]*\n")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), leftmost and non-overlapping within each kind."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_VALUE]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def _mixed(value: str) -> bool:
    """Looks random: letters of both cases and digits, at least a third distinct
    (of a value over ``FULL`` characters, as many as of one of ``FULL``)."""
    return (any(c.isdigit() for c in value) and any(c.islower() for c in value) and any(c.isupper() for c in value)
            and 3 * len(set(value)) >= min(len(value), FULL))


class _Kind:
    """Spans of one kind, to be asked for a neighbour in scope: of those that start
    earlier the one that ends last, which a nested span may hide in the order of
    starts, and of the others the first."""

    def __init__(self, spans, blanks):
        self.spans, self.blanks = sorted(set(spans)), blanks
        self.starts = [s for s, _ in self.spans]
        self.ends = list(accumulate((e for _, e in self.spans), max))

    def _met(self, end: int, start: int) -> bool:
        return start - end <= SCOPE and bisect_left(self.blanks, end) == bisect_left(self.blanks, max(end, start))

    def near(self, span) -> bool:
        k = bisect_left(self.starts, span[0])
        if k and self._met(self.ends[k - 1], span[0]):
            return True
        k += k < len(self.spans) and self.spans[k] == span
        return k < len(self.spans) and self._met(span[1], self.starts[k])


def linked_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The weak parts that complementary parts in their scope confirm."""
    named = [(m.start(), m.end()) for m in IDENTIFIER.finditer(text)] if "=" in text or ":" in text else []
    access = [(s, e) for s, e, k in base if k == "access"]
    if not access and not named:
        return []
    taken = sorted((s, e) for s, e, _ in base)
    starts = [s for s, _ in taken]
    ends = []
    for _, e in taken:
        ends.append(max(e, ends[-1]) if ends else e)

    def free(span):
        k = bisect_left(starts, span[1])
        return not k or ends[k - 1] <= span[0]

    named = [s for s in named if free(s)]
    strong = [(s, e) for s, e, k in base if k != "access"]
    weak = [(m.start(), m.end()) for m in WEAK_SECRET.finditer(text) if _mixed(m[0])]
    weak = [s for s in weak if free(s)]
    points = [s for s in ((m.start(), m.end()) for m in ENDPOINT.finditer(text)) if free(s)]
    blanks = [m.start() for m in BLANK.finditer(text)]
    ids, secrets = _Kind(access + named, blanks), _Kind(strong + weak, blanks)
    firm, ends_ = _Kind(strong, blanks), _Kind(points, blanks)
    out = [(*s, "identifier") for s in named if firm.near(s) or secrets.near(s) and ends_.near(s)]
    out += [(*s, "secret") for s in weak if ids.near(s)]
    out += [(*s, "endpoint") for s in points if ids.near(s) and secrets.near(s)]
    return out


def spans_of(text: str) -> list[tuple[int, int, str]]:
    base = base_spans(text)
    return sorted(base + linked_spans(text, base), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])


def _scan(batches):
    for b in batches:
        rows = []
        for t in b.column(1):
            text = t.as_py() or ""
            rows.append([{"kind": k, "start": s, "end": e, "value": text[s:e]} for s, e, k in spans_of(text)])
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(_SPAN))], names=["doc_id", "spans"])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, spans (kind, start, end, value) by start."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        released(_scan), "doc_id long, spans array<struct<kind string, start bigint, end bigint, value string>>")


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
