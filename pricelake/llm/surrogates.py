"""Surrogates for personal data: keyed, type-consistent, distinct replacements.

Detected entities are e-mail addresses, phone, card and social security
numbers, IBANs, IPv4 addresses and person names (after a title, or a known given
name before a surname). Each is reduced to a canonical value (digits only,
lower case) of a type; its surrogate depends on the key, the type and that
value alone, so one person keeps one surrogate in every document, whatever the
spelling, and no table of entities has to be joined to the texts.

Numbers go through a keyed permutation of all numbers of their length
(format-preserving Feistel rounds), so different values stay different; cards
keep their first digit and whether they pass the Luhn check, IBANs their country and
their remainder modulo 97, phone numbers their country code, all their separators. E-mail names are permuted class by
class, letters to letters, digits to digits, and their domains end in the
reserved ``.example``. Given names keep the gender of the name or title, all
names their script and case.

Collision check over all documents: two values of a type with one surrogate, or
a surrogate that is some value of the documents, take the next attempt, until
none collides. Values that needed more than one attempt are few (permutations
only meet other real values; names have billions of forms); they are broadcast
within ``MAX_RETRIES``, beyond which the job stops and asks for more name
syllables instead of risking a merge.

Defined cases: null texts stay null and have no entities, empty ones stay empty; a
null ``doc_id`` is kept; repeated rows give repeated rows; very long texts are taken
whole, one at a time; of overlapping finds the earlier kind stays; a given name of two
genders in one document has neither; only the named columns are read, so further
columns with any names do no harm; an empty table gives an empty result.
"""

from __future__ import annotations

import hmac
import re
import secrets
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from pricelake.llm.common import released, stage

#: Setting that names the key of a release, for the registered query.
KEY_SETTING = "spark.pricelake.surrogates.key"
MAX_RETRIES = 200_000
#: Syllables of invented surnames and given names.
SYLLABLE_COUNTS = (5, 4)

# Known given names, titles, and the syllables of invented ones.
FEMALE = frozenset("""mary patricia jennifer linda elizabeth barbara susan jessica sarah karen lisa nancy betty sandra
ashley emily donna michelle carol amanda melissa deborah laura anna emma julia maria sophie claire marie camille
ana carmen lucia elena sabine petra ursula monika anke heike olga natalia irina""".split())
MALE = frozenset("""james robert john michael david william richard joseph thomas charles daniel matthew anthony mark
paul steven andrew kenneth george kevin brian edward peter hans klaus jürgen wolfgang stefan pierre jean michel
philippe luis carlos jose juan miguel javier antonio ivan dmitri sergei boris""".split())
TITLES = {"mr": "m", "mister": "m", "herr": "m", "señor": "m", "sr": "m", "monsieur": "m", "sir": "m",
          "mrs": "f", "ms": "f", "miss": "f", "frau": "f", "señora": "f", "sra": "f", "madame": "f", "mme": "f",
          "dr": "u", "prof": "u", "doctor": "u", "professor": "u"}
SYLLABLES = {
    "LATIN": "ba be bi bo bu da de di do du fa fe fi fo ga ge go ha he hi ka ke ki ko la le li lo lu ma me mi mo na ne ni no pa pe ra re ri ro sa se si so ta te ti to".split(),
    "CYRILLIC": "ба бе би бо ва ве ви га го да де ди до ка ки ко ла ле ли ло ма ме ми мо на не ни но па пе ра ре ри ро са се си со та те ти то".split(),
    "GREEK": "βα βε βι βο γα γε δα δε δι κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο πα πε ρα ρε ρι ρο σα σε σι σο τα τε τι το".split()}
ENDINGS = {"LATIN": {"f": "a", "m": "n", "u": "y", "s": "r"}, "CYRILLIC": {"f": "я", "m": "н", "u": "й", "s": "в"},
           "GREEK": {"f": "α", "m": "ς", "u": "ι", "s": "ς"}}

_WORD = r"[^\W\d_]+(?:[-'’][^\W\d_]+)*"
EMAIL = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}")
IP = re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\d]|\.\d)", re.ASCII)
IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?\b", re.ASCII)
SSN = re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", re.ASCII)
CARD = re.compile(r"(?<![\d-])\d{4}(?:([ -]?)\d{4}\1\d{4}\1\d{1,7}|[ -]\d{6}[ -]\d{5})(?![\d-])", re.ASCII)
PHONE = re.compile(r"(?<![\w.+-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?![\w-]|\.\d)"
                   r"|(?<![\w+])\+\d{8,15}(?!\w)", re.ASCII)
NUMERIC = (("ip", IP), ("ssn", SSN), ("card", CARD), ("phone", PHONE))
TITLED = re.compile(rf"\b({'|'.join(TITLES)})\b\.?\x20+({_WORD})(?:\x20({_WORD}))?", re.I)
WORDS = re.compile(_WORD)
PERSON = ("surname", "given_f", "given_m", "given_u")
IBAN_HEAD = re.compile(r"[A-Z]{2}\d{2}[\x20A-Z0-9]", re.ASCII)
#: A stretch that can hold a number of one of the kinds above.
NUMBERS = re.compile(r"[+(]?\d[\d .()+-]{5,}", re.ASCII)
KNOWN = {form(n): n for n in FEMALE | MALE for form in (str.capitalize, str.upper)}
TITLE_FORMS = frozenset(form(t) + dot for t in TITLES for form in (str.lower, str.capitalize, str.upper) for dot in ("", "."))
_OPENING = "(\"'«“„¿¡[{*_/>"


# ---- detection ----

def _gender(word: str, title: str | None = None) -> str:
    low = word.lower().split("-")[0]
    return "f" if low in FEMALE else "m" if low in MALE else TITLES[title.lower()] if title else "u"


@lru_cache(maxsize=10_000)
def _given(names: frozenset) -> re.Pattern:
    return re.compile(rf"\b({'|'.join(sorted(names))})\x20({_WORD})")


def _digits(s: str) -> str:
    return "".join(c for c in s if c.isdigit())


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, canonical value), sorted and disjoint; where finds
    overlap the earlier kind of the list below stays."""
    out: list[tuple[int, int, str, str]] = []
    taken = bytearray(len(text))

    def add(s, e, kind, value):
        if e > s and not any(taken[s:e]):
            taken[s:e] = b"\1" * (e - s)
            out.append((s, e, kind, value))

    if "@" in text:
        for m in EMAIL.finditer(text):
            add(*m.span(), "email", m[0].lower())
    if IBAN_HEAD.search(text):
        for m in IBAN.finditer(text):
            add(*m.span(), "iban", m[0].replace(" ", ""))
    runs = [m.span() for m in NUMBERS.finditer(text)]
    for kind, pattern in NUMERIC if runs else ():
        for lo, hi in runs:
            for m in pattern.finditer(text, lo, min(len(text), hi + 1)):
                n = len(_digits(m[0]))
                if kind == "card" and not 13 <= n <= 19 or kind == "phone" and not 7 <= n <= 15:
                    continue
                value = m[0] if kind == "ip" else ("+" if m[0][0] == "+" else "") + _digits(m[0])
                add(*m.span(), kind, value)
    plain = text
    for c in _OPENING:
        plain = plain.replace(c, " ")
    tokens = set(plain.split())
    if not tokens.isdisjoint(TITLE_FORMS):
        for m in TITLED.finditer(text):
            first, second = m[2], m[3]
            if not first[0].isupper():
                continue
            if second and second[0].isupper():
                add(*m.span(2), "given_" + _gender(first, m[1]), first.lower())
                add(*m.span(3), "surname", second.lower())
            else:
                known = first.lower() in FEMALE or first.lower() in MALE
                add(*m.span(2), "given_" + _gender(first) if known else "surname", first.lower())
    names = {t for t in tokens if t.split("-")[0] in KNOWN}
    if names:
        for m in _given(frozenset(names)).finditer(text):
            if m[2][0].isupper():
                add(*m.span(1), "given_" + _gender(m[1]), m[1].lower())
                add(*m.span(2), "surname", m[2].lower())
    # a person's names stand for the person wherever the document says them
    said = {value: kind for _, _, kind, value in reversed(out) if kind in PERSON and len(value) > 1}
    if said:
        for m in WORDS.finditer(text):
            if m[0][0].isupper() and (value := m[0].lower()) in said:
                add(*m.span(), said[value], value)
        genders: dict[str, set[str]] = {}
        for _, _, kind, value in out:
            if kind in PERSON and kind != "surname":
                genders.setdefault(value, set()).add(kind[-1])
        one = {v: (g - {"u"} or {"u"}).pop() if len(g - {"u"}) < 2 else "u" for v, g in genders.items()}
        out = [(s, e, f"given_{one[v]}" if k in PERSON and k != "surname" else k, v) for s, e, k, v in out]
    return sorted(out)


# ---- surrogates ----

def _prf(key: bytes, *parts) -> int:
    return int.from_bytes(hmac.digest(key, "\x1f".join(map(str, parts)).encode(), "sha256")[:16], "big")


def permuted(key: bytes, tweak: str, value: int, size: int) -> int:
    """A keyed permutation of 0..size-1: eight Feistel rounds on the smallest
    square that holds it, walked until the value falls inside."""
    if size < 2:
        return value
    side = 1
    while side * side < size:
        side *= 2
    while True:
        a, b = divmod(value, side)
        for r in range(8):
            a, b = b, (a + _prf(key, tweak, size, r, b)) % side
        value = a * side + b
        if value < size:
            return value


def _number(key: bytes, tweak: str, digits: str) -> str:
    return str(permuted(key, tweak, int(digits), 10 ** len(digits))).zfill(len(digits)) if digits else ""


def _luhn(digits: str) -> int:
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))) % 10


def _mod97(iban: str) -> int:
    """The remainder that is 1 for a valid IBAN."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _classed(key: bytes, tweak: str, s: str) -> str:
    """Letters become letters and digits digits; the rest stays. A permutation
    of all strings of that pattern."""
    value, size = 0, 1
    for c in s:
        n = 10 if c.isdigit() else 26 if "a" <= c <= "z" else 1
        value, size = value * n + (int(c) if n == 10 else ord(c) - 97 if n == 26 else 0), size * n
    pattern = "".join("9" if c.isdigit() else "a" if "a" <= c <= "z" else c for c in s)
    value, out = permuted(key, f"{tweak}|{pattern}", value, size), []
    for c in reversed(pattern):
        n = 10 if c == "9" else 26 if c == "a" else 1
        value, k = divmod(value, n)
        out.append(str(k) if n == 10 else chr(97 + k) if n == 26 else c)
    return "".join(reversed(out))


def _script(word: str) -> str:
    name = unicodedata.name(word[0], "").split()
    return name[0] if name and name[0] in SYLLABLES else "LATIN"


@lru_cache(maxsize=100_000)
def surrogate(key: bytes, kind: str, value: str, attempt: int = 0, syllables: tuple[int, int] = SYLLABLE_COUNTS) -> str:
    """The canonical surrogate of a canonical value."""
    tweak = f"{kind}/{attempt}"
    if kind == "email":
        name, _, domain = value.partition("@")
        labels = domain.split(".")
        return _classed(key, tweak, name) + "@" + ".".join([*(_classed(key, "domain", x) for x in labels[:-1]), labels[-1], "example"])
    if kind == "ip":
        n = 0
        for x in value.split("."):
            n = n * 256 + int(x)
        n = permuted(key, tweak, n, 1 << 32)
        return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
    if kind == "iban":
        body = _classed(key, tweak + value[:2], value[4:].lower()).upper()
        check = (_mod97(value) - _mod97(value[:2] + "00" + body)) % 97
        return f"{value[:2]}{check if check > 1 else check + 97:02d}{body}"          # check digits are 02 to 98
    if kind == "card":
        body = value[0] + _number(key, tweak + value[0], value[1:-1])
        rest = _luhn(value)              # the check sum's remainder stays: valid cards stay valid
        return body + str((rest - _luhn(body + "0")) % 10)
    if kind == "phone":
        code = 0
        if value[0] == "+":
            code = 2 if value[1] in "17" else 3
        return value[:code] + _number(key, tweak + value[:code], value[code:])
    if kind == "ssn":
        return _number(key, tweak, value)
    script = _script(value)
    # a given name keeps its stem whatever gender a document shows
    parts, n = SYLLABLES[script], _prf(key, f"{kind.split('_')[0]}/{attempt}", value)
    out = []
    for _ in range(syllables[kind != "surname"]):
        n, k = divmod(n, len(parts))
        out.append(parts[k])
    return "".join(out) + ENDINGS[script]["s" if kind == "surname" else kind[-1]]


def in_format(raw: str, kind: str, new: str) -> str:
    """The surrogate in the separators and case of the text it replaces."""
    if kind in ("card", "phone", "ssn", "iban"):
        chars = iter(c for c in new if c.isalnum())
        return "".join(next(chars) if c.isalnum() else c for c in raw)
    if kind == "email":
        return new.upper() if raw.isupper() else new
    if kind == "ip":
        return new
    return new.upper() if len(raw) > 1 and raw.isupper() else new.capitalize() if raw[0].isupper() else new


# ---- Spark ----

def _values(batches):
    for b in batches:
        found = {(k, v) for t in b.column(0).to_pylist() if t for _, _, k, v in entities(t)}
        yield pa.RecordBatch.from_pydict({"kind": pa.array([k for k, _ in found], pa.string()),
                                          "value": pa.array([v for _, v in found], pa.string())})


def _draw(key: bytes, syllables):
    def run(batches):
        for b in batches:
            new = [surrogate(key, k, v, n, syllables) for k, v, n in zip(*(c.to_pylist() for c in b.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(new, pa.string())], names=["kind", "value", "attempt", "new"])
    return run


def retried(docs: DataFrame, key: bytes, text_col: str, syllables: tuple[int, int] = SYLLABLE_COUNTS) -> dict[tuple[str, str], int]:
    """The values whose first surrogate collided, with the attempt that did not."""
    values = stage(docs.select(F.col(text_col).alias("text")).mapInArrow(released(_values), "kind string, value string").distinct(), "values")
    drawn = values.withColumn("attempt", F.lit(0)).mapInArrow(released(_draw(key, syllables)), "kind string, value string, attempt int, new string")
    while True:
        drawn = stage(drawn, "drawn")
        order = Window.partitionBy("kind", "new").orderBy(F.col("attempt"), "value")
        real = values.select("kind", F.col("value").alias("new"), F.lit(True).alias("real"))
        clash = stage(drawn.withColumn("rank", F.row_number().over(order)).join(real, ["kind", "new"], "left")
                      .filter((F.col("rank") > 1) | F.col("real")).select("kind", "value", (F.col("attempt") + 1).alias("attempt")), "clash")
        if clash.isEmpty():
            break
        again = clash.mapInArrow(released(_draw(key, syllables)), "kind string, value string, attempt int, new string")
        drawn = drawn.join(clash.select("kind", "value"), ["kind", "value"], "left_anti").unionByName(again)
    late = drawn.filter("attempt > 0")
    if late.count() > MAX_RETRIES:
        raise ValueError("too many collisions to broadcast: ask for more syllables")
    return {(r.kind, r.value): r.attempt for r in late.toLocalIterator()}


_SPANS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", LongType()),
                               StructField("end", LongType()), StructField("surrogate", StringType())]))
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("surrogate", pa.string())]))


def replaced(text: str, key: bytes, late: dict, syllables: tuple[int, int] = SYLLABLE_COUNTS) -> tuple[str, list[dict]]:
    out, spans, pos = [], [], 0
    for s, e, kind, value in entities(text):
        new = in_format(text[s:e], kind, surrogate(key, kind, value, late.get((kind, value), 0), syllables))
        out += [text[pos:s], new]
        spans.append({"kind": kind, "start": s, "end": e, "surrogate": new})
        pos = e
    return "".join([*out, text[pos:]]), spans


def _replacer(key: bytes, shared, syllables):
    def run(batches):
        for b in batches:
            rows = [replaced(t, key, shared.value, syllables) if t else (t, []) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([t for t, _ in rows], pa.string()),
                                              pa.array([s for _, s in rows], _ARROW)], names=["doc_id", "text", "spans"])
    return run


def session_key(spark) -> bytes:
    """The key that the session names; without one a key drawn for this run alone."""
    named = spark.conf.get(KEY_SETTING, None)
    return named.encode() if named else secrets.token_bytes(32)


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text",
                 syllables: tuple[int, int] = SYLLABLE_COUNTS) -> DataFrame:
    """One row per document: doc_id, text with surrogates, spans (kind, start and
    end in the old text, surrogate)."""
    shared = docs.sparkSession.sparkContext.broadcast(retried(docs, key, text_col, syllables))
    schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("spans", _SPANS)])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(released(_replacer(key, shared, syllables)), schema)
