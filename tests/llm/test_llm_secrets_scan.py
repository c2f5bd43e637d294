import hashlib
import re

from pricelake.llm import queries
from pricelake.llm import secrets_scan as S

PATTERNS = {  # the contract's patterns, matched plainly
    "assign": (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
               r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24)}


def brute(text):
    found = [(m.start(), k, m.end()) for k, (p, ok) in PATTERNS.items() for m in re.finditer(p, text or "") if ok(m)]
    found.sort(key=lambda s: (s[0], list(PATTERNS).index(s[1])))
    return ",".join(f"{k}:{s}:{e}" for s, k, e in found)


KEY, BLOB = "AKIA" + "Z7" * 8, "wJalrXUtnFEMIK7MDENGbPxRfiCYzEXAMPLEKEY9"
TEXTS = ["", None, f"é {KEY} x", f"{KEY}A AKIA123 AKIA{'9' * 15}", "token=token:abcdefgh", "passWORD : 'abc.def'", "api_key=short",
         "apikey=longer_one secret=\"a=b=c=d\"", "ſecret=abcdefgh toKen=abcdefgh", "0123456789abcdef01234567", "0123456789abcdef0123456",
         "AKIAAKIA" + "1" * 16, "token=" + "a" * 30, "token = \n abcdefgh", "x" * 200_000 + " token=abcdef1 " + "f" * 50_000]


def test_base_spans_equal_the_plain_patterns(make):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, TEXTS[2]), (2, TEXTS[2])]
    got = S.find_secrets(make(rows)).collect()
    assert len(got) == len(rows)
    for r, (i, t) in zip(got, rows, strict=True):
        base = [s for s in r.spans if s.kind in S.BASE]
        assert r.doc_id == i and ",".join(f"{s.kind}:{s.start}:{s.end}" for s in base) == brute(t)
        assert all(s.value == t[s.start:s.end] for s in r.spans)


def test_weak_parts_need_their_complement():
    kinds = lambda t: [k for _, _, k in S.spans_of(t)]
    assert kinds(f"id {KEY} and {BLOB}") == ["access", "secret"]
    assert kinds(f"only {BLOB} here") == []
    assert kinds("see https://host.example/path") == []
    assert kinds(f"{KEY} https://host.example/path") == ["access"]
    assert kinds(f"{KEY} {BLOB} https://host.example/path") == ["access", "secret", "endpoint"]
    assert kinds("client_id=my-app") == []
    assert kinds("client_id=my-app token=abcdefgh1") == ["identifier", "assign"]
    assert kinds(f"client_id=my-app {BLOB}") == ["secret"]
    assert kinds(f"client_id=my-app {BLOB} host=db.example.org:5432") == ["identifier", "secret", "endpoint"]


def test_scopes_end_at_distance_and_blank_lines():
    near, far = "x " * 100, "x " * 200
    kinds = lambda t: [k for _, _, k in S.spans_of(t)]
    assert kinds(f"{KEY} {near}{BLOB}") == ["access", "secret"]
    assert kinds(f"{KEY} {far}{BLOB}") == ["access"]
    assert kinds(f"{KEY}\n\n{BLOB}") == ["access"]


def test_links_equal_an_all_pairs_join():
    import itertools
    import random
    r = random.Random(8)
    parts = [KEY, BLOB, "client_id=app77", "token=abcdefgh9", "https://h.example/p", "words and more words", "y " * 90, "\n\n", "z " * 140]
    for _ in range(150):
        text = " ".join(r.choice(parts) for _ in range(r.randint(2, 14)))
        spans = S.spans_of(text)
        base = [(s, e, k) for s, e, k in spans if k in S.BASE]
        weak = [(m.start(), m.end()) for m in S.WEAK_SECRET.finditer(text) if S._mixed(m[0])]
        weak = [w for w in weak if not any(w[0] < e and s < w[1] for s, e, _ in base)]
        names = [(m.start(), m.end()) for m in S.IDENTIFIER.finditer(text)]
        ids = [(s, e) for s, e, k in base if k == "access"] + names

        def meets(a, b, text=text):
            a, b = sorted((a, b))
            return b[0] - a[1] <= S.SCOPE and not S.BLANK.search(text, a[1], max(a[1], b[0]) + 1)
        want = {w for w, i in itertools.product(weak, ids) if meets(w, i)}
        assert {(s, e) for s, e, k in spans if k == "secret"} == want


def test_query_digest_and_empty_table(spark, make, monkeypatch):
    monkeypatch.setattr(queries, "table", lambda *a: make([(1, f"{KEY} token=abcdefgh"), (2, None)]))
    a, b = queries.op2_secrets(spark, "").collect()
    want = f"access:0:20,assign:21:{21 + 14}"
    assert (a.n_assign, a.n_access, a.n_hex, a.spans) == (1, 1, 0, want)
    assert a.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert b.base_sha256 == hashlib.sha256(b"").hexdigest() and b.spans == ""
    assert S.find_secrets(make([])).count() == 0


def test_weak_secrets_of_any_length_are_linked():
    import random
    import string
    r = random.Random(5)
    kinds = lambda t: [k for _, _, k in S.spans_of(t)]
    for n in (128, 129, 200, 1000, 100_000):
        token = "aZ7" + "".join(r.choices(string.ascii_letters + string.digits + "+/", k=n - 3))
        assert kinds(f"id {KEY} and {token}==") == ["access", "secret"]
        assert S.spans_of(f"id {KEY} and {token}")[1][:2] == (len(KEY) + 8, len(KEY) + 8 + n)
        assert kinds(f"host=db.example.org:5432 client_id=my-app {token}") == ["endpoint", "identifier", "secret"]
        assert kinds(f"only {token} here") == []
    assert kinds(f"{KEY} {'aZ7' * 100}") == ["access"]


def test_a_nested_span_hides_no_neighbour():
    """The longer span starts earlier and ends nearer; identifiers equal all pairs."""
    import random
    h = "0123456789abcdef01234567"
    assert [k for _, _, k in S.spans_of(f"password={h}{'g' * 401} client_id=myclient01")] == ["assign", "hex", "identifier"]
    r = random.Random(9)
    parts = [f"password={h}{'g' * 310}", f"token={'q' * 40}", h, "client_id=app77", "login=me-too", "https://h.example/p", "y " * 90, "\n\n", "z " * 120]
    for _ in range(200):
        text = " ".join(r.choice(parts) for _ in range(r.randint(2, 12)))
        spans = S.spans_of(text)
        firm = [(s, e) for s, e, k in spans if k in ("assign", "hex")]
        names = [(m.start(), m.end()) for m in S.IDENTIFIER.finditer(text)]

        def meets(a, b, text=text):
            a, b = sorted((a, b))
            return b[0] - a[1] <= S.SCOPE and not S.BLANK.search(text, a[1], max(a[1], b[0]) + 1)
        want = {n for n in names if any(meets(n, f) for f in firm)}
        assert {(s, e) for s, e, k in spans if k == "identifier"} == want
