import random
import re

import pytest

from pricelake.llm import surrogates as S

KEY = b"the tests' own key"
TEXT = ("Mail bo.b42@mail8.example.com or +1 (988) 555-2485, card 4041894974608795 or 4111 1111 1111 1111, ip 42.144.35.254. "
        "Mr. John Smith met Mary Jones; Dr. SMITH said so. SSN 123-45-6789, DE89 3704 0044 0532 0130 00")


def test_detected_and_replaced_in_type_and_format():
    new, spans = S.replaced(TEXT, KEY, {})
    kinds = [s["kind"] for s in spans]
    assert kinds == ["email", "phone", "card", "card", "ip", "given_m", "surname", "given_f", "surname", "surname", "ssn", "iban"]
    by = [(s["kind"], TEXT[s["start"]:s["end"]], s["surrogate"]) for s in spans]
    for kind, old, made in by:
        assert old not in new and made in new and made != old
        if kind in ("phone", "card", "ssn", "iban"):
            assert re.sub(r"[0-9A-Z]", "#", old) == re.sub(r"[0-9A-Z]", "#", made)
    assert by[1][2].startswith("+1 (")
    valid = lambda s: S._luhn(S._digits(s)) == 0
    assert [valid(o) for _, o, _ in by[2:4]] == [valid(m) for _, _, m in by[2:4]]
    john, smith, mary, smith2 = by[5], by[6], by[7], by[9]
    assert smith2[2] == smith[2].upper() and john[2].endswith("n") and mary[2].endswith("a")
    outside = re.sub("|".join(re.escape(s["surrogate"]) for s in spans), "", new)
    assert outside == re.sub("|".join(re.escape(TEXT[s["start"]:s["end"]]) for s in spans), "", TEXT)


def test_scripts_stay():
    (_, made), = [(s["kind"], s["surrogate"]) for s in S.replaced("Dr. Петров", KEY, {})[1]]
    assert re.fullmatch(r"[А-Я][а-я]+", made)


@pytest.mark.parametrize("size", [2, 10, 97, 1000, 4096])
def test_permutation_is_one(size):
    assert sorted(S.permuted(b"k", "t", v, size) for v in range(size)) == list(range(size))


def test_different_values_stay_different_and_keys_matter():
    r = random.Random(2)
    for kind, make in (("phone", lambda: "+1" + str(r.randrange(10 ** 9, 10 ** 10))), ("ssn", lambda: f"{r.randrange(10 ** 9):09d}"),
                       ("card", lambda: str(r.randrange(10 ** 15, 10 ** 16))), ("ip", lambda: ".".join(str(r.randrange(256)) for _ in range(4))),
                       ("email", lambda: f"{r.choice('abc')}{r.randrange(9999)}@{r.choice('xyz')}.{r.choice(('com', 'org'))}")):
        values = {make() for _ in range(2000)}
        made = {v: S.surrogate(b"one", kind, v) for v in values}
        assert len(set(made.values())) == len(values)
        assert sum(made[v] != S.surrogate(b"two", kind, v) for v in values) > 0.9 * len(values)


def test_collisions_are_found_over_all_documents_and_resolved(make):
    names = ["".join(p) for p in __import__("itertools").product("Abcdefgh"[:1], "eiou", "lmnrst", "aeio", "nrst")]
    rows = [(k, f"Mr. {n} came") for k, n in enumerate(names)]
    late = S.retried(make(rows), KEY, "text", (2, 2))
    made = [S.surrogate(KEY, "surname", n.lower(), late.get(("surname", n.lower()), 0), (2, 2)) for n in names]
    assert late and len(set(made)) == len(names) and not set(made) & {n.lower() for n in names}


def test_documents(spark, make):
    rows = [(1, TEXT), (2, "Call +1 (988) 555-2485."), (3, None), (4, ""), (None, "a@b.org"), (5, "clean words only"), (5, "clean words only"),
            (6, "x " * 200_000 + "a@b.org"), (7, "a" * 200_000 + " @")]
    got = S.pseudonymise(make(rows), KEY).collect()
    assert [r.doc_id for r in got] == [i for i, _ in rows]
    phone = next(s.surrogate for s in got[0].spans if s.kind == "phone")
    assert got[1].text == f"Call {phone}."                      # coreference over documents
    assert got[2].text is None and got[2].spans == [] and got[3].text == ""
    assert got[4].text == got[7].text.split()[-1] != "a@b.org"
    assert got[5].text == "clean words only" and got[8].text == rows[8][1]
    assert S.pseudonymise(make([]), KEY).count() == 0


def test_one_person_has_one_name_in_a_document():
    text = "Dr. Alex Smith wrote. Mr. Alex Smith agreed. Smith said no to Alex. ALEX left the smith."
    new, spans = S.replaced(text, KEY, {})
    first, last = S.surrogate(KEY, "given_m", "alex").capitalize(), S.surrogate(KEY, "surname", "smith").capitalize()
    assert new == f"Dr. {first} {last} wrote. Mr. {first} {last} agreed. {last} said no to {first}. {first.upper()} left the smith."
    assert len(spans) == 7
    # without a gender the stem is the same, and two genders are none
    assert S.surrogate(KEY, "given_u", "alex")[:-1] == S.surrogate(KEY, "given_m", "alex")[:-1]
    assert {s["kind"] for s in S.replaced("Mr. Kim Jones and Mrs. Kim Miller", KEY, {})[1]} == {"given_u", "surname"}
    kinds = [s["kind"] for s in S.replaced("So Jean-Pierre Dupont said; Dupont left.", KEY, {})[1]]
    assert kinds == ["given_m", "surname", "surname"]


def test_ibans_keep_their_remainder():
    r = random.Random(1)
    seen = set()
    for k in range(500):
        body = "".join(r.choice("0123456789") for _ in range(18))
        valid = "DE" + f"{(98 - S._mod97('DE00' + body)):02d}" + body
        value = valid if k % 2 else "DE" + f"{r.randrange(2, 99):02d}" + body
        made = S.surrogate(KEY, "iban", value)
        assert S._mod97(made) == S._mod97(value) and made[:2] == "DE" and len(made) == len(value) and 2 <= int(made[2:4]) <= 98
        assert S._mod97(valid) == 1
        seen.add(made)
    assert len(seen) == 500
    assert S._mod97(S.surrogate(KEY, "iban", "DE89370400440532013000")) == 1


def test_whole_output_equals_plain_replacement(spark, make):
    """Documents made of planted values between clean words: each value is replaced
    by its surrogate in its own format, and nothing else changes."""
    r = random.Random(7)
    people = [("Anna", "f", "Kovac"), ("Peter", "m", "Okoro"), ("Maria", "f", "Lindqvist"), ("Klaus", "m", "Brandt")]
    plain = [("email", "bo.b42@mail8.example.com"), ("phone", "+1 (988) 555-2485"), ("card", "4111 1111 1111 1111"), ("ip", "42.144.35.254"),
             ("ssn", "123-45-6789"), ("iban", "DE89 3704 0044 0532 0130 00")]
    canon = {"email": str.lower, "phone": lambda v: "+" + S._digits(v), "card": S._digits, "ip": str, "ssn": S._digits, "iban": lambda v: v.replace(" ", "")}
    rows, want = [], []
    for k in range(120):
        old, new = [], []
        named = set()
        for _ in range(r.randint(0, 12)):
            kind = r.random()
            if kind < 0.4:
                old.append("clean words between them")
                new.append(old[-1])
            elif kind < 0.7:
                t, v = r.choice(plain)
                old.append(v)
                new.append(S.in_format(v, t, S.surrogate(KEY, t, canon[t](v))))
            else:
                g, sex, f = r.choice(people)
                a, b = (S.surrogate(KEY, x, v.lower()).capitalize() for x, v in ((f"given_{sex}", g), ("surname", f)))
                if f in named and r.random() < 0.5:
                    old.append(f)
                    new.append(b)
                else:
                    named.add(f)
                    old.append(f"{g} {f}")
                    new.append(f"{a} {b}")
        rows.append((k, " ; ".join(old)))
        want.append((k, " ; ".join(new)))
    assert [(x.doc_id, x.text) for x in S.pseudonymise(make(rows), KEY).collect()] == want


def test_the_session_names_the_key(spark):
    assert S.session_key(spark) != S.session_key(spark)
    spark.conf.set(S.KEY_SETTING, "release 5")
    try:
        assert S.session_key(spark) == b"release 5"
    finally:
        spark.conf.unset(S.KEY_SETTING)
