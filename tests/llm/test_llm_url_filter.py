import math
import re
from zlib import crc32

import pytest

from pricelake.llm import url_filter as U


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fits = [(h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0])) if fits else (None, None)


ODD = [None, "", "no scheme", "http://", "http://net/", "http://NET/x", "http://a.b.net", "http://a.net/?q", "x://example.net/en/1",
       "http://sub.Example.NET/en/", "http://example.net/en", "http://notexample.com/de/", "http://example.com/de/a?b://c",
       "http://example.org/fr/1", "http://example.org/en/1", "a\n://host.net/p", "http://É.net/ü", "http://h.net#f", "http://h.com/" + "p" * 50_000]


@pytest.fixture()
def pages(spark):
    urls = ODD + [f"http://w{k}.example.{t}/{lang}/{k}" for k in range(60) for t in ("com", "net", "org") for lang in ("en", "de", "fr")]
    rows = [(k, u, "h", "r") for k, u in enumerate(urls)] + [(None, urls[40], "h", "r"), (40, urls[40], "h", "r")]
    return spark.createDataFrame(rows, "page_id long, url string, host string, rule string").repartition(3)


def model(urls):
    """The same model and scores in plain Python, with grams by their text."""
    counts = [{}, {}]
    for u in urls:
        v = rule_of(*parts(u))[1]
        if u and v and crc32(u.encode()) % U.HOLD_OUT:
            s = "^" * U.ORDER + u
            for i in range(U.ORDER, len(s)):
                for k in range(1, U.ORDER + 2):
                    g = s[i - k + 1:i + 1]
                    counts[v == "allow"][g] = counts[v == "allow"].get(g, 0) + 1
    ctx = [{}, {}]
    for c in (0, 1):
        for g, n in counts[c].items():
            a = ctx[c].setdefault(g[:-1] if len(g) > 1 else (), [0, 0])
            a[0] += n
            a[1] += 1
    ctx = [{(k if k != () else ""): v for k, v in c.items()} for c in ctx]

    def p(c, g):
        lower = p(c, g[1:]) if len(g) > 1 else 1 / U.ALPHABET
        n, t = ctx[c].get(g[:-1], (0, 0))
        return (counts[c].get(g, 0) + t * lower) / (n + t) if n else lower

    def score(u):
        if not u:
            return 0.0
        s = "^" * U.ORDER + u
        return sum(math.log(p(1, s[i - U.ORDER:i + 1]) / p(0, s[i - U.ORDER:i + 1])) for i in range(U.ORDER, len(s))) / len(u)
    return score


def test_rules_and_scores_equal_a_plain_version(pages):
    rows = {(r.page_id, r.url) for r in pages.collect()}
    score = model([r.url for r in pages.collect()])
    got = U.judge(pages).collect()
    assert len(got) == pages.count()
    urls = dict(rows)
    decided = []
    for r in got:
        url = urls[r.page_id]
        host, path = parts(url)
        rule, verdict = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
        assert abs(r.score - score(url)) < 1e-9, url
        if rule and crc32((url or "").encode()) % U.HOLD_OUT == 0:
            decided.append((r.score, verdict == "allow"))
    own = [r for r in got if r.rule is None]
    assert {r.verdict for r in own} == {"allow", "block"}
    assert min(r.score for r in own if r.verdict == "allow") > max(r.score for r in own if r.verdict == "block")
    spark = pages.sparkSession
    cut = spark.range(1).select(U.threshold(spark.createDataFrame(decided, "score double, accepted boolean"))).first()[0]
    assert max(r.score for r in own if r.verdict == "block") < cut <= min(r.score for r in own if r.verdict == "allow")
    yes, no = [s for s, y in decided if y], [s for s, y in decided if not y]
    gap = lambda t: abs(sum(s < t for s in yes) / len(yes) - sum(s >= t for s in no) / len(no))
    assert gap(cut) <= min(gap(k / 200 - 0.0025) for k in range(-1000, 1000)) + 1e-9
    assert sum((s >= cut) != y for s, y in decided) <= 0.1 * len(decided)


def test_one_class_or_nothing(spark):
    df = spark.createDataFrame([(1, "http://a.net/x"), (2, "http://b.com/y")], "page_id long, url string")
    assert [(r.page_id, r.verdict, r.score) for r in U.judge(df).orderBy("page_id").collect()] == [(1, "block", 0.0), (2, "allow", 0.0)]
    assert U.judge(df.limit(0)).count() == 0


def test_plan_has_no_python(pages):
    plan = U.judge(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
