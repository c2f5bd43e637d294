"""URL filter by the likelihood ratio of two character models, native only.

Accepted and rejected URLs (those that the path rules decide) give two
variable-order Markov models: counts of every character after contexts of up
to ``ORDER`` characters, smoothed by Witten-Bell interpolation down to the
uniform distribution. Grams are kept by their text, so no two share a count, and
both models sum to one. For every gram the model holds the log ratio (accepted
over rejected) where it was seen, and that of the back-off weights of a seen
context. A URL's score is the sum over its characters, each from the longest seen
gram, divided by its length. One in ``HOLD_OUT`` decided URLs (by the CRC-32 of
its text) teaches nothing: the threshold is calibrated on those, as the score at
which the two classes' error rates are closest to equal.

Everything is DataFrame work: counting explodes grams into a partial
aggregation. Each distinct gram of ``ORDER`` + 1 characters is resolved against the
model once; scoring joins the characters of the distinct URLs to that table, which
is broadcast while its counted size is small and shuffled beyond. The model is as
large as the URLs' variety of short grams, never collected.

Defined cases: a URL that is null or has no ``://`` has an empty host and path,
fits no rule, and a null URL scores as an empty text, 0; an empty table, or one
whose learnt URLs all fall in one class, leaves every ratio 0, and one whose held
out URLs do is calibrated on all decided ones, without both the threshold is 0; a
score at the threshold is allowed; very long URLs are whole; repeated rows count
each; the output has its own columns only, whatever others the table has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import join_staged, stage

ORDER = 3
HOLD_OUT = 4
ALPHABET = 256
SCORE_BINS = 4000
#: A gram of at most ORDER + 1 characters with two numbers, in memory.
GRAM_BYTES = 64
#: (verdict, host, path): the rule fits the host and its subdomains from that path on.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def apply_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else null."""
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):     # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _padded(url: Column) -> Column:
    return F.concat(F.lit("^" * ORDER), F.coalesce(url, F.lit("")))


def held_out(url: Column) -> Column:
    return F.crc32(F.encode(url, "UTF-8")) % HOLD_OUT == 0


def _gram_counts(urls: DataFrame) -> DataFrame:
    """(k, gram, acc, rej): counts of the grams of k characters."""
    at = F.explode(F.sequence(F.lit(ORDER + 1), F.length("padded")))
    chars = urls.filter(F.length("url") > 0).select("accepted", "padded", at.alias("i"))
    grams = [F.struct(F.lit(k).alias("k"), F.substr("padded", F.col("i") - (k - 1), F.lit(k)).alias("gram")) for k in range(1, ORDER + 2)]
    one = lambda c: F.sum(c.cast("long"))
    return chars.select("accepted", F.inline(F.array(*grams))).groupBy("k", "gram").agg(
        one(F.col("accepted")).alias("acc"), one(~F.col("accepted")).alias("rej"))


def train(pages: DataFrame, url_col: str = "url", rules=RULES) -> DataFrame:
    """The model: rows (k, kind, gram, ratio), staged. kind ``gram``: log ratio of
    a seen gram of k characters; kind ``back``: log ratio of the back-off weights
    of a context (k - 1 characters) seen before a k-th character."""
    url = F.col(url_col)
    _, verdict = apply_rules(url_host(url), url_path(url), rules)
    urls = pages.filter(~held_out(url)).select(url.alias("url"), _padded(url).alias("padded"), (verdict == "allow").alias("accepted")) \
        .filter("accepted is not null")
    counts = stage(_gram_counts(urls), "grams")
    both = counts.agg((F.sum("acc") > 0) & (F.sum("rej") > 0)).first()[0]
    if not both:
        return stage(counts.limit(0).select("k", F.lit("gram").alias("kind"), "gram", F.lit(0.0).alias("ratio")), "ratios")
    lower = None
    parts = []
    for k in range(1, ORDER + 2):
        seen = counts.filter(F.col("k") == k).withColumn("ctx", F.substr("gram", F.lit(1), F.lit(k - 1)))
        ctx = stage(seen.groupBy("ctx").agg(
            F.sum("acc").alias("na"), F.sum("rej").alias("nr"),
            F.sum((F.col("acc") > 0).cast("int")).alias("ta"), F.sum((F.col("rej") > 0).cast("int")).alias("tr")), "contexts")
        below = join_staged(seen, ctx, "ctx", "inner", row_bytes=GRAM_BYTES)
        if lower is None:
            below = below.withColumn("pa", F.lit(1.0 / ALPHABET)).withColumn("pr", F.lit(1.0 / ALPHABET))
        else:
            below = join_staged(below.withColumn("low", F.substr("gram", F.lit(2))), lower, "low", "inner", row_bytes=GRAM_BYTES)

        def smoothed(n: str, total: str, types: str, p: str) -> Column:
            t = F.col(types)
            return F.when(F.col(total) == 0, F.col(p)).otherwise((F.col(n) + t * F.col(p)) / (F.col(total) + t))

        level = stage(below.select("gram", smoothed("acc", "na", "ta", "pa").alias("pa"),
                                   smoothed("rej", "nr", "tr", "pr").alias("pr")), "level")
        weight = lambda n, t: F.when(F.col(n) == 0, F.lit(1.0)).otherwise(F.col(t) / (F.col(n) + F.col(t)))
        parts.append(level.select(F.lit(k).alias("k"), F.lit("gram").alias("kind"), "gram",
                                  (F.log("pa") - F.log("pr")).alias("ratio")))
        parts.append(ctx.select(F.lit(k).alias("k"), F.lit("back").alias("kind"), F.col("ctx").alias("gram"),
                                (F.log(weight("na", "ta")) - F.log(weight("nr", "tr"))).alias("ratio")))
        lower = level.select(F.col("gram").alias("low"), "pa", "pr")
    return stage(reduce(DataFrame.unionByName, parts), "ratios")


def resolved(grams: DataFrame, model: DataFrame) -> DataFrame:
    """(gram, ratio), staged: each gram of ``ORDER`` + 1 characters by the longest
    seen gram that it ends with."""
    out, total = grams, F.lit(0.0)
    for k in range(1, ORDER + 2):
        for kind, n in (("gram", k), ("back", k - 1)):
            start = F.lit(ORDER + 2 - k)
            known = model.filter((F.col("k") == k) & (F.col("kind") == kind)).select(F.col("gram").alias("__key"), F.col("ratio").alias(f"{kind}{k}"))
            out = join_staged(out.withColumn("__key", F.substr("gram", start, F.lit(n))), known, "__key", "left", row_bytes=GRAM_BYTES).drop("__key")
        total = F.coalesce(F.col(f"gram{k}"), F.coalesce(F.col(f"back{k}"), F.lit(0.0)) + total)
    return stage(out.select("gram", total.alias("ratio")), "resolved")


def score_urls(urls: DataFrame, model: DataFrame) -> DataFrame:
    """(url, score) of the distinct values of ``urls.url``: the mean over a URL's
    characters of the log ratio of the longest seen gram that ends there."""
    ends = F.explode(F.sequence(F.lit(ORDER + 1), F.length("url") + ORDER))
    chars = urls.select("url").filter(F.length("url") > 0).distinct() \
        .select("url", _padded(F.col("url")).alias("padded"), ends.alias("i")) \
        .select("url", F.substr("padded", F.col("i") - ORDER, F.lit(ORDER + 1)).alias("gram"))
    ratios = resolved(stage(chars.select("gram").distinct(), "url-grams"), model)
    return join_staged(chars, ratios, "gram", "inner", row_bytes=GRAM_BYTES).groupBy("url").agg(F.avg("ratio").alias("score"))


def threshold(decided: DataFrame) -> Column:
    """Calibrated on (score, accepted): where the share of accepted URLs below
    and of rejected URLs at or above it are closest to equal. 0 without both."""
    bins = decided.groupBy(F.round(F.col("score") * (SCORE_BINS / 20)).alias("bin")).agg(
        F.sum(F.col("accepted").cast("long")).alias("a"), F.sum((~F.col("accepted")).cast("long")).alias("r"))
    # at most a few thousand bins: their running sums are one array fold
    cell = F.collect_list(F.struct("bin", "a", "r"))
    lists = bins.agg(F.array_sort(cell).alias("cells"), F.sum("a").alias("na"), F.sum("r").alias("nr"))
    err = F.abs(F.col("below_a") / F.col("na") - (1 - F.col("below_r") / F.col("nr")))
    steps = (lists.filter("na > 0 and nr > 0").select("cells", "na", "nr", F.posexplode("cells").alias("i", "c"))
             .withColumn("below_a", F.aggregate(F.slice("cells", F.lit(1), F.col("i")), F.lit(0).cast("long"), lambda s, x: s + x.a))
             .withColumn("below_r", F.aggregate(F.slice("cells", F.lit(1), F.col("i")), F.lit(0).cast("long"), lambda s, x: s + x.r)))
    best = steps.agg(F.min(F.struct(err.alias("e"), F.col("c.bin").alias("bin"))).alias("b"))
    return F.coalesce(best.select((F.col("b.bin") - 0.5) / (SCORE_BINS / 20)).scalar(), F.lit(0.0))


def judge(pages: DataFrame, url_col: str = "url", id_col: str = "page_id", rules=RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score."""
    url = F.col(url_col)
    scores = stage(score_urls(pages.select(url.alias("url")), train(pages, url_col, rules)), "urls")
    rule, verdict = apply_rules(url_host(url), url_path(url), rules)
    rows = pages.select(F.col(id_col).alias("page_id"), url.alias("url"), url_host(url).alias("host"),
                        url_path(url).alias("path"), rule.alias("rule"), verdict.alias("ruled"))
    width = scores.agg(F.avg(F.octet_length("url"))).first()[0] or 0
    scored = join_staged(rows, scores, "url", "left", row_bytes=int(width) + 48).withColumn("score", F.coalesce("score", F.lit(0.0)))
    scored = stage(scored, "scored")
    decided = scored.filter("ruled is not null").select(held_out(F.coalesce("url", F.lit(""))).alias("held"), "score", (F.col("ruled") == "allow").alias("accepted"))
    sides = decided.filter("held").agg(F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("r")).first()
    cut = threshold(decided.filter("held") if sides["a"] and sides["r"] else decided)
    own = F.when(F.col("score") >= cut, F.lit("allow")).otherwise(F.lit("block"))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "score")
