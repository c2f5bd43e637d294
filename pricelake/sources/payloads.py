"""Flatten landed JSON payloads into raw rows, without UDFs and without a shuffle.

A payload is one row ``{asset_id, fetched_at, payload}`` (``payload`` as JSON
text or already parsed). Everything inside one payload -- last-wins on a
repeated timestamp, the volume/cap lookup by timestamp, candles by date --
is done with array functions on that row, so the work is local to the task
holding the payload; only the candle merge joins two payload tables, and it
joins payload rows (one per asset fetch), not points.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pricelake import schemas
from pricelake.functions import epoch_ms_to_date, epoch_ms_to_ts, iso_text_to_date

ENVELOPE_KEYS = ("asset_id", "fetched_at")


def _parsed(df: DataFrame, kind: str, col: str = "payload") -> Column:
    if isinstance(df.schema[col].dataType, StringType):
        return F.from_json(F.col(col), schemas.ENVELOPE_KINDS[kind])
    return F.col(col)


def _short(points: Column, size: int) -> Column:
    """Whether an array holds a point without a time, or not of ``size`` members.
    A missing array holds none."""
    def bad(x):
        return x.isNull() | (F.size(x) != size) | F.get(x, F.lit(0)).isNull()
    return F.exists(F.coalesce(points, F.array().cast("array<array<double>>")), lambda x: F.coalesce(bad(x), F.lit(True)))


def split_payloads(df: DataFrame, kind: str, col: str = "payload",
                   keys: Sequence[str] = ENVELOPE_KEYS) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine). Parsing is lazy and per row; a bad payload loses only
    its own fetch. Quarantine rows keep the envelope keys, the text and a reason:
    ``unparseable``, or the first array (prices, volumes, caps, candles) holding a
    point without a time or of the wrong size. A chart whose text lacks an array is
    good and has no points of it; an array that is null or no array is not."""
    p = df.withColumn("__p", _parsed(df, kind, col))
    if kind == "candles":
        reason = (F.when(F.col("__p").isNull(), F.lit("unparseable"))
                  .when(_short(F.col("__p"), 5), F.lit("candle_arity")))
    elif kind == "market_chart":
        # text that is no JSON object parses to empty fields, like an object without them;
        # of a payload parsed before, a missing array cannot be told from a null
        broken = F.col("__p.prices").isNull()
        if isinstance(df.schema[col].dataType, StringType):
            keys_there = F.json_object_keys(F.col(col))
            lost = [F.array_contains(keys_there, a) & F.col(f"__p.{a}").isNull() for a in ("prices", "total_volumes", "market_caps")]
            broken = keys_there.isNull() | lost[0] | lost[1] | lost[2]
        reason = (F.when(F.col("__p").isNull() | broken, F.lit("unparseable"))
                  .when(_short(F.col("__p.prices"), 2), F.lit("point_shape"))
                  .when(_short(F.col("__p.total_volumes"), 2), F.lit("volume_shape"))
                  .when(_short(F.col("__p.market_caps"), 2), F.lit("cap_shape")))
    else:
        reason = F.when(F.col("__p").isNull(), F.lit("unparseable"))
    p = p.withColumn("__reason", reason)
    good = p.filter(F.col("__reason").isNull()) \
        .withColumn(col, F.col("__p")).drop("__p", "__reason")
    text = F.col(col) if isinstance(df.schema[col].dataType, StringType) else F.to_json(col)
    bad = p.filter(F.col("__reason").isNotNull()).select(
        *keys, F.lit(kind).alias("kind"), F.col("__reason").alias("reason"),
        text.alias("payload_text"))
    return good, bad


def unique_fetches(payloads: DataFrame, keys: Sequence[str] = ENVELOPE_KEYS, col: str = "payload") -> DataFrame:
    """One payload per fetch: a file delivered twice counts once (of differing
    payloads under one key the greatest, so a re-run picks the same)."""
    rest = [c for c in payloads.columns if c not in (*keys, col)]
    best = F.max(F.struct(col, *rest)).alias("__best")
    return payloads.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__best.{c}").alias(c) for c in (col, *rest)]) \
        .select(*payloads.columns)


def _bound(value: Column, fn) -> Column:
    """``fn`` of ``value`` computed once: a lambda's variable is a plain reference,
    where a repeated expression would be computed again for every element."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


_VOLUME, _CAP, _PRICE = 0, 1, 2


def _tagged(points: Column, kind: int) -> Column:
    return F.transform(
        F.coalesce(points, F.array().cast("array<array<double>>")),
        lambda x, i: F.struct(F.get(x, F.lit(0)).cast("bigint").alias("k"), F.lit(kind).alias("kind"), i.alias("pos"),
                              F.get(x, F.lit(1)).alias("v")))


def _chart_points(p: str) -> Column:
    """The finished points of one chart payload, in O(n log n).

    All three arrays are sorted together by (time, kind, position); of each
    (time, kind) the last stays. A time's volume and cap then stand right before
    its price, so each price looks at two neighbours.
    """
    entries = F.concat(_tagged(F.col(f"{p}.total_volumes"), _VOLUME), _tagged(F.col(f"{p}.market_caps"), _CAP),
                       _tagged(F.col(f"{p}.prices"), _PRICE))

    def last_of_each(s):
        def final(x, i):
            following = F.get(s, i + 1)
            return following.isNull() | (following["k"] != x["k"]) | (following["kind"] != x["kind"])
        return F.filter(s, final)

    def points(s):
        def before(x, i, kind):
            def at(n):
                e = F.get(s, i - n)
                return F.when((i >= n) & (e["k"] == x["k"]) & (e["kind"] == kind), e["v"])
            return F.coalesce(at(1), at(2))
        joined = F.transform(s, lambda x, i: F.struct(
            x["k"].alias("k"), x["kind"].alias("kind"), x["v"].alias("close"),
            before(x, i, _VOLUME).alias("volume"), before(x, i, _CAP).alias("cap")))
        return F.filter(joined, lambda x: (x["kind"] == _PRICE) & x["k"].isNotNull())

    return _bound(F.array_sort(entries), lambda s: _bound(last_of_each(s), points))


def _price_rows(p: DataFrame, keys: Sequence[str], points: Column, with_source_ts: bool) -> DataFrame:
    pt = F.col("__pt")
    out = [
        F.col("asset_id"),
        epoch_ms_to_date(pt["k"]).alias("price_date"),
        pt["open"].alias("open_usd"),
        pt["high"].alias("high_usd"),
        pt["low"].alias("low_usd"),
        pt["close"].alias("close_usd"),
        pt["volume"].alias("volume_usd"),
        pt["cap"].alias("market_cap_usd"),
        F.col("fetched_at").cast("date").alias("fetched_date"),
        F.col("fetched_at"),
    ]
    if with_source_ts:
        out.append(epoch_ms_to_ts(pt["k"]).alias("source_ts"))
    extra = [F.col(k) for k in keys if k not in ("asset_id", "fetched_at")]
    return p.select(*keys, F.explode(points).alias("__pt")).select(*out, *extra)


def _with_candles(points: Column, candle_map: Column | None) -> Column:
    """Points with open, high and low of their date (missing: NULL); done before
    the explode, so the map is not copied to the rows."""
    def one(x):
        if candle_map is None:
            none = F.lit(None).cast("double")
            ohl = [none.alias("open"), none.alias("high"), none.alias("low")]
        else:
            c = F.try_element_at(candle_map, epoch_ms_to_date(x["k"]))
            ohl = [c["o"].alias("open"), c["h"].alias("high"), c["l"].alias("low")]
        return F.struct(x["k"].alias("k"), *ohl, x["close"].alias("close"), x["volume"].alias("volume"), x["cap"].alias("cap"))
    return F.transform(points, one)


def parse_market_chart(payloads: DataFrame, keys: Sequence[str] = ENVELOPE_KEYS,
                       col: str = "payload", with_source_ts: bool = True) -> DataFrame:
    """Raw price rows: one per distinct timestamp of ``prices`` (last wins);
    volume and cap looked up by the same timestamp, missing -> NULL."""
    p = payloads.select(*keys, _parsed(payloads, "market_chart", col).alias("__p"))
    return _price_rows(p, keys, _with_candles(_chart_points("__p"), None), with_source_ts)


def candles_by_date(candles: DataFrame, keys: Sequence[str] = ENVELOPE_KEYS,
                    col: str = "payload", resample: str | None = None) -> DataFrame:
    """Per candle payload: map date -> (open, high, low), a row per fetch.

    Default: the last candle of a date wins (all three values from it).
    ``resample="ohlc"``: a daily resample -- the first candle's open, the
    highest high and the lowest low of the date. A payload holding any malformed
    candle yields no map (the merge for that fetch is skipped, the price rows
    stay)."""
    if resample not in (None, "ohlc"):
        raise ValueError(f"unknown resample {resample!r}")
    c = candles.select(*keys, _parsed(candles, "candles", col).alias("__c"))
    c = unique_fetches(c.filter(F.col("__c").isNotNull() & ~_short(F.col("__c"), 5)), keys, "__c")
    v = lambda x, i: F.get(x, F.lit(i))
    entries = F.array_sort(F.transform("__c", lambda x, i: F.struct(
        epoch_ms_to_date(v(x, 0)).alias("k"), i.alias("pos"), v(x, 1).alias("o"), v(x, 2).alias("h"), v(x, 3).alias("l"))))

    def last_of_day(s):
        return F.filter(s, lambda x, i: F.get(s, i + 1).isNull() | (F.get(s, i + 1)["k"] != x["k"]))

    def days(s):
        """One fold over the sorted candles: each day's first open, running high and low."""
        first = F.array().cast("array<struct<k:date,o:double,h:double,l:double>>")
        zero = F.struct(first.alias("done"), F.lit(None).cast("struct<k:date,o:double,h:double,l:double>").alias("day"))

        def step(acc, x):
            new = F.struct(x["k"].alias("k"), x["o"].alias("o"), x["h"].alias("h"), x["l"].alias("l"))
            day = acc["day"]
            same = F.coalesce(day["k"] == x["k"], F.lit(False))
            grown = F.struct(day["k"].alias("k"), day["o"].alias("o"), F.greatest(day["h"], x["h"]).alias("h"),
                             F.least(day["l"], x["l"]).alias("l"))
            closed = F.when(same | day.isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(day)))
            return F.struct(closed.alias("done"), F.when(same, grown).otherwise(new).alias("day"))
        return F.aggregate(s, zero, step, lambda acc: F.when(acc["day"].isNull(), acc["done"]).otherwise(
            F.concat(acc["done"], F.array(acc["day"]))))

    chosen = _bound(entries, last_of_day if resample is None else days)
    pairs = F.transform(chosen, lambda x: F.struct(x["k"], F.struct(x["o"].alias("o"), x["h"].alias("h"), x["l"].alias("l"))))
    return c.select(*keys, F.map_from_entries(pairs).alias("candle_map"))


def merge_ohlc(charts: DataFrame, candles: DataFrame | None,
               keys: Sequence[str] = ENVELOPE_KEYS, col: str = "payload",
               resample: str | None = None) -> DataFrame:
    """Parse the chart payloads and set open/high/low from the candle payload of
    the same fetch (matched on ``keys``) for the same date; the candle close is
    not used. Fetches without a usable candle payload keep NULLs. A chart or
    candle payload delivered twice counts once."""
    charts = unique_fetches(charts, keys, col)
    if candles is None:
        return parse_market_chart(charts, keys, col)
    # payload-level join: one row per asset fetch on each side
    joined = charts.join(candles_by_date(candles, keys, col, resample), list(keys), "left")
    p = joined.select(*keys, "candle_map", _parsed(joined, "market_chart", col).alias("__p"))
    points = _with_candles(_chart_points("__p"), F.col("candle_map"))
    return _price_rows(p.withColumn("__points", points).select(*keys, "__points"), keys, F.col("__points"), True)


def parse_metadata(infos: DataFrame, keys: Sequence[str] = ENVELOPE_KEYS,
                   col: str = "payload") -> DataFrame:
    """Raw metadata rows: one per info payload, keyed by the requested asset id."""
    p = infos.select(*keys, _parsed(infos, "info", col).alias("__p"))
    return p.select(
        "asset_id",
        F.col("__p.name").alias("name"),
        F.col("__p.symbol").alias("symbol"),
        F.try_to_date(F.col("__p.genesis_date"), "yyyy-MM-dd").alias("genesis_date"),
        F.col("__p.market_data.ath.usd").alias("ath_usd"),
        iso_text_to_date(F.col("__p.market_data.ath_date.usd")).alias("ath_date"),
        "fetched_at",
    )


def stamp_batch(df: DataFrame, batch_ts) -> DataFrame:
    """One fetch time for the whole run (passed in, never read from the clock here)."""
    from pricelake.functions import as_ts_lit
    ts = as_ts_lit(batch_ts)
    return df.withColumn("fetched_at", ts).withColumn("fetched_date", ts.cast("date"))
