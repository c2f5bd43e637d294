"""Scalar column expressions (all JVM-side, no UDF)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = "Column | str"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_date_lit(d) -> Column:
    """A DATE literal from a date, ISO text or Column (kept as is)."""
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def as_ts_lit(ts) -> Column:
    """A TIMESTAMP_NTZ literal (wall clock in UTC) from datetime or ISO text.

    Built from text, so neither the Python process's nor the session's time
    zone can shift it."""
    if isinstance(ts, Column):
        return ts
    if isinstance(ts, str):
        ts = _dt.datetime.fromisoformat(ts)
    if ts.tzinfo is not None:
        ts = ts.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


EPOCH_NTZ = "1970-01-01 00:00:00"
MS_PER_DAY = 86_400_000


def safe_div(num, den) -> Column:
    """NULL when the denominator is 0 or NULL (ANSI-safe)."""
    return F.try_divide(_c(num), _c(den))


def pct_change(new, base) -> Column:
    """(new - base) / base * 100, NULL on a zero or missing base."""
    return safe_div(_c(new) - _c(base), _c(base)) * F.lit(100.0)


def week_start(d, first_day: str = "sunday") -> Column:
    """First day of the week holding ``d``; weeks start on Sunday by default.

    ``trunc(d, 'week')`` starts on Monday, so Sunday weeks are computed from
    ``dayofweek`` (1 = Sunday .. 7 = Saturday).
    """
    d = _c(d)
    if first_day == "sunday":
        return F.date_sub(d, F.dayofweek(d) - 1)
    if first_day == "monday":
        return F.trunc(d, "week")
    raise ValueError(f"unknown first_day {first_day!r}")


def epoch_ms_to_date(ms) -> Column:
    """UTC calendar date of an epoch-milliseconds number (day arithmetic, so
    the session time zone plays no part)."""
    days = F.floor(_c(ms).cast("bigint") / F.lit(MS_PER_DAY)).cast("int")
    return F.date_add(F.lit(_dt.date(1970, 1, 1)), days)


def epoch_ms_to_ts(ms) -> Column:
    """UTC wall-clock timestamp (NTZ) of an epoch-milliseconds number."""
    secs = (_c(ms).cast("bigint").cast("decimal(20,3)") / F.lit(1000)).cast("decimal(18,6)")
    return F.lit(EPOCH_NTZ).cast("timestamp_ntz") + \
        F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def ntz_to_epoch_ms(ts) -> Column:
    """Epoch milliseconds of a UTC wall-clock (NTZ) timestamp."""
    return F.timestamp_diff("MILLISECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), _c(ts))


def iso_text_to_date(s) -> Column:
    """ISO date/time text -> date; trailing 'Z's dropped; bad text -> NULL."""
    core = F.substring(F.regexp_replace(_c(s), "Z+$", ""), 1, 10)
    return F.try_to_date(core, "yyyy-MM-dd")


def lookback_start(as_of, days: int) -> Column:
    return F.date_sub(as_of_date(as_of), int(days))


def as_of_date(as_of) -> Column:
    return as_date_lit(as_of)


def month_text(d) -> Column:
    return F.date_format(_c(d), "yyyy-MM")


# Display text. Fixed values that must equal the reference's formatting:
#   missing value -> "N/A"; price >= 1000 -> "$" + thousands-grouped, 0 decimals;
#   price < 1000 -> "$" + 4 decimals; percent -> sign, 2 decimals, "%";
#   billions -> "$" + value/1e9 with 1 decimal + "B".
NA_TEXT = "N/A"


def fmt_price(v) -> Column:
    v = _c(v)
    return (F.when(v.isNull() | F.isnan(v), F.lit(NA_TEXT))
            .when(v >= 1000, F.concat(F.lit("$"), F.format_number(v, 0)))
            .otherwise(F.concat(F.lit("$"), F.regexp_replace(F.format_number(v, 4), ",", ""))))


def fmt_pct(v) -> Column:
    v = _c(v)
    body = F.regexp_replace(F.format_number(v, 2), ",", "")
    return (F.when(v.isNull() | F.isnan(v), F.lit(NA_TEXT))
            .otherwise(F.concat(F.when(v >= 0, F.lit("+")).otherwise(F.lit("")), body, F.lit("%"))))


def fmt_billions(v) -> Column:
    v = _c(v)
    body = F.regexp_replace(F.format_number(v / F.lit(1e9), 1), ",", "")
    return (F.when(v.isNull() | F.isnan(v), F.lit(NA_TEXT))
            .otherwise(F.concat(F.lit("$"), body, F.lit("B"))))


# Staleness classes of the status page (calendar days since the last ingest).
# Fixed values: <= 1 day "ok", <= 2 days "warn", else "error".
STALE_OK_DAYS = 1
STALE_WARN_DAYS = 2


def staleness_class(days) -> Column:
    days = _c(days)
    return (F.when(days.isNull(), F.lit("error"))
            .when(days <= STALE_OK_DAYS, F.lit("ok"))
            .when(days <= STALE_WARN_DAYS, F.lit("warn"))
            .otherwise(F.lit("error")))


def valid_price(c) -> Column:
    """close IS NOT NULL AND close > 0, NaN excluded (NaN > 0 is true in Spark)."""
    c = _c(c)
    return c.isNotNull() & ~F.isnan(c) & (c > 0)
