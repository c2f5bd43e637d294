from pricelake.functions.columns import (  # noqa: F401
    as_date_lit, as_ts_lit, safe_div, pct_change, week_start, epoch_ms_to_date,
    epoch_ms_to_ts, ntz_to_epoch_ms, iso_text_to_date, lookback_start, as_of_date, month_text,
    fmt_price, fmt_pct, fmt_billions, staleness_class, valid_price,
)
