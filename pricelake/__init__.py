"""pricelake: keyed daily time-series analytics as lazy Spark DataFrame functions.

The user-level API, by layer (every function takes and returns DataFrames):

* sources: ``read_watchlist``, ``read_payloads``, ``parse_market_chart``,
  ``merge_ohlc``, ``parse_metadata``, ``stamp_batch``
* staging: ``stage_prices``, ``stage_metadata``, ``keep_latest``,
  ``select_assets``, ``lookback``
* features and marts: ``add_returns``, ``add_rolling``, ``add_drawdown``,
  ``fact_daily``, ``weekly_rollup``, ``latest_price``, ``dim_assets``
* quality: ``not_null``, ``unique``, ``unique_combo``, ``expression_is_true``,
  ``freshness``, ``run_suite``
* sinks and incremental: ``write_table``, ``upsert``, ``upsert_table``,
  ``incremental_slice``, ``incremental_features``
* the daily job: ``pricelake.plans.pipeline`` (ingest, build, check, loaders)
* streams: ``pricelake.streaming.jobs``
"""

from pricelake.operators.dedup import keep_latest  # noqa: F401
from pricelake.operators.features import add_drawdown, add_returns, add_rolling  # noqa: F401
from pricelake.operators.marts import (  # noqa: F401
    dim_assets, fact_daily, latest_price, weekly_rollup,
)
from pricelake.operators.quality import (  # noqa: F401
    expression_is_true, freshness, not_null, run_suite, unique, unique_combo,
)
from pricelake.operators.staging import (  # noqa: F401
    lookback, select_assets, stage_metadata, stage_prices,
)
from pricelake.plans.incremental import incremental_features, incremental_slice  # noqa: F401
from pricelake.sources.files import read_payloads, read_watchlist  # noqa: F401
from pricelake.sources.payloads import (  # noqa: F401
    merge_ohlc, parse_market_chart, parse_metadata, stamp_batch,
)
from pricelake.sources.sinks import upsert, upsert_table, write_table  # noqa: F401

__version__ = "0.1.0"
