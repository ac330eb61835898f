"""codetrail: Spark-native attribution analytics for transaction calldata trailers.

Every operator is a DataFrame -> DataFrame function built from Spark built-ins, so
Catalyst sees the whole plan (pushdown, pruning, partial aggregation).

Main entry points::

    from codetrail import attribute_transactions, attribute_transfers, daily_metrics
    from codetrail import Floors, Lookback, tx_window, metric_window
    from codetrail import delete_insert, merge, append, full_refresh, compact
"""

__version__ = "0.1.0"

from codetrail.functions.windows import Floors, Lookback, metric_window, tx_window  # noqa: E402
from codetrail.operators.attribution import (  # noqa: E402
    attribute_transactions,
    attribute_transfers,
    attribution_keys,
    extract_code,
    parse_trailer,
    select_transactions,
    select_transfers,
)
from codetrail.operators.metrics import (  # noqa: E402
    daily_metrics,
    fee_metrics,
    token_prices,
    transfer_metrics,
    tx_fees,
    tx_metrics,
)
from codetrail.operators.upsert import (  # noqa: E402
    append,
    compact,
    dedupe_latest,
    delete_insert,
    full_refresh,
    merge,
)
from codetrail.plans.models import ModelPaths, run_all  # noqa: E402

__all__ = [
    "Floors", "Lookback", "tx_window", "metric_window",
    "select_transactions", "parse_trailer", "extract_code", "attribute_transactions",
    "select_transfers", "attribution_keys", "attribute_transfers",
    "transfer_metrics", "tx_metrics", "tx_fees", "token_prices", "fee_metrics", "daily_metrics",
    "delete_insert", "merge", "append", "dedupe_latest", "full_refresh", "compact",
    "ModelPaths", "run_all",
]
