"""Parameters of the driver queries (the derived data covers January 2024)."""

import datetime as dt

from codetrail.functions.windows import Floors

CHAIN = "celo"
# Historical floors: Jan 1 excluded, Jan 2 partial for transactions, full for prices.
FLOORS = Floors(dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 7, 30, 0), dt.datetime(2024, 1, 2, 0, 0, 0))
# Run instants of the incremental checks.
AS_OF_FIRST = dt.datetime(2024, 1, 20, 0, 0, 0)
AS_OF_NEXT = dt.datetime(2024, 1, 20, 6, 0, 0)
AS_OF_METRIC = dt.datetime(2024, 1, 21, 9, 0, 0)
# Export window.
EXPORT_START = dt.datetime(2024, 1, 10, 0, 0, 0)
EXPORT_END = dt.datetime(2024, 1, 15, 0, 0, 0)
TOP_K = 10
ROUND_USD = 6
ROUND_FEE = 12
# Changed rows: a day whose rows move to the next one, a day whose rows are restated, a day that empties.
MOVED_DAY = dt.date(2024, 1, 5)
RESTATED_DAY = dt.date(2024, 1, 8)
EMPTIED_DAY = dt.date(2024, 1, 19)
SPOT_ROWS = 10
