"""Typed literals that do not depend on the driver process's time zone.

``F.lit(naive_datetime)`` converts through the Python process's local zone, so the same
bound would shift on a driver that is not in UTC. Dates and instants are therefore written
as ISO text and cast by Spark under the session time zone (UTC, see ``session``); Catalyst
folds the cast, so the predicate still reaches the scan as a plain literal.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def typed_lit(v) -> Column:
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return F.lit(v.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    if isinstance(v, dt.date):
        return F.lit(v.isoformat()).cast("date")
    return F.lit(v)


def isin(col: Column, values) -> Column:
    """``col IN (values)`` with typed literals."""
    return col.isin([typed_lit(v) for v in values])
