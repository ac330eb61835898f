"""Surrogate keys and driver-friendly renderings of binary values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of our own surrogate-key format.
KEY_SEPARATOR = "-"
NULL_SENTINEL = "_null_"


def surrogate_key(*cols: str | Column) -> Column:
    """sha256 hex of the columns as text, NULLs replaced by a sentinel, joined by '-'.

    Never NULL, so it is safe as a unique key.
    """
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_SENTINEL)) for c in cols]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256)


def hex_text(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(F.hex(c))


def portable(df: DataFrame) -> DataFrame:
    """Render a result for engine-neutral comparison: binary -> lower hex, decimal -> text,
    nested -> text, instants -> UTC wall-clock ``timestamp_ntz`` (so collecting them does not
    depend on the client's local zone). Names and order are kept. Built as one ``selectExpr``."""
    exprs = []
    for f in df.schema.fields:
        q = "`" + f.name.replace("`", "``") + "`"
        if isinstance(f.dataType, T.BinaryType):
            e = f"lower(hex({q}))"
        elif isinstance(f.dataType, (T.DecimalType, T.ArrayType, T.StructType, T.MapType)):
            e = f"cast({q} as string)"
        elif isinstance(f.dataType, T.TimestampType):
            e = f"cast({q} as timestamp_ntz)"
        else:
            e = q
        exprs.append(f"{e} AS {q}")
    return df.selectExpr(*exprs)
