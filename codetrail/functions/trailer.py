"""Calldata trailer: slicing, validation, decoding and splitting as Column expressions.

Layout at the end of the calldata, with n = byte length and 1-based positions::

    ... | code (L bytes) | L (1 byte) | schema id (1 byte) | marker (16 bytes)
          n-17-L .. n-18    n-17         n-16                n-15 .. n
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the trailer format (must equal the reference's constants).
MARKER_HEX = "80218021802180218021802180218021"
SCHEMA_ID_HEX = "00"
MARKER_BYTES = 16
MIN_CALLDATA_BYTES = 18          # rows with n <= 18 are not read at all
HEADER_BYTES = 17                # marker + schema id + length byte
MAX_CODE_BYTES = 255


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def binary_lit(hex_text: str) -> Column:
    """A binary literal from hex text (X'..')."""
    return F.unhex(F.lit(hex_text))


def byte_length(col: Column | str) -> Column:
    return F.octet_length(_c(col))


def byte_slice(col: Column | str, start: Column, length: Column | int) -> Column:
    """1-based slice of a binary; start/length may be columns."""
    ln = F.lit(length) if isinstance(length, int) else length
    return F.substring(_c(col), start.cast("int"), ln.cast("int"))


def byte_to_int(col: Column | str) -> Column:
    """Unsigned value of a 1-byte binary (0..255) as bigint."""
    return F.conv(F.hex(_c(col)), 16, 10).cast("long")


def tail_marker(data: Column | str, n: Column) -> Column:
    return byte_slice(data, n - 15, MARKER_BYTES)


def schema_id(data: Column | str, n: Column) -> Column:
    return byte_slice(data, n - 16, 1)


def code_len(data: Column | str, n: Column) -> Column:
    return byte_to_int(byte_slice(data, n - 17, 1))


def is_valid_trailer(marker: Column, sid: Column, length: Column, n: Column) -> Column:
    return (
        (marker == binary_lit(MARKER_HEX))
        & (sid == binary_lit(SCHEMA_ID_HEX))
        & length.between(1, MAX_CODE_BYTES)
        & (n > F.lit(HEADER_BYTES) + length)
    )


def decode_code(data: Column | str, n: Column, length: Column) -> Column:
    """UTF-8 text of the code bytes; invalid sequences become U+FFFD."""
    raw = byte_slice(data, n - HEADER_BYTES - length, length)
    return F.make_valid_utf8(raw.cast("string"))


def multi_code(data: Column | str, n: Column, marker: Column, sid: Column, length: Column) -> Column:
    """Decoded payload when the trailer is valid, else NULL (no otherwise branch)."""
    return F.when(is_valid_trailer(marker, sid, length, n), decode_code(data, n, length))


def first_code(mc: Column | str) -> Column:
    """First comma field. Not blank-guarded: ',x' gives ''."""
    return F.split_part(_c(mc), F.lit(","), F.lit(1))


def second_code(mc: Column | str) -> Column:
    """Second comma field, blank -> NULL. Later fields are ignored; no trimming."""
    return F.nullif(F.split_part(_c(mc), F.lit(","), F.lit(2)), F.lit(""))


def effective_code(builder_code: Column | str, builder_code2: Column | str) -> Column:
    """The more specific (second) code wins when present and not blank."""
    return F.coalesce(F.nullif(_c(builder_code2), F.lit("")), _c(builder_code))


def encode_trailer_hex(code: Column, prefix_hex: Column | None = None, marker_hex: str = MARKER_HEX,
                       schema_hex: str = SCHEMA_ID_HEX) -> Column:
    """Hex text of calldata that carries ``code`` in a trailer (the encoder, for fixtures/tests).

    ``F.unhex`` of the result gives the binary calldata.
    """
    parts = []
    if prefix_hex is not None:
        parts.append(prefix_hex)
    parts += [
        F.lower(F.hex(F.encode(code, "UTF-8"))),
        F.lower(F.lpad(F.hex(F.octet_length(F.encode(code, "UTF-8"))), 2, "0")),
        F.lit(schema_hex),
        F.lit(marker_hex),
    ]
    return F.concat(*parts)
