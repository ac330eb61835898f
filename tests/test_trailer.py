"""Byte-level table of the trailer rules, and an encode -> decode round trip."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from codetrail import schemas
from codetrail.functions import trailer
from codetrail.functions.windows import Floors
from codetrail.operators import attribution as A

M = bytes.fromhex(trailer.MARKER_HEX)
FLOORS = Floors(__import__("datetime").date(2000, 1, 1), __import__("datetime").datetime(2000, 1, 1),
                __import__("datetime").datetime(2000, 1, 1))


def wrap(code: bytes, prefix: bytes = b"", sid: bytes = b"\x00", length=None) -> bytes:
    n = len(code) if length is None else length
    return prefix + code + bytes([n]) + sid + M


def tx_frame(spark, datas):
    import datetime as dt

    rows = []
    for i, data in enumerate(datas):
        row = {f.name: None for f in schemas.TRANSACTIONS.fields}
        row.update(block_time=dt.datetime(2024, 1, 1, 12), block_date=dt.date(2024, 1, 1), block_number=i,
                   hash=i.to_bytes(32, "big"), data=data, **{"from": b"\x01" * 20})
        rows.append(row)
    return spark.createDataFrame(rows, schemas.TRANSACTIONS)


def decode(spark, datas):
    out = A.attribute_transactions(tx_frame(spark, datas), FLOORS).orderBy("block_number")
    res = {r["block_number"]: r for r in out.collect()}
    return [res.get(i) for i in range(len(datas))]


def test_trailer_table(spark):
    cases = [
        (wrap(b"x" * 255), ("x" * 255, "x" * 255, None)),                 # n = 273, nothing before
        (wrap(b"a"), ("a", "a", None)),                                     # n = 19
        (wrap(b"ab", length=3), None),                                      # length one too large -> false
        (wrap(b","), (",", "", None)),                                      # effective code ''
        (wrap(b"a,"), ("a,", "a", None)),
        (wrap(b"a, b"), ("a, b", "a", " b")),                               # no trimming
        (wrap("héllo,wörld".encode()), ("héllo,wörld", "héllo", "wörld")),  # length counts bytes
        (wrap(b"ab\xffcd"), ("ab�cd", "ab�cd", None)),            # invalid UTF-8 still tagged
        (wrap(b"last", prefix=wrap(b"first")), ("last", "last", None)),    # only the last trailer counts
        (wrap(b"abc") + b"\x00", None),                                     # marker not at the end
        (wrap(b"abc", sid=b"\x01"), None),                                  # wrong schema id
        (b"\x61\xff\x00" + M, None),                                        # L = 255 > room
        (b"\x00\x00\x00" + M, None),                                        # L = 0
        (wrap(b"a,b,c"), ("a,b,c", "a", "b")),                              # third code ignored
    ]
    got = decode(spark, [c[0] for c in cases])
    for (data, exp), row in zip(cases, got):
        assert row is not None, data
        if exp is None:
            assert row["has_builder_code"] is False and row["multi_code"] is None
            assert row["builder_code"] is None and row["builder_code2"] is None
        else:
            assert row["has_builder_code"] is True
            assert (row["multi_code"], row["builder_code"], row["builder_code2"]) == exp


def test_short_and_null_data_dropped(spark):
    got = decode(spark, [b"", None, b"\x00\x00" + M, b"\x00" + b"\x00\x00" + M])
    assert got[0] is None and got[1] is None and got[2] is None  # 0 bytes, NULL, 18 bytes
    assert got[3] is not None and got[3]["has_builder_code"] is False  # 19 bytes, L = 0


def test_columns_and_order(spark):
    out = A.attribute_transactions(tx_frame(spark, [wrap(b"abc")]), FLOORS)
    assert out.columns == schemas.TX_ATTRIBUTED_COLUMNS


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",)), min_size=1, max_size=60),
                min_size=1, max_size=40))
def test_encode_decode_round_trip(spark, codes):
    codes = [c for c in codes if 1 <= len(c.encode()) <= 255]
    if not codes:
        return
    df = spark.createDataFrame([(i, c, random.Random(i).randbytes(i % 5).hex()) for i, c in enumerate(codes)],
                               "i int, code string, prefix string")
    enc = df.select("i", "code", F.unhex(trailer.encode_trailer_hex(F.col("code"), F.col("prefix"))).alias("d"))
    n = trailer.byte_length("d")
    dec = enc.select("i", "code", trailer.multi_code("d", n, trailer.tail_marker("d", n), trailer.schema_id("d", n),
                                                     trailer.code_len("d", n)).alias("mc"))
    for r in dec.collect():
        assert r["mc"] == r["code"]
