"""Lossless staging: the fidelity cases through CSV and Parquet staged files."""

import datetime as dt
import decimal
import math

import pytest
from pyspark.sql import types as T

from sluice.sinks import staging

SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("txt", T.StringType()),
    T.StructField("amt", T.DecimalType(12, 4)),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("note", T.StringType()),
    T.StructField("flag", T.BooleanType()),
    T.StructField("f", T.DoubleType()),
    T.StructField("b", T.BinaryType()),
    T.StructField("d", T.DateType()),
    T.StructField("arr", T.ArrayType(T.LongType())),
    T.StructField("ltz", T.TimestampType()),
])

#: One row per entry: a text, a decimal(12,4), a timestamp and a double that are easily damaged.
CASES = [
    (None, None, None, None),
    ("", "0.0000", "1970-01-01 00:00:00", 0.0),
    ("__NULL__ but not quite", "-0.0001", "1969-12-31 23:59:59.999999", -0.0),
    ("Ærøskøbing / Łódź / ኢትዮጵያ / 🜁", "12345678.9012", "2038-01-19 03:14:08.000001", float("inf")),
    ("a,b;c\td", "0.1", "1999-12-31 23:59:60".replace(":60", ":59.5"), 0.1),
    ('""" \'quoted\' "', "-99999999.9999", "0001-01-01 00:00:00", float("nan")),
    ("first\r\nsecond\n\nlast", "1000", "9999-12-31 23:59:59.999999", 2.0 ** -1074),
    (" \t leading and trailing \t ", "3.1400", "2024-02-29 12:00:00.100000", 1.7976931348623157e308),
    ("C:\\dir\\\"x\"\\", "7", "2001-09-09 01:46:40", -2.5e-300),
    ("long " * 2000, "42.4242", "2020-06-30 23:59:59.000100", 1 / 3),
]
TEXTS, AMTS, TSS, FLOATS = zip(*CASES)


def rows():
    out = []
    for i in range(len(TEXTS)):
        out.append((i + 1, TEXTS[i], decimal.Decimal(AMTS[i]) if AMTS[i] else None,
                    dt.datetime.fromisoformat(TSS[i]) if TSS[i] else None, TEXTS[i],
                    None if i == 0 else (i % 2 == 0), FLOATS[i],
                    None if i == 0 else bytes([i, 0, 255]), None if i == 0 else dt.date(1, 1, i),
                    None if i == 0 else [i, None, -i],
                    None if i == 0 else dt.datetime(2026, 3, 29, 1, 30, i, i * 1000,
                                                    tzinfo=dt.timezone.utc)))
    return out


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return (math.isnan(a) and math.isnan(b)) or (a == b and math.copysign(1, a) == math.copysign(1, b))
    return a == b


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_fidelity_round_trip(spark, scratch, fmt):
    src = spark.createDataFrame(rows(), SCHEMA)
    up, _ = staging.stage_round_trip(spark, src, None, fmt, scratch, fmt)
    got = {r.id: tuple(r) for r in up.collect()}
    for r in rows():
        g = got[r[0]]
        for a, b in zip(r, g):
            if isinstance(a, (bytes, bytearray)):
                b = bytes(b)
            if isinstance(a, dt.datetime) and a.tzinfo is not None:
                a = a.astimezone(dt.timezone.utc).replace(tzinfo=None)
            assert same(a, b), (fmt, r[0], a, b)


def test_csv_refuses_sentinel_text(spark, scratch):
    src = spark.createDataFrame([(1, "__NULL__")], "id long, txt string")
    with pytest.raises(Exception, match="__NULL__"):
        staging.write_csv(src, scratch)


def test_csv_header_must_match(spark, scratch):
    src = spark.createDataFrame([(1, "a")], "id long, txt string")
    staging.write_csv(src, scratch)
    other = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    with pytest.raises(Exception):
        staging.read_csv(spark, scratch, other).collect()


def test_csv_bad_text_fails_typed_cast(spark, scratch):
    src = spark.createDataFrame([("1",), ("x",)], "id string")
    staging.write_csv(src, scratch)
    with pytest.raises(Exception):
        staging.read_csv(spark, scratch, T.StructType([T.StructField("id", T.LongType())])).collect()


def test_variant_round_trip(spark, scratch):
    src = spark.sql("""SELECT id, parse_json(j) AS v FROM VALUES
        (1, '{"a": [1, null, "x"], "b": {"c": 1.5}}'), (2, 'null'), (3, NULL) AS t(id, j)""")
    for fmt in ("csv", "parquet"):
        up, _ = staging.stage_round_trip(spark, src, None, fmt, f"{scratch}/{fmt}", fmt)
        got = {r.id: r.j for r in up.selectExpr("id", "to_json(v) AS j").collect()}
        assert got == {1: '{"a":[1,null,"x"],"b":{"c":1.5}}', 2: "null", 3: None}, fmt


def test_positional_reads_skip_a_header_and_refuse_ragged_rows(spark, scratch):
    src = spark.createDataFrame([("1", "a,b"), ("2", None)], "n string, t string")
    staging.write_csv(src, f"{scratch}/h")
    got = staging.read_positional_csv(spark, f"{scratch}/h", ["x", "y"], header=True, with_file=True)
    assert sorted((r.x, r.y) for r in got.collect()) == [("1", "a,b"), ("2", None)]
    assert all(r.file_name.endswith(".csv") for r in got.collect())
    spark.createDataFrame([('"1","a"',), ('"2"',)], "value string").coalesce(1).write.text(f"{scratch}/r")
    with pytest.raises(Exception):
        staging.read_positional_csv(spark, f"{scratch}/r", ["x", "y"]).collect()


def test_files_are_bounded_by_bytes(spark, scratch, monkeypatch):
    monkeypatch.setattr(staging, "FILE_BYTES", 50_000)
    wide = spark.range(200, numPartitions=1).selectExpr("id", "repeat('x', 1000) AS t")
    assert 40 <= staging.rows_per_file(wide, 50_000) <= 50
    staging.write_csv(wide, scratch, staging.rows_per_file(wide, 50_000))
    from sluice import fs
    assert 4 <= len([n for n in fs.list_names(spark, scratch) if n.endswith(".csv")]) <= 6
