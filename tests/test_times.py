"""Times of day and offsets beside instants; the entry without its optional parts."""

import datetime as dt
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from sluice.functions import columns as C
from sluice.sinks import staging

TIMES = ["00:00:00.000000", "23:59:59.999999", "12:00:00.000000", "03:04:05.000006", "10:20:30.500000"]


def test_times_through_text_micros_and_files(spark, scratch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*TIMES, None])], "i int, s string")
    df = df.select("i", "s", F.col("s").cast("time(6)").alias("t"))
    out = df.select("s", C.time_text(F.col("t")).alias("text"), "t", C.micros_time(C.time_micros(F.col("t"))).alias("again"))
    for r in out.collect():
        assert r["s"] is None or (r["text"] == r["s"] and r["again"] == r["t"] == dt.time.fromisoformat(r["s"]))
    staging.write_csv(df.drop("s"), f"{scratch}/csv")
    staging.write_parquet(df.drop("s"), f"{scratch}/parquet")
    schema = df.drop("s").schema
    want = sorted(map(tuple, df.drop("s").collect()))
    assert sorted(map(tuple, staging.read_csv(spark, f"{scratch}/csv", schema).collect())) == want
    assert sorted(map(tuple, spark.read.schema(schema).parquet(f"{scratch}/parquet").collect())) == want


@pytest.mark.parametrize("text", ["2024-02-29 23:30:00.000001-03:00", "2024-01-01 00:10:00.000000+05:30", "1969-12-31 23:59:59.999999Z"])
def test_offset_is_kept_beside_the_instant(spark, text):
    df = spark.createDataFrame([(text,), (None,)], "s string").select(
        "s", F.to_timestamp("s", staging.CSV_OPTIONS["timestampFormat"]).alias("t"), C.offset_of(F.col("s")).alias("o"))
    rows = df.select("s", C.in_offset(F.col("t"), F.col("o")).alias("back"), "o").collect()
    assert all(r["s"] == r["back"] for r in rows) and [r["o"] is None for r in rows] == [False, True]


def test_core_queries_without_the_optional_parts(monkeypatch, capsys):
    core = {k for k in E.queries() if not k.startswith("op") and k != "pipeline"} | {
        k for k in E.queries() if k.startswith("outbox")}
    for name in ("sluice.llm.queries", "corpus_pipeline"):
        monkeypatch.setitem(sys.modules, name, None)
    assert set(E.queries()) == core == set(E.oracle_sql())
    assert "left out" in capsys.readouterr().err
