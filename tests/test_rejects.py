"""Rows that do not fit the declared types stand aside; values compared one by one; ceilings from footers."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF01
from sluice.functions.columns import TooManyRejects, check_rejects, split_rejects, try_decode
from sluice.operators import reconcile as R
from sluice.sinks import staging
from sluice.sinks.native import NativeTable
from sluice.sources import scan

DDL = ("k bigint not null, d decimal(6,2), b boolean, day date, t timestamp, x binary, l array<int>, f double, s string")
GOOD = ("7", "-12.50", "true", "2024-02-29", "2024-02-29 10:00:00.000001+02:00", "00FF", "[1,2]", "1e3", "")
BAD = {"k": "7.5", "d": "1.005", "b": "maybe", "day": "2023-02-29", "t": "noon", "x": "0G", "l": "[1", "f": "one"}


def text(spark, rows):
    return spark.createDataFrame(rows, T.StructType([T.StructField(n, T.StringType()) for n in T.StructType.fromDDL(DDL).names]))


def test_good_values_keep_their_types(spark):
    good, bad = split_rejects(try_decode(text(spark, [GOOD, ("1", *[None] * 8)]), T.StructType.fromDDL(DDL),
                                         {"t": staging.CSV_OPTIONS["timestampFormat"]}))
    assert bad.collect() == []
    assert [f.dataType for f in good.schema.fields] == [f.dataType for f in T.StructType.fromDDL(DDL).fields]
    rows = sorted(map(tuple, good.drop("t").collect()))
    assert rows[1] == (7, decimal.Decimal("-12.50"), True, dt.date(2024, 2, 29), bytearray(b"\x00\xff"), [1, 2], 1000.0, "")
    at = good.where("k = 7").select(F.date_format("t", "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    assert at == "2024-02-29 08:00:00.000001"


@pytest.mark.parametrize("column", BAD)
def test_each_bad_value_has_its_reason(spark, column):
    names = T.StructType.fromDDL(DDL).names
    row = tuple(BAD[column] if n == column else v for n, v in zip(names, GOOD))
    good, bad = split_rejects(try_decode(text(spark, [row, GOOD]), T.StructType.fromDDL(DDL),
                                         {"t": staging.CSV_OPTIONS["timestampFormat"]}))
    found = bad.collect()
    assert good.count() == 1 and len(found) == 1 and tuple(found[0])[:-1] == row
    assert len(found[0]["reasons"]) == 1 and found[0]["reasons"][0].startswith(f"{column}: {BAD[column]} is no ")


def test_null_keys_limits_and_unknown_columns(spark, scratch):
    schema = T.StructType.fromDDL("k bigint not null, v int")
    df = spark.createDataFrame([(None, "1"), ("2", "x"), ("y", "z"), ("3", None)], "k string, v string")
    decoded = try_decode(df, schema)
    assert check_rejects(decoded, 3) == 3
    with pytest.raises(TooManyRejects, match="3 rows do not fit, 2 are allowed; by column: k 2, v 2"):
        check_rejects(decoded, 2)
    with pytest.raises(ValueError, match="missing in the target"):
        try_decode(df.withColumn("w", F.lit("")), schema)
    staging.write_csv(df, f"{scratch}/files")
    good, bad = staging.read_csv_rejects(spark, f"{scratch}/files", schema, f"{scratch}/stored", max_rejects=3)
    assert [tuple(r) for r in good.collect()] == [(3, None)] and bad.count() == 3


def test_numbers_are_compared_by_value(spark):
    one = lambda ddl, v: spark.sql(f"SELECT CAST('{v}' AS {ddl}) AS m")
    same = [("decimal(12,2)", "1.50", "decimal(18,6)", "1.5"), ("bigint", "7", "string", "7.000"), ("double", "1e10", "bigint", "10000000000")]
    other = [("decimal(12,2)", "1.50", "decimal(18,6)", "1.500001"), ("string", "007", "bigint", "7"), ("string", "a", "string", "A"),
             ("decimal(38,0)", "9" * 28, "decimal(38,0)", "9" * 27 + "8")]
    for cases, want in ((same, True), (other, False)):
        for a, x, b, y in cases:
            assert R.compare_metrics(one(a, x), one(b, y)).first()["matches"] is want, (a, x, b, y)
    assert R.compare_metrics(one("int", "1").select(F.lit(None).cast("int").alias("m")),
                             one("int", "1").withColumnRenamed("m", "n")).where("matches").isEmpty()


def test_column_diff(spark):
    a = spark.createDataFrame([(1, "x", 1.0, None), (2, "y", 2.0, True), (3, "z", 3.0, None)], "k int, s string, v double, b boolean")
    b = spark.createDataFrame([(1, "x", 1.0, None), (2, "Y", 2.5, None), (4, "z", 3.0, None)], "k int, s string, v double, b boolean")
    got = sorted(map(tuple, R.column_diff(a, b.select("b", "v", "s", "k"), ["k"]).collect()), key=repr)
    assert got == sorted([(2, "s", "y", "Y", "changed"), (2, "v", "2.0", "2.5", "changed"), (2, "b", "true", None, "changed"),
                          (3, None, None, None, "source_only"), (4, None, None, None, "target_only")], key=repr)
    wide = b.withColumn("v", F.col("v").cast("decimal(18,6)"))
    assert {r["column"] for r in R.column_diff(b, wide, ["k"]).collect()} == set()
    with pytest.raises(ValueError, match="columns differ"):
        R.column_diff(a, b.drop("v"), ["k"])
    with pytest.raises(ValueError, match="duplicate key"):
        R.column_diff(a.unionByName(a), b, ["k"])


def test_footers_answer_without_reading_rows(spark, scratch):
    before = {k: spark.conf.get(k) for k in scan._PUSHED}
    try:
        for k, v in scan._PUSHED.items():
            spark.conf.set(k, v)
        plan = scan.footer_max(spark, f"{SF01}/orders.parquet", "o_orderkey")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "PushedAggregation: [MAX(o_orderkey)]" in plan
    df = spark.createDataFrame([(1, dt.date(2020, 1, 2), float("nan")), (None, None, 5.0)], "k int, d date, f double")
    df.write.parquet(scratch)
    assert scan.footer_ceiling(spark, scratch, "d") == scan.hwm_ceiling(df, "d")
    assert scan.footer_ceiling(spark, scratch, "k").value == "1"
    assert scan.footer_ceiling(spark, scratch, "f").value == "NaN"
    df.where("k is null").write.mode("overwrite").parquet(scratch)
    assert scan.footer_ceiling(spark, scratch, "k") is None
    assert {k: spark.conf.get(k) for k in before} == before


def test_defaults_of_target_only_columns(spark, scratch):
    rows = lambda lo, hi: spark.range(lo, hi).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    table = NativeTable(spark, scratch, keys=["k"], buckets=2, defaults={"n": "40 + 2"})
    table.publish(upserts=rows(0, 6).withColumn("n", F.col("k").cast("int")))
    table = NativeTable(spark, scratch)                        # keys and defaults come from the manifest
    table.publish(upserts=rows(4, 8))                          # in place: 4, 5 keep theirs, 6, 7 are new
    table.publish(upserts=rows(0, 2), on_match="replace")
    table.publish(upserts=rows(100, 102), append=True)
    got = {r["k"]: r["n"] for r in table.read().collect()}
    assert got == {0: 42, 1: 42, 2: 2, 3: 3, 4: 4, 5: 5, 6: 42, 7: 42, 100: 42, 101: 42}
    with pytest.raises(ValueError, match="unknown columns"):
        NativeTable(spark, f"{scratch}-2", keys=["k"], defaults={"z": "1"}).publish(upserts=rows(0, 1))
