"""Dense row numbers: order, ties, hot keys, empty tables and the plan's shape."""

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from plan_text import executed_plan
from sluice.operators.rownumbers import dense_ids


def test_descending_order_with_ties_and_nulls(spark):
    rows = [(i, None if i % 5 == 0 else i % 7) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, k int")
    out = dense_ids(df, [F.col("k").desc_nulls_last()], partitions=8).orderBy("row_id").collect()
    assert [r["row_id"] for r in out] == list(range(1, 501))
    ks = [-1 if r["k"] is None else r["k"] for r in out]
    assert ks == sorted(ks, reverse=True)


def test_equal_rows_are_dealt_over_tasks(spark):
    df = spark.range(40_000).select(F.when(F.col("id") < 30_000, 3).otherwise(F.col("id")).alias("k"))
    out = dense_ids(df, ["k"], partitions=8)
    got = out.agg(F.min("row_id"), F.max("row_id"), F.count_distinct("row_id")).first()
    assert tuple(got) == (1, 40_000, 40_000)
    files = out.select(F.input_file_name().alias("f")).groupBy("f").count()
    assert files.agg(F.max("count")).first()[0] < 10_000
    assert out.where("row_id <= 30000").where("k <> 3").isEmpty()


def test_empty_and_clash(spark):
    df = spark.createDataFrame([], "k int, row_id int")
    assert dense_ids(df, ["k"], "n").collect() == []
    with pytest.raises(ValueError):
        dense_ids(df, ["k"])


def test_no_task_sorts_the_table(spark):
    lines = spark.read.parquet(f"{SF01}/lineitem.parquet")
    plan = executed_plan(dense_ids(lines, ["l_orderkey"], "n"))
    assert "SinglePartition" not in plan and "Window" not in plan and "Exchange hash" not in plan
