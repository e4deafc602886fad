"""Keyed write operators and column functions on small frames."""

import pytest
from pyspark.sql import functions as F

from sluice.functions.columns import check_target_columns, exclude, lower_cols, nan_to_null, replace
from sluice.operators import keys as K
from sluice.operators import merge as M
from sluice.operators import reconcile as R


@pytest.fixture()
def target(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, None, 30)],
                                 "id long, v string, extra long")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_upsert_update_keeps_target_only(spark, target):
    ch = spark.createDataFrame([(2, "B"), (4, "D")], "id long, v string")
    assert rows(M.upsert(target, ch, ["id"])) == rows(spark.createDataFrame(
        [(1, "a", 10), (2, "B", 20), (3, None, 30), (4, "D", None)], "id long, v string, extra long"))


def test_upsert_replace_resets_target_only(spark, target):
    ch = spark.createDataFrame([(2, "B")], "id long, v string")
    got = dict((r.id, r.extra) for r in M.upsert(target, ch, ["id"], on_match="replace").collect())
    assert got == {1: 10, 2: None, 3: 30}


def test_upsert_refuses_unknown_columns(spark, target):
    with pytest.raises(ValueError, match="missing in the target"):
        M.upsert(target, spark.createDataFrame([(1, "x")], "id long, nope string"), ["id"])


def test_delete_null_key_never_matches(spark):
    t = spark.createDataFrame([(1, "a"), (None, "n")], "id long, v string")
    d = spark.createDataFrame([(None,), (1,)], "id long")
    assert rows(M.delete_by_key(t, d, ["id"])) == [(None, "n")]


def test_all_key_columns_upsert_keeps_rows(spark):
    t = spark.createDataFrame([(1, 1), (1, 2)], "a long, b long")
    ch = spark.createDataFrame([(1, 2), (2, 2)], "a long, b long")
    assert rows(M.upsert(t, ch, ["a", "b"])) == [(1, 1), (1, 2), (2, 2)]


def test_append_replay_same_run_does_not_duplicate(spark, target):
    add = spark.createDataFrame([(9, "z", 90)], "id long, v string, extra long")
    once = M.append(target, add, run_id="r1")
    twice = M.append(once, add, run_id="r1")
    assert twice.count() == 4
    assert M.append(twice, add, run_id="r2").count() == 5


def test_truncate_load_fills_target_only_with_null(spark, target):
    src = spark.createDataFrame([(7, "q")], "id long, v string")
    assert rows(M.truncate_load(target, src)) == [(7, "q", None)]


def test_key_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d")], "id long, v string")
    assert rows(K.duplicate_keys(df, ["id"])) == [(1, 2)]
    assert rows(K.null_keys(df, ["id"])) == [(None, "c")]
    with pytest.raises(ValueError, match="NULL"):
        K.check_keys(df.where("id IS NULL OR id = 2"), ["id"])
    with pytest.raises(ValueError, match="duplicate"):
        K.check_keys(df.where("id IS NOT NULL"), ["id"])
    names = spark.createDataFrame([("abc",), ("ABC",), ("x",), ("abc",)], "k string")
    assert rows(K.case_colliding_keys(names, "k")) == [("abc", 2)]
    with pytest.raises(ValueError, match="case"):
        K.check_keys(names.distinct(), ["k"], case_insensitive=True)


def test_left_diff_null_semantics(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "id long, v string")
    b = spark.createDataFrame([(1, "p"), (2, "x")], "id long, v string")
    assert rows(R.left_diff(a, b, ["id"])) == [(3, "y")]              # <> ignores NULL
    assert rows(R.left_diff(a, b, ["id"], null_safe=True)) == [(1, None), (3, "y")]


def test_compare_metrics_reports_missing_names(spark):
    s = spark.createDataFrame([(3, 5)], "row_count long, max_key long")
    t = spark.createDataFrame([(3, 6)], "row_count long, other long")
    got = {r.metric: (r.source_value, r.target_value, r.matches)
           for r in R.compare_metrics(s, t).collect()}
    assert got == {"row_count": (3, 3, True), "max_key": (5, None, False),
                   "other": (None, 6, False)}


def test_column_functions(spark):
    df = spark.createDataFrame([(1, float("nan"), "a"), (2, 1.5, "b")], "ID long, Val double, Txt string")
    low = lower_cols(df)
    assert low.columns == ["id", "val", "txt"]
    assert [r.val for r in nan_to_null(low).orderBy("id").collect()] == [None, 1.5]
    assert exclude(low, ["txt"]).columns == ["id", "val"]
    assert replace(low, {"txt": F.upper("txt")}).orderBy("id").first().txt == "A"
    with pytest.raises(ValueError, match="collide"):
        lower_cols(spark.createDataFrame([(1, 2)], "A long, a2 long").toDF("A", "a"))
    with pytest.raises(ValueError, match="no columns"):
        check_target_columns(low, ["id", "val"])


def test_sample_rows_and_empty_copy(spark):
    from sluice.sources.scan import empty_copy, sample_rows
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    few = sample_rows(orders, "o_orderkey", 10)
    keys = sorted(r["o_orderkey"] for r in orders.select("o_orderkey").collect())
    assert [r["o_orderkey"] for r in few.collect()] == [k for k in keys if k <= 10]
    assert "LessThanOrEqual(o_orderkey,10)" in few._jdf.queryExecution().executedPlan().toString()
    assert empty_copy(orders).schema == orders.schema and empty_copy(orders).count() == 0
