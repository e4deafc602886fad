"""Plan shape: pushdown, partial aggregation, one join for a diff, no
single-partition exchange in the data path."""

from sluice.queries import catalog as C
from sluice.queries import fixtures as fx
from sluice.operators.netchange import net_change, net_delete_keys

from conftest import SF01


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_hwm_window_pushes_filter_to_scan(spark):
    p = plan(C.hwm_window(spark, SF01))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in p
    assert "LessThanOrEqual(o_orderdate" in p


def test_net_change_is_partially_aggregated(spark):
    p = plan(net_change(fx.events_feed(spark, SF01), ["user_id"]))
    assert "partial_max_by" in p
    assert "SinglePartition" not in p


def test_window_form_limits_before_shuffle(spark):
    p = plan(net_change(fx.events_feed(spark, SF01), ["user_id"], method="window"))
    assert "WindowGroupLimit" in p


def test_snapshot_diff_joins_once(spark):
    p = plan(C.snapshot_diff_q(spark, SF01))
    assert p.count("FullOuter") == 1


def test_deletes_read_only_keys_and_action(spark):
    p = plan(net_delete_keys(fx.events_log(spark, SF01), ["user_id"], order_cols=["event_id"]))
    schema_lines = [ln for ln in p.split("\n") if "ReadSchema" in ln]
    assert schema_lines and all("props" not in ln for ln in schema_lines)


def test_merge_has_no_single_partition_exchange(spark):
    for q in (C.hwm_upsert, C.upsert_keep_extra, C.apply_changes, C.delete_by_key, C.row_diff):
        assert "SinglePartition" not in plan(q(spark, SF01)), q.__name__


def test_key_order_is_range_partitioned_not_global_sort(spark):
    p = plan(C.full_load(spark, SF01))
    assert "rangepartitioning" in p.lower() and "SinglePartition" not in p


def test_snapshot_diff_reduces_per_key_without_extra_exchange(spark):
    p = plan(C.snapshot_diff_q(spark, SF01))
    assert p.count("Exchange hashpartitioning") == 2   # one per snapshot, reused by the join


def test_snapshot_diff_refuses_duplicate_keys(spark):
    import pytest
    from sluice.sources.snapshot import snapshot_diff
    old = spark.createDataFrame([(1, "a"), (1, "b")], "id long, v string")
    new = spark.createDataFrame([(1, "a")], "id long, v string")
    with pytest.raises(Exception, match="duplicate key"):
        snapshot_diff(old, new, ["id"]).collect()


def test_pending_outbox_read_prunes_partitions(spark, scratch):
    from sluice.streaming.outbox import OutboxStore
    store = OutboxStore(spark, scratch)
    feed = spark.createDataFrame([(1, "INSERT")], "id long, _cdc_action string")
    for c in range(3):
        store.write_consume(feed, c)
    store.acknowledge([0, 1], "t")
    window, ids = store.pending_window("t")
    assert ids == [2]
    assert "PartitionFilters: [isnotnull(consume_id" in plan(window)
    assert [r.consume_id for r in window.select("consume_id").collect()] == [2]


def test_partitions_of_a_diff_never_change_it(spark):
    from sluice.sources.snapshot import snapshot_diff
    old = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a")], "id long, v string")
    new = spark.createDataFrame([(1, "b"), (2, "b"), (4, "a")], "id long, v string")
    plain = sorted(map(tuple, snapshot_diff(old, new, ["id"]).collect()))
    assert plain == sorted(map(tuple, snapshot_diff(old, new, ["id"], partitions=5).collect())) and len(plain) == 6


def test_diffs_sort_no_whole_rows_before_the_join(spark):
    from sluice.sources.snapshot import snapshot_diff, snapshot_net_change
    old = spark.range(1000).selectExpr("id", "cast(id AS string) AS v", "id % 7 AS w")
    new = old.selectExpr("id + 10 AS id", "v", "w + 1 AS w")
    for df in (snapshot_diff(old, new, ["id"]), snapshot_net_change(old, new, ["id"])):
        assert "SortAggregate" not in plan(df) and "ObjectHashAggregate" not in plan(df)
    assert plan(snapshot_net_change(old, new, ["id"])).count("Exchange hashpartitioning") <= 2


def test_net_change_of_two_snapshots_equals_the_reduced_feed(spark):
    from pyspark.sql import functions as F
    from sluice.operators.netchange import net_change
    from sluice.sources.snapshot import snapshot_diff, snapshot_net_change
    old = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, None, 2), (5, "e", 5)], "id long, v string, w long")
    new = spark.createDataFrame([(1, "a", None), (2, "B", 1), (3, None, None), (4, "d", 4)], "id long, v string, w long")
    feed = snapshot_diff(old, new, ["id"]).withColumn("consume_id", F.lit(1).cast("long"))
    want = net_change(feed, ["id"]).select("id", "v", "w", "_cdc_action")
    got = snapshot_net_change(old, new, ["id"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_key_order_spreads_a_hot_key(spark):
    from pyspark.sql import functions as F
    from sluice.operators.order import key_order
    df = spark.range(60_000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("k"),
                                    F.col("id").alias("v"))
    out = key_order(df, ["k"], partitions=8)
    sizes = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in sizes) < 20_000 * 0.9     # the hot key is split
    parts = out.select(F.spark_partition_id().alias("p"), "k").groupBy("p").agg(
        F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("p").collect()
    for a, b in zip(parts, parts[1:]):
        assert a.hi <= b.lo                                   # global key order holds


def test_jdbc_source_is_partitioned_and_pushes_the_window(spark):
    from pyspark.sql import functions as F
    from sluice.sinks.jdbc import JdbcSink, create_table_sql, derby_memory_url, q
    from sluice.sources.jdbc_source import read_jdbc_table
    url = derby_memory_url()
    df = spark.range(1000).selectExpr("id", "id * 2 AS v")
    JdbcSink(spark, url, "src", keys=["id"]).execute(create_table_sql("src", df.schema, ["id"]))
    df.write.format("jdbc").option("url", url).option("dbtable", q("src")).mode("append").save()
    src = read_jdbc_table(spark, url, "src", partition_col="id", num_partitions=4)
    assert src.rdd.getNumPartitions() == 4
    w = src.where(F.col("v") > 1500)
    assert "PushedFilters: [*IsNotNull(v), *GreaterThan(v,1500)]" in plan(w)
    assert w.count() == 249


def test_jdbc_source_ranges_follow_the_rows_not_the_span(spark):
    from pyspark.sql import functions as F
    from sluice.sinks.jdbc import derby_memory_url, q
    from sluice.sources.jdbc_source import read_jdbc_table
    url = derby_memory_url()
    df = spark.range(1000).select(F.when(F.col("id") < 900, F.col("id")).otherwise(F.col("id") + 10**12).alias("id"))
    df.unionAll(spark.sql("SELECT CAST(NULL AS BIGINT)")).write.format("jdbc").option("url", url).option("dbtable", q("gap")).save()
    src = read_jdbc_table(spark, url, "gap", partition_col="id", num_partitions=5)
    sizes = src.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 1001 and max(r["count"] for r in sizes) <= 260
    assert src.distinct().count() == 1001
