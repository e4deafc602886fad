"""Structured Streaming consume: replay after a failed batch leaves no
duplicates; several triggers become several consumes; late commits count."""

import pytest
from pyspark.sql import functions as F

from sluice.streaming.consume import consume_to_outbox
from sluice.streaming.outbox import OutboxStore

SCHEMA = "id long, v string, _cdc_action string, _cdc_is_update boolean"


def write_log(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_replayed_batch_does_not_duplicate(spark, scratch, monkeypatch):
    log = f"{scratch}/log"
    write_log(spark, log, [(i, "a", "INSERT", False) for i in range(20)])
    store = OutboxStore(spark, f"{scratch}/outbox")
    orig = OutboxStore.write_consume
    calls = {"n": 0}

    def flaky(self, feed, consume_id, loaded_at=None):
        orig(self, feed, consume_id, loaded_at)
        calls["n"] += 1
        if calls["n"] == 1:
            raise RuntimeError("injected after the write, before the offset commit")
    monkeypatch.setattr(OutboxStore, "write_consume", flaky)
    with pytest.raises(Exception):
        consume_to_outbox(spark, log, spark.createDataFrame([], SCHEMA).schema, store)
    monkeypatch.undo()
    consume_to_outbox(spark, log, spark.createDataFrame([], SCHEMA).schema, store)
    rows = store.rows()
    assert rows.count() == 20
    assert rows.select("consume_id").distinct().count() == 1


def test_each_trigger_is_one_consume_and_late_files_arrive(spark, scratch):
    log = f"{scratch}/log"
    schema = spark.createDataFrame([], SCHEMA).schema
    for f in range(3):
        write_log(spark, log, [(f * 10 + i, f"f{f}", "INSERT", False) for i in range(5)])
    store = OutboxStore(spark, f"{scratch}/outbox")
    new = consume_to_outbox(spark, log, schema, store, max_files_per_trigger=1)
    assert len(new) == 3
    # A change committed later (whatever its content) is picked up by the next run.
    write_log(spark, log, [(1, "late", "DELETE", False)])
    new2 = consume_to_outbox(spark, log, schema, store)
    assert len(new2) == 1 and min(new2) > max(new)
    late = store.rows().where(F.col("consume_id") == new2[0]).collect()
    assert [(r.id, r._cdc_action) for r in late] == [(1, "DELETE")]


def test_new_checkpoint_on_non_empty_outbox_refused(spark, scratch):
    from sluice import fs
    log = f"{scratch}/log"
    schema = spark.createDataFrame([], SCHEMA).schema
    write_log(spark, log, [(1, "a", "INSERT", False)])
    store = OutboxStore(spark, f"{scratch}/outbox")
    consume_to_outbox(spark, log, schema, store)
    fs.delete(spark, f"{scratch}/outbox/_checkpoint")
    with pytest.raises(RuntimeError, match="checkpoint is missing"):
        consume_to_outbox(spark, log, schema, store)


def test_raw_log_with_sequence_reduces_sequence_first(spark, scratch):
    """Several actions of one key inside one consume: the last by sequence wins,
    so an INSERT followed by a DELETE deletes."""
    from sluice.plans import job
    from sluice.sinks.native import NativeTable
    from sluice.spec import SyncSpec
    table = NativeTable(spark, f"{scratch}/t", keys=["id"], buckets=2)
    table.publish(upserts=spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"))
    cols = "id long, v string, _cdc_action string, _cdc_is_update boolean, _cdc_commit_seq long"
    log = spark.createDataFrame([(1, "x", "INSERT", False, 1), (1, "x", "DELETE", False, 2),
                                 (3, "y", "INSERT", False, 3), (3, "y", "DELETE", False, 4),
                                 (3, "z", "INSERT", False, 5)], cols)
    log.coalesce(1).write.parquet(f"{scratch}/log")
    spec = SyncSpec("src", "t", capture="stream", mode="upsert", keys=["id"], order_cols=["_cdc_commit_seq"],
                    change_log=f"{scratch}/log", outbox=f"{scratch}/outbox")
    s = job.run(spark, spec, log, table, change_log_schema=log.schema)
    assert (s["rows_written"], s["rows_deleted"]) == (1, 1)
    assert sorted(map(tuple, table.read().collect())) == [(2, "b"), (3, "z")]


def test_ledger_compaction_keeps_what_can_be_pending(spark, scratch):
    store = OutboxStore(spark, scratch)
    for c in (0, 2, 4):
        store.write_consume(spark.createDataFrame([(c,)], "id long"), c)
    for c in range(5):
        store.acknowledge([c], "t")
    assert store.compact_ledger(max_files=3)
    assert store.acked_ids("t") == {0, 2, 4}  # 1 and 3 left the outbox long ago
    from sluice import fs
    assert len([n for n in fs.list_names(spark, store.ledger_path) if n.endswith(".parquet")]) == 1


def test_acked_ids_are_pruned_below_the_outbox(spark, scratch):
    from sluice.plans import job
    from sluice.sinks.native import NativeTable
    from sluice.spec import SyncSpec
    table = NativeTable(spark, f"{scratch}/t", keys=["id"], buckets=2)
    table.publish(upserts=spark.createDataFrame([(0, "a")], "id long, v string"))
    spec = SyncSpec("src", "t", capture="stream", mode="upsert", keys=["id"],
                    change_log=f"{scratch}/log", outbox=f"{scratch}/outbox")
    for i in range(1, 4):
        write_log(spark, f"{scratch}/log", [(i, f"v{i}", "INSERT", False)])
        s = job.run(spark, spec, spark.createDataFrame([], SCHEMA), table,
                    change_log_schema=spark.createDataFrame([], SCHEMA).schema)
        assert s["status"] == "ok"
    assert len(table.acked()) <= 1
    assert sorted(r.id for r in table.read().collect()) == [0, 1, 2, 3]


def test_processing_time_trigger_consumes_until_stopped(spark, scratch):
    log = f"{scratch}/log"
    schema = spark.createDataFrame([], SCHEMA).schema
    write_log(spark, log, [(i, "a", "INSERT", False) for i in range(3)])
    store = OutboxStore(spark, f"{scratch}/outbox")
    new = consume_to_outbox(spark, log, schema, store, processing_time="1 second", timeout_s=15)
    assert new and store.rows().count() == 3


def test_missing_change_log_means_nothing_to_consume(spark, scratch):
    store = OutboxStore(spark, f"{scratch}/outbox")
    assert consume_to_outbox(spark, f"{scratch}/no_log_yet",
                             spark.createDataFrame([], SCHEMA).schema, store) == []


def stream_spec(scratch, target="t", **more):
    from sluice.spec import SyncSpec
    return SyncSpec("src", target, capture="stream", mode="upsert", keys=["id"],
                    change_log=f"{scratch}/log", outbox=f"{scratch}/outbox", **more)


def deliver(spark, scratch, table, target="t", schema=SCHEMA, **more):
    from sluice.plans import job
    return job.run(spark, stream_spec(scratch, target, **more), spark.createDataFrame([], schema), table,
                   change_log_schema=spark.createDataFrame([], schema).schema)


def table_of(spark, scratch, name="t"):
    from sluice.sinks.native import NativeTable
    t = NativeTable(spark, f"{scratch}/{name}", keys=["id"], buckets=2)
    t.publish(upserts=spark.createDataFrame([(0, "a")], "id long, v string"))
    return t


def test_several_commits_of_a_key_between_runs(spark, scratch):
    """Without a column to order by, the commit time of the files does."""
    import time
    table = table_of(spark, scratch)
    for v in ("one", "two", "three"):
        write_log(spark, f"{scratch}/log", [(1, v, "INSERT", False)])
        time.sleep(0.05)
    write_log(spark, f"{scratch}/log", [(0, "a", "DELETE", False)])
    assert deliver(spark, scratch, table)["status"] == "ok"
    assert [tuple(r) for r in table.read().collect()] == [(1, "three")]
    assert deliver(spark, scratch, table)["status"] == "no_changes"


def test_purge_waits_for_every_target(spark, scratch):
    a, b = table_of(spark, scratch, "a"), table_of(spark, scratch, "b")
    deliver(spark, scratch, a, "a")
    deliver(spark, scratch, b, "b")       # nothing there yet, but both are known now
    write_log(spark, f"{scratch}/log", [(1, "x", "INSERT", False)])
    assert deliver(spark, scratch, a, "a")["consumes_purged"] == 0
    assert deliver(spark, scratch, b, "b")["consumes_purged"] == 1
    for t in (a, b):
        assert sorted(map(tuple, t.read().collect())) == [(0, "a"), (1, "x")]


def test_a_log_cleaned_too_early_stops_the_run(spark, scratch):
    from sluice import fs
    from sluice.streaming.consume import StaleFeed
    schema = SCHEMA + ", _cdc_seq long"
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{scratch}/log")
    table = table_of(spark, scratch)
    put([(1, "x", "INSERT", False, 1), (2, "x", "INSERT", False, 2)])
    deliver(spark, scratch, table, schema=schema, order_cols=["_cdc_seq"])
    put([(3, "x", "INSERT", False, 3)])
    deliver(spark, scratch, table, schema=schema, order_cols=["_cdc_seq"])
    fs.delete(spark, f"{scratch}/log")    # retention took 4 as well, before it was consumed
    put([(5, "x", "INSERT", False, 5)])
    with pytest.raises(StaleFeed, match="full reload"):
        deliver(spark, scratch, table, schema=schema, order_cols=["_cdc_seq"])
    assert table.read().count() == 4


def test_the_rows_of_a_commit_are_not_joined_in_one_task(spark):
    """Whatever the size of the batch: one commit's rows stay where they were read."""
    from sluice.streaming.consume import with_commit_time
    name = "part-00000-01234567-89ab-cdef-0123-456789abcdef-c000.snappy.parquet"
    batch = spark.range(0, 400, 1, 4).select("id", F.lit(name).alias("_cdc_file"),
                                             F.timestamp_seconds(F.col("id")).alias("_cdc_written_at"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = with_commit_time(batch).withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(r["id"] for r in rows) == list(range(400))
    assert len({r["part"] for r in rows}) == 4
    assert {r["_cdc_committed_at"].minute * 60 + r["_cdc_committed_at"].second for r in rows} == {399}
