"""The change log as files: equal commit times, numbered commits, gaps, emptied logs, what is pending."""

import pytest
from plan_text import ancestors, executed_plan
from pyspark.sql import functions as F

from sluice import fs
from sluice.streaming import feed as fd
from sluice.streaming.consume import StaleFeed
from test_streaming import SCHEMA, deliver, table_of, write_log


def parquet_files(spark, path):
    return sorted(n for n in fs.list_names(spark, path) if n.endswith(".parquet"))


def same_time(spark, path):
    for n in parquet_files(spark, path):
        fs.set_time(spark, f"{path}/{n}", 1_700_000_000_000)


def commit(spark, path, rows):
    return fd.append_commit(spark, path, spark.createDataFrame(rows, SCHEMA))


def content(table):
    return sorted(map(tuple, table.read().collect()))


def test_equal_commit_times_are_refused(spark, scratch):
    table, log = table_of(spark, scratch), f"{scratch}/log"
    write_log(spark, log, [(1, "x", "INSERT", False)])
    write_log(spark, log, [(1, "x", "DELETE", False)])
    same_time(spark, log)
    for _ in range(2):
        with pytest.raises(ValueError, match="share their time"):
            deliver(spark, scratch, table)
    assert content(table) == [(0, "a")]


def test_an_update_within_one_commit_is_no_tie(spark, scratch):
    table, log = table_of(spark, scratch), f"{scratch}/log"
    write_log(spark, log, [(0, "a", "DELETE", True), (0, "b", "INSERT", True)])
    write_log(spark, log, [(5, "x", "INSERT", False)])
    same_time(spark, log)
    assert deliver(spark, scratch, table)["status"] == "ok"
    assert content(table) == [(0, "b"), (5, "x")]


def test_numbers_order_commits_of_equal_time(spark, scratch):
    table, log = table_of(spark, scratch), f"{scratch}/log"
    for i, action in enumerate(["INSERT", "DELETE", "INSERT", "DELETE"]):
        assert commit(spark, log, [(1, f"v{i}", action, False), (100 + i, "x", "INSERT", False)]) == i + 1
    commit(spark, log, [(0, "again", "INSERT", False)])
    same_time(spark, log)
    assert deliver(spark, scratch, table)["status"] == "ok"
    assert content(table) == [(0, "again"), *((100 + i, "x") for i in range(4))]


@pytest.mark.parametrize("later", [[], [(3, "z", "INSERT", False)]])
def test_a_log_emptied_before_a_change_was_read(spark, scratch, later):
    table, log = table_of(spark, scratch), f"{scratch}/log"
    write_log(spark, log, [(1, "x", "INSERT", False)])
    assert deliver(spark, scratch, table)["status"] == "ok"
    write_log(spark, log, [(2, "y", "INSERT", False)])
    fs.delete(spark, log)
    if later:
        write_log(spark, log, later)
    with pytest.raises(StaleFeed, match="full reload required"):
        deliver(spark, scratch, table)
    assert content(table) == [(0, "a"), (1, "x")]


@pytest.mark.parametrize("gone", [(2,), (3,), (2, 3)])
def test_a_gap_between_numbered_commits(spark, scratch, gone):
    table, log = table_of(spark, scratch), f"{scratch}/log"
    commit(spark, log, [(1, "x", "INSERT", False)])
    assert deliver(spark, scratch, table)["status"] == "ok"
    for i in (2, 3):
        commit(spark, log, [(i, "x", "INSERT", False)])
    for n in parquet_files(spark, log):
        if int(n[1:11]) in gone:
            fs.delete(spark, f"{log}/{n}")
    with pytest.raises(StaleFeed, match=f"commit {gone[0]} .*full reload required"):
        deliver(spark, scratch, table)


def test_one_file_of_a_commit_missing(spark, scratch):
    table, log = table_of(spark, scratch), f"{scratch}/log"
    rows = spark.createDataFrame([(i, "x", "INSERT", False) for i in range(40)], SCHEMA)
    fd.append_commit(spark, log, rows.repartition(4))
    fs.delete(spark, f"{log}/{parquet_files(spark, log)[1]}")
    with pytest.raises(StaleFeed, match="commit 1 "):
        deliver(spark, scratch, table)


def test_a_commit_under_way_is_waited_for(spark, scratch):
    table, log = table_of(spark, scratch), f"{scratch}/log"
    commit(spark, log, [(1, "x", "INSERT", False)])
    aside = f"{log}/_staged/other"
    write_log(spark, aside, [(2, "y", "INSERT", False)])
    fs.create_exclusive(spark, f"{log}/_commits/c0000000002", aside)     # its writer has not got further
    assert deliver(spark, scratch, table)["status"] == "ok"
    part = parquet_files(spark, aside)[0]
    fs.rename(spark, f"{aside}/{part}", f"{log}/c0000000002-00000-of-00001-x.parquet")
    fs.delete(spark, aside)
    assert deliver(spark, scratch, table)["status"] == "ok"
    assert content(table) == [(0, "a"), (1, "x"), (2, "y")]


def test_old_consumed_commits_may_be_cleaned(spark, scratch):
    table, log = table_of(spark, scratch), f"{scratch}/log"
    for i in (1, 2, 3):
        commit(spark, log, [(i, "x", "INSERT", False)])
        assert deliver(spark, scratch, table)["status"] == "ok"
    for n in parquet_files(spark, log)[:2]:
        fs.delete(spark, f"{log}/{n}")
    assert deliver(spark, scratch, table)["status"] == "no_changes"
    commit(spark, log, [(4, "x", "INSERT", False)])
    assert deliver(spark, scratch, table)["status"] == "ok"


def test_pending_changes_and_nothing_moved(spark, scratch):
    table, log = table_of(spark, scratch), f"{scratch}/log with a space"
    schema, point = spark.createDataFrame([], SCHEMA).schema, f"{scratch}/outbox/_checkpoint"
    assert not fd.has_pending(spark, log, point)
    write_log(spark, log, [(1, "x", "INSERT", False)])
    assert fd.has_pending(spark, log, point)
    from sluice.streaming.consume import consume_to_outbox
    from sluice.streaming.outbox import OutboxStore
    store = OutboxStore(spark, f"{scratch}/outbox")
    consume_to_outbox(spark, log, schema, store)
    assert not fd.has_pending(spark, log, point)
    assert fd.feed_pending(spark, log, schema, point).collect() == []
    write_log(spark, log, [(2, "y", "INSERT", False), (3, "z", "DELETE", False)])
    for _ in range(2):
        assert sorted(r["id"] for r in fd.feed_pending(spark, log, schema, point).collect()) == [2, 3]
    assert len(consume_to_outbox(spark, log, schema, store)) == 1
    assert table.read().count() == 1


def test_pending_rows_are_not_joined_by_file(spark, scratch):
    log, schema = f"{scratch}/log", spark.createDataFrame([], SCHEMA).schema
    write_log(spark, log, [(i, "x", "INSERT", False) for i in range(50)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pending = fd.feed_pending(spark, log, schema, f"{scratch}/outbox/_checkpoint")
        plan = executed_plan(pending)
        assert sorted(r["id"] for r in pending.collect()) == list(range(50))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan
    for above in ancestors(plan, "FileScan parquet"):
        assert not any(op.startswith(("Exchange", "Sort")) for op in above), above


@pytest.mark.parametrize("query, commits, least", [("feed_pending", 2, 3), ("stream_equal_times", 2, 3),
                                                   ("stream_multi_commit", 1, 6)])
def test_logs_are_written_by_more_tasks_as_tables_grow(spark, scratch, monkeypatch, query, commits, least):
    from sluice.queries import catalog_io as io
    events = spark.sql("""SELECT id AS event_id, timestamp_ntz'2024-01-20 00:00:00' + make_dt_interval(id % 9) AS ts, id % 40 AS user_id,
                          if(id % 10 = 0, 'error', 'view') AS event_type, id / 4 AS value, '{"k": 1}' AS props FROM range(2000)""")
    events.coalesce(1).write.parquet(f"{scratch}/events.parquet")
    size, results = fs.size(spark, f"{scratch}/events.parquet"), []
    for parts in (1, 12):
        monkeypatch.setattr(io, "LOG_FILE_BYTES", size // parts)
        monkeypatch.setattr(io, "work_path", lambda spark, *p, n=parts: f"{scratch}/{query}-{n}")
        results.append(sorted(map(tuple, io.IO_QUERIES[query](spark, scratch).collect())))
        log = parquet_files(spark, f"{scratch}/{query}-{parts}/change_log")
        assert len(log) == commits * max(least, parts)
    assert results[0] == results[1] and results[0]


def test_two_writers_never_share_a_number(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda i: commit(spark, scratch, [(i, "x", "INSERT", False)]), range(8)))
    assert sorted(numbers) == list(range(1, 9))
    rows = spark.read.schema(SCHEMA).parquet(scratch)
    assert rows.agg(F.count_distinct("id")).first()[0] == 8
