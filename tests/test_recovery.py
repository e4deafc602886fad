"""Fault injection: after a failed run and clean re-runs the target equals the
source; a failed run publishes nothing. Also the compare-and-swap of publish."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from sluice import fs
from sluice.plans import job
from sluice.plans.state import resume_at
from sluice.session import checkpoint_dir
from sluice.sinks.jdbc import JdbcSink, create_table_sql, derby_memory_url
from sluice.sinks.native import ConcurrentPublish, NativeTable
from sluice.sources.snapshot import snapshot_diff
from sluice.spec import SyncSpec
from sluice.streaming.outbox import OutboxStore

COLS = "id long, v string, updated_at timestamp_ntz"
T0 = dt.datetime(2026, 1, 1)


def stock(*rows):
    """Rows of a small stock table from (id, text, minutes after T0)."""
    return [(i, v, T0 + dt.timedelta(minutes=m)) for i, v, m in rows]


def before(spark):
    return spark.createDataFrame(stock(*[(10 * i, "shelf", 0) for i in range(1, 8)]), COLS)


def after(spark, capture):
    """The table an hour later: one text moved, two rows came; and, unless the
    capture cannot see it (hwm), two rows went and one changed its number."""
    rows = [(10, "shelf", 0), (20, "counter", 60), (50, "shelf", 0), (60, "shelf", 0), (70, "shelf", 0),
            (81, "new", 60), (82, None, 60)]
    rows += [(30, "shelf", 0), (40, "shelf", 0)] if capture == "hwm" else [(400, "shelf", 60)]
    return spark.createDataFrame(stock(*rows), COLS)


class Boom(RuntimeError):
    pass


def spec_for(capture, root, staged="direct"):
    more = {"none": dict(mode="truncate"), "hwm": dict(mode="upsert", hwm_col="updated_at"),
            "stream": dict(mode="upsert", change_log=f"{root}/log", outbox=f"{root}/outbox")}[capture]
    return SyncSpec("src", "tgt", capture=capture, keys=["id"], staging=staged, **more)


def run_once(spark, capture, root, table, src, feed_schema=None, staged="direct"):
    return job.run(spark, spec_for(capture, root, staged), src, table, change_log_schema=feed_schema,
                   run_log=f"{root}/runs")


def failing(df):
    return df.withColumn("v", F.when(F.col("id") == 81, F.raise_error(F.lit("injected read")))
                         .otherwise(F.col("v")))


#: A full load has no state; a stream reads the change log, which mid_write covers; staging is over at the commit.
CASES = [(c, f) for c in ("none", "hwm", "stream") for f in ("read", "mid_write", "commit", "state")
         if (c, f) not in (("none", "state"), ("stream", "read"))]
MATRIX = [("direct", c, f) for c, f in CASES] + [("jdbc", c, f) for c, f in CASES]
MATRIX += [(s, c, f) for s in ("csv", "parquet") for c, f in CASES if f in ("read", "mid_write")]


def derby_table(spark):
    """A keyed table of a database inside this process, for the rows of these tests."""
    sink = JdbcSink(spark, derby_memory_url(), "tgt", keys=["id"])
    sink.execute(create_table_sql("tgt", spark.createDataFrame([], COLS).schema, ["id"]))
    return sink


def break_sink(monkeypatch, failure):
    """Failures inside a database target: while staging, and at the last statement of the transaction."""
    if failure == "mid_write":
        orig = JdbcSink._stage

        def bad_stage(self, df, *a):
            orig(self, df.limit(1), *a)
            raise Boom("injected mid-write")
        monkeypatch.setattr(JdbcSink, "_stage", bad_stage)
    elif failure == "commit":
        orig = JdbcSink.statements
        monkeypatch.setattr(JdbcSink, "statements", lambda *a, **k: [*orig(*a, **k), "DELETE FROM no_such_table"])


@pytest.mark.parametrize("staged, capture, failure", MATRIX)
def test_recovery(spark, scratch, monkeypatch, capture, failure, staged):
    root, staging = scratch, "direct" if staged == "jdbc" else staged
    table = derby_table(spark) if staged == "jdbc" else NativeTable(spark, f"{root}/t", keys=["id"], buckets=4)
    old = before(spark)
    job.run(spark, SyncSpec("src", "tgt", keys=["id"]), old, table)
    new = after(spark, capture)
    feed_schema = None
    if capture == "stream":
        feed = snapshot_diff(old, new, ["id"])
        feed.write.mode("append").parquet(f"{root}/log")
        feed_schema = feed.schema
    v0 = table.version()

    src = new
    if failure == "read":
        src = failing(new)
    elif staged == "jdbc" and failure != "state":
        break_sink(monkeypatch, failure)
    elif failure == "mid_write":
        orig = NativeTable._write

        def bad_write(self, df, run_id):
            orig(self, df.limit(1), run_id)
            raise Boom("injected mid-write")
        monkeypatch.setattr(NativeTable, "_write", bad_write)
    elif failure == "commit":
        monkeypatch.setattr(fs, "create_exclusive", lambda *a, **k: (_ for _ in ()).throw(Boom("commit")))
    elif failure == "state":
        monkeypatch.setattr(OutboxStore, "acknowledge", lambda *a, **k: (_ for _ in ()).throw(Boom("ack")))

    if failure == "state" and capture == "hwm":
        # hwm progress commits inside the manifest: nothing can fail in between.
        run_once(spark, capture, root, table, src, feed_schema, staging)
    else:
        with pytest.raises(Exception):
            run_once(spark, capture, root, table, src, feed_schema, staging)
        if failure != "state":
            assert table.version() == v0, "a failed run must publish nothing"
            assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, old.collect()))
    monkeypatch.undo()

    for _ in range(2):
        run_once(spark, capture, root, table, new, feed_schema, staging)
    got = sorted(map(tuple, table.read().collect()))
    want = sorted(map(tuple, new.collect()))
    assert got == want
    runs = job.read_run_log(spark, f"{root}/runs").collect()
    assert runs[-1].status in ("ok", "no_changes")


def test_concurrent_publish_one_winner(spark, scratch):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    a = NativeTable(spark, scratch, keys=["id"], buckets=4)
    a.publish(upserts=df)
    base = a.version()
    b = NativeTable(spark, scratch, keys=["id"], buckets=4)
    a.publish(upserts=spark.createDataFrame([(1, "A")], "id long, v string"), expected_version=base)
    with pytest.raises(ConcurrentPublish):
        b.publish(upserts=spark.createDataFrame([(2, "B")], "id long, v string"),
                  expected_version=base)
    assert sorted(map(tuple, a.read().collect())) == [(1, "A"), (2, "b")]


def test_watermark_commits_with_data(spark, scratch):
    table = NativeTable(spark, scratch, keys=["id"], buckets=4)
    src = after(spark, "hwm")
    spec = SyncSpec("src", "tgt", capture="hwm", mode="upsert", keys=["id"], hwm_col="updated_at")
    s1 = job.run(spark, spec, src, table)
    assert s1["status"] == "ok" and s1["rows_written"] == 9
    assert resume_at(table.state(), "src", "tgt").value.startswith("2026-01-01 01:00:00")
    s2 = job.run(spark, spec, src, table)
    assert s2["status"] == "no_changes"


def test_duplicate_keys_rejected_before_writing(spark, scratch):
    table = NativeTable(spark, scratch, keys=["id"], buckets=4)
    dup = spark.createDataFrame(stock((5, "left", 0), (6, "alone", 0), (5, "right", 1)), COLS)
    with pytest.raises(ValueError, match="duplicate"):
        job.run(spark, SyncSpec("src", "tgt", mode="upsert", keys=["id"]), dup, table)
    assert table.version() is None


def test_upsert_keeps_target_only_columns(spark, scratch):
    table = NativeTable(spark, scratch, keys=["id"], buckets=4)
    table.publish(upserts=spark.createDataFrame([(1, "a", 100), (2, "b", 200)],
                                                "id long, v string, sk long"))
    job.run(spark, SyncSpec("src", "tgt", mode="upsert", keys=["id"]),
            spark.createDataFrame([(1, "A"), (3, "C")], "id long, v string"), table)
    assert sorted(map(tuple, table.read().collect())) == [(1, "A", 100), (2, "b", 200), (3, "C", None)]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_staged_run_cleans_up_after_success(spark, scratch, fmt):
    table = NativeTable(spark, f"{scratch}/t", keys=["id"], buckets=4)
    stage = f"{scratch}/stage"
    spec = SyncSpec("src", "tgt", mode="upsert", keys=["id"], staging=fmt, stage_path=stage)
    s = job.run(spark, spec, after(spark, "stream"), table)
    assert s["status"] == "ok" and s["rows_written"] == 8
    assert fs.list_names(spark, stage) == []
    keep = SyncSpec("src", "tgt", mode="upsert", keys=["id"], staging=fmt, stage_path=stage,
                    keep_files=True)
    job.run(spark, keep, after(spark, "stream"), table)
    assert len(fs.list_names(spark, stage)) == 1
    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, after(spark, "stream").collect()))


def test_staleness_check(spark):
    from sluice.streaming.consume import StaleFeed, check_staleness
    log = spark.createDataFrame([(5,), (9,)], "seq long")
    check_staleness(log, "seq", 7)      # the log still holds everything after 7
    check_staleness(log, "seq", None)   # first consume
    with pytest.raises(StaleFeed, match="full reload"):
        check_staleness(log, "seq", 3)  # changes 4 were dropped by retention


def test_stream_run_purges_and_logs(spark, scratch):
    table = NativeTable(spark, f"{scratch}/t", keys=["id"], buckets=4)
    old, new = before(spark), after(spark, "stream")
    job.run(spark, SyncSpec("src", "tgt", keys=["id"]), old, table)
    feed = snapshot_diff(old, new, ["id"])
    feed.write.parquet(f"{scratch}/log")
    s = run_once(spark, "stream", scratch, table, new, feed.schema)
    assert (s["rows_written"], s["rows_deleted"], s["consumes_purged"]) == (4, 2, 1)
    assert s["rows_consumed"] == feed.count()
    assert OutboxStore(spark, f"{scratch}/outbox").rows() is None


def test_existing_table_keeps_its_buckets(spark, scratch):
    df = spark.createDataFrame([(i, "a") for i in range(50)], "id long, v string")
    NativeTable(spark, scratch, keys=["id"], buckets=4).publish(upserts=df)
    other = NativeTable(spark, scratch, keys=["id"], buckets=32)   # ignored: table exists
    assert other.n == 4
    other.publish(upserts=spark.createDataFrame([(7, "b")], "id long, v string"))
    got = dict(map(tuple, other.read().collect()))
    assert len(got) == 50 and got[7] == "b"
    with pytest.raises(ValueError, match="keyed by"):
        NativeTable(spark, scratch, keys=["v"])


def test_auto_buckets_from_size(spark, scratch):
    t = NativeTable(spark, scratch, keys=["id"], buckets=None, bucket_bytes=64 << 10)
    t.publish(upserts=spark.range(200_000).selectExpr("id", "repeat('x', 20) AS v"))
    assert t.n >= 8 and t.manifest()["n_buckets"] == t.n
    assert t.read().count() == 200_000


def test_inserts_append_without_rewriting(spark, scratch):
    t = NativeTable(spark, scratch, keys=["id"], buckets=4)
    t.publish(upserts=spark.createDataFrame([(i, "a") for i in range(40)], "id long, v string"))
    before_paths = t.manifest()["buckets"]
    # New keys only: every touched bucket keeps its old file and gains one.
    t.publish(upserts=spark.createDataFrame([(i, "n") for i in range(100, 140)], "id long, v string"))
    after_paths = t.manifest()["buckets"]
    for b, ps in before_paths.items():
        assert after_paths[b][:len(ps)] == ps and len(after_paths[b]) == len(ps) + 1
    # An update rewrites only the bucket holding the key.
    t.publish(upserts=spark.createDataFrame([(5, "u")], "id long, v string"))
    changed = [b for b in after_paths if t.manifest()["buckets"].get(b) != after_paths[b]]
    assert len(changed) == 1 and len(t.manifest()["buckets"][changed[0]]) == 1
    got = dict(map(tuple, t.read().collect()))
    assert len(got) == 80 and got[5] == "u" and got[120] == "n"
    # A delete of a key that does not exist changes nothing but the version.
    t.publish(deletes=spark.createDataFrame([(999,)], "id long"))
    assert t.read().count() == 80


def test_jdbc_publish_compare_and_swap(spark):
    from sluice.sinks.jdbc import JdbcSink, create_table_sql, derby_memory_url
    url = derby_memory_url()
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    a = JdbcSink(spark, url, "t", keys=["id"])
    a.execute(create_table_sql("t", df.schema, ["id"]).replace("VARCHAR(32672)", "VARCHAR(20)"))
    assert a.version() is None
    assert a.publish(upserts=df, state={"w": 1}) == 1
    b = JdbcSink(spark, url, "t", keys=["id"])
    base = b.version()
    a.publish(upserts=spark.createDataFrame([(1, "A")], "id long, v string"), expected_version=base)
    with pytest.raises(ConcurrentPublish):
        b.publish(upserts=spark.createDataFrame([(2, "B")], "id long, v string"),
                  expected_version=base)
    assert sorted(map(tuple, a.read().collect())) == [(1, "A"), (2, "b")]
    assert a.version() == 2 and a.state() == {"w": 1}


def test_jdbc_run_counts_rows(spark):
    from sluice.sinks.jdbc import JdbcSink, create_table_sql, derby_memory_url
    url = derby_memory_url()
    src = after(spark, "stream")
    sink = JdbcSink(spark, url, "r", keys=["id"], max_connections=3)
    sink.execute(create_table_sql("r", src.schema, ["id"]).replace("VARCHAR(32672)", "VARCHAR(20)"))
    s = job.run(spark, SyncSpec("src", "r", mode="upsert", keys=["id"]), src, sink)
    assert s["rows_written"] == 8 and s["version"] == 1
    assert sorted(map(tuple, sink.read().collect())) == sorted(map(tuple, src.collect()))


def test_lower_cols_run_with_upper_case_source(spark, scratch):
    src = spark.createDataFrame([(1, "a", T0), (2, "b", T0)], "ID long, V string, UPDATED_AT timestamp_ntz")
    table = NativeTable(spark, scratch, keys=["id"], buckets=2)
    spec = SyncSpec("src", "tgt", capture="hwm", mode="upsert", keys=["ID"], hwm_col="UPDATED_AT",
                    lower_cols=True)
    s = job.run(spark, spec, src, table)
    assert s["rows_written"] == 2 and table.read().columns == ["id", "v", "updated_at"]


def test_hwm_late_commit_missed_then_caught_by_lookback(spark, scratch):
    t1, t2, t3 = (T0 + dt.timedelta(minutes=m) for m in (1, 2, 3))
    table = NativeTable(spark, scratch, keys=["id"], buckets=2)
    spec = SyncSpec("src", "tgt", capture="hwm", mode="upsert", keys=["id"], hwm_col="updated_at")
    # Row 2 was stamped at t2 but its transaction commits after row 3 (t3) was read.
    job.run(spark, spec, spark.createDataFrame([(1, "a", t1), (3, "c", t3)], COLS), table)
    late = spark.createDataFrame([(1, "a", t1), (2, "b", t2), (3, "c", t3)], COLS)
    assert job.run(spark, spec, late, table)["status"] == "no_changes"     # missed (reference behaviour)
    assert sorted(r.id for r in table.read().collect()) == [1, 3]
    wide = SyncSpec("src", "tgt", capture="hwm", mode="upsert", keys=["id"], hwm_col="updated_at",
                    lookback="INTERVAL 5 MINUTES")
    s = job.run(spark, wide, late, table)          # nothing newer arrived: still re-sends the window
    assert s["status"] == "ok" and sorted(r.id for r in table.read().collect()) == [1, 2, 3]
    assert resume_at(table.state(), "src", "tgt").value.startswith("2026-01-01 00:03:00")


def test_append_replayed_under_same_key_does_not_duplicate(spark, scratch):
    table = NativeTable(spark, scratch, keys=["id"], buckets=2)
    table.publish(upserts=spark.createDataFrame([(1, "a", T0)], COLS))
    spec = SyncSpec("src", "tgt", mode="append")
    day1 = spark.createDataFrame([(2, "b", T0), (3, "c", T0)], COLS)
    job.run(spark, spec, day1, table, replay_key="2026-01-01")
    job.run(spark, spec, day1, table, replay_key="2026-01-01")        # retried run
    assert sorted(r.id for r in table.read().collect()) == [1, 2, 3]
    job.run(spark, spec, spark.createDataFrame([(4, "d", T0)], COLS), table, replay_key="2026-01-02")
    assert sorted(r.id for r in table.read().collect()) == [1, 2, 3, 4]
    job.run(spark, spec, day1, table)                                  # no key: plain append
    assert table.read().count() == 6


def test_jdbc_text_key_upsert_and_delete(spark):
    from sluice.sinks.jdbc import JdbcSink, create_table_sql, derby_memory_url
    url = derby_memory_url()
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "code string, n long")
    sink = JdbcSink(spark, url, "codes", keys=["code"])
    sink.execute(create_table_sql("codes", df.schema, ["code"]).replace("VARCHAR(32672)", "VARCHAR(8)"))
    sink.publish(upserts=df)
    sink.publish(upserts=spark.createDataFrame([("b", 20), ("d", 4)], df.schema),
                 deletes=spark.createDataFrame([("a",)], "code string"))
    assert sorted(map(tuple, sink.read().collect()), key=repr) == \
        [("b", 20), ("c", None), ("d", 4)]
    sink.publish(upserts=spark.createDataFrame([("x", 9)], df.schema), truncate=True)
    assert [tuple(r) for r in sink.read().collect()] == [("x", 9)]
    assert sink.version() == 3


def test_empty_table_keeps_its_schema(spark, scratch):
    t = NativeTable(spark, scratch, keys=["id"], buckets=2)
    t.publish(upserts=before(spark).limit(0))           # a schema copy, no rows
    assert t.read().count() == 0 and t.read().columns == ["id", "v", "updated_at"]
    t.publish(upserts=before(spark))
    t.publish(deletes=before(spark).select("id"))       # deletes empty every bucket
    assert t.read().count() == 0 and t.schema() == before(spark).schema


def test_full_load_of_an_empty_source(spark, scratch):
    table = NativeTable(spark, scratch, keys=["id"], buckets=2)
    s = job.run(spark, SyncSpec("src", "tgt", keys=["id"]), before(spark).limit(0), table)
    assert s["status"] == "ok" and s["rows_written"] == 0 and table.read().count() == 0


def test_jdbc_publish_with_empty_upserts_and_deletes(spark):
    from sluice.sinks.jdbc import JdbcSink, create_table_sql, derby_memory_url
    url = derby_memory_url()
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    sink = JdbcSink(spark, url, "e", keys=["id"])
    sink.execute(create_table_sql("e", df.schema, ["id"]).replace("VARCHAR(32672)", "VARCHAR(8)"))
    sink.publish(upserts=df)
    sink.publish(upserts=df.limit(0), deletes=spark.createDataFrame([(1,)], "id long"))
    assert [tuple(r) for r in sink.read().collect()] == [(2, "b")]


def test_nan_to_null_option(spark, scratch):
    table = NativeTable(spark, scratch, keys=["id"], buckets=2)
    src = spark.createDataFrame([(1, float("nan")), (2, 1.5)], "id long, x double")
    job.run(spark, SyncSpec("src", "tgt", keys=["id"], nan_to_null=True), src, table)
    assert dict(map(tuple, table.read().collect())) == {1: None, 2: 1.5}


# ------------------------------------------------ what used to corrupt silently


def publish(spark, scratch, rows, cols, **options):
    t = NativeTable(spark, scratch, keys=["id"], **{"buckets": 8, **options})
    t.publish(upserts=spark.createDataFrame(rows, cols))
    return t


def test_keys_of_another_type_meet_their_rows(spark, scratch):
    t = publish(spark, scratch, [(i, "old") for i in range(40)], "id long, v string")
    t.publish(upserts=spark.createDataFrame([(i, "new") for i in range(11, 50)], "id int, v string"))
    got = dict(map(tuple, t.read().collect()))
    assert t.read().count() == 50 and all(got[i] == "new" for i in range(11, 50)) and got[3] == "old"
    t.publish(deletes=spark.createDataFrame([(str(i),) for i in range(45)], "id string"))
    assert sorted(r.id for r in t.read().collect()) == [45, 46, 47, 48, 49]


@pytest.mark.parametrize("bad, cols", [
    ([(1, "x")], "id long, n string"), ([(1, 1.5)], "id long, n double"), ([(1, 2**40)], "id long, n long"),
    ([(1, dt.date(2020, 1, 1))], "id long, n date")])
def test_values_that_do_not_fit_are_refused(spark, scratch, bad, cols):
    t = publish(spark, scratch, [(1, 5)], "id long, n int")
    with pytest.raises(Exception):
        t.publish(upserts=spark.createDataFrame(bad, cols))
    assert [tuple(r) for r in t.read().collect()] == [(1, 5)] and t.version() == 1
    assert fs.list_names(spark, f"{scratch}/_change") == []


def test_text_amounts_become_exact_decimals(spark, scratch):
    t = publish(spark, scratch, [(1, "1.50")], "id long, amt string")
    t2 = NativeTable(spark, f"{scratch}/d", keys=["id"])
    t2.publish(upserts=t.read().withColumn("amt", F.col("amt").cast("decimal(8,2)")))
    t2.publish(upserts=spark.createDataFrame([(2, "7.25"), (3, "8.1")], "id long, amt string"))
    assert sorted((r.id, str(r.amt)) for r in t2.read().collect()) == [(1, "1.50"), (2, "7.25"), (3, "8.10")]
    with pytest.raises(Exception, match="does not fit"):
        t2.publish(upserts=spark.createDataFrame([(4, "1.239")], "id long, amt string"))


def test_a_moving_source_is_read_once(spark, scratch):
    """Every evaluation of the source gives other rows; one of them is delivered whole."""
    table = publish(spark, f"{scratch}/t", [(i, "old") for i in range(0, 60, 2)], "id long, v string")
    drift = spark.sparkContext.accumulator(0)

    def moving(it):
        drift.add(1)
        for _ in it:
            import time
            start = time.time_ns() % 1000
            yield from ((start + k, "new") for k in range(30))
    rows = spark.createDataFrame(spark.sparkContext.parallelize([0], 1).mapPartitions(moving), "id long, v string")
    s = job.run(spark, SyncSpec("src", "tgt", mode="upsert", keys=["id"]), rows, table)
    assert drift.value == 1 and s["rows_written"] == 30
    got = table.read()
    assert got.where("v = 'new'").count() == 30
    assert got.groupBy("id").count().where("count > 1").count() == 0


def test_a_table_without_the_newer_manifest_fields_still_merges(spark, scratch):
    t = publish(spark, scratch, [(i, "a") for i in range(20)], "id long, v string")
    path = t._manifest_path(1)
    old = {k: v for k, v in t.manifest().items() if k not in ("bytes", "fixed_buckets", "appends")}
    fs.delete(spark, path)
    assert fs.create_exclusive(spark, path, json.dumps(old))
    t = NativeTable(spark, scratch, keys=["id"])
    t.publish(upserts=spark.createDataFrame([(100, "n")], "id long, v string"))
    t.publish(upserts=spark.createDataFrame([(7, "u")], "id long, v string"))
    got = dict(map(tuple, t.read().collect()))
    assert t.read().count() == 21 and got[7] == "u"


def test_first_loads_without_a_size_estimate_start_small(spark, scratch):
    t = publish(spark, scratch, [(1, "a")], "id long, v string", buckets=None)
    assert t.n == 2


def test_a_table_that_outgrows_its_buckets_is_dealt_anew(spark, scratch):
    t = NativeTable(spark, scratch, keys=["id"], bucket_bytes=40_000)
    t.publish(upserts=spark.range(100).selectExpr("id", "uuid() AS v"))
    assert t.n == 2
    t.publish(upserts=spark.range(50, 20_000).selectExpr("id", "uuid() AS v"), deletes=spark.range(10).toDF("id"))
    assert t.n >= 8
    assert t.read().count() == 19_990 and t.read().select("id").distinct().count() == 19_990
    t.publish(upserts=spark.range(19_999, 20_001).selectExpr("id", "'z' AS v"))
    assert t.read().count() == 19_991


def test_a_replay_of_rewritten_rows_is_refused(spark, scratch):
    t = publish(spark, scratch, [(1, "a")], "id long, v string", buckets=2)
    t.publish(upserts=spark.createDataFrame([(2, "b")], "id long, v string"), append=True, replay_key="day")
    t.publish(upserts=spark.createDataFrame([(2, "B"), (1, "A")], "id long, v string"))
    with pytest.raises(ValueError, match="rewritten"):
        t.publish(upserts=spark.createDataFrame([(2, "b")], "id long, v string"), append=True, replay_key="day")


def test_an_overtaken_run_stops_before_it_writes(spark, scratch, monkeypatch):
    t = publish(spark, f"{scratch}/t", [(1, "a")], "id long, v string")
    other = NativeTable(spark, f"{scratch}/t", keys=["id"])
    real = NativeTable._settle

    def overtaken(self, *a, **k):
        monkeypatch.undo()
        other.publish(upserts=spark.createDataFrame([(3, "first")], "id long, v string"))
        return real(self, *a, **k)
    monkeypatch.setattr(NativeTable, "_settle", overtaken)
    with pytest.raises(ConcurrentPublish):
        job.run(spark, SyncSpec("s", "t", mode="upsert", keys=["id"]), spark.createDataFrame([(2, "b")], "id long, v string"),
                t, run_log=f"{scratch}/runs")
    assert sorted(r.id for r in t.read().collect()) == [1, 3] and len(fs.list_names(spark, f"{scratch}/t/data")) == 2
    assert job.read_run_log(spark, f"{scratch}/runs").first().status == job.CONFLICT


def test_failed_bookkeeping_is_not_called_a_failed_publish(spark, scratch, monkeypatch):
    table = publish(spark, f"{scratch}/t", [(1, "a")], "id long, v string")
    feed = spark.createDataFrame([(2, "b", "INSERT", False)], "id long, v string, _cdc_action string, _cdc_is_update boolean")
    feed.write.parquet(f"{scratch}/log")
    monkeypatch.setattr(OutboxStore, "acknowledge", lambda self, ids, *a: (_ for _ in ()).throw(Boom("ledger")) if ids else None)
    with pytest.raises(job.BookkeepingFailed):
        run_once(spark, "stream", scratch, table, feed, feed.schema)
    monkeypatch.undo()
    assert table.read().count() == 2
    s = run_once(spark, "stream", scratch, table, feed, feed.schema)  # completes the ledger from the target
    assert s["status"] == "no_changes" and OutboxStore(spark, f"{scratch}/outbox").acked_ids("tgt") >= {0}
    assert [r.status for r in job.read_run_log(spark, f"{scratch}/runs").collect()] == ["unsaved", "no_changes"]


def test_half_written_manifests_are_never_seen(spark, scratch, monkeypatch):
    t = publish(spark, scratch, [(1, "a")], "id long, v string")
    fs.ensure_dir(spark, f"{scratch}/_manifest")
    with open(f"{scratch.removeprefix('file:')}/_manifest/.v0000000002.json.x.tmp", "w") as f:
        f.write("{\"vers")  # a writer that died before it gave its file the name
    assert t.version() == 1
    t.publish(upserts=spark.createDataFrame([(2, "b")], "id long, v string"))
    assert t.read().count() == 2


def test_paths_are_resolved_as_spark_resolves_them(spark, scratch):
    plain = scratch.removeprefix("file:")
    t = publish(spark, f"file:{plain}", [(1, "a")], "id long, v string")
    assert NativeTable(spark, plain).read().count() == t.read().count() == 1
    assert fs.scheme(spark, plain) == "file"


def test_file_systems_without_an_atomic_rename_are_refused(spark, scratch, monkeypatch):
    class Store:
        def getUri(self):
            return self

        def getScheme(self):
            return "s3a"
    monkeypatch.setattr(fs, "_fs", lambda spark, path: (Store(), path))
    with pytest.raises(ValueError, match="atomic rename"):
        fs.create_exclusive(spark, "s3a://bucket/t/_manifest/v1.json", "{}")


def test_clusters_must_name_the_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(ValueError, match="checkpoint.dir"):
        checkpoint_dir(Session())
