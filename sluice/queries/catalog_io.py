"""Registered queries that write and read files or a database on the way.

Each writes under a fresh folder of the shared work area (``spark.checkpoint.dir``)
and returns a DataFrame over what was written, so the check sees the result of
the full write path: staging codecs, the native sink's manifest protocol, the
streaming consume and the JDBC transaction.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fs
from ..operators.netchange import CONSUME
from ..plans import job
from ..session import work_path
from ..sinks import staging
from ..sinks.jdbc import JdbcSink, create_table_sql, derby_memory_url, q
from ..sinks.native import NativeTable
from ..sources.generator import claims_from_orders, claims_updates
from ..sources.snapshot import snapshot_diff
from ..sources.tables import read_table, table_path
from ..spec import SyncSpec
from ..streaming.consume import consume_to_outbox
from ..streaming.feed import append_commit, feed_pending
from ..streaming.outbox import OutboxStore, add_cdc_columns
from . import fixtures as fx


# ---------------------------------------------------------------- staged files (A8, A10, C*)

def _csv_round_trip(spark, sf, table):
    src = read_table(spark, sf, table)
    path = work_path(spark, "csv", table)
    # Documents run to ~20,000 words: 200 per file keeps files near 20 MB, so a
    # multiLine (unsplittable) CSV stage still reads in parallel.
    staging.write_csv(src, path, max_records=200)
    return staging.read_csv(spark, path, src.schema)


def csv_round_trip(spark, sf):
    return _csv_round_trip(spark, sf, "documents")


def csv_round_trip_pages(spark, sf):
    return _csv_round_trip(spark, sf, "pages")


def csv_round_trip_conversations(spark, sf):
    return _csv_round_trip(spark, sf, "conversations")


def _typed_events(spark, sf):
    e = read_table(spark, sf, "events")
    return e.select(
        "event_id", "ts", "value",
        F.col("value").cast("decimal(18,2)").alias("amount"),
        F.encode("props", "UTF-8").alias("props_bin"),
        (F.col("event_type") == "error").alias("is_error"),
        F.when(F.col("event_type") == "view", F.lit(None).cast("string"))
        .when(F.col("event_type") == "click", F.lit(""))
        .otherwise(F.concat(F.lit("  "), F.col("props"), F.lit("\n"))).alias("note"),
        F.to_date("ts").alias("day"),
        F.array("user_id", "event_id").alias("ids"))


def csv_codecs(spark, sf):
    src = _typed_events(spark, sf)
    path = work_path(spark, "csv", "codecs")
    staging.write_csv(src, path, max_records=2000, compression="gzip")
    back = staging.read_csv(spark, path, src.schema)
    return back.select("event_id", "ts", "value", F.col("amount").cast("string").alias("amount"),
                       F.hex("props_bin").alias("props_hex"), "is_error", "note",
                       F.date_format("day", "yyyy-MM-dd").alias("day"),
                       (F.col("ids")[0] + F.col("ids")[1]).alias("ids_sum"))


def positional_csv(spark, sf):
    src = read_table(spark, sf, "orders")
    path = work_path(spark, "csv", "positional")
    staging.csv_encode(src).write.options(**{**staging.CSV_OPTIONS, "header": "false"}).csv(path)
    raw = staging.read_positional_csv(spark, path, src.columns, with_file=True)
    named = T.StructType([*src.schema.fields, T.StructField("file_name", T.StringType())])
    return (staging.csv_decode(raw, named)
            .withColumn("from_a_csv_file", F.col("file_name").endswith(".csv")).drop("file_name"))


def positional_csv_header(spark, sf):
    """Positional read of files whose header names other columns."""
    src = read_table(spark, sf, "customer")
    path = work_path(spark, "csv", "positional-header")
    renamed = src.toDF(*[f"x{i}" for i in range(len(src.columns))])
    staging.write_csv(renamed, path)
    return staging.csv_decode(staging.read_positional_csv(spark, path, src.columns, header=True), src.schema)


def parquet_staging(spark, sf):
    src = read_table(spark, sf, "conversations")
    up, _ = staging.stage_round_trip(spark, src, None, "parquet", work_path(spark, "stage"), "run")
    return up


# ---------------------------------------------------------------- native sink jobs

def hwm_job(spark, sf):
    """Full load of the old snapshot, then two hwm runs (the second finds
    nothing) against the current table, through the native sink."""
    return _hwm_runs(spark, sf)[0].read()


def run_log(spark, sf):
    """The run log of the hwm scenario: one row per run (deterministic columns)."""
    root = _hwm_runs(spark, sf)[1]
    return (job.read_run_log(spark, f"{root}/_runs")
            .select("capture", "mode", "status", "rows_written", "rows_deleted"))


def table_changes(spark, sf):
    """Change feed of the native table between its first load and its final version."""
    table = _hwm_runs(spark, sf)[0]
    return snapshot_diff(table.read(1), table.read(), table.keys)


def _hwm_runs(spark, sf):
    root = work_path(spark, "native", "hwm")
    table = NativeTable(spark, f"{root}/orders_t", keys=["o_orderkey"], buckets=8)
    fx.orders_old(spark, sf).createOrReplaceTempView("orders_v1")
    fx.orders(spark, sf).createOrReplaceTempView("orders_now")
    job.run(spark, SyncSpec("orders_v1", "orders_t", keys=["o_orderkey"]),
            spark.table("orders_v1"), table, run_log=f"{root}/_runs")
    spec = SyncSpec("orders_now", "orders_t", capture="hwm", mode="upsert", keys=["o_orderkey"],
                    hwm_col="o_orderdate", hwm_start=fx.HWM_START)
    for _ in range(2):
        job.run(spark, spec, spark.table("orders_now"), table, run_log=f"{root}/_runs")
    return table, root


#: Bytes of a source table that go into one file of a change log made from it.
LOG_FILE_BYTES = 16 << 20


def _log_files(spark, sf, table, least: int) -> int:
    """Files of a change log made from ``table``: ``least``, more as it grows."""
    return max(least, fs.size(spark, table_path(sf, table)) // LOG_FILE_BYTES)


def _write_change_log(spark, feed, path, files: int):
    feed.repartition(files).write.mode("append").parquet(path)


def stream_job(spark, sf):
    """Old snapshot loaded; the snapshot feed lands in a change log; the stream
    capture consumes it into the outbox, applies the net change, acknowledges
    and purges; a second run finds nothing."""
    root = work_path(spark, "native", "stream")
    keys = ["o_orderkey"]
    table = NativeTable(spark, f"{root}/orders_t", keys=keys, buckets=8)
    old = fx.orders_old(spark, sf)
    job.run(spark, SyncSpec("orders_old", "orders_t", keys=keys), old, table)
    log_path = f"{root}/change_log"
    feed = snapshot_diff(old, fx.orders_new(spark, sf), keys)
    _write_change_log(spark, feed, log_path, _log_files(spark, sf, "orders", 4))
    spec = SyncSpec("orders", "orders_t", capture="stream", mode="upsert", keys=keys,
                    change_log=log_path, outbox=f"{root}/outbox")
    for _ in range(2):
        job.run(spark, spec, feed, table, change_log_schema=feed.schema,
                run_log=f"{root}/_runs")
    return table.read()


def stream_consume(spark, sf):
    """Events change log consumed by Structured Streaming, several files per
    trigger → several consumes; returns the outbox rows."""
    root = work_path(spark, "stream", "events")
    feed = fx.events_feed(spark, sf).withColumnRenamed(CONSUME, "_cdc_commit_day")
    log_path = f"{root}/change_log"
    files = _log_files(spark, sf, "events", 6)
    _write_change_log(spark, feed, log_path, files)
    store = OutboxStore(spark, f"{root}/outbox")
    consume_to_outbox(spark, log_path, feed.schema, store, max_files_per_trigger=-(-files // 3))   # three consumes
    return store.rows().select(*feed.columns)   # without what the outbox adds


def stream_multi_commit(spark, sf):
    """Raw event log, many commits of one user within a consume, delivered in
    one run: the table holds what a replay in order leaves."""
    root = work_path(spark, "stream", "commits")
    log = fx.events_log(spark, sf).drop(CONSUME)
    _write_change_log(spark, log, f"{root}/change_log", _log_files(spark, sf, "events", 6))
    table = NativeTable(spark, f"{root}/user_state", keys=["user_id"])
    spec = SyncSpec("events", "user_state", capture="stream", mode="upsert", keys=["user_id"],
                    change_log=f"{root}/change_log", outbox=f"{root}/outbox", order_cols=["event_id"])
    job.run(spark, spec, log, table, change_log_schema=log.schema)
    return table.read()


def outbox_two_targets(spark, sf):
    """Two tables fed from one outbox: the second still gets what the first has
    received and purged with no retention."""
    root = work_path(spark, "stream", "two")
    keys, old = ["o_orderkey"], fx.orders_old(spark, sf)
    feed = snapshot_diff(old, fx.orders_new(spark, sf), keys)
    tables = [NativeTable(spark, f"{root}/{name}", keys=keys, buckets=4) for name in ("first", "second")]

    def deliver(i):
        spec = SyncSpec("orders", ("first", "second")[i], capture="stream", mode="upsert", keys=keys,
                        change_log=f"{root}/change_log", outbox=f"{root}/outbox")
        job.run(spark, spec, feed, tables[i], change_log_schema=feed.schema)
    for i in (0, 1):
        tables[i].publish(upserts=old)
        deliver(i)  # nothing to deliver yet, but the target is known from here on
    _write_change_log(spark, feed, f"{root}/change_log", _log_files(spark, sf, "orders", 4))
    deliver(0)
    deliver(1)
    return tables[1].read()


def cdc_columns(spark, sf):
    """Feed rows with the columns the outbox appends."""
    return add_cdc_columns(fx.events_feed(spark, sf).drop(CONSUME), 7, fx.NOW)


def upsert_typed(spark, sf):
    """Keys read as int and money read as text, upserted into a table keyed by
    bigint with decimal money."""
    root = work_path(spark, "native", "typed")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    typed = lambda o: o.select("o_orderkey", "o_orderstatus", cents.cast("decimal(18,2)").alias("cents"))
    table = NativeTable(spark, f"{root}/orders_t", keys=["o_orderkey"], buckets=8)
    job.run(spark, SyncSpec("orders_v1", "orders_t", keys=["o_orderkey"]),
            typed(fx.orders_stale_target(spark, sf)), table)
    loose = fx.orders(spark, sf).select(F.col("o_orderkey").cast("int").alias("o_orderkey"), "o_orderstatus",
                                        F.concat(cents.cast("string"), F.lit(".00")).alias("cents"))
    job.run(spark, SyncSpec("orders", "orders_t", mode="upsert", keys=["o_orderkey"]), loose, table)
    return table.read()


def truncate_filled(spark, sf):
    """A filled table emptied and loaded anew in one publish."""
    root = work_path(spark, "native", "truncate")
    table = NativeTable(spark, f"{root}/orders_t", keys=["o_orderkey"])
    for rows in (fx.orders_old(spark, sf), fx.orders_new(spark, sf)):
        job.run(spark, SyncSpec("orders", "orders_t", keys=["o_orderkey"]), rows, table)
    return table.read()


def append_replayed(spark, sf):
    """Two appended batches, the second delivered twice under one replay key."""
    root = work_path(spark, "native", "append")
    table, spec = NativeTable(spark, f"{root}/t"), SyncSpec("orders", "t", mode="append")
    for rows, day in ((fx.orders_old(spark, sf), "1"), (fx.orders_new(spark, sf), "2"), (fx.orders_new(spark, sf), "2")):
        job.run(spark, spec, rows, table, replay_key=day)
    return table.read()


# ---------------------------------------------------------------- JDBC sink (W3 on Derby)

ORDERS_DDL = ("o_orderkey BIGINT NOT NULL PRIMARY KEY, o_custkey BIGINT, o_orderstatus VARCHAR(16), "
              "o_totalprice DOUBLE, o_orderdate TIMESTAMP, o_orderpriority VARCHAR(32), "
              "o_note VARCHAR(64)")


def jdbc_upsert(spark, sf):
    """hwm upsert into a keyed table of an in-process Derby database; the
    target-only column ``o_note`` keeps its values on matched rows."""
    url = derby_memory_url()
    sink = JdbcSink(spark, url, "orders_t", keys=["o_orderkey"])
    cols = ", ".join(f"{q(c.split()[0])} {' '.join(c.split()[1:])}" for c in ORDERS_DDL.split(", "))
    sink.execute(f"CREATE TABLE {q('orders_t')} ({cols})")
    stale = fx.orders_stale_target(spark, sf, note=True)
    (stale.write.format("jdbc").option("url", url).option("dbtable", q("orders_t"))
     .mode("append").save())
    fx.orders(spark, sf).createOrReplaceTempView("orders_now")
    spec = SyncSpec("orders_now", "orders_t", capture="hwm", mode="upsert", keys=["o_orderkey"],
                    hwm_col="o_orderdate", hwm_start=fx.HWM_START)
    job.run(spark, spec, spark.table("orders_now"), sink)
    back = sink.read()
    # Materialise before the in-memory database can go away.
    path = work_path(spark, "jdbc", "orders_t")
    back.write.parquet(path)
    return spark.read.parquet(path)


def jdbc_stream_job(spark, sf):
    """Stream capture into a JDBC table: upserts and deletes of the snapshot
    feed applied in one transaction on an in-process Derby database."""
    root = work_path(spark, "jdbc", "stream")
    url = derby_memory_url()
    keys = ["o_orderkey"]
    sink = JdbcSink(spark, url, "orders_t", keys=keys)
    cols = ", ".join(f"{q(c.split()[0])} {' '.join(c.split()[1:])}"
                     for c in ORDERS_DDL.split(", ") if not c.startswith("o_note"))
    sink.execute(f"CREATE TABLE {q('orders_t')} ({cols})")
    old = fx.orders_old(spark, sf)
    job.run(spark, SyncSpec("orders_old", "orders_t", mode="append"), old, sink)
    feed = snapshot_diff(old, fx.orders_new(spark, sf), keys)
    _write_change_log(spark, feed, f"{root}/change_log", _log_files(spark, sf, "orders", 4))
    spec = SyncSpec("orders", "orders_t", capture="stream", mode="upsert", keys=keys,
                    change_log=f"{root}/change_log", outbox=f"{root}/outbox")
    for _ in range(2):
        job.run(spark, spec, feed, sink, change_log_schema=feed.schema)
    path = f"{root}/result"
    sink.read().write.parquet(path)
    return spark.read.parquet(path)


def composite_key_upsert(spark, sf):
    """Upsert on a two-column key through the native sink: later turns of each
    conversation replace stale text and add the turns the target lacked."""
    root = work_path(spark, "native", "composite")
    keys = ["conv_id", "turn"]
    conv = read_table(spark, sf, "conversations")
    stale = (conv.where(F.col("turn") <= 3)
             .withColumn("text", F.when(F.col("turn") >= 2, F.lit("stale")).otherwise(F.col("text"))))
    table = NativeTable(spark, f"{root}/conv_t", keys=keys, buckets=8)
    job.run(spark, SyncSpec("conv_v1", "conv_t", keys=keys), stale, table)
    job.run(spark, SyncSpec("conversations", "conv_t", mode="upsert", keys=keys),
            conv.where(F.col("turn") >= 2), table)
    return table.read()


def jdbc_source_hwm(spark, sf):
    """hwm window read from a database table: 8 parallel key-range readers,
    the window predicate pushed into each range query."""
    from ..plans.planner import hwm_rows
    from ..sources.jdbc_source import read_jdbc_table
    from ..sources.scan import Watermark
    url = derby_memory_url()
    o = fx.orders(spark, sf)
    sink = JdbcSink(spark, url, "orders_src", keys=["o_orderkey"])
    sink.execute(create_table_sql("orders_src", o.schema, ["o_orderkey"])
                 .replace("VARCHAR(32672)", "VARCHAR(64)"))
    o.write.format("jdbc").option("url", url).option("dbtable", q("orders_src")).mode("append").save()
    src = read_jdbc_table(spark, url, "orders_src", partition_col="o_orderkey", num_partitions=8)
    window = hwm_rows(src, "o_orderdate", Watermark("timestamp_ntz", fx.HWM_START))
    path = work_path(spark, "jdbc", "source_window")
    window.write.parquet(path)       # materialised before the in-memory database goes away
    return spark.read.parquet(path)


# ---------------------------------------------------------------- generator

def claims_generator(spark, sf):
    return claims_from_orders(read_table(spark, sf, "orders"))


def claims_settled(spark, sf):
    """The update half of an increment: every 10th claim paid or denied."""
    return claims_updates(claims_from_orders(read_table(spark, sf, "orders")))


def stage_layout(spark, sf):
    """What lies under ``<stage>/<run>/{upsert,delete}`` after a run was staged
    again under its own name: rows, keys and key range of each folder (W8)."""
    root, key = work_path(spark, "stage"), ["o_orderkey"]
    old, new = fx.orders_old(spark, sf), fx.orders_new(spark, sf)
    gone = old.join(new, key, "left_anti").select(*key)
    for up in (old, new):  # the second staging clears the folders first
        staging.stage_round_trip(spark, up, gone, "parquet", root, "run", keys=key)
    files = spark.read.schema("o_orderkey long").option("recursiveFileLookup", "true").parquet(f"{root}/run")
    part = F.regexp_extract("_metadata.file_path", "/run/([a-z]+)/[^/]+$", 1).alias("part")
    return files.select(part, "o_orderkey").groupBy("part").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("o_orderkey").alias("n_keys"),
        F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


IO_QUERIES = {
    "csv_round_trip": csv_round_trip,
    "csv_round_trip_pages": csv_round_trip_pages,
    "csv_round_trip_conversations": csv_round_trip_conversations,
    "csv_codecs": csv_codecs,
    "positional_csv": positional_csv,
    "parquet_staging": parquet_staging,
    "hwm_job": hwm_job,
    "run_log": run_log,
    "positional_csv_header": positional_csv_header,
    "stream_multi_commit": stream_multi_commit,
    "outbox_two_targets": outbox_two_targets,
    "cdc_columns": cdc_columns,
    "upsert_typed": upsert_typed,
    "truncate_filled": truncate_filled,
    "append_replayed": append_replayed,
    "table_changes": table_changes,
    "stream_job": stream_job,
    "stream_consume": stream_consume,
    "jdbc_upsert": jdbc_upsert,
    "jdbc_stream_job": jdbc_stream_job,
    "jdbc_source_hwm": jdbc_source_hwm,
    "composite_key_upsert": composite_key_upsert,
    "claims_generator": claims_generator,
    "claims_settled": claims_settled,
    "stage_layout": stage_layout,
}



# ---------------------------------------------------------------- more codecs and writes

def exclude_replace(spark, sf):
    """``SELECT * EXCLUDE (props) REPLACE (upper(event_type) AS event_type)``."""
    from ..functions.columns import exclude, replace
    e = read_table(spark, sf, "events")
    return replace(exclude(e, ["props"]), {"event_type": F.upper("event_type")})


def semi_structured(spark, sf):
    """JSON text → Variant → staged as JSON text in CSV → Variant; field read back."""
    e = read_table(spark, sf, "events").select("event_id", F.parse_json("props").alias("props"))
    path = work_path(spark, "csv", "variant")
    staging.write_csv(e, path)
    back = staging.read_csv(spark, path, e.schema)
    return back.select("event_id", F.variant_get("props", "$.k", "int").alias("k"),
                       F.to_json("props").alias("props_json"))


def zoned_timestamp(spark, sf):
    """Instants (session zone UTC) staged with an explicit offset and read back."""
    e = read_table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    path = work_path(spark, "csv", "zoned")
    staging.write_csv(e, path)
    back = staging.read_csv(spark, path, e.schema)
    return back.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts_utc"),
                       F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSSXXX").alias("ts_text"))


def staged_delete(spark, sf):
    """Bulk delete from a staged key file, decoded with the same codec as upserts."""
    from ..operators.merge import delete_by_key
    o = read_table(spark, sf, "orders")
    gone = o.where((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < fx.ts(fx.ARCHIVE_BEFORE)))
    _, keys = staging.stage_round_trip(spark, None, gone.select("o_orderkey"), "csv",
                                       work_path(spark, "stage"), "run")
    return delete_by_key(o, keys, ["o_orderkey"])


IO_QUERIES.update({
    "exclude_replace": exclude_replace,
    "semi_structured": semi_structured,
    "zoned_timestamp": zoned_timestamp,
    "staged_delete": staged_delete,
})


# ---------------------------------------------------------------- row numbers

#: Orders the lines without ties.
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def dense_ids_q(spark, sf):
    """Every line with its dense number in key order."""
    from ..operators.rownumbers import dense_ids
    lines = read_table(spark, sf, "lineitem").select(*LINE_ORDER, "l_shipdate")
    return dense_ids(lines, LINE_ORDER, "line_id")


IO_QUERIES["dense_ids"] = dense_ids_q


# ---------------------------------------------------------------- commits and what is pending

def _log_in_two_commits(spark, sf, path, numbered=False):
    """The raw event log written by two commits, events up to NOW and later ones."""
    log = fx.events_log(spark, sf).drop(CONSUME)
    parts = log.where(F.col("ts") < fx.ts(fx.NOW)), log.where(~(F.col("ts") < fx.ts(fx.NOW)))
    files = _log_files(spark, sf, "events", 3)
    for part in parts:
        if numbered:
            append_commit(spark, path, part.repartition(files))
        else:
            _write_change_log(spark, part, path, files)
    return log


def stream_equal_times(spark, sf):
    """Two commits whose files carry the same time. A run that would have to
    order them by it refuses and leaves the table alone; with an order column
    the same outbox is delivered. The later commit's deletes are not lost."""
    root = work_path(spark, "stream", "equal-times")
    log_path = f"{root}/change_log"
    log = _log_in_two_commits(spark, sf, log_path)
    for name in fs.list_names(spark, log_path):
        if name.endswith(".parquet"):
            fs.set_time(spark, f"{log_path}/{name}", 1_700_000_000_000)
    table = NativeTable(spark, f"{root}/user_state", keys=["user_id"])
    table.publish(upserts=log.where("_cdc_action = 'INSERT'").drop("_cdc_action").limit(0))
    spec = dict(capture="stream", mode="upsert", keys=["user_id"], change_log=log_path, outbox=f"{root}/outbox")
    try:
        job.run(spark, SyncSpec("events", "user_state", **spec), log, table, change_log_schema=log.schema)
    except ValueError as refused:
        if table.version() != 1:
            raise RuntimeError("a refused run changed the table") from refused
    else:
        raise RuntimeError("commits of equal time were delivered in any order")
    job.run(spark, SyncSpec("events", "user_state", order_cols=["event_id"], **spec), log, table,
            change_log_schema=log.schema)
    return table.read()


def feed_pending_q(spark, sf):
    """What a change log holds beyond the checkpoint: all of it before the first
    consume, the second commit after that, nothing at the end."""
    root = work_path(spark, "stream", "pending")
    log_path = f"{root}/change_log"
    log = fx.events_log(spark, sf).drop(CONSUME)
    store = OutboxStore(spark, f"{root}/outbox")
    early = F.col("ts") < fx.ts(fx.NOW)
    files = _log_files(spark, sf, "events", 3)
    looks = []

    def look(when):
        seen = feed_pending(spark, log_path, log.schema, store.checkpoint).withColumn("looked", F.lit(when))
        path = f"{root}/look-{len(looks)}"
        seen.write.parquet(path)
        looks.append(path)
    append_commit(spark, log_path, log.where(early).repartition(files))
    look("before the first consume")
    consume_to_outbox(spark, log_path, log.schema, store)
    append_commit(spark, log_path, log.where(~early).repartition(files))
    look("after the second commit")
    consume_to_outbox(spark, log_path, log.schema, store)
    look("after all")
    schema = T.StructType([*log.schema.fields, T.StructField("looked", T.StringType())])
    return spark.read.schema(schema).parquet(*looks)


IO_QUERIES.update({"stream_equal_times": stream_equal_times, "feed_pending": feed_pending_q})


# ---------------------------------------------------------------- rejects, defaults, footers

def _event_text(spark, sf):
    """Events as text, as another system might hand them over: money with three
    digits behind the point, times in words, numbers missing or not numbers."""
    e = read_table(spark, sf, "events")
    kind, milli = F.col("event_type"), F.round(F.col("value") * 1000).cast("long")
    amount = F.concat(F.floor(milli / 1000).cast("string"), F.lit("."), F.lpad((milli % 1000).cast("string"), 3, "0"))
    return e.select(F.col("event_id").cast("string").alias("event_id"),
                    F.when(kind == "error", "yesterday").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ts"),
                    F.when(F.col("user_id") % 10 != 3, F.col("user_id").cast("string")).alias("user_id"),
                    amount.alias("amount"), F.when(kind == "view", "n/a").otherwise("7").alias("count"))


def typed_rejects(spark, sf):
    """Text rows cast to declared types; what does not fit stands aside with reasons."""
    schema = T.StructType.fromDDL("event_id bigint not null, ts timestamp_ntz, user_id bigint not null, "
                                  "amount decimal(12,2), count int")
    root = work_path(spark, "csv", "rejects")
    staging.write_csv(_event_text(spark, sf), f"{root}/files", max_records=5000)
    good, bad = staging.read_csv_rejects(spark, f"{root}/files", schema, f"{root}/stored", max_rejects=1 << 60)
    text = good.select(F.col("event_id").cast("string").alias("event_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
                       F.col("user_id").cast("string").alias("user_id"), F.col("amount").cast("string").alias("amount"),
                       F.col("count").cast("string").alias("count"))
    return (text.withColumn("reasons", F.lit(""))
            .unionByName(bad.withColumn("reasons", F.array_join("reasons", "; "))))


def upsert_defaults(spark, sf):
    """Replacing upsert into a native table whose target-only column has a
    default: replaced and new rows get it, rows left alone keep what they had."""
    root = work_path(spark, "native", "defaults")
    table = NativeTable(spark, f"{root}/orders_t", keys=["o_orderkey"], buckets=8,
                        defaults={"o_note": "concat('none', ' given')"})
    job.run(spark, SyncSpec("orders_v1", "orders_t", keys=["o_orderkey"]), fx.orders_stale_target(spark, sf, note=True), table)
    fx.orders(spark, sf).createOrReplaceTempView("orders_now")
    job.run(spark, SyncSpec("orders_now", "orders_t", capture="hwm", mode="upsert", keys=["o_orderkey"], hwm_col="o_orderdate",
                            hwm_start=fx.HWM_START, on_match="replace"), spark.table("orders_now"), table)
    return table.read()


def ceiling_footers(spark, sf):
    """Ceilings of a number column (from footers) and of a time column (by a scan)."""
    from ..sources.scan import footer_ceiling
    from ..sources.tables import table_path
    path = table_path(sf, "orders")
    tops = [(c, footer_ceiling(spark, path, c).value) for c in ("o_orderkey", "o_custkey", "o_orderdate")]
    return spark.createDataFrame(tops, "column string, ceiling string")


IO_QUERIES.update({"typed_rejects": typed_rejects, "upsert_defaults": upsert_defaults, "ceiling_footers": ceiling_footers})


# ---------------------------------------------------------------- keys of a case-insensitive target

def upsert_collated(spark, sf):
    """Customers by name in a table that ignores case. A second system writes
    names in capitals: known ones are updated and keep their spelling, a log of
    it that deletes and writes names in either case is reduced per folded name."""
    root = work_path(spark, "native", "collated")
    keys = ["c_name"]
    customers = read_table(spark, sf, "customer").select("c_name", "c_mktsegment", "c_nationkey")
    first = customers.where(F.col("c_mktsegment") != "MACHINERY")
    loud = customers.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        F.upper("c_name").alias("c_name"), F.lit("LOUD").alias("c_mktsegment"), "c_nationkey")
    table = NativeTable(spark, f"{root}/customers", keys=keys, buckets=8, case_insensitive=True)
    fold = dict(keys=keys, case_insensitive_keys=True)
    job.run(spark, SyncSpec("crm", "customers", **fold), first, table)
    job.run(spark, SyncSpec("erp", "customers", mode="upsert", **fold), loud, table)
    change = customers.where(F.col("c_mktsegment") == "FURNITURE")
    row = lambda name, action: change.select(name.alias("c_name"), F.lit("GONE").alias("c_mktsegment"), "c_nationkey",
                                             F.lit(action).alias("_cdc_action"))
    append_commit(spark, f"{root}/log", row(F.lower("c_name"), "INSERT"))
    append_commit(spark, f"{root}/log", row(F.upper("c_name"), "DELETE"))
    feed = row(F.col("c_name"), "INSERT")
    job.run(spark, SyncSpec("log", "customers", capture="stream", mode="upsert", change_log=f"{root}/log",
                            outbox=f"{root}/outbox", **fold), feed, table, change_log_schema=feed.schema)
    return table.read()


IO_QUERIES["upsert_collated"] = upsert_collated


# ---------------------------------------------------------------- times of day and offsets

def time_codecs(spark, sf):
    """Times of day through CSV and Parquet files, and zoned times in text kept
    as instant and offset and written out again in their offset."""
    from ..functions.columns import in_offset, micros_time, offset_of, time_micros, time_text
    e = read_table(spark, sf, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp")) % 86_400_000_000
    offset = F.when(F.col("user_id") % 3 == 0, "Z").when(F.col("user_id") % 3 == 1, "+05:30").otherwise("-03:00")
    src = e.select("event_id", micros_time(micros).alias("time"),
                   F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), offset).alias("zoned"))
    root = work_path(spark, "csv", "times")
    staging.write_csv(src, f"{root}/csv", max_records=5000)
    staging.write_parquet(staging.read_csv(spark, f"{root}/csv", src.schema), f"{root}/parquet")
    back = spark.read.schema(src.schema).parquet(f"{root}/parquet")
    back = back.withColumns({"instant": F.to_timestamp("zoned", staging.CSV_OPTIONS["timestampFormat"]),
                             "offset": offset_of(F.col("zoned"))})
    return back.select("event_id", time_text(F.col("time")).alias("time_text"), time_micros(F.col("time")).alias("time_micros"),
                       F.col("instant").cast("timestamp_ntz").alias("instant_utc"), "offset",
                       in_offset(F.col("instant"), F.col("offset")).alias("zoned"))


IO_QUERIES["time_codecs"] = time_codecs
