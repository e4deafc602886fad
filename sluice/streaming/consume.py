"""Structured Streaming consumption of an append-only change log into the outbox.

``trigger(availableNow=True)`` drains what is pending and stops (a scheduled
run); ``processingTime`` keeps it running. Each micro-batch becomes one
consume: ``foreachBatch`` writes partition ``consume_id=<batchId>`` with
dynamic partition overwrite, so a batch replayed after a failure rewrites the
same partition and never duplicates rows. The streaming checkpoint (kept in
the outbox folder, so batch ids are unique for the outbox's life) is the
offset; it advances only after the batch's write committed.

Change position is file/commit order, not event time: a row stamped early but
committed late is still delivered (no event-time watermark is used).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fs
from .feed import COMMIT_NO, StaleFeed, check_log, commit_number
from .outbox import COMMIT_ID, COMMITTED_AT, OutboxStore


_FILE, _WRITTEN = "_cdc_file", "_cdc_written_at"


def consume_to_outbox(spark: SparkSession, change_log: str, schema: T.StructType,
                      outbox: OutboxStore, max_files_per_trigger: int | None = None,
                      processing_time: str | None = None, timeout_s: float | None = None,
                      max_file_age: str = "30d", commit_col: str | None = None) -> list[int]:
    """Move every pending change-log row into the outbox; returns new consume ids.

    Each row gets the commit of its file: its time, identity and, in numbered
    logs, number. The run first makes sure that no commit left the log before it
    was consumed (``check_log``); with ``commit_col`` (a number or time that
    grows with the commits) also that the log still reaches back to what was
    consumed last.

    ``max_file_age`` bounds the list of seen files that the stream keeps: a file
    is only skipped if it is that much older than the newest file consumed in an
    earlier run and was not there then. File times are commit times here.
    """
    ckpt = outbox.checkpoint
    check_log(spark, change_log, ckpt)
    if not fs.exists(spark, change_log):
        return []          # nothing has been published to the change log yet
    if not fs.exists(spark, ckpt) and outbox.rows() is not None:
        raise RuntimeError("outbox holds rows but its checkpoint is missing; "
                           "a new checkpoint would reuse consume ids")
    if commit_col:
        kind = schema[commit_col].dataType
        last = outbox.position(commit_col, kind.simpleString())
        check_staleness(spark.read.schema(schema).parquet(change_log), commit_col,
                        None if last is None else F.lit(last).cast(kind))
    before = set(outbox.consume_ids())
    reader = spark.readStream.schema(schema).option("maxFileAge", max_file_age)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(change_log).select(
        "*", F.col("_metadata.file_name").alias(_FILE), F.col("_metadata.file_modification_time").alias(_WRITTEN))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        outbox.write_consume(with_commit_time(batch), int(batch_id), loaded_at=now)

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    q = w.start()
    if processing_time:
        q.awaitTermination(timeout_s)
        q.stop()
    else:
        q.awaitTermination()
    new = sorted(set(outbox.consume_ids()) - before)
    if new and commit_col:
        outbox.note_position(new[-1], commit_col)
    return new


def with_commit_time(batch: DataFrame) -> DataFrame:
    """Rows with the time of the commit that brought them, in place of their
    file. The files of one numbered commit carry its number; those of one Spark
    write share the write's id in their names. They were committed together,
    when the last of them was there; any other file is a commit of its own. One
    row per commit is joined back: it goes to all tasks, as a join by commit
    would put all rows of a commit into one task."""
    write_id = F.regexp_extract(_FILE, "^part-[0-9]+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})", 1)
    number = commit_number(F.col(_FILE))
    rows = batch.withColumns({COMMIT_NO: number, COMMIT_ID: F.coalesce(
        number.cast("string"), F.when(write_id != "", write_id), F.col(_FILE))})
    commits = rows.groupBy(COMMIT_ID).agg(F.max(_WRITTEN).alias(COMMITTED_AT))
    return rows.join(F.broadcast(commits), COMMIT_ID).drop(_FILE, _WRITTEN)


def check_staleness(change_log: DataFrame, commit_col: str, last_consumed) -> None:
    """Raise when the log no longer reaches back to the last consumed position:
    changes in between may have been dropped. Whoever cleans the log keeps the
    newest consumed change until the next run."""
    if last_consumed is None:
        return
    last = last_consumed if isinstance(last_consumed, Column) else F.lit(last_consumed)
    oldest = change_log.agg(F.min(commit_col).alias("m")).select("m", (F.col("m") > last).alias("late")).first()
    if oldest["late"]:
        raise StaleFeed(f"the change log starts at {oldest['m']!r}, after what was consumed last: "
                        f"full reload required")
