"""The change log as files: numbered commits, what a stream has seen of it, what is pending.

``append_commit`` writes one commit of a log as files that carry its number
(``c0000000012-00000-of-00004-<id>.parquet``); numbers have no gaps, so a
consumer can order the commits by them and notice when one was taken away. Logs
written in any other way work as well: their commits are ordered by file time,
and are only missed when the newest consumed one is gone too.

What a stream has seen stands in its checkpoint, one line per file; looking at
it moves nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fs

#: Number of the commit that brought a row; null in logs without numbers.
COMMIT_NO = "_cdc_commit_no"
_NAME = r"^c([0-9]{10})-([0-9]{5})-of-([0-9]{5})-"
_SEEN = "path string, timestamp long, batchId long"
_STAGED, _CLAIMS = "_staged", "_commits"


class StaleFeed(RuntimeError):
    """Changes were removed from the log before being consumed: reload fully."""


def commit_number(file_name: Column) -> Column:
    """The number in the name of a log file, or null."""
    digits = F.regexp_extract(file_name, _NAME, 1)
    return F.when(digits != "", digits).cast("long")


def append_commit(spark: SparkSession, change_log: str, feed: DataFrame) -> int:
    """Append ``feed`` to a change log as one numbered commit; returns its number.

    The files are written aside, the next number is claimed exclusively (two
    writers cannot share one), then the files get their names. A writer that
    dies in between leaves its files aside; readers see a commit under way.
    """
    aside = f"{change_log}/{_STAGED}/{uuid.uuid4().hex}"
    feed.write.parquet(aside)
    parts = sorted(n for n in fs.list_names(spark, aside) if n.endswith(".parquet"))
    claims = f"{change_log}/{_CLAIMS}"
    fs.ensure_dir(spark, claims)
    while True:
        n = max((int(c[1:11]) for c in fs.list_names(spark, claims) if c.startswith("c")), default=0) + 1
        if fs.create_exclusive(spark, f"{claims}/c{n:010d}", aside):
            break
    for i, part in enumerate(parts):
        name = f"c{n:010d}-{i:05d}-of-{len(parts):05d}-{uuid.uuid4().hex}.parquet"
        if not fs.rename(spark, f"{aside}/{part}", f"{change_log}/{name}"):
            raise OSError(f"could not put {name} into {change_log}")
    fs.delete(spark, aside)
    return n


def _same_form(path: Column) -> Column:
    """A file's path without scheme and authority."""
    return F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


def log_files(spark: SparkSession, change_log: str) -> DataFrame:
    """``file``, ``written_at`` and ``commit_no`` of every file; no content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(change_log)
    return files.select(_same_form(F.col("path")).alias("file"), F.col("modificationTime").alias("written_at"),
                        commit_number(F.element_at(F.split("path", "/"), -1)).alias("commit_no"))


def seen_files(spark: SparkSession, checkpoint: str) -> DataFrame | None:
    """``file``, ``written_at``, ``commit_no`` of the files that committed
    batches of the stream have read; None if there was no batch yet."""
    batches = [int(n) for n in fs.list_names(spark, f"{checkpoint}/commits") if n.isdigit()]
    if not batches:
        return None
    entry = F.from_json("value", _SEEN)
    lines = spark.read.text(f"{checkpoint}/sources/0").where(F.col("value").startswith("{")).select(entry.alias("e"))
    return (lines.where(F.col("e.batchId") <= max(batches))
            .select(_same_form(F.call_function("url_decode", F.replace("e.path", F.lit("+"), F.lit("%2B")))).alias("file"),
                    F.timestamp_millis("e.timestamp").alias("written_at"),
                    commit_number(F.element_at(F.split("e.path", "/"), -1)).alias("commit_no")).distinct())


def pending_files(spark: SparkSession, change_log: str, checkpoint: str) -> DataFrame:
    """The files of the log that the stream has not consumed yet."""
    files, seen = log_files(spark, change_log), seen_files(spark, checkpoint)
    return files if seen is None else files.join(seen.select("file"), "file", "left_anti")


def feed_pending(spark: SparkSession, change_log: str, schema: T.StructType, checkpoint: str) -> DataFrame:
    """The changes that the next consume would move, as they stand in the log.

    Files older than the oldest pending one are not opened. The names of the
    pending files go to all tasks: a join by file would put each file's rows
    into one task."""
    pending = pending_files(spark, change_log, checkpoint)
    oldest = pending.agg(F.min("written_at").alias("t")).first()["t"]
    rows = spark.read.schema(schema).parquet(change_log).select("*", F.col("_metadata.file_path").alias("_file"),
                                                                F.col("_metadata.file_modification_time").alias("_at"))
    if oldest is None:
        return rows.where(F.lit(False)).drop("_file", "_at")
    here = rows.where(F.col("_at") >= F.lit(oldest)).withColumn("file", _same_form(F.call_function(
        "url_decode", F.replace("_file", F.lit("+"), F.lit("%2B")))))
    return here.join(F.broadcast(pending.select("file")), "file", "left_semi").drop("file", "_file", "_at")


def has_pending(spark: SparkSession, change_log: str, checkpoint: str) -> bool:
    return fs.exists(spark, change_log) and not pending_files(spark, change_log, checkpoint).isEmpty()


def _under_way(spark: SparkSession, change_log: str, number: int) -> bool:
    """Whether the writer of a claimed commit still has its files aside."""
    aside = fs.read_text(spark, f"{change_log}/{_CLAIMS}/c{number:010d}").strip()
    return fs.exists(spark, aside)


def check_log(spark: SparkSession, change_log: str, checkpoint: str) -> None:
    """Raise ``StaleFeed`` when changes left the log before they were consumed.

    The newest consumed commit has to be there still; whoever cleans the log
    keeps it until the next run. In a numbered log, moreover, all commits from
    it to the highest number claimed have to be there with all their files. The
    driver sees a few scalars and the numbers of commits under way.
    """
    seen = seen_files(spark, checkpoint)
    claims = {int(c[1:11]) for c in fs.list_names(spark, f"{change_log}/{_CLAIMS}") if c.startswith("c")}
    if seen is None and not claims:
        return
    there = fs.exists(spark, change_log)
    files = log_files(spark, change_log) if there else None
    last = 0
    if seen is not None:
        newest = seen.agg(F.max("written_at").alias("t"), F.max("commit_no").alias("n")).first()
        last = newest["n"] or 0
        same = seen.where(F.col("written_at") == F.lit(newest["t"])).select("file")
        if files is None or files.join(same, "file", "left_semi").isEmpty():
            raise StaleFeed("what was consumed last is no longer in the change log, and changes after it may be "
                            "gone too: full reload required")
    if not claims or max(claims) <= last:
        return
    name = F.element_at(F.split("file", "/"), -1)
    whole = (files.where(F.col("commit_no") > last).groupBy("commit_no")
             .agg((F.count(F.lit(1)) == F.max(F.regexp_extract(name, _NAME, 3).cast("int"))).alias("whole"))
             .where("whole"))
    found = whole.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if found == max(claims) - last:
        return
    missing = (spark.range(last + 1, max(claims) + 1).withColumnRenamed("id", "commit_no")
               .join(whole, "commit_no", "left_anti").orderBy("commit_no"))
    for r in missing.toLocalIterator():
        if r["commit_no"] not in claims or not _under_way(spark, change_log, r["commit_no"]):
            raise StaleFeed(f"commit {r['commit_no']} of the change log is gone: full reload required")
