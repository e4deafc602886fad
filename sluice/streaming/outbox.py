"""Outbox: durable change rows held until delivery is confirmed.

Layout: Parquet partitioned by integer ``consume_id`` (one partition per
consume, i.e. per streaming micro-batch) plus a small ledger of delivered
consumes ``(target, consume_id, acked_at)``. All rows of a consume share one
load time, so cutoff, acknowledge and purge work on whole consumes: no
row-level UPDATE or DELETE is ever needed.

The DataFrame functions below are the operators; ``OutboxStore`` binds them to
a folder.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.netchange import ACTION, CONSUME, LOADED_AT
from .. import fs

#: Time of the change-log commit that brought a row.
COMMITTED_AT = "_cdc_committed_at"
#: Identity of that commit: its number, the id of the write, or its file.
COMMIT_ID = "_cdc_commit_id"
#: Ledger entry of a target that reads the outbox and may not have received anything yet.
REGISTERED = -1

LEDGER_SCHEMA = T.StructType([
    T.StructField("target", T.StringType(), False),
    T.StructField(CONSUME, T.LongType(), False),
    T.StructField("acked_at", T.TimestampNTZType(), True),
])


def add_cdc_columns(feed: DataFrame, consume_id: int, loaded_at) -> DataFrame:
    """Outbox row = feed row + load time + consume id (by name, not position)."""
    return (feed.withColumn(LOADED_AT, F.lit(loaded_at).cast("timestamp_ntz"))
            .withColumn(CONSUME, F.lit(consume_id).cast("long")))


def acked_consumes(ledger: DataFrame, target: str) -> DataFrame:
    return ledger.where(F.col("target") == target).select(CONSUME).distinct()


def pending(outbox: DataFrame, ledger: DataFrame, target: str) -> DataFrame:
    """Rows not yet delivered to ``target`` (anti join on the small ledger)."""
    return outbox.join(acked_consumes(ledger, target), CONSUME, "left_anti")


def cutoff(pending_rows: DataFrame) -> DataFrame:
    """Newest pending consume and the pending row count (one aggregate)."""
    return pending_rows.agg(F.max(CONSUME).alias("cutoff"),
                            F.count(F.lit(1)).alias("pending_rows"))


def cutoff_value(pending_rows: DataFrame) -> int | None:
    return pending_rows.agg(F.max(CONSUME).alias("c")).first()["c"]


def up_to(pending_rows: DataFrame, cut: int) -> DataFrame:
    """Rows a run reads and acknowledges; later consumes stay pending."""
    return pending_rows.where(F.col(CONSUME) <= F.lit(cut))


def ack_rows(window: DataFrame, target: str, acked_at) -> DataFrame:
    """Ledger rows for every consume of the delivered window."""
    return (window.select(CONSUME).distinct()
            .select(F.lit(target).alias("target"), CONSUME,
                    F.lit(acked_at).cast("timestamp_ntz").alias("acked_at")))


def purgeable(outbox: DataFrame, ledger: DataFrame, target: str | Sequence[str], now,
              retention_days: int) -> DataFrame:
    """Consumes delivered to ``target`` (all of them, if several) and loaded at
    least ``retention_days`` before ``now``."""
    if retention_days < 0:
        raise ValueError("retention_days must be 0 or more")
    limit = F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(F.lit(retention_days))
    loaded = outbox.select(CONSUME, LOADED_AT).where(F.col(LOADED_AT) <= limit).distinct()
    targets = [target] if isinstance(target, str) else list(target)
    by_all = (ledger.where(F.col("target").isin(targets)).groupBy(CONSUME)
              .agg(F.count_distinct("target").alias("n")).where(F.col("n") == len(set(targets))))
    return loaded.join(by_all, CONSUME, "left_semi").select(CONSUME)


def purge(outbox: DataFrame, ledger: DataFrame, target: str | Sequence[str], now,
          retention_days: int) -> DataFrame:
    """Outbox contents after the purge; pending rows are never touched."""
    gone = purgeable(outbox, ledger, target, now, retention_days)
    return outbox.join(gone, CONSUME, "left_anti")


def history(outbox: DataFrame, ledger: DataFrame, target: str) -> DataFrame:
    """Rows per consume and action, with the consume's delivered flag."""
    acked = acked_consumes(ledger, target).withColumn("delivered", F.lit(True))
    return (outbox.groupBy(CONSUME, ACTION).agg(F.count(F.lit(1)).alias("n_rows"))
            .join(acked, CONSUME, "left")
            .withColumn("delivered", F.coalesce(F.col("delivered"), F.lit(False))))


def pending_count(outbox: DataFrame, ledger: DataFrame, target: str) -> DataFrame:
    """``COUNT_IF(NOT exported)``; a non-zero count forbids re-creating the outbox."""
    acked = acked_consumes(ledger, target).withColumn("_acked", F.lit(True))
    return (outbox.join(acked, CONSUME, "left")
            .agg(F.count_if(F.col("_acked").isNull()).alias("pending_rows")))


class OutboxStore:
    """An outbox folder and its ledger."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.rows_path = f"{self.path}/rows"
        self.ledger_path = f"{self.path}/ledger"
        #: Checkpoint of the stream that fills the outbox.
        self.checkpoint = f"{self.path}/_checkpoint"
        fs.ensure_dir(spark, self.path)

    def rows(self) -> DataFrame | None:
        if not fs.partition_values(self.spark, self.rows_path, CONSUME):
            return None
        return self.spark.read.parquet(self.rows_path)

    def ledger(self) -> DataFrame:
        if not fs.exists(self.spark, self.ledger_path):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.ledger_path)

    def consume_ids(self) -> list[int]:
        return sorted(fs.partition_values(self.spark, self.rows_path, CONSUME))

    def acked_ids(self, target: str) -> set[int]:
        return {r[CONSUME] for r in acked_consumes(self.ledger(), target).collect()}

    def register(self, target: str) -> None:
        """Note that ``target`` reads this outbox; nothing is purged before it
        has received it. Later runs find the note and add none."""
        if self.ledger().where((F.col("target") == target) & (F.col(CONSUME) == REGISTERED)).isEmpty():
            self._ledger_rows([(target, REGISTERED, None)])

    def targets(self) -> list[str]:
        """Every target that has registered or received something."""
        return sorted(r["target"] for r in self.ledger().select("target").distinct().collect())

    def pending_window(self, target: str) -> tuple[DataFrame | None, list[int]]:
        """Rows of the pending consumes (not acknowledged for ``target``), read
        through a partition filter so delivered consumes are never scanned.
        The id lists are bounded by the number of retained consumes."""
        done = self.acked_ids(target)
        ids = [c for c in self.consume_ids() if c not in done]
        if not ids:
            return None, []
        rows = self.spark.read.parquet(self.rows_path).where(F.col(CONSUME).isin(ids))
        return rows, ids

    def write_consume(self, feed: DataFrame, consume_id: int, loaded_at=None) -> None:
        """Write one consume; replaying the same id rewrites only its partition."""
        loaded_at = loaded_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        (add_cdc_columns(feed, consume_id, loaded_at)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(CONSUME).parquet(self.rows_path))

    def _ledger_rows(self, rows: list[tuple]) -> None:
        (self.spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1)
         .write.mode("append").parquet(self.ledger_path))

    def acknowledge(self, window_ids: Sequence[int], target: str, acked_at=None) -> None:
        acked_at = acked_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        if window_ids:
            self._ledger_rows([(target, int(c), acked_at) for c in window_ids])

    def compact_ledger(self, max_files: int = 64) -> bool:
        """Fold the ledger's per-run files into one once there are many, and
        drop the entries of purged consumes, which can never be pending again.

        The folded file is moved in first and the old files removed after, so
        a crash in between leaves duplicate ledger rows (harmless: acknowledged
        ids are read as a set), never missing ones."""
        old = [n for n in fs.list_names(self.spark, self.ledger_path) if n.endswith(".parquet")]
        if len(old) < max_files:
            return False
        tmp = f"{self.path}/ledger_compact"
        keep = [REGISTERED, *self.consume_ids()]
        self.ledger().where(F.col(CONSUME).isin(keep)).coalesce(1).write.mode("overwrite").parquet(tmp)
        for n in fs.list_names(self.spark, tmp):
            if n.endswith(".parquet"):
                fs.rename(self.spark, f"{tmp}/{n}", f"{self.ledger_path}/compact-{n}")
        for n in old:
            fs.delete(self.spark, f"{self.ledger_path}/{n}")
        fs.delete(self.spark, tmp)
        return True

    def purge(self, now, retention_days: int) -> list[int]:
        """Delete partitions older than the retention that every target has
        received; returns their ids."""
        rows = self.rows()
        if rows is None:
            return []
        gone = [r[CONSUME] for r in
                purgeable(rows, self.ledger(), self.targets(), now, retention_days).collect()]
        for c in gone:
            fs.delete(self.spark, f"{self.rows_path}/{CONSUME}={c}")
        return gone

    # ------------------------------------------------------------ log position

    def position(self, column: str, kind: str):
        """Greatest ``column`` consumed so far, or None."""
        names = sorted(fs.list_names(self.spark, f"{self.path}/position"))
        if not names:
            return None
        noted = json.loads(fs.read_text(self.spark, f"{self.path}/position/{names[-1]}"))
        return noted["value"] if (noted["column"], noted["type"]) == (column, kind) else None

    def note_position(self, consume_id: int, column: str) -> None:
        rows = self.spark.read.parquet(self.rows_path).where(F.col(CONSUME) == consume_id)
        kind = rows.schema[column].dataType.simpleString()
        value = rows.agg(F.max(column).cast("string").alias("m")).first()["m"]
        if value is None:
            return
        folder = f"{self.path}/position"
        fs.ensure_dir(self.spark, folder)
        old = fs.list_names(self.spark, folder)
        fs.create_exclusive(self.spark, f"{folder}/p{consume_id:012d}.json",
                            json.dumps({"column": column, "type": kind, "value": value}))
        for name in old:
            if name < f"p{consume_id:012d}":
                fs.delete(self.spark, f"{folder}/{name}")
