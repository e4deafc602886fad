"""Run lifecycle: validate → plan → materialise → guard → publish{data, progress} → log.

The rows to send are read from the source once and written to the shared
folder; the key check and the publish read that copy. The sink commits rows and
progress together (native manifest or one JDBC transaction), so a failed run
leaves both unchanged and simply repeating it is safe. What follows the commit
(the outbox ledger, the purge) is only bookkeeping that the next run completes;
if it fails, the run says so and does not claim that nothing was published.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fs
from ..operators.keys import check_keys
from ..session import work_path
from ..sinks import staging
from ..sinks.native import ConcurrentPublish, NativeTable
from ..spec import SyncSpec
from ..streaming.consume import consume_to_outbox
from ..streaming.outbox import OutboxStore
from . import planner

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("capture", T.StringType()),
    T.StructField("staging", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("rows_written", T.LongType()),
    T.StructField("rows_deleted", T.LongType()),
    T.StructField("rows_consumed", T.LongType()),
    T.StructField("consumes_purged", T.LongType()),
    T.StructField("version", T.LongType()),
    T.StructField("seconds", T.DoubleType()),
    T.StructField("message", T.StringType()),
    T.StructField("finished_at", T.TimestampNTZType()),
])

#: What a run can end as. ``unsaved``: the target is committed, the bookkeeping
#: after it failed; the next run completes it.
OK, NO_CHANGES, FAILED, CONFLICT, UNSAVED = "ok", "no_changes", "failed", "conflict", "unsaved"


class BookkeepingFailed(RuntimeError):
    """The target was committed; what should have followed was not done."""


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def _log(spark: SparkSession, path: str | None, row: dict) -> None:
    if path:
        spark.createDataFrame([row], RUN_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark: SparkSession, spec: SyncSpec, source: DataFrame, sink,
        run_log: str | None = None, change_log_schema: T.StructType | None = None,
        check_key_quality: bool = True, now=None, replay_key: str | None = None) -> dict:
    """One delivery run; returns its summary row (also appended to ``run_log``).

    ``replay_key`` (e.g. a scheduler's logical date) makes an append run
    idempotent: replaying the same key replaces the rows that key appended
    before instead of adding them again. A database target needs a column for it."""
    spec.checked()
    if replay_key and (spec.mode != "append" or not getattr(sink, "replays", True)):
        raise ValueError("replay_key: only appends into a native table, or with a replay_col, can be replayed")
    if spec.case_insensitive_keys and isinstance(sink, NativeTable) and not sink.case_insensitive:
        raise ValueError("case_insensitive_keys: the target table tells keys apart by case")
    started, run_id = time.time(), uuid.uuid4().hex
    summary = {"run_id": run_id, "source": spec.source, "target": spec.target,
               "capture": spec.capture, "staging": spec.staging, "mode": spec.mode,
               "rows_written": 0, "rows_deleted": 0, "rows_consumed": 0, "consumes_purged": 0,
               "version": None, "status": FAILED, "message": ""}
    copy = f"{(spec.stage_path or work_path(spark, 'stage')).rstrip('/')}/{run_id}"
    try:
        base = sink.version()
        store = OutboxStore(spark, spec.outbox) if spec.capture == "stream" else None
        plan = _plan(spark, spec, source, sink, store, change_log_schema, summary)
        if plan is None:
            summary.update(status=NO_CHANGES, version=base)
            return summary
        keys = [k.lower() for k in spec.keys] if spec.lower_cols else list(spec.keys)
        fmt = "csv" if spec.staging == "csv" else "parquet"
        counts: dict[str, int] = {}
        upserts, deletes = staging.stage_round_trip(spark, plan.upserts, plan.deletes, fmt, copy, "",
                                                    keys=keys if spec.staging != "direct" else (), counts=counts)
        if fmt == "csv":   # parsed once; all that follows reads typed files
            upserts, deletes = staging.typed_copy(spark, upserts, deletes, f"{copy}/typed")
        if keys and check_key_quality:
            check_keys(upserts, keys, case_insensitive=spec.case_insensitive_keys)
        # Consumes below the oldest one still in the outbox can never be pending again.
        floor = {"ack_floor": min(store.consume_ids())} if store else {}
        summary["version"] = sink.publish(
            upserts=upserts, deletes=deletes, truncate=plan.empties_target,
            append=spec.mode == "append", on_match=spec.on_match, state=plan.progress,
            ack=plan.consumes, expected_version=base, run={"summary": plan.why}, **floor,
            **({"replay_key": replay_key} if replay_key else {}),
            **({"stored_bytes": fs.size(spark, f"{copy}/typed" if fmt == "csv" else copy)} if isinstance(sink, NativeTable) else {}))
        summary.update(status=UNSAVED, message=plan.why)  # until the bookkeeping is done
        # Counted while the rows were written; no further pass.
        summary["rows_written"], summary["rows_deleted"] = counts["upsert"], counts.get("delete", 0)
        if not spec.keep_files:
            fs.delete(spark, copy)
        if store:
            store.acknowledge(plan.consumes, spec.target)
            summary["consumes_purged"] = len(store.purge(now or _now(), spec.outbox_retention_days))
            store.compact_ledger()
        summary["status"] = OK
        return summary
    except ConcurrentPublish as e:
        summary.update(status=CONFLICT, message=str(e)[:2000])
        raise
    except Exception as e:
        summary["message"] = f"{type(e).__name__}: {e}"[:2000]
        if summary["status"] == UNSAVED:
            raise BookkeepingFailed(summary["message"]) from e
        raise
    finally:
        summary["seconds"] = round(time.time() - started, 3)
        summary["finished_at"] = _now()
        _log(spark, run_log, summary)


def _plan(spark: SparkSession, spec: SyncSpec, source: DataFrame, sink, store: OutboxStore | None,
          schema: T.StructType | None, summary: dict) -> planner.Delivery | None:
    if spec.capture == "none":
        return planner.plan_full(source, spec)
    if spec.capture == "hwm":
        return planner.plan_hwm(source, spec, sink.state())
    store.register(spec.target)
    # Consumes that the target holds but the ledger lost in a crash are completed first.
    store.acknowledge(sorted(set(sink.acked()) - store.acked_ids(spec.target)), spec.target)
    new_ids = consume_to_outbox(spark, spec.change_log, schema or source.schema, store,
                                commit_col=spec.order_cols[0] if spec.order_cols else None)
    if new_ids:   # row counts of the new partitions come from Parquet footers
        summary["rows_consumed"] = store.rows().where(F.col("consume_id").isin(new_ids)).count()
    window, ids = store.pending_window(spec.target)
    return None if window is None else planner.plan_pending(window, ids, spec)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(path).orderBy(F.col("finished_at"))
