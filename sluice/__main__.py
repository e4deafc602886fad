"""Command line: one delivery run.

    python -m sluice --source db.claims --target claims --target-path /lake/claims \
        --key-cols claim_id --capture hwm --mode upsert --hwm-col updated_at

The source is a catalog table or view, or (``--source-path``) a Parquet folder
registered under the ``--source`` name. The target is a native table folder
(``--target-path``) or a JDBC table (``--jdbc-url``).
"""

from __future__ import annotations

import argparse
import json
import sys

from .spec import MODES, STAGINGS, SyncSpec

# What a scheduler reads from the process.
#   0 done or nothing to send    1 failed, nothing published
#   2 invalid options            3 another run published first
#   4 published, but the bookkeeping after it failed
DONE, FAILED, INVALID, OVERTAKEN, UNSAVED = 0, 1, 2, 3, 4


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="sluice", description="keyed change delivery on Spark")
    p.add_argument("--source", required=True, help="source table or view name")
    p.add_argument("--source-path", help="Parquet folder to register as --source")
    p.add_argument("--source-jdbc-url", help="read --source as a table of this JDBC database")
    p.add_argument("--source-partition-col", help="numeric column splitting the JDBC read")
    p.add_argument("--source-partitions", type=int, default=16, help="parallel JDBC readers")
    p.add_argument("--target", required=True, help="target name (native: also its folder name)")
    p.add_argument("--target-path", help="native table folder")
    p.add_argument("--jdbc-url", help="deliver into a JDBC table instead of a native table")
    p.add_argument("--capture", choices=("none", "hwm", "stream"), default="none")
    p.add_argument("--mode", choices=MODES, default="truncate")
    p.add_argument("--key-cols", nargs="*", default=[])
    p.add_argument("--lower-cols", action="store_true")
    p.add_argument("--nan-to-null", action="store_true", help="store float NaN as NULL")
    p.add_argument("--case-insensitive-keys", action="store_true", help="text keys match whatever their case")
    p.add_argument("--hwm-col")
    p.add_argument("--hwm-start")
    p.add_argument("--lookback", help="interval literal, e.g. 'INTERVAL 1 DAY'")
    p.add_argument("--change-log", help="append-only change-log folder (stream)")
    p.add_argument("--outbox", help="outbox folder (stream)")
    p.add_argument("--order-cols", nargs="*", default=[],
                   help="columns of the change log that order the changes of a key")
    p.add_argument("--outbox-retention-days", type=int, default=0)
    p.add_argument("--staging", choices=STAGINGS, default="direct")
    p.add_argument("--stage-path")
    p.add_argument("--keep-files", action="store_true")
    p.add_argument("--batch-rows", type=int)
    p.add_argument("--on-match", choices=("update", "replace"), default="update")
    p.add_argument("--buckets", type=int, default=None,
                   help="buckets of a new native table (default: sized from the first load)")
    p.add_argument("--run-log", help="folder of the run log (one row per run)")
    p.add_argument("--replay-key", help="append mode: replaying this key replaces its earlier rows")
    p.add_argument("--replay-col", help="column of a database target that holds the replay key of appended rows")
    p.add_argument("--max-connections", type=int, default=16, help="connections to a database target at most")
    return p.parse_args(argv)


def spec_from(a: argparse.Namespace) -> SyncSpec:
    return SyncSpec(source=a.source, target=a.target, capture=a.capture, mode=a.mode,
                    keys=list(a.key_cols or []), lower_cols=a.lower_cols, hwm_col=a.hwm_col,
                    hwm_start=a.hwm_start, lookback=a.lookback, change_log=a.change_log,
                    outbox=a.outbox, order_cols=list(a.order_cols), outbox_retention_days=a.outbox_retention_days,
                    staging=a.staging, stage_path=a.stage_path, keep_files=a.keep_files,
                    batch_rows=a.batch_rows, on_match=a.on_match, nan_to_null=a.nan_to_null,
                    case_insensitive_keys=a.case_insensitive_keys)


def main(argv=None, spark=None) -> int:
    a = parse_args(argv)
    spec = spec_from(a)
    found = spec.problems()
    if bool(a.target_path) == bool(a.jdbc_url):
        found.append("give either --target-path or --jdbc-url")
    if a.replay_key and (a.mode != "append" or a.jdbc_url and not a.replay_col):
        found.append("--replay-key: only appends into a native table, or into a database with --replay-col, can be replayed")
    if a.max_connections < 1:
        found.append("--max-connections: at least 1")
    if found:
        print("invalid options: " + "; ".join(found), file=sys.stderr)
        return INVALID
    from pyspark.sql import SparkSession

    from .plans import job
    from .session import configure
    from .sinks.jdbc import JdbcSink
    from .sinks.native import ConcurrentPublish, NativeTable

    spark = spark or SparkSession.builder.appName("sluice").getOrCreate()
    configure(spark)
    if a.source_path:
        spark.read.parquet(a.source_path).createOrReplaceTempView(a.source)
    if a.source_jdbc_url:
        from .sources.jdbc_source import read_jdbc_table
        source = read_jdbc_table(spark, a.source_jdbc_url, a.source, a.source_partition_col,
                                 a.source_partitions)
    else:
        source = spark.table(a.source)
    if a.jdbc_url:
        sink = JdbcSink(spark, a.jdbc_url, a.target, keys=spec.keys,
                        batch_rows=a.batch_rows or 10_000, max_connections=a.max_connections, replay_col=a.replay_col)
    else:
        sink = NativeTable(spark, a.target_path, keys=[k.lower() for k in spec.keys] if spec.lower_cols
                           else spec.keys, buckets=a.buckets, case_insensitive=a.case_insensitive_keys)
    try:
        summary = job.run(spark, spec, source, sink, run_log=a.run_log, replay_key=a.replay_key)
    except ConcurrentPublish as e:
        print(json.dumps({"status": job.CONFLICT, "message": str(e)}))
        return OVERTAKEN
    except job.BookkeepingFailed as e:
        print(json.dumps({"status": job.UNSAVED, "message": str(e)}))
        return UNSAVED
    except Exception as e:  # the run log holds the failure row
        print(json.dumps({"status": job.FAILED, "message": f"{type(e).__name__}: {e}"}))
        return FAILED
    print(json.dumps(summary, default=str))
    return DONE


if __name__ == "__main__":
    sys.exit(main())
