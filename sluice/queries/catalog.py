"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads whole given tables (or data Spark derives from them); the
matching DuckDB SQL lives in ``oracle.py`` under the same name, with the same
column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import lower_cols, nan_to_null
from ..operators import keys as K
from ..operators import merge as M
from ..operators import reconcile as R
from ..operators.netchange import CONSUME, net_change, net_delete_keys, split_actions
from ..operators.order import key_order
from ..plans.planner import hwm_rows
from ..sources import scan
from ..sources.scan import Watermark, define_view, hwm_ceiling
from ..sources.snapshot import changes_between, snapshot_diff
from ..sources.tables import read_table
from ..streaming import outbox as ob
from . import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
ORDER_KEY = ["o_orderkey"]
TS = "timestamp_ntz"


def _start() -> Watermark:
    return Watermark(TS, fx.HWM_START)


# ---------------------------------------------------------------- scans

def full_load(spark, sf):
    return key_order(fx.orders(spark, sf), ORDER_KEY)


def view_load(spark, sf):
    read_table(spark, sf, "customer").createOrReplaceTempView("customer_src")
    return define_view(spark, "customer_upper_v",
                       "SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, c_acctbal, "
                       "c_mktsegment FROM customer_src")


def hwm_first_run(spark, sf):
    return hwm_rows(fx.orders(spark, sf), "o_orderdate", None)


def hwm_window(spark, sf):
    return hwm_rows(fx.orders(spark, sf), "o_orderdate", _start())


def hwm_null_excluded(spark, sf):
    return hwm_rows(fx.orders_null_hwm(spark, sf), "o_orderdate", None)


def hwm_ceiling_q(spark, sf):
    src = fx.orders(spark, sf)
    c = hwm_ceiling(src, "o_orderdate", _start())
    return (src.where((F.col("o_orderdate") > _start().lit()) & (F.col("o_orderdate") <= c.lit()))
            .agg(F.max("o_orderdate").alias("ceiling"), F.count(F.lit(1)).alias("window_rows")))


def hwm_no_changes(spark, sf):
    src = fx.orders(spark, sf)
    top = hwm_ceiling(src, "o_orderdate")
    return hwm_rows(src, "o_orderdate", top)


def hwm_lookback(spark, sf):
    return hwm_rows(fx.orders(spark, sf), "o_orderdate", _start(),
                    lookback=f"INTERVAL {fx.LOOKBACK_DAYS} DAYS")


def hwm_upsert(spark, sf):
    target = fx.orders_stale_target(spark, sf)
    window = hwm_rows(fx.orders(spark, sf), "o_orderdate", _start())
    return M.upsert(target, window, ORDER_KEY)


def hwm_missed_deletes(spark, sf):
    target = fx.orders(spark, sf)                      # loaded before the archive
    source = fx.orders_new(spark, sf)                  # archived rows deleted since
    return R.orphan_keys(target, source, ORDER_KEY)


def row_count_and_latest(spark, sf):
    return scan.row_count_and_latest(fx.orders(spark, sf), "o_orderdate")


def changed_recently(spark, sf):
    e = read_table(spark, sf, "events")
    since = fx.ts(fx.NOW) - F.expr("INTERVAL 30 MINUTES")
    return scan.changed_since(e, "ts", since)


# ---------------------------------------------------------------- feeds

def snapshot_diff_q(spark, sf):
    return snapshot_diff(fx.orders_old(spark, sf), fx.orders_new(spark, sf), ORDER_KEY)


def snapshot_diff_bucketed(spark, sf):
    return snapshot_diff(fx.orders_old(spark, sf), fx.orders_new(spark, sf), ORDER_KEY,
                         partitions=64)


def changes_between_q(spark, sf):
    return changes_between(fx.events_feed(spark, sf), "ts", "2024-01-10 00:00:00",
                           "2024-01-17 00:00:00")


def change_feed(spark, sf):
    return fx.events_feed(spark, sf)


def net_change_q(spark, sf):
    return net_change(fx.events_feed(spark, sf), ["user_id"])


def net_change_window(spark, sf):
    return net_change(fx.events_feed(spark, sf), ["user_id"], method="window")


def net_change_ordered(spark, sf):
    return net_change(fx.events_log(spark, sf), ["user_id"], order_cols=["event_id"])


def net_upserts(spark, sf):
    return split_actions(net_change(fx.events_feed(spark, sf), ["user_id"]), ["user_id"])[0]


def net_deletes(spark, sf):
    return net_delete_keys(fx.events_feed(spark, sf), ["user_id"])


def _snapshot_net(spark, sf):
    feed = snapshot_diff(fx.orders_old(spark, sf), fx.orders_new(spark, sf), ORDER_KEY)
    return net_change(feed.withColumn(CONSUME, F.lit(1).cast("long")), ORDER_KEY)


def apply_changes(spark, sf):
    return M.apply_net_change(fx.orders_old(spark, sf), _snapshot_net(spark, sf), ORDER_KEY)


def rekey(spark, sf):
    old = fx.orders_old(spark, sf).withColumn("_row_id", F.col("o_orderkey"))
    new = fx.orders_new(spark, sf, row_id=True)
    feed = snapshot_diff(old, new, ["_row_id"]).drop("_row_id")
    return net_change(feed.withColumn(CONSUME, F.lit(1).cast("long")), ORDER_KEY).drop(CONSUME)


# ---------------------------------------------------------------- outbox

def _outbox(spark, sf):
    return fx.events_outbox(spark, sf), fx.events_ledger(spark, sf)


def outbox_cutoff(spark, sf):
    rows, ledger = _outbox(spark, sf)
    return ob.cutoff(ob.pending(rows, ledger, fx.TARGET_NAME))


def outbox_pending(spark, sf):
    rows, ledger = _outbox(spark, sf)
    pend = ob.pending(rows, ledger, fx.TARGET_NAME)
    cut = ob.cutoff_value(pend)
    return ob.up_to(pend, cut)


def outbox_pending_count(spark, sf):
    rows, ledger = _outbox(spark, sf)
    return ob.pending_count(rows, ledger, fx.TARGET_NAME)


def outbox_acked(spark, sf):
    rows, ledger = _outbox(spark, sf)
    pend = ob.pending(rows, ledger, fx.TARGET_NAME)
    window = ob.up_to(pend, ob.cutoff_value(pend))
    return ledger.unionByName(ob.ack_rows(window, fx.TARGET_NAME, fx.NOW))


def outbox_purged(spark, sf):
    rows, ledger = _outbox(spark, sf)
    return ob.purge(rows, ledger, fx.TARGET_NAME, fx.NOW, fx.RETENTION_DAYS)


def outbox_history(spark, sf):
    rows, ledger = _outbox(spark, sf)
    return ob.history(rows, ledger, fx.TARGET_NAME)


def outbox_net_change(spark, sf):
    rows, ledger = _outbox(spark, sf)
    pend = ob.pending(rows, ledger, fx.TARGET_NAME)
    return net_change(ob.up_to(pend, ob.cutoff_value(pend)), ["user_id"])


# ---------------------------------------------------------------- writes

def append_load(spark, sf):
    o = fx.orders(spark, sf)
    target = o.where(F.col("o_orderdate") < fx.ts(fx.HWM_START))
    rows = o.where(~(F.col("o_orderdate") < fx.ts(fx.HWM_START)))
    once = M.append(target, rows, run_id="run-2")
    replayed = M.append(once, rows, run_id="run-2")   # a retried run replaces its rows
    return replayed.drop("_run_id")


def truncate_load(spark, sf):
    part = read_table(spark, sf, "part")
    stale = part.where(F.col("p_size") < 10).withColumn("p_name", F.lit("stale"))
    return M.truncate_load(stale, part)


def upsert_keep_extra(spark, sf):
    target = fx.orders_stale_target(spark, sf, note=True)
    window = hwm_rows(fx.orders(spark, sf), "o_orderdate", _start())
    return M.upsert(target, window, ORDER_KEY, on_match="update")


def upsert_replace(spark, sf):
    target = fx.orders_stale_target(spark, sf, note=True)
    window = hwm_rows(fx.orders(spark, sf), "o_orderdate", _start())
    return M.upsert(target, window, ORDER_KEY, on_match="replace")


def delete_by_key(spark, sf):
    o = fx.orders(spark, sf)
    gone = o.where((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < fx.ts(fx.ARCHIVE_BEFORE)))
    return M.delete_by_key(o, gone.select(*ORDER_KEY), ORDER_KEY)


# ---------------------------------------------------------------- key checks

def duplicate_keys(spark, sf):
    return K.duplicate_keys(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def key_problems(spark, sf):
    """The pre-write guard's single aggregation: NULL and duplicate keys."""
    return K.key_problems(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def _merged_customer_names(spark, sf):
    c = read_table(spark, sf, "customer")
    second = c.where((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") < 0))
    return c.select("c_name").unionByName(second.select(F.upper("c_name").alias("c_name")))


def case_colliding_keys(spark, sf):
    return K.case_colliding_keys(_merged_customer_names(spark, sf), "c_name")


def null_keys(spark, sf):
    return K.null_keys(fx.orders_null_hwm(spark, sf), ["o_orderkey", "o_orderdate"])


# ---------------------------------------------------------------- reconciliation

def _order_metrics(df):
    return R.metrics(df.withColumn("is_urgent", F.col("o_orderpriority") == "1-URGENT"),
                     key="o_orderkey", money=["o_totalprice"],
                     text=["o_orderstatus", "o_orderpriority"], flags=["is_urgent"],
                     dates=["o_orderdate"], nullable=["o_orderdate"])


def reconcile_metrics(spark, sf):
    return _order_metrics(fx.orders(spark, sf))


def status_counts(spark, sf):
    return R.group_counts(fx.orders(spark, sf), "o_orderstatus")


def reconcile_compare(spark, sf):
    # Target delivered by hwm only (misses the archive deletes) vs the new source.
    source = fx.orders_new(spark, sf)
    target = M.upsert(fx.orders_old(spark, sf),
                      hwm_rows(source, "o_orderdate", _start()), ORDER_KEY)
    return R.compare_metrics(_order_metrics(source), _order_metrics(target))


def left_diff(spark, sf):
    return R.left_diff(fx.orders_old(spark, sf), fx.orders_new(spark, sf), ORDER_KEY)


def left_diff_null_safe(spark, sf):
    a = fx.orders_null_hwm(spark, sf)
    return R.left_diff(a, fx.orders(spark, sf), ORDER_KEY, null_safe=True)


def column_diff(spark, sf):
    return R.column_diff(fx.orders_old(spark, sf), fx.orders_new(spark, sf), ORDER_KEY)


def row_diff(spark, sf):
    return R.row_diff(fx.orders_old(spark, sf), fx.orders_new(spark, sf))


def row_diff_counts(spark, sf):
    # Whole lines against a table that lacks the returned ones ('R') and holds
    # the accepted ones ('A') twice.
    a = read_table(spark, sf, "lineitem")
    b = a.where("l_returnflag <> 'R'")
    return R.row_diff_counts(a, b.unionAll(a.where("l_returnflag = 'A'")))


# ---------------------------------------------------------------- normalisation (B1, B2)

def lower_cols_q(spark, sf):
    o = fx.orders(spark, sf)
    upper = o.select(*[F.col(c).alias(c.upper()) for c in o.columns])
    return lower_cols(upper)


def nan_to_null_q(spark, sf):
    e = read_table(spark, sf, "events")
    e = e.withColumn("value", F.when(F.col("event_type") == "error", F.lit(float("nan")))
                     .otherwise(F.col("value")))
    return nan_to_null(e)


QUERIES: dict[str, Query] = {
    "full_load": full_load,
    "view_load": view_load,
    "hwm_first_run": hwm_first_run,
    "hwm_window": hwm_window,
    "hwm_null_excluded": hwm_null_excluded,
    "hwm_ceiling": hwm_ceiling_q,
    "hwm_no_changes": hwm_no_changes,
    "hwm_lookback": hwm_lookback,
    "hwm_upsert": hwm_upsert,
    "hwm_missed_deletes": hwm_missed_deletes,
    "row_count_and_latest": row_count_and_latest,
    "changed_recently": changed_recently,
    "snapshot_diff": snapshot_diff_q,
    "snapshot_diff_bucketed": snapshot_diff_bucketed,
    "changes_between": changes_between_q,
    "change_feed": change_feed,
    "net_change": net_change_q,
    "net_change_window": net_change_window,
    "net_change_ordered": net_change_ordered,
    "net_upserts": net_upserts,
    "net_deletes": net_deletes,
    "apply_changes": apply_changes,
    "rekey": rekey,
    "outbox_cutoff": outbox_cutoff,
    "outbox_pending": outbox_pending,
    "outbox_pending_count": outbox_pending_count,
    "outbox_acked": outbox_acked,
    "outbox_purged": outbox_purged,
    "outbox_history": outbox_history,
    "outbox_net_change": outbox_net_change,
    "append_load": append_load,
    "truncate_load": truncate_load,
    "upsert_keep_extra": upsert_keep_extra,
    "upsert_replace": upsert_replace,
    "delete_by_key": delete_by_key,
    "duplicate_keys": duplicate_keys,
    "key_problems": key_problems,
    "case_colliding_keys": case_colliding_keys,
    "null_keys": null_keys,
    "reconcile_metrics": reconcile_metrics,
    "status_counts": status_counts,
    "reconcile_compare": reconcile_compare,
    "left_diff": left_diff,
    "left_diff_null_safe": left_diff_null_safe,
    "column_diff": column_diff,
    "row_diff": row_diff,
    "row_diff_counts": row_diff_counts,
    "lower_cols": lower_cols_q,
    "nan_to_null": nan_to_null_q,
}
