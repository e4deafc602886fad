"""Scenario inputs derived from the given tables, in Spark and in SQL.

Each derivation exists twice — as DataFrame code used by the registered
queries and as a DuckDB SQL fragment used by the oracle — and both read the
whole table. Changes are derived from the rows' own attributes (dates,
statuses, priorities), never from id subsets.

Fixed scenario values (shared by both forms):
  HWM_START      saved watermark of the incremental runs: 1998-01-01 00:00:00
  STALE_UNTIL    the stale target holds orders before 1999-01-01 00:00:00
  LOOKBACK       widening of the lower bound: 30 days
  SNAP_NEW_FROM  orders from 2001-01-01 exist only in the new snapshot
  ARCHIVE_BEFORE fulfilled ('F') orders before 1995-07-01 are deleted
  UPDATE         '1-URGENT' open ('O') orders become fulfilled ('F')
  REKEY          '2-HIGH' orders of 1997 get key + 1,000,000,000,000
  NULL_HWM       '3-MEDIUM' orders have no order date in the null source
  NOW            reference time of the outbox scenario: 2024-01-25 00:00:00
  ACKED_UNTIL    consumes loaded up to 2024-01-20 00:00:00 were delivered
  RETENTION      delivered consumes are kept 3 days
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.netchange import ACTION, CONSUME, LOADED_AT
from ..sources.changelog import feed_per_consume
from ..sources.tables import read_table

HWM_START = "1998-01-01 00:00:00"
STALE_UNTIL = "1999-01-01 00:00:00"
LOOKBACK_DAYS = 30
SNAP_NEW_FROM = "2001-01-01 00:00:00"
ARCHIVE_BEFORE = "1995-07-01 00:00:00"
REKEY_OFFSET = 1_000_000_000_000
NOW = "2024-01-25 00:00:00"
ACKED_UNTIL = "2024-01-20 00:00:00"
RETENTION_DAYS = 3
TARGET_NAME = "user_state"

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
              "o_orderpriority"]
EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


# --------------------------------------------------------------------------
# orders snapshots


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "orders")


def orders_old(spark: SparkSession, sf: str) -> DataFrame:
    return orders(spark, sf).where(~(F.col("o_orderdate") >= ts(SNAP_NEW_FROM)))


def _archived():
    return (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < ts(ARCHIVE_BEFORE))


def orders_new(spark: SparkSession, sf: str, row_id: bool = False) -> DataFrame:
    o = orders(spark, sf).where(~_archived())
    upd = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O")
    rekey = (F.col("o_orderpriority") == "2-HIGH") & (F.year("o_orderdate") == 1997)
    cols = [F.when(rekey, F.col("o_orderkey") + REKEY_OFFSET).otherwise(F.col("o_orderkey"))
            .alias("o_orderkey"),
            "o_custkey",
            F.when(upd, F.lit("F")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
            "o_totalprice", "o_orderdate", "o_orderpriority"]
    if row_id:
        cols.append(F.col("o_orderkey").alias("_row_id"))
    return o.select(*cols)


def orders_null_hwm(spark: SparkSession, sf: str) -> DataFrame:
    o = orders(spark, sf)
    return o.withColumn("o_orderdate", F.when(F.col("o_orderpriority") == "3-MEDIUM", None)
                        .otherwise(F.col("o_orderdate")))


def orders_stale_target(spark: SparkSession, sf: str, note: bool = False) -> DataFrame:
    o = orders(spark, sf).where(F.col("o_orderdate") < ts(STALE_UNTIL))
    o = o.withColumn("o_orderstatus", F.when(F.col("o_orderdate") > ts(HWM_START), F.lit("STALE"))
                     .otherwise(F.col("o_orderstatus")))
    if note:
        o = o.withColumn("o_note", F.concat(F.lit("note-"), F.col("o_orderpriority")))
    return o


# --------------------------------------------------------------------------
# events change log and outbox


def events_log(spark: SparkSession, sf: str) -> DataFrame:
    """Raw ordered log: an 'error' event deletes the user's row, any other
    event writes it; the consume is the event's day."""
    e = read_table(spark, sf, "events")
    return e.select(*EVENT_COLS,
                    F.when(F.col("event_type") == "error", "DELETE").otherwise("INSERT").alias(ACTION),
                    F.unix_date(F.to_date("ts")).cast("long").alias(CONSUME))


def events_feed(spark: SparkSession, sf: str) -> DataFrame:
    return feed_per_consume(events_log(spark, sf), ["user_id"], "event_id")


def loaded_at(consume_col: str = CONSUME):
    return F.date_from_unix_date((F.col(consume_col) + 1).cast("int")).cast("timestamp_ntz")


def events_outbox(spark: SparkSession, sf: str) -> DataFrame:
    """Outbox as of NOW: feed rows + load time (end of the consume's day)."""
    f = events_feed(spark, sf).withColumn(LOADED_AT, loaded_at())
    return f.where(F.col(LOADED_AT) <= ts(NOW))


def events_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Delivery ledger before this run: (target, consume_id, acked_at)."""
    ob = events_outbox(spark, sf)
    return (ob.where(F.col(LOADED_AT) <= ts(ACKED_UNTIL))
            .select(CONSUME, LOADED_AT).distinct()
            .select(F.lit(TARGET_NAME).alias("target"), CONSUME,
                    (F.col(LOADED_AT) + F.expr("INTERVAL 1 HOUR")).alias("acked_at")))


# --------------------------------------------------------------------------
# SQL forms of the same derivations (DuckDB), as CTE bodies.

SQL = {
    "orders_old": f"SELECT * FROM orders WHERE NOT (o_orderdate >= TIMESTAMP '{SNAP_NEW_FROM}')",
    "orders_new": f"""
        SELECT CASE WHEN o_orderpriority = '2-HIGH' AND year(o_orderdate) = 1997
                    THEN o_orderkey + {REKEY_OFFSET} ELSE o_orderkey END AS o_orderkey,
               o_custkey,
               CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN 'F'
                    ELSE o_orderstatus END AS o_orderstatus,
               o_totalprice, o_orderdate, o_orderpriority,
               o_orderkey AS _row_id
        FROM orders
        WHERE NOT (o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '{ARCHIVE_BEFORE}')""",
    "orders_null_hwm": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE o_orderdate END AS o_orderdate,
               o_orderpriority
        FROM orders""",
    "orders_stale": f"""
        SELECT o_orderkey, o_custkey,
               CASE WHEN o_orderdate > TIMESTAMP '{HWM_START}' THEN 'STALE' ELSE o_orderstatus END
                 AS o_orderstatus,
               o_totalprice, o_orderdate, o_orderpriority,
               'note-' || o_orderpriority AS o_note
        FROM orders WHERE o_orderdate < TIMESTAMP '{STALE_UNTIL}'""",
    "events_log": """
        SELECT event_id, ts, user_id, event_type, value, props,
               CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'INSERT' END AS _cdc_action,
               CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT) AS consume_id
        FROM events""",
    "events_feed": """
        SELECT event_id, ts, user_id, event_type, value, props, _cdc_action, consume_id,
               count(*) OVER (PARTITION BY user_id, consume_id) = 2 AS _cdc_is_update
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id, consume_id, _cdc_action
                                           ORDER BY event_id DESC) AS _rn
              FROM events_log) WHERE _rn = 1""",
    "events_outbox": f"""
        SELECT * FROM (
          SELECT *, CAST(DATE '1970-01-01' + CAST(consume_id + 1 AS INTEGER) AS TIMESTAMP)
                    AS _cdc_loaded_at
          FROM events_feed) WHERE _cdc_loaded_at <= TIMESTAMP '{NOW}'""",
    "events_ledger": f"""
        SELECT DISTINCT '{TARGET_NAME}' AS target, consume_id,
               _cdc_loaded_at + INTERVAL 1 HOUR AS acked_at
        FROM events_outbox WHERE _cdc_loaded_at <= TIMESTAMP '{ACKED_UNTIL}'""",
}


def with_ctes(*names: str) -> str:
    """``WITH`` clause holding the named derivations (dependencies included)."""
    deps = {"events_feed": ["events_log"], "events_outbox": ["events_log", "events_feed"],
            "events_ledger": ["events_log", "events_feed", "events_outbox"]}
    order: list[str] = []
    for n in names:
        for d in deps.get(n, []) + [n]:
            if d not in order:
                order.append(d)
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in order) + "\n"
