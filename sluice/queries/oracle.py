"""DuckDB SQL equivalent of every registered query (same names, same columns).

Tables are the pre-registered views of the given parquet files; scenario
derivations come from ``fixtures.SQL`` so both sides read the same inputs.
"""

from __future__ import annotations

from ..sources.generator import FILLER
from . import fixtures as fx

ORDER_COLS = fx.ORDER_COLS
EVENT_COLS = fx.EVENT_COLS
HWM = f"TIMESTAMP '{fx.HWM_START}'"
NEW_COLS = ", ".join(ORDER_COLS)


def _cols(alias: str, cols) -> str:
    return ", ".join(f"{alias}.{c}" for c in cols)


def _differs(a: str, b: str, cols) -> str:
    return " OR ".join(f"{a}.{c} IS DISTINCT FROM {b}.{c}" for c in cols)


def diff_sql(old: str, new: str, keys, cols) -> str:
    """Feed old → new: INSERT / DELETE / flagged update pairs."""
    on = " AND ".join(f"o.{k} = n.{k}" for k in keys)
    vals = [c for c in cols if c not in keys]
    return f"""
      SELECT {_cols('n', cols)}, 'INSERT' AS _cdc_action, false AS _cdc_is_update
        FROM {new} n WHERE NOT EXISTS (SELECT 1 FROM {old} o WHERE {on})
      UNION ALL
      SELECT {_cols('o', cols)}, 'DELETE', false
        FROM {old} o WHERE NOT EXISTS (SELECT 1 FROM {new} n WHERE {on})
      UNION ALL
      SELECT {_cols('o', cols)}, 'DELETE', true
        FROM {old} o JOIN {new} n ON {on} WHERE {_differs('o', 'n', vals)}
      UNION ALL
      SELECT {_cols('n', cols)}, 'INSERT', true
        FROM {old} o JOIN {new} n ON {on} WHERE {_differs('o', 'n', vals)}"""


def net_sql(feed: str, keys, cols, order: str = "") -> str:
    """E1 as row_number = 1: latest consume, then INSERT before DELETE."""
    part = ", ".join(keys)
    extra = f"{order}, " if order else ""
    return f"""
      SELECT {', '.join(cols)} FROM (
        SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY consume_id DESC, {extra}
               CASE WHEN _cdc_action = 'INSERT' THEN 0 ELSE 1 END) AS _rn
        FROM {feed}) WHERE _rn = 1"""


FEED_COLS = EVENT_COLS + ["_cdc_action", "consume_id", "_cdc_is_update"]
OUTBOX_COLS = FEED_COLS + ["_cdc_loaded_at"]
SNAP = fx.with_ctes("orders_old", "orders_new")
OUTBOX = fx.with_ctes("events_ledger") + """,
  acked AS (SELECT DISTINCT consume_id FROM events_ledger WHERE target = 'user_state'),
  pending AS (SELECT * FROM events_outbox WHERE consume_id NOT IN (SELECT consume_id FROM acked))
"""
STALE = fx.with_ctes("orders_stale")
WINDOW = f"""(SELECT * FROM orders WHERE o_orderdate > {HWM}
              AND o_orderdate <= (SELECT max(o_orderdate) FROM orders WHERE o_orderdate > {HWM}))"""


def _metrics(src: str) -> str:
    return f"""
      SELECT CAST(count(*) AS BIGINT) AS row_count,
             CAST(max(o_orderkey) AS BIGINT) AS max_key,
             CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS sum_cents_o_totalprice,
             CAST(count(o_totalprice) AS BIGINT) AS nonnull_o_totalprice,
             CAST(count_if(o_orderstatus = '') AS BIGINT) AS empty_o_orderstatus,
             CAST(sum(length(o_orderstatus)) AS BIGINT) AS chars_o_orderstatus,
             CAST(count_if(o_orderpriority = '') AS BIGINT) AS empty_o_orderpriority,
             CAST(sum(length(o_orderpriority)) AS BIGINT) AS chars_o_orderpriority,
             CAST(count_if(o_orderdate IS NULL) AS BIGINT) AS nulls_o_orderdate,
             CAST(sum(CAST(o_orderpriority = '1-URGENT' AS INTEGER)) AS BIGINT) AS true_is_urgent,
             CAST(min(floor(epoch(o_orderdate))) AS BIGINT) AS min_o_orderdate,
             CAST(max(floor(epoch(o_orderdate))) AS BIGINT) AS max_o_orderdate
      FROM {src}"""


ORACLE_SQL: dict[str, str] = {
    "full_load": "SELECT * FROM orders",
    "view_load": "SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, c_acctbal, c_mktsegment "
                 "FROM customer",
    "hwm_first_run": "SELECT * FROM orders WHERE o_orderdate <= (SELECT max(o_orderdate) FROM orders)",
    "hwm_window": f"SELECT * FROM {WINDOW}",
    "hwm_null_excluded": fx.with_ctes("orders_null_hwm") + """
        SELECT * FROM orders_null_hwm
        WHERE o_orderdate <= (SELECT max(o_orderdate) FROM orders_null_hwm)""",
    "hwm_ceiling": f"""SELECT max(o_orderdate) AS ceiling, CAST(count(*) AS BIGINT) AS window_rows
                       FROM orders WHERE o_orderdate > {HWM}""",
    "hwm_no_changes": "SELECT * FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders)",
    "hwm_lookback": f"""
        SELECT * FROM orders
        WHERE o_orderdate > {HWM} - INTERVAL {fx.LOOKBACK_DAYS} DAY
          AND o_orderdate <= (SELECT max(o_orderdate) FROM orders WHERE o_orderdate > {HWM})""",
    "hwm_upsert": f"""
        {STALE}
        SELECT {_cols('t', ORDER_COLS)} FROM orders_stale t
          WHERE NOT EXISTS (SELECT 1 FROM {WINDOW} w WHERE w.o_orderkey = t.o_orderkey)
        UNION ALL SELECT * FROM {WINDOW}""",
    "hwm_missed_deletes": SNAP + """
        SELECT o.o_orderkey FROM orders o
        WHERE NOT EXISTS (SELECT 1 FROM orders_new n WHERE n.o_orderkey = o.o_orderkey)""",
    "row_count_and_latest": "SELECT CAST(count(*) AS BIGINT) AS row_count, max(o_orderdate) AS latest "
                            "FROM orders",
    "changed_recently": f"""
        SELECT CAST(count_if(ts >= TIMESTAMP '{fx.NOW}' - INTERVAL 30 MINUTE) AS BIGINT) AS changed,
               CAST(count(*) AS BIGINT) AS row_count FROM events""",
    "snapshot_diff": SNAP + f""", nn AS (SELECT {NEW_COLS} FROM orders_new)
        {diff_sql('orders_old', 'nn', ['o_orderkey'], ORDER_COLS)}""",
    "changes_between": fx.with_ctes("events_feed") + """
        SELECT * FROM events_feed
        WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-17 00:00:00'""",
    "change_feed": fx.with_ctes("events_feed") + "SELECT * FROM events_feed",
    "net_change": fx.with_ctes("events_feed") + net_sql("events_feed", ["user_id"], FEED_COLS),
    "net_change_window": fx.with_ctes("events_feed") + net_sql("events_feed", ["user_id"], FEED_COLS),
    "net_change_ordered": fx.with_ctes("events_log") + net_sql(
        "events_log", ["user_id"], EVENT_COLS + ["_cdc_action", "consume_id"], order="event_id DESC"),
    "net_upserts": fx.with_ctes("events_feed") + f"""
        SELECT {', '.join(EVENT_COLS)} FROM ({net_sql('events_feed', ['user_id'], FEED_COLS)})
        WHERE _cdc_action = 'INSERT'""",
    "net_deletes": fx.with_ctes("events_feed") + f"""
        SELECT user_id FROM ({net_sql('events_feed', ['user_id'], FEED_COLS)})
        WHERE _cdc_action = 'DELETE'""",
    "apply_changes": SNAP + f"SELECT {NEW_COLS} FROM orders_new",
    "rekey": SNAP + f""", oo AS (SELECT *, o_orderkey AS _row_id FROM orders_old),
        feed AS ({diff_sql('oo', 'orders_new', ['_row_id'], ORDER_COLS)}),
        f1 AS (SELECT *, 1 AS consume_id FROM feed)
        {net_sql('f1', ['o_orderkey'], ORDER_COLS + ['_cdc_action', '_cdc_is_update'])}""",
    "outbox_cutoff": OUTBOX + """
        SELECT max(consume_id) AS cutoff, CAST(count(*) AS BIGINT) AS pending_rows FROM pending""",
    "outbox_pending": OUTBOX + "SELECT * FROM pending WHERE consume_id <= (SELECT max(consume_id) FROM pending)",
    "outbox_pending_count": OUTBOX + """
        SELECT CAST(count(*) AS BIGINT) AS pending_rows FROM events_outbox
        WHERE consume_id NOT IN (SELECT consume_id FROM acked)""",
    "outbox_acked": OUTBOX + f"""
        SELECT * FROM events_ledger
        UNION ALL
        SELECT DISTINCT '{fx.TARGET_NAME}' AS target, consume_id, TIMESTAMP '{fx.NOW}' AS acked_at
        FROM pending""",
    "outbox_purged": OUTBOX + f"""
        SELECT * FROM events_outbox
        WHERE NOT (consume_id IN (SELECT consume_id FROM acked)
                   AND _cdc_loaded_at <= TIMESTAMP '{fx.NOW}' - INTERVAL {fx.RETENTION_DAYS} DAY)""",
    "outbox_history": OUTBOX + """
        SELECT consume_id, _cdc_action, CAST(count(*) AS BIGINT) AS n_rows,
               consume_id IN (SELECT consume_id FROM acked) AS delivered
        FROM events_outbox GROUP BY consume_id, _cdc_action""",
    "outbox_net_change": OUTBOX + net_sql("pending", ["user_id"], OUTBOX_COLS),
    "append_load": "SELECT * FROM orders",
    "truncate_load": "SELECT * FROM part",
    "upsert_keep_extra": f"""
        SELECT *, CASE WHEN o_orderdate < TIMESTAMP '{fx.STALE_UNTIL}' THEN 'note-' || o_orderpriority
                  END AS o_note FROM orders""",
    "upsert_replace": f"""
        SELECT *, CASE WHEN o_orderdate <= {HWM} THEN 'note-' || o_orderpriority
                  END AS o_note FROM orders""",
    "delete_by_key": f"""
        SELECT * FROM orders
        WHERE NOT (o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '{fx.ARCHIVE_BEFORE}')""",
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "key_problems": """
        SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n_rows,
               (l_orderkey IS NULL OR l_linenumber IS NULL) AS null_key
        FROM lineitem GROUP BY l_orderkey, l_linenumber
        HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
    "case_colliding_keys": """
        WITH names AS (SELECT c_name FROM customer
                       UNION ALL SELECT upper(c_name) FROM customer
                       WHERE c_mktsegment = 'BUILDING' AND c_acctbal < 0),
             sp AS (SELECT DISTINCT c_name AS k FROM names WHERE c_name IS NOT NULL)
        SELECT lower(k) AS folded_key, CAST(count(*) AS BIGINT) AS n_spellings
        FROM sp GROUP BY lower(k) HAVING count(*) > 1""",
    "null_keys": fx.with_ctes("orders_null_hwm") + """
        SELECT * FROM orders_null_hwm WHERE o_orderkey IS NULL OR o_orderdate IS NULL""",
    "reconcile_metrics": _metrics("orders"),
    "status_counts": "SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n_rows FROM orders "
                     "GROUP BY o_orderstatus",
    "reconcile_compare": SNAP + f""",
        nn AS (SELECT {NEW_COLS} FROM orders_new),
        w AS (SELECT * FROM nn WHERE o_orderdate > {HWM}
              AND o_orderdate <= (SELECT max(o_orderdate) FROM nn WHERE o_orderdate > {HWM})),
        tgt AS (SELECT * FROM orders_old o WHERE NOT EXISTS
                  (SELECT 1 FROM w WHERE w.o_orderkey = o.o_orderkey)
                UNION ALL SELECT * FROM w),
        sm AS ({_metrics('nn')}), tm AS ({_metrics('tgt')}),
        su AS (UNPIVOT sm ON COLUMNS(*) INTO NAME metric VALUE source_value),
        tu AS (UNPIVOT tm ON COLUMNS(*) INTO NAME metric VALUE target_value)
        SELECT coalesce(su.metric, tu.metric) AS metric, su.source_value, tu.target_value,
               su.source_value IS NOT DISTINCT FROM tu.target_value AS matches
        FROM su FULL OUTER JOIN tu ON su.metric = tu.metric""",
    "left_diff": SNAP + f""", nn AS (SELECT {NEW_COLS}, true AS _hit FROM orders_new)
        SELECT {_cols('a', ORDER_COLS)} FROM orders_old a
        LEFT JOIN nn b ON a.o_orderkey = b.o_orderkey
        WHERE b._hit IS NULL OR {' OR '.join(f'coalesce(a.{c} <> b.{c}, false)' for c in ORDER_COLS[1:])}""",
    "left_diff_null_safe": fx.with_ctes("orders_null_hwm") + f"""
        , bb AS (SELECT *, true AS _hit FROM orders)
        SELECT {_cols('a', ORDER_COLS)} FROM orders_null_hwm a
        LEFT JOIN bb b ON a.o_orderkey = b.o_orderkey
        WHERE b._hit IS NULL OR {_differs('a', 'b', ORDER_COLS[1:])}""",
    "row_diff": SNAP + f""", nn AS (SELECT {NEW_COLS} FROM orders_new)
        SELECT *, 'source_only' AS side FROM (SELECT * FROM orders_old EXCEPT ALL SELECT * FROM nn)
        UNION ALL
        SELECT *, 'target_only' AS side FROM (SELECT * FROM nn EXCEPT ALL SELECT * FROM orders_old)""",
    "row_diff_counts": """
        SELECT *, 'source_only' AS side, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem
        WHERE l_returnflag = 'R' GROUP BY ALL
        UNION ALL
        SELECT *, 'target_only' AS side, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem
        WHERE l_returnflag = 'A' GROUP BY ALL""",
    "lower_cols": "SELECT * FROM orders",
    "nan_to_null": """
        SELECT event_id, ts, user_id, event_type,
               CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value, props
        FROM events""",
}


def _claims_sql() -> str:
    k = "o_orderkey"
    status = f"""CASE {k} % 5 WHEN 0 THEN 'SUBMITTED' WHEN 1 THEN 'PENDING' WHEN 2 THEN 'PAID'
                 WHEN 3 THEN 'DENIED' ELSE 'ADJUSTED' END"""
    money = "CAST(({}) / 100 AS DECIMAL(12, 2))".format
    allowed = f"CASE WHEN {k} % 20 < 17 THEN c * 85 // 100 END"
    submitted = f"o_orderdate + to_seconds({k} % 86400)"
    return f"""
      WITH o AS (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders),
           s AS (SELECT *, {status} AS st, {allowed} AS al FROM o)
      SELECT {k} AS claim_id, 10000 + o_custkey AS member_id,
             1 + ({k} * 7919) % 5000 AS provider_id,
             lpad(CAST(({k} * 104729) % 10000000000 AS VARCHAR), 10, '0') AS provider_npi,
             'PLN-' || lpad(CAST(1 + o_custkey % 400 AS VARCHAR), 4, '0') AS plan_code,
             CASE {k} % 4 WHEN 0 THEN 'PREVENTIVE' WHEN 1 THEN 'BASIC' WHEN 2 THEN 'MAJOR'
                  ELSE 'ORTHODONTIC' END AS claim_type,
             'D' || lpad(CAST({k} % 10000 AS VARCHAR), 4, '0') AS procedure_code,
             CASE WHEN {k} % 5 < 2 THEN NULL
                  ELSE lpad(CAST(1 + {k} % 32 AS VARCHAR), 2, '0') END AS tooth_number,
             CASE WHEN {k} % 5 >= 3 THEN NULL
                  ELSE CASE {k} % 5 WHEN 0 THEN 'M' WHEN 1 THEN 'O' WHEN 2 THEN 'D'
                       WHEN 3 THEN 'B' ELSE 'L' END END AS tooth_surface,
             'K' || lpad(CAST({k} % 100000 AS VARCHAR), 5, '0') AS diagnosis_code,
             CAST(o_orderdate AS DATE) AS service_date,
             {submitted} AS submitted_at,
             st AS claim_status,
             {money('c')} AS billed_amount,
             {money('al')} AS allowed_amount,
             {money("CASE WHEN st = 'PAID' THEN coalesce(al, c) * 80 // 100 ELSE 0 END")} AS paid_amount,
             {money('c - coalesce(al, c)')} AS member_resp_amount,
             CASE WHEN st = 'DENIED' THEN 'denied: code ' || lpad(CAST({k} % 97 AS VARCHAR), 2, '0')
                  END AS denial_reason,
             CASE WHEN {k} % 10 < 3 THEN NULL
                  WHEN {k} % 100 < 33 THEN ''
                  WHEN {k} % 100 < 40 THEN 'note "' || CAST({k} AS VARCHAR) || '", with, commas'
                  ELSE rpad('note ' || CAST({k} AS VARCHAR), CAST(1 + {k} * 37 % 400 AS INTEGER), '{FILLER}') END AS payer_note,
             {k} % 20 = 0 AS is_emergency,
             {submitted} AS updated_at
      FROM s"""


ORACLE_SQL.update({
    "csv_round_trip": "SELECT * FROM documents",
    "csv_round_trip_pages": "SELECT * FROM pages",
    "csv_round_trip_conversations": "SELECT * FROM conversations",
    "csv_codecs": """
        SELECT event_id, ts, value, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount,
               upper(hex(props)) AS props_hex, event_type = 'error' AS is_error,
               CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'click' THEN ''
                    ELSE '  ' || props || chr(10) END AS note,
               strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day,
               user_id + event_id AS ids_sum
        FROM events""",
    "positional_csv": "SELECT *, true AS from_a_csv_file FROM orders",
    "positional_csv_header": "SELECT * FROM customer",
    "stream_multi_commit": fx.with_ctes("events_log") + f"""
        SELECT {', '.join(EVENT_COLS)} FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS _rn FROM events_log)
        WHERE _rn = 1 AND _cdc_action = 'INSERT'""",
    "outbox_two_targets": SNAP + f"SELECT {NEW_COLS} FROM orders_new",
    "cdc_columns": fx.with_ctes("events_feed") + f"""
        SELECT {', '.join(EVENT_COLS)}, _cdc_action, _cdc_is_update, TIMESTAMP '{fx.NOW}' AS _cdc_loaded_at,
               CAST(7 AS BIGINT) AS consume_id FROM events_feed""",
    "upsert_typed": """
        SELECT o_orderkey, o_orderstatus,
               CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DECIMAL(18, 2)) AS cents FROM orders""",
    "truncate_filled": SNAP + f"SELECT {NEW_COLS} FROM orders_new",
    "append_replayed": SNAP + f"SELECT * FROM orders_old UNION ALL SELECT {NEW_COLS} FROM orders_new",
    "parquet_staging": "SELECT * FROM conversations",
    "hwm_job": "SELECT * FROM orders",
    "stream_job": SNAP + f"SELECT {NEW_COLS} FROM orders_new",
    "stream_consume": fx.with_ctes("events_feed") + f"""
        SELECT {', '.join(EVENT_COLS)}, _cdc_action, consume_id AS _cdc_commit_day, _cdc_is_update
        FROM events_feed""",
    "jdbc_upsert": ORACLE_SQL["upsert_keep_extra"],
    "claims_generator": _claims_sql(),
})

ORACLE_SQL.update({
    "exclude_replace": "SELECT event_id, ts, user_id, upper(event_type) AS event_type, value FROM events",
    "semi_structured": """
        SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
               CAST(json(props) AS VARCHAR) AS props_json FROM events""",
    "zoned_timestamp": """
        SELECT event_id, ts AS ts_utc, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || 'Z' AS ts_text
        FROM events""",
    "staged_delete": ORACLE_SQL["delete_by_key"],
    "snapshot_diff_bucketed": ORACLE_SQL["snapshot_diff"],
    "jdbc_stream_job": ORACLE_SQL["stream_job"],
    "composite_key_upsert": "SELECT * FROM conversations",
    "jdbc_source_hwm": ORACLE_SQL["hwm_window"],
    "table_changes": fx.with_ctes("orders_old") + diff_sql("orders_old", "orders", ["o_orderkey"], ORDER_COLS),
    "run_log": fx.with_ctes("orders_old") + f"""
        SELECT 'none' AS capture, 'truncate' AS mode, 'ok' AS status,
               CAST(count(*) AS BIGINT) AS rows_written, CAST(0 AS BIGINT) AS rows_deleted
        FROM orders_old
        UNION ALL
        SELECT 'hwm', 'upsert', 'ok', CAST(count(*) AS BIGINT), CAST(0 AS BIGINT)
        FROM orders WHERE o_orderdate > {HWM}
        UNION ALL
        SELECT 'hwm', 'upsert', 'no_changes', CAST(0 AS BIGINT), CAST(0 AS BIGINT)""",
})

LINE_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
ORACLE_SQL["dense_ids"] = f"""
    SELECT {LINE_ORDER}, l_shipdate, CAST(row_number() OVER (ORDER BY {LINE_ORDER}) AS BIGINT) AS line_id
    FROM lineitem"""

ORACLE_SQL["stream_equal_times"] = ORACLE_SQL["stream_multi_commit"]
ORACLE_SQL["feed_pending"] = fx.with_ctes("events_log") + f"""
    SELECT * EXCLUDE (consume_id), 'before the first consume' AS looked FROM events_log WHERE ts < TIMESTAMP '{fx.NOW}'
    UNION ALL
    SELECT * EXCLUDE (consume_id), 'after the second commit' FROM events_log WHERE NOT (ts < TIMESTAMP '{fx.NOW}')"""

ORACLE_SQL.update({
    "column_diff": SNAP + """, j AS (
        SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, o.o_orderkey IS NULL AS no_o, n.o_orderkey IS NULL AS no_n,
               o.o_orderstatus AS os, n.o_orderstatus AS ns
        FROM orders_old o FULL JOIN orders_new n ON o.o_orderkey = n.o_orderkey)
        SELECT o_orderkey, CASE WHEN NOT no_o AND NOT no_n THEN 'o_orderstatus' END AS column,
               CASE WHEN NOT no_o AND NOT no_n THEN os END AS source_value,
               CASE WHEN NOT no_o AND NOT no_n THEN ns END AS target_value,
               CASE WHEN no_n THEN 'source_only' WHEN no_o THEN 'target_only' ELSE 'changed' END AS status
        FROM j WHERE no_o OR no_n OR os IS DISTINCT FROM ns""",
    "typed_rejects": """
        WITH e AS (SELECT *, CAST(round(value * 1000) AS BIGINT) AS milli FROM events),
        t AS (
          SELECT CAST(event_id AS VARCHAR) AS event_id,
                 CASE WHEN event_type = 'error' THEN 'yesterday' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts,
                 CASE WHEN user_id % 10 <> 3 THEN CAST(user_id AS VARCHAR) END AS user_id,
                 CAST(milli // 1000 AS VARCHAR) || '.' || lpad(CAST(milli % 1000 AS VARCHAR), 3, '0') AS amount,
                 CASE WHEN event_type = 'view' THEN 'n/a' ELSE '7' END AS count, milli % 10 = 0 AS fits
          FROM e),
        r AS (
          SELECT *, concat_ws('; ', CASE WHEN ts = 'yesterday' THEN 'ts: yesterday is no timestamp_ntz' END,
                 CASE WHEN user_id IS NULL THEN 'user_id: NULL is not allowed' END,
                 CASE WHEN NOT fits THEN 'amount: ' || amount || ' is no decimal(12,2)' END,
                 CASE WHEN count = 'n/a' THEN 'count: n/a is no int' END) AS reasons FROM t)
        SELECT event_id, ts, user_id, CASE WHEN reasons = '' THEN left(amount, length(amount) - 1) ELSE amount END AS amount,
               count, reasons FROM r""",
    "upsert_defaults": f"""
        {STALE}
        SELECT t.* FROM orders_stale t
          WHERE NOT EXISTS (SELECT 1 FROM {WINDOW} w WHERE w.o_orderkey = t.o_orderkey)
        UNION ALL SELECT w.*, 'none given' AS o_note FROM {WINDOW} w""",
    "ceiling_footers": """
        SELECT 'o_orderkey' AS column, CAST(max(o_orderkey) AS VARCHAR) AS ceiling FROM orders
        UNION ALL SELECT 'o_custkey', CAST(max(o_custkey) AS VARCHAR) FROM orders
        UNION ALL SELECT 'o_orderdate', strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') FROM orders""",
})

ORACLE_SQL["upsert_collated"] = """
    SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN upper(c_name) ELSE c_name END AS c_name,
           CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'LOUD' ELSE c_mktsegment END AS c_mktsegment,
           c_nationkey
    FROM customer WHERE c_mktsegment <> 'FURNITURE'"""

ORACLE_SQL["time_codecs"] = """
    SELECT event_id, strftime(ts, '%H:%M:%S.%f') AS time_text, epoch_us(ts) % 86400000000 AS time_micros,
           CASE user_id % 3 WHEN 0 THEN ts WHEN 1 THEN ts - INTERVAL 330 MINUTE ELSE ts + INTERVAL 3 HOUR END AS instant_utc,
           CASE user_id % 3 WHEN 0 THEN 'Z' WHEN 1 THEN '+05:30' ELSE '-03:00' END AS offset,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || CASE user_id % 3 WHEN 0 THEN 'Z' WHEN 1 THEN '+05:30' ELSE '-03:00' END AS zoned
    FROM events"""

_ALLOWED = "coalesce(allowed_amount, billed_amount)"
_PAID = f"CASE WHEN claim_id % 20 = 0 THEN 0 ELSE CAST({_ALLOWED} * 0.8 AS DECIMAL(12,2)) END"
ORACLE_SQL.update({
    "claims_settled": f"""
        SELECT * REPLACE (
            CASE WHEN claim_id % 20 = 0 THEN 'DENIED' ELSE 'PAID' END AS claim_status,
            CAST({_PAID} AS DECIMAL(12,2)) AS paid_amount,
            CAST(CASE WHEN claim_id % 20 = 0 THEN 0 ELSE {_ALLOWED} - {_PAID} END AS DECIMAL(12,2)) AS member_resp_amount,
            CASE WHEN claim_id % 20 = 0 THEN 'denied: on review' END AS denial_reason,
            coalesce(payer_note, '') || ' / settled' AS payer_note,
            updated_at + INTERVAL 1 DAY AS updated_at)
        FROM ({ORACLE_SQL["claims_generator"]}) WHERE claim_id % 10 = 0""",
    "stage_layout": SNAP + """, parts AS (
        SELECT 'upsert' AS part, o_orderkey FROM orders_new
        UNION ALL
        SELECT 'delete', o_orderkey FROM orders_old o WHERE NOT EXISTS (SELECT 1 FROM orders_new n WHERE n.o_orderkey = o.o_orderkey))
        SELECT part, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys, min(o_orderkey) AS first_key,
               max(o_orderkey) AS last_key FROM parts GROUP BY part""",
})
