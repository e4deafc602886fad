"""Command line: exit codes and an hwm run end to end."""

import json

from sluice.__main__ import DONE, INVALID, main
from sluice.sinks.native import NativeTable

from conftest import SF001


def test_usage_error_exit_code(capsys):
    assert main(["--source", "s", "--target", "t", "--mode", "upsert"]) == INVALID
    assert "keys: needed" in capsys.readouterr().err


def test_hwm_runs_then_nothing_to_send(spark, scratch, capsys):
    args = ["--source", "orders_cli", "--source-path", f"{SF001}/orders.parquet",
            "--target", "orders_t", "--target-path", f"{scratch}/orders_t",
            "--capture", "hwm", "--mode", "upsert", "--key-cols", "o_orderkey",
            "--hwm-col", "o_orderdate", "--hwm-start", "1998-01-01 00:00:00",
            "--buckets", "4", "--run-log", f"{scratch}/runs"]
    assert main(args, spark=spark) == DONE
    first = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert first["status"] == "ok" and first["rows_written"] > 0
    assert main(args, spark=spark) == DONE
    second = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert second["status"] == "no_changes"
    t = NativeTable(spark, f"{scratch}/orders_t", keys=["o_orderkey"])
    assert t.read().count() == first["rows_written"]


def test_jdbc_source_into_native_target(spark, scratch, capsys):
    from sluice.sinks.jdbc import JdbcSink, create_table_sql, derby_memory_url, q
    url = derby_memory_url()
    df = spark.range(300).selectExpr("id", "cast(id AS string) AS v")
    JdbcSink(spark, url, "src", keys=["id"]).execute(
        create_table_sql("src", df.schema, ["id"]).replace("VARCHAR(32672)", "VARCHAR(20)"))
    df.write.format("jdbc").option("url", url).option("dbtable", q("src")).mode("append").save()
    args = ["--source", "src", "--source-jdbc-url", url, "--source-partition-col", "id",
            "--source-partitions", "3", "--target", "t", "--target-path", f"{scratch}/t",
            "--mode", "upsert", "--key-cols", "id", "--buckets", "2"]
    assert main(args, spark=spark) == DONE
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["rows_written"] == 300


def test_a_target_place_is_needed_and_replays_need_a_table(capsys):
    base = ["--source", "s", "--target", "t"]
    assert main(base) == INVALID and "--target-path" in capsys.readouterr().err
    assert main(base + ["--jdbc-url", "jdbc:x", "--mode", "append", "--replay-key", "d"]) == INVALID
    assert "--replay-key" in capsys.readouterr().err


def test_a_database_can_replay_with_a_column_for_the_key(capsys):
    base = ["--source", "s", "--target", "t", "--jdbc-url", "jdbc:x", "--mode", "append", "--replay-key", "d"]
    from sluice.__main__ import parse_args
    assert parse_args([*base, "--replay-col", "day"]).replay_col == "day"
    assert main([*base, "--replay-col", "day", "--max-connections", "0"]) == INVALID
    err = capsys.readouterr().err
    assert "--max-connections" in err and "--replay-key" not in err
