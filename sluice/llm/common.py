"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, work_path
from ..sources.tables import read_table

#: A word, as the table contracts define it: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows in one Arrow batch; texts can be long, so batches are kept short.
BATCH_ROWS = 200


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of this package: UTC, ANSI, AQE, short Arrow batches.

    Python workers look for this package where the driver found it. A cluster
    whose machines do not see that folder gets it by ``--py-files``.
    """
    configure(spark)
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, so later passes neither recompute it nor lose it with an
    executor, and gives Spark a file size to check before it broadcasts.
    """
    spark = df.sparkSession
    path = work_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, name: str = "row") -> Column:
    """The whole row as one struct, so added columns cannot clash with its own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def unpacked(df: DataFrame, columns: list[str], drop: tuple[str, ...] = ()) -> list[Column]:
    """The columns of a packed row again, without those named in ``drop``."""
    return [F.col(f"row.`{c}`").alias(c) for c in columns if c not in drop]


def n_words(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
