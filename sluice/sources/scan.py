"""Source scans: whole table, view, and high-water-mark window.

All scans stay lazy; the only value brought to the driver is the scalar
ceiling of a window, captured once before the window is read so rows that
advance during the read wait for the next run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def define_view(spark: SparkSession, name: str, select_sql: str) -> DataFrame:
    """Register a view that pins the projection (e.g. ``UPPER(v) AS v``)."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {select_sql}")
    return spark.table(name)


def sample_rows(df: DataFrame, key: str, up_to) -> DataFrame:
    """The rows with keys up to a value, in key order, to look at (E4). The bound reaches the scan."""
    return df.where(F.col(key) <= F.lit(up_to)).orderBy(key)


def empty_copy(df: DataFrame) -> DataFrame:
    """No rows, all columns with their types (E4); nothing is read."""
    return df.sparkSession.createDataFrame([], df.schema)


@dataclass(frozen=True)
class Watermark:
    """A typed watermark value kept as exact text (round-trips via ``cast``)."""

    type: str
    value: str

    def lit(self) -> Column:
        return F.lit(self.value).cast(self.type)

    def to_json(self) -> dict:
        return {"type": self.type, "value": self.value}

    @staticmethod
    def from_json(d: dict | None) -> "Watermark | None":
        return None if not d else Watermark(d["type"], d["value"])

    @staticmethod
    def of(value, dtype: T.DataType) -> "Watermark":
        return Watermark(dtype.simpleString(), str(value))


def hwm_ceiling(df: DataFrame, col: str, watermark: Watermark | None = None,
                lookback: str | None = None) -> Watermark | None:
    """``MAX(col)`` [above the watermark, widened by ``lookback``]; None means
    nothing to send.

    One partial + final aggregate; the scan only reads ``col`` and Parquet
    row groups whose max is below the bound are skipped.
    """
    dtype = df.schema[col].dataType
    rows = df.select(col)
    if watermark is not None:
        lower = watermark.lit() - F.expr(lookback) if lookback else watermark.lit()
        rows = rows.where(F.col(col) > lower)
    value = rows.agg(F.max(col).cast("string").alias("c")).first()["c"]
    return None if value is None else Watermark(dtype.simpleString(), value)


def footer_ceiling(spark: SparkSession, path: str, col: str) -> Watermark | None:
    """``MAX(col)`` of a Parquet folder from the files' footers (D1): the
    aggregate is pushed into the V2 reader, so no row group is read.

    That holds for whole numbers and dates; Spark pushes no other type down (or,
    for floats, a maximum that knows no NaN), so those are aggregated by a scan
    of the one column, as are files whose footers tell no maximum (a file that
    holds only NULL there). None means that there is nothing, or only NULL.
    """
    source = spark.read.parquet(path)
    if not isinstance(source.schema[col].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DateType)):
        return hwm_ceiling(source, col)
    before = {k: spark.conf.get(k) for k in _PUSHED}
    try:
        for k, v in _PUSHED.items():
            spark.conf.set(k, v)
        top = footer_max(spark, path, col)
        value = top.first()["ceiling"]
    except Exception as e:
        if "No min/max found" not in str(e):
            raise
        top = None
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    if top is None:
        return hwm_ceiling(source, col)
    return None if value is None else Watermark(top.schema["ceiling"].dataType.simpleString(), str(value))


def footer_max(spark: SparkSession, path: str, col: str) -> DataFrame:
    """One row ``ceiling``; answered from footers while ``_PUSHED`` is set."""
    return spark.read.parquet(path).agg(F.max(col).alias("ceiling"))


#: Settings under which Spark answers MAX from Parquet footers.
_PUSHED = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def hwm_window(df: DataFrame, col: str, watermark: Watermark | None,
               ceiling: Watermark, lookback: str | None = None) -> DataFrame:
    """Rows with ``watermark < col <= ceiling``; no lower bound on a first run.

    NULL in ``col`` is never selected. ``lookback`` (an interval literal such
    as ``INTERVAL 2 DAYS``) widens the lower bound so rows committed late with
    an older stamp are re-sent; safe because upsert is idempotent.
    """
    cond = F.col(col) <= ceiling.lit()
    if watermark is not None:
        lower = watermark.lit()
        if lookback:
            lower = lower - F.expr(lookback)
        cond = (F.col(col) > lower) & cond
    return df.where(cond)


def row_count_and_latest(df: DataFrame, col: str) -> DataFrame:
    """``COUNT(*)`` and ``MAX(col)`` in one pass."""
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.max(col).alias("latest"))


def changed_since(df: DataFrame, col: str, since: Column) -> DataFrame:
    """``COUNT_IF(col >= since)`` with a passed-in reference time, and ``COUNT(*)``."""
    return df.agg(F.count_if(F.col(col) >= since).alias("changed"), F.count(F.lit(1)).alias("row_count"))
