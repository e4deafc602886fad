"""Staged files between reading and publishing.

Parquet staging (default) keeps every type exactly. CSV staging is kept for
interchange and is lossless with the options below: NULL is written as the
sentinel ``__NULL__``, the empty string as ``""`` (every field quoted), no
whitespace is trimmed, timestamps carry microseconds, binary is hex text and
nested values are JSON. A genuine text value equal to the sentinel cannot be
represented; writing one fails the job instead of turning it into NULL.

Files are written by the executors in parallel (``maxRecordsPerFile`` bounds
file size); ``multiLine`` CSV cannot be split inside a file, so many files are
what keeps the read parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fs
from ..functions.columns import check_rejects, split_rejects, time_text, try_decode
from ..spec import NULL_SENTINEL

# CSV dialect of the staged files.
CSV_OPTIONS = {
    "header": "true",
    "quoteAll": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": NULL_SENTINEL,
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX",
    "dateFormat": "yyyy-MM-dd",
    "encoding": "UTF-8",
    "lineSep": "\n",
}
READ_ONLY_OPTIONS = {"multiLine": "true", "enforceSchema": "false", "mode": "FAILFAST"}
DEFAULT_MAX_RECORDS = 1_000_000
#: A CSV file with line breaks in its fields is read by one task, so it is kept to about this size.
FILE_BYTES = 100 << 20


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while another action runs over them (no extra pass)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("n")), obs


def observed_value(obs: Observation, name: str = "n", default=None):
    """Metric of an Observation; a write that produced no rows may leave the
    observation without a row, which Spark reports as an error: read as
    ``default`` then."""
    try:
        v = obs.get.get(name)
    except Exception:
        return default
    return default if v is None else v


def _nested(dt: T.DataType) -> bool:
    return isinstance(dt, (T.ArrayType, T.StructType, T.MapType))


def _encode(f: T.StructField) -> Column:
    c = F.col(f.name)
    if isinstance(f.dataType, T.StringType):
        guard = F.raise_error(F.lit(f"text equal to {NULL_SENTINEL} in column {f.name} "
                                    f"cannot be staged as CSV"))
        return F.when(c == NULL_SENTINEL, guard).otherwise(c).alias(f.name)
    if isinstance(f.dataType, T.BinaryType):
        return F.hex(c).alias(f.name)
    if _nested(f.dataType):
        return F.to_json(c).alias(f.name)
    if isinstance(f.dataType, T.VariantType):
        return F.to_json(c).alias(f.name)
    if isinstance(f.dataType, T.TimeType):
        return time_text(c).alias(f.name)
    if isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
        # Shortest text that casts back to the same value.
        return c.cast("string").alias(f.name)
    return c.alias(f.name)


def csv_encode(df: DataFrame) -> DataFrame:
    """Typed rows → CSV-safe columns."""
    return df.select(*[_encode(f) for f in df.schema.fields])


def _decode(f: T.StructField) -> Column:
    c = F.col(f.name)
    dt = f.dataType
    if isinstance(dt, T.StringType):
        return c.alias(f.name)
    if isinstance(dt, T.BinaryType):
        return F.unhex(c).alias(f.name)
    if _nested(dt):
        return F.from_json(c, dt).alias(f.name)
    if isinstance(dt, T.VariantType):
        return F.parse_json(c).alias(f.name)
    if isinstance(dt, T.TimestampNTZType):
        return F.to_timestamp_ntz(c, F.lit(CSV_OPTIONS["timestampNTZFormat"])).alias(f.name)
    if isinstance(dt, T.TimestampType):
        return F.to_timestamp(c, CSV_OPTIONS["timestampFormat"]).alias(f.name)
    return c.cast(dt).alias(f.name)   # ANSI: text that does not fit fails the run


def csv_decode(text: DataFrame, schema: T.StructType) -> DataFrame:
    """All-text staged rows → the target's types."""
    return text.select(*[_decode(f) for f in schema.fields])


def rows_per_file(text: DataFrame, file_bytes: int = FILE_BYTES) -> int:
    """Rows of average width that fill a file (one aggregate over the rows)."""
    width = F.lit(0)
    for c in text.columns:
        width = width + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(8)) + 3
    mean = text.agg(F.avg(width).alias("w")).first()["w"]
    return max(1, int(file_bytes / mean)) if mean else DEFAULT_MAX_RECORDS


def write_csv(df: DataFrame, path: str, max_records: int | None = None,
              compression: str | None = None) -> int:
    """Write staged CSV files in parallel; returns the row count (counted
    during the write, no extra pass). Files are bounded by ``max_records`` rows
    or, without it, by about ``FILE_BYTES``."""
    text = csv_encode(df)
    counted, obs = observed(text, "csv_rows")
    w = counted.write.mode("overwrite").options(**CSV_OPTIONS)
    w = w.option("maxRecordsPerFile", str(max_records or rows_per_file(text)))
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return int(observed_value(obs, "n", 0))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with embedded newlines; the header must name the schema's columns."""
    text_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    text = (spark.read.schema(text_schema).options(**CSV_OPTIONS).options(**READ_ONLY_OPTIONS)
            .csv(path))
    return csv_decode(text, schema)


def read_csv_rejects(spark: SparkSession, path: str, schema: T.StructType, stored: str,
                     max_rejects: int = 0) -> tuple[DataFrame, DataFrame]:
    """Staged CSV files as good rows of the declared types and rejected rows as
    text with reasons (C8). The files are parsed once, into ``stored``; more
    than ``max_rejects`` rejected rows fail the run before anything is delivered."""
    text_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    text = (spark.read.schema(text_schema).options(**CSV_OPTIONS).options(**READ_ONLY_OPTIONS).csv(path))
    formats = {f.name: CSV_OPTIONS["timestampFormat"] for f in schema.fields if isinstance(f.dataType, T.TimestampType)}
    decoded = try_decode(text, schema, formats)
    decoded.write.parquet(stored)
    decoded = spark.read.schema(decoded.schema).parquet(stored)
    check_rejects(decoded, max_rejects)
    return split_rejects(decoded)


def read_positional_csv(spark: SparkSession, path: str, names: list[str],
                        header: bool = False, with_file: bool = False) -> DataFrame:
    """Fields by position, named ``names``; a header line is skipped, whatever
    it says. Optionally the name of the file each row came from. A row with
    more or fewer fields fails the read."""
    fields = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))])
    opts = {**CSV_OPTIONS, "header": "true" if header else "false", "multiLine": "true", "mode": "FAILFAST"}
    raw = spark.read.schema(fields).options(**opts).csv(path)
    cols = [F.col(f"_c{i}").alias(n) for i, n in enumerate(names)]
    if with_file:
        cols.append(F.col("_metadata.file_name").alias("file_name"))
    return raw.select(*cols)


def write_parquet(df: DataFrame, path: str, max_records: int = DEFAULT_MAX_RECORDS) -> int:
    counted, obs = observed(df, "parquet_rows")
    counted.write.mode("overwrite").option("maxRecordsPerFile", str(max_records)).parquet(path)
    return int(observed_value(obs, "n", 0))


def stage_round_trip(spark: SparkSession, upserts: DataFrame | None, deletes: DataFrame | None,
                     fmt: str, stage_root: str | None, run_id: str, keys=(),
                     counts: dict[str, int] | None = None) -> tuple[DataFrame | None, DataFrame | None]:
    """Write ``<stage>/<run>/{upsert,delete}`` and return typed readers of them.
    ``counts`` receives the rows of each part, as counted by the write (D12).

    With ``keys`` the staged files are key-clustered (range partitions, sorted
    inside), so whoever loads them reads key ranges in order. The folder is
    removed by the caller after a successful publish (kept after a failure,
    or when asked to keep files)."""
    from ..operators.order import key_order
    from ..session import work_path
    base = f"{stage_root.rstrip('/')}/{run_id}" if stage_root else work_path(spark, "stage")
    out = []
    for part, df in (("upsert", upserts), ("delete", deletes)):
        if df is None:
            out.append(None)
            continue
        if keys:
            df = key_order(df, keys)
        path = f"{base}/{part}"
        if fmt == "csv":
            n = write_csv(df, path)
            out.append(read_csv(spark, path, df.schema))
        else:
            n = write_parquet(df, path)
            out.append(spark.read.schema(df.schema).parquet(path))
        if counts is not None:
            counts[part] = n
    return out[0], out[1]


def typed_copy(spark: SparkSession, upserts: DataFrame | None, deletes: DataFrame | None,
               path: str) -> tuple[DataFrame | None, DataFrame | None]:
    """Staged rows written once more as Parquet, so that text is parsed once."""
    out = []
    for part, df in (("upsert", upserts), ("delete", deletes)):
        if df is not None:
            write_parquet(df, f"{path}/{part}")
            df = spark.read.schema(df.schema).parquet(f"{path}/{part}")
        out.append(df)
    return out[0], out[1]


def remove_stage(spark: SparkSession, path: str) -> None:
    fs.delete(spark, path)
