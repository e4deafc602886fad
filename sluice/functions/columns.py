"""Column-level transforms applied before writing (all Catalyst expressions)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lower_cols(df: DataFrame) -> DataFrame:
    """Lower-case every column name; refuse names that collide afterwards."""
    lowered = [c.lower() for c in df.columns]
    if len(set(lowered)) != len(lowered):
        dup = sorted({c for c in lowered if lowered.count(c) > 1})
        raise ValueError(f"column names collide when lower-cased: {dup}")
    return df.toDF(*lowered)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in float/double columns becomes NULL (what a database stores)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            out.append(F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def exclude(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``SELECT * EXCLUDE (…)``."""
    return df.drop(*cols)


def replace(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """``SELECT * REPLACE (expr AS col)`` keeping the column position."""
    missing = [c for c in exprs if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns {missing}")
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def check_target_columns(source: DataFrame, target_columns: Sequence[str]) -> None:
    """Columns are matched by name; a source column the target lacks fails the run."""
    have = {c.lower() for c in target_columns}
    missing = [c for c in source.columns if c.lower() not in have]
    if missing:
        raise ValueError(f"target has no columns {missing}")


_WIDER = ("tinyint", "smallint", "int", "bigint")


def _fits_always(have: T.DataType, want: T.DataType) -> bool:
    a, b = have.simpleString(), want.simpleString()
    if a in _WIDER and b in _WIDER:
        return _WIDER.index(a) <= _WIDER.index(b)
    if isinstance(have, T.DecimalType) and isinstance(want, T.DecimalType):
        return (have.scale <= want.scale
                and have.precision - have.scale <= want.precision - want.scale)
    return isinstance(want, T.StringType) or (a, b) == ("float", "double")


def cast_exactly(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``df`` in the types ``schema`` declares for their names.

    A value that the declared type cannot hold, or only rounded or cut, fails
    the job; types that cannot be cast are refused at once. Columns that the
    schema does not name are refused as well.
    """
    declared = {f.name: f.dataType for f in schema.fields}
    unknown = [c for c in df.columns if c not in declared]
    if unknown:
        raise ValueError(f"columns missing in the target: {unknown}")
    out = []
    for f in df.schema.fields:
        c, want = F.col(f.name), declared[f.name]
        if f.dataType == want:
            out.append(c)
            continue
        cast = c.cast(want)
        if not _fits_always(f.dataType, want):
            whole = isinstance(f.dataType, T.StringType)
            if whole and isinstance(want, T.DecimalType):
                kept = cast == c.cast(T.DecimalType(38, min(38, want.scale + 10)))
            elif whole or isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
                kept = F.lit(True)  # text that does not parse already fails the cast
            else:
                kept = cast.cast(f.dataType) == c
            fail = F.raise_error(F.concat(F.lit(f"column {f.name}: a value does not fit {want.simpleString()}: "),
                                          c.cast("string") if not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.lit("")))
            cast = F.when(c.isNull() | kept, cast).otherwise(fail.cast(want))
        out.append(cast.alias(f.name))
    return df.select(*out)


# ---------------------------------------------------------------- times of day and offsets

def time_text(c: Column) -> Column:
    """A TIME as ``HH:mm:ss.SSSSSS``; ``cast("time(6)")`` reads it back."""
    two = lambda part: F.lpad(part.cast("string"), 2, "0")
    return F.concat(two(F.hour(c)), F.lit(":"), two(F.minute(c)), F.lit(":"),
                    F.lpad(F.extract(F.lit("SECOND"), c).cast("string"), 9, "0"))


def time_micros(c: Column) -> Column:
    """A TIME as microseconds since midnight."""
    return F.time_diff(F.lit("MICROSECOND"), F.lit("00:00:00").cast("time(6)"), c)


def micros_time(c: Column) -> Column:
    """Microseconds since midnight as a TIME; fails outside of a day."""
    seconds = F.floor(c / 1_000_000)
    return F.make_time(F.floor(seconds / 3600).cast("int"), F.floor(seconds % 3600 / 60).cast("int"),
                       (seconds % 60 + (c % 1_000_000).cast("decimal(16,6)") / F.lit(1_000_000).cast("decimal(7,0)"))
                       .cast("decimal(16,6)"))


def offset_of(text: Column) -> Column:
    """The offset behind a time in text (``Z`` or ``+hh:mm``), NULL without one.
    Kept in a column beside the instant, as a timestamp holds the instant alone."""
    found = F.regexp_extract(text, "(Z|[+-][0-9]{2}:[0-9]{2})$", 1)
    return F.when(found != "", found)


def in_offset(instant: Column, offset: Column) -> Column:
    """The wall clock of an instant at an offset, with the offset behind it, to
    the microsecond (session zone UTC)."""
    sign = F.when(offset.startswith("-"), -1).otherwise(1)
    part = lambda at: F.when(offset == "Z", 0).otherwise(sign * F.substring(offset, at, 2).try_cast("int"))
    wall = instant.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), part(2), part(5))
    return F.concat(F.date_format(wall, "yyyy-MM-dd HH:mm:ss.SSSSSS"), offset)


# ---------------------------------------------------------------- rejected rows

#: Column with the reasons why a row was set aside.
REASONS = "reasons"


def try_decode(text: DataFrame, schema: T.StructType, formats: Mapping[str, str] | None = None) -> DataFrame:
    """All-text rows as ``row`` (a struct of the declared types) and ``reasons``,
    one sentence per value that does not fit, empty for good rows.

    A value does not fit when ``try_cast`` refuses it, when a decimal would be
    rounded, or when NULL stands in a column declared NOT NULL. ``formats``
    gives the pattern of dates and times that are not in ISO form. Columns that
    the schema does not name fail at once; missing ones are NULL.
    """
    unknown = [c for c in text.columns if c not in schema.names]
    if unknown:
        raise ValueError(f"columns missing in the target: {unknown}")
    values, reasons = [], []
    for f in schema.fields:
        c = F.col(f"`{f.name}`").cast("string") if f.name in text.columns else F.lit(None).cast("string")
        value = _try_value(c, f.dataType, (formats or {}).get(f.name))
        bad = c.isNotNull() & value.isNull()
        if isinstance(f.dataType, T.DecimalType):
            wide = c.try_cast(T.DecimalType(38, min(38, f.dataType.scale + 10)))
            bad = bad | (wide.isNotNull() & value.isNotNull() & (wide != value))
            value = F.when(wide == value, value)
        told = F.concat(F.lit(f"{f.name}: "), c, F.lit(f" is no {f.dataType.simpleString()}"))
        reasons.append(F.when(bad, told))
        if not f.nullable:
            reasons.append(F.when(c.isNull(), F.lit(f"{f.name}: NULL is not allowed")))
        values.append(value.alias(f.name))
    return text.select(F.struct(*values).alias("row"), F.array_compact(F.array(*reasons)).alias(REASONS),
                       F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in text.columns]).alias("text"))


def _try_value(c: Column, dt: T.DataType, fmt: str | None) -> Column:
    if isinstance(dt, T.StringType):
        return c
    if isinstance(dt, T.BinaryType):
        return F.when(c.rlike("^([0-9A-Fa-f]{2})*$"), F.unhex(c))
    if isinstance(dt, (T.ArrayType, T.StructType, T.MapType)):
        return F.from_json(c, dt, {"mode": "PERMISSIVE"})
    if isinstance(dt, T.VariantType):
        return F.try_parse_json(c)
    if fmt and isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.try_to_timestamp(c, F.lit(fmt)).cast(dt)
    return c.try_cast(dt)


def split_rejects(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows in their types, and rejected ones as the text they came as with
    their reasons. ``decoded`` is read twice; give it as stored files."""
    good = decoded.where(F.size(REASONS) == 0).select("row.*")
    return good, decoded.where(F.size(REASONS) > 0).select("text.*", REASONS)


class TooManyRejects(ValueError):
    """More rows do not fit the declared types than the run allows."""


def check_rejects(decoded: DataFrame, limit: int) -> int:
    """Number of rejected rows; raises beyond ``limit``, naming the most common reasons."""
    bad = decoded.where(F.size(REASONS) > 0)
    n = bad.count()
    if n > limit:
        why = (bad.select(F.explode(REASONS).alias("r")).groupBy(F.substring_index("r", ":", 1).alias("column"))
               .count().orderBy(F.desc("count"), "column").limit(5).collect())
        raise TooManyRejects(f"{n} rows do not fit, {limit} are allowed; by column: "
                             + ", ".join(f"{r['column']} {r['count']}" for r in why))
    return n
