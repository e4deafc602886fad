"""Source-to-target reconciliation: aggregate metrics, compare, row diffs.

Metrics are one global aggregate (partial per partition, one tiny final
merge). Money columns held as double are summed as integer cents so the
result does not depend on summation order; decimals are summed as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("long")


def epoch_seconds(c: str) -> Column:
    return F.unix_timestamp(F.col(c).cast("timestamp")).cast("long")


def metrics(df: DataFrame, key: str, money: Sequence[str] = (), text: Sequence[str] = (),
            flags: Sequence[str] = (), dates: Sequence[str] = (),
            nullable: Sequence[str] = ()) -> DataFrame:
    """One row of named BIGINT metrics: count, max key, exact sums, non-null
    counts, empty strings, total text length, NULL count, flag sum, min/max."""
    aggs = [F.count(F.lit(1)).alias("row_count"), F.max(key).cast("long").alias("max_key")]
    for m in money:
        exact = isinstance(df.schema[m].dataType, T.DecimalType)
        aggs.append((F.sum(m).cast("string").alias(f"sum_{m}") if exact
                     else F.sum(cents(m)).cast("long").alias(f"sum_cents_{m}")))
        aggs.append(F.count(m).cast("long").alias(f"nonnull_{m}"))
    for t in text:
        aggs.append(F.count_if(F.col(t) == "").cast("long").alias(f"empty_{t}"))
        aggs.append(F.sum(F.length(t)).cast("long").alias(f"chars_{t}"))
    for n in nullable:
        aggs.append(F.count_if(F.col(n).isNull()).cast("long").alias(f"nulls_{n}"))
    for f in flags:
        aggs.append(F.sum(F.col(f).cast("int")).cast("long").alias(f"true_{f}"))
    for d in dates:
        aggs.append(F.min(epoch_seconds(d)).alias(f"min_{d}"))
        aggs.append(F.max(epoch_seconds(d)).alias(f"max_{d}"))
    return df.agg(*aggs)


def group_counts(df: DataFrame, col: str) -> DataFrame:
    """``GROUP BY col, COUNT(*)``."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))


_EXACT = T.DecimalType(38, 10)


def _as_number(c: Column) -> Column:
    """A number in text as a number of one scale, so that 1.5 equals 1.500000;
    null where the text is none, has leading zeros or would be rounded."""
    exact = c.try_cast(_EXACT)
    written = c.rlike(r"^-?(0|[1-9][0-9]*)([.][0-9]{1,10}0*)?$") | c.rlike(r"^-?[0-9]([.][0-9]+)?E-?[0-9]+$")
    return F.when(written & (exact.cast("double") == c.try_cast("double")), exact)


def same_value(a: Column, b: Column) -> Column:
    """NULL-safe equality of two texts, of numbers by value and not by spelling."""
    x, y = _as_number(a), _as_number(b)
    return a.eqNullSafe(b) | F.coalesce(x == y, F.lit(False))


def unpivot_metrics(m: DataFrame) -> DataFrame:
    """One metrics row → (metric, value) rows; as text where a metric is."""
    if any(isinstance(f.dataType, T.StringType) for f in m.schema.fields):
        m = m.select(*[F.col(c).cast("string").alias(c) for c in m.columns])
    return m.unpivot([], m.columns, "metric", "value")


def compare_metrics(source: DataFrame, target: DataFrame) -> DataFrame:
    """Metric by metric, NULL-safe; names present on one side only are reported
    with the other side NULL and ``matches`` false. Numbers held in different
    types or scales (``decimal(12,2)`` and ``decimal(18,6)``, bigint and text)
    are compared by value; other text as text."""
    s = unpivot_metrics(source).withColumnRenamed("value", "source_value").withColumn("_s", F.lit(True))
    t = unpivot_metrics(target).withColumnRenamed("value", "target_value").withColumn("_t", F.lit(True))
    both = s.join(t, "metric", "full_outer")
    here = F.col("_s").isNotNull() & F.col("_t").isNotNull()
    value = lambda c: F.col(c).cast("string")
    return (both.withColumn("matches", here & same_value(value("source_value"), value("target_value")))
            .drop("_s", "_t"))


def column_diff(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What differs, value by value (J4): the keys, ``column``, ``source_value``
    and ``target_value`` as text, ``status``.

    ``changed`` rows name one differing column each, NULL-safe. A row that one
    side lacks gives one line with ``column`` NULL and ``source_only`` or
    ``target_only``. Numbers are compared by value whatever their types; columns
    that one side lacks are refused. Keys have to be unique and not NULL (a
    duplicate fails the job before the join). One full outer join; only
    differing values are expanded.
    """
    from ..sources.snapshot import assert_unique
    keys = list(keys)
    if sorted(source.columns) != sorted(target.columns):
        raise ValueError(f"columns differ: {sorted(set(source.columns) ^ set(target.columns))}")
    vals = [c for c in source.columns if c not in keys]
    side = lambda df, tag, what: assert_unique(df, keys, what).select(
        *keys, *[F.col(f"`{c}`").alias(f"{tag}{c}") for c in vals], F.lit(True).alias(f"{tag}_here"))
    j = side(source, "_s_", "source").join(side(target, "_t_", "target"), keys, "full_outer")
    only_s, only_t = F.col("_t__here").isNull(), F.col("_s__here").isNull()

    def line(column, s, t, status):
        return F.struct(F.lit(column).cast("string").alias("column"), s.alias("source_value"), t.alias("target_value"),
                        F.lit(status).alias("status"))
    none = F.lit(None).cast("string")
    lines = [F.when(only_s, line(None, none, none, "source_only")), F.when(only_t, line(None, none, none, "target_only"))]
    for c in vals:
        a, b = F.col(f"`_s_{c}`"), F.col(f"`_t_{c}`")
        s, t = a.cast("string"), b.cast("string")
        same = a.eqNullSafe(b) if source.schema[c].dataType == target.schema[c].dataType else same_value(s, t)
        lines.append(F.when(~only_s & ~only_t & ~same, line(c, s, t, "changed")))
    found = F.array_compact(F.array(*lines))
    return j.select(*keys, F.inline(found))


def left_diff(a: DataFrame, b: DataFrame, keys: Sequence[str],
              null_safe: bool = False) -> DataFrame:
    """Rows of ``a`` missing in ``b`` or differing in a non-key column.

    ``null_safe=False`` reproduces ``a.x <> b.x`` (a NULL on either side never
    counts as a difference); ``True`` uses ``NOT (a.x <=> b.x)``."""
    from ..sources.snapshot import assert_unique
    keys = list(keys)
    cols = [c for c in a.columns if c not in keys]
    bb = assert_unique(b, keys, "compared table").select(
        *keys, *[F.col(c).alias(f"_b_{c}") for c in cols], F.lit(True).alias("_b_hit"))
    j = a.join(bb, keys, "left")
    differs = F.col("_b_hit").isNull()
    for c in cols:
        if null_safe:
            differs = differs | ~F.col(c).eqNullSafe(F.col(f"_b_{c}"))
        else:
            differs = differs | F.coalesce(F.col(c) != F.col(f"_b_{c}"), F.lit(False))
    return j.where(differs).select(*a.columns)


def row_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in one side and not the other, as multisets, with a ``side`` column.

    Counted in one pass (``row_diff_counts``) and expanded after a
    rebalancing exchange in pieces of at most 10,000 copies, so that the surplus copies of a
    hot row are made by many tasks."""
    piece = 10_000
    found = row_diff_counts(a, b)
    pieces = F.transform(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_rows") - 1) / piece)),
                         lambda i: F.least(F.lit(piece).cast("long"), F.col("n_rows") - i * piece))
    cols = a.columns
    dealt = found.select(*cols, "side", F.explode(pieces).alias("_n")).hint("rebalance")
    return dealt.select(*cols, "side", F.explode(F.array_repeat(F.lit(1), F.col("_n").cast("int"))).alias("_i")).drop("_i")


def row_diff_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Multiset difference as distinct rows with their surplus count (``n_rows``)
    and ``side``. One partial aggregation over both inputs; unlike a
    row-by-row ``EXCEPT ALL`` it never replicates the copies of a hot row in a
    single task."""
    cols = a.columns
    both = (a.select(*cols, F.lit(1).alias("_s"))
            .unionByName(b.select(*cols, F.lit(-1).alias("_s"))))
    g = both.groupBy(*cols).agg(F.sum("_s").cast("long").alias("_d"))
    return (g.where(F.col("_d") != 0)
            .select(*cols, F.when(F.col("_d") > 0, F.lit("source_only"))
                    .otherwise(F.lit("target_only")).alias("side"),
                    F.abs("_d").alias("n_rows")))


def orphan_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target keys that no longer exist in the source (missed deletes of hwm)."""
    keys = list(keys)
    return target.select(*keys).join(source.select(*keys), keys, "left_anti")
