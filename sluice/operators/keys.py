"""Key-quality checks run before any write (duplicate, case-colliding, NULL keys).

All are aggregations with a partial (map-side) step, so a hot key is counted
per partition before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``GROUP BY keys HAVING COUNT(*) > 1`` → keys and their row count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def case_colliding_keys(df: DataFrame, key: str) -> DataFrame:
    """String keys that are equal only after case folding (a case-insensitive
    target would merge them) → folded key and the number of spellings."""
    spellings = df.select(F.col(key).alias("k")).where(F.col("k").isNotNull()).distinct()
    return (spellings.groupBy(F.lower("k").alias("folded_key"))
            .agg(F.count(F.lit(1)).alias("n_spellings"))
            .where(F.col("n_spellings") > 1))


def folded_name(df_types: dict[str, str], key: str) -> str:
    """Name of the column that holds a key without regard to case; the key
    itself where it is no text."""
    return f"_lc_{key}" if df_types[key] == "string" else key


def with_folded_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with its text keys in lower case beside them, and the columns to
    match by. A case-insensitive target holds one row per folded key; the folded
    columns are plain text, so they can be hashed into buckets."""
    types = dict(df.dtypes)
    match = [folded_name(types, k) for k in keys]
    return df.withColumns({m: F.lower(k) for k, m in zip(keys, match) if m != k}), match


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any key column (NULL never matches in merge/delete)."""
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return df.where(cond)


def key_problems(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One aggregation finds both NULL and duplicate keys (reads key columns only)."""
    keys = list(keys)
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    return (df.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where((F.col("n_rows") > 1) | has_null)
            .select(*keys, "n_rows", has_null.alias("null_key")))


def check_keys(df: DataFrame, keys: Sequence[str], case_insensitive: bool = False) -> None:
    """Raise before writing when the key is not usable (one job; it stops at the
    first offending key)."""
    bad = key_problems(df, keys).first()
    if bad is not None:
        if bad["null_key"]:
            raise ValueError(f"NULL values in key columns {list(keys)}")
        raise ValueError(f"duplicate keys in {list(keys)}")
    if case_insensitive:
        for k in keys:
            if dict(df.dtypes)[k] == "string" and not case_colliding_keys(df, k).isEmpty():
                raise ValueError(f"keys in {k!r} collide when case is ignored")
