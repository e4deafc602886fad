"""Uniform shuffle into shards of exact size by a communication matrix.

How many rows each input partition sends to each cell (a block of a shard) is
drawn exactly: the matrix whose row sums are the partition sizes and whose
column sums are the cell sizes is multivariate hypergeometric for a uniform
shuffle. Every partition permutes its rows locally against its row of the
matrix, rows are exchanged, and each cell permutes what it received.

The matrix is never built. Splitting the partitions in halves, the cell sizes
of a half are one multivariate hypergeometric draw seeded by the half, so each
task walks from the root to its own partition and gets its row, and a task that
is run again gets the same one. The driver only sees one count per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, unpacked

ADDED = ("shard", "slot")
#: Above this population numpy's own sampler refuses.
_NUMPY_MOST = 1_000_000_000 - 1


def draw_count(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """Hypergeometric draw for a population of any size.

    Beyond numpy's limit it inverts the distribution over 40 standard
    deviations around the mode, from the ratio of neighbouring terms.
    """
    if good + bad <= _NUMPY_MOST:
        return int(rng.hypergeometric(good, bad, drawn)) if drawn else 0
    low, high = max(0, drawn - bad), min(good, drawn)
    n = good + bad
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (n + 2)))
    sd = max(1.0, float(drawn / n * good * (bad / n) * ((n - drawn) / n)) ** 0.5)
    lo, hi = max(low, mode - int(40 * sd) - 1), min(high, mode + int(40 * sd) + 1)
    k = np.arange(lo, hi, dtype=np.float64)
    ratio = np.log((good - k) / (k + 1)) + np.log((drawn - k) / (bad - drawn + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(ratio)])
    p = np.cumsum(np.exp(logs - logs.max()))
    return lo + int(np.searchsorted(p, rng.random() * p[-1], side="right"))


def draw_counts(rng: np.random.Generator, sizes: np.ndarray, drawn: int) -> np.ndarray:
    """How many of ``drawn`` rows fall in each cell, cells having ``sizes`` places."""
    left = int(sizes.sum())
    if left <= _NUMPY_MOST:
        return rng.multivariate_hypergeometric(sizes, drawn, method="marginals")
    out = np.zeros_like(sizes)
    for i, size in enumerate(sizes.tolist()):
        if not drawn:
            break
        left -= size
        out[i] = draw_count(rng, size, left, drawn)
        drawn -= int(out[i])
    return out


def matrix_row(part: int, ends: np.ndarray, cells: np.ndarray, seed: int) -> np.ndarray:
    """Row ``part`` of the communication matrix; ``ends`` are cumulative
    partition sizes, starting with 0."""
    lo, hi, sizes = 0, len(ends) - 1, cells
    while hi - lo > 1:
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        left = draw_counts(rng, sizes, int(ends[mid] - ends[lo]))
        if part < mid:
            hi, sizes = mid, left
        else:
            lo, sizes = mid, sizes - left
    return sizes


def cell_sizes(rows: int, shards: int, blocks: int) -> np.ndarray:
    """Places in each cell, shard by shard: shards differ by one row at most,
    and so do the blocks of a shard."""
    quota = rows // shards + (np.arange(shards) < rows % shards)
    return (quota[:, None] // blocks + (np.arange(blocks) < (quota % blocks)[:, None])).ravel()


def shuffle_to_shards(df: DataFrame, shards: int, seed: int = 1,
                      block_rows: int = 20_000) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0
    in each shard): a uniformly random arrangement whose shard sizes differ by
    one row at most.

    A shard is made of blocks of about ``block_rows`` rows, each permuted by a
    task of its own, so the last step stays as small whatever the table's size.
    The input must give the same partitions when it is read again, as a table
    or a checkpoint does; a partition whose row count changed fails the job.

    Defined cases: rows are placed one by one, so repeated rows and nulls need
    no rule; an empty table gives no rows; with fewer rows than shards the
    first shards get one each. Input columns named like an added one are
    replaced by it.
    """
    counted = df.groupBy(F.spark_partition_id().alias("part")).count().collect()
    n_parts = 1 + max((r["part"] for r in counted), default=0)
    per_part = np.zeros(n_parts, dtype=np.int64)
    for r in counted:
        per_part[r["part"]] = r["count"]
    ends = np.concatenate([[0], np.cumsum(per_part)])
    total = int(ends[-1])
    blocks = max(1, -(-total // (shards * block_rows)))

    @F.pandas_udf("long")
    def cell_of(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        labels, part, seen = None, 0, 0
        for batch in ids:
            if labels is None and len(batch):
                part = int(batch.iloc[0]) >> 33
                row = matrix_row(part, ends, cell_sizes(total, shards, blocks), seed)
                labels = np.repeat(np.arange(len(row)), row)
                np.random.default_rng([seed, n_parts, part, 2]).shuffle(labels)
            seen += len(batch)
            if len(batch) and seen > len(labels):
                break
            yield pd.Series(labels[batch.to_numpy() & ((1 << 33) - 1)] if len(batch) else [], dtype="int64")
        if labels is not None and seen != len(labels):
            raise ValueError(f"partition {part} changed between two reads ({len(labels)}, then "
                             f"{seen} rows); write or checkpoint() the input first")

    placed = (df.select(packed(df), F.monotonically_increasing_id().alias("id"))
              .withColumn("cell", cell_of("id")))
    shard, block = F.floor(F.col("cell") / blocks), F.col("cell") % blocks
    quota = F.lit(total // shards) + (F.col("shard") < total % shards).cast("long")
    start = block * F.floor(quota / blocks) + F.least(block, quota % blocks)
    within = Window.partitionBy("cell").orderBy(F.xxhash64(F.lit(seed), F.col("id")), "id")
    return (placed.withColumn("nth", F.row_number().over(within) - 1)
            .withColumn("shard", shard.cast("int"))
            .withColumn("slot", (start + F.col("nth")).cast("long"))
            .select(*unpacked(df, df.columns, ADDED), "shard", "slot"))
