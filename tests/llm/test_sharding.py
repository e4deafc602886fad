"""The uniform shuffle: exact sizes, gapless slots, uniform matrix, reruns."""

from llm_tables import docs, odd  # noqa: F401
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import sharding as S


def layout(df, shards, **options):
    return sorted((r["shard"], r["slot"], r["id"]) for r in S.shuffle_to_shards(df, shards, **options).collect())


@pytest.mark.parametrize("block_rows", [10_000, 7])
def test_exact_sizes_and_gapless_slots(spark, block_rows):
    df = spark.range(1003, numPartitions=5)
    got = layout(df, 40, block_rows=block_rows)
    assert sorted(i for _, _, i in got) == list(range(1003))
    per_shard = {}
    for s, slot, _ in got:
        per_shard.setdefault(s, []).append(slot)
    assert sorted(map(len, per_shard.values())) == [25] * 37 + [26] * 3
    assert all(v == list(range(len(v))) for v in per_shard.values())
    assert got == layout(df, 40, block_rows=block_rows)
    assert got != layout(df, 40, block_rows=block_rows, seed=2)


def test_matrix_rows_add_up():
    ends = np.array([0, 10, 10, 43, 100, 137])
    cells = S.cell_sizes(137, 7, 2)
    rows = np.array([S.matrix_row(p, ends, cells, 3) for p in range(5)])
    assert (rows >= 0).all()
    assert rows.sum(axis=1).tolist() == np.diff(ends).tolist() and rows.sum(axis=0).tolist() == cells.tolist()


def test_every_place_is_equally_likely(spark):
    """Row 0's shard over many seeds, and the mean of the matrix."""
    ends, cells = np.array([0, 8, 20]), S.cell_sizes(20, 4, 1)
    rows = np.array([S.matrix_row(0, ends, cells, s) for s in range(4000)])
    assert np.allclose(rows.mean(axis=0), 8 * 5 / 20, atol=0.08)
    assert np.allclose(rows.var(axis=0), 8 * .25 * .75 * 12 / 19, atol=0.08)


def test_draw_beyond_numpys_limit(monkeypatch):
    rng = np.random.default_rng(0)
    monkeypatch.setattr(S, "_NUMPY_MOST", 0)
    got = np.array([S.draw_count(rng, 30, 70, 20) for _ in range(20_000)])
    assert abs(got.mean() - 6) < 0.05 and abs(got.var() - 20 * .3 * .7 * 80 / 99) < 0.1
    assert S.draw_counts(rng, np.array([3, 4, 5]), 12).tolist() == [3, 4, 5]
    monkeypatch.undo()
    big = S.draw_count(rng, 10**9, 3 * 10**9, 10**6)
    assert abs(big - 250_000) < 3000


def test_a_changed_partition_fails(spark):
    chance = F.udf(lambda i: random.random() < 0.5, "boolean").asNondeterministic()
    df = spark.range(1000, numPartitions=2).filter(chance("id"))
    with pytest.raises(Exception, match="changed between two reads"):
        S.shuffle_to_shards(df, 4).collect()


def test_odd_rows(odd, docs):
    out = S.shuffle_to_shards(odd.coalesce(1), 3)
    assert out.columns.count("shard") == 1 and out.count() == 10
    assert S.shuffle_to_shards(docs([]), 5).collect() == []
    assert sorted((r["shard"], r["slot"]) for r in S.shuffle_to_shards(docs([(1, "a"), (2, None)]), 5).collect()) == [(0, 0), (1, 0)]
