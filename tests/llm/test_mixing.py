"""Pareto mixing against its SQL and a plain allocation."""

from llm_tables import SF01, docs, odd  # noqa: F401
import math

import __spark_entry__ as E
from oracle_check import compare, duck
from pyspark.sql import functions as F

from sluice.llm import mixing as M


def test_equals_sql(spark):
    name = "op10_pareto_mix"
    n, problems = compare(spark, duck(SF01), name, E.queries()[name], E.oracle_sql()[name], SF01)
    assert n == 1000 and not problems, problems


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Cut at the cap, reshare the excess by weight, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    goal, full = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        left = goal - sum(cap * sizes[s] for s in full)
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if target[s] > cap * sizes[s] + 1e-9}
        if not over:
            return {**{s: cap * sizes[s] for s in full}, **target}
        full |= over


def test_targets_equal_the_plain_allocation(spark):
    sizes = {"b": 10, "a": 1000, "é": 400, None: 77, "Z": 0, "c": 3000, "d": 5}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r["source"]: r["target"] for r in M.allocate(df, (3, 1, 2), 1.5, 2.0).collect()}
    want = plain_targets(sizes)
    assert all(math.isclose(got[s], want[s], abs_tol=1e-6) for s in sizes)


def test_words_taken_come_near_and_reruns_agree(docs):
    rows = [(i, " ".join(["w"] * (1 + i * 7919 % 400)), "en", f"s{i % 4 if i % 3 else 0}") for i in range(2000)]
    df = docs(rows)
    first = M.pareto_mix(df)
    off = first.groupBy("source").agg((F.sum(F.col("size") * F.col("copies")) / F.max("target") - 1).alias("off"))
    assert all(abs(r["off"]) < 0.003 for r in off.collect())
    key = lambda d: sorted((r["doc_id"], r["copies"]) for r in d.collect())
    assert key(first) == key(M.pareto_mix(df.repartition(3)))
    assert {c for _, c in key(first)} <= {0, 1, 2}
    mixed = M.expand(first, df.columns)
    assert mixed.columns == df.columns and mixed.count() == sum(c for _, c in key(first))


def test_weights_change_the_odds(docs):
    rows = [(i, "one two three", "en", "s") for i in range(3000)]
    df = docs(rows).withColumn("w", F.when(F.col("doc_id") < 1000, 8.0).when(F.col("doc_id") < 1010, None).otherwise(1.0))
    out = M.pareto_mix(df, weight="w", share=0.5).groupBy((F.col("doc_id") < 1000).alias("heavy")).agg(
        F.avg("copies").alias("c"), F.sum(F.col("size") * F.col("copies")).alias("words"), F.max("target").alias("t"))
    got = {r["heavy"]: r for r in out.collect()}
    assert 6 < got[True]["c"] / got[False]["c"] < 10
    assert abs(got[True]["words"] + got[False]["words"] - got[True]["t"]) <= 3
    capped = M.pareto_mix(df, weight="w", share=1.5).agg(
        F.max("copies").alias("m"), F.sum(F.col("size") * F.col("copies")).alias("words"), F.max("target").alias("t")).first()
    assert capped["m"] == 2 and abs(capped["words"] - capped["t"]) <= 3


def test_odd_rows(odd, docs):
    out = M.pareto_mix(odd)
    rows = {(r["doc_id"], r["text"]): r for r in out.collect()}
    assert out.count() == 10 and out.columns.count("size") == 1
    assert rows[(1, None)]["size"] == 0 and rows[(2, "")]["size"] == 0
    same = [r["copies"] for r in out.collect() if r["doc_id"] == 6]
    assert same[0] == same[1]
    assert M.pareto_mix(docs([])).collect() == []
    assert [r["copies"] for r in M.pareto_mix(docs([(1, ""), (2, None)])).collect()] == [0, 0]
