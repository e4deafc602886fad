"""Merkle manifest against a plain tree: odd keys, repeated rows, many rounds, tampering, SQL."""

import hashlib
from collections import defaultdict

import pytest
from llm_tables import SF01, DOCS, docs, odd  # noqa: F401
from oracle_check import compare, duck
from pyspark.sql import functions as F

import __spark_entry__ as E
from sluice.llm import merkle as M


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    frame = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha("".join(frame(row[f]) for f in M.FIELDS))


def plain_tree(nodes):
    """(top, siblings of each node with their side), pairing level by level."""
    paths = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        for i, members in enumerate(under):
            other = i ^ 1
            for m in members:
                paths[m].append((nodes[other], other < i) if other < len(nodes) else (None, other < i))
        nodes = [sha("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
        under = [sum(under[i:i + 2], []) for i in range(0, len(under), 2)]
    return nodes[0], paths


def plain(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
    trees = [plain_tree([plain_leaf(r) for r in groups[g]]) for g in order]
    root, upper = plain_tree([t for t, _ in trees])
    return sorted(((r["doc_id"], g, plain_leaf(r), pos, path + above, top, root)
                   for g, (top, paths), above in zip(order, trees, upper)
                   for pos, (r, path) in enumerate(zip(groups[g], paths))), key=repr)


def found(df):
    return sorted(((r["doc_id"], r["lang"], r["leaf"], r["pos"], [(s["digest"], s["left"]) for s in r["path"]],
                    r["subroot"], r["root"]) for r in df.collect()), key=repr)


def check(df):
    rows = found(M.manifest(df))
    assert rows == plain([r.asDict() for r in df.collect()])
    return rows


def test_odd_rows(odd):
    rows = check(odd)
    assert len(rows) == 10 and [r[0] for r in rows].count(6) == 2


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_few_rows_in_one_group(docs, n):
    check(docs([(i, f"t{i}") for i in range(n)]))


def test_many_rounds_of_small_slot_arrays(spark, docs, monkeypatch):
    monkeypatch.setattr(M, "LEVELS", 2)
    ids = [i * i * i - 40_000 for i in range(70)] + [2**63 - 1, -2**63, 2**62, -2**62 + 5]
    rows = [(i, f"text {i}", ["en", "de", None, "", "é", "z"][k % 7 % 6], "s") for k, i in enumerate(ids)]
    check(docs(rows).repartition(5))


def test_keys_that_repeat(docs, monkeypatch):
    monkeypatch.setattr(M, "LEVELS", 3)
    monkeypatch.setattr(M, "_PIECE", 4)
    rows = ([(5, f"other text {i % 40}") for i in range(90)] + [(None, f"no key {i % 3}") for i in range(20)]
            + [(i, "x") for i in range(70)] + [(5, "again", "de")] * 9)
    check(docs(rows).repartition(6))


def test_empty_table_and_wrong_key(docs):
    empty = docs([])
    assert M.manifest(empty).collect() == []
    with pytest.raises(TypeError):
        M.manifest(empty.withColumn("doc_id", F.lit("a")))


def test_parts_merge_to_one_bitmap(docs):
    keyed = M.leaves(docs([(i * 3, "t", ["a", "b"][i % 2]) for i in range(300)]))
    whole = M.bitmaps(keyed)
    parts = M.merged(*(M.bitmaps(keyed.where(F.col("key") % 2 == r)) for r in (0, 1)))
    assert sorted(whole.collect()) == sorted(parts.collect())


def test_tampering_is_found(docs):
    df = docs([(i, f"text number {i}", "en" if i % 3 else "de") for i in range(40)] + [(None, None)])
    bad = M.leaf_digest([F.when(F.col("doc_id") == 11, "changed").otherwise(F.col(c)) if c == "text" else F.col(c)
                         for c in M.FIELDS])
    out = M.manifest(df, carry={"now": bad})
    wrong = out.where(M.folded(F.col("now"), F.col("path")) != F.col("root")).collect()
    assert [r["doc_id"] for r in wrong] == [11]
    assert out.where(M.folded(F.col("leaf"), F.col("path")) == F.col("root")).count() == 41
    again = M.manifest(df.repartition(3))
    assert found(again) == found(M.manifest(df))


def test_null_count_stays_null(spark, docs):
    df = spark.createDataFrame([(14, "t", None, None, None), (2**63 - 1, "u", "en", None, 2**63 - 1)], DOCS)
    assert M.manifest(df).count() == 2


def test_no_task_sorts_or_collects_all(spark):
    path = f"{SF01}/documents.parquet"
    keyed = M.leaves(spark.read.parquet(path))
    index = M.rank_index(M.bitmaps(keyed))
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_query_equals_sql(spark):
    name = "op13_merkle_manifest"
    n, problems = compare(spark, duck(SF01), name, E.queries()[name], E.oracle_sql()[name], SF01)
    assert n == 1000 and not problems, problems
