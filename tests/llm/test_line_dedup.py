"""Cuckoo filters, and line dedup against a plain version: batches, deletions, odd rows, SQL."""

from collections import Counter

import numpy as np
import pytest
from llm_tables import SF01, docs, odd  # noqa: F401
from oracle_check import compare, duck
from pyspark.sql import functions as F

import __spark_entry__ as E
from sluice.llm import line_dedup as L
from sluice.llm.cuckoo import CuckooFilter, Full, buckets_for


def keys(n, seed=1):
    return np.unique(np.random.default_rng(seed).integers(-2**63, 2**63 - 1, n))


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1000, 50_000])
def test_filter_knows_its_keys(n):
    k, strange = keys(n), keys(20_000, 2)
    made = CuckooFilter.of(k)
    assert made.might_hold(k).all() and np.count_nonzero(made.cells) == len(k)
    assert made.might_hold(strange).mean() < 0.002
    again = CuckooFilter.from_bytes(made.to_bytes())
    assert again.might_hold(k).all()


def test_filter_takes_keys_out():
    k = keys(5000)
    made = CuckooFilter.of(k)
    made.remove(k[::2])
    assert made.might_hold(k[1::2]).all() and made.might_hold(k[::2]).mean() < 0.01
    made.add(k[::2])
    assert made.might_hold(k).all() and np.count_nonzero(made.cells) == len(k)
    made.remove(k)
    assert not made.cells.any()
    with pytest.raises(KeyError):
        made.remove(k[:1])


def test_a_full_filter_says_so():
    made = CuckooFilter(np.zeros((buckets_for(100), 4), np.uint16))
    with pytest.raises(Full):
        made.add(keys(1000))


def plain_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans(L.UPPER, L.LOWER))


def plain(known, rows, threshold, min_chars=1):
    """(doc_id, kept, n_lines, n_dropped) after the documents ``known``."""
    n = Counter(k for _, t, *_ in known for k in {plain_key(x) for x in (t or "").split("\n")})
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(plain_key(x)) < min_chars or n[plain_key(x)] < threshold]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=repr)


def cleaned(index, df, **options):
    return sorted((tuple(r) for r in index.clean(df, **options).select("doc_id", "kept", "n_lines", "n_dropped").collect()), key=repr)


def texts(n, seed, words=30):
    r = np.random.default_rng(seed)
    line = lambda: ["", " ", "\t x"][r.integers(3)] + f"Line {r.integers(words) ** 2 % 97}" + ["", "  ", "\r"][r.integers(3)]
    return [(int(seed * 1000 + i), "\n".join(line() for _ in range(r.integers(0, 9)))) for i in range(n)]


def test_batches_and_deletions(spark, docs, monkeypatch):
    monkeypatch.setattr(L, "MAX_CHANGES", 2)
    parts = [texts(60, s) for s in range(4)]
    index = L.LineIndex.empty(spark, threshold=5)
    known, seen = [], [index]
    for p in parts:
        index, known = index.insert(docs(p)), known + p
        seen.append(index)
        assert cleaned(index, docs(known)) == plain(known, known, 5)
    index = index.delete(docs(parts[3])).delete(docs(parts[1]))
    left = parts[0] + parts[2]
    assert cleaned(index, docs(known)) == plain(left, known, 5)
    back = index.insert(docs(parts[1])).delete(docs(parts[2])).delete(docs(parts[1])).delete(docs(parts[0]))
    assert back.counts().count() == 0 and back.filters.agg(F.sum("n_keys")).first()[0] == 0
    assert cleaned(seen[2], docs(known)) == plain(parts[0] + parts[1], known, 5)   # older states stay


def test_reversal_gives_the_same_table(spark, docs):
    a, b = texts(50, 5), texts(50, 6)
    first = L.LineIndex.empty(spark, threshold=4).insert(docs(a))
    back = first.insert(docs(b)).delete(docs(b))
    assert sorted(first.counts().collect()) == sorted(back.counts().collect())
    held = lambda i: i.filters.agg(F.sum("n_keys")).first()[0]
    assert held(first) == held(back) == first.frequent().count()


def test_deleting_what_was_never_there_fails(spark, docs):
    index = L.LineIndex.empty(spark).insert(docs([(1, "a")]))
    with pytest.raises(Exception, match="never inserted"):
        index.delete(docs([(2, "b")]))


def test_many_shards_and_filters_that_overflow(spark, docs, monkeypatch):
    monkeypatch.setattr(L, "SHARD_KEYS", 8)
    first = [(i, f"a{i % 40}\nb{i % 25}") for i in range(200)]
    second = [(1000 + i, f"c{i % 900}\nb{i % 25}") for i in range(1800)]
    index = L.LineIndex.empty(spark, threshold=2).insert(docs(first))
    assert index.shards == 16
    monkeypatch.setattr(L, "SHARD_KEYS", 1000)      # the shards stay, their filters run over
    index = index.insert(docs(second))
    assert index.shards == 16 and index.filters.where("cells is null").isEmpty()
    assert cleaned(index, docs(first + second)) == plain(first + second, first + second, 2)


def test_without_room_for_the_filters(spark, docs):
    rows = texts(80, 7)
    index = L.LineIndex.empty(spark, threshold=3).insert(docs(rows))
    assert cleaned(index, docs(rows), filter_bytes=0) == cleaned(index, docs(rows)) == plain(rows, rows, 3)


def test_false_alarms_cost_no_line(spark, docs):
    rows = texts(80, 8)
    index = L.LineIndex.empty(spark, threshold=3).insert(docs(rows))
    alarmed = index.filters.collect()
    cells = np.frombuffer(bytes(alarmed[0]["cells"]), np.uint16).copy()
    full = spark.createDataFrame([(0, (np.arange(65536 * 4) % 65535 + 1).astype(np.uint16).tobytes(), len(cells))], L._FILTERS)
    noisy = L.LineIndex(spark, index.changes, full, 1, 3, 1)
    got = cleaned(noisy, docs(rows))
    want = plain(rows, rows, 3)
    assert all(g[3] <= w[3] for g, w in zip(got, want))


def test_hot_line_in_copies(spark, docs):
    rows = [(i, "same line\nown 1\n\n") for i in range(3000)] + [(i, f"same line \nown {i}") for i in range(3000, 3100)]
    index = L.LineIndex.empty(spark).insert(docs(rows).repartition(7))
    assert cleaned(index, docs(rows)) == plain(rows, rows, 10)


def test_odd_rows(spark, odd, docs):
    rows = [tuple(r)[:2] for r in odd.collect()]
    index = L.LineIndex.empty(spark, threshold=2).insert(odd)
    out = index.clean(odd)
    assert out.columns[:5] == odd.columns[:5] and out.first()["row"] == "clash"
    assert cleaned(index, odd) == plain(rows, rows, 2)
    empty = L.LineIndex.empty(spark).insert(docs([]))
    assert empty.clean(docs([])).collect() == []
    assert cleaned(empty, odd) == plain([], rows, 10)


def test_short_keys_stay(spark, docs):
    rows = [(i, "ab\nabc\n é é \n") for i in range(12)]
    index = L.LineIndex.empty(spark, min_chars=3).insert(docs(rows))
    assert cleaned(index, docs(rows)) == plain(rows, rows, 10, 3)
    with pytest.raises(ValueError):
        L.LineIndex.empty(spark, threshold=0)


def test_query_equals_sql(spark):
    name = "op11_cuckoo_line_dedup"
    n, problems = compare(spark, duck(SF01), name, E.queries()[name], E.oracle_sql()[name], SF01)
    assert n == 1000 and not problems, problems
