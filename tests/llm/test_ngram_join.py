"""The Jaccard join against all pairs of full n-gram sets."""

from llm_tables import SF01, docs, odd  # noqa: F401
import random

import duckdb
import numpy as np
import pytest

from sluice.llm import ngram_join as J
from sluice.llm.common import prepare, table


def sets_of(texts, n=5):
    out = {}
    for i, t in texts.items():
        w = (t or "").encode().split()
        if w:
            out[i] = frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1)))
    return out


def brute(texts, threshold=0.8):
    """class id and links of every key, over all pairs."""
    sets = sets_of(texts)
    links = {i: set() for i in texts}
    keys = sorted(sets)
    for a, i in enumerate(keys):
        for j in keys[a + 1:]:
            both = len(sets[i] & sets[j])
            if both and both >= threshold * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                links[i].add(j)
                links[j].add(i)
    out = {}
    for i in sorted(texts):
        if i not in out:
            todo, seen = [i], {i}
            while todo:
                for k in links[todo.pop()] - seen:
                    seen.add(k)
                    todo.append(k)
            out.update({k: i for k in seen})
    return {i: (out[i], len(links[i])) for i in texts}


def found(df):
    return {r["doc_id"]: (r["class_id"], r["n_links"]) for r in df.collect()}


def test_whole_table_equals_all_pairs(spark):
    prepare(spark)
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF01}/documents.parquet'").fetchall())
    assert found(J.classes(table(spark, SF01, "documents"))) == brute(texts)


def near_copies(seed, base_words, copies, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(base_words)]
    out = []
    for _ in range(copies):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_large_group_is_cut_in_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_NODES", 16)
    texts = dict(enumerate(near_copies(1, 120, 90, 3) + near_copies(2, 60, 20, 2) + ["lone text " + str(i) for i in range(30)]))
    assert found(J.classes(docs(list(texts.items())))) == brute(texts)


def test_copies_count_but_do_not_multiply(docs):
    text = "one two three four five six seven"
    got = found(J.classes(docs([(i, text) for i in range(300)] + [(300, text + "  ")])))
    assert set(got.values()) == {(0, 300)}


def test_odd_rows(odd):
    rows = J.classes(odd).collect()
    assert len(rows) == 10
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append((r["class_id"], r["n_links"]))
    assert by[1] == [(1, 0)] and by[2] == [(2, 0)] and by[3] == [(3, 0)]
    assert by[6] == [(6, 1), (6, 1)] and by[None] == [(None, 0)]


def test_one_per_class_keeps_the_smallest_and_all_columns(docs, odd):
    texts = near_copies(3, 100, 6, 2)
    df = docs([(20 + i, t) for i, t in enumerate(texts)] + [(3, texts[0]), (50, "something else entirely here now ok")])
    kept = J.one_per_class(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 50]
    kept = J.one_per_class(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "5", "6", "7", "8", "None"]


def test_null_keys_lose_no_text(docs):
    df = docs([(None, "first text of five words"), (None, "second text with other words"), (None, "second text with other words")])
    assert sorted(r["text"] for r in J.one_per_class(df).collect()) == ["first text of five words", "second text with other words"]


def test_empty_table(docs):
    assert J.classes(docs([])).collect() == [] and J.one_per_class(docs([])).collect() == []


def test_banding_meets_its_recall():
    bands, rows = J.bands_for(0.8, 0.9999, 128)
    assert bands * rows <= 128 and 1 - (1 - 0.8 ** rows) ** bands >= 0.9999
    with pytest.raises(ValueError):
        J.bands_for(0.05, 0.9999, 8)
    rng, hits = np.random.default_rng(0), 0
    for _ in range(200):  # pairs right at 0.8
        pool = rng.integers(0, 2**63, 90, dtype=np.uint64)
        a, b = np.sort(pool[:85]), np.sort(np.concatenate([pool[:80], pool[85:]]))
        hits += bool(set(J.band_hashes(a, bands, rows, 9)) & set(J.band_hashes(b, bands, rows, 9)))
    assert hits == 200


def test_a_row_repeated_often_is_held_once(docs, monkeypatch):
    """Thousands of equal rows beside near copies: links count them all, cells hold one, the shuffle sees one a task."""
    near = near_copies(5, 80, 6, 2)
    df = docs([(1, near[0])] * 3000 + [(i, t) for i, t in enumerate(near[1:], 2)] + [(90, None)] * 5)
    rows = J.classes(df).collect()
    assert len(rows) == 3010
    want, near_1 = brute(dict(enumerate(near, 1))), brute({**dict(enumerate(near, 1)), 0: near[0]})
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in rows if r["doc_id"] != 90}
    assert got[1] == (1, want[1][1] + 2999) and want[1][1] > 0
    for i, (c, n) in want.items():  # each link with the repeated row counts for all its repeats
        assert i == 1 or got[i] == (c, n + 2999 * (near_1[i][1] - n))
    kept = J.one_per_class(df)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for c, _ in want.values()}) + [90] * 5


def test_texts_are_fetched_once_per_row_key(docs, monkeypatch):
    """What a cell gets holds each node once, before the n-gram sets are made."""
    seen = []
    real = J.settle
    monkeypatch.setattr(J, "settle", lambda df, name: (seen.append((name, df._jdf.queryExecution().executedPlan().toString())), real(df, name))[1])
    J.classes(docs([(1, "a b c d e f g")] * 50 + [(2, "a b c d e f g h i j k l m n o p"), (3, "a b c d e f g h i j k l m n o p q")]))
    plan = dict(seen)["links"]
    assert "partial_first(text" in plan
