"""The vector search: recall against brute force, ties, hot lists, odd vectors."""

from llm_tables import SF01  # noqa: F401
import math

import numpy as np

from sluice.llm import posting_lists as A
from sluice.llm.common import prepare, table

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, vectors):
    prepare(spark)
    return spark.createDataFrame([(i, v, 0) for i, v in vectors], SCHEMA)


def brute(ids, x, every=20, k=20):
    x = np.asarray(x, dtype=np.float32).astype(np.float64)
    out = {}
    for i, q in zip(ids, x):
        if i % every == 0:
            s = (x * q).sum(axis=1)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in w}) / len(w) for q, w in want.items()])


def test_recall_on_the_given_table(spark):
    prepare(spark)
    df = table(spark, SF01, "embeddings")
    rows = df.collect()
    ids, x = np.array([r["vec_id"] for r in rows]), [r["embedding"] for r in rows]
    got, want = found(A.search(df, list_rows=16)), brute(ids, x)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.9
    exact = {q: dict(w) for q, w in want.items()}
    assert all(math.isclose(s, exact[q][i], rel_tol=1e-12) for q, w in got.items() for i, s in w if i in exact[q])


def test_lengths_differ_and_recall_holds(spark):
    """Inner product, not angle: long vectors win."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    x = (centres[rng.integers(0, 12, 3000)] + 0.4 * rng.normal(size=(3000, 16))) * rng.uniform(0.2, 3, (3000, 1))
    got = found(A.search(frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]), list_rows=64))
    assert recall(got, brute(np.arange(3000), x)) >= 0.9


def test_equal_vectors_rank_by_key_in_split_lists(spark, monkeypatch):
    monkeypatch.setattr(A, "CELL_ROWS", 50)
    rng = np.random.default_rng(2)
    one = rng.normal(size=8)
    x = np.array([one] * 300 + [rng.normal(size=8) * 0.2 for _ in range(300)])
    got = found(A.search(frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]), list_rows=64))
    assert [i for i, _ in got[0]] == list(range(1, 21)) and [i for i, _ in got[20]] == list(range(20))


def test_odd_vectors(spark):
    vectors = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]),
               (5, [float("inf"), 1.0]), (6, []), (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, [0.5, 0.5]), (8, [0.5, 0.5]),
               (20, [0.0, 1.0]), (40, None)]
    got = found(A.search(frame(spark, vectors)))
    assert got == {0: [(8, 0.5), (20, 0.0)], 20: [(8, 0.5), (0, 0.0)]}
    assert A.search(frame(spark, [])).collect() == []
    assert A.search(frame(spark, [(1, [1.0])])).collect() == []
    assert A.search(frame(spark, [(20, [1.0])])).collect() == []


def test_graph_search_finds_the_near_lists():
    rng = np.random.default_rng(3)
    sample = rng.normal(size=(4000, 12))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    index = A.fit(np.hstack([sample, np.zeros((4000, 1))]), 100, 1.0, 1)
    missed = total = 0
    for q in index.lift_queries(sample[:100]):
        lists, _ = index.search(q, 1.2)
        d = index.distances(q[None])[0]
        want = set(np.flatnonzero(d <= 1.2 * d.min()))
        missed, total = missed + len(want - set(lists.tolist())), total + len(want)
    assert missed <= 0.01 * total


def test_tight_clusters(spark):
    """More lists than a walk from a few entries could reach."""
    rng = np.random.default_rng(4)
    x = np.repeat(rng.normal(size=(200, 16)), 30, axis=0) + 0.001 * rng.normal(size=(6000, 16))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True))[rng.permutation(6000)]
    got = found(A.search(frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]), list_rows=2))
    want = brute(np.arange(6000), x)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.95


def test_a_third_of_equal_rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 8))
    x[::3] = x[0]
    got = found(A.search(frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]), list_rows=16))
    want = brute(np.arange(1500), x)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.9


def clustered(n, clusters, spread, seed, dim=16):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(clusters, dim))[rng.integers(0, clusters, n)] + spread * rng.normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def index_of(x, lists):
    return A.fit(np.hstack([x, np.zeros((len(x), 1))]), lists, 1.0, 1)


def test_every_centroid_can_be_reached():
    """Tight clusters far apart: neighbours alone would leave them separate."""
    index = index_of(clustered(6000, 150, 0.01, 6), 1200)
    assert len(np.unique(A._parts(index.graph))) == 1
    full = index.walk(index.points[:50], len(index.points))
    assert np.isfinite(full).all()
    assert np.allclose(full, index.distances(index.points[:50]))
    assert len(index.entries) < len(index.points) / 10


def test_walks_use_the_graph_and_meet_few_centroids(monkeypatch):
    x = clustered(8000, 60, 0.3, 7)
    index = index_of(x, 800)
    q = index.lift_queries(x[:200])
    exact = index.distances(q)

    def all_centroids(*_):
        raise AssertionError("a row was compared with all centroids")
    monkeypatch.setattr(A.Centroids, "distances", all_centroids)
    met = index.walk(q, A.BEAM)
    assert (met.argmin(axis=1) == exact.argmin(axis=1)).mean() > 0.99
    assert np.isfinite(met).mean() < 0.5
    near = index.near(q, 1.1)
    want = [np.flatnonzero(d <= 1.1 * d.min()) for d in exact]
    assert sum(len(np.intersect1d(a, b)) for a, b in zip(near, want)) >= 0.97 * sum(map(len, want))
    assert (index.file(q, 4, 1.15)[:, 0] == exact.argmin(axis=1)).mean() > 0.99
    cut = A.Centroids(index.points, index.norm, np.full((len(index.points), 1), -1), index.entries)
    assert np.isfinite(cut.walk(q, A.BEAM)).sum(axis=1).max() == len(index.entries)
    assert (cut.file(q, 4, 1.15)[:, 0] == exact.argmin(axis=1)).mean() < 0.5


def test_clustered_vectors_read_few_rows(spark):
    x = clustered(12_000, 100, 0.05, 8)
    index = index_of(x, 12_000 // 32)
    at = index.file(index.lift(x), 4, 1.15)
    rows = np.bincount(at[at >= 0], minlength=len(index.points))
    read = [rows[f].sum() for f in index.near(index.lift_queries(x[::60]), 1.3, rows, 21)]
    assert np.mean(read) < len(x) / 5
    got = found(A.search(frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]), every=60, list_rows=32))
    assert recall(got, brute(np.arange(len(x)), x, every=60)) >= 0.9


def test_registered_query_against_brute_force(spark):
    from sluice.llm.queries import op6_balanced_posting_lists
    rows = table(spark, SF01, "embeddings").collect()
    want = brute(np.array([r["vec_id"] for r in rows]), [r["embedding"] for r in rows])
    got = found(op6_balanced_posting_lists(spark, SF01))
    assert set(got) == set(want) and recall(got, want) >= 0.9


def test_a_query_is_handed_on_once_and_by_several_tasks(spark, monkeypatch):
    """Not once for each list it reads: most queries read many lists here."""
    kept = {}
    monkeypatch.setattr(A, "settle", lambda df, name, settle=A.settle: kept.setdefault(name, settle(df, name)))
    rng = np.random.default_rng(9)
    x = rng.normal(size=(4000, 24))
    got = found(A.search(frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]), every=4, list_rows=64))
    assert recall(got, brute(np.arange(4000), x, every=4)) >= 0.9
    assert kept["asks"].count() == 1000
    assert len(kept["asks"].inputFiles()) > 2


def test_groups_hold_neighbours_and_few_rows():
    points, rows = clustered(700, 20, 0.05, 10), np.random.default_rng(11).integers(0, 90, 700)
    group, place = A.grouped(points, rows, 1000)
    assert all(sorted(place[group == g]) == list(range((group == g).sum())) for g in range(group.max() + 1))
    assert np.bincount(group, weights=rows).max() <= 1000 and group.max() + 1 < 4 * rows.sum() / 1000
    assert A.grouped(points[:1], rows[:1], 0)[0].tolist() == [0]


def test_hits_of_a_cell_are_those_of_its_lists(spark, monkeypatch):
    """Repeated rows, rows of several lists and equal scores, in blocks of few scores."""
    monkeypatch.setattr(A, "SCORES", 500)
    monkeypatch.setattr(A, "HELD_HITS", 300)
    rng = np.random.default_rng(12)
    x, ids = np.round(rng.normal(size=(400, 3)), 1), rng.permutation(400)
    at = np.concatenate([np.arange(400), np.repeat(rng.integers(0, 400, 9), 30), rng.integers(0, 400, 300)])
    place = np.sort(rng.integers(0, 12, len(at))).astype(np.int32)
    cell = A._Cell([A.pa.RecordBatch.from_pydict({"place": A.pa.array(place), "vec_id": A.pa.array(ids[at]),
                                                  "vector": A.pa.array(x[at].tolist())})])
    bits = (rng.random((60, 12)) < 0.5).astype(np.uint8)
    for k in (3, 20):
        got = cell.nearest(ids[:60], x[:60], bits, k).to_pylist()
        assert [r["query_id"] for r in got] == ids[:60].tolist()
        for r in got:
            i = int(np.flatnonzero(ids[:60] == r["query_id"])[0])
            rows = {(-(x[j] * x[i]).sum(), int(ids[j])) for j, p in zip(at, place) if bits[i, p] and j != i}
            assert [(h["away"], h["vec_id"]) for h in r["hits"]] == sorted(rows)[:k]


def test_a_near_list_after_a_far_one_gives_few_hits(monkeypatch):
    """All rows of the second list are nearer than the best of the first."""
    merged, sizes = A._merged, []
    monkeypatch.setattr(A, "_merged", lambda held, k: sizes.append(sum(len(h[0]) for h in held)) or merged(held, k))
    rng = np.random.default_rng(13)
    x = np.vstack([rng.uniform(0, 1, (500, 4)), rng.uniform(2, 3, (3000, 4))])
    place = np.repeat([0, 1], [500, 3000]).astype(np.int32)
    cell = A._Cell([A.pa.RecordBatch.from_pydict({"place": A.pa.array(place), "vec_id": A.pa.array(np.arange(3500)),
                                                  "vector": A.pa.array(x.tolist())})])
    q = rng.uniform(1, 2, (50, 4))
    got = cell.nearest(np.arange(50) + 9000, q, np.ones((50, 2), np.uint8), 20).to_pylist()
    want = np.argsort(-q @ x.T, axis=1, kind="stable")[:, :20]
    assert [[h["vec_id"] for h in r["hits"]] for r in got] == want.tolist()
    assert max(sizes) <= 50 * 20 * 6


def test_the_sample_is_that_of_the_whole_order(spark):
    rows = frame(spark, [(i % 4500, [float(i), 1.0]) for i in range(5000)]).selectExpr("vec_id", "embedding as vector")
    ids = lambda t: sorted(t.column("vec_id").to_pylist())
    by = A.F.xxhash64(A.F.lit(6), "vec_id")
    assert ids(A._picked(rows, 5000, 100, 6)) == ids(rows.orderBy(by, "vec_id").limit(100).toArrow())
    one = rows.select(A.F.lit(7).cast("long").alias("vec_id"), "vector")
    assert A._picked(one, 5000, 100, 6).num_rows == 100
