"""Approximate nearest neighbours by largest inner product, on balanced posting
lists.

Vectors are lifted by one component to a common norm, where the largest inner
product is the smallest distance. Centroids are fitted to a bounded sample by
k-means with a penalty on large clusters. Every vector is filed under its
nearest centroid and, if it lies on a boundary, under up to ``replicas`` in
all. Centroids are found by an in-memory graph of them: a beam of the nearest
ones seen so far is widened node by node. Its components are linked, and what
could not be reached from the entries is an entry itself, so every centroid can
be found. A query reads the lists whose distance is within a ratio of the
nearest one's, and further ones until they hold ``k`` rows. Ratio and beam are
measured, not guessed: sample queries are compared with all rows, and walk the
graph as all others do; the beam is doubled until it finds the lists of their
true neighbours, and the ratio is the one at which the lists read hold
``recall`` of them.

Neighbouring lists form groups, and a query goes to a group once, with the lists
it reads there; groups that are still large, or asked by very many queries, are
split into cells that are searched side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

#: Rows per list aimed at, bounds of the fitted sample, of the lists and of the measured queries.
LIST_ROWS, SAMPLE_ROWS, MOST_LISTS, MEASURED = 256, 50_000, 16_384, 64
#: Neighbours of a centroid in the graph (as many again may lead to it), entries
#: of a walk beside those that keep all centroids reachable, and the beam of a walk.
DEGREE, ENTRIES, BEAM = 16, 64, 32
#: A cell of a group of lists holds about this many vectors or queries at most, and
#: bytes of vectors; the lists make about so many groups, if these have rows enough.
CELL_ROWS, CELL_BYTES, GROUPS, GROUP_ROWS = 50_000, 64_000_000, 48, 1024
#: Hits a task holds before it merges those of one query, queries that it searches
#: together, and how many of their scores it has at a time.
HELD_HITS, ASKED_ROWS, SCORES = 500_000, 2048, 1_000_000


@dataclass(frozen=True)
class Centroids:
    """What the tasks get: bounded by the parameters, not by the table."""
    points: np.ndarray
    norm: float
    graph: np.ndarray | None = None      # neighbours of each centroid, -1 where it has fewer
    entries: np.ndarray | None = None

    def lift(self, x: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.norm ** 2 - (x * x).sum(axis=1), 0)
        return np.hstack([x, np.sqrt(rest)[:, None]])

    def lift_queries(self, q: np.ndarray) -> np.ndarray:
        size = np.sqrt((q * q).sum(axis=1, keepdims=True))
        return np.hstack([q * (self.norm / size), np.zeros((len(q), 1))])

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Distances to all centroids, with a floor below which rounding decides."""
        c = self.points
        return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * x @ c.T,
                                  (1e-6 * self.norm) ** 2))

    def walk(self, q: np.ndarray, beam: int) -> np.ndarray:
        """Distances of each (lifted) row to the centroids that a walk through
        the graph meets, infinite for all others. A walk ends when the ``beam``
        nearest centroids it has met are all expanded."""
        n, floor = len(self.points), (1e-6 * self.norm) ** 2
        met = np.full((len(q), n), np.inf)
        start = self.points[self.entries]
        square = (q * q).sum(axis=1)[:, None] + (start * start).sum(axis=1) - 2 * q @ start.T
        met[:, self.entries] = np.sqrt(np.maximum(square, floor))
        keep, degree = min(max(beam, 1), n), self.graph.shape[1]
        # The open nodes of each row, unsorted. Those behind ``keep`` others are never expanded.
        ids = np.zeros((len(q), keep + max(8 * degree, keep)), dtype=np.int64)
        gaps, used = np.full(ids.shape, np.inf), 0

        def room(columns: int) -> int:
            if used + columns <= ids.shape[1]:
                return used
            near = np.argpartition(gaps, keep - 1, axis=1)[:, :keep]
            ids[:, :keep], gaps[:, :keep] = np.take_along_axis(ids, near, 1), np.take_along_axis(gaps, near, 1)
            gaps[:, keep:] = np.inf
            return keep

        for part in np.array_split(self.entries, -(-len(self.entries) // degree)):
            used = room(len(part))
            ids[:, used:used + len(part)], gaps[:, used:used + len(part)] = part, met[:, part]
            used += len(part)
        rows, spent, steps = np.arange(len(q)), np.empty((len(q), keep + degree)), 0
        while True:
            at = np.arange(len(rows))
            best = gaps[:, :used].argmin(axis=1)
            gap = gaps[at, best]
            live = np.isfinite(gap)
            if steps >= keep:   # all that is nearer than the nearest open node has been expanded
                live &= (spent[:, :steps] < gap[:, None]).sum(axis=1) < keep
            if not live.all():
                ids, gaps, spent, rows, best, gap = (v[live] for v in (ids, gaps, spent, rows, best, gap))
                at = np.arange(len(rows))
            if not len(rows):
                return met
            if steps == spent.shape[1]:
                spent = np.hstack([spent, np.empty_like(spent)])
            spent[:, steps], steps = gap, steps + 1
            next_ = self.graph[ids[at, best]]
            gaps[at, best] = np.inf
            new = (next_ >= 0) & np.isinf(met[rows[:, None], next_])
            r, c = np.nonzero(new)
            if not len(r):
                continue
            node = next_[r, c]
            away = self.points[node] - q[rows[r]]
            d = np.sqrt(np.maximum(np.einsum("md,md->m", away, away), floor))
            met[rows[r], node] = d
            place = new.cumsum(axis=1)
            most = int(place[:, -1].max())
            used = room(most)
            column = used + place[r, c] - 1
            ids[r, column], gaps[r, column] = node, d
            used += most

    def file(self, x: np.ndarray, replicas: int, ratio: float) -> np.ndarray:
        """Lists of each (lifted) vector, -1 where it needs no further replica."""
        d = self.walk(x, BEAM)
        k = min(replicas, d.shape[1])
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        near = np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, 1), axis=1, kind="stable"), 1)
        gap = np.take_along_axis(d, near, 1)
        return np.where(np.isfinite(gap) & (gap <= ratio * gap[:, :1] + 1e-12), near, -1)

    def near(self, q: np.ndarray, ratio: float, rows: np.ndarray | None = None, least: int = 0,
             beam: int = BEAM) -> list[np.ndarray]:
        """Lists of each lifted query that a walk meets within ``ratio`` of the
        nearest one's distance, and as many more as hold ``least`` of the
        ``rows`` filed there first; the beam is doubled for queries that lack them."""
        d = self.walk(q, beam)
        reach = ratio * d.min(axis=1, keepdims=True)
        if least and rows is not None:
            wider = beam
            while True:
                held = np.where(np.isfinite(d), rows, 0).sum(axis=1)
                few = np.flatnonzero(held < least)
                if not len(few) or wider >= d.shape[1]:
                    break
                wider *= 2
                d[few] = self.walk(q[few], wider)
            few = np.flatnonzero(np.where(d <= reach, rows, 0).sum(axis=1) < least)
            order = np.argsort(d[few], axis=1, kind="stable")
            at = np.minimum((np.cumsum(rows[order], axis=1) < least).sum(axis=1), np.isfinite(d[few]).sum(axis=1) - 1)
            enough = np.take_along_axis(d[few], np.take_along_axis(order, at[:, None], 1), 1)
            reach[few] = np.maximum(reach[few], enough)
        return [np.flatnonzero(r) for r in np.isfinite(d) & (d <= reach * (1 + 1e-9))]

    def search(self, q: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """Lists within ``ratio`` of the nearest one's distance to one lifted
        query, with their distances."""
        lists = self.near(q[None], ratio, beam=len(self.points))[0]
        return lists, self.distances(q[None])[0, lists]


def _parts(graph: np.ndarray) -> np.ndarray:
    """Number of the connected part of each node, edges taken both ways."""
    part = np.arange(len(graph))
    a, c = np.nonzero(graph >= 0)
    b = graph[a, c]
    while True:
        low = np.minimum(part[a], part[b])
        new = part.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == part).all():
            return part
        part = new


def _blocks(n: int) -> list[np.ndarray]:
    return np.array_split(np.arange(n), max(1, n * n // 4_000_000))


def linked(points: np.ndarray, norm: float, seed: int) -> Centroids:
    """The centroids with their graph: the nearest neighbours of each and the
    nearest of those it is a neighbour of; the nearest nodes of two separate
    parts are joined until there is one part. Works on centroids only."""
    n, rng = len(points), np.random.default_rng(seed)
    size = (points * points).sum(axis=1)
    degree = max(1, min(DEGREE, n - 1))
    out = np.full((n, degree), -1)
    for rows in _blocks(n) if n > 1 else []:
        d = size - 2 * points[rows] @ points.T
        d[np.arange(len(rows)), rows] = np.inf
        near = np.argpartition(d, degree - 1, axis=1)[:, :degree]
        out[rows] = np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, 1), axis=1, kind="stable"), 1)
    edges = {(int(a), int(b)) for a in range(n) for b in out[a] if b >= 0}
    back = [[] for _ in range(n)]
    for a, b in edges:
        if (b, a) not in edges:
            back[b].append(a)
    for b, from_ in enumerate(back):
        if len(from_) > degree:   # hubs keep the nearest of many
            from_ = np.array(from_)[np.argsort(((points[from_] - points[b]) ** 2).sum(axis=1), kind="stable")[:degree]]
        edges.update((b, int(a)) for a in from_)
    while True:
        graph = _padded(edges, n)
        part = _parts(graph)
        if (part == part[0]).all():
            break
        best = {}
        for rows in _blocks(n):
            d = size - 2 * points[rows] @ points.T + size[rows][:, None]
            d[part[rows][:, None] == part[None, :]] = np.inf
            for i, j in zip(rows, d.argmin(axis=1)):
                gap = d[i - rows[0], j]
                if gap < best.get(part[i], (np.inf,))[0]:
                    best[part[i]] = (gap, int(i), int(j))
        for _, i, j in best.values():
            edges |= {(i, j), (j, i)}
    entries = np.sort(rng.choice(n, min(n, ENTRIES), replace=False))
    reached = np.zeros(n, bool)
    while True:
        front = entries[~reached[entries]]
        while len(front):
            reached[front] = True
            front = np.unique(graph[front])
            front = front[front >= 0]
            front = front[~reached[front]]
        if reached.all():
            return Centroids(points, norm, graph, entries)
        entries = np.append(entries, np.flatnonzero(~reached)[0])


def _padded(edges: set[tuple[int, int]], n: int) -> np.ndarray:
    lists = [[] for _ in range(n)]
    for a, b in sorted(edges):
        lists[a].append(b)
    graph = np.full((n, max(1, max(map(len, lists)))), -1)
    for a, to in enumerate(lists):
        graph[a, :len(to)] = to
    return graph


def fit(sample: np.ndarray, lists: int, norm: float, seed: int, rounds: int = 10) -> Centroids:
    """Balanced k-means on a lifted sample; centroids that coincide are merged."""
    rng = np.random.default_rng(seed)
    lists = max(1, min(lists, len(sample)))
    points = sample[np.sort(rng.choice(len(sample), lists, replace=False))].copy()
    fair, load = len(sample) / lists, np.zeros(lists)
    for _ in range(rounds):
        half = (points * points).sum(axis=1) / 2
        spread = max(1e-12, float(np.mean(half))) * 0.02
        own = np.concatenate([np.argmin(half - part @ points.T + spread * np.maximum(load / fair - 1, 0), axis=1)
                              for part in np.array_split(sample, max(1, len(sample) * lists // 4_000_000))])
        load = np.bincount(own, minlength=lists).astype(float)
        total = np.zeros_like(points)
        np.add.at(total, own, sample)
        points = np.where(load[:, None] > 0, total / np.maximum(load, 1)[:, None], points)
    _, first = np.unique(np.round(points / max(norm * 1e-6, 1e-300)), axis=0, return_index=True)
    return linked(points[np.sort(first)], norm, seed)


def usable(vector: Column) -> Column:
    """Neither null, empty, zero nor with a null or non-finite component."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def nearest(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ids and exact scores of the k best rows of ``x`` for each query but its
    own, ties to the smaller id."""
    out = []
    for rows in np.array_split(np.arange(len(q)), max(1, len(q) * len(x) // 4_000_000)):
        rough = q[rows] @ x.T
        rough[q_ids[rows][:, None] == x_ids[None, :]] = -np.inf
        for i, r in zip(rows, rough):
            cut = np.partition(r, len(r) - k)[len(r) - k] if len(r) > k else -np.inf
            some = np.flatnonzero((r >= cut - 1e-9 * (1 + abs(cut))) & (r > -np.inf) if np.isfinite(cut) else r > -np.inf)
            # Row by row sums are the same wherever a vector stands, unlike those of a matrix product.
            exact = (x[some] * q[i]).sum(axis=1)
            order = np.lexsort((x_ids[some], -exact))
            ids, scores = x_ids[some][order], exact[order]
            keep = np.concatenate([[True], ids[1:] != ids[:-1]]) if len(ids) else np.empty(0, bool)
            out.append((ids[keep][:k], scores[keep][:k]))
    return out


def _merge(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    ids, scores = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    first = np.sort(np.unique(ids, return_index=True)[1])[:k]
    return ids[first], scores[first]


_HITS = "query_id long, hits array<struct<away: double, vec_id: long>>"


def _hits(q: np.ndarray, away: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """One row for each query, whose hits stand together."""
    starts = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])[:len(q)])
    hits = pa.StructArray.from_arrays([pa.array(away, pa.float64()), pa.array(ids, pa.int64())], ["away", "vec_id"])
    ends = pa.array(np.append(starts, len(q)), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(q[starts], pa.int64()), pa.ListArray.from_arrays(ends, hits)],
                                      ["query_id", "hits"])


def _merged(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, distance and id of the k nearest different hits of each query, in order."""
    q, away, ids = (np.concatenate(c) for c in zip(*held))
    order = np.lexsort((ids, away, q))
    q, away, ids = q[order], away[order], ids[order]
    new = np.concatenate([[True], (q[1:] != q[:-1]) | (away[1:] != away[:-1]) | (ids[1:] != ids[:-1])])[:len(q)]
    q, away, ids = q[new], away[new], ids[new]
    starts = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])[:len(q)])
    rank = np.arange(len(q)) - np.repeat(starts, np.diff([*starts, len(q)]))
    return q[rank < k], away[rank < k], ids[rank < k]


def _best(hits: DataFrame, k: int) -> DataFrame:
    """``query_id, hits``: the k nearest of all partial lists of a query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, most = [], 0, HELD_HITS
        for batch in batches:
            hits, counts = batch.column("hits").flatten(), batch.column("hits").value_lengths().to_numpy()
            held.append((np.repeat(batch.column("query_id").to_numpy(), counts),
                         hits.field("away").to_numpy(), hits.field("vec_id").to_numpy()))
            n += len(held[-1][0])
            if n > most:
                held = [_merged(held, k)]
                n = len(held[0][0])
                most = max(HELD_HITS, 2 * n)
        if n:
            yield _hits(*_merged(held, k))

    return hits.repartition("query_id").mapInArrow(run, _HITS)


def brute_force(rows: DataFrame, q: np.ndarray, q_ids: np.ndarray, k: int) -> DataFrame:
    """``query_id, hits`` over all ``rows(vec_id, vector)`` for a few queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: list | None = None
        for batch in batches:
            x, ids = _matrix(batch.column("vector")), batch.column("vec_id").to_numpy()
            found = nearest(q, q_ids, x, ids, k)
            if top is not None:
                found = [_merge(a, b, k) for a, b in zip(top, found)]
            top = found
        if top is not None:
            yield _hits(np.repeat(q_ids, [len(ids) for ids, _ in top]), -np.concatenate([s for _, s in top]),
                        np.concatenate([ids for ids, _ in top]))

    return _best(rows.select("vec_id", "vector").mapInArrow(run, _HITS), k)


def search(embeddings: DataFrame, every: int = 20, k: int = 20, key: str = "vec_id", vector: str = "embedding",
           replicas: int = 4, boundary: float = 1.15, recall: float = 0.97, seed: int = 6,
           list_rows: int = LIST_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found for every
    row whose key is divisible by ``every``; the key must be a whole number.

    ``score`` is the inner product of the original vectors in double precision.
    Fitted on at most ``SAMPLE_ROWS`` rows, measured on at most ``MEASURED``
    queries; every row is indexed.

    Defined cases: rows whose vector is unusable (see ``usable``), has another
    length than most, or whose key is null take no part; rows that repeat key
    and vector are one candidate, and a key asked with several vectors asks
    with the smallest; equal vectors rank by key; with fewer than
    ``k`` candidates all are returned; an empty table gives no rows. Other
    columns are ignored.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("n")).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("vec_id") % every == 0).alias("asked"),
        F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))).alias("norm2"))
    most = lengths.orderBy(F.desc("rows"), "n").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if most is None:
        return empty
    rows = rows.filter(F.size("vector") == most["n"])
    norm = float(np.sqrt(most["norm2"]))
    lists = min(MOST_LISTS, -(-most["rows"] // list_rows))
    picked = _picked(rows, most["rows"], min(SAMPLE_ROWS, 256 * lists), seed)
    sample = _matrix(picked.column("vector").combine_chunks())
    lifted = Centroids(np.empty((0, 0)), norm).lift(sample)
    index = spark.sparkContext.broadcast(fit(lifted, lists, norm, seed))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = index.value.file(index.value.lift(_matrix(batch.column("vector"))), replicas, boundary)
                row, column = np.nonzero(at >= 0)
                take = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at[row, column].astype(np.int32)), take.column("vec_id"), take.column("vector"),
                     pa.array(column == 0)], ["list", "vec_id", "vector", "first"])

    kind = rows.schema["vector"].dataType.simpleString()
    postings = settle(rows.mapInArrow(post, f"list int, vec_id long, vector {kind}, first boolean"), "postings")
    held, filed = np.zeros((2, len(index.value.points)), dtype=np.int64)
    each = postings.groupBy("list", "vec_id").agg(F.count("*").alias("rows"), F.max("first").alias("first"))
    for r in each.groupBy("list").agg(F.count_if("first").alias("held"), F.sum("rows").alias("rows")).collect():
        held[r["list"]], filed[r["list"]] = r["held"], r["rows"]

    asked = rows.filter(F.col("vec_id") % every == 0)
    measured = asked.orderBy(F.xxhash64(F.lit(seed + 1), "vec_id"), "vec_id").limit(MEASURED).toArrow()
    if not measured.num_rows:
        return empty
    q, q_ids = _matrix(measured.column("vector").combine_chunks()), measured.column("vec_id").to_numpy()
    truth = brute_force(rows, q, q_ids, k).select("query_id", F.explode("hits.vec_id").alias("true_id"))
    where = (postings.select("list", "vec_id").join(F.broadcast(truth), F.col("vec_id") == F.col("true_id"))
             .groupBy("query_id", "vec_id").agg(F.collect_set("list").alias("lists")).collect())
    ratio, beam = _ratio(index.value, q, q_ids, where, recall)

    # A group of lists goes to a task at once; each query goes there with a bit for each of its lists.
    most_rows = max(1, min(CELL_ROWS, CELL_BYTES // (8 * most["n"]), max(GROUP_ROWS, int(filed.sum()) // GROUPS)))
    group, place = grouped(index.value.points, filed, most_rows)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lifted = index.value.lift_queries(_matrix(batch.column("vector")))
                found = index.value.near(lifted, ratio, held, k + 1, beam)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("vector"), _bits(found, group, place)],
                    ["vec_id", "vector", "asks"])

    asked = (asked.repartition(-(-most["asked"] // 256), "vec_id").groupBy("vec_id").agg(F.min("vector").alias("vector")))
    asks = settle(asked.mapInArrow(ask, f"vec_id long, vector {kind}, asks {_ASKS}"), "asks")

    # Cells: a group's vectors in n_v parts, its queries in n_q parts, and each pair of parts together.
    n_q = np.zeros(group.max() + 1, dtype=np.int64)
    for r in asks.select(F.explode("asks.at").alias("at")).groupBy("at").count().collect():
        n_q[r["at"]] = -(-r["count"] // CELL_ROWS)
    n_v = -(-np.bincount(group, weights=filed).astype(np.int64) // most_rows)
    columns = {"n_v": n_v.astype(np.int32), "n_q": n_q.astype(np.int32)}
    groups = spark.createDataFrame(pa.table({"group": np.arange(len(n_v), dtype=np.int32), **columns}))
    spots = spark.createDataFrame(pa.table({"spot": np.arange(len(group), dtype=np.int32), "group": group, "place": place,
                                            **{name: column[group] for name, column in columns.items()}}))
    part = lambda own: F.pmod(F.xxhash64("vec_id"), F.col(own)).cast("int")
    every_other = lambda other: F.explode(F.sequence(F.lit(0), F.col(other) - 1))
    vectors = (postings.join(F.broadcast(spots.filter("n_q > 0")), F.col("list") == F.col("spot"))
               .select("group", part("n_v").alias("c_v"), every_other("n_q").alias("c_q"), F.lit(False).alias("is_query"),
                       "place", "vec_id", "vector", F.lit(None).cast("binary").alias("bits")))
    queries = (asks.select("vec_id", "vector", F.inline("asks")).join(F.broadcast(groups.filter("n_v > 0")), F.col("at") == F.col("group"))
               .select("group", every_other("n_v").alias("c_v"), part("n_q").alias("c_q"), F.lit(True).alias("is_query"),
                       F.lit(0).alias("place"), "vec_id", "vector", "bits"))
    cell = ["group", "c_v", "c_q"]
    hits = (vectors.union(queries).repartition(max(1, 4 * int((n_v * n_q).sum())), *cell)
            .sortWithinPartitions(*cell, "is_query", "place").mapInArrow(_search_cells(k), _HITS))
    best = _best(hits, k).select("query_id", F.posexplode("hits").alias("pos", "hit"))
    return best.select("query_id", (F.col("pos") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                       (-F.col("hit.away")).alias("score"))


def _picked(rows: DataFrame, n: int, most: int, seed: int) -> pa.Table:
    """The ``most`` of ``n`` rows whose keys come first by a hash. What is far
    behind them is left out before they are sorted, unless too few remain."""
    by = F.xxhash64(F.lit(seed), "vec_id")
    share = (most + 10 * most ** 0.5 + 100) / n
    if share < 0.9:
        near = rows.filter(by < int(-2 ** 63 + share * 2 ** 64)).orderBy(by, "vec_id").limit(most).toArrow()
        if near.num_rows == most:
            return near
    return rows.orderBy(by, "vec_id").limit(most).toArrow()


def grouped(points: np.ndarray, rows: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Group of each list and its place there: halves of neighbours are halved
    until a group holds at most ``most`` of the ``rows``, or one list."""
    group, place = np.zeros((2, len(points)), dtype=np.int32)
    todo, n = [np.arange(len(points))], 0
    while todo:
        some = todo.pop()
        if len(some) == 1 or rows[some].sum() <= most:
            group[some], place[some] = n, np.arange(len(some))
            n += 1
            continue
        x = points[some] - points[some].mean(axis=0)
        some = some[np.argsort(x @ x[(x * x).sum(axis=1).argmax()], kind="stable")]
        total = np.cumsum(rows[some])
        half = min(max(int(np.searchsorted(total, total[-1] / 2)), 1), len(some) - 1)
        todo += [some[:half], some[half:]]
    return group, place


_ASKS = "array<struct<at: int, bits: binary>>"


def _bits(found: list[np.ndarray], group: np.ndarray, place: np.ndarray) -> pa.Array:
    """For each query its groups, and in each a bit for every list it reads there."""
    groups = int(group.max()) + 1
    width = np.bincount(group, minlength=groups) // 8 + 1
    row, lists = np.repeat(np.arange(len(found)), [len(f) for f in found]), np.concatenate(found)
    pairs, own = np.unique(row * groups + group[lists], return_inverse=True)
    ends = np.concatenate([[0], np.cumsum(width[pairs % groups])])
    bits = np.zeros(ends[-1], dtype=np.uint8)
    np.bitwise_or.at(bits, ends[own] + place[lists] // 8, (1 << place[lists] % 8).astype(np.uint8))
    asks = pa.StructArray.from_arrays(
        [pa.array((pairs % groups).astype(np.int32)), pa.Array.from_buffers(
            pa.binary(), len(pairs), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(bits)])], ["at", "bits"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(pairs // groups, np.arange(len(found) + 1)), pa.int32()), asks)


def _ratio(index: Centroids, q: np.ndarray, q_ids: np.ndarray, where: list, recall: float) -> tuple[float, int]:
    """The distance ratio up to which lists must be read, so that ``recall`` of
    the measured queries' true neighbours stand in one of them, and the beam
    with which a walk meets these lists."""
    row = {int(i): n for n, i in enumerate(q_ids)}
    lifted, beam = index.lift_queries(q), BEAM
    while True:
        d = index.walk(lifted, beam)
        d = d / d.min(axis=1, keepdims=True)
        need = [d[row[r["query_id"]], r["lists"]].min() for r in where if r["query_id"] in row]
        ratio = float(np.quantile(need, recall, method="higher")) * (1 + 1e-6) if need else 1.0
        if np.isfinite(ratio) or beam >= len(index.points):
            return ratio, beam
        beam *= 2


def _below(cut: np.ndarray, slack: np.ndarray) -> np.ndarray:
    """What rough scores must reach, so that no exact score of ``cut`` or more is left out."""
    return np.where(np.isfinite(cut), cut - 1e-9 * (1 + np.abs(cut)) - slack, np.finfo(float).min)


class _Cell:
    """The vectors of a cell, list by list; a row that repeats in a list is one candidate."""

    def __init__(self, held: list[pa.RecordBatch]):
        cell = pa.Table.from_batches(held).combine_chunks()
        place, self.ids = cell.column("place").to_numpy(), cell.column("vec_id").to_numpy()
        self.x = _matrix(cell.column("vector").combine_chunks())
        order = np.lexsort((self.ids, place))
        if ((np.diff(place[order]) == 0) & (np.diff(self.ids[order]) == 0)).any():
            rows = np.column_stack([place.astype(np.float64), self.ids.view(np.float64), self.x])
            first = np.sort(np.unique(rows.view(np.dtype((np.void, 8 * rows.shape[1]))).ravel(), return_index=True)[1])
            place, self.ids, self.x = place[first], self.ids[first], self.x[first]
        self.starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        self.ends, self.places = np.append(self.starts[1:], len(place)), place[self.starts]
        self.by_id = np.argsort(self.ids, kind="stable")
        self.size = np.sqrt((self.x * self.x).sum(axis=1).max())

    def own(self, q_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of a query and of a vector for all pairs of one key, by vector."""
        ids = self.ids[self.by_id]
        low, high = np.searchsorted(ids, q_ids, "left"), np.searchsorted(ids, q_ids, "right")
        n = high - low
        row = np.repeat(np.arange(len(q_ids)), n)
        at = self.by_id[np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
        order = np.argsort(at, kind="stable")
        return row[order], at[order]

    def nearest(self, q_ids: np.ndarray, q: np.ndarray, bits: np.ndarray, k: int) -> pa.RecordBatch:
        """The k best rows of each query but its own, of the lists that it reads.

        List by list, a query takes what is not behind the k best it has; the
        best are merged after 1, 2, 4, 8 ... lists."""
        last, held, n = np.full(len(q), -np.inf), [], 0   # last: score of the k-th best so far
        slack = 1e-12 * self.size * np.sqrt((q * q).sum(axis=1))
        own_row, own_at = self.own(q_ids)
        for step, (place, a, z) in enumerate(zip(self.places, self.starts, self.ends), 1):
            asked = np.flatnonzero(bits[:, place])
            mine = slice(*np.searchsorted(own_at, [a, z]))
            for rows in np.array_split(asked, min(len(asked), -(-len(asked) * int(z - a) // SCORES))) if len(asked) else []:
                rough = q[rows] @ self.x[a:z].T
                at = np.minimum(np.searchsorted(rows, own_row[mine]), len(rows) - 1)
                here = rows[at] == own_row[mine]
                rough[at[here], own_at[mine][here] - a] = -np.inf
                cut, first = last[rows], np.flatnonzero(np.isinf(last[rows]))
                if len(first) and z - a > k:
                    cut[first] = np.partition(rough[first], z - a - k, axis=1)[:, z - a - k]
                cut = _below(cut, slack[rows])
                row, column = np.divmod(np.flatnonzero(rough >= cut[:, None]), z - a)
                many = np.flatnonzero(np.bincount(row, minlength=len(rows)) > 4 * k)
                if len(many):   # the lists so far were far from these queries
                    cut[many] = np.maximum(cut[many], _below(np.partition(rough[many], z - a - k, axis=1)[:, z - a - k],
                                                             slack[rows[many]]))
                    few = rough[row, column] >= cut[row]
                    row, column = row[few], column[few]
                row, column = rows[row], column + a
                # Row by row sums are the same wherever a vector stands, unlike those of a matrix product.
                parts = max(1, -(-len(row) // 20_000))
                exact = [(self.x[c] * q[r]).sum(axis=1)
                         for r, c in zip(np.array_split(row, parts), np.array_split(column, parts))]
                held.append((row, -np.concatenate(exact), self.ids[column]))
                n += len(row)
                if n > HELD_HITS or rows[-1] == asked[-1] and step & (step - 1) == 0:
                    held[:], n = [_merged(held, k)], 0
                    ends = np.cumsum(np.bincount(held[0][0], minlength=len(q)))
                    full = np.flatnonzero(np.diff(ends, prepend=0) == k)
                    last[full] = -held[0][1][ends[full] - 1]
        row, away, ids = _merged(held, k) if held else (np.empty(0, dtype=np.int64), np.empty(0), np.empty(0, dtype=np.int64))
        return _hits(row, away, ids).set_column(0, "query_id", pa.array(q_ids[np.unique(row)], pa.int64()))


def _search_cells(k: int):
    """A task body over rows sorted by cell, its vectors by list and then its
    queries; a cell may span batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, cell = None, None
        held: list[pa.RecordBatch] = []
        asks: list[pa.RecordBatch] = []

        def answer() -> Iterator[pa.RecordBatch]:
            if asks and cell is not None:
                rows = pa.Table.from_batches(asks).combine_chunks()
                bits = b"".join(rows.column("bits").to_pylist())
                bits = np.unpackbits(np.frombuffer(bits, dtype=np.uint8).reshape(len(rows), -1), axis=1, bitorder="little")
                yield cell.nearest(rows.column("vec_id").to_numpy(), _matrix(rows.column("vector").combine_chunks()), bits, k)
            asks.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("group", "c_v", "c_q", "is_query")])
            ends = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(ends[:-1], ends[1:]):
                *this, is_query = keys[:, a].tolist()
                if this != key:
                    yield from answer()
                    key, cell = this, None
                    held.clear()
                if not is_query:
                    held.append(batch.slice(a, b - a))
                    continue
                if held:
                    cell = _Cell(held)
                    held.clear()
                asks.append(batch.slice(a, b - a))
                if sum(map(len, asks)) >= ASKED_ROWS:
                    yield from answer()
        yield from answer()
    return run
