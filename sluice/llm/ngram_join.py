"""N-gram Jaccard join: pairs of texts whose word n-gram sets have a Jaccard
similarity of at least ``threshold``, found by MinHash banding.

1. Every whole text becomes its set of n-grams of words (64-bit hashes), a
   digest of that set and its band hashes. Equal sets are one node with a
   count, so copies never meet each other again.
2. Nodes are shuffled on band hashes. Every node of a bucket is tied to the
   bucket's smallest node, which is linear in the bucket, and the ties'
   connected components bring all nodes together that share a bucket.
3. Each component's full n-gram sets meet once and all its pairs are compared
   exactly. A large component is cut in blocks, and each pair of blocks is a
   cell with a task of its own. Cells return link counts and local roots, one
   row per node, never the pairs.
4. Components of the links are the classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, packed, settle, unpacked
from .components import components

#: A block holds about this many n-grams and nodes at most.
BLOCK_GRAMS, BLOCK_NODES = 2_000_000, 4096
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def bands_for(threshold: float, recall: float, hashes: int) -> tuple[int, int]:
    """Bands and rows per band that find a pair at the threshold with the given
    probability: the most rows (fewest chance candidates) within ``hashes``."""
    best = None
    for rows in range(1, hashes + 1):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log1p(-threshold ** rows)))
        if bands * rows <= hashes:
            best = bands, rows
    if best is None:
        raise ValueError("no banding reaches this recall; allow more hashes")
    return best


def grams(text: str | None, n: int) -> np.ndarray:
    """Sorted hashes of the distinct word n-grams of a whole text. A text with
    fewer than n words has one gram, all its words; one without words none."""
    words = text.encode("utf-8", "surrogatepass").split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    index: dict[bytes, int] = {}
    ids = [index.setdefault(w, len(index)) for w in words]
    each = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in index), np.uint64, len(index))[ids]
    size = min(n, len(words))
    out = np.full(len(words) - size + 1, np.uint64(size), dtype=np.uint64)
    for i in range(size):
        out = (out ^ (out >> np.uint64(29))) * _MULTIPLIER + each[i:len(words) - size + 1 + i]
    return np.unique(out ^ (out >> np.uint64(32)))


def _multipliers(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_hashes(found: np.ndarray, bands: int, rows: int, seed: int) -> np.ndarray:
    """One hash per band of the MinHash signature of a set of grams."""
    factor = _multipliers(bands * rows, seed)[:, None]
    low = np.full(bands * rows, np.uint64(2 ** 64 - 1), dtype=np.uint64)
    for i in range(0, len(found), 256):
        np.minimum(low, (factor * found[None, i:i + 256]).min(axis=1), out=low)
    out = np.arange(1, bands + 1, dtype=np.uint64)
    for column in low.reshape(bands, rows).T:
        out = (out ^ (out >> np.uint64(31))) * _MULTIPLIER + column
    return out.view(np.int64)


def _links(sets: list[np.ndarray], half: np.ndarray | None, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) with similarity at or above the threshold; with
    ``half``, only between its two values. Exact, from the shared grams."""
    m, sizes = len(sets), np.array([len(s) for s in sets], dtype=np.int64)
    if m == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        if both >= threshold * (sizes.sum() - both) - 1e-9 and (half is None or half[0] != half[1]):
            yield np.array([0]), np.array([1])
        return
    owner = np.repeat(np.arange(m), sizes)
    _, gram, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    column = np.cumsum(shared) - 1
    use = shared[gram]
    owner, gram = owner[use], column[gram[use]]
    n = int(shared.sum())
    order = np.argsort(gram, kind="stable")
    owner, gram = owner[order], gram[order]
    wide, tall = max(1, 4_000_000 // m), max(1, 8_000_000 // m)
    for top in range(0, m, tall):
        rows = slice(top, min(m, top + tall))
        common = np.zeros((rows.stop - top, m), dtype=np.float32)
        for left in range(0, n, wide):
            part = slice(*np.searchsorted(gram, [left, left + wide]))
            block = np.zeros((m, min(wide, n - left)), dtype=np.float32)
            block[owner[part], gram[part] - left] = 1
            common += block[rows] @ block.T
        either = sizes[rows, None] + sizes[None, :] - common
        near = common >= threshold * either - 1e-9 * (either > 0)
        near &= np.arange(top, rows.stop)[:, None] < np.arange(m)[None, :]
        if half is not None:
            near &= half[rows, None] != half[None, :]
        i, j = np.nonzero(near & (common > 0))
        if len(i):
            yield i + top, j


def _cell(nodes: np.ndarray, copies: np.ndarray, blocks: np.ndarray, sets: list[np.ndarray],
          cross: bool, threshold: float) -> Iterator[tuple[np.ndarray, ...]]:
    """Linked nodes of one cell with linked documents, linked texts and local root."""
    _, first = np.unique(nodes, return_index=True)  # a repeated row brings its node again
    nodes, copies, blocks, sets = nodes[first], copies[first], blocks[first], [sets[i] for i in first]
    if len(nodes) < 2:
        return
    docs, texts, root = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64), np.arange(len(nodes))
    pairs = list(_links(sets, blocks if cross else None, threshold))
    for i, j in pairs:
        np.add.at(docs, i, copies[j])
        np.add.at(docs, j, copies[i])
        np.add.at(texts, i, 1)
        np.add.at(texts, j, 1)
    while True:  # smallest label along the links, by pointer jumping
        before = root.copy()
        for i, j in pairs:
            low = np.minimum(root[i], root[j])
            np.minimum.at(root, i, low)
            np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            break
    hit = np.flatnonzero(texts)
    if len(hit):
        yield nodes[hit], docs[hit], texts[hit], nodes[root[hit]]


def _verify(threshold: float):
    """A task body over rows sorted by cell; a cell may span batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key, out, n_out = None, [], 0

        def close() -> None:
            nonlocal n_out
            if len(held) > 1:
                n, c, b, s = zip(*held)
                for found in _cell(np.array(n), np.array(c), np.array(b), list(s), key[1] != key[2], threshold):
                    out.append(found)
                    n_out += len(found[0])

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in zip(*out)], ["nid", "docs", "texts", "root"])

        for rows in batches:
            lists = rows.column("grams")
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            ends = ends - ends[0]
            keys = zip(*(rows.column(c).to_pylist() for c in ("comp", "lo", "hi")))
            for i, (k, n, c, b) in enumerate(zip(keys, *(rows.column(x).to_pylist() for x in ("nid", "copies", "block")))):
                if k != key:
                    close()
                    held.clear()
                    key = k
                held.append((n, c, b, flat[ends[i]:ends[i + 1]].copy()))
            if n_out > 5000:
                yield batch()
                out.clear()
                n_out = 0
        close()
        if out:
            yield batch()
    return run


def row_key(key: Column, text: Column) -> Column:
    """Names a row by its key and text; rows equal in both share it."""
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(":"),
                          F.coalesce(F.concat(F.lit("t"), text), F.lit("null"))))


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, threshold: float = 0.8,
            recall: float = 0.9999, hashes: int = 128, seed: int = 9) -> DataFrame:
    """One row per row of ``docs``: its key, ``row_key``, ``class_id`` (smallest
    key of the documents it is linked with, directly or over others),
    ``copy_of`` (smallest key with the same set of grams), ``n_links`` (other
    documents with similarity >= ``threshold``, copies included) and ``root``
    (an internal number of the class; null for a text without words).

    ``recall`` is the probability that banding alone brings a pair right at the
    threshold together; more similar pairs and pairs with common neighbours are
    likelier still. Every pair brought together is compared on its full sets.

    Defined cases: a text that is null or has no words has no grams, no links
    and its own key as class; repeated rows are copies of each other; rows
    without a key take part, and a class of such rows alone has a null id; an
    empty table gives no rows. Other columns are ignored.
    """
    bands, rows = bands_for(threshold, recall, hashes)

    @F.pandas_udf("n int, digest binary, bands array<long>")
    def sign(texts: pd.Series) -> pd.DataFrame:
        found = [grams(t, n) for t in texts]
        return pd.DataFrame({
            "n": [len(g) for g in found],
            "digest": [xxhash.xxh3_128_digest(g.tobytes()) if len(g) else None for g in found],
            "bands": [band_hashes(g, bands, rows, seed) if len(g) else None for g in found]})

    @F.pandas_udf("array<long>")
    def gram_set(texts: pd.Series) -> pd.Series:
        return pd.Series([grams(t, n).view(np.int64) for t in texts])

    doc, words = F.col(f"`{key}`"), F.col(f"`{text}`")
    signed = settle(docs.select(doc.alias("doc"), row_key(doc, words).alias("row_key"), sign(words).alias("s"))
                    .select("doc", "row_key", "s.*"), "signed")
    nodes = settle(signed.filter("digest is not null").groupBy("digest").agg(
        F.min("row_key").alias("rep"), F.min("doc").alias("copy_of"), F.count("*").alias("copies"),
        F.first("n").alias("n"), F.first("bands").alias("bands"))
        .withColumn("nid", F.monotonically_increasing_id()), "nodes")

    buckets = nodes.select("nid", F.explode("bands").alias("band"))
    shared = (buckets.groupBy(F.col("band").alias("b")).agg(F.min("nid").alias("low"), F.count("*").alias("size"))
              .filter("size > 1"))
    ties = (buckets.join(shared, F.col("band") == F.col("b")).filter("nid <> low")
            .select(F.col("nid").alias("a"), F.col("low").alias("b")).distinct())
    together = components(ties)
    members = nodes.select("nid", "rep", "copies", "n").join(
        together.withColumnRenamed("root", "comp"), F.col("nid") == F.col("node"))
    sizes = members.groupBy(F.col("comp").alias("c")).agg(
        F.greatest(F.ceil(F.sum("n") / BLOCK_GRAMS), F.ceil(F.count("*") / BLOCK_NODES)).alias("n_blocks"))
    members = settle(members.join(sizes, F.col("comp") == F.col("c")).select(
        "nid", "rep", "copies", "comp", "n_blocks",
        F.pmod(F.xxhash64("nid"), F.col("n_blocks")).alias("block")), "members")

    # Members grow with the table, so their texts are fetched by a shuffle at every size.
    # A repeated row is reduced to one before that shuffle, however often it stands there.
    once = (docs.select(row_key(doc, words).alias("row_key"), words.alias("text"))
            .groupBy("row_key").agg(F.first("text").alias("text")))
    texts = (once.join(members.hint("merge"), F.col("row_key") == F.col("rep"))
                 .select("nid", "copies", "comp", "block", "n_blocks", gram_set("text").alias("grams")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1))
    cells = (texts.withColumn("other", other)
             .select("comp", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                     "nid", "copies", "block", "grams"))
    found = settle(cells.repartition("comp", "lo", "hi").sortWithinPartitions("comp", "lo", "hi")
                   .mapInArrow(_verify(threshold), "nid long, docs long, texts long, root long"), "links")

    linked = components(found.select(F.col("nid").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy(F.col("nid").alias("x")).agg(F.sum("docs").alias("docs"))
    about = (nodes.select("nid", "digest", "copy_of", "copies")
             .join(linked, F.col("nid") == F.col("node"), "left").join(counts, F.col("nid") == F.col("x"), "left")
             .select(F.col("digest").alias("d"), "copy_of", "copies", F.coalesce("root", "nid").alias("root"),
                     F.coalesce("docs", F.lit(0)).alias("docs")))
    about = settle(about, "about")
    firsts = about.groupBy(F.col("root").alias("r")).agg(F.min("copy_of").alias("class_id"))
    about = settle(about.join(firsts, F.col("root") == F.col("r")).select(
        "d", "copy_of", "class_id", "root", (F.col("docs") + F.col("copies") - 1).alias("n_links")), "classes")
    alone = F.col("root").isNull()
    return signed.join(about, F.col("digest") == F.col("d"), "left").select(
        F.col("doc").alias(key), "row_key", F.when(alone, F.col("doc")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc")).otherwise(F.col("copy_of")).alias("copy_of"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "root")


def one_per_class(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay: of each class one row with the smallest
    key (rows without a key come last; of several, the smallest ``row_key``).
    Texts without words all stay, since nothing links them."""
    found = settle(classes(docs, key, text, **options), "class-rows")
    doc = F.col(f"`{key}`")
    first = found.filter("root is not null").groupBy("root").agg(
        F.min(F.struct(doc.isNull(), doc.alias("k"), "row_key")).alias("m"))
    stay = settle(first.select(F.col("m.row_key").alias("stay")), "stay")
    worded = F.coalesce(F.regexp_like(F.col(f"`{text}`"), F.lit(WORD)), F.lit(False))
    rows = docs.select(packed(docs), row_key(doc, F.col(f"`{text}`")).alias("row_key"), worded.alias("worded"))
    # Of repeated rows one is left in each task before the shuffle, by Spark's group limit.
    nth = F.row_number().over(Window.partitionBy("row_key").orderBy(F.lit(1)))
    kept = (rows.filter("worded").withColumn("nth", nth).filter("nth = 1")
            .join(stay, F.col("row_key") == F.col("stay"), "left_semi"))
    return kept.select(*unpacked(kept, docs.columns)).unionByName(
        rows.filter("not worded").select(*unpacked(rows, docs.columns)))


#: DuckDB SQL for ``classes`` on ``documents``: all pairs that share a gram, compared exactly.
SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS gram
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n, md5(string_agg(gram, chr(10) ORDER BY gram)) AS grams FROM g GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
           FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
         WHERE c >= 0.8 * (nx.n + ny.n - c) - 1e-9),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
class AS (SELECT x AS doc_id, min(y) AS class_id FROM reach GROUP BY x),
links AS (SELECT x AS doc_id, count(*) AS n_links FROM link GROUP BY x)
SELECT doc_id, class_id, coalesce(min(n.doc_id) OVER (PARTITION BY grams, grams IS NULL AND doc_id IS NOT NULL), doc_id) AS copy_of,
       coalesce(n_links, 0)::BIGINT AS n_links
FROM class LEFT JOIN n USING (doc_id) LEFT JOIN links USING (doc_id)"""
