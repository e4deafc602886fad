"""Importance resampling towards a target distribution.

Texts are seen as bags of hashed features: runs of 1 to ``max_n`` words, each in
the bucket its CRC-32 names. A bucket's gain compares how often the target and
the corpus use it; a document's weight is the mean gain of its features. Adding
seeded Gumbel noise to the weights and taking the highest sums draws documents
without replacement, in proportion to the exponential of the weight.

Method: checksums come from tables indexed by byte and distance from the end
(``crc.py``), for all feature spans of an Arrow batch at once. The corpus is
read twice, once to count buckets (one vector per task, then an aggregate of
``buckets`` rows) and once to weigh; nothing of a document is kept in between.
Ranks come from sampled ranges, so no task sorts the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.rownumbers import dense_ids
from .common import packed, settle, unpacked
from .crc import crc32_spans

BUCKETS = 10_000
MAX_N = 2
#: Words whose spans are expanded at once: bounds the memory of one step.
_WORDS_AT_ONCE = 8_192


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Per byte: its lower-cased form and whether it belongs to a word. Bytes of
    code points beyond ASCII all do."""
    lower = np.arange(256, dtype=np.uint8)
    lower[ord("A"):ord("Z") + 1] += 32
    word = np.zeros(256, bool)
    word[ord("0"):ord("9") + 1] = word[ord("a"):ord("z") + 1] = word[128:] = True
    return lower, word[lower]


_LOWER, _WORD = _classes()


def _utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array in a row, and where each text begins (and the
    last ends). A null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    buffers = texts.buffers()
    borders = np.frombuffer(buffers[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    return data[borders[0]:borders[-1]], borders - borders[0]


class Words:
    """The words of a batch of texts: lower-cased bytes with one space behind
    each word, where each begins and ends there, and the text it is of."""

    def __init__(self, texts: pa.Array):
        data, borders = _utf8(texts)
        inside = _WORD[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cut = borders[:-1][borders[:-1] < len(data)]          # words end where their text ends
        first[cut] |= inside[cut]
        last[cut[cut > 0] - 1] |= inside[cut[cut > 0] - 1]
        begins, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        lengths = ends - begins
        self.text = np.searchsorted(borders, begins, side="right") - 1
        self.n_words = np.bincount(self.text, minlength=len(texts)).astype(np.int64)
        self.start = np.cumsum(lengths + 1) - lengths - 1
        self.end = self.start + lengths
        self.bytes = np.full(int(lengths.sum()) + len(lengths), ord(" "), np.uint8)
        self.bytes[np.flatnonzero(inside) - np.repeat(begins - self.start, lengths)] = _LOWER[data[inside]]

    def buckets(self, max_n: int, n_buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(text, bucket) of the features, block by block of the words."""
        total = len(self.start)
        for low in range(0, total, _WORDS_AT_ONCE):
            for n in range(1, max_n + 1):
                i = np.arange(low, min(low + _WORDS_AT_ONCE, total - n + 1))
                i = i[self.text[i] == self.text[i + n - 1]]
                if len(i):
                    crc = crc32_spans(self.bytes, self.start[i], self.end[i + n - 1])
                    yield self.text[i], (crc % np.uint32(n_buckets)).astype(np.int64)


def bucket_counts(texts: DataFrame, column: str = "text", max_n: int = MAX_N, buckets: int = BUCKETS) -> DataFrame:
    """``bucket``, ``n``: how often all texts use each bucket (used ones only)."""

    def count(batches):
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, used in Words(batch.column(0)).buckets(max_n, buckets):
                n += np.bincount(used, minlength=buckets)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used])], ["bucket", "n"])

    per_task = texts.select(F.col(f"`{column}`")).mapInArrow(count, "bucket long, n long")
    return per_task.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket``, ``gain`` from the bucket counts of corpus and target, for
    every bucket: the floored thousandfold log ratio of the smoothed shares."""
    double = lambda c: F.coalesce(c, F.lit(0)).cast("double")
    totals = [d.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias(name))
              for d, name in ((corpus, "S"), (target, "T"))]
    all_buckets = corpus.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    rows = (all_buckets.join(corpus.withColumnRenamed("n", "s"), "bucket", "left")
            .join(target.withColumnRenamed("n", "t"), "bucket", "left"))
    big_s, big_t = (t.first()[0] for t in totals)
    ratio = (((double(F.col("t")) + 1) * F.lit(big_s + buckets))
             / ((double(F.col("s")) + 1) * F.lit(big_t + buckets)))
    return rows.select("bucket", F.floor(F.lit(1000.0) * F.ln(ratio)).cast("long").alias("gain"))


def _weigher(gain: np.ndarray, max_n: int):
    buckets = len(gain)

    @F.arrow_udf("struct<n_words: long, n_features: long, weight: long>")
    def weigh(texts: pa.Array) -> pa.Array:
        words = Words(texts)
        n, total = np.zeros((2, len(texts)), np.int64)
        for text, used in words.buckets(max_n, buckets):
            n += np.bincount(text, minlength=len(texts))
            np.add.at(total, text, gain[used])
        weight = np.floor_divide(total, np.maximum(n, 1))
        return pa.StructArray.from_arrays([pa.array(words.n_words), pa.array(n), pa.array(weight)],
                                          ["n_words", "n_features", "weight"])
    return weigh


def weigh(docs: DataFrame, target: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` with ``n_words``, ``n_features`` and ``weight`` (columns of these
    names are replaced). ``target`` is any table with a ``text``.

    Null, empty and wordless texts have no features and weight 0. Repeated rows
    are weighed alike. Without a target every bucket counts as unseen there.
    """
    gain = gains(settle(bucket_counts(docs, max_n=max_n, buckets=buckets), "corpus-buckets"),
                 settle(bucket_counts(target, max_n=max_n, buckets=buckets), "target-buckets"), buckets)
    # One row per bucket, a parameter.
    vector = np.array([r["gain"] for r in gain.orderBy("bucket").collect()], np.int64)
    new = ("n_words", "n_features", "weight")
    rows = docs.select(packed(docs), _weigher(vector, max_n)(F.col("text")).alias("w"))
    return rows.select(*unpacked(rows, docs.columns, drop=new), *[F.col(f"w.{c}").alias(c) for c in new])


def noisy_score(weight: Column, key: Column, seed: int) -> Column:
    """The weight plus Gumbel noise (in thousandths) drawn from seed and key; a
    null key counts as an empty one."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return weight + F.floor(F.lit(-1000.0) * F.ln(-F.ln(u))).cast("long")


def draw(weighed: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7, key: str = "doc_id") -> DataFrame:
    """All rows with ``score`` and ``rank`` (columns of these names are replaced).

    Of the N rows with at least ``min_words`` words the floor(percent * N / 100)
    highest scores are drawn and ranked 1, 2, 3 …; the rank of others is null.
    Ties go to the smaller key, null last; rows of equal score and key rank next
    to each other, by a hash of the row. ``weighed`` is read several times, so
    give it as stored files.
    """
    kept = [c for c in weighed.columns if c not in ("score", "rank")]
    scored = settle(weighed.select(*[F.col(f"`{c}`") for c in kept],
                                   noisy_score(F.col("weight"), F.col(f"`{key}`"), seed).alias("score")), "scores")
    able = scored.where(F.col("n_words") >= min_words)
    drawn = percent * able.count() // 100
    ranked = dense_ids(able, [F.col("score").desc(), F.col(f"`{key}`").asc_nulls_last()], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(~F.coalesce(F.col("n_words") >= min_words, F.lit(False)))
    return ranked.unionByName(rest.withColumn("rank", F.lit(None).cast(T.LongType())))


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7) -> DataFrame:
    """The drawn documents with all their columns, weight, score and rank."""
    return draw(weigh(docs, target), percent, min_words, seed).where(F.col("rank").isNotNull())


#: The same result over ``documents`` and ``benchmark`` in DuckDB: checksums byte by byte from a table of 256.
SQL = r"""
WITH tbl AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
d AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT kind, rn, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT 's' AS kind, rn, doc_id, text FROM d
        UNION ALL SELECT 't', 0, NULL, coalesce(text, '') FROM benchmark)),
f AS (
  SELECT kind, rn, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f
  FROM w),
h AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM f)),
b AS (
  SELECT f, xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(range(0, length(x) // 2), lambda p:
          16 * (strpos('0123456789ABCDEF', substr(x, 2 * p + 1, 1)) - 1)
          + strpos('0123456789ABCDEF', substr(x, 2 * p + 2, 1)) - 1)),
      lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]))) % 10000 AS bucket
  FROM h, tbl),
u AS (SELECT kind, rn, bucket FROM f JOIN b USING (f)),
s AS (SELECT bucket, count(*) AS s FROM u WHERE kind = 's' GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM u WHERE kind = 't' GROUP BY bucket),
big AS (SELECT coalesce((SELECT sum(s) FROM s), 0)::DOUBLE AS bs, coalesce((SELECT sum(t) FROM t), 0)::DOUBLE AS bt),
g AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (bs + 10000)) / ((s + 1)::DOUBLE * (bt + 10000)))) AS gain
  FROM s LEFT JOIN t USING (bucket), big),
m AS (SELECT rn, count(*) AS n, floor(sum(gain) / count(*))::BIGINT AS weight
      FROM u JOIN g USING (bucket) WHERE kind = 's' GROUP BY rn),
o AS (
  SELECT rn, doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(
             sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM w LEFT JOIN m USING (rn) WHERE kind = 's'),
r AS (SELECT rn, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS r FROM o WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score,
       CASE WHEN r <= 25 * (SELECT count(*) FROM r) // 100 THEN r END AS rank
FROM o LEFT JOIN r USING (rn)
"""
