"""Incremental line dedup that can be taken back.

A line's key is the line without white space at its ends, A-Z lower-cased. Keys
found in at least ``threshold`` documents lose all their lines.

The index holds an exact table of reference counts (in how many documents a key
stands) as a list of stored changes, and sharded cuckoo filters of the keys that
have reached the threshold. Documents are inserted and deleted in batches: the
counts of the batch's keys alone are looked up, and keys that cross the
threshold enter or leave the filter of their shard. What the filters let through
is checked against the exact table, so a false alarm costs time, never a line.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import packed, settle, unpacked
from .cuckoo import CuckooFilter, Full

#: White space that is stripped, and the letters that are lower-cased (fixed by the contract).
BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Keys in one shard's filter, about; the shards double as keys come in.
SHARD_KEYS = 1 << 16
#: Filters up to this size go to all tasks; beyond, every line is looked up in the exact table.
FILTER_BYTES = 64 << 20
#: Parts that the rows of one key or of one text are dealt into.
SALTS = 16
#: Stored changes of the counts that are kept before they are folded into one.
MAX_CHANGES = 8

_COUNTS = "digest binary, hash long, n long"
_FILTERS = "shard int, cells binary, n_keys long"


def line_key(line: bytes) -> bytes:
    return line.strip(BLANK.encode()).lower()


def _digest(key: Column) -> Column:
    """128 bits of the key's SHA-256; what equality of keys means here."""
    return F.unhex(F.substring(F.sha2(key, 256), 1, 32))


def _digests(text: Column, min_chars: int) -> Column:
    """Digests of the lines' keys, in order; null for keys that are too short."""
    key = lambda x: F.translate(F.btrim(x, F.lit(BLANK)), UPPER, LOWER)
    keys = F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), key)
    return F.transform(keys, lambda k: F.when(F.char_length(k) >= min_chars, _digest(k)))


def key_counts(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """``digest``, ``hash``, ``n``: in how many rows of ``docs`` each key stands."""
    distinct = F.array_distinct(F.filter(_digests(F.col("text"), min_chars), lambda d: d.isNotNull()))
    keys = docs.select(F.explode(distinct).alias("digest"))
    return keys.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).select("digest", F.xxhash64("digest").alias("hash"), "n")


def _shard(shards: int) -> Column:
    return F.pmod(F.col("hash"), F.lit(shards)).cast("int").alias("shard")


@dataclass(frozen=True)
class LineIndex:
    """What is known of all documents inserted so far. Every change gives a new
    index; the one before stays as it is."""

    spark: SparkSession
    changes: tuple[DataFrame, ...]
    filters: DataFrame
    shards: int
    threshold: int
    min_chars: int

    @staticmethod
    def empty(spark: SparkSession, threshold: int = 10, min_chars: int = 1) -> "LineIndex":
        if threshold < 1:
            raise ValueError("threshold has to be 1 or more")
        return LineIndex(spark, (), spark.createDataFrame([], _FILTERS), 1, threshold, min_chars)

    def counts(self) -> DataFrame:
        """The exact reference counts: ``digest``, ``hash``, ``n`` (1 or more)."""
        if not self.changes:
            return self.spark.createDataFrame([], _COUNTS)
        rows = self.changes[0]
        for c in self.changes[1:]:
            rows = rows.unionByName(c)
        return rows if len(self.changes) == 1 else (
            rows.groupBy("digest", "hash").agg(F.sum("n").alias("n")).where("n <> 0"))

    def frequent(self) -> DataFrame:
        return self.counts().where(F.col("n") >= self.threshold)

    def insert(self, docs: DataFrame) -> "LineIndex":
        """The index with these documents; every row is a document of its own."""
        return self._changed(key_counts(docs, self.min_chars))

    def delete(self, docs: DataFrame) -> "LineIndex":
        """The index without these documents, which were inserted before; keys
        that were not there as often fail the job."""
        gone = key_counts(docs, self.min_chars)
        return self._changed(gone.withColumn("n", -F.col("n")))

    def _changed(self, batch: DataFrame) -> "LineIndex":
        batch = settle(batch, "line-counts")
        moved = batch.withColumn("before", F.lit(0).cast("long"))
        if self.changes:
            known = self.counts().select("digest", F.col("n").alias("before"))
            touched = known.join(batch.select("digest"), "digest", "left_semi")
            moved = batch.join(touched, "digest", "left").withColumn("before", F.coalesce("before", F.lit(0)))
        after = F.col("before") + F.col("n")
        after = F.when(after < 0, F.raise_error(F.lit("lines of a document that was never inserted")).cast("long")).otherwise(after)
        moved = moved.select("hash", (F.col("before") >= self.threshold).alias("was"), (after >= self.threshold).alias("is"))
        crossing = settle(moved.where("was <> is").select("hash", F.col("is").alias("enters")), "crossing")
        changes = (*self.changes, batch)
        if len(changes) > MAX_CHANGES:
            changes = (settle(LineIndex(self.spark, changes, self.filters, 1, 1, 1).counts(), "line-counts"),)
        new = LineIndex(self.spark, changes, self.filters, self.shards, self.threshold, self.min_chars)
        return new._with_filters(crossing)

    def _with_filters(self, crossing: DataFrame) -> "LineIndex":
        """The filters after keys entered and left; made anew from the exact
        table when there are too many for the shards."""
        n = (self.filters.agg(F.coalesce(F.sum("n_keys"), F.lit(0))).first()[0]
             + crossing.agg(F.coalesce(F.sum(F.when(F.col("enters"), 1).otherwise(-1)), F.lit(0))).first()[0])
        shards = self.shards
        while shards * SHARD_KEYS < n:
            shards *= 2
        if shards != self.shards:
            filters = self._built(self.frequent().select("hash"), shards)
        else:
            keyed = crossing.select(_shard(shards), "hash", "enters")
            filters = settle(keyed.groupBy("shard").cogroup(self.filters.groupBy("shard"))
                             .applyInArrow(_updated, _FILTERS), "filters")
            full = filters.where("cells is null").select("shard")
            if not full.isEmpty():
                again = self.frequent().select("hash", _shard(shards)).join(full, "shard", "left_semi")
                filters = settle(filters.where("cells is not null").unionByName(
                    self._built(again.select("hash"), shards)), "filters")
        return LineIndex(self.spark, self.changes, filters, shards, self.threshold, self.min_chars)

    def _built(self, hashes: DataFrame, shards: int) -> DataFrame:
        return settle(hashes.select(_shard(shards), "hash").groupBy("shard").applyInArrow(_filter_of, _FILTERS), "filters")

    # ------------------------------------------------------------ cleaning

    def _suspects(self, docs: DataFrame, filter_bytes: int) -> DataFrame:
        """``text_key``, ``digest`` of the lines that may have to go."""
        rows = docs.select(_text_key(), _digests(F.col("text"), self.min_chars).alias("digests"))
        size = self.filters.agg(F.coalesce(F.sum(F.octet_length("cells")), F.lit(0))).first()[0]
        some = lambda d: d.isNotNull()
        if size <= filter_bytes:
            cells = {r["shard"]: bytes(r["cells"]) for r in self.filters.select("shard", "cells").collect()}
            shared = self.spark.sparkContext.broadcast(cells)
            hashes = F.transform("digests", lambda d: F.when(d.isNotNull(), F.xxhash64(d)))
            rows = rows.withColumn("suspect", _checker(shared, self.shards)(hashes)).where(F.size("suspect") > 0)
            picked = F.transform("suspect", lambda i: F.get("digests", i))
        else:
            picked = F.filter("digests", some)
        return rows.select("text_key", F.explode(F.array_distinct(picked)).alias("digest")).distinct()

    def clean(self, docs: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
        """``docs`` with ``kept`` (the text without the lines of frequent keys),
        ``n_lines`` and ``n_dropped`` (columns of these names are replaced).

        A null or empty text has one empty line. Lines whose key is shorter than
        ``min_chars`` stay, so does the order of lines; repeated rows get equal
        results. ``docs`` need not have been inserted.
        """
        salts = F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt")
        salt = lambda *c: F.pmod(F.xxhash64(*c), F.lit(SALTS)).cast("int").alias("salt")
        suspects = self._suspects(docs, filter_bytes).select("text_key", "digest", salt("text_key"))
        frequent = settle(self.frequent().select("digest"), "frequent").select("digest", salts)
        gone = settle(suspects.join(frequent, ["digest", "salt"], "left_semi").groupBy("text_key")
                      .agg(F.collect_list("digest").alias("gone")), "gone")
        # Copies of one text are dealt into parts by what else is in their rows.
        rest = [F.col(f"`{c}`") for c, t in docs.dtypes if c != "text" and not t.startswith(("map", "variant"))]
        rows = docs.select(packed(docs), _text_key(), salt(*rest, F.spark_partition_id()), F.col("text"))
        out = rows.join(gone.select("*", salts), ["text_key", "salt"], "left")
        whole = F.coalesce("text", F.lit(""))
        drop_lines = F.arrow_udf(_drop_lines, "struct<kept: string, n_dropped: long>")
        out = out.withColumn("r", drop_lines(F.when(F.col("gone").isNotNull(), whole), F.col("gone")))
        new = ("kept", "n_lines", "n_dropped")
        return out.select(*unpacked(out, docs.columns, drop=new), F.coalesce("r.kept", whole).alias("kept"),
                          (F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
                          F.coalesce("r.n_dropped", F.lit(0)).cast("long").alias("n_dropped"))


def _text_key() -> Column:
    return F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_key")


def _filters_table(shard: int, made: CuckooFilter | None, n: int) -> pa.Table:
    return pa.table({"shard": pa.array([shard], pa.int32()), "cells": pa.array([made and made.to_bytes()], pa.binary()),
                     "n_keys": pa.array([n], pa.int64())})


def _filter_of(keys: pa.Table) -> pa.Table:
    hashes = keys["hash"].to_numpy()
    return _filters_table(keys["shard"][0].as_py(), CuckooFilter.of(hashes), len(hashes))


def _updated(crossing: pa.Table, old: pa.Table) -> pa.Table:
    """A shard's filter after its keys entered and left; without cells if they
    do not fit any more."""
    shard = (crossing if crossing.num_rows else old)["shard"][0].as_py()
    enters = crossing["enters"].to_numpy().astype(bool)
    hashes = crossing["hash"].to_numpy()
    if not old.num_rows:
        return _filters_table(shard, CuckooFilter.of(hashes[enters]), int(enters.sum()))
    n = old["n_keys"][0].as_py() + int(enters.sum()) - int((~enters).sum())
    held = CuckooFilter.from_bytes(old["cells"][0].as_py())
    held.remove(hashes[~enters])
    try:
        held.add(hashes[enters])
    except Full:
        return _filters_table(shard, None, n)
    return _filters_table(shard, held, n)


def _checker(shared, shards: int):
    @F.arrow_udf("array<int>")
    def check(hashes: pa.Array) -> pa.Array:
        """Places of the lines that some filter knows."""
        filters = {s: CuckooFilter(np.frombuffer(c, np.uint16).reshape(-1, 4)) for s, c in shared.value.items()}
        values, borders = hashes.flatten(), np.concatenate(([0], np.cumsum(hashes.value_lengths().fill_null(0).to_numpy())))
        there = values.is_valid().to_numpy(zero_copy_only=False)
        keys = values.fill_null(0).to_numpy()
        hit = np.zeros(len(keys), bool)
        of = keys % shards
        for shard in np.unique(of[there]):
            if shard in filters:
                mine = np.flatnonzero(there & (of == shard))
                hit[mine] = filters[shard].might_hold(keys[mine])
        at = np.flatnonzero(hit)
        text = np.searchsorted(borders, at, side="right") - 1
        counts = np.bincount(text, minlength=len(hashes))
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()),
                                        pa.array(at - borders[text], pa.int32()))
    return check


def _drop_lines(texts: pa.Array, gone: pa.Array) -> pa.Array:
    kept, dropped = [], []
    for text, digests in zip(texts, gone):
        if not text.is_valid:
            kept.append(None)
            dropped.append(None)
            continue
        away = set(digests.as_py())
        lines = text.as_py().encode().split(b"\n")
        stay = [x for x in lines if hashlib.sha256(line_key(x)).digest()[:16] not in away]
        kept.append(b"\n".join(stay).decode())
        dropped.append(len(lines) - len(stay))
    return pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(dropped, pa.int64())], ["kept", "n_dropped"])


#: The same result over ``documents`` in DuckDB.
SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rn, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rn, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM d),
k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rn) >= 10),
s AS (
  SELECT rn, count(*) AS n, string_agg(line, chr(10) ORDER BY place) AS kept
  FROM k WHERE key NOT IN (SELECT key FROM f) GROUP BY rn)
SELECT doc_id, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(n, 0))::BIGINT AS n_dropped,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (rn)
"""
