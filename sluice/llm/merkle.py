"""Merkle manifest of a dataset: a proof for every document.

Each row is a leaf, the SHA-256 of its framed values. Per group (``lang``) the
leaves stand in key order (``doc_id``) and are hashed in pairs, level by level,
to a subroot; the subroots, in order of their groups, are hashed to the root.

Method, bitmap-rank indexing: the keys of a group form a bitmap, kept as its
non-zero 64-bit words (partial bitmaps are merged by OR before the shuffle) with
a directory of the rows before each word, summed up over a hierarchy of words.
A leaf's coordinate is then one lookup: directory entry plus popcount of the
lower bits; leaves are never sorted. Coordinates put leaves into slot arrays of
1,024, each of which is reduced ten levels at once; their tops are the leaves of
the next round. Paths are handed down from the root the same way.

Everything runs inside the JVM. The driver sees the number of rows of the
largest group, nothing else.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.rownumbers import dense_ids
from .common import settle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels reduced in one slot array.
LEVELS = 10
#: Words and directory entries below one entry of the next directory level, as a power of two.
_FAN = 14
#: Digits of a leaf that deal the rows of a repeated key into cells.
_CELL = 3
#: Copies of one row made by one task.
_PIECE = 10_000


def _sha(c: Column) -> Column:
    return F.sha2(c, 256)


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the values one after another, each as its UTF-8 length, a
    colon and its text, or ``-`` where it is null."""
    text = [v.cast("string") for v in values]
    return _sha(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]))


def _key_word(key: Column) -> Column:
    """Number of the bitmap word of a key; nulls have a word below all others."""
    return F.coalesce(F.shiftright(key, 6), F.lit(-(1 << 57) - 1))


def _key_bit(key: Column) -> Column:
    return F.coalesce(key.bitwiseAND(F.lit(63)), F.lit(0)).cast("int")


def leaves(docs: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "lang",
           carry: Mapping[str, Column] | None = None) -> DataFrame:
    """``grp``, ``word``, ``bit``, ``key``, ``leaf`` and the carried columns of every row."""
    if not isinstance(docs.schema[key].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        raise TypeError(f"{key} has to be a whole number of at most 64 bits")
    k, g = F.col(f"`{key}`").cast("long"), F.col(f"`{group}`").cast("string")
    carried = F.struct(*[c.alias(n) for n, c in carry.items()]) if carry else F.struct(F.lit(0).alias("none"))
    return docs.select(F.coalesce(F.concat(F.lit("="), g), F.lit("")).alias("grp"), _key_word(k).alias("word"),
                       _key_bit(k).alias("bit"), k.alias("key"),
                       leaf_digest([F.col(f"`{f}`") for f in fields]).alias("leaf"), carried.alias("carried"))


# ---------------------------------------------------------------- the index

def bitmaps(keyed: DataFrame) -> DataFrame:
    """Words of the groups' bitmaps: ``grp``, ``word``, ``bits`` and ``n``, the
    rows in the word (more than its bits where keys repeat). Merged per task first."""
    mask = F.expr("shiftleft(1L, bit)")
    return keyed.groupBy("grp", "word").agg(F.bit_or(mask).alias("bits"), F.count(F.lit(1)).alias("n"))


def merged(*parts: DataFrame) -> DataFrame:
    """One bitmap from those of several parts of a dataset."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.groupBy("grp", "word").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))


def _earlier(n: str, by: Sequence[str], order: Sequence[str | Column]) -> Column:
    """Sum of ``n`` over the rows before this one in its window."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(w), F.lit(0))


def _directory(counts: DataFrame, at: str, bits: int) -> DataFrame:
    """``counts(grp, at, n)`` with ``before``, the sum of ``n`` over smaller
    ``at`` of the group. ``at`` has ``bits`` bits: every window spans one entry
    of the level above, the last a whole group of at most 2^15 entries."""
    if bits <= 15:
        return counts.withColumn("before", _earlier("n", ["grp"], [at]))
    up = f"{at}_up"
    rows = counts.withColumn(up, F.shiftright(at, _FAN))
    above = _directory(rows.groupBy("grp", up).agg(F.sum("n").alias("n")), up, bits - _FAN)
    inside = rows.withColumn("inside", _earlier("n", ["grp", up], [at]))
    return (inside.join(above.select("grp", up, F.col("before").alias("above")), ["grp", up])
            .select(*counts.columns, (F.col("above") + F.col("inside")).alias("before")))


def rank_index(words: DataFrame) -> DataFrame:
    """The words with ``before``, the rows of the group before each, and
    ``total``, all rows of the group."""
    before = _directory(words, "word", 58)
    total = words.groupBy("grp").agg(F.sum("n").alias("total"))
    return before.join(total, "grp")


def coordinates(keyed: DataFrame, index: DataFrame) -> DataFrame:
    """``pos`` (from 0, within the group) and ``total`` of every leaf.

    Rows that share a key stand in order of their leaf digest. Words that hold
    such keys go another way: equal rows are counted first, the rest is numbered
    in cells of key and first digits of the digest, and the copies are made in
    pieces. So a key that holds a third of all rows is spread over many tasks.
    """
    crowded = F.col("n") > F.bit_count("bits")
    lower = F.expr("~shiftleft(-1L, bit)")
    single = (keyed.join(index.where(~crowded).hint("shuffle_hash"), ["grp", "word"])
              .select("grp", "key", "leaf", "carried", "total",
                      (F.col("before") + F.bit_count(F.col("bits").bitwiseAND(lower))).alias("pos")))
    busy = index.where(crowded).select("grp", "word", "before", "total")
    rows = (keyed.join(busy.select("grp", "word"), ["grp", "word"], "left_semi")
            .groupBy("grp", "word", "bit", "key", "leaf", "carried").agg(F.count(F.lit(1)).alias("m"))
            .withColumn("cell", F.substring("leaf", 1, _CELL)))
    rows = settle(rows, "repeated")
    cells = (rows.groupBy("grp", "word", "bit", "cell").agg(F.sum("m").alias("m"))
             .withColumn("cells", _earlier("m", ["grp", "word"], ["bit", "cell"])).drop("m")
             .join(busy, ["grp", "word"]))
    at = (rows.withColumn("inside", _earlier("m", ["grp", "word", "bit", "cell"], ["leaf", F.xxhash64("carried")]))
          .join(cells, ["grp", "word", "bit", "cell"])
          .withColumn("first", F.col("before") + F.col("cells") + F.col("inside")))
    pieces = F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / _PIECE))
    at = at.select("*", F.explode(pieces).alias("piece")).hint("rebalance")
    last = F.least(F.col("m"), (F.col("piece") + 1) * _PIECE) - 1
    copies = at.select("grp", "key", "leaf", "carried", "total",
                       F.explode(F.sequence(F.col("first") + F.col("piece") * _PIECE, F.col("first") + last)).alias("pos"))
    return single.unionByName(copies)


# ---------------------------------------------------------------- the tree

def _pairs(row: Column) -> Column:
    """Digests of every two consecutive nodes; an odd last one is hashed alone."""
    return F.transform(F.sequence(F.lit(0), F.shiftright(F.size(row) - 1, 1)),
                       lambda i: _sha(F.concat(F.get(row, 2 * i), F.coalesce(F.get(row, 2 * i + 1), F.lit("")))))


def _height(nodes: Column) -> Column:
    """Levels above ``nodes`` nodes that one slot array reduces."""
    return (F.when(nodes <= 1, 0).when(nodes > (1 << LEVELS), LEVELS)
            .otherwise(F.length(F.bin(nodes - 1))).cast("int"))


def _upto(n: Column) -> Column:
    """1, 2 … n; nothing for 0."""
    return F.slice(F.sequence(F.lit(1), n + 1), F.lit(1), n)


def _slot_arrays(nodes: DataFrame, rest: Sequence[str], round_: int) -> DataFrame:
    """Nodes ``(grp, total, pos, leaf, *rest)`` as arrays of 1,024 slots with the
    digests of all their levels; written down, as every later step reads them."""
    slots = (nodes.groupBy("grp", "total", F.shiftright("pos", LEVELS).alias("block"))
             .agg(F.sort_array(F.collect_list(F.struct(
                 F.col("pos").bitwiseAND(F.lit((1 << LEVELS) - 1)).cast("int").alias("slot"), "leaf", *rest))).alias("slots")))
    here = F.shiftright(F.col("total") - 1, LEVELS * round_) + 1
    levels = F.aggregate(_upto(_height(here)), F.array(F.transform("slots", lambda s: s["leaf"])),
                         lambda done, _: F.array_append(done, _pairs(F.element_at(done, -1))))
    return settle(slots.withColumn("levels", levels), "slots")


def _steps(slot: Column) -> Column:
    """The path of a slot within its array: per level the sibling's digest (null
    if it has none) and whether it stands left."""
    return F.transform(_upto(F.size("levels") - 1), lambda n: F.struct(
        F.get(F.element_at("levels", n), _level_place(slot, n).bitwiseXOR(F.lit(1))).alias("digest"),
        (_level_place(slot, n).bitwiseAND(F.lit(1)) == 1).alias("left")))


def _level_place(slot: Column, n: Column) -> Column:
    return F.call_function("shiftright", slot, n - 1)


def _path(slot: Column, above: Column) -> Column:
    return F.concat(_steps(slot), above)


_PATH_TYPE = "array<struct<digest:string,left:boolean>>"


class _Tree:
    """Slot arrays of all rounds over ``nodes(grp, total, pos, leaf, *rest)``."""

    def __init__(self, nodes: DataFrame, rest: Sequence[str], largest: int):
        self.rounds = [_slot_arrays(nodes, rest, 0)]
        while largest > (1 << LEVELS):
            largest = ((largest - 1) >> LEVELS) + 1
            self.rounds.append(_slot_arrays(self._tops(len(self.rounds) - 1), (), len(self.rounds)))

    def _tops(self, round_: int) -> DataFrame:
        top = F.get(F.element_at("levels", -1), F.lit(0))
        return self.rounds[round_].select("grp", "total", F.col("block").alias("pos"), top.alias("leaf"))

    def tops(self) -> DataFrame:
        """``grp`` and its root digest."""
        return self._tops(len(self.rounds) - 1).select("grp", F.col("leaf").alias("subroot"))

    def paths(self, above: DataFrame) -> DataFrame:
        """The slot arrays of the first round with ``above``, the path from
        their top on. ``above(grp, block, above, …)`` gives that of the roots."""
        extra = [c for c in above.columns if c not in ("grp", "block", "above")]
        for blocks in self.rounds[:0:-1]:
            wide = blocks.join(above, ["grp", "block"])
            slot = F.explode("slots").alias("s")
            above = settle(wide.select("grp", "block", "levels", "above", *extra, slot).select(
                "grp", F.call_function("shiftleft", F.col("block"), F.lit(LEVELS)).alias("base"), F.col("s.slot").alias("slot"),
                _path(F.col("s.slot"), F.col("above")).alias("above"), *extra).select(
                "grp", (F.col("base") + F.col("slot")).alias("block"), "above", *extra), "paths")
        return self.rounds[0].join(above, ["grp", "block"])


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "lang",
             carry: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per document: the key, the group, ``leaf``, ``pos`` (its place in
    the group, from 0), ``path`` (sibling digest and side per level, up to the
    root), ``subroot``, ``root`` and the carried columns.

    Null keys stand first in their group, a null group before all others.
    Repeated rows are leaves of their own, next to each other; rows that share a
    key are ordered by digest. Other columns of ``docs`` play no part, whatever
    their names. An empty table has no rows and no root.
    """
    keyed = settle(leaves(docs, fields, key, group, carry), "leaves")
    index = settle(rank_index(settle(bitmaps(keyed), "bitmaps")), "rank-index")
    largest = index.agg(F.max("total").alias("m")).first()["m"] or 0
    tree = _Tree(coordinates(keyed, index), ("key", "carried"), largest)
    subroots = settle(tree.tops(), "subroots")
    n_groups = subroots.count()
    ranked = dense_ids(subroots.withColumnRenamed("grp", "of"), ["of"], "rank").select(
        F.lit("").alias("grp"), F.lit(n_groups).cast("long").alias("total"), (F.col("rank") - 1).alias("pos"),
        F.col("subroot").alias("leaf"), "of")
    top = _Tree(ranked, ("of",), n_groups)
    root = top.tops().select(F.lit(0).cast("long").alias("block"), F.lit("").alias("grp"), F.col("subroot").alias("root"),
                             F.array().cast(_PATH_TYPE).alias("above"))
    groups = (top.paths(root).select("levels", "above", "root", F.explode("slots").alias("s"))
              .select(F.col("s.of").alias("grp"), F.lit(0).cast("long").alias("block"), F.col("s.leaf").alias("subroot"),
                      "root", _path(F.col("s.slot"), F.col("above")).alias("above")))
    wide = tree.paths(settle(groups, "groups"))
    out = wide.select("grp", "block", "levels", "above", "subroot", "root", F.explode("slots").alias("s"))
    names = list(carry or ())
    return out.select(F.col("s.key").alias(key),
                      F.when(F.col("grp") != "", F.substr("grp", F.lit(2))).alias(group), F.col("s.leaf").alias("leaf"),
                      (F.call_function("shiftleft", F.col("block"), F.lit(LEVELS)) + F.col("s.slot")).alias("pos"),
                      _path(F.col("s.slot"), F.col("above")).alias("path"), "subroot", "root",
                      *[F.col(f"s.carried.{n}").alias(n) for n in names])


def proof_digest(path: Column) -> Column:
    """SHA-256 of the siblings of a path, one after another."""
    return _sha(F.array_join(F.transform(path, lambda s: F.coalesce(s["digest"], F.lit(""))), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda h, s: _sha(
        F.when(s["left"], F.concat(s["digest"], h)).otherwise(F.concat(h, F.coalesce(s["digest"], F.lit(""))))))


#: The same digests over ``documents`` in DuckDB, level by level; tampering as in the registered query.
SQL = """
WITH RECURSIVE tbl AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
d AS (
  SELECT *, coalesce(lang, '') AS l, lang IS NULL AS no_lang, coalesce(xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1),
                                              lambda p: ascii(substr(CAST(doc_id AS VARCHAR), p, 1)))),
      lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]))) % 7 = 0, false) AS hit
  FROM documents, tbl),
f AS (
  SELECT doc_id, l, no_lang,
    'x' AS x, list_transform([CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text],
        lambda v: coalesce(octet_length(encode(v)) || ':' || v, '-')) AS v,
    list_transform([CAST(CASE WHEN hit THEN n_chars + 1 ELSE n_chars END AS VARCHAR)],
        lambda v: coalesce(octet_length(encode(v)) || ':' || v, '-')) AS w
  FROM d),
leaf AS (
  SELECT doc_id, l, no_lang, sha256(array_to_string(v, '')) AS leaf, sha256(v[1] || v[2] || v[3] || w[1] || v[5]) AS bad
  FROM f),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY l, no_lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY l, no_lang) AS n
  FROM leaf),
nodes AS (
  SELECT l, no_lang, 0 AS lvl, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT l, no_lang, any_value(lvl) + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY l, no_lang, pos // 2),
sub AS (
  SELECT l, no_lang, h AS subroot, row_number() OVER (ORDER BY no_lang DESC, encode(l)) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
upper_nodes AS (
  SELECT 0 AS lvl, pos, n, subroot AS h FROM sub
  UNION ALL
  SELECT any_value(lvl) + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM upper_nodes WHERE n > 1 GROUP BY pos // 2),
steps AS (
  SELECT p.l, p.no_lang, p.pos, u.lvl, (p.pos >> u.lvl) % 2 = 1 AS on_left, s.h
  FROM placed p JOIN (SELECT DISTINCT l, no_lang, lvl FROM nodes WHERE n > 1) u USING (l, no_lang)
  LEFT JOIN nodes s ON s.l = p.l AND s.no_lang = p.no_lang AND s.lvl = u.lvl AND s.pos = xor(p.pos >> u.lvl, 1)
  UNION ALL
  SELECT p.l, p.no_lang, p.pos, 1000 + u.lvl, (b.pos >> u.lvl) % 2 = 1, s.h
  FROM placed p JOIN sub b USING (l, no_lang), (SELECT DISTINCT lvl FROM upper_nodes WHERE n > 1) u
  LEFT JOIN upper_nodes s ON s.lvl = u.lvl AND s.pos = xor(b.pos >> u.lvl, 1)),
paths AS (
  SELECT l, no_lang, pos, list(CASE WHEN h IS NULL THEN '-' WHEN on_left THEN 'L' || h ELSE 'R' || h END ORDER BY lvl) AS path
  FROM steps GROUP BY l, no_lang, pos)
SELECT p.doc_id, p.leaf, s.subroot, r.h AS root,
       sha256(coalesce(array_to_string(list_transform(path, lambda x: substr(x, 2)), ''), '')) AS proof_sha256,
       list_reduce(list_prepend(p.bad, coalesce(path, [])), lambda h, x: sha256(
           CASE x[1] WHEN 'L' THEN substr(x, 2) || h WHEN 'R' THEN h || substr(x, 2) ELSE h END)) AS folded_root,
       folded_root = root AS verified
FROM placed p JOIN sub s USING (l, no_lang) CROSS JOIN (SELECT h FROM upper_nodes WHERE n = 1) r
LEFT JOIN paths q ON q.l = p.l AND q.no_lang = p.no_lang AND q.pos = p.pos
"""
