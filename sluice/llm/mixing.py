"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target in words. A document's expected number of copies is
its source's target over its source's size (times the document's weight, if
one is given). The whole part of that number is allocated for certain; the
fractional part is the inclusion probability of one more copy. That extra copy
is drawn by Pareto order sampling: documents are ranked by

    (u / (1 - u)) / (p / (1 - p)),   u uniform by a keyed hash of the document,

and the smallest ranks are taken up to a fixed size, here counted in words.

The ranking is never sorted as a whole. Ranks are binned, words are summed per
source and bin (map-side), and only the one bin in which a source's budget
ends is ordered row by row, so a source with a third of all rows is as cheap as
any. Nothing reaches the driver but the flag that ends the weight loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, packed, settle, unpacked

#: Bins of the rank; a source's budget ends in one of them, whose rows are ordered.
BINS = 4096
ADDED = ("size", "source_size", "target", "copies")


def allocate(sources: DataFrame, weights: tuple[int, ...], share: float,
             cap: float) -> DataFrame:
    """``target`` words per row of ``sources(source, source_size)``.

    Sources by code point (null last) take ``weights`` in turn and share
    ``share`` times all words. A target stops at ``cap`` times its source's
    size and the excess is reshared by weight: the fixed point is
    ``min(cap * size, level * weight)`` for one level, found by ordering the
    sources by the level at which they fill up. One row per source is handled.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    everything = Window.partitionBy()
    filling = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0.0)
    level = ((F.col("goal") - F.coalesce(F.sum("most").over(before), none))
             / (F.sum("weight").over(everything)
                - F.coalesce(F.sum("weight").over(before), none)))
    rows = (sources.withColumn("weight", weight)
            .withColumn("most", F.lit(float(cap)) * F.col("source_size"))
            .withColumn("goal", F.lit(float(share)) * F.sum("source_size").over(everything))
            .withColumn("full_at", F.col("most") / F.col("weight"))
            .withColumn("level", level)
            .withColumn("place", F.row_number().over(filling)))
    first = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("place", "level")))
    rows = rows.withColumn("found", first.over(everything)["level"])
    target = F.when(F.col("found").isNull(), F.col("most")).otherwise(
        F.least(F.col("most"), F.col("found") * F.col("weight")))
    return rows.select("source", "source_size", target.alias("target"))


def uniform(key: Column, text: Column, seed: str) -> Column:
    """A number in (0, 1) that depends on the seed and the document's key alone
    (on its text where the key is null)."""
    name = F.coalesce(key.cast("string"), F.concat(F.lit("text:"), text), F.lit("null"))
    hexed = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, 13)
    return (F.conv(hexed, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def _with_rank(docs: DataFrame, cap: float) -> DataFrame:
    """Adds whole, p, rank and bin; needs size, u, w and the source's rate."""
    expected = F.least(F.lit(float(cap)), F.coalesce(F.col("rate"), F.lit(0.0)) * F.col("w"))
    rank = ((F.col("u") / (F.lit(1.0) - F.col("u")))
            / (F.col("p") / (F.lit(1.0) - F.col("p"))))
    return (docs.withColumn("expected", expected)
            .withColumn("whole", F.floor("expected"))
            .withColumn("p", F.col("expected") - F.col("whole"))
            .withColumn("rank", F.when(F.col("p") > 0, rank))
            .withColumn("bin", F.floor(F.col("rank") / (F.col("rank") + 1) * BINS)))


def _rates(narrow: DataFrame, goals: DataFrame, cap: float, weighted: bool) -> DataFrame:
    """Copies per unit of document weight in each source, so that the expected
    words meet the target though no document exceeds ``cap`` copies."""
    rates = goals.withColumn("rate", F.when(F.col("source_size") > 0,
                                            F.col("target") / F.col("source_size"))
                             .otherwise(0.0))
    if not weighted:
        return rates
    # Documents at the cap are taken out and the rest is rescaled, until no more reach it.
    full = None
    while True:
        at_cap = (F.lit(False) if full is None else F.col("w") * F.col("rate") >= cap)
        docs = narrow if full is None else narrow.join(
            rates.select(F.col("source").alias("s"), "rate"), F.col("source").eqNullSafe(F.col("s")), "left")
        sums = docs.groupBy("source").agg(
            F.sum(F.when(at_cap, F.col("size") * cap).otherwise(0.0)).alias("at_cap"),
            F.sum(F.when(at_cap, 0).otherwise(1)).alias("n_free"),
            F.sum(F.when(at_cap, 0.0).otherwise(F.col("size") * F.col("w"))).alias("free"))
        rates = settle(goals.join(sums.withColumnRenamed("source", "s"),
                                  F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source", "source_size", "target", "n_free",
            F.when(F.col("free") > 0, (F.col("target") - F.col("at_cap")) / F.col("free"))
            .otherwise(F.lit(float(cap))).alias("rate")), "mix-rates")
        total = rates.agg(F.sum("n_free")).first()[0]
        if total == full:
            return rates.drop("n_free")
        full = total


def pareto_mix(docs: DataFrame, key: str = "doc_id", source: str = "source",
               text: str = "text", weight: str | None = None,
               weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
               cap: int = 2, seed: str = "mix-1") -> DataFrame:
    """``docs`` with ``size`` (words of ``text``), ``source_size``, ``target``
    and ``copies`` (0 to ``cap``): how often the mix takes the document.

    The fixed size is the largest prefix of the ranking whose words stay within
    the source's budget, plus the one further document that brings the words
    closest to it, if any brings them closer. The draw depends on ``seed`` and
    the key, so reruns agree.

    Defined cases: a null text has size 0; null sources form one source, last;
    repeated rows (equal key) share one draw, as they cannot be told apart;
    rows without a key draw by their text; a weight that is null or not above
    0 counts as 0. An empty table gives no rows. Input columns named like an
    added one are replaced by it.
    """
    w = F.lit(1.0) if weight is None else F.coalesce(
        F.greatest(F.col(f"`{weight}`").cast("double"), F.lit(0.0)), F.lit(0.0))
    rows = docs.select(packed(docs), F.col(f"`{source}`").alias("source"),
                       n_words(F.col(f"`{text}`")).alias("size"), w.alias("w"),
                       uniform(F.col(f"`{key}`"), F.col(f"`{text}`"), seed).alias("u"))
    narrow = settle(rows.drop("row"), "mix-narrow")
    goals = settle(allocate(narrow.groupBy("source").agg(F.sum("size").alias("source_size")),
                            weights, share, cap), "mix-goals")
    rates = _rates(narrow, goals, cap, weight is not None)

    def by_source(frame: DataFrame, per_source: DataFrame) -> DataFrame:
        small = per_source.withColumnRenamed("source", "s")
        return frame.join(small, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")

    ranked = _with_rank(by_source(narrow, rates), cap)
    bins = ranked.groupBy("source", "target", "bin").agg(
        F.sum(F.col("whole") * F.col("size")).alias("certain"),
        F.sum("size").alias("words"))
    per_source = Window.partitionBy("source")
    up_to = per_source.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = (bins.withColumn("budget", F.col("target") - F.sum("certain").over(per_source))
            .filter(F.col("bin").isNotNull())
            .withColumn("total", F.sum("words").over(up_to)))
    over = F.col("total") > F.col("budget")
    ends = settle(bins.groupBy("source").agg(
        F.first("budget").alias("budget"),
        F.coalesce(F.min(F.when(over, F.col("bin"))), F.lit(BINS + 1)).alias("end_bin"),
        F.coalesce(F.max(F.when(~over, F.col("total"))), F.lit(0)).alias("below")), "mix-ends")

    at_end = by_source(ranked, ends).filter(F.col("bin") == F.col("end_bin"))
    at_end = at_end.groupBy("source", "rank", "budget", "below").agg(F.sum("size").alias("words"))
    so_far = F.col("below") + F.sum("words").over(
        per_source.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    last = (at_end.withColumn("total", so_far).filter(F.col("total") <= F.col("budget"))
            .groupBy("source").agg(F.max("rank").alias("end_rank"), F.max("total").alias("reached")))
    cuts = settle(by_source(ends, last).withColumn(
        "gap", F.col("budget") - F.coalesce(F.col("reached"), F.col("below"))), "mix-cuts")

    drawn = (F.col("bin") < F.col("end_bin")) | (
        (F.col("bin") == F.col("end_bin")) & (F.col("rank") <= F.coalesce(F.col("end_rank"), F.lit(-1.0))))
    off = F.abs(F.col("size") - F.col("gap"))
    closing = (by_source(ranked.filter(F.col("p") > 0), cuts).filter(~drawn & (off < F.col("gap")))
               .groupBy("source").agg(F.min(F.struct(off.alias("off"), F.col("rank"))).alias("m"))
               .select("source", F.col("m.rank").alias("closing")))
    final = settle(by_source(by_source(rates, cuts), closing), "mix-final")

    extra = F.when(F.col("p") > 0, drawn | F.coalesce(F.col("rank") == F.col("closing"), F.lit(False)))
    out = _with_rank(by_source(rows, final), cap).withColumn(
        "copies", (F.col("whole") + F.coalesce(extra, F.lit(False)).cast("long")).cast("long"))
    return out.select(*unpacked(out, docs.columns, ADDED), "size",
                      F.col("source_size").cast("long").alias("source_size"), "target", "copies")


def expand(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: each row as often as its ``copies``, original columns only."""
    times = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return mixed.select(*[F.col(f"`{c}`") for c in columns], times.alias("_copy")).drop("_copy")


#: DuckDB SQL for the mix of ``documents`` with the defaults above.
SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'text:' || text, 'null')), 1, 13))::BIGINT
            + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
             2.0::DOUBLE * source_size AS most, 1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE AS goal FROM s),
f AS (SELECT *, most / weight AS full_at FROM w),
l AS (SELECT *, (goal - coalesce(sum(most) OVER b, 0.0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0)) AS level,
             row_number() OVER (ORDER BY full_at, source NULLS LAST) AS place
      FROM f WINDOW b AS (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT source, source_size,
             least(most, coalesce((SELECT arg_min(level, place) FROM l WHERE level <= full_at) * weight, most)) AS target FROM l),
e AS (SELECT d.*, source_size, target,
             least(2.0::DOUBLE, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END) AS expected
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
p AS (SELECT *, floor(expected) AS whole, expected - floor(expected) AS p FROM e),
r AS (SELECT *, CASE WHEN p > 0 THEN (u / (1.0::DOUBLE - u)) / (p / (1.0::DOUBLE - p)) END AS rk,
             target - sum(whole * size) OVER (PARTITION BY source) AS budget FROM p),
c AS (SELECT *, CASE WHEN rk IS NOT NULL THEN sum(size) FILTER (WHERE rk IS NOT NULL) OVER (PARTITION BY source ORDER BY rk NULLS LAST
             RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS total FROM r),
t AS (SELECT *, coalesce(total <= budget, false) AS drawn FROM c),
gap AS (SELECT *, budget - coalesce(max(total) FILTER (WHERE drawn) OVER (PARTITION BY source), 0) AS gap FROM t),
close AS (SELECT source, arg_min(rk, (abs(size - gap), rk)) AS closing FROM gap
          WHERE p > 0 AND NOT drawn AND abs(size - gap) < gap GROUP BY source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN drawn OR coalesce(rk = closing, false) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM gap LEFT JOIN close ON gap.source IS NOT DISTINCT FROM close.source
"""
