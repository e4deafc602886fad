"""Quality rules whose cutoffs come with a bound on false rejections.

Fixed base rules reject short and repetitive texts. Further rules compare one
measure of a text with a cutoff per stratum (the language). The cutoffs are
learned: labelled documents serve as a holdout, and cutoffs are admissible if an
exact binomial test shows that the rules together reject at most ``alpha`` of the
stratum's good documents.

The rules tighten one after another along one nested sequence of joint cutoffs,
from the loosest to the strictest; the last before the first failure is taken (a
fixed-sequence test, which needs no correction within the stratum and spends
all of ``alpha`` on one test). Across strata the error level ``delta`` is split
by their numbers of labelled good documents (weighted Bonferroni), so with
probability 1 - ``delta`` every stratum loses at most ``alpha`` of its good ones.
With one stratum 149 good texts are enough at the defaults.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import packed, settle, unpacked

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper")
PROFILE = T.StructType([T.StructField(m, T.LongType(), False) for m in MEASURES])

_SPACE = b" \t\n\v\f\r"
_NOT_SYMBOL = bytes(b for b in range(256) if b not in b"#*$%&|<>")
_NOT_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window found twice or more, the first
    occurrence included; each word counts once."""
    if len(words) < 4:
        return 0
    index: dict[bytes, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for w in words], dtype=np.int64)
    pairs = ids[:-2] * len(index) + ids[1:-1]
    if len(index) > 2_000_000:  # keeps the combined number within 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, window, times = np.unique(pairs * len(index) + ids[2:], return_inverse=True, return_counts=True)
    again = times[window] > 1
    inside = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        inside[shift:len(words) - 2 + shift] |= again
    return int(inside.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measures of one whole text, in the order of ``MEASURES``."""
    if not text:
        return (0,) * len(MEASURES)
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # on bytes: exactly space and \x09 to \x0D
    lines = [x for x in data.split(b"\n") if x.strip(_SPACE)]
    space = len(data) - len(data.translate(None, _SPACE))
    return (len(words), len(text) - space, len(data.translate(None, _NOT_SYMBOL)),
            len(lines) - len(set(lines)), repeated_words(words), len(data.translate(None, _NOT_UPPER)))


@F.pandas_udf(PROFILE)
def profile_of(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(t) for t in texts], columns=list(MEASURES), dtype="int64")


@dataclass(frozen=True)
class Rule:
    """Rejects where ``value`` (a whole number) lies beyond the cutoff. The
    cutoffs stand from the loosest to the strictest; ``above`` says which side
    is rejected."""
    name: str
    value: str
    cutoffs: tuple[int, ...]
    above: bool = True

    def rejects(self, cutoff: Column) -> Column:
        value = F.expr(self.value)
        return F.coalesce(value > cutoff if self.above else value < cutoff, F.lit(False))

    def level(self) -> Column:
        """How many of the loosest cutoffs let the document pass."""
        value, array = F.expr(self.value), F.array(*[F.lit(c).cast("long") for c in self.cutoffs])
        return F.size(F.filter(array, lambda c: value <= c if self.above else value >= c))


def _down(start: int, stop: int, ratio: float = 0.85) -> tuple[int, ...]:
    out, x = [], float(start)
    while x > stop:
        out.append(round(x))
        x *= ratio
    return tuple(dict.fromkeys([*out, stop]))


RULES = (
    Rule("symbols", "n_symbols * 1000 div greatest(word_chars, 1)", _down(900, 5)),
    Rule("upper_case", "n_upper * 1000 div greatest(word_chars, 1)", _down(950, 30)),
    Rule("repeated_words", "n_repeat_words * 1000 div greatest(n_words, 1)", _down(490, 10)),
    Rule("repeated_lines", "n_dup_lines * 1000 div greatest(n_words, 1)", _down(300, 1)),
    Rule("long_words", "word_chars * 100 div greatest(n_words, 1)", _down(4000, 600, 0.93)),
    Rule("short_words", "word_chars * 100 div greatest(n_words, 1)", tuple(range(100, 401, 10)), above=False),
)


def joint_steps(rules: tuple[Rule, ...] = RULES) -> list[dict[str, int]]:
    """The nested sequence of joint cutoffs by rule name: the rules tighten one
    after another in their order, each from its loosest to its strictest cutoff,
    where it stays. So the rule that tells most should stand first."""
    out, held = [], {}
    for r in rules:
        for c in r.cutoffs:
            held = {**held, r.name: c}
            out.append(held)
    return out


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), summed term by term; exact for the
    k < n * p that can pass a test, 1 otherwise."""
    if k >= n * p:
        return 1.0
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
                    + k * math.log(p) + (n - k) * math.log1p(-p))
    total, j = term, k
    while j > 0 and term > total * 1e-18:
        term *= j / (n - j + 1) * (1 - p) / p
        total += term
        j -= 1
    return total


def profile(docs: DataFrame, stratum: str = "lang", text: str = "text") -> DataFrame:
    """``row`` (the packed input), ``stratum``, ``digest`` of the text and its measures."""
    rows = docs.select(packed(docs), F.col(f"`{stratum}`").cast("string").alias("stratum"),
                       F.xxhash64(F.col(f"`{text}`")).alias("digest"),
                       profile_of(F.col(f"`{text}`")).alias("m"))
    return rows.select("row", "stratum", "digest", "m.*")


def passed_steps(rules: tuple[Rule, ...] = RULES) -> Column:
    """How many of the joint steps let the document pass: those before the first
    cutoff it fails, as what fails at a step fails at all later ones."""
    total = len(joint_steps(rules))
    first, fails = 0, []
    for r in rules:
        fails.append(F.when(r.level() < len(r.cutoffs), r.level() + first).otherwise(total))
        first += len(r.cutoffs)
    return F.least(*fails, F.lit(total))


def calibrate(profiles: DataFrame, key: str, labels: DataFrame, rules: tuple[Rule, ...] = RULES,
              alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """One row per stratum with a column of cutoffs per rule; strata without are left out.

    With probability ``1 - delta`` no stratum's rules together reject more than
    ``alpha`` of its good documents. The rules tighten along one nested sequence of
    joint cutoffs (``joint_steps``), tested from the loosest on until the first
    failure, so all of ``alpha`` serves one test. ``delta`` is shared among
    the strata by their numbers of labelled good documents (a weighted
    Bonferroni correction; these numbers say nothing about rejections).

    ``profiles`` holds ``key``, ``stratum``, ``digest`` and the measures;
    ``labels`` holds ``key`` and ``quality``. A document with several labels is
    good if one of them says so. Equal texts of a stratum count once, since the
    test takes its cases as independent. Only documents that pass the base
    rules are at stake. A stratum without enough labelled documents gets no
    cutoffs, so nothing of it is rejected.
    """
    marks = labels.groupBy(F.col(key).alias("marked")).agg(F.max("quality").alias("quality"))
    good = (profiles.join(marks, F.col(key) == F.col("marked"))
            .filter((F.col("quality") == 1) & ~base_failed())
            .groupBy("stratum", "digest").agg(*[F.min(m).alias(m) for m in MEASURES]))
    counts = settle(good.select("stratum", passed_steps(rules).alias("passed"))
                    .groupBy("stratum", "passed").count(), "steps")
    total = counts.agg(F.sum("count")).first()[0] or 0
    sizes = counts.groupBy("stratum").agg(F.sum("count").alias("n"),
                                          F.collect_list(F.struct("passed", "count")).alias("counts"))
    path = joint_steps(rules)
    step = F.explode(F.sequence(F.lit(0), F.lit(len(path) - 1))).alias("step")
    beyond = F.aggregate(F.filter("counts", lambda x: x["passed"] <= F.col("step")), F.lit(0).cast("long"),
                         lambda a, x: a + x["count"])
    tested = sizes.select("stratum", "n", "counts", step).select("stratum", "n", "step", beyond.alias("rejected"))

    @F.pandas_udf("double")
    def tail(k: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([binomial_tail(int(a), int(b), alpha) for a, b in zip(k, n)], dtype="float64")

    # The tail grows with the rejections, so all that pass stand before the first failure.
    last = (tested.filter(tail("rejected", "n") <= F.lit(delta) * F.col("n") / F.lit(total))
            .groupBy(F.col("stratum").alias("cut_stratum")).agg(F.max("step").alias("step")))
    return settle(last.select("cut_stratum", *[
        F.element_at(F.array(*[F.lit(x.get(r.name)).cast("long") for x in path]), F.col("step") + 1).alias(f"cut_{r.name}")
        for r in rules]), "cutoffs")


def judge(profiles: DataFrame, cutoffs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``profiles`` with ``base_failed``, ``failed_rules`` and ``kept``. The
    cutoffs are one row per stratum; Spark broadcasts their file if it is small."""
    out = profiles.join(cutoffs, F.col("stratum").eqNullSafe(F.col("cut_stratum")), "left")
    failed = F.array_compact(F.array(*[F.when(r.rejects(F.col(f"cut_{r.name}")), F.lit(r.name))
                                       for r in rules]))
    return (out.withColumn("base_failed", base_failed()).withColumn("failed_rules", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
            .drop("cut_stratum", *[f"cut_{r.name}" for r in rules]))


def report(docs: DataFrame, labels: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """Key, measures and verdict of every document.

    Defined cases: a null or empty text has no words and fails the base rules;
    a null stratum is a stratum of its own; repeated rows are judged alike;
    without labels only the base rules reject; further columns are ignored.
    """
    narrow = settle(profile(docs).select(F.col(f"row.`{key}`").alias(key), "stratum", "digest",
                                         *MEASURES), "profiles")
    return judge(narrow, calibrate(narrow, key, labels, **options))


def keep(docs: DataFrame, labels: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns. Same cases as ``report``."""
    rows = settle(profile(docs), "measured")  # texts are measured once; the calibration reads the narrow columns
    narrow = rows.select(F.col(f"row.`{key}`").alias(key), "stratum", "digest", *MEASURES)
    kept = judge(rows, calibrate(narrow, key, labels, **options)).filter("kept")
    return kept.select(*unpacked(kept, docs.columns))


def _sql(alpha: float = 0.02, delta: float = 0.05) -> str:
    """DuckDB SQL for ``report`` with the default rules."""
    value = {r.name: r.value.replace(" div ", " // ") for r in RULES}
    steps = joint_steps()
    cases = " UNION ALL ".join(
        f"SELECT doc_id, stratum, text, '{r.name}' AS rule, {value[r.name]} AS v FROM good" for r in RULES)
    grid = " UNION ALL ".join(
        f"SELECT '{r.name}' AS rule, {str(r.above).lower()} AS above, unnest({[x[r.name] for x in steps if r.name in x]})::BIGINT "
        f"AS cutoff, unnest(range({sum(r.name not in x for x in steps)}, {len(steps)})) AS step" for r in RULES)
    rejected = " OR ".join(
        f"coalesce({value[r.name]} {'>' if r.above else '<'} (SELECT cutoff FROM cut WHERE cut.rule = '{r.name}' "
        f"AND cut.stratum IS NOT DISTINCT FROM m.stratum), false)" for r in RULES)
    return rf"""
WITH t AS (SELECT doc_id, lang AS stratum, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                  row_number() OVER () AS k FROM documents),
win AS (SELECT k, unnest(range(1, len(w) - 1)) AS i, w FROM t WHERE len(w) >= 3),
tri AS (SELECT k, i, count(*) OVER (PARTITION BY k, w[i], w[i + 1], w[i + 2]) AS c FROM win),
cov AS (SELECT k, count(DISTINCT pos) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS pos FROM tri WHERE c > 1) GROUP BY k),
ln AS (SELECT k, count(*) - count(DISTINCT line) AS n FROM
         (SELECT k, unnest(string_split(text, chr(10))) AS line FROM t)
       WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k),
m AS (SELECT doc_id, stratum, text, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
             len(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             coalesce(ln.n, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
             len(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g'))::BIGINT AS n_upper
      FROM t LEFT JOIN cov USING (k) LEFT JOIN ln USING (k)),
mark AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
good AS (SELECT min(m.doc_id) AS doc_id, stratum, text, any_value(n_words) AS n_words, any_value(word_chars) AS word_chars,
                any_value(n_symbols) AS n_symbols, any_value(n_dup_lines) AS n_dup_lines,
                any_value(n_repeat_words) AS n_repeat_words, any_value(n_upper) AS n_upper
         FROM m JOIN mark USING (doc_id)
         WHERE quality = 1 AND NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) GROUP BY stratum, text),
val AS ({cases}), grid AS ({grid}),
size AS (SELECT stratum, count(*) AS n FROM good GROUP BY stratum),
hit AS (SELECT stratum, step, count(DISTINCT doc_id) AS k FROM val JOIN grid USING (rule)
        WHERE CASE WHEN above THEN v > cutoff ELSE v < cutoff END GROUP BY stratum, step),
test AS (SELECT size.stratum, s.step, n, coalesce(k, 0) AS k FROM size CROSS JOIN (SELECT DISTINCT step FROM grid) s
         LEFT JOIN hit ON hit.step = s.step AND hit.stratum IS NOT DISTINCT FROM size.stratum),
ok AS (SELECT * FROM test WHERE k < n * {alpha!r}::DOUBLE AND list_sum(list_transform(range(k + 1),
         lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({alpha!r}::DOUBLE)
                  + (n - j) * ln(1 - {alpha!r}::DOUBLE))))
         <= {delta!r}::DOUBLE * n / (SELECT sum(n) FROM size)),
last AS (SELECT stratum, max(step) AS step FROM ok GROUP BY stratum),
cut AS (SELECT stratum, rule, cutoff FROM last JOIN grid USING (step))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT ({rejected}) AS kept
FROM m"""


SQL = _sql()
