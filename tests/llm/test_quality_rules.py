"""Quality rules against their SQL, exact binomials and planted documents."""

from llm_tables import SF01, docs, odd  # noqa: F401
import math

import __spark_entry__ as E
from oracle_check import compare, duck
from pyspark.sql import functions as F

from sluice.llm import quality_rules as Q


def test_equals_sql(spark):
    name = "op8_risk_controlled_rules"
    n, problems = compare(spark, duck(SF01), name, E.queries()[name], E.oracle_sql()[name], SF01)
    assert n == 1000 and not problems, problems


def test_measures():
    text = "A b c\n a b c\nA b c\nx#y $|\v z w \x1c\n\n"
    #       words: A b c a b c A b c x#y $| z w \x1c
    words, chars, symbols, dup, repeat, upper = Q.measure(text)
    assert (words, symbols, dup, upper) == (13, 3, 1, 2)
    assert chars == 9 + 3 + 2 + 3 + 1
    seq = text.encode().split()
    windows = [tuple(seq[i:i + 3]) for i in range(len(seq) - 2)]
    want = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    assert repeat == len(want) > 0
    assert Q.measure(None) == Q.measure("") == (0,) * 6


def test_tail_equals_the_sum():
    for n, p in ((40, 0.1), (1000, 0.01), (3000, 0.0033)):
        for k in range(int(n * p)):
            want = sum(math.comb(n, j) * p**j * (1 - p)**(n - j) for j in range(k + 1))
            assert math.isclose(Q.binomial_tail(k, n, p), want, rel_tol=1e-9)
    assert Q.binomial_tail(5, 10, 0.1) == 1.0


def make(docs, spark, n, bad, lang="en"):
    """Plain good texts and, as junk, texts full of symbols; all labelled."""
    good = [(i, " ".join(f"w{i}_{k}" for k in range(60)), lang) for i in range(n)]
    junk = [(n + i, " ".join(f"w{i}_{k}###" for k in range(60)), lang) for i in range(bad)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(n)] + [(n + i, 0, 0) for i in range(bad)],
                                   "doc_id long, quality int, toxic int")
    return docs(good + junk), labels


def test_junk_goes_and_good_stays_within_the_bound(docs, spark):
    df, labels = make(docs, spark, 3000, 100)
    got = Q.report(df, labels).groupBy((F.col("doc_id") < 3000).alias("good")).agg(
        F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r["good"]: r["kept"] for r in got}
    assert kept[True] >= 0.98 and kept[False] == 0


def test_too_few_labels_reject_nothing(docs, spark):
    df, labels = make(docs, spark, 100, 30)
    assert Q.report(df, labels).filter("kept").count() == 130
    assert Q.keep(df, labels.filter("false")).count() == 130


def test_copies_count_once(docs, spark):
    """A thousand copies of one good text are one case, not a thousand."""
    text = " ".join(f"w{k}" for k in range(60))
    df = docs([(i, text) for i in range(3000)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(3000)], "doc_id long, quality int, toxic int")
    narrow = Q.profile(df).select(F.col("row.doc_id").alias("doc_id"), "stratum", "digest", *Q.MEASURES)
    assert Q.calibrate(narrow, "doc_id", labels).count() == 0


def test_odd_rows(odd, docs, spark):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 1), (6, 1, 1), (None, None, None)], "doc_id long, quality int, toxic int")
    rows = Q.report(odd, labels).collect()
    assert len(rows) == 10
    assert {r["doc_id"]: r["n_words"] for r in rows}[4] == 60_000
    kept = Q.keep(odd, labels)
    assert kept.columns == odd.columns and kept.count() == 0
    assert Q.report(docs([]), labels).collect() == []


def test_cutoffs_are_learned_from_the_given_labels(spark):
    """At sf0.01 English has labels enough: learned cutoffs reject what the base rules let pass."""
    rows = E.queries()["op8_risk_controlled_rules"](spark, SF01).collect()
    learned = {r["doc_id"] for r in rows if not r["kept"] and not r["base_failed"]}
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF01}/labels.parquet").filter("quality = 1").collect()}
    passed = {r["doc_id"] for r in rows if not r["base_failed"]} & good
    assert learned and len(learned & good) <= 0.02 * len(passed)


def test_steps_equal_a_plain_reading(spark):
    """Joint steps, counts and the last admissible one, by loops over the documents."""
    n, rules = 400, Q.RULES
    rows = [(i, "en" if i % 4 else None, i, 100, 500, i % 23 if i % 3 == 0 else 0, 0, i % 7, i % 19) for i in range(n)]
    profiles = spark.createDataFrame(rows, "doc_id long, stratum string, digest long, n_words long, word_chars long, "
                                           "n_symbols long, n_dup_lines long, n_repeat_words long, n_upper long")
    labels = spark.createDataFrame([(i, 1) for i in range(n)], "doc_id long, quality int")

    def values(r):
        _, _, _, words, chars, symbols, dup, repeat, upper = r
        return {"symbols": symbols * 1000 // chars, "upper_case": upper * 1000 // chars, "repeated_words": repeat * 1000 // words,
                "repeated_lines": dup * 1000 // words, "long_words": chars * 100 // words, "short_words": chars * 100 // words}

    want = {}
    for stratum in ("en", None):
        docs_ = [values(r) for r in rows if r[1] == stratum]
        for cut in Q.joint_steps():
            k = sum(any(v[r.name] > cut[r.name] if r.above else v[r.name] < cut[r.name] for r in rules if r.name in cut)
                    for v in docs_)
            p = sum(math.comb(len(docs_), j) * 0.1**j * 0.9**(len(docs_) - j) for j in range(k + 1))
            if k >= 0.1 * len(docs_) or p > 0.05 * len(docs_) / n:
                break
            want[stratum] = cut
    got = {r["cut_stratum"]: {x.name: r[f"cut_{x.name}"] for x in rules if r[f"cut_{x.name}"] is not None}
           for r in Q.calibrate(profiles, "doc_id", labels, alpha=0.1).collect()}
    assert got == want and len(want) == 2
    assert all(c["symbols"] < Q.RULES[0].cutoffs[0] for c in got.values())
