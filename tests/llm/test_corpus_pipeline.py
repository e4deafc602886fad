"""The pipeline, stage by stage, against plain Python on the small table."""

from llm_tables import SF001  # noqa: F401
from collections import Counter

import corpus_pipeline as C
from test_ngram_join import brute

from sluice.llm import quality_rules as Q
from sluice.llm.common import prepare, settle, table
from sluice.llm.pseudonyms import pseudonymise
from sluice.llm.queries import PSEUDONYM_KEY


def test_stages(spark):
    prepare(spark)
    docs = table(spark, SF001, "documents")
    stage = dict(C.STAGES)
    assert list(stage) == ["quality_rules", "ngram_jaccard_join", "pii", "mixing", "sentencepiece"]
    rows = {r["doc_id"]: r for r in docs.collect()}

    good = settle(stage["quality_rules"](spark, docs, SF001), "t1")
    want = set()
    for i, r in rows.items():  # so few labels admit no cutoff: the base rules decide
        n, _, _, _, repeat, _ = Q.measure(r["text"])
        if not (n < 50 or 100 * repeat > 50 * n):
            want.add(i)
    assert {r["doc_id"] for r in good.collect()} == want and good.columns == docs.columns

    unique = settle(stage["ngram_jaccard_join"](spark, good, SF001), "t2")
    classes = brute({i: rows[i]["text"] for i in want})
    assert {r["doc_id"] for r in unique.collect()} == {c for c, _ in classes.values()}

    clean = settle(stage["pii"](spark, unique, SF001), "t3")
    assert clean.columns == docs.columns
    for r in clean.collect():
        assert r["text"] == pseudonymise(rows[r["doc_id"]]["text"], PSEUDONYM_KEY)[0] and r["n_chars"] == len(r["text"])

    mixed = settle(stage["mixing"](spark, clean, SF001), "t4")
    assert mixed.columns == docs.columns and set(Counter(r["doc_id"] for r in mixed.collect()).values()) <= {1, 2}

    last = stage["sentencepiece"](spark, mixed, SF001)
    assert last.count() == mixed.count() and last.filter("not round_trip").count() == 0
    key = lambda d: sorted((r["doc_id"], r["text"], len(r["ids"])) for r in d.collect())
    assert key(C.run(spark, SF001)) == key(last)
