"""Paths and table fixtures of these tests; a test module imports what it uses."""

import pytest
from pyspark.sql import functions as F

from sluice.llm.common import prepare

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    """Builds a documents table from (doc_id, text[, lang[, source]]) rows."""
    prepare(spark)

    def make(rows):
        full = [(*r, *["en", "s"][len(r) - 2:], None)[:5] if len(r) < 5 else r for r in rows]
        full = [(i, t, g, s, None if t is None else len(t)) for i, t, g, s, _ in full]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture()
def odd(docs):
    """Null, empty, blank, very long, repeated and clashing rows, in one table."""
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 60_000), (5, "x" * 100_000), (None, "no key at all"),
            (6, "twice the same row"), (6, "twice the same row"), (7, "null source", None, None), (8, "\x1c  é 😀")]
    return docs(rows).withColumns({c: F.lit("clash") for c in (
        "row", "size", "copies", "target", "shard", "slot", "score", "pii", "ids", "kept", "stratum", "class_id")})
