"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; ``run`` writes each result as Parquet to the shared folder and reads it
again for the next stage. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import mixing, ngram_join, pieces, pseudonyms, quality_rules
from sluice.llm.common import prepare, settle, table
from sluice.llm.queries import PSEUDONYM_KEY, SENTENCEPIECE_MODEL


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a risk-controlled cutoff reject go."""
    prepare(spark)
    return quality_rules.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a 5-gram Jaccard similarity of 0.8 or more one stays."""
    prepare(spark)
    return ngram_join.one_per_class(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates, addresses and secrets become pseudonyms;
    ``n_chars`` follows the text."""
    prepare(spark)
    out = pseudonyms.with_pseudonyms(docs, PSEUDONYM_KEY)
    n_chars = F.char_length("text").cast(dict(docs.dtypes)["n_chars"])
    return out.withColumn("n_chars", F.when(F.size("pii") > 0, n_chars).otherwise(F.col("n_chars"))).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    prepare(spark)
    return mixing.expand(mixing.pareto_mix(docs), docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids."""
    prepare(spark)
    return pieces.encode_documents(docs, SENTENCEPIECE_MODEL).drop("decoded")


STAGES = [("quality_rules", quality), ("ngram_jaccard_join", near_duplicates), ("pii", private_data),
          ("mixing", mix), ("sentencepiece", tokens)]

#: The pseudonyms of stage 3 are beyond SQL; the test compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)


QUERIES = {"pipeline": pipeline}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
