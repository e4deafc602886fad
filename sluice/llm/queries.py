"""The registered queries of this package, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import importance, licences, line_dedup, merkle, mil, mixing, ngram_join, pieces, posting_lists, pseudonyms, quality_rules, sharding, url_rules
from .common import prepare, settle, table

#: Where the tokenizer's file lies; every operator takes its path as a parameter.
SENTENCEPIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: The key of the registered query. Real use passes a secret of its own.
PSEUDONYM_KEY = b"registered query, not a secret"


def op1_attention_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels that are not held out."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    out = mil.score(docs, mil.fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", mil.held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced, and where."""
    prepare(spark)
    return pseudonyms.with_pseudonyms(table(spark, sf_dir, "documents"), PSEUDONYM_KEY).select("doc_id", "text", "pii")


def op3_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards, uniformly shuffled (law ``rows``)."""
    prepare(spark)
    out = sharding.shuffle_to_shards(table(spark, sf_dir, "documents"), 40)
    return out.select("doc_id", F.coalesce(F.octet_length("text") + 16, F.lit(16)).cast("long").alias("size"),
                      F.crc32("text").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op4_association_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page. A page carries the label of the
    document with its number; low quality and toxic ones are to be blocked."""
    prepare(spark)
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    marks = labels.groupBy("doc_id").agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad"))
    labelled = pages.join(marks, F.col("page_id") == F.col("doc_id")).select("url", (F.col("bad") == 1).alias("blocked"))
    return url_rules.judge(pages.select("page_id", "url"), labelled).select(
        "page_id", "host", "path", "rule", "verdict")


def op5_licence_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licence sentences and recognised licences of every document, as text."""
    prepare(spark)
    out = licences.scan(table(spark, sf_dir, "documents"))
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), " ").alias(c)
    return out.select("doc_id", text("sentence_ids"), text("line_ids"), text("licences"))


def op6_balanced_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    prepare(spark)
    return posting_lists.search(table(spark, sf_dir, "embeddings"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    prepare(spark)
    out = pieces.encode_documents(table(spark, sf_dir, "documents"), SENTENCEPIECE_MODEL)
    return out.select("doc_id", F.size("ids").alias("n_ids"), "ids", "round_trip")


def op8_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    prepare(spark)
    out = quality_rules.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document, for 5-grams and 0.8."""
    prepare(spark)
    return ngram_join.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "copy_of", "n_links")


def op10_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    prepare(spark)
    out = mixing.pareto_mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("size") * F.col("copies")).alias("taken"))


def op11_cuckoo_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten documents or more share."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    out = line_dedup.LineIndex.empty(spark, threshold=10, min_chars=1).insert(docs).clean(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, towards the texts of ``benchmark``."""
    prepare(spark)
    weighed = importance.weigh(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    narrow = settle(weighed.select("doc_id", "n_words", "n_features", "weight"), "weights")
    return importance.draw(narrow).select("doc_id", "n_features", "weight", "score", "rank")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document. Where 7 divides the
    checksum of doc_id the leaf is checked with one character more than it has."""
    prepare(spark)
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    n_chars = F.col("n_chars").cast("decimal(20,0)")
    checked = merkle.leaf_digest([F.when(hit, n_chars + 1).otherwise(n_chars) if c == "n_chars" else F.col(c)
                                  for c in merkle.FIELDS])
    out = merkle.manifest(table(spark, sf_dir, "documents"), carry={"checked": checked})
    out = out.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                     merkle.folded(F.col("checked"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_attention_mil, op2_feistel_pseudonyms, op3_hypergeometric_shards, op4_association_url_rules,
    op5_licence_sentences, op6_balanced_posting_lists, op7_sentencepiece, op8_risk_controlled_rules,
    op9_ngram_jaccard_join, op10_pareto_mix, op11_cuckoo_line_dedup,
    op12_importance_resampling, op13_merkle_manifest)}

ORACLES: dict[str, str] = {
    "op4_association_url_rules": url_rules.SQL,
    "op5_licence_sentences": licences.SQL,
    "op8_risk_controlled_rules": quality_rules.SQL,
    "op9_ngram_jaccard_join": ngram_join.SQL,
    "op10_pareto_mix": mixing.SQL,
    "op11_cuckoo_line_dedup": line_dedup.SQL,
    "op12_importance_resampling": importance.SQL,
    "op13_merkle_manifest": merkle.SQL,
}
