"""The registered queries of this subpackage: op<N>_<name>, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecheck.llm import (best_fit_packing, language_id, merkle_manifest, mixing, multiprobe_search, ngram_jaccard_join, quality_rules, ranked_search,
                           suffix_dedup, token_counts, topk_search, toxicity, url_filters)
from lakecheck.sources.tables import load


def op1_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    """Classes of documents linked at 85 % Jaccard similarity of their 4-word shingles."""
    return ngram_jaccard_join.jaccard_classes(load(spark, sf, "documents"), words=4, num=85, den=100)


def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    d = load(spark, sf, "documents").select("doc_id", "text", "lang")
    out = language_id.identify(d, d.where(~language_id.held_out(F.col("doc_id"), 4, 2)))
    return out.select("doc_id", language_id.held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


def op3_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Place of every piece of every document in sequences of 1024 tokens."""
    return best_fit_packing.pack(load(spark, sf, "documents"))


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    out = toxicity.score(load(spark, sf, "documents"), load(spark, sf, "labels"), learn=toxicity.remainder(F.col("doc_id"), 3) != 1)
    held = F.coalesce(toxicity.remainder(F.col("doc_id"), 3) == 1, F.lit(False))           # NULL ids are not held out
    return out.select("doc_id", held.alias("held_out"), "score",
                      (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every document, found by scanning the flat token files made of all documents."""
    return token_counts.document_counts(load(spark, sf, "documents"))


def op6_topk_search(spark: SparkSession, sf: str) -> DataFrame:
    """The five highest integer inner products of every 50th vector, over all vectors."""
    return topk_search.top_k(load(spark, sf, "embeddings"), F.col("id") % 50 == 0)


def op7_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Measures and verdict of every document."""
    return quality_rules.judge(load(spark, sf, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the bytes of 200-byte strings that occur again."""
    return suffix_dedup.cut_repeats(load(spark, sf, "documents")).drop("kept_text")


def op9_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    """Verdict on every page's url.  A page's label is that of the document its url ends in: bad if toxic or of low quality."""
    pages = load(spark, sf, "pages").select("page_id", "url")
    labels = load(spark, sf, "labels").groupBy("doc_id").agg(F.max(((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int")).alias("bad"))
    doc = F.expr("try_cast(nullif(regexp_extract(url, '/([0-9]+)(?:[^/0-9][^/]*)?/?$', 1), '') as bigint)")
    labels = pages.select("page_id", doc.alias("doc_id")).join(labels, "doc_id").groupBy("page_id").agg(F.max("bad").alias("bad"))
    return url_filters.judge(pages, labels).select("page_id", "host", "path", "rule", "verdict")


def op10_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Calibrated factor and draw of every document, raked to source, language and topic marginals."""
    d = mixing.features(load(spark, sf, "documents").select("doc_id", "text", "source", "lang"))
    d = mixing.stored(d.drop("text"), "features")
    return mixing.calibrate(d).select("doc_id", "source", "lang", "topic", "n_tokens", F.round("factor", 6).alias("factor"),
                                      F.round("probability", 6).alias("probability"), "copies", "sampled")


def op11_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether it is verified after A-Z of the texts were
    lower-cased where 3 divides the crc32 of the id."""
    changed = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0,
                     F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    return merkle_manifest.verify(load(spark, sf, "documents"), {"text": changed})


def op12_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    """The ten best documents of every benchmark item, over all documents."""
    return ranked_search.search(load(spark, sf, "documents"), load(spark, sf, "benchmark"))


def op13_multiprobe_search(spark: SparkSession, sf: str) -> DataFrame:
    """The ten nearest vectors found of every 100th vector, over all vectors."""
    return multiprobe_search.nearest(load(spark, sf, "embeddings"), F.col("id") % 100 == 0)


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_language_id, op3_best_fit_packing, op4_toxicity, op5_token_counts, op6_topk_search,
    op7_quality_rules, op8_suffix_dedup, op9_url_filters, op10_mixing, op11_merkle_manifest, op12_ranked_search, op13_multiprobe_search)}
