"""The corpus pipeline: documents are filtered, deduplicated, mixed and packed.

Each stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept; all but the last return
the columns of ``documents``.  ``run`` writes each stage's result as Parquet in the shared scratch folder and reads
it back, so a lost executor costs at most one stage's tasks, and removes what the stage no longer needs.

Defined cases: documents with NULL or empty texts pass the filters and are packed as an end token; documents of
one near-duplicate class leave the smallest id, whatever number of rows an id has; equal texts without words stay
once an id; a document whose bytes all repeat stays with an empty text; mixing repeats the rows of documents with a
factor above 1, and each copy is packed as a document; rows with NULL ids are documents of their own, compared and
cut like others, the last of their class; columns that are not of ``documents`` are carried to the last stage,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecheck.llm import best_fit_packing, mixing, ngram_jaccard_join, suffix_dedup, toxicity
from lakecheck.llm.common import bounded, keep_only, made, stored
from lakecheck.sources.tables import load

TOXIC = 0.7            # documents that score so high go
ORACLE_SQL = None      # the stages are not SQL; tests hold them against brute force


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the class-conditional models call toxic."""
    scored = toxicity.score(docs, load(spark, sf_dir, "labels"), refit=False)
    gone = stored(scored.where(F.col("score") >= TOXIC).select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct(), "toxic")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("hash"), F.struct("*").alias("doc"))
    same = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("hash") == F.col("gone_hash"))
    return rows.join(bounded(gone), same, "left_anti").select("doc.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of five-word-shingle similarity 0.8 or more: the first by id (NULL last), hash of the
    text and the other columns.  Rows are told apart by keys of their own, so repeated and NULL ids are compared too;
    only keys and order columns are moved to choose, not the texts."""
    own = {c: f"c{k}" for k, c in enumerate(docs.columns)}                              # names that cannot clash with keys
    doc_id, text = F.col(own["doc_id"]), F.col(own["text"]).cast("string")
    rest = [F.col(name) for c, name in own.items() if c not in ("doc_id", "text")]
    rows = stored(docs.select(F.monotonically_increasing_id().alias("row"), *[F.col(c).alias(name) for c, name in own.items()]), "rows")
    classes = stored(ngram_jaccard_join.jaccard_classes(rows, id_col="row", text_col=own["text"], words=5, num=80, den=100), "row-classes")
    many = classes.groupBy(F.col("component_id").alias("class")).agg(F.count("*").alias("n")).where("n > 1").select("class")
    place = F.struct(doc_id.isNull(), doc_id, F.xxhash64(text), *rest, F.col("row"))
    member = classes.select("row", F.col("component_id").alias("class")).join(many, "class").join(rows.select("row", place.alias("place")), "row")
    first = member.groupBy("class").agg(F.min("place").alias("place"))
    gone = stored(member.join(first.withColumnRenamed("place", "first"), "class").where(F.col("place") != F.col("first")).select("row"), "near-copies")
    kept = rows.join(bounded(gone), "row", "left_anti")
    bare = doc_id.isNotNull() & (mixing.tokens(text) == 0)                              # these have no class
    one = kept.where(bare).dropDuplicates([own["doc_id"], own["text"]])
    return kept.where(~bare).union(one.select(kept.columns)).select(*[F.col(name).alias(c) for c, name in own.items()])


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 200-byte strings that occur again."""
    rest = {c: f"carried_{k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text", "n_chars")}
    rows = docs.select("doc_id", "text", *[F.col(c).alias(name) for c, name in rest.items()])
    out = suffix_dedup.cut_repeats(rows, carry=tuple(rest.values()))                    # keys the rows itself
    made = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return out.select(*[made.get(c, F.col(rest.get(c, c))).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its calibrated factor of source, language and topic says."""
    drawn = F.coalesce(F.col("doc_id").cast("string"), F.md5("text"))       # rows without an id draw by their texts
    rows = mixing.features(docs.select("source", "lang", "text", drawn.alias("draw"), F.struct("*").alias("doc"))).drop("text")
    return mixing.repeat(mixing.calibrate(rows, id_col="draw")).select("doc.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece in sequences of 1024 tokens."""
    return best_fit_packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_copies), ("repeated_passages", cut_passages),
          ("mixing", mix_sources), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs, start = load(spark, sf_dir, "documents"), made()
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        keep_only(spark, start, docs)                    # the stage's own tables and its predecessor's rows go
    return STAGES[-1][1](spark, docs, sf_dir)
