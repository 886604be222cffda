"""A training-corpus pipeline over ``documents``.

Five stages, each an operator of ``fitframe.llm`` applied to all that the one
before kept.  ``run`` writes every stage's result as Parquet into the shared
folder and reads it again for the next, so a lost executor repeats one stage
at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fitframe.llm import decontamination, ngram_join, quality_model, secret_scan, sentencepiece_bpe
from fitframe.llm.common import keep, small, table

# Near duplicates: shingles of five words, a Jaccard similarity of 0.8.
SHINGLE_WORDS, SIMILAR_NUM, SIMILAR_DEN = 5, 80, 100


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects.  All labels teach."""
    scored = quality_model.score_documents(docs, table(spark, sf_dir, "labels"))
    return _without(docs, scored.where("predicted = 0").select("id", "text_key"), "rejected")


def _without(docs: DataFrame, rows: DataFrame, name: str) -> DataFrame:
    """``docs`` without the rows of these ids and text hashes; the list is
    stored, and broadcast if its files are small."""
    rows = small(keep(rows.toDF("__id", "__key").distinct(), name))
    return docs.join(rows, docs["doc_id"].eqNullSafe(F.col("__id")) & F.xxhash64(docs["text"]).eqNullSafe(F.col("__key")), "left_anti")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the least id (of its texts,
    the one with the least hash; a missing id goes before none).  Of rows with
    the same id and text one stays."""
    groups = keep(ngram_join.similar_classes(docs, k=SHINGLE_WORDS, num=SIMILAR_NUM, den=SIMILAR_DEN)
                  .select(F.col("doc_id").alias("id"), "component_id", "text_key", "group_key"), "groups")
    copies = groups.where("component_id is not null and not id <=> component_id").select("id", "text_key")
    # rows of the least id itself, or of a group without ids, on several texts
    heads = groups.where("group_key is not null and id <=> component_id")
    several = heads.groupBy("group_key").agg(F.min("text_key").alias("first"), F.max("text_key").alias("last")).where("first <> last")
    others = heads.join(several, "group_key").where("text_key <> first").select("id", "text_key")
    kept = _without(docs, copies.unionByName(others), "copies")
    repeated = keep(groups.groupBy("id", "text_key").count().where("count > 1").select("id", "text_key"), "repeated")
    if repeated.isEmpty():
        return kept
    twice = small(repeated).select(F.col("id").alias("__id"), F.col("text_key").alias("__key"))
    again = kept.join(twice, kept["doc_id"].eqNullSafe(F.col("__id")) & F.xxhash64(kept["text"]).eqNullSafe(F.col("__key")), "left_semi")
    return _without(kept, repeated, "repeated-pairs").unionByName(again.dropDuplicates(["doc_id", "text"]))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item or its template."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; n_chars counts the new text."""
    clean = secret_scan.mask(docs, secret_scan.scan(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in clean.columns else clean


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, ids, n_tokens)``: every text as ids with the end id."""
    encoded = sentencepiece_bpe.encode(docs.select("doc_id", "text"), sentencepiece_bpe.default_path())
    return encoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("quality classifier", drop_low_quality),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("secret scan", mask_secrets),
    ("sentencepiece encoding", encode_pieces),
]

# Models and the encoder can't be stated in SQL; tests/llm hold the stages
# against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
