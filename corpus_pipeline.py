"""Corpus pipeline: STAGES applied to ``documents`` in order, each written and reread.

A stage works on all rows that the one before has kept, and its decisions
take effect: texts judged bad go, one document of each near-duplicate group
stays, contaminated documents go, documents are left out or repeated by the
mix, and what remains is dealt to shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.llm import decontamination, mixing, ngram_join, quality_classifier, sharding
from stellate.llm.common import bounded, materialise, table

#: Near duplicates in the pipeline: word shingles and percent of similarity.
SHINGLE_WORDS, SIMILARITY = 5, 80


def _without(docs: DataFrame, verdicts: DataFrame, tag: str) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, text_hash) is not in ``verdicts``."""
    gone = bounded(verdicts.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), tag)
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash")), "left_anti")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier accepts."""
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.scored(docs, model).where("_score >= 0.5").select(docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each component of near duplicates; of
    rows repeated with that id and text, one. Texts without words all stay."""
    found = materialise(ngram_join.jaccard_components(docs, SHINGLE_WORDS, SIMILARITY), "dedup")
    per = found.groupBy("doc_id", "text_hash").agg(F.count_if("is_first").alias("first"), F.count(F.lit(1)).alias("rows"))
    per = materialise(per, "dedup-rows")
    out = _without(docs, per.where("first = 0"), "dedup-gone")
    repeated = per.where("first > 0 AND first < rows").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    if repeated.isEmpty():
        return out
    repeated = bounded(repeated, "dedup-repeated")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    # rows that repeat an id with its text are alike, so any one of them will do
    return out.join(repeated, same, "left_anti").unionByName(
        out.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without too much of the benchmark."""
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("contaminated"), "contaminated")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated as often as the mix takes them, 0 times included."""
    copies = mixing.mix(docs).groupBy("doc_id", "tie").agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
    copies = bounded(copies.select(F.col("doc_id").alias("_id"), F.col("tie").alias("_hash"), "_copies", "_rows"), "mix-taken")
    if not copies.where("_rows > 1").isEmpty():  # rows repeated with id and text: one stands for all
        docs = docs.dropDuplicates(["doc_id", "text"])
    rows = docs.join(copies, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash")))
    rows = rows.where("_copies > 0").withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    return rows.select(docs.columns)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's shard and slot."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
    ("sharding", sharding_stage),
]
#: Classifier, similarity join and mix are not SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; each one's rows are written before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-").lower())
    return docs
