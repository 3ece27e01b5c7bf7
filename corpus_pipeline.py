"""Documents to packed training sequences: quality, rules, near duplicates, decontamination, packing.

Every stage reads the rows its predecessor kept. Null and empty texts are ordinary texts without words; null ids, repeated
rows and further columns are allowed; an empty table stays empty. All stages but the last return the columns given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlens.llm import decontam, packing, quality, queries, rules, similar, textstats
from boardlens.llm.common import read_table
from boardlens.operators.lineage import cut
from boardlens.session import ship_package


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labelled ones among them, predicts to be good.

    Labels meet the statistics only; texts are read again for the scores instead of being shuffled.
    """
    labels = read_table(spark, sf_dir, "labels")
    model = quality.fit_quality(cut(quality.with_statistics(docs)), labels)
    return docs.filter(quality.text_score_udf(model)("text") >= quality.CUTOFF)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and no rejecting rule matches."""
    labels = read_table(spark, sf_dir, "labels")
    stats = cut(docs.select("doc_id", textstats.text_statistics(F.col("text")).alias("stats")))
    found = rules.learn_rules(stats, labels)
    judged = docs.select(F.struct("*").alias("doc"), textstats.text_statistics(F.col("text")).alias("stats"))
    return judged.filter(rules.verdict(found)).select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return similar.distinct_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item; equal texts have one verdict."""
    key = similar.text_key(F.col("text")).alias("key")
    flagged = decontam.contaminated(docs.select("doc_id", "text", key), read_table(spark, sf_dir, "benchmark"), keep=("key",))
    return docs.select(F.struct("*").alias("doc"), key).join(flagged.select("key").distinct(), "key", "left_anti").select("doc.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the training sequences."""
    pieces = packing.token_pieces(docs, queries.tokenizer_path())
    packed = packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # learnt verdicts, fingerprints and token ids have no SQL form; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each one's result is a written table that the next one reads."""
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs
