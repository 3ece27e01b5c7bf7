"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlens.llm import chat, decontam, html_extract, langid, lmscore, mixing, oracle, packing, quality, repair, rules, simhash, textstats, token_files, trie
from boardlens.llm.common import held_out, read_table
from boardlens.operators.lineage import checkpoint_folder, cut

WORD_BPE = "word_bpe_49k.json"


def tokenizer_path(name: str = WORD_BPE) -> str:
    """The place of a public tokenizer file; every executor has it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    pages = read_table(spark, d, "pages").select("page_id", "url", F.coalesce(html_extract.extract(F.col("html")), F.lit("")).alias("text"))
    return pages.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op2_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    stats = cut(quality.with_statistics(read_table(spark, d, "documents")))
    model = quality.fit_quality(stats, read_table(spark, d, "labels"))
    scored = stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), quality.score_udf(model)("stats").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.CUTOFF).cast("int"))


def op3_packing(spark: SparkSession, d: str) -> DataFrame:
    pieces = packing.token_pieces(read_table(spark, d, "documents"), tokenizer_path())
    packed = packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op4_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    stats = cut(read_table(spark, d, "documents").select("doc_id", textstats.text_statistics(F.col("text")).alias("stats")))
    found = rules.learn_rules(stats, read_table(spark, d, "labels"))
    return stats.select(
        "doc_id", *[F.col(f"stats.{n}").alias(n) for n in textstats.BASE], rules.base_failed().alias("base_failed"), rules.verdict(found).alias("kept")
    )


def op5_token_files(spark: SparkSession, d: str) -> DataFrame:
    path = f"{checkpoint_folder(spark)}/boardlens-{uuid.uuid4().hex}"
    token_files.write_token_files(read_table(spark, d, "documents"), path, tokenizer_path(), end_id=1)
    return token_files.read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontam.contaminated(read_table(spark, d, "documents"), read_table(spark, d, "benchmark"))


def op7_chat_formatting(spark: SparkSession, d: str) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").cast("int").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    turns = read_table(spark, d, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    read = chat.read_turns(cut(chat.format_conversations(turns)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars",
    )


def op8_language_id(spark: SparkSession, d: str) -> DataFrame:
    documents = read_table(spark, d, "documents")
    predict = langid.predict_udf(langid.fit_languages(documents))
    return documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("_p")).select("doc_id", "held_out", "_p.lang_pred", "_p.score")


def op9_lm_scoring(spark: SparkSession, d: str) -> DataFrame:
    """The target are the documents that ``labels`` marks as good, the background is every document."""
    documents = read_table(spark, d, "documents").select("doc_id", "text")
    good = read_table(spark, d, "labels").filter("quality = 1").select("doc_id", F.lit(True).alias("good")).distinct()
    return lmscore.scores(documents.join(good.hint("merge"), "doc_id", "left"), "good")  # the same plan for labels of any size


def op10_simhash_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, d, "documents"))


def op11_conversation_trie(spark: SparkSession, d: str) -> DataFrame:
    return trie.prefix_trie(trie.rebuilt(cut(trie.sequences(read_table(spark, d, "conversations")))))


def op12_source_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(read_table(spark, d, "documents"))


def op13_conversation_repair(spark: SparkSession, d: str) -> DataFrame:
    conversations = repair.by_conversation(read_table(spark, d, "conversations"))
    repaired = repair.repair(conversations.select("conv_id", repair.damaged(F.col("conv_id"), F.col("turns")).alias("turns")))
    lines = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    return repaired.withColumn("repaired_sha256", F.sha2(F.array_join(lines, "\n").cast("binary"), 256)).drop("repaired")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = [
        op1_html_extraction, op2_quality_classifier, op3_packing, op4_quality_rules, op5_token_files, op6_decontamination,
        op7_chat_formatting, op8_language_id, op9_lm_scoring, op10_simhash_near_dedup,
        op11_conversation_trie, op12_source_mixing, op13_conversation_repair,
    ]
    return {q.__name__: q for q in listed}


def oracle_sql() -> dict[str, str]:
    return oracle.statements()
