"""One query per operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroseries.llm import conversation_repair, decontaminate, jaccard_join, langid, line_dedup, quality, resampling, sentencepiece_codec, substring_dedup, suffix_dedup, token_counts, token_store, url_filter
from aeroseries.llm.registry import ORACLES, QUERIES, query, table
from aeroseries.llm.vocab import public

__all__ = ["ORACLES", "QUERIES"]


@query("op1_quality_rules")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return quality.quality_rules(table(spark, sf_dir, "documents"), labels.where("quality = 1"))


@query("op4_substring_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.substring_dedup(table(spark, sf_dir, "documents")))


@query("op3_suffix_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents")))


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(~langid.held_out(docs["doc_id"])))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out(found["doc_id"]).alias("held_out"), "lang_pred", "score")


@query("op5_sentencepiece")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentencepiece_codec.encode_documents(docs, public("piece_bpe_32k.model"))
    return coded.select("doc_id", "ids", F.size("ids").alias("n_pieces"), "round_trip")


@query("op8_token_store")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_tokens(table(spark, sf_dir, "documents"), public("byte_bpe_50k.json"))


@query("op9_jaccard_join")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "n_copies")


@query("op6_line_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_figures(table(spark, sf_dir, "documents"), whole=True)


@query("op10_decontaminate", decontaminate.SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(*decontaminate.FIGURES)


@query("op7_url_filter", url_filter.SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query("op12_importance_resampling", resampling.SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_token_counts")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public("byte_bpe_50k.json"))


@query("op11_conversation_repair", conversation_repair.SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_figures(conversation_repair.damage(table(spark, sf_dir, "conversations")))
