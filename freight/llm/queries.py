"""The operators as queries over whole tables, with production parameters, and the SQL that checks them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freight.llm import attention_lm, byte_bpe, fill_middle, language, licenses, line_windows, mixing, pivots, repeats, simhash, spelling, toxicity, winnowing
from freight.llm.common import parted, table

BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang", parted("doc_id", 5, 0).alias("held_out"))
    model = language.train(documents.where("not held_out"))
    return language.identify(documents, model).select("doc_id", "held_out", "language.*")


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", parted("doc_id", 4, 2).alias("held_out"))
    labels = table(spark, folder, "labels").where(~parted("doc_id", 4, 2))
    model = toxicity.train(documents.where("not held_out"), labels)
    scored = toxicity.score_documents(documents, model, into="score")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op3_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.edits(table(spark, folder, "documents"))


def op4_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.digests(repeats.remove_repeats(table(spark, folder, "documents")))


def op5_line_windows(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_windows.dedup_lines(table(spark, folder, "documents"))
    n_chars = F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars")
    return kept.select("doc_id", "lang", "source", "text", n_chars, "n_lines", "n_removed")


def op6_attention_lm(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", parted("doc_id", 7, 2).alias("held_out"), "text")
    return attention_lm.score_documents(documents, attention_lm.train(documents.where("not held_out"), BPE_RANKS))


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.token_digests(table(spark, folder, "documents"), BPE_RANKS)


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), words=3, radius=2)


def op10_pivots(spark: SparkSession, folder: str) -> DataFrame:
    return pivots.top_inner_products(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op11_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.summaries(table(spark, folder, "documents"))


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.text_variants(table(spark, folder, "documents"), every=97)


def op13_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.digests(table(spark, folder, "documents"))


QUERIES = {
    "op1_language": op1_language,
    "op2_toxicity": op2_toxicity,
    "op3_winnowing": op3_winnowing,
    "op4_repeats": op4_repeats,
    "op5_line_windows": op5_line_windows,
    "op6_attention_lm": op6_attention_lm,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_mixing": op8_mixing,
    "op9_simhash": op9_simhash,
    "op10_pivots": op10_pivots,
    "op11_licenses": op11_licenses,
    "op12_spelling": op12_spelling,
    "op13_fill_middle": op13_fill_middle,
}

ORACLES: dict[str, str] = {
    "op5_line_windows": line_windows.ORACLE,
    "op8_mixing": mixing.ORACLE,
    "op10_pivots": pivots.ORACLE,
    "op11_licenses": licenses.ORACLE,
    "op13_fill_middle": fill_middle.ORACLE,
}
