"""A corpus made ready for training: five stages, each of them one operator of ``freight.llm``.

Every stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``; ordered by the last one's ``mix_slot`` and
``mix_row``, its rows are in the order of the mix.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freight.llm import byte_bpe, language, line_windows, mixing, simhash
from freight.llm.common import free_name, parted, table, written

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Shingle length and bits of the near-duplicate stage.
WORDS, RADIUS = 3, 2


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs``, with ``n_chars`` as the text now has it."""
    length = F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars")
    return docs.select(*(length if c == "n_chars" else F.col(c) for c in columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; those without a letter or with an ambiguous text go.

    The model learns from the labelled rows of its own input, without the held-out fifth.
    """
    model = language.train(docs.where(~parted("doc_id", 5, 0)))
    into = free_name(docs.columns, "language")
    marked = language.identify(docs, model, into=into)
    return marked.where(~F.col(into)["ambiguous"]).select(*docs.columns)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of three-line windows that occur earlier."""
    return _with_length(line_windows.dedup_lines(docs), docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return simhash.representatives(docs, words=WORDS, radius=RADIUS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix."""
    return mixing.mix(docs).orderBy("mix_slot", "mix_row").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their tokens, ids and the byte at which each token starts, and their place in the mix.

    The order of stored rows is lost when several files are read again, so ``mix_slot`` and ``mix_row`` carry it.
    They depend on the rows alone, so they are found again here as ``mix_sources`` had them, which may add no column.
    Columns of ``docs`` called like one of the four new ones are replaced, all others are kept.
    """
    new = ("token_ids", "token_offsets", "mix_slot", "mix_row")
    kept = [c for c in docs.columns if c.lower() not in new]
    mixed = mixing.mix(docs.select(*kept))
    into = free_name(mixed.columns, "tokens")
    rows = byte_bpe.encode_documents(mixed, RANKS, into=into)
    return rows.select(*kept, F.col(into)["ids"].alias("token_ids"), F.col(into)["offsets"].alias("token_offsets"), "mix_slot", "mix_row")


STAGES = [
    ("language", identify_language),
    ("line_dedup", remove_repeated_lines),
    ("near_duplicates", remove_near_duplicates),
    ("mix", mix_sources),
    ("tokens", encode),
]

#: SQL cannot train the language model or compute the hashes; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each but the last stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
