"""A pipeline from raw documents to packed sequences: language ID, near duplicates, personal data, mixing, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import jaccard, langid, mixing, packing, pii
from ledgerline.llm.ship import ship
from ledgerline.llm.store import written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language that the labelled ones teach; texts without letters or in another language, and noise, go.

    A text goes if its best language knows less of its n-grams than 0.6 of the 1% quantile over that language's labelled texts.
    Null and empty texts go; without any labelled row all rows stay; see langid.kept for other odd rows.
    """
    ship(spark)
    return langid.kept(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by 0.8 of their five-word shingles, the one with the smallest id stays.

    Null and empty texts and rows without doc_id are in no group and stay; of repeated rows one stays. Ties cannot be: the
    smallest id decides, and rows that share it stay or go together.
    """
    ship(spark)
    return jaccard.one_per_group(docs, words=5, num=4, den=5)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts a mark in place of every span of personal data; no document goes.

    Null texts stay null, empty ones empty; repeated rows get the same text each; other columns stay, whatever their names.
    """
    return pii.masked(docs)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats sources of few tokens, as the packing counts them, by 1.25 passes at most; every document stays at least once.

    A null source is one of its own; a null or empty text counts as one token; rows that repeat id and text share their fate.
    """
    ship(spark)
    return mixing.mixture(docs, mixing.Target(passes=1.25), packing.vocabulary("byte_bpe_50k.json"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens, neighbours along the curve together.

    A null or empty text is its end mark alone; repeated rows are documents of their own; an empty table gives no rows.
    """
    ship(spark)
    return packing.pack(docs, packing.vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("ngram_jaccard_join", near_duplicates),
    ("pii", personal_data),
    ("source_mixing", mixing_weights),
    ("curve_packing", packed),
]

#: Learned filters, verified set joins and tokenizers are beyond SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's rows written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
