"""Queries over documents: token ids, mixtures and canonical forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cairnfield.llm import forms, mixing, tokens
from cairnfield.session import cut
from cairnfield.sources.tables import read


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The token ids of every document."""
    return tokens.encode_corpus(read(spark, folder, "documents"))


def _mixed(spark: SparkSession, folder: str) -> DataFrame:
    sizes = cut(tokens.token_counts(read(spark, folder, "documents"), ["doc_id", "source"]))
    return mixing.mixture(sizes, read(spark, folder, "mix_targets"))


def p8_mix(spark: SparkSession, folder: str) -> DataFrame:
    """How often each mixture takes each document."""
    return _mixed(spark, folder)


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The share that each source was to give and gave."""
    return mixing.shares(_mixed(spark, folder), read(spark, folder, "mix_targets"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of documents that differ only in characters that look the same or show nothing."""
    return forms.alike(read(spark, folder, "documents")).toDF("doc_id_a", "doc_id_b")


def p9_forms(spark: SparkSession, folder: str) -> DataFrame:
    """The one consistent form of every text."""
    return forms.canonical_corpus(read(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (p7_ids, p8_mix, p8_shares, p9_found, p9_forms)}
SQL: dict[str, str] = {}
