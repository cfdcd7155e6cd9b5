"""Queries over names: the organisation that a typed name denotes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnfield.llm import names
from cairnfield.sources.tables import read


def _links(spark: SparkSession, folder: str) -> DataFrame:
    typed = read(spark, folder, "organization_soldto_account").where("ORGANIZATION_ID is null").select(F.col("ID").alias("id"), F.col("ACCOUNT_NAME").alias("name"))
    listed = read(spark, folder, "organization").select(F.col("ID").alias("id"), F.col("ORGANIZATION_NAME").alias("name"))
    return names.link(typed, listed)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """The listed organisation of each account without one."""
    return _links(spark, folder).select(F.col("typed_id").alias("account_row_id"), F.col("listed_id").alias("organization_id"))


def p5_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the similarity of the names."""
    return _links(spark, folder).select(F.col("typed_id").alias("account_row_id"), F.col("listed_id").alias("organization_id"), F.round("similarity", 6).alias("similarity"))


QUERIES = {f.__name__: f for f in (p5_found, p5_scores)}
SQL: dict[str, str] = {}
