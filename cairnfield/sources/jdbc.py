"""Warehouse tables by JDBC, for sessions that have a driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, query: str, partition: tuple[str, int, int, int] | None = None, **options: str) -> DataFrame:
    """The result of a query, read in parallel where `partition` gives a column, its bounds and the number of parts."""
    reader = spark.read.format("jdbc").options(url=url, **options)
    if partition:
        column, low, high, n = partition
        return reader.options(dbtable=f"({query}) t", partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(n)).load()
    return reader.option("query", query).load()
