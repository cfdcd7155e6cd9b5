"""File sources and sinks: delimited files, scope files, run identity for a scheduler, column descriptions."""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cairnfield.operators.scopes import bucketed


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A delimited file with a header and a declared schema."""
    return spark.read.option("header", True).schema(schema).csv(path)


def read_training(spark: SparkSession, paths: Sequence[str], schema: StructType | str, min_rows: int) -> DataFrame:
    """The rows of those files that hold at least `min_rows`, with the file they come from."""
    rows = spark.read.option("header", True).schema(schema).csv(list(paths)).withColumn("file", F.input_file_name())
    return rows.join(rows.groupBy("file").agg(F.count("*").alias("n")).where(F.col("n") >= min_rows).select("file"), "file", "left_semi")


def write_distinct(df: DataFrame, path: str) -> None:
    """The distinct rows as a delimited file with a header."""
    df.distinct().write.mode("overwrite").option("header", True).csv(path)


def write_scopes(scopes: DataFrame, path: str) -> None:
    """Scopes by identifier, group and bucket, so that a worker reads only its own."""
    scopes.write.mode("overwrite").partitionBy("identifier", "group", "bucket").parquet(path)


def read_scopes(spark: SparkSession, path: str, identifier: str, group: str, bucket: int) -> DataFrame:
    """The scopes of one worker."""
    return spark.read.parquet(path).where((F.col("identifier") == identifier) & (F.col("group") == group) & (F.col("bucket") == bucket))


def number_workers(scopes: DataFrame, order: Sequence[str], workers: int, chunk: int) -> DataFrame:
    """The scopes with the worker (contiguous, the first taking the remainder) and the chunk within it of at most so many."""
    rows = bucketed(scopes, order, workers)
    return rows.withColumn("chunk", F.floor((F.row_number().over(Window.partitionBy("bucket").orderBy(*order)) - 1) / chunk).cast("int"))


def append_results(df: DataFrame, path: str) -> None:
    """Append result rows of a search to delimited files with a header."""
    df.write.mode("append").option("header", True).csv(path)


def write_run(path: str, run: dict[str, str]) -> None:
    """The identity of a run for the scheduler."""
    Path(path).write_text(json.dumps(run))


def describe_columns(df: DataFrame, descriptions: dict[str, str], name: str) -> str:
    """A YAML description of a table's columns; texts of several lines are written as blocks."""
    lines = ["version: 2", "models:", f"  - name: {name}", "    columns:"]
    for f in df.schema.fields:
        text = (descriptions.get(f.name) or "").strip()
        lines.append(f"      - name: {f.name}")
        if "\n" in text:
            lines += ["        description: |", *[f"          {x}" for x in text.splitlines()]]
        else:
            lines.append(f"        description: {json.dumps(text)}")
    return "\n".join(lines) + "\n"
