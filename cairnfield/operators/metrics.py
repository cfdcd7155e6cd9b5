"""Metrics of a run over many tables in one long format."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnfield.operators.dml import append


@dataclass(frozen=True)
class Metric:
    """A metric of one table: 'count', 'duplicates' of a key, or 'missing' parents of a key."""

    category: str
    entity: str
    kind: str
    key: str = ""
    parent: str = ""
    parent_key: str = ""


def _one(tables: dict[str, DataFrame], m: Metric) -> DataFrame:
    df = tables[m.entity]
    if m.kind == "duplicates":
        df = df.groupBy(m.key).agg(F.count("*").alias("n")).where("n > 1")
    elif m.kind == "missing":
        parent = tables[m.parent].select(F.col(m.parent_key).alias(m.key)).distinct()
        df = df.where(F.col(m.key).isNotNull()).join(parent, m.key, "left_anti")
    return df.agg(F.count("*").alias("result")).select(F.lit(m.category).alias("category"), F.lit(m.entity).alias("entity"), F.lit(m.kind).alias("metric"), "result", F.round(F.col("result") / 1e6).alias("in_millions"))


def run_metrics(tables: dict[str, DataFrame], metrics: Sequence[Metric], run_id: str) -> DataFrame:
    """(category, entity, metric, result, in_millions, run_id) of every metric."""
    return reduce(DataFrame.unionByName, [_one(tables, m) for m in metrics]).withColumn("run_id", F.lit(run_id))


def append_metrics(found: DataFrame, table: str) -> None:
    """Append a run's metrics to a table, with the time of their writing."""
    append(found.withColumn("created_at", F.current_timestamp()), table)
