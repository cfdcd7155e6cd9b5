"""Table sources: Parquet tables of a data folder and a run-suffixed catalog."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table `name` of a data folder (a file or a directory of parts)."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


@dataclass(frozen=True)
class Catalog:
    """Names of tables whose schemas carry the suffix of a run; `unsuffixed` schemas never do."""

    suffix: str = ""
    unsuffixed: tuple[str, ...] = ()

    def name(self, schema: str, table: str) -> str:
        """`schema<suffix>.table`."""
        return f"{schema}{'' if schema in self.unsuffixed else self.suffix}.{table}"

    def table(self, spark: SparkSession, schema: str, table: str) -> DataFrame:
        """The table under its suffixed schema."""
        return spark.table(self.name(schema, table))
