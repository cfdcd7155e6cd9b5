"""Incremental loads as streams: new rows appended once, and late references settled as their parents arrive."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cairnfield.operators.dml import insert_new


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where)


def append_new(stream: DataFrame, path: str, columns: Sequence[str], checkpoint: str, by: Sequence[str] = ()) -> StreamingQuery:
    """Append to a Parquet table the rows of each batch that it lacks, nulls being equal; a batch that is tried again
    finds its rows and adds none. With columns `by` the table is partitioned by them, and a batch is compared with the
    partitions that it holds rows of only. A table that can't be read is an error; only a missing one is empty."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        batch = batch.select(*columns)
        old = spark.read.schema(batch.schema).parquet(path) if _exists(spark, path) else batch.limit(0)
        if by:
            held = batch.select(*[F.col(c).alias(f"_{c}") for c in by]).distinct()
            match = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
            old = old.join(held, match, "left_semi")
        insert_new(old, batch, columns).write.mode("append").partitionBy(*by).parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def each_batch(stream: DataFrame, act: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Append what a batch function makes of every batch, in a folder of the batch's own, so that trying again replaces it."""

    def write(batch: DataFrame, n: int) -> None:
        act(batch).write.mode("overwrite").parquet(f"{path}/batch={n}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def open_rows(df: DataFrame, column: str = "OPS_LOCATION_ID") -> DataFrame:
    """The rows without an association yet."""
    return df.where(F.col(column).isNull())


def read_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stream of a table's Parquet parts, with the schema of what is there."""
    path = f"{folder}/{name}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).option("pathGlobFilter", "*.parquet").parquet(path)
