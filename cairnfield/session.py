"""Sessions, shared scratch space and lineage cuts."""

from __future__ import annotations

import math
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Defaults of a session this engine builds for itself; a given session keeps its own settings.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(name: str = "cairnfield", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, Arrow and UTC; `conf` entries (dots as `__`) override the defaults."""
    builder = SparkSession.builder.appName(name).config(map=DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()})
    return (builder.master(master) if master else builder).getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of `spark.checkpoint.dir`; a folder of our own only where neither it nor the context names one and
    the session runs on this machine alone. On a cluster a missing setting is an error, as executors share no such folder."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not sc.getCheckpointDir():
        if not found and not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = found or tempfile.mkdtemp(prefix="cairnfield-")
        sc.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint, which survives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def buckets(rows: int, per_bucket: int) -> int:
    """How many buckets hold `rows` rows at about `per_bucket` each."""
    return max(1, math.ceil(rows / per_bucket))


def parallelism(spark: SparkSession) -> int:
    """Partitions for work that costs much a row: what the session shuffles into, and no fewer than its cores."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores where the files that the plan reads are too small to be split for all of them; larger ones are
    left as they are, without a shuffle. Nothing is run to find out."""
    spark = df.sparkSession
    leaves, conf = df._jdf.queryExecution().optimizedPlan().collectLeaves(), spark._jsparkSession.sessionState().conf()
    size = sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    cores = spark.sparkContext.defaultParallelism
    piece = min(conf.filesMaxPartitionBytes(), max(conf.filesOpenCostInBytes(), (size + conf.filesOpenCostInBytes()) / cores))
    return df.repartition(parallelism(spark)) if math.ceil(size / piece) < cores else df
