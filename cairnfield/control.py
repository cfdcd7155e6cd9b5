"""Control of a run: timing records, time limits by cancelling jobs, and commits and resets as sequences of steps."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Sequence
from functools import wraps
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from cairnfield.operators import dml

#: Seconds that geocoding with a cache, the geocoding service and one scope's geocoding may take.
LIMITS = {"geocode": 900, "service": 3_600, "scope": 1_800}


def timed(log: Callable[[dict], None], **labels: Any) -> Callable:
    """A decorator that logs name, seconds, rows (of a result that has them without a job: len) and labels of every call."""

    def decorate(f: Callable) -> Callable:
        @wraps(f)
        def run(*args: Any, **kwargs: Any) -> Any:
            began = time.monotonic()
            result = f(*args, **kwargs)
            log({"function_name": f.__name__, "runtime_seconds": round(time.monotonic() - began, 3), "n_rows": len(result) if hasattr(result, "__len__") else None, **labels})
            return result

        return run

    return decorate


def within(spark: SparkSession, seconds: float, act: Callable[[], Any]) -> Any:
    """The result of `act`, whose Spark jobs are cancelled after so many seconds; then TimeoutError is raised."""
    tag, late = f"cairnfield-{uuid.uuid4().hex}", threading.Event()

    def stop() -> None:
        late.set()
        spark.sparkContext.cancelJobsWithTag(tag)

    timer = threading.Timer(seconds, stop)
    spark.sparkContext.addJobTag(tag)
    timer.start()
    try:
        return act()
    except Exception as failed:
        if late.is_set():
            raise TimeoutError(f"stopped after {seconds} s") from failed
        raise
    finally:
        timer.cancel()
        spark.sparkContext.removeJobTag(tag)


def committed(dims: dict[str, DataFrame], associations: dict[str, DataFrame], key: str = "ID") -> dict[str, DataFrame]:
    """The raw tables with OPS_LOCATION_ID and OPS_MATCH_SCORE of their associations (DIM_LOCATION_ID, OPS_LOCATION_ID,
    OPS_MATCH_SCORE), other rows as they were; the best association of a row counts, the smallest id among equals."""
    from pyspark.sql import functions as F

    out = {}
    for name, df in dims.items():
        best = associations[name].groupBy(F.col("DIM_LOCATION_ID").alias(key)).agg(F.min(F.struct((-F.col("OPS_MATCH_SCORE")).alias("s"), F.col("OPS_LOCATION_ID").alias("o"))).alias("b"))
        new = best.select(key, F.col("b.o").alias("OPS_LOCATION_ID"), (-F.col("b.s")).alias("OPS_MATCH_SCORE"))
        wide = df if "OPS_MATCH_SCORE" in df.columns else df.withColumn("OPS_MATCH_SCORE", F.lit(None).cast("double"))
        out[name] = dml.merge(wide, new, key, {"OPS_LOCATION_ID": "OPS_LOCATION_ID", "OPS_MATCH_SCORE": "OPS_MATCH_SCORE"})
    return out


def reset_all(tables: dict[str, DataFrame], emptied: Sequence[str], unlinked: dict[str, Sequence[str]]) -> dict[str, DataFrame]:
    """The tables of a run from the start: some emptied, of others the linking columns set to null."""
    return {n: dml.truncate(df) if n in emptied else dml.reset(df, unlinked[n]) if n in unlinked else df for n, df in tables.items()}


def replaced_clusters(ops: DataFrame, sites: DataFrame, children: str = "children") -> DataFrame:
    """The canonical rows with the old sites taken out, the new ones put in, and the children named after theirs."""
    from pyspark.sql import functions as F

    kept = dml.delete(ops, F.col("IS_SITE"))
    kept = dml.merge_children(kept, sites, "ID", children, "OPS_LOC_NAME", "MAIN_LOC_NAME")
    return kept.unionByName(sites.drop(children), allowMissingColumns=True).select(*ops.columns)
