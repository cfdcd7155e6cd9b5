"""Connected components of an undirected graph, by disjoint-set forests within buckets and label rounds across them.

Up to a stated number of edges one task solves the graph. Beyond it every bucket is first reduced to a spanning forest,
then each vertex takes the smallest label among its neighbours and jumps to that label's own label until nothing moves;
the edges that join two labels shrink from round to round.

Cases: repeated edges and self loops change nothing; edges with a null end are left out. Empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnfield.session import buckets, cut

BUCKET_EDGES = 2_000_000


def _labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vertices and the smallest vertex of each one's component."""
    names, codes = np.unique(np.concatenate([a, b]), return_inverse=True)  # sorted, so the smallest code is the smallest name
    x, y = codes[: len(a)], codes[len(a) :]
    at = np.arange(len(names))
    while True:
        low = np.minimum(at[x], at[y])
        new = at.copy()
        np.minimum.at(new, at[x], low)
        np.minimum.at(new, at[y], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == at).all():
            return names, names[at]
        at = new


def _solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = [df for df in batches if len(df)]
    if rows:
        df = pd.concat(rows)
        vertices, labels = _labels(df["a"].to_numpy(), df["b"].to_numpy())
        yield pd.DataFrame({"vertex": vertices, "component": labels})


def components(edges: DataFrame, a: str = "a", b: str = "b", bucket_edges: int = BUCKET_EDGES) -> DataFrame:
    """(vertex, component) of every vertex of an edge, `component` being the smallest vertex of its component."""
    edges = cut(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null"))
    kind = edges.schema["a"].dataType.simpleString()
    schema = f"vertex {kind}, component {kind}"
    n = edges.count()
    if n <= bucket_edges:
        return edges.coalesce(1).mapInPandas(_solve, schema)
    labels = edges.select(F.explode(F.array("a", "b")).alias("vertex")).distinct().withColumn("component", F.col("vertex"))
    rest = edges
    while n:
        local = rest.repartition(buckets(n, bucket_edges)).mapInPandas(_solve, schema)
        rest = cut(local.where("vertex <> component").select(F.col("vertex").alias("a"), F.col("component").alias("b")).distinct())
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("component"), F.least("a", "m").alias("m"))
        jump = cut(low.join(low.select(F.col("component").alias("m"), F.col("m").alias("m2")), "m", "left").select("component", F.coalesce("m2", "m").alias("to")))
        labels = cut(labels.join(jump, "component", "left").select("vertex", F.coalesce("to", "component").alias("component")))
        to = jump.select(F.col("component").alias("a"), F.col("to").alias("ta"))
        rest = rest.join(to, "a").join(to.select(F.col("a").alias("b"), F.col("ta").alias("tb")), "b").where("ta <> tb").select(F.col("ta").alias("a"), F.col("tb").alias("b")).distinct()
        rest = cut(rest)
        n = rest.count()
    return labels
