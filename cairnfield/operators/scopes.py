"""Scopes: the blocks of keys that work is cut into, their sizes, groups and buckets.

A scope is a row of key columns, so one semi-join selects the rows of many scopes exactly; Catalyst decides by size
whether to send it to all executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnfield.functions.text import edge_bin
from cairnfield.session import cut


@dataclass(frozen=True)
class ScopeSpec:
    """The keys of a scope, SQL expressions for them on the raw (`dim`) and the canonical (`ops`) side, and the condition
    of an incremental run."""

    name: str
    keys: tuple[str, ...]
    dim: dict[str, str] = field(default_factory=dict)
    ops: dict[str, str] = field(default_factory=dict)
    open_dim: str = "OPS_LOCATION_ID is null"
    open_ops: str = "true"

    def _side(self, df: DataFrame, side: dict[str, str], only: str | None) -> DataFrame:
        return (df.where(only) if only else df).withColumns({k: F.expr(side.get(k, k)) for k in self.keys})

    def dim_rows(self, df: DataFrame, incremental: bool = False) -> DataFrame:
        """The raw rows with the scope's keys."""
        return self._side(df, self.dim, self.open_dim if incremental else None)

    def ops_rows(self, df: DataFrame, incremental: bool = False) -> DataFrame:
        """The canonical rows with the scope's keys."""
        return self._side(df, self.ops, self.open_ops if incremental else None)


    def get_dim(self, df: DataFrame, scopes: DataFrame | None = None, incremental: bool = False) -> DataFrame:
        """The raw rows of the given scopes, or of all."""
        rows = self.dim_rows(df, incremental)
        return rows if scopes is None else in_scopes(rows, scopes, self.keys)

    def get_ops(self, df: DataFrame, scopes: DataFrame | None = None, incremental: bool = False) -> DataFrame:
        """The canonical rows of the given scopes, or of all."""
        rows = self.ops_rows(df, incremental)
        return rows if scopes is None else in_scopes(rows, scopes, self.keys)

    def dim_sizes(self, df: DataFrame, incremental: bool = False, id_col: str = "ID") -> DataFrame:
        """(keys, size) of the raw side."""
        return sizes(self.dim_rows(df, incremental), self.keys, id_col)

    def ops_sizes(self, df: DataFrame, incremental: bool = False, id_col: str = "ID") -> DataFrame:
        """(keys, size) of the canonical side."""
        return sizes(self.ops_rows(df, incremental), self.keys, id_col)


def _zip3(c: str) -> str:
    return f"left(trim({c}), 3)"


#: The four ways to cut the location tables.
SPECS = {
    "sales_order": ScopeSpec("sales_order", ("ORGANIZATION_ID", "STATE"), ops={"STATE": "OPS_STATE"}),
    "soldto": ScopeSpec("soldto", ("ORGANIZATION_ID", "ZIP3"), {"ZIP3": _zip3("ZIP5")}, {"ZIP3": _zip3("OPS_ZIP5")}),
    "dnb": ScopeSpec("dnb", ("STATE", "ZIP3"), {"STATE": "PHYS_ST_ABRV", "ZIP3": _zip3("PHYS_ZIP5")}, {"STATE": "OPS_STATE", "ZIP3": _zip3("OPS_ZIP5")}, "true", "DNB_DIM_LOCATION_ID is null"),
    "keepstock": ScopeSpec("keepstock", ("ACCOUNT",)),
}


def sizes(df: DataFrame, keys: Sequence[str], id_col: str | None = None, low: int | None = None, high: int | None = None) -> DataFrame:
    """(keys, size): rows, or distinct ids, per scope; null keys left out; only sizes from `low` to `high` where given."""
    out = df.dropna(subset=list(keys)).groupBy(*keys).agg((F.count_distinct(id_col) if id_col else F.count("*")).alias("size"))
    return out.where(F.col("size").between(low, high)) if low is not None and high is not None else out


def match_sizes(dim: DataFrame, ops: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, size): the candidate pairs of each scope, 0 where one side lacks it."""
    d, o = dim.withColumnRenamed("size", "_d"), ops.withColumnRenamed("size", "_o")
    return d.join(o, list(keys), "full").select(*keys, F.coalesce(F.col("_d") * F.col("_o"), F.lit(0)).alias("size"))


def in_scopes(df: DataFrame, scopes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose keys form one of the scopes."""
    return df.join(scopes.select(*keys).distinct(), list(keys), "left_semi")


def grouped(scopes: DataFrame, edges: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """The scopes with the group of their size, (edge, next edge]; those at or below the first edge are left out."""
    return scopes.withColumn("group", edge_bin(F.col("size"), edges, labels)).where(F.col("group").isNotNull())


def ranked(df: DataFrame, order: Sequence[str], name: str = "rank") -> DataFrame:
    """The rows with their place 1 … n in the order: ranges of the order are sorted apart and counted, each range begins
    after the rows of those before it. The order should tell all rows apart."""
    parts = cut(df.repartitionByRange(*[F.col(c) for c in order]).withColumn("_part", F.spark_partition_id()))
    counts = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).alias("_before"))  # a row per range
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + F.coalesce("_before", F.lit(0))
    return parts.join(F.broadcast(before), "_part").withColumn(name, place).drop("_part", "_before")


def _share(rank: Column, rows: Column, n: int) -> Column:
    """The bucket 0 … n-1 of a rank among so many rows, the first buckets taking the remainder."""
    size, more = F.floor(rows / n), rows % n
    return F.when(rank <= more * (size + 1), F.floor((rank - 1) / (size + 1))).otherwise(more + F.floor((rank - 1 - more * (size + 1)) / size)).cast("int")


def bucketed(scopes: DataFrame, order: Sequence[str], n: int, per: Sequence[str] = ()) -> DataFrame:
    """The scopes with a bucket 0 … n-1, contiguous in the order, the first ones taking the remainder."""
    if per:
        return scopes.withColumn("bucket", F.ntile(n).over(Window.partitionBy(*per).orderBy(*order)) - 1)
    rows = scopes.agg(F.count("*").alias("_rows"))
    return ranked(scopes, order).crossJoin(F.broadcast(rows)).withColumn("bucket", _share(F.col("rank"), F.col("_rows"), n)).drop("rank", "_rows")


def capped(scopes: DataFrame, order: Sequence[str], most: int | None) -> DataFrame:
    """The first scopes of the order, as many as asked for; all without a number."""
    return scopes if most is None else scopes.orderBy(*order).limit(most)


@dataclass(frozen=True)
class Group:
    """A group of scopes: sizes above `above` up to the next group's, worked on in chunks of so many."""

    name: str
    above: float
    chunk: int


#: The groups of each way to cut the tables, by rows of a scope or, for matching, by its pairs.
GROUPS = {
    "sales_order": (Group("small", -1, 16_000), Group("medium", 1_000, 100), Group("large", 10_000, 5)),
    "sales_order_full": (Group("small", -1, 16_000), Group("medium", 1_000, 100), Group("large", 10_000, 5), Group("huge", 30_000, 1)),
    "soldto": (Group("all", -1, 3_000),),
    "keepstock": (Group("all", -1, 100),),
    "dnb": (Group("SM", 0, 100), Group("MD", 8.3e7, 100), Group("LG", 4.09e8, 10), Group("HG", 1.5e9, 10)),
}


def in_groups(scopes: DataFrame, groups: Sequence[Group], order: Sequence[str], most: int | None = None) -> DataFrame:
    """The scopes with their group and the chunk of it that they are worked on in; at most so many scopes of each group."""
    out = grouped(scopes, [g.above for g in groups], [g.name for g in groups])
    place = F.row_number().over(Window.partitionBy("group").orderBy(F.desc("size"), *order))
    chunk = F.create_map(*[F.lit(x) for g in groups for x in (g.name, g.chunk)])[F.col("group")]
    out = out.withColumn("_place", place).withColumn("chunk", F.floor((F.col("_place") - 1) / chunk).cast("int"))
    return (out.where(F.col("_place") <= most) if most is not None else out).drop("_place")


def shuffled(df: DataFrame, seed: int, *keys: str) -> DataFrame:
    """The rows in a random order that the seed repeats."""
    return df.orderBy(F.xxhash64(F.lit(seed), *keys), *keys)
