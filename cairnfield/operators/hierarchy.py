"""Parent-child links to full hierarchies.

Every record has at most one parent, so the links form trees and, where the data is broken, cycles. Each bucket of links
is solved by a weighted disjoint-set forest: path compression gives every record the top of its local tree and its
offset from it. Tops that have a parent in another bucket are the only records of the next level, where they are merged
the same way; what they resolve to is added to the offsets of the level below. Where a level doesn't shrink (long chains
cut at every link), pointers are doubled across buckets first, so the number of rounds stays logarithmic in the depth.
No task ever holds more than one bucket.

Paths are materialised by traversal along the parent index, doubling the known stretch of each path in every round.

Cases: records without a name can't be parents. A null or blank parent name is no link, an unknown one makes its record
a root. Repeated rows count once; where one id has several rows with different parents, the smallest parent wins. A
record that is its own parent is a cycle of one. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnfield.functions.keys import name_form
from cairnfield.session import buckets, cut

#: Links that one task solves at once (about 100 bytes each while it works).
BUCKET_ROWS = 1_000_000
FOREST = "id string, top string, off long, cyclic boolean, on_cycle boolean"


def links_by_name(df: DataFrame, id_col: str, name_col: str, parent_col: str, every: bool = False) -> DataFrame:
    """Distinct (id, parent) for every record that names a parent, or for `every` record; parent is null where no record
    has the name and where none is named."""
    rows = df.select(F.col(id_col).cast("string").alias("id"), name_form(F.col(name_col)).alias("name"), name_form(F.col(parent_col)).alias("parent_name"))
    named = rows.where("name is not null").groupBy("name").agg(F.min("id").alias("parent")).withColumnRenamed("name", "parent_name")
    return rows.where("id is not null" if every else "parent_name is not null and id is not null").join(named, "parent_name", "left").groupBy("id").agg(F.min("parent").alias("parent"))


def _compress(ids: np.ndarray, parents: np.ndarray, weights: np.ndarray) -> pd.DataFrame:
    """Path compression over the links of one bucket: top, offset, and for each record whether it leads into or is on a cycle."""
    codes, names = pd.factorize(np.concatenate([ids, parents]))
    n, m = len(ids), len(names)
    at, off = np.arange(m), np.zeros(m, np.int64)
    at[codes[:n]], off[codes[:n]] = codes[n:], weights
    child = np.zeros(m, bool)
    child[codes[:n]] = True
    for _ in range(int(math.log2(m + 1)) + 1):  # beyond m steps, so only cycles go on
        off, at = off + off[at], at[at]
    cyclic = child[at]
    on = np.zeros(m, bool)
    on[at[cyclic]] = True  # all steps lead onto the cycle, where they permute it
    c = codes[:n]
    return pd.DataFrame({"id": ids, "top": names[at[c]], "off": np.where(cyclic[c], 0, off[c]), "cyclic": cyclic[c], "on_cycle": on[c]})


def _solve_bucket(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = [df for df in batches if len(df)]
    if rows:
        df = pd.concat(rows)
        yield _compress(df["id"].to_numpy(object), df["parent"].to_numpy(object), df["w"].to_numpy(np.int64))


def _double(edge: DataFrame, rounds: int) -> DataFrame:
    """Pointer doubling across buckets; what still moves after more steps than there are edges is on its way round a cycle."""
    state = edge.select("id", "top", "off", "cyclic")
    for _ in range(rounds):
        up = state.select(F.col("id").alias("top"), F.col("top").alias("_top"), F.col("off").alias("_off"), F.col("cyclic").alias("_cyclic"))
        state = cut(
            state.join(up, "top", "left").select(
                "id", F.coalesce("_top", "top").alias("top"), (F.col("off") + F.coalesce("_off", F.lit(0))).alias("off"), (F.col("cyclic") | F.coalesce("_cyclic", F.lit(False))).alias("cyclic")
            )
        )
    moving = edge.select(F.col("id").alias("top"), F.lit(True).alias("_moves"))
    return state.join(moving, "top", "left").select("id", "top", "off", (F.col("cyclic") | F.coalesce("_moves", F.lit(False))).alias("cyclic"))


def _forest(links: DataFrame, n: int, bucket_rows: int) -> DataFrame:
    """(id, top, off, cyclic) for more than one bucket of links (id, parent, w)."""
    local = cut(links.repartition(buckets(n, bucket_rows), "id").mapInPandas(_solve_bucket, FOREST).drop("on_cycle"))
    edge = cut(local.join(local.where("not cyclic").select(F.col("top").alias("id")).distinct(), "id", "left_semi"))
    m = edge.count()
    if m <= bucket_rows or m <= n // 2:
        links = edge.select("id", F.when(F.col("cyclic"), F.col("id")).otherwise(F.col("top")).alias("parent"), F.col("off").alias("w"))
        high = links.coalesce(1).mapInPandas(_solve_bucket, FOREST) if m <= bucket_rows else _forest(links, m, bucket_rows)
    else:
        high = _double(edge, int(math.log2(m + 1)) + 1)
    up = high.select(F.col("id").alias("top"), F.col("top").alias("_top"), F.col("off").alias("_off"), F.col("cyclic").alias("_cyclic"))
    return local.join(up, "top", "left").select(
        "id", F.coalesce("_top", "top").alias("top"), (F.col("off") + F.coalesce("_off", F.lit(0))).alias("off"), (F.col("cyclic") | F.coalesce("_cyclic", F.lit(False))).alias("cyclic")
    )


def forest(links: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(id, top, off, cyclic, on_cycle) for the links (id, parent), ids unique, no null: the topmost ancestor and the
    number of links to it; records that lead into a cycle are `cyclic`, those on it also `on_cycle`."""
    links = cut(links.select("id", "parent", F.lit(1).cast("long").alias("w")))
    n = links.count()
    if n <= bucket_rows:
        return links.coalesce(1).mapInPandas(_solve_bucket, FOREST)
    out = cut(_forest(links, n, bucket_rows))
    rings = on_cycles(links.join(out.where("cyclic").select("id"), "id", "left_semi"), bucket_rows)
    return out.join(rings.withColumn("_on", F.lit(True)), "id", "left").select("id", "top", "off", "cyclic", F.coalesce("_on", F.lit(False)).alias("on_cycle"))


def on_cycles(links: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The ids on a cycle, of links all of which lead into one: the image of more steps than there are links."""
    links = cut(links)
    n = links.count()
    if n <= bucket_rows:
        return links.coalesce(1).mapInPandas(_solve_bucket, FOREST).where("on_cycle").select("id")
    step = links.select("id", F.col("parent").alias("top"))
    for _ in range(int(math.log2(n)) + 1):
        step = cut(step.join(step.select(F.col("id").alias("top"), F.col("top").alias("next")), "top").select("id", F.col("next").alias("top")))
    return step.select(F.col("top").alias("id")).distinct()


def resolve(links: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(id, root_id, depth) of every record of `links_by_name`: depth 0 for a root, root_id 'cycle' with depth -1 on a
    cycle and -2 where the ancestors lead into one."""
    links = cut(links)
    solved = forest(links.where("parent is not null"), bucket_rows).select(
        "id", F.when(F.col("cyclic"), "cycle").otherwise(F.col("top")).alias("root_id"), F.when(F.col("on_cycle"), -1).when(F.col("cyclic"), -2).otherwise(F.col("off")).cast("int").alias("depth")
    )
    return solved.unionByName(links.where("parent is null").select("id", F.col("id").alias("root_id"), F.lit(0).alias("depth")))


def paths(links: DataFrame, bucket_rows: int = BUCKET_ROWS, cycles: bool = False) -> DataFrame:
    """(id, root_id, depth, path) of every record not led into a cycle, `path` holding the ids from the root to the record;
    with `cycles` the others too, as `resolve` gives them, their path null."""
    links = cut(links)
    every = cut(resolve(links, bucket_rows))
    solved = every.where("depth >= 0")
    deepest = solved.agg(F.max("depth")).first()[0] or 0
    walk = cut(solved.join(links, "id").select("id", F.when(F.col("depth") > 0, F.array("parent", "id")).otherwise(F.array("id")).alias("path")))
    for _ in range(math.ceil(math.log2(deepest)) if deepest > 1 else 0):
        up = walk.select(F.col("id").alias("_head"), F.col("path").alias("_up")).where(F.size("path") > 1)
        head = F.when(F.size("path") > 1, F.col("path")[0])
        walk = cut(walk.join(up, head == F.col("_head"), "left").select("id", F.when(F.col("_up").isNull(), F.col("path")).otherwise(F.concat("_up", F.slice("path", 2, F.size("path")))).alias("path")))
    return every.join(walk, "id", "left" if cycles else "inner")


def descendants(walks: DataFrame) -> DataFrame:
    """(ancestor_id, descendant_id, levels) of every record below another, from the result of `paths`."""
    return walks.select(F.col("id").alias("descendant_id"), F.posexplode("path").alias("pos", "ancestor_id"), "depth").where("pos < depth").select("ancestor_id", "descendant_id", (F.col("depth") - F.col("pos")).cast("int").alias("levels"))
