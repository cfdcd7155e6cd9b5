"""Bridge rows between locations and the site they name: each member at level 0, each link at level 1."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FLAGS = ("parent_is_top", "parent_is_bottom", "child_is_top", "child_is_bottom")


def bridge(df: DataFrame, id_col: str, name: str, main: str) -> DataFrame:
    """(location_id_p, location_id_c, levels_removed, flags). The parent of a group is the row whose own name is the
    group's, else the smallest id; rows without a group stand alone with all flags true. Repeated ids count once; blank
    group names count as none."""
    rows = df.select(F.col(id_col).alias("id"), F.col(name).alias("name"), F.when(F.trim(F.col(main)) != "", F.col(main)).alias("main")).distinct()
    head = rows.where("main is not null").groupBy("main").agg(F.min(F.struct((~F.coalesce(F.col("name") == F.col("main"), F.lit(False))).alias("other"), F.col("id")))["id"].alias("head"))
    member = rows.join(head, "main").select("id", "head").distinct()
    flags = lambda *f: [F.lit(x).alias(c) for c, x in zip(FLAGS, f, strict=True)]
    is_head = F.col("id") == F.col("head")
    own = member.select(F.col("id").alias("location_id_p"), F.col("id").alias("location_id_c"), F.lit(0).alias("levels_removed"), is_head.alias("parent_is_top"), (~is_head).alias("parent_is_bottom"), is_head.alias("child_is_top"), (~is_head).alias("child_is_bottom"))
    link = member.where(~is_head).select(F.col("head").alias("location_id_p"), F.col("id").alias("location_id_c"), F.lit(1).alias("levels_removed"), *flags(True, False, False, True))
    alone = rows.where("main is null").select(F.col("id").alias("location_id_p"), F.col("id").alias("location_id_c"), F.lit(0).alias("levels_removed"), *flags(True, True, True, True)).distinct()
    return own.unionByName(link).unionByName(alone)
