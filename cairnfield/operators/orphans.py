"""References to records that do not exist.

Distinct non-null foreign keys are anti-joined with the parent keys; the keys that are in doubt are joined back to the
referring rows for a verdict per record and for counts per table and period. Only distinct keys meet the parents, so a
key that holds a third of all rows is compared once; the join back is left to the adaptive skew split.

Cases: null and blank keys are no references. Repeated rows give one row. Empty tables give no rows; an empty parent
makes every reference missing. A null LOADED_AT gives a null period and is never late. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnfield.functions.keys import key_form


@dataclass(frozen=True)
class Reference:
    """A column of one table that names records of another."""

    table: str
    column: str
    parent: str
    table_id: str = "ID"
    parent_id: str = "ID"
    loaded: str = "LOADED_AT"
    deleted: str = "DELETED_AT"


def orphans(child: DataFrame, parent: DataFrame, ref: Reference) -> DataFrame:
    """Distinct (table_name, record_id, period, kind) of the records of `child` whose reference finds no live, timely record."""
    rows = child.select(
        F.col(ref.table_id).cast("string").alias("record_id"), key_form(F.col(ref.column)).alias("k"), F.col(ref.loaded).alias("at")
    ).where("k is not null")
    gone = F.col(ref.deleted).isNotNull() if ref.deleted in parent.columns else F.lit(False)
    parents = (
        parent.select(key_form(F.col(ref.parent_id)).alias("k"), F.col(ref.loaded).alias("at"), gone.alias("gone"))
        .where("k is not null")
        .groupBy("k")
        .agg(F.min("at").alias("first"), F.min("gone").alias("gone"))
    )
    asked = rows.select("k").distinct()
    missing = asked.join(parents, "k", "left_anti").select("k", F.lit(None).cast("timestamp_ntz" if dict(parents.dtypes)["first"] == "timestamp_ntz" else "timestamp").alias("first"), F.lit("missing").alias("verdict"))
    found = asked.join(parents, "k").select("k", "first", F.when(F.col("gone"), "deleted").alias("verdict"))
    kind = F.coalesce("verdict", F.when(F.col("first") > F.col("at"), "late"))
    return (
        rows.join(missing.unionByName(found), "k")
        .select(F.lit(ref.table).alias("table_name"), "record_id", F.date_format("at", "yyyy-MM").alias("period"), kind.alias("kind"))
        .where("kind is not null")
        .distinct()
    )


def all_orphans(tables: dict[str, DataFrame], refs: Sequence[Reference]) -> DataFrame:
    """The orphans of every reference, one below the other."""
    return reduce(DataFrame.unionByName, [orphans(tables[r.table], tables[r.parent], r) for r in refs])


def orphan_counts(found: DataFrame) -> DataFrame:
    """Orphan references per table, period and kind."""
    return found.groupBy("table_name", "period", "kind").agg(F.count("*").alias("n_records"))
