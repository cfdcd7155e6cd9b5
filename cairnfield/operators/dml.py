"""Changes of tables as pure functions from the old rows to the new, for storage without update in place."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def insert_new(old: DataFrame, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows to append: the distinct new ones that the table lacks, nulls being equal; extra columns are ignored."""
    return rows.select(*columns).subtract(old.select(*columns))


def truncate(old: DataFrame) -> DataFrame:
    """No rows, the same columns."""
    return old.limit(0)


def reset(old: DataFrame, columns: Sequence[str], where: Column | None = None) -> DataFrame:
    """The columns set to null, everywhere or where the condition holds."""
    kinds = dict(old.dtypes)
    null = {c: F.lit(None).cast(kinds[c]) for c in columns}
    return old.withColumns(null if where is None else {c: F.when(where, v).otherwise(F.col(c)) for c, v in null.items()})


def reset_in(old: DataFrame, column: str, key: str, keys: DataFrame) -> DataFrame:
    """The column set to null where the row's key is among the keys (their first column)."""
    marks = keys.select(F.col(keys.columns[0]).alias(key)).where(f"{key} is not null").distinct().withColumn("_hit", F.lit(True))
    return old.join(marks, key, "left").withColumn(column, F.when(F.col("_hit").isNull(), F.col(column))).select(*old.columns)


def delete(old: DataFrame, where: Column) -> DataFrame:
    """The rows without those for which the condition is true; unknown keeps a row."""
    return old.where(~F.coalesce(where, F.lit(False)))


def merge(old: DataFrame, new: DataFrame, key: str, updates: dict[str, str]) -> DataFrame:
    """The columns (old: new) taken from the matching row where there is one; `new` holds each key once."""
    side = new.select(F.col(key), *[F.col(n).alias(f"_new_{o}") for o, n in updates.items()], F.lit(True).alias("_hit"))
    return old.join(side, key, "left").withColumns({o: F.when(F.col("_hit"), F.col(f"_new_{o}")).otherwise(F.col(o)) for o in updates}).select(*old.columns)


def merge_children(old: DataFrame, parents: DataFrame, key: str, children: str, name: str, to: str) -> DataFrame:
    """`to` of every row that a parent lists in its array of children set to the parent's name; the smallest of several wins."""
    listed = parents.select(F.explode(children).alias(key), F.col(name).alias("_n")).groupBy(key).agg(F.min("_n").alias("_n"))
    return old.join(listed, key, "left").withColumn(to, F.coalesce("_n", to)).select(*old.columns)


def apply(old: DataFrame, steps: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """The steps one after the other."""
    return reduce(lambda df, step: step(df), steps, old)


def append(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> None:
    """Append to a table, creating it if there is none."""
    (df.select(*columns) if columns else df).write.mode("append").saveAsTable(table)


def write(df: DataFrame, table: str, truncate_table: bool = False) -> None:
    """Append to a table or replace its rows."""
    df.write.mode("overwrite" if truncate_table else "append").saveAsTable(table)


def for_each_row(df: DataFrame, act: Callable[[Row], None]) -> None:
    """Call `act` for every row where it lies, partition by partition; a join serves better where it can."""
    df.foreachPartition(lambda rows: [act(r) for r in rows] and None)
