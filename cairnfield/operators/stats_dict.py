"""Repairs of addresses by what is usual in their population: missing words, missing numbers, switched order.

Every rule works on the distinct addresses with their counts, by keys of tokens, so nothing is compared pairwise. The
rules' replacements are followed to the end as a forest, whose cycles are left as they are.

Cases: ties between equally frequent addresses fall to the first by text. Null and empty addresses are left alone. The
statistics hold within each scope where `by` names its columns; its nulls form a scope of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnfield.operators.hierarchy import forest
from cairnfield.session import cut

SEP = "\u0001"


def frequencies(df: DataFrame, address: str, by: Sequence[str] = ()) -> DataFrame:
    """(scope, address, tokens, n) of the distinct addresses; `scope` stands for the `by` columns."""
    scope = F.concat_ws(SEP, *[F.coalesce(F.col(c).cast("string"), F.lit("\u0002")) for c in by]) if by else F.lit("")
    rows = df.where(F.col(address) != "").select(scope.alias("scope"), F.col(address).alias("address"))
    return rows.groupBy("scope", "address").agg(F.count("*").alias("n")).withColumn("tokens", F.filter(F.split("address", r"\s+"), lambda t: t != ""))


def _usual(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The most frequent row of each key, the first by address among equals."""
    best = rows.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("m"), "address", "text")).alias("b"), F.count("*").alias("size"))
    return best.select(*keys, F.col("b.address").alias("address"), F.col("b.text").alias("text"), "size")


def _reduced(freq: DataFrame, keep: Callable[[Column], Column]) -> DataFrame:
    """The addresses whose remaining tokens are an address too; `key` holds them."""
    rows = freq.select("scope", "address", "n", F.array_join("tokens", " ").alias("text"), F.array_join(F.filter("tokens", keep), " ").alias("key")).where("key <> ''")
    return rows.join(freq.select("scope", F.array_join("tokens", " ").alias("key")).distinct(), ["scope", "key"], "left_semi")


def missing_tokens(freq: DataFrame, words: Sequence[str]) -> DataFrame:
    """(scope, key, address): an address without the given words, and the usual one that has them."""
    known = F.array(*map(F.lit, sorted(set(words))))
    return _usual(_reduced(freq, lambda t: ~F.array_contains(known, t)), ["scope", "key"]).where("text <> key").select("scope", "key", "address")


def missing_numbers(freq: DataFrame) -> DataFrame:
    """(scope, key, address): an address without a number, and the one that has it, where there is but one."""
    return _usual(_reduced(freq, lambda t: ~t.rlike(r"^\d+$")), ["scope", "key"]).where("size < 3 and text <> key").select("scope", "key", "address")


def switched_order(freq: DataFrame) -> DataFrame:
    """(scope, key, address): an address, and the usual order of the same tokens."""
    rows = freq.select("scope", "address", "n", F.array_join("tokens", " ").alias("text"), F.array_join(F.array_sort("tokens"), " ").alias("sorted"))
    usual = _usual(rows, ["scope", "sorted"]).where("size > 1").select("scope", "sorted", F.col("address").alias("best"))
    return rows.join(usual, ["scope", "sorted"]).where("address <> best").select("scope", F.col("text").alias("key"), F.col("best").alias("address"))


def dictionary(freq: DataFrame, words: Sequence[str]) -> DataFrame:
    """(scope, key, address) of all rules, the later rule first: switched order, missing numbers, missing words."""
    freq = cut(freq)  # every rule reads it
    rules = [missing_tokens(freq, words), missing_numbers(freq), switched_order(freq)]
    every = None
    for rank, rows in enumerate(rules):
        rows = rows.withColumn("rank", F.lit(-rank))
        every = rows if every is None else every.unionByName(rows)
    return every.groupBy("scope", "key").agg(F.min(F.struct("rank", "address"))["address"].alias("address"))


def resolved(rules: DataFrame) -> DataFrame:
    """(scope, key, address): every key with what following the rules leads to; those on or into a cycle left out."""
    links = rules.select(F.concat_ws(SEP, "scope", "key").alias("id"), F.concat_ws(SEP, "scope", F.array_join(F.filter(F.split("address", r"\s+"), lambda t: t != ""), " ")).alias("parent"))
    ends = forest(links.where("id <> parent")).where("not cyclic")
    last = lambda c: F.element_at(F.split(c, SEP), -1)
    scope = F.array_join(F.slice(F.split("id", SEP), 1, F.size(F.split("id", SEP)) - 1), SEP)
    return ends.select(scope.alias("scope"), last("id").alias("key"), last("top").alias("address"))


def repaired(df: DataFrame, address: str, words: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The rows with their address repaired."""
    freq = frequencies(df, address, by)
    scope = F.concat_ws(SEP, *[F.coalesce(F.col(c).cast("string"), F.lit("\u0002")) for c in by]) if by else F.lit("")
    fixes = resolved(dictionary(freq, words)).withColumnsRenamed({"address": "_to", "key": "_key", "scope": "_scope"})
    rows = df.withColumn("_scope", scope).withColumn("_key", F.array_join(F.filter(F.split(address, r"\s+"), lambda t: t != ""), " "))
    return rows.join(fixes, ["_scope", "_key"], "left").withColumn(address, F.coalesce("_to", address)).drop("_scope", "_key", "_to")
