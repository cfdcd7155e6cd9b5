"""Account selection: revenue, mail domains, samples and names alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnfield.functions.text import equal_width_bin, ratio
from cairnfield.session import spread


def average(total: Column, n: Column) -> Column:
    """The average to two digits, halves up, null for no rows."""
    return F.when(n > 0, F.floor(total * 100 / n + 0.5) / 100)


def revenue(lines: DataFrame, keys: Sequence[str], order_id: str, amount: str, least: float | None = None) -> DataFrame:
    """(keys, n_orders, revenue, avg_revenue) per account; only those of at least the given revenue."""
    total = F.sum(F.col(amount).cast("decimal(18,2)")).cast("double")
    out = lines.groupBy(*keys).agg(F.count_distinct(order_id).alias("n_orders"), total.alias("revenue"))
    out = out.withColumn("avg_revenue", average(F.col("revenue"), F.col("n_orders")))
    return out.where(F.col("revenue") >= least) if least is not None else out


def domain_frequency(df: DataFrame, key: str, address: Column, excluded: Sequence[str] = ()) -> DataFrame:
    """(key, domain, n): how often each domain occurs per key, without the excluded ones."""
    rows = df.select(F.col(key), address.alias("domain")).where("domain is not null and domain <> ''")
    return (rows.where(~F.col("domain").isin(list(excluded))) if excluded else rows).groupBy(key, "domain").agg(F.count("*").alias("n"))


def domain_mode(frequency: DataFrame, key: str) -> DataFrame:
    """(key, domain, n): the most frequent domain of each key, the first by name among equals."""
    best = frequency.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("m"), "domain", "n")).alias("b"))
    return best.select(key, "b.domain", "b.n")


def domain_modes(frequency: DataFrame, key: str) -> DataFrame:
    """(key, domain, n): all the most frequent domains of each key."""
    most = frequency.groupBy(key).agg(F.max("n").alias("n"))
    return frequency.join(most, [key, "n"]).select(key, "domain", "n")


def with_mode(df: DataFrame, frequency: DataFrame, key: str) -> DataFrame:
    """The rows with the most frequent domain of their key, null where it has none."""
    return df.join(domain_mode(frequency, key).drop("n"), key, "left")


def by_track_code(df: DataFrame, code: str, bins: int, account: str = "SOLD_ACCOUNT", track: str = "TRACK_CODE") -> DataFrame:
    """(account, n, bin): the accounts that have rows of a track code, how many, and their bin of so many equal widths."""
    rows = df.where((F.col(track) == code) & F.col(account).isNotNull()).groupBy(account).agg(F.count("*").alias("n"))
    ends = rows.agg(F.min("n").alias("_low"), F.max("n").alias("_high"))
    return rows.crossJoin(F.broadcast(ends)).select(account, "n", equal_width_bin(F.col("n"), F.col("_low"), F.col("_high"), bins).alias("bin"))


def slash_halves(c: Column) -> tuple[Column, Column]:
    """The parts before and after the first slash; the whole and null where there is none."""
    has = F.contains(c, F.lit("/"))
    return F.when(has, F.split_part(c, F.lit("/"), F.lit(1))).otherwise(c), F.when(has, F.split_part(c, F.lit("/"), F.lit(2)))


def draw(*parts: Column | int | str) -> Column:
    """A number of 60 bits that the parts' texts decide, the same in any engine that has md5."""
    text = F.concat_ws("|", *[F.lit(str(p)) if isinstance(p, int) else F.col(p).cast("string") if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def sample_bins(df: DataFrame, value: str, name: str, bins: int, per_bin: int, seed: int, id_col: str) -> DataFrame:
    """`per_bin` rows, drawn with replacement, of every bin of value and slash in the name; column `draw` numbers them."""
    low_high = df.agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    rows = df.crossJoin(F.broadcast(low_high)).withColumn("bin", equal_width_bin(F.col(value), F.col("_low"), F.col("_high"), bins)).withColumn("slash", F.contains(F.col(name), F.lit("/"))).drop("_low", "_high")
    groups = ["bin", "slash"]
    numbered = rows.withColumn("_i", F.row_number().over(Window.partitionBy(*groups).orderBy(draw(seed, id_col), id_col)))
    drawn = rows.groupBy(*groups).agg(F.count("*").alias("_n")).withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(per_bin))))
    drawn = drawn.withColumn("_i", (F.pmod(draw(seed, "bin", "slash", "draw"), F.col("_n")) + 1).cast("int"))
    return numbered.join(drawn.drop("_n"), [*groups, "_i"]).drop("_i")


def similar_names(df: DataFrame, id_col: str, name: str, target: str, threshold: int) -> DataFrame:
    """(id, name, similarity) of the names at least so alike to the target, itself left out."""
    rows = df.select(F.col(id_col), F.col(name)).where(F.col(name) != target)
    return rows.withColumn("similarity", ratio(F.upper(name), F.lit(target.upper()))).where(F.col("similarity") >= threshold)


def ranked_names(df: DataFrame, id_col: str, name: str, target: str, threshold: int) -> DataFrame:
    """`similar_names`, the most alike first."""
    return similar_names(df, id_col, name, target, threshold).orderBy(F.desc("similarity"), id_col)


def similar_pairs(df: DataFrame, id_col: str, name: str, threshold: int) -> DataFrame:
    """(target, id, name, similarity) of the names at least so alike to that of each row, the target, itself left out."""
    rows = df.select(F.col(id_col), F.col(name)).where(F.col(name).isNotNull()).distinct()
    low = spread(rows).select(F.col(id_col).alias("_id"), F.col(name).alias("_name"))
    pairs = low.crossJoin(rows).where(F.col("_id") < F.col(id_col)).withColumn("similarity", ratio(F.upper("_name"), F.upper(name))).where(F.col("similarity") >= threshold)
    one = lambda a, b, n: F.struct(F.col(a).alias("target"), F.col(b).alias(id_col), F.col(n).alias(name))
    both = pairs.select(F.explode(F.array(one("_id", id_col, name), one(id_col, "_id", "_name"))).alias("p"), "similarity")
    return both.select("p.*", "similarity")


def captured(c: Column, pattern: str, groups: Sequence[int], override: str | None = None, to: str | None = None) -> list[Column]:
    """The groups of a pattern in a text, null without a match; the first replaced where the text matches `override`."""
    out = [F.nullif(F.regexp_extract(c, pattern, g), F.lit("")) for g in groups]
    if override:
        out[0] = F.when(c.rlike(override), to).otherwise(out[0])
    return out
