"""Geography: geocodes from a cache and a provider, residential flags, distances and single-linkage clusters.

Clusters are the connected components of the pairs within the radius. Distinct coordinates of a group are taken first; they
fall into grid cells so small that any two points of a cell are within the radius, so a cell's points are linked through
one of them. Two neighbouring cells need but one pair within the radius to be linked, so every point is first held against one point of
each neighbouring cell; only cells that this leaves apart compare all their points.

Cases: rows without coordinates stay out of clusters; the date line is crossed; a pair at exactly the radius is not
within it. Cache rows without a formatted address are misses; of several hits the most accurate counts, the first by
coordinates among equals. Null flags are unknown and count as not residential.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnfield.operators.components import components
from cairnfield.session import cut

EARTH_M, RADIUS_M = 6371007.2, 100.0
CACHE_KEYS = ("ops_street", "ops_city", "ops_state", "ops_zip5", "organization_name")
FOUND = "accuracy double, type string, lat double, lon double, formatted_address string"


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres between two points in degrees."""
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_M) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def _around(row: Column, fine: float) -> Column:
    """How many cells a row of cells has round the earth: as wide at every latitude as at its edge nearest the equator."""
    edge = F.least(F.abs(row * F.lit(fine)), F.abs((row + 1) * F.lit(fine)))
    return F.greatest(F.lit(1), F.ceil(F.lit(360 / fine) * F.cos(F.radians(F.least(edge, F.lit(90.0)))))).cast("long")


def _places(df: DataFrame, id_col: str, group: str, lat: str, lon: str, radius: float) -> tuple[DataFrame, DataFrame]:
    """The distinct (id, g, lat, lon), and the distinct places (g, lat, lon, place, n, row, col) with their cells; `place` is
    the smallest id there, n how many ids."""
    points = df.where(f"{lat} between -90 and 90 and {lon} between -180 and 180 and {group} is not null").select(F.col(id_col).alias("id"), F.col(group).alias("g"), F.col(lat).alias("lat"), F.col(lon).alias("lon")).distinct()
    fine = radius / EARTH_M / 1.5 * 180 / math.pi  # any two points of a cell are within the radius: its diagonal is 0.95 of it
    places = points.groupBy("g", "lat", "lon").agg(F.min("id").alias("place"), F.count("*").alias("n")).withColumn("row", F.floor(F.col("lat") / fine).cast("long"))
    around = _around(F.col("row"), fine)
    return points, cut(places.withColumn("col", F.pmod(F.floor((F.col("lon") + 180) / 360 * around).cast("long"), around)))


def _next_cells(places: DataFrame, radius: float) -> DataFrame:
    """The places with every other cell (row, col) that the radius can reach from them: two rows up and down."""
    fine = radius / EARTH_M / 1.5 * 180 / math.pi
    near = places.select("place", "g", "lat", "lon", "n", F.col("row").alias("r0"), F.col("col").alias("c0"), F.explode(F.sequence(F.lit(-2), F.lit(2))).alias("dr")).withColumn("row", F.col("r0") + F.col("dr"))
    near = near.withColumn("around", _around(F.col("row"), fine))
    width = F.ceil(F.lit(1.5) / F.greatest(F.lit(1e-6), F.cos(F.radians(F.least(F.abs(F.col("lat")) + 0.01, F.lit(89.9999))))) * F.col("around") * F.lit(fine / 360)) + 1
    span = F.least(width.cast("long"), F.col("around") / 2 + 1).cast("long")
    centre = F.floor((F.col("lon") + 180) / 360 * F.col("around")).cast("long")
    near = near.withColumn("col", F.explode(F.sequence(centre - span, centre + span))).withColumn("col", F.pmod("col", F.col("around")))
    return near.where("not (row = r0 and col = c0)").select("place", "g", "lat", "lon", "n", "r0", "c0", "row", "col").distinct()


def _within(radius: float) -> Column:
    return haversine(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")) < radius


def neighbour_counts(df: DataFrame, id_col: str, group: str, lat: str = "LATITUDE", lon: str = "LONGITUDE", radius: float = RADIUS_M) -> DataFrame:
    """(id, n): how many other points of its group lie within the radius of each, points without any left out. Distinct places
    are compared, those of one cell and of neighbouring cells."""
    points, places = _places(df, id_col, group, lat, lon, radius)
    other = places.select("g", "row", "col", F.col("place").alias("p2"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), F.col("n").alias("n2"))
    outer = _next_cells(places, radius).join(other, ["g", "row", "col"]).where(_within(radius)).select("place", "lat", "lon", "g", "n2")
    # a cell's places are all within the radius of each other
    inner = places.join(places.groupBy("g", "row", "col").agg(F.sum("n").alias("n2")), ["g", "row", "col"]).select("place", "lat", "lon", "g", (F.col("n2") - 1).alias("n2"))
    found = inner.unionByName(outer).groupBy("g", "lat", "lon").agg(F.sum("n2").alias("k")).where("k > 0")
    return points.join(found, ["g", "lat", "lon"]).groupBy("id").agg(F.sum("k").alias("n"))


def clusters(df: DataFrame, id_col: str, group: str, lat: str = "LATITUDE", lon: str = "LONGITUDE", radius: float = RADIUS_M) -> DataFrame:
    """(id, cluster) of the distinct points that have another of their group within the radius; `cluster` is the smallest id."""
    points, places = _places(df, id_col, group, lat, lon, radius)
    cell = ["g", "row", "col"]
    heads = cut(places.groupBy(*cell).agg(F.min_by(F.struct("place", "lat", "lon"), "place").alias("h")).select(*cell, F.col("h.place").alias("head"), F.col("h.lat").alias("lat2"), F.col("h.lon").alias("lon2")))
    same = points.join(places.select("g", "lat", "lon", "place"), ["g", "lat", "lon"]).where("id <> place").select(F.col("id").alias("a"), F.col("place").alias("b"))
    inner = places.join(heads.select(*cell, "head"), cell).where("place <> head").select(F.col("place").alias("a"), F.col("head").alias("b"))
    near = cut(_next_cells(places, radius).drop("n"))
    sides = ["g", "r0", "c0", "row", "col"]
    by_head = cut(near.join(heads, cell).where(_within(radius)).groupBy(*sides).agg(F.min("place").alias("a"), F.min("head").alias("b")))
    # pairs of cells that no head links: either side may have found it
    both = by_head.select(*sides).unionByName(by_head.select("g", F.col("row").alias("r0"), F.col("col").alias("c0"), F.col("r0").alias("row"), F.col("c0").alias("col"))).distinct()
    apart = near.join(both, sides, "left_anti")
    other = places.select(*cell, F.col("place").alias("p2"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    outer = apart.join(other, cell).where((F.col("place") < F.col("p2")) & _within(radius)).select(F.col("place").alias("a"), F.col("p2").alias("b"))
    edges = same.unionByName(inner).unionByName(by_head.select("a", "b")).unionByName(outer)
    return components(edges).select(F.col("vertex").alias("id"), F.col("component").alias("cluster"))


def mode_of(c: str) -> Column:
    """The most frequent value, the smallest among equals; null for none."""
    return F.mode(c, deterministic=True)


def sites(df: DataFrame, id_col: str = "ID", group: str = "ORGANIZATION_ID") -> DataFrame:
    """A parent record for each cluster of two or more non-residential points, with its children's ids sorted."""
    live = df.where(F.col("IS_RESIDENTIAL") == F.lit(False)) if "IS_RESIDENTIAL" in df.columns else df
    member = live.join(clusters(live, id_col, group).withColumnRenamed("id", id_col), id_col)
    common = ["OPS_CITY", "OPS_STREET", "OPS_STATE", "OPS_ZIP5", "ORGANIZATION_NAME"]
    out = member.groupBy(F.col(group), "cluster").agg(*[mode_of(c).alias(c) for c in common], *[(F.sum(F.col(c).cast("decimal(18,9)")).cast("double") / F.count(c)).alias(c) for c in ("LATITUDE", "LONGITUDE")], F.array_sort(F.collect_set(id_col)).alias("children"))
    main = F.concat_ws(" ", "ORGANIZATION_NAME", "OPS_STATE", F.concat(F.lit("P"), F.left(F.sha1("cluster"), F.lit(8))))
    return out.withColumns(
        {
            "MAIN_LOC_NAME": main, "OPS_LOC_NAME": F.concat_ws(" ", main, "OPS_STREET", "OPS_CITY"), "ID": F.sha2(F.concat_ws(" ", F.lit("site"), "cluster"), 256), "OPS_SUBLOCATION": F.lit(""), "IS_SITE": F.lit(True), "IS_ADDRESS": F.lit(False),
            "IS_BUILDING": F.lit(False), "IS_RESIDENTIAL": F.lit(False), "CURATED": F.lit(False),
        }
    )


def best_of_cache(cache: DataFrame, keys: Sequence[str] = CACHE_KEYS) -> DataFrame:
    """One cache row per address: with a formatted address, the most accurate."""
    known = cache.where("formatted_address is not null")
    order = F.struct((-F.coalesce("accuracy", F.lit(-1.0))).alias("o"), "lat", "lon", "type", "formatted_address", "accuracy")
    return known.groupBy(*[F.coalesce(F.col(k), F.lit("")).alias(k) for k in keys]).agg(F.min(order).alias("b")).select(*keys, *[f"b.{c}" for c in ("accuracy", "type", "lat", "lon", "formatted_address")])


def split_by_cache(addresses: DataFrame, cache: DataFrame, keys: Sequence[str] = CACHE_KEYS) -> tuple[DataFrame, DataFrame]:
    """The distinct addresses that the cache knows, with their geocode, and those it doesn't."""
    asked = addresses.select(*[F.coalesce(F.col(k), F.lit("")).alias(k) for k in keys]).distinct()
    best = best_of_cache(cache, keys)
    return asked.join(best, list(keys)), asked.join(best, list(keys), "left_anti")


def geocode(addresses: DataFrame, cache: DataFrame, provider: Callable[[pd.DataFrame], pd.DataFrame] | None = None, keys: Sequence[str] = CACHE_KEYS, batch: int = 10_000, tries: int = 3) -> DataFrame:
    """A geocode for every distinct address: from the cache, else from the provider, which is asked once per address in
    batches of at most `batch` and returns a frame of `FOUND` in the same order. A batch that fails so many times, or whose
    answer has another length, gives nulls, as does a missing provider."""
    hits, misses = split_by_cache(addresses, cache, keys)
    schema = ", ".join([*[f"{k} string" for k in keys], FOUND])
    names = [x.split()[0] for x in FOUND.split(", ")]

    def answer(part: pd.DataFrame) -> pd.DataFrame:
        for _ in range(tries):
            try:
                got = provider(part)
                if len(got) == len(part):
                    return got.reset_index(drop=True)[names]
            except Exception:  # noqa: BLE001 - whatever a provider raises, the batch is tried again
                continue
        return pd.DataFrame({n: [None] * len(part) for n in names})

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for start in range(0, len(pdf), batch):
                part = pdf.iloc[start : start + batch].reset_index(drop=True)
                yield pd.concat([part, answer(part)], axis=1)

    if provider is None:
        found = misses.select(*keys, *[F.lit(None).cast(k).alias(c) for c, k in (x.split() for x in FOUND.split(", "))])
    else:
        found = misses.mapInPandas(ask, schema)
    return hits.unionByName(found)


def geocode_rows(df: DataFrame, columns: Sequence[str], cache: DataFrame, provider: Callable[[pd.DataFrame], pd.DataFrame] | None = None, keys: Sequence[str] = CACHE_KEYS) -> DataFrame:
    """The rows with the geocode of their address: `columns` name the rows' columns for the keys; every distinct address is
    looked up once and its geocode joined back to all its rows."""
    asked = df.withColumns({f"_{k}": F.coalesce(F.lower(F.col(c)) if k == "ops_street" else F.col(c), F.lit("")) for k, c in zip(keys, columns, strict=True)})
    found = geocode(asked.select(*[F.col(f"_{k}").alias(k) for k in keys]), cache, provider, keys).withColumnsRenamed({k: f"_{k}" for k in keys})
    return asked.join(found, [f"_{k}" for k in keys], "left").drop(*[f"_{k}" for k in keys])


def new_cache_rows(found: DataFrame, cache: DataFrame, keys: Sequence[str] = CACHE_KEYS) -> DataFrame:
    """The rows to append to the cache: geocodes with coordinates of addresses that it lacks, each once."""
    known = cache.select(*[F.coalesce(F.col(k), F.lit("")).alias(k) for k in keys]).distinct()
    return found.where("lat is not null and lon is not null").join(known, list(keys), "left_anti").dropDuplicates(list(keys))


def residential(df: DataFrame, lookup: DataFrame, keys: Sequence[str], svs: str = "svs_rdi", ups: str = "ups_rdi") -> DataFrame:
    """The rows with IS_RESIDENTIAL: true where either provider says so for their address, else false."""
    says = F.coalesce(F.col(svs) == "R", F.lit(False)) | F.coalesce(F.col(ups) == "Residential", F.lit(False))
    flags = lookup.groupBy(*keys).agg(F.max(says).alias("_r"))
    return df.drop("IS_RESIDENTIAL").join(flags, list(keys), "left").withColumn("IS_RESIDENTIAL", F.coalesce("_r", F.lit(False))).drop("_r")
