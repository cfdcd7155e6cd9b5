"""Curation pipelines: raw records of a scope become canonical locations with the ids of the records they stand for.

Cases: rows without a valid street are left out; null fields are empty texts. The ids of a location are sorted. Of
several markers or coordinates of one location the smallest is taken. Repeated rows add up. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnfield.functions.text import content_id, joined, ratio, title_case
from cairnfield.operators import address as A
from cairnfield.operators.stats_dict import repaired
from cairnfield.session import cut, parallelism

TEXT = ("STREET", "STREET_NUM", "CITY", "STATE", "ZIP5", "DEPARTMENT", "ATTENTION", "SUPPLEMENTAL", "RECEIVER")
OTHERS = ("DEPARTMENT", "ATTENTION", "SUPPLEMENTAL", "RECEIVER")
GEO = {"LATITUDE": "double", "LONGITUDE": "double", "GEOCODE_LEVEL": "string", "GEOCODE_ACCURACY": "double"}


#: The counts of a row and the columns that they are counted over.
COUNTS = {"ADDRESS_cnt": ("ADDRESS",), "ADDRESS_CITY_ZIP5_cnt": ("ADDRESS", "CITY", "ZIP5"), "SUBLOCATION_LVL1_cnt": ("ADDRESS", "SUBLOCATION_LVL1"), "ADDRESS_RAW_cnt": ("STREET", "CITY", "STATE", "ZIP5")}


def counts(df: DataFrame, of: dict[str, Sequence[str]] | None = None, counted: str = "STREET") -> DataFrame:
    """The rows with how often their address, its place, its sub-location and its raw form occur, rows without `counted` not
    being counted. Each count is aggregated and joined back; rows whose key's first column is null count 0 and join nothing."""
    for name, (lead, *more) in (of or COUNTS).items():
        there = df.where(F.col(lead).isNotNull())
        sums = there.groupBy(F.col(lead), *[F.col(k).alias(f"_{k}") for k in more]).agg(F.count(counted).alias(name)).withColumnRenamed(lead, f"_{lead}")
        match = [F.col(lead) == F.col(f"_{lead}"), *[F.col(k).eqNullSafe(F.col(f"_{k}")) for k in more]]
        counted_rows = there.join(sums, match).drop(f"_{lead}", *[f"_{k}" for k in more])
        df = counted_rows.unionByName(df.where(F.col(lead).isNull()).withColumn(name, F.lit(0).cast("long")))
    return df


def precurate(df: DataFrame, by: Sequence[str] = (), rules: A.Rules | None = None, with_counts: bool = True) -> DataFrame:
    """The rows with ADDRESS, SUBLOCATION_LVL1, SUBLOCATION_LVL2, IS_INTERSECTION, OPS_MARKER and, if wanted, the counts.
    The distinct combinations of the address fields are inferred once each; statistics hold within the scope columns `by`."""
    rules = rules or A.Rules()
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit("")) if c in df.columns else F.lit("") for c in TEXT})
    fields = ["STREET_NUM", "STREET", *OTHERS]
    # a stated number of partitions, as the rules cost more than their bytes tell the adaptive coalescing
    inferred = df.select(*fields).repartition(parallelism(df.sparkSession), *fields).distinct().withColumn("_a", A.infer_columns(F.col("STREET_NUM"), F.col("STREET"), [F.col(c) for c in OTHERS], rules))
    df = df.join(cut(inferred), fields).withColumns({"ADDRESS": A.special(F.col("_a.address")), "SUBLOCATION_LVL1": F.col("_a.lvl1"), "SUBLOCATION_LVL2": F.col("_a.lvl2")}).drop("_a")
    df = df.withColumn("IS_INTERSECTION", A.is_intersection(F.col("ADDRESS")))
    df = repaired(df, "ADDRESS", sorted(set(rules.suffixes.values())), by)
    df = df.withColumn("OPS_MARKER", A.marker(F.col("SUBLOCATION_LVL1")))
    return counts(df) if with_counts else df


def _canonical(df: DataFrame, keys: Sequence[str], id_col: str, extra: dict[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(id_col)).alias("DIM_LOCATION_ID"), *[c.alias(n) for n, c in extra.items()])


def _with_geo(df: DataFrame, geocodes: DataFrame | None) -> DataFrame:
    """Coordinates of the address from a table of (OPS_STREET, OPS_CITY, OPS_STATE, OPS_ZIP5), nulls without one."""
    if geocodes is None:
        return df.withColumns({c: F.lit(None).cast(k) for c, k in GEO.items()})
    keys = ["OPS_STREET", "OPS_CITY", "OPS_STATE", "OPS_ZIP5"]
    return df.join(geocodes.groupBy(*keys).agg(F.min(F.struct(*GEO)).alias("_g")), keys, "left").withColumns({c: F.col(f"_g.{c}") for c in GEO}).drop("_g")


def sales_locations(pre: DataFrame, id_col: str = "ID", geocodes: DataFrame | None = None, rules: A.Rules | None = None) -> DataFrame:
    """Canonical locations of precurated sales-order rows: valid streets by place, sub-location and organisation."""
    rules = rules or A.Rules()
    org = ["ORGANIZATION_ID", "ORGANIZATION_NAME"]
    rows = pre.select(F.col("ADDRESS").alias("OPS_STREET"), F.col("CITY").alias("OPS_CITY"), F.col("STATE").alias("OPS_STATE"), F.col("ZIP5").alias("OPS_ZIP5"), F.col("SUBLOCATION_LVL1").alias("OPS_SUBLOCATION"), "OPS_MARKER", *org, F.col(id_col).alias("_id"))
    rows = rows.where(A.is_valid(F.col("OPS_STREET"), True, rules))
    rows = rows.withColumn("OPS_STREET", A.ordinals(A.without_garbage(F.col("OPS_STREET"), rules), sorted(set(rules.suffixes.values()))))
    place = ["OPS_STREET", "OPS_CITY", "OPS_STATE", "OPS_ZIP5"]
    out = _with_geo(_canonical(rows, [*place, "OPS_SUBLOCATION", *org], "_id", {"OPS_MARKER": F.min("OPS_MARKER")}), geocodes)
    is_building = F.col("OPS_MARKER").isNotNull()
    out = out.withColumns({"OPS_LOC_NAME": F.trim(F.concat_ws(" ", F.col("ORGANIZATION_ID").cast("string"), F.lit("@"), "OPS_STREET", "OPS_SUBLOCATION")), "IS_ADDRESS": ~is_building, "IS_BUILDING": is_building, "IS_SITE": F.lit(False), "CURATED": F.lit(False)})
    out = with_parents(out, [*place, *org])
    return out.withColumn("ID", content_id("ORGANIZATION_NAME", *place, "OPS_SUBLOCATION"))


def with_parents(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MAIN_LOC_NAME of the buildings of an address that has exactly one row of its own: that row's name."""
    w = Window.partitionBy(*keys)
    one = F.count(F.when(F.col("IS_ADDRESS"), 1)).over(w) == 1
    name = F.max(F.when(F.col("IS_ADDRESS"), F.col("OPS_LOC_NAME"))).over(w)
    return df.withColumn("MAIN_LOC_NAME", F.when(F.col("IS_BUILDING") & one, name))


def fill_state(df: DataFrame, zips: DataFrame, state: str = "STATE", code: str = "ZIP5") -> DataFrame:
    """A blank state filled from the zip."""
    of = zips.groupBy(F.col("ZIP5").alias(code)).agg(F.min("STATE").alias("_state"))
    return df.join(of, code, "left").withColumn(state, F.coalesce(F.nullif(F.trim(F.col(state)), F.lit("")), F.col("_state"))).select(*df.columns)


def soldto_locations(pre: DataFrame, id_col: str = "ID", geocodes: DataFrame | None = None, rules: A.Rules | None = None) -> DataFrame:
    """Canonical locations of precurated sold-to rows: no sub-locations, no intersections, no parents."""
    rules = rules or A.Rules()
    org = ["ORGANIZATION_ID", "ORGANIZATION_NAME"]
    rows = pre.where(A.is_valid(F.col("ADDRESS"), False, rules))
    street = A.ordinals(A.without_garbage(F.col("ADDRESS"), rules), sorted(set(rules.suffixes.values())))
    rows = rows.select(street.alias("OPS_STREET"), title_case(F.col("CITY")).alias("OPS_CITY"), F.col("STATE").alias("OPS_STATE"), F.col("ZIP5").alias("OPS_ZIP5"), *org, F.col(id_col).alias("_id"))
    place = ["OPS_STREET", "OPS_CITY", "OPS_STATE", "OPS_ZIP5"]
    out = _with_geo(_canonical(rows, [*place, *org], "_id", {}), geocodes)
    return out.withColumns({"OPS_LOC_NAME": F.trim(joined(F.col("ORGANIZATION_ID").cast("string"), F.lit("@"), *place)), "ID": content_id("ORGANIZATION_NAME", *place)})


def associations(locations: DataFrame, score: float = 1.0) -> DataFrame:
    """(OPS_LOCATION_ID, DIM_LOCATION_ID, OPS_MATCH_SCORE) of every record and the location that stands for it."""
    return locations.select(F.col("ID").alias("OPS_LOCATION_ID"), F.explode("DIM_LOCATION_ID").alias("DIM_LOCATION_ID"), F.lit(score).alias("OPS_MATCH_SCORE"))


def override_place(df: DataFrame, key: Sequence[str], columns: Sequence[str], trusted: float = 0.99) -> DataFrame:
    """The columns of every row of a key taken from its best geocode where the rows disagree: of several beyond the trusted
    accuracy the one seen most often, else the most accurate; keys with a route in their street are left alone. Off by default."""
    w = Window.partitionBy(*key)
    values = F.struct(*columns)
    differ = F.size(F.collect_set(values).over(w)) > 1
    route = F.max(F.col("OPS_STREET").contains("Route")).over(w)
    several = F.size(F.collect_set(F.when(F.col("GEOCODE_ACCURACY") > trusted, values)).over(w)) > 1
    order = F.when(several & (F.col("GEOCODE_ACCURACY") > trusted), F.struct(F.lit(1), F.col("RAW_STREET_COUNT").cast("double"), values)).otherwise(F.struct(F.lit(0), F.coalesce("GEOCODE_ACCURACY", F.lit(-1.0)), values))
    best = F.max(order).over(w)["col3"]
    return df.withColumn("_best", F.when(differ & ~route, best).otherwise(values)).withColumns({c: F.col(f"_best.{c}") for c in columns}).drop("_best")


#: Levels of a geocode whose street can be trusted.
STREET_LEVELS = ("rooftop", "range_interpolation", "nearest_rooftop_match")


def override_street(df: DataFrame, geocoded: str = "GEOCODED_STREET", least: int = 80) -> DataFrame:
    """OPS_STREET of all rows at one coordinate replaced by the one that is most like the geocoder's street, where rows differ,
    the geocode is of a level to trust and the likeness is high enough; ties go to the smallest text. Off by default."""
    key = ["LATITUDE", "LONGITUDE"]
    fit = F.when(F.col("GEOCODE_LEVEL").isin(*STREET_LEVELS), ratio(F.upper("OPS_STREET"), F.upper(geocoded)))
    rated = df.withColumn("_fit", fit)
    best = rated.dropna(subset=key).groupBy(*key).agg(F.count_distinct("OPS_STREET").alias("_n"), F.min(F.when(F.col("_fit") >= least, F.struct((-F.col("_fit")).alias("f"), F.col("OPS_STREET").alias("s")))).alias("_b"))
    out = rated.join(best, key, "left")
    return out.withColumn("OPS_STREET", F.when(F.col("_n") > 1, F.coalesce("_b.s", "OPS_STREET")).otherwise(F.col("OPS_STREET"))).drop("_fit", "_n", "_b")


def presented(df: DataFrame) -> DataFrame:
    """Precurated rows in the order they are looked through: frequent addresses first, then by place and sub-location."""
    return df.orderBy(*[F.desc(c) for c in ("ADDRESS_cnt", "ADDRESS", "ADDRESS_CITY_ZIP5_cnt", "CITY", "SUBLOCATION_LVL1_cnt", "SUBLOCATION_LVL1")])


def sanitised(df: DataFrame) -> DataFrame:
    """Coordinates as numbers, null where they are none, and the organisation's id as a text."""
    kinds = {"LATITUDE": "double", "LONGITUDE": "double", "ORGANIZATION_ID": "string"}
    return df.withColumns({c: F.col(c).try_cast(k) for c, k in kinds.items() if c in df.columns})


def with_county(df: DataFrame, counties: DataFrame, code: str = "ZIP5") -> DataFrame:
    """The rows with COUNTY of their zip by a reference (ZIP5, COUNTY), null where it has none; the smallest of several."""
    return df.join(counties.groupBy(F.col("ZIP5").alias(code)).agg(F.min("COUNTY").alias("COUNTY")), code, "left")
