"""Queries of whole workflows: the four ways to cut the tables with both sides and their sizes, association of every kind of
raw record, geocoded rows, and the checks before them, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnfield.functions import text
from cairnfield.functions.keys import key_form
from cairnfield.operators import accounts, curate, geo, match, scopes
from cairnfield.plans.curation import _OPS_ROWS, _canonical, _scores_sql, _text_sql
from cairnfield.sources import staging
from cairnfield.sources.tables import read

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query with its SQL."""

    def add(f):
        QUERIES[name or f.__name__] = f
        if sql:
            SQL[name or f.__name__] = sql
        return f

    return add


# --- the four ways to cut the tables: raw and canonical rows, whole or still open, and their sizes


def _soldto(spark: SparkSession, folder: str) -> DataFrame:
    """Sold-to rows with the organisation of the location that they refer to."""
    of = read(spark, folder, "soldto_location").groupBy(key_form(F.col("ID")).alias("_k")).agg(F.min("ORGANIZATION_ID").alias("ORGANIZATION_ID"))
    return read(spark, folder, "dim_location_soldto").withColumn("_k", key_form(F.col("OPS_LOCATION_ID"))).join(of, "_k", "left").drop("_k")


def _with_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical rows once for each account of their organisation; those of organisations without accounts fall out."""
    of = read(spark, folder, "organization_soldto_account").where("ORGANIZATION_ID is not null and ACCOUNT is not null").select("ORGANIZATION_ID", "ACCOUNT").distinct()
    return read(spark, folder, "ops_location").join(of, "ORGANIZATION_ID")


_SOLDTO = """(SELECT s.*, l.ORGANIZATION_ID FROM dim_location_soldto s LEFT JOIN (SELECT replace(ID, '-', '') AS k, min(ORGANIZATION_ID) AS ORGANIZATION_ID FROM soldto_location GROUP BY 1) l
  ON l.k = replace(lower(regexp_replace(nullif(trim(s.OPS_LOCATION_ID), ''), '[{}\\s]', '', 'g')), '-', ''))"""
_ACCOUNTS = "(SELECT o.*, a.ACCOUNT FROM ops_location o LEFT JOIN (SELECT DISTINCT ORGANIZATION_ID, ACCOUNT FROM organization_soldto_account) a ON o.ORGANIZATION_ID = a.ORGANIZATION_ID WHERE a.ACCOUNT IS NOT NULL)"
#: For each way: raw rows, canonical rows, both in SQL, the keys in SQL on either side, and what is open in SQL.
SIDES = {
    "sales_order": (lambda s, f: read(s, f, "dim_location_sales_order"), lambda s, f: read(s, f, "ops_location"), "dim_location_sales_order", "ops_location", ("ORGANIZATION_ID", "STATE"), ("ORGANIZATION_ID", "OPS_STATE"), "OPS_LOCATION_ID IS NULL", "true"),
    "soldto": (_soldto, lambda s, f: read(s, f, "soldto_location"), _SOLDTO, "soldto_location", ("ORGANIZATION_ID", "left(trim(ZIP5), 3)"), ("ORGANIZATION_ID", "left(trim(OPS_ZIP5), 3)"), "OPS_LOCATION_ID IS NULL", "true"),
    "dnb": (lambda s, f: read(s, f, "dim_location_dnb"), lambda s, f: read(s, f, "ops_location"), "dim_location_dnb", "ops_location", ("PHYS_ST_ABRV", "left(trim(PHYS_ZIP5), 3)"), ("OPS_STATE", "left(trim(OPS_ZIP5), 3)"), "true", "DNB_DIM_LOCATION_ID IS NULL"),
    "keepstock": (lambda s, f: read(s, f, "dim_location_keepstock"), _with_accounts, "dim_location_keepstock", _ACCOUNTS, ("ACCOUNT",), ("ACCOUNT",), "OPS_LOCATION_ID IS NULL", "true"),
}


def _register_scopes(way: str) -> None:
    dim, ops, dim_sql, ops_sql, dim_keys, ops_keys, open_dim, open_ops = SIDES[way]
    spec = scopes.SPECS[way]
    for side, rows, table, keys, still in (("dim", dim, dim_sql, dim_keys, open_dim), ("ops", ops, ops_sql, ops_keys, open_ops)):
        of = ", ".join(f"{e} AS {k}" for e, k in zip(keys, spec.keys, strict=True))
        names = ", ".join(spec.keys)

        def scope_rows(spark: SparkSession, folder: str, side: str = side, rows=rows) -> DataFrame:
            get = spec.get_dim if side == "dim" else spec.get_ops
            return get(rows(spark, folder), None, True).select(F.col("ID").cast("string").alias("ID"), *spec.keys).distinct()

        def scope_sizes(spark: SparkSession, folder: str, side: str = side, rows=rows) -> DataFrame:
            size = spec.dim_sizes if side == "dim" else spec.ops_sizes
            whole, left = size(rows(spark, folder)), size(rows(spark, folder), True).withColumnRenamed("size", "open")
            return whole.join(left, list(spec.keys), "left").withColumn("open", F.coalesce("open", F.lit(0)))

        sizes = f"SELECT {of}, count(DISTINCT ID) AS size, count(DISTINCT CASE WHEN {still} THEN ID END) AS open FROM {table} WHERE {' AND '.join(f'{k} IS NOT NULL' for k in keys)} GROUP BY {', '.join(keys)}"
        query(f"SELECT DISTINCT CAST(ID AS VARCHAR) AS ID, {of} FROM {table} WHERE {still}", f"scope_{way}_{side}_open")(scope_rows)
        query(f"SELECT {names}, size, open FROM ({sizes})", f"scope_{way}_{side}_counts")(scope_sizes)


for _way in SIDES:
    _register_scopes(_way)


@query("""WITH s AS (SELECT ORGANIZATION_ID, STATE, count(DISTINCT ID) AS size FROM dim_location_sales_order WHERE ORGANIZATION_ID IS NOT NULL AND STATE IS NOT NULL GROUP BY 1, 2),
g AS (SELECT *, CASE WHEN size > 10000 THEN 'large' WHEN size > 1000 THEN 'medium' ELSE 'small' END AS "group" FROM s),
p AS (SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY size DESC, ORGANIZATION_ID, STATE) AS place FROM g)
SELECT ORGANIZATION_ID, STATE, size, "group", CAST(floor((place - 1) / CASE "group" WHEN 'small' THEN 16000 WHEN 'medium' THEN 100 ELSE 5 END) AS INTEGER) AS chunk FROM p WHERE place <= 500""")
def scope_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """The largest five hundred scopes of each group and the chunk that each is worked on in."""
    found = scopes.SPECS["sales_order"].dim_sizes(read(spark, folder, "dim_location_sales_order"))
    return scopes.in_groups(found, scopes.GROUPS["sales_order"], ["ORGANIZATION_ID", "STATE"], 500)


# --- association

_ROUNDED = "round(score, 6) AS score"
_KEEP_ROWS = f"SELECT DISTINCT ID, ACCOUNT, {_text_sql('ADDRESS1', 'CITY', 'PROVINCE', 'ZIP5')} AS text FROM dim_location_keepstock WHERE ACCOUNT IS NOT NULL"
_ACCOUNT_ROWS = f"SELECT DISTINCT ID, ACCOUNT, {_text_sql('OPS_STREET', 'OPS_CITY', 'OPS_STATE', 'OPS_ZIP5')} AS text FROM {_ACCOUNTS} WHERE IS_ADDRESS AND DELETED_AT IS NULL"


@query(f"WITH {_scores_sql(_KEEP_ROWS, _ACCOUNT_ROWS, ('ACCOUNT',))} SELECT l AS dim_id, r AS ops_id, {_ROUNDED} FROM scored WHERE score >= 0.1 QUALIFY row_number() OVER (PARTITION BY l ORDER BY score DESC, r) = 1")
def match_keepstock(spark: SparkSession, folder: str) -> DataFrame:
    """The most alike canonical address of its account for every stock record."""
    dim = read(spark, folder, "dim_location_keepstock").where("ACCOUNT is not null").select("ID", "ACCOUNT", text.location_string("keepstock").alias("text")).distinct()
    ops = read(spark, folder, "ops_location").where("IS_ADDRESS and DELETED_AT is null").select("ID", "ORGANIZATION_ID", text.location_string("ops_no_sublocation").alias("text")).distinct()
    of = read(spark, folder, "organization_soldto_account").where("ORGANIZATION_ID is not null and ACCOUNT is not null").select("ORGANIZATION_ID", "ACCOUNT").distinct()
    found = match.rank_by_account(dim, ops, of, F.col("text"), F.col("text"), threshold=match.THRESHOLD)
    return found.select(F.col("left_id").alias("dim_id"), F.col("right_id").alias("ops_id"), F.round("score", 6).alias("score"))


_SOLDTO_TEXTS = f"SELECT DISTINCT ID, ORGANIZATION_ID, {_text_sql('STREET', 'CITY', 'REGION', 'ZIP5')} AS text FROM {_SOLDTO}"
_LOCATION_TEXTS = f"SELECT DISTINCT ID, ORGANIZATION_ID, {_text_sql('OPS_STREET', 'OPS_CITY', 'OPS_STATE', 'OPS_ZIP5')} AS text FROM soldto_location WHERE DELETED_AT IS NULL"


@query(f"""WITH {_scores_sql(_SOLDTO_TEXTS, _LOCATION_TEXTS, ('ORGANIZATION_ID',))}, best AS (SELECT * FROM scored WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY l ORDER BY score DESC, r) = 1)
SELECT d.ID AS dim_id, r AS ops_id, round(coalesce(score, 0), 6) AS score FROM (SELECT DISTINCT ID FROM dim_location_soldto) d LEFT JOIN best ON l = d.ID""")
def match_soldto(spark: SparkSession, folder: str) -> DataFrame:
    """Every sold-to record with the most alike location of its organisation, score 0 without one."""
    dim = _soldto(spark, folder).select("ID", "ORGANIZATION_ID", text.joined("STREET", "CITY", "REGION", "ZIP5").alias("text")).distinct()
    ops = read(spark, folder, "soldto_location").where("DELETED_AT is null").select("ID", "ORGANIZATION_ID", text.location_string("ops_no_sublocation").alias("text")).distinct()
    return match.scored_left(dim, ops, F.col("text"), F.col("text"), ["ORGANIZATION_ID"]).select("dim_id", "ops_id", F.round("score", 6).alias("score"))


_KEYED = f"SELECT DISTINCT ID, PHYS_ST_ABRV AS STATE, left(trim(PHYS_ZIP5), 3) AS ZIP3, {_text_sql('PHYS_STRT_AD', 'PHYS_CTY', 'PHYS_ST_ABRV', 'PHYS_ZIP5')} AS text FROM dim_location_dnb WHERE DELETED_AT IS NULL"
_BLOCK = ("STATE", "ZIP3")


@query(f"""WITH sure AS (SELECT l AS id, r AS label FROM (WITH {_scores_sql(_KEYED, _OPS_ROWS, _BLOCK)} SELECT * FROM scored WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY l ORDER BY score DESC, r) = 1) WHERE score >= 0.1),
alike AS (SELECT * FROM (WITH {_scores_sql(_KEYED, _KEYED, _BLOCK)} SELECT l, r, score FROM scored)),
near AS (SELECT l, label, score FROM alike JOIN sure ON r = sure.id WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY l ORDER BY score DESC, r) <= 5),
votes AS (SELECT l, label, round(sum(score), 9) AS votes FROM near GROUP BY 1, 2)
SELECT l AS dim_id, label AS ops_id, round(votes, 6) AS votes FROM votes QUALIFY row_number() OVER (PARTITION BY l ORDER BY votes DESC, label) = 1""")
def match_votes(spark: SparkSession, folder: str) -> DataFrame:
    """A canonical address for every third-party record by the votes of the records most like it that have a sure one."""
    dim = read(spark, folder, "dim_location_dnb").where("DELETED_AT is null").select("ID", F.col("PHYS_ST_ABRV").alias("STATE"), F.left(F.trim("PHYS_ZIP5"), F.lit(3)).alias("ZIP3"), text.location_string("dnb").alias("text")).distinct()
    return match.voted(dim, _canonical(spark, folder), F.col("text"), F.col("text"), list(_BLOCK)).select("dim_id", "ops_id", F.round("votes", 6).alias("votes"))


# --- geocodes, checks and selections


@query("""WITH c AS (SELECT lower(coalesce(OPS_STREET, '')) AS st, coalesce(OPS_CITY, '') AS ci, coalesce(OPS_STATE, '') AS sta, coalesce(OPS_ZIP5, '') AS zi, GEOCODE_ACCURACY AS a, LATITUDE AS la, LONGITUDE AS lo FROM soldto_location
  WHERE DELETED_AT IS NULL AND LATITUDE IS NOT NULL AND NOT isnan(LATITUDE) AND LONGITUDE IS NOT NULL AND NOT isnan(LONGITUDE) AND GEOCODE_ACCURACY BETWEEN 0 AND 1 AND NOT isnan(GEOCODE_ACCURACY)),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY st, ci, sta, zi ORDER BY a DESC, la, lo) = 1)
SELECT DISTINCT d.ID, b.la AS lat, b.lo AS lon, b.a AS accuracy FROM dim_location_soldto d LEFT JOIN b ON b.st = lower(coalesce(d.STREET, '')) AND b.ci = coalesce(d.CITY, '') AND b.sta = coalesce(d.REGION, '') AND b.zi = coalesce(d.ZIP5, '')""")
def geocoded_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Sold-to records with the most accurate geocode known of their address."""
    keys = ["ops_street", "ops_city", "ops_state", "ops_zip5"]
    known = read(spark, folder, "soldto_location").where("DELETED_AT is null and not isnan(LATITUDE) and not isnan(LONGITUDE) and GEOCODE_ACCURACY between 0 and 1 and not isnan(GEOCODE_ACCURACY)")
    cache = known.select(F.lower("OPS_STREET").alias("ops_street"), F.col("OPS_CITY").alias("ops_city"), F.col("OPS_STATE").alias("ops_state"), F.col("OPS_ZIP5").alias("ops_zip5"), F.col("GEOCODE_ACCURACY").alias("accuracy"), F.col("LATITUDE").alias("lat"), F.col("LONGITUDE").alias("lon"), F.col("GEOCODE_LEVEL").alias("type"), F.lit("").alias("formatted_address"))
    return geo.geocode_rows(read(spark, folder, "dim_location_soldto"), ["STREET", "CITY", "REGION", "ZIP5"], cache, None, keys).select("ID", "lat", "lon", "accuracy").distinct()


@query(r"""SELECT DISTINCT ID, nullif(regexp_extract(OPS_STREET, '^\s*([0-9]+[A-Za-z]?(?:\s+[0-9]/[0-9])?)(?:\s|,|$)', 1), '') AS number,
  nullif(trim(regexp_replace(regexp_replace(OPS_STREET, '^\s*([0-9]+[A-Za-z]?(?:\s+[0-9]/[0-9])?)(?:[\s,]+|$)', ''), '(?i)(,|#|\b(?:suite|ste|unit|apt|apartment|room|rm|floor|dock|door|gate|building|bldg)\b).*$', '')), '') AS street FROM soldto_location""")
def number_street(spark: SparkSession, folder: str) -> DataFrame:
    """House number and street of every sold-to location."""
    return read(spark, folder, "soldto_location").select("ID", text.number_street(F.col("OPS_STREET")).alias("a")).select("ID", "a.number", "a.street").distinct()


@query("SELECT ID, concat_ws(', ', nullif(trim(OPS_STREET), ''), nullif(trim(OPS_CITY), ''), nullif(trim(OPS_STATE), ''), nullif(trim(OPS_ZIP5), '')) AS line FROM soldto_location")
def address_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Each location's address as one line, as a geocoder takes it."""
    return read(spark, folder, "soldto_location").select("ID", text.address_line("OPS_STREET", "OPS_CITY", "OPS_STATE", "OPS_ZIP5").alias("line"))


@query("""WITH a AS (SELECT SOLD_ACCOUNT, count(*) AS n FROM dim_location_sales_order WHERE TRACK_CODE = 'A1' AND SOLD_ACCOUNT IS NOT NULL GROUP BY 1), m AS (SELECT min(n) AS lo, max(n) AS hi FROM a)
SELECT SOLD_ACCOUNT, n, CAST(CASE WHEN hi > lo THEN least(4, floor((n - lo) / (hi - lo) * 5)) ELSE 0 END AS INTEGER) AS bin FROM a, m""")
def track_code_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """The accounts of one track code in five bins of their rows."""
    return accounts.by_track_code(read(spark, folder, "dim_location_sales_order"), "A1", 5)


@query("SELECT source, domain, n FROM (SELECT source, split_part(lower(repo), '/', 1) AS domain, count(*) AS n FROM documents WHERE repo IS NOT NULL AND split_part(lower(repo), '/', 1) <> '' GROUP BY 1, 2) QUALIFY rank() OVER (PARTITION BY source ORDER BY n DESC) = 1")
def domain_modes(spark: SparkSession, folder: str) -> DataFrame:
    """All the most frequent repository owners of each source, ties kept."""
    rows = accounts.domain_frequency(read(spark, folder, "documents"), "source", F.split_part(F.lower("repo"), F.lit("/"), F.lit(1)))
    return accounts.domain_modes(rows.where("source is not null"), "source").unionByName(accounts.domain_modes(rows.where("source is null").withColumn("source", F.lit("")), "source").withColumn("source", F.lit(None).cast("string")))


@query("SELECT ID, OPS_STREET, CAST(ORGANIZATION_ID AS VARCHAR) AS ORGANIZATION_ID, LATITUDE, CAST(NULL AS VARCHAR) AS OPS_MARKER FROM soldto_location")
def staged_upload(spark: SparkSession, folder: str) -> DataFrame:
    """Sold-to locations in the declared columns of an upload: extra ones ignored, missing ones null."""
    return staging.conformed(read(spark, folder, "soldto_location"), staging.LOCATION).select("ID", "OPS_STREET", "ORGANIZATION_ID", "LATITUDE", "OPS_MARKER")


@query("SELECT DISTINCT ID, TRY_CAST(ZIP5 AS DOUBLE) AS LATITUDE, CAST(ORGANIZATION_ID AS VARCHAR) AS ORGANIZATION_ID FROM dim_location_sales_order")
def sanitised_types(spark: SparkSession, folder: str) -> DataFrame:
    """A text column read as coordinates: numbers where it holds them, else null."""
    rows = read(spark, folder, "dim_location_sales_order").select("ID", F.col("ZIP5").alias("LATITUDE"), "ORGANIZATION_ID")
    return curate.sanitised(rows).distinct()
