"""Queries by the relational operators: accounts, scopes, changes of tables, bridges and metrics, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnfield.functions.keys import key_form
from cairnfield.functions.text import content_id, edge_bin, equal_width_bin, joined, location_string
from cairnfield.operators import accounts, bridge, dml, metrics, scopes
from cairnfield.operators.curate import counts
from cairnfield.sources.tables import read

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _not_in(df: DataFrame, column: str, banned: DataFrame) -> DataFrame:
    """NOT IN with its null rules: the keys of `banned` have no null, a null of the column is left out."""
    return df.where(F.col(column).isNotNull()).join(banned, column, "left_anti")


@query("""SELECT c_custkey AS account, trim(c_name) AS account_name, n_name AS nation, count(DISTINCT o_orderkey) AS n_orders,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
  floor(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) * 100 / count(DISTINCT o_orderkey) + 0.5) / 100 AS avg_revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) AND year(o_orderdate) = 1997 AND o_orderpriority LIKE '1%'
  AND l_returnflag IN ('N', 'R') AND l_extendedprice >= 0
GROUP BY 1, 2, 3 HAVING revenue >= 0 ORDER BY revenue DESC""")
def accounts_by_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Orders, revenue and their average of each valid account in a year, the highest first."""
    lines = read(spark, folder, "lineitem").where("l_returnflag in ('N', 'R') and l_extendedprice >= 0").select("l_orderkey", "l_extendedprice")
    orders = read(spark, folder, "orders").where((F.year("o_orderdate") == 1997) & F.startswith("o_orderpriority", F.lit("1"))).select("o_orderkey", "o_custkey")
    customer = read(spark, folder, "customer")
    orders = _not_in(orders, "o_custkey", customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey")))
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customer, F.col("o_custkey") == F.col("c_custkey")).join(read(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select(F.col("c_custkey").alias("account"), F.trim("c_name").alias("account_name"), F.col("n_name").alias("nation"), "o_orderkey", "l_extendedprice")
    return accounts.revenue(rows, ["account", "account_name", "nation"], "o_orderkey", "l_extendedprice", 0.0).orderBy(F.desc("revenue"))


_SALES = "nullif(trim(ORGANIZATION_ID), '')"


def _sales(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "dim_location_sales_order")


_DIM_SIZES = "SELECT ORGANIZATION_ID, STATE, count(DISTINCT ID) AS size FROM dim_location_sales_order WHERE ORGANIZATION_ID IS NOT NULL AND STATE IS NOT NULL GROUP BY 1, 2"
_OPS_SIZES = "SELECT ORGANIZATION_ID, OPS_STATE AS STATE, count(*) AS size FROM ops_location WHERE ORGANIZATION_ID IS NOT NULL AND OPS_STATE IS NOT NULL AND IS_SITE = FALSE GROUP BY 1, 2"
_KEYS = ["ORGANIZATION_ID", "STATE"]


def _dim_sizes(spark: SparkSession, folder: str, low: int | None = None, high: int | None = None) -> DataFrame:
    return scopes.sizes(scopes.SPECS["sales_order"].dim_rows(_sales(spark, folder)), _KEYS, "ID", low, high)


def _ops_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return scopes.sizes(scopes.SPECS["sales_order"].ops_rows(read(spark, folder, "ops_location").where(F.col("IS_SITE") == F.lit(False))), _KEYS)


@query(_DIM_SIZES)
def scope_dim_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct raw records of each scope."""
    return _dim_sizes(spark, folder)


@query(_DIM_SIZES + " HAVING size BETWEEN 2 AND 20")
def scope_dim_sizes_between(spark: SparkSession, folder: str) -> DataFrame:
    """The scopes of a medium size."""
    return _dim_sizes(spark, folder, 2, 20)


@query(_OPS_SIZES)
def scope_ops_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical records of each scope that are no site."""
    return _ops_sizes(spark, folder)


@query(f"SELECT ORGANIZATION_ID, STATE, coalesce(d.size * o.size, 0) AS size FROM ({_DIM_SIZES}) d FULL JOIN ({_OPS_SIZES}) o USING (ORGANIZATION_ID, STATE)")
def scope_match_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Candidate pairs of each scope, 0 where one side lacks it."""
    return scopes.match_sizes(_dim_sizes(spark, folder), _ops_sizes(spark, folder), _KEYS)


@query(f"WITH d AS ({_DIM_SIZES}), o AS ({_OPS_SIZES}) SELECT d.ORGANIZATION_ID, d.STATE, d.size AS dim_size, o.size AS ops_size, d.size * o.size AS size FROM d LEFT JOIN o ON d.ORGANIZATION_ID = o.ORGANIZATION_ID AND d.STATE = o.STATE")
def scope_size_product(spark: SparkSession, folder: str) -> DataFrame:
    """Both sizes and their product of each scope of the raw side, null where the other side lacks it."""
    d, o = _dim_sizes(spark, folder).withColumnRenamed("size", "dim_size"), _ops_sizes(spark, folder).withColumnRenamed("size", "ops_size")
    return d.join(o, _KEYS, "left").withColumn("size", F.col("dim_size") * F.col("ops_size"))


_CHOSEN = "SELECT ORGANIZATION_ID, STATE FROM dim_location_sales_order GROUP BY 1, 2 HAVING count(*) >= 5"


@query(f"SELECT DISTINCT s.ID, s.ORGANIZATION_ID, s.STATE FROM dim_location_sales_order s JOIN ({_CHOSEN}) c ON s.ORGANIZATION_ID = c.ORGANIZATION_ID AND s.STATE = c.STATE")
def scope_composite_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The raw records of the scopes with five rows or more."""
    rows = _sales(spark, folder)
    chosen = scopes.sizes(rows, _KEYS).where("size >= 5")
    return scopes.in_scopes(rows, chosen, _KEYS).select("ID", *_KEYS).distinct()


@query(f"SELECT ORGANIZATION_ID, STATE, size, CASE WHEN size > 20 THEN 'large' WHEN size > 5 THEN 'medium' ELSE 'small' END AS \"group\" FROM ({_DIM_SIZES}) WHERE size > 1")
def scope_groups(spark: SparkSession, folder: str) -> DataFrame:
    """The scopes by group of size; those of one record fall out."""
    return scopes.grouped(_dim_sizes(spark, folder), (1, 5, 20), ("small", "medium", "large"))


@query(f"SELECT ORGANIZATION_ID, STATE, size, CAST(ntile(7) OVER (ORDER BY ORGANIZATION_ID, STATE) - 1 AS INTEGER) AS bucket FROM ({_DIM_SIZES})")
def scope_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """The scopes in seven contiguous buckets."""
    return scopes.bucketed(_dim_sizes(spark, folder), _KEYS, 7)


@query("""SELECT DISTINCT s.ID, s.STREET, s.CITY, left(trim(s.ZIP5), 3) AS zip3, o.ORGANIZATION_NAME FROM dim_location_sales_order s
LEFT JOIN organization o ON s.ORGANIZATION_ID = o.ID WHERE year(s.LOADED_AT) >= 2025 AND s.STREET <> ''""")
def dim_scan_active(spark: SparkSession, folder: str) -> DataFrame:
    """Recent raw records with their organisation's name."""
    rows = _sales(spark, folder).where((F.year("LOADED_AT") >= 2025) & (F.col("STREET") != ""))
    org = read(spark, folder, "organization").select(F.col("ID").alias("ORGANIZATION_ID"), "ORGANIZATION_NAME")
    return rows.join(org, "ORGANIZATION_ID", "left").select("ID", "STREET", "CITY", F.left(F.trim("ZIP5"), F.lit(3)).alias("zip3"), "ORGANIZATION_NAME").distinct()


@query("SELECT ID, SOLD_ACCOUNT, ORGANIZATION_ID FROM dim_location_sales_order WHERE OPS_LOCATION_ID IS NULL")
def incremental_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The raw records without an association yet."""
    return _sales(spark, folder).where("OPS_LOCATION_ID is null").select("ID", "SOLD_ACCOUNT", "ORGANIZATION_ID")


_COLS = ["OPS_STREET", "OPS_CITY", "OPS_STATE", "OPS_ZIP5", "ORGANIZATION_ID"]


@query(f"SELECT {', '.join(_COLS)} FROM soldto_location EXCEPT SELECT {', '.join(_COLS)} FROM soldto_location WHERE DELETED_AT IS NOT NULL")
def dedupe_insert_minus(spark: SparkSession, folder: str) -> DataFrame:
    """The rows to append to the table of deleted ones, each once."""
    rows = read(spark, folder, "soldto_location")
    return dml.insert_new(rows.where("DELETED_AT is not null"), rows, _COLS)


@query("SELECT ID, ACCOUNT, CASE WHEN ACCOUNT IN (SELECT ACCOUNT FROM organization_soldto_account WHERE ORGANIZATION_ID IS NULL) THEN NULL ELSE OPS_LOCATION_ID END AS OPS_LOCATION_ID FROM dim_location_keepstock")
def dml_reset_column(spark: SparkSession, folder: str) -> DataFrame:
    """Stock rows whose account has no organisation lose their association."""
    open_accounts = read(spark, folder, "organization_soldto_account").where("ORGANIZATION_ID is null").select("ACCOUNT")
    return dml.reset_in(read(spark, folder, "dim_location_keepstock"), "OPS_LOCATION_ID", "ACCOUNT", open_accounts).select("ID", "ACCOUNT", "OPS_LOCATION_ID")


@query("SELECT ID, IS_SITE FROM ops_location WHERE NOT coalesce(IS_SITE = TRUE OR ORGANIZATION_ID = 'ORG00001', false)")
def dml_delete_sites(spark: SparkSession, folder: str) -> DataFrame:
    """The locations without sites and without one organisation's."""
    return dml.delete(read(spark, folder, "ops_location"), F.col("IS_SITE") | (F.col("ORGANIZATION_ID") == "ORG00001")).select("ID", "IS_SITE")


@query("""WITH p AS (SELECT ORGANIZATION_ID || ' in ' || OPS_STATE AS name, list(DISTINCT ID) AS children FROM ops_location WHERE ORGANIZATION_ID IS NOT NULL AND OPS_STATE IS NOT NULL GROUP BY ORGANIZATION_ID, OPS_STATE HAVING count(DISTINCT ID) > 3),
c AS (SELECT id, min(name) AS name FROM (SELECT unnest(children) AS id, name FROM p) GROUP BY id)
SELECT o.ID, coalesce(c.name, o.MAIN_LOC_NAME) AS MAIN_LOC_NAME FROM ops_location o LEFT JOIN c ON o.ID = c.id""")
def merge_parent_names(spark: SparkSession, folder: str) -> DataFrame:
    """Locations take the name of the group that lists them."""
    ops = read(spark, folder, "ops_location")
    keys = ops.where("ORGANIZATION_ID is not null and OPS_STATE is not null").groupBy("ORGANIZATION_ID", "OPS_STATE")
    parents = keys.agg(F.collect_set("ID").alias("children")).where("size(children) > 3").select(F.concat("ORGANIZATION_ID", F.lit(" in "), "OPS_STATE").alias("name"), "children")
    return dml.merge_children(ops, parents, "ID", "children", "name", "MAIN_LOC_NAME").select("ID", "MAIN_LOC_NAME")


_BRIDGE = """WITH r AS (SELECT DISTINCT ID AS id, OPS_LOC_NAME AS name, CASE WHEN trim(MAIN_LOC_NAME) <> '' THEN MAIN_LOC_NAME END AS main FROM ops_location),
h AS (SELECT main, arg_min(id, (CASE WHEN coalesce(name = main, false) THEN '0' ELSE '1' END) || id) AS head FROM r WHERE main IS NOT NULL GROUP BY main),
m AS (SELECT DISTINCT r.id, h.head FROM r JOIN h USING (main)) """
_LINK = "SELECT head AS location_id_p, id AS location_id_c, 1 AS levels_removed, true AS parent_is_top, false AS parent_is_bottom, false AS child_is_top, true AS child_is_bottom FROM m WHERE id <> head"
_ALONE = "SELECT DISTINCT id AS location_id_p, id AS location_id_c, 0 AS levels_removed, true AS parent_is_top, true AS parent_is_bottom, true AS child_is_top, true AS child_is_bottom FROM r WHERE main IS NULL"


@query(f"{_BRIDGE} SELECT id AS location_id_p, id AS location_id_c, 0 AS levels_removed, id = head AS parent_is_top, id <> head AS parent_is_bottom, id = head AS child_is_top, id <> head AS child_is_bottom FROM m UNION ALL {_LINK} UNION ALL {_ALONE}")
def bridge_location(spark: SparkSession, folder: str) -> DataFrame:
    """The bridge of locations and the sites they name."""
    return bridge.bridge(read(spark, folder, "ops_location"), "ID", "OPS_LOC_NAME", "MAIN_LOC_NAME")


@query(f"{_BRIDGE} {_ALONE}")
def bridge_standalone(spark: SparkSession, folder: str) -> DataFrame:
    """The bridge rows of locations without a site."""
    return bridge.bridge(read(spark, folder, "ops_location").where("MAIN_LOC_NAME is null or trim(MAIN_LOC_NAME) = ''"), "ID", "OPS_LOC_NAME", "MAIN_LOC_NAME")


#: The tables that a run is measured by, their category and key.
MEASURED = {
    "dim_location_sales_order": ("location", "ID"), "ops_location": ("location", "ID"), "soldto_location": ("location", "ID"), "dim_location_soldto": ("location", "ID"), "dim_location_keepstock": ("location", "ID"), "dim_location_dnb": ("location", "ID"),
    "zip_reference": ("location", "ZIP5"), "organization": ("organization", "ID"), "organization_soldto_account": ("organization", "ID"), "region": ("sales", "r_regionkey"), "nation": ("sales", "n_nationkey"), "customer": ("sales", "c_custkey"),
    "supplier": ("sales", "s_suppkey"), "part": ("sales", "p_partkey"), "orders": ("sales", "o_orderkey"), "lineitem": ("sales", "l_orderkey"), "events": ("events", "event_id"), "documents": ("corpus", "doc_id"), "notebook_cells": ("corpus", "doc_id"), "mix_targets": ("corpus", "mix_id"),
}
METRICS = (
    *[metrics.Metric(c, t, "count") for t, (c, _) in MEASURED.items()],
    *[metrics.Metric(c, t, "duplicates", k) for t, (c, k) in MEASURED.items()],
    metrics.Metric("organization", "dim_location_sales_order", "missing", "ORGANIZATION_ID", "organization", "ID"),
    metrics.Metric("organization", "organization_soldto_account", "missing", "ORGANIZATION_ID", "organization", "ID"),
    metrics.Metric("organization", "ops_location", "missing", "ORGANIZATION_ID", "organization", "ID"),
    metrics.Metric("sales", "orders", "missing", "o_custkey", "customer", "c_custkey"),
)


def _metric_sql(m: metrics.Metric) -> str:
    inner = {
        "count": f"SELECT count(*) AS n FROM {m.entity}",
        "duplicates": f"SELECT count(*) AS n FROM (SELECT {m.key} FROM {m.entity} GROUP BY 1 HAVING count(*) > 1)",
        "missing": f"SELECT count(*) AS n FROM {m.entity} a WHERE a.{m.key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {m.parent or m.entity} p WHERE p.{m.parent_key or 'ID'} = a.{m.key or 'ID'})",
    }[m.kind]
    return f"SELECT '{m.category}' AS category, '{m.entity}' AS entity, '{m.kind}' AS metric, n AS result, round(n / 1e6) AS in_millions, 'run' AS run_id FROM ({inner})"


@query(" UNION ALL ".join(map(_metric_sql, METRICS)))
def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, duplicates and missing parents of the location tables."""
    names = {n for m in METRICS for n in (m.entity, m.parent) if n}
    return metrics.run_metrics({n: read(spark, folder, n) for n in names}, METRICS, "run")


def _string_sql(fields: tuple[str, ...]) -> str:
    return f"concat_ws(' ', {', '.join(f'''nullif({c}, '')''' for c in fields)})"


def _strings(kind: str):
    from cairnfield.functions.text import STRING_FIELDS

    return _string_sql(STRING_FIELDS[kind])


@query(f"SELECT ID, {_strings('full')} AS text FROM dim_location_sales_order")
def loc_string_full(spark: SparkSession, folder: str) -> DataFrame:
    """All fields of a raw record as one text."""
    return _sales(spark, folder).select("ID", location_string("full").alias("text"))


@query(f"SELECT ID, {_strings('no_account')} AS no_account, {_strings('simple')} AS simple, {_strings('address')} AS address FROM dim_location_sales_order")
def loc_string_simple(spark: SparkSession, folder: str) -> DataFrame:
    """The shorter texts of a raw record."""
    return _sales(spark, folder).select("ID", *[location_string(k).alias(k) for k in ("no_account", "simple", "address")])


@query(f"SELECT ID, {_strings('ops')} AS ops, {_strings('ops_no_sublocation')} AS ops_no_sublocation FROM ops_location")
def loc_string_ops(spark: SparkSession, folder: str) -> DataFrame:
    """The texts of a canonical record."""
    return read(spark, folder, "ops_location").select("ID", *[location_string(k).alias(k) for k in ("ops", "ops_no_sublocation")])


@query(f"SELECT 'dnb' AS source, ID, {_strings('dnb')} AS text FROM dim_location_dnb UNION ALL SELECT 'keepstock', ID, {_strings('keepstock')} FROM dim_location_keepstock")
def loc_string_third_party(spark: SparkSession, folder: str) -> DataFrame:
    """The texts of third-party records."""
    parts = [read(spark, folder, f"dim_location_{k}").select(F.lit(k).alias("source"), "ID", location_string(k).alias("text")) for k in ("dnb", "keepstock")]
    return parts[0].unionByName(parts[1])


_ID = ("ORGANIZATION_NAME", "OPS_STREET", "OPS_CITY", "OPS_STATE", "OPS_ZIP5", "OPS_SUBLOCATION")


@query(f"SELECT ID, sha256({''' || ' ' || '''.join(f'''coalesce({c}, '')''' for c in _ID)}) AS hash_id FROM ops_location")
def location_hash_id(spark: SparkSession, folder: str) -> DataFrame:
    """An id made from a location's content."""
    return read(spark, folder, "ops_location").select("ID", content_id(*_ID).alias("hash_id"))


@query("SELECT PHYS_ST_ABRV AS state, left(trim(PHYS_ZIP5), 3) AS zip3, count(DISTINCT ID) AS size FROM dim_location_dnb WHERE PHYS_ST_ABRV IS NOT NULL AND PHYS_ZIP5 IS NOT NULL GROUP BY 1, 2")
def zip_prefix_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Third-party records by state and the beginning of the zip."""
    return scopes.sizes(scopes.SPECS["dnb"].dim_rows(read(spark, folder, "dim_location_dnb")), ["STATE", "ZIP3"], "ID").withColumnsRenamed({"STATE": "state", "ZIP3": "zip3"})


_OWNERS = "SELECT source, split_part(lower(repo), '/', 1) AS domain, count(*) AS n FROM documents WHERE repo IS NOT NULL AND split_part(lower(repo), '/', 1) NOT IN ('', 'campus-lab') GROUP BY 1, 2"


def _owners(spark: SparkSession, folder: str) -> DataFrame:
    return accounts.domain_frequency(read(spark, folder, "documents"), "source", F.split_part(F.lower("repo"), F.lit("/"), F.lit(1)), ["campus-lab"])


@query(_OWNERS)
def domain_frequency(spark: SparkSession, folder: str) -> DataFrame:
    """How often each repository owner occurs per source."""
    return _owners(spark, folder)


@query(f"SELECT source, domain, n FROM ({_OWNERS}) QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC, domain) = 1")
def domain_mode(spark: SparkSession, folder: str) -> DataFrame:
    """The most frequent repository owner of each source."""
    return accounts.domain_mode(_owners(spark, folder), "source")


@query("""SELECT ID, count(STREET) OVER (PARTITION BY STREET) AS street_cnt, count(STREET) OVER (PARTITION BY STREET, CITY, ZIP5) AS street_city_zip_cnt,
  count(STREET) OVER (PARTITION BY STREET, CITY, STATE, ZIP5) AS raw_cnt FROM dim_location_sales_order""")
def address_counts(spark: SparkSession, folder: str) -> DataFrame:
    """How often each raw street and place occurs, beside every record."""
    of = {"street_cnt": ("STREET",), "street_city_zip_cnt": ("STREET", "CITY", "ZIP5"), "raw_cnt": ("STREET", "CITY", "STATE", "ZIP5")}
    return counts(_sales(spark, folder).select("ID", "STREET", "CITY", "STATE", "ZIP5"), of).select("ID", *of)


@query("SELECT c_custkey, c_acctbal, CAST(CASE WHEN c_acctbal = m.hi THEN 4 ELSE least(4, floor((c_acctbal - m.lo) / (m.hi - m.lo) * 5)) END AS INTEGER) AS bin, CASE WHEN c_acctbal > 5000 THEN 'high' WHEN c_acctbal > 0 THEN 'low' END AS band FROM customer, (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer) m")
def value_bins(spark: SparkSession, folder: str) -> DataFrame:
    """Balances in bins of equal width and in bands by edges."""
    rows = read(spark, folder, "customer").select("c_custkey", "c_acctbal")
    ends = rows.agg(F.min("c_acctbal").alias("lo"), F.max("c_acctbal").alias("hi"))
    return rows.crossJoin(F.broadcast(ends)).select("c_custkey", "c_acctbal", equal_width_bin(F.col("c_acctbal"), F.col("lo"), F.col("hi"), 5).alias("bin"), edge_bin(F.col("c_acctbal"), (0, 5000), ("low", "high")).alias("band"))


@query("""SELECT ORGANIZATION_ID, OPS_STATE AS state, sum(n) AS n, min(name) AS name, array_to_string(list_sort(flatten(list(ids))), ',') AS ids FROM (
  SELECT ORGANIZATION_ID, OPS_STATE, OPS_CITY, count(*) AS n, min(OPS_LOC_NAME) AS name, list(DISTINCT ID) AS ids FROM ops_location GROUP BY 1, 2, 3) GROUP BY 1, 2""".replace("sum(n) AS n", "CAST(sum(n) AS BIGINT) AS n"))
def group_first_sum_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of groups with their sums, first name and all ids; null keys form groups."""
    inner = read(spark, folder, "ops_location").groupBy("ORGANIZATION_ID", "OPS_STATE", "OPS_CITY").agg(F.count("*").alias("n"), F.min("OPS_LOC_NAME").alias("name"), F.collect_set("ID").alias("ids"))
    outer = inner.groupBy("ORGANIZATION_ID", F.col("OPS_STATE").alias("state")).agg(F.sum("n").alias("n"), F.min("name").alias("name"), F.array_sort(F.flatten(F.collect_list("ids"))).alias("ids"))
    return outer.withColumn("ids", F.array_join("ids", ","))


@query("SELECT s.ID, coalesce(nullif(trim(s.STATE), ''), z.st) AS state FROM dim_location_sales_order s LEFT JOIN (SELECT ZIP5, min(STATE) AS st FROM zip_reference GROUP BY 1) z ON s.ZIP5 = z.ZIP5")
def state_fill(spark: SparkSession, folder: str) -> DataFrame:
    """Blank states filled from the zip."""
    from cairnfield.operators.curate import fill_state

    return fill_state(_sales(spark, folder), read(spark, folder, "zip_reference")).select("ID", F.col("STATE").alias("state"))


@query("""SELECT count(*) AS n_missing FROM dim_location_soldto a WHERE nullif(trim(a.OPS_LOCATION_ID), '') IS NOT NULL AND NOT EXISTS
(SELECT 1 FROM soldto_location p WHERE replace(p.ID, '-', '') = replace(lower(regexp_replace(a.OPS_LOCATION_ID, '[{}\\s]', '', 'g')), '-', ''))""")
def missing_associations(spark: SparkSession, folder: str) -> DataFrame:
    """How many sold-to records refer to no location."""
    rows = read(spark, folder, "dim_location_soldto").select(key_form(F.col("OPS_LOCATION_ID")).alias("k")).where("k is not null")
    return rows.join(read(spark, folder, "soldto_location").select(key_form(F.col("ID")).alias("k")).distinct(), "k", "left_anti").agg(F.count("*").alias("n_missing"))


@query("""SELECT ID, ACCOUNT_NAME, CASE WHEN contains(ACCOUNT_NAME, '/') THEN split_part(ACCOUNT_NAME, '/', 1) ELSE ACCOUNT_NAME END AS name_before,
  CASE WHEN contains(ACCOUNT_NAME, '/') THEN split_part(ACCOUNT_NAME, '/', 2) END AS name_after FROM organization_soldto_account""")
def slash_names(spark: SparkSession, folder: str) -> DataFrame:
    """Account names in their parts before and after a slash."""
    before, after = accounts.slash_halves(F.col("ACCOUNT_NAME"))
    return read(spark, folder, "organization_soldto_account").select("ID", "ACCOUNT_NAME", before.alias("name_before"), after.alias("name_after"))


@query(r"""SELECT ID, CASE WHEN regexp_matches(ACCOUNT_NAME, '(?i)food') THEN 'FOOD' ELSE nullif(regexp_extract(ACCOUNT_NAME, '^(\w+)\W+.*?(\d+)\s*$', 1), '') END AS stem,
  nullif(regexp_extract(ACCOUNT_NAME, '^(\w+)\W+.*?(\d+)\s*$', 2), '') AS store FROM organization_soldto_account""")
def name_captures(spark: SparkSession, folder: str) -> DataFrame:
    """First word and store number of account names, one kind replaced."""
    stem, store = accounts.captured(F.col("ACCOUNT_NAME"), r"^(\w+)\W+.*?(\d+)\s*$", (1, 2), "(?i)food", "FOOD")
    return read(spark, folder, "organization_soldto_account").select("ID", stem.alias("stem"), store.alias("store"))


@query()
def similar_names(spark: SparkSession, folder: str) -> DataFrame:
    """Organisations whose name is like that of each other one."""
    return accounts.similar_pairs(read(spark, folder, "organization"), "ID", "ORGANIZATION_NAME", 60)


_DRAW = "CAST('0x' || substr(md5(concat_ws('|', {0})), 1, 15) AS BIGINT)"


@query(f"""WITH r AS (SELECT c_custkey, c_name LIKE '%/%' AS slash, CAST(CASE WHEN c_acctbal = m.hi THEN 4 ELSE least(4, floor((c_acctbal - m.lo) / (m.hi - m.lo) * 5)) END AS INTEGER) AS bin FROM customer, (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer) m),
i AS (SELECT *, row_number() OVER (PARTITION BY bin, slash ORDER BY {_DRAW.format("'42', c_custkey")}, c_custkey) AS i FROM r), g AS (SELECT bin, slash, count(*) AS n FROM r GROUP BY 1, 2),
d AS (SELECT bin, slash, draw, {_DRAW.format("'42', bin, slash, draw")} % n + 1 AS i FROM g, (SELECT unnest([1, 2, 3]) AS draw))
SELECT c_custkey, bin, slash, draw FROM i JOIN d USING (bin, slash, i)""")
def account_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Three customers, drawn with replacement, of each of five bins of balance."""
    return accounts.sample_bins(read(spark, folder, "customer"), "c_acctbal", "c_name", 5, 3, 42, "c_custkey").select("c_custkey", "bin", "slash", "draw")


@query(f"SELECT ID, {_strings('address')} AS text FROM dim_location_sales_order WHERE ZIP5 BETWEEN '20000' AND '60000' AND STATE NOT IN ('OH', 'AZ') AND STATE IS NOT NULL ORDER BY ZIP5, ID")
def filtered_places(spark: SparkSession, folder: str) -> DataFrame:
    """Raw records of some states and zips in order."""
    rows = _sales(spark, folder).where(F.col("ZIP5").between("20000", "60000") & ~F.col("STATE").isin("OH", "AZ"))
    return rows.select("ID", joined("STREET_NUM", "STREET", "CITY", "STATE", "ZIP5").alias("text"), "ZIP5").orderBy("ZIP5", "ID").drop("ZIP5")
