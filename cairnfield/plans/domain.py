"""Queries over the location tables by the core operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cairnfield.operators import hierarchy
from cairnfield.operators.orphans import Reference, all_orphans, orphan_counts
from cairnfield.sources.tables import read

REFERENCES = (
    Reference("dim_location_sales_order", "OPS_LOCATION_ID", "ops_location"),
    Reference("dim_location_keepstock", "OPS_LOCATION_ID", "ops_location"),
    Reference("dim_location_soldto", "OPS_LOCATION_ID", "soldto_location"),
    Reference("ops_location", "DNB_DIM_LOCATION_ID", "dim_location_dnb"),
)


def _links(spark: SparkSession, folder: str, every: bool = False) -> DataFrame:
    return hierarchy.links_by_name(read(spark, folder, "ops_location"), "ID", "OPS_LOC_NAME", "MAIN_LOC_NAME", every)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Root and depth of every location that names a parent."""
    return hierarchy.resolve(_links(spark, folder))


def p1_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Path from the root of every location, as ids joined by '>'; null on and below cycles."""
    return hierarchy.paths(_links(spark, folder, True), cycles=True).selectExpr("id", "root_id", "depth", "array_join(path, '>') path")


def p1_descendants(spark: SparkSession, folder: str) -> DataFrame:
    """Every pair of a location and one below it, with the levels between them."""
    return hierarchy.descendants(hierarchy.paths(_links(spark, folder)))


def _orphans(spark: SparkSession, folder: str) -> DataFrame:
    names = {n for r in REFERENCES for n in (r.table, r.parent)}
    return all_orphans({n: read(spark, folder, n) for n in names}, REFERENCES)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every record with an orphan reference."""
    return _orphans(spark, folder)


def p3_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Orphan references per table, month and kind."""
    return orphan_counts(_orphans(spark, folder))


QUERIES = {f.__name__: f for f in (p1_found, p1_paths, p1_descendants, p3_found, p3_counts)}

_NAME = "nullif(lower(trim(regexp_replace({}, '\\s+', ' ', 'g'))), '')"
_LINKS = f"""links AS (
  WITH r AS (SELECT DISTINCT "ID" id, {_NAME.format('"OPS_LOC_NAME"')} nm, {_NAME.format('"MAIN_LOC_NAME"')} pn FROM ops_location),
  n AS (SELECT nm, min(id) parent FROM r WHERE nm IS NOT NULL GROUP BY nm)
  SELECT r.id, min(n.parent) parent FROM r LEFT JOIN n ON r.pn = n.nm WHERE r.pn IS NOT NULL GROUP BY r.id),
walk(id, top, depth, path, looped) AS (
  SELECT id, id, 0, [id], false FROM links
  UNION ALL
  SELECT w.id, l.parent, w.depth + 1, list_prepend(l.parent, w.path), list_contains(w.path, l.parent)
  FROM walk w JOIN links l ON w.top = l.id WHERE l.parent IS NOT NULL AND NOT w.looped),
ends AS (SELECT id, arg_max(top, depth) root_id, max(depth)::INTEGER depth, arg_max(path, depth) path, bool_or(looped) looped,
  bool_or(looped AND top = id) self FROM walk GROUP BY id)"""
_KEY = """CASE WHEN regexp_matches({0}, '^[0-9]+(\\.0*)?$') THEN regexp_extract({0}, '^0*([0-9]+)', 1)
  WHEN regexp_matches({0}, '^[0-9a-f-]{{32,36}}$') THEN replace({0}, '-', '') ELSE {0} END"""


def _key(c: str) -> str:
    return _KEY.format(f"nullif(lower(regexp_replace({c}::VARCHAR, '[{{}}\\s]', '', 'g')), '')")


def _orphan_sql(r: Reference) -> str:
    return f"""SELECT DISTINCT '{r.table}' table_name, c.id record_id, strftime(c."at", '%Y-%m') period,
  CASE WHEN p.k IS NULL THEN 'missing' WHEN p.gone THEN 'deleted' WHEN p.first > c."at" THEN 'late' END kind
FROM (SELECT "ID"::VARCHAR id, {_key(f'"{r.column}"')} k, "LOADED_AT" AS at FROM {r.table}) c
LEFT JOIN (SELECT {_key('"ID"')} k, min("LOADED_AT") AS first, bool_and("DELETED_AT" IS NOT NULL) gone FROM {r.parent} GROUP BY 1) p ON c.k = p.k
WHERE c.k IS NOT NULL AND (p.k IS NULL OR p.gone OR p.first > c."at")"""


_ORPHANS = "\nUNION ALL\n".join(map(_orphan_sql, REFERENCES))

SQL = {
    "p1_found": f"""WITH RECURSIVE {_LINKS} SELECT id, CASE WHEN looped THEN 'cycle' ELSE root_id END root_id,
  CASE WHEN self THEN -1 WHEN looped THEN -2 ELSE depth END::INTEGER depth FROM ends""",
    "p1_paths": f"""WITH RECURSIVE {_LINKS.replace('WHERE r.pn IS NOT NULL GROUP BY', 'GROUP BY')} SELECT id, CASE WHEN looped THEN 'cycle' ELSE root_id END root_id,
  CASE WHEN self THEN -1 WHEN looped THEN -2 ELSE depth END::INTEGER depth, CASE WHEN NOT looped THEN array_to_string(path, '>') END path FROM ends""",
    "p1_descendants": f"""WITH RECURSIVE {_LINKS} SELECT w.top ancestor_id, w.id descendant_id, w.depth::INTEGER levels
FROM walk w JOIN ends e ON w.id = e.id WHERE NOT e.looped AND w.depth > 0""",
    "p3_found": _ORPHANS,
    "p3_counts": f"SELECT table_name, period, kind, count(*) n_records FROM ({_ORPHANS}) GROUP BY 1, 2, 3",
}
