"""Queries over duplicate groups: the best representative of each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnfield.llm import representatives
from cairnfield.llm.addresses import DIRECTION_OF, SUBLOCATIONS
from cairnfield.sources.tables import read


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return representatives.live_records(read(spark, folder, "soldto_location"), read(spark, folder, "zip_reference"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """The record that supplies each field of each group's survivor."""
    return representatives.survivors(_records(spark, folder))


def p2_truth(spark: SparkSession, folder: str) -> DataFrame:
    """Every usable value of each group with the probability that it is true, and whether it is kept."""
    return representatives.truths(_records(spark, folder)).withColumn("probability", F.round("probability", 6))


def p2_agreement(spark: SparkSession, folder: str) -> DataFrame:
    """How often the latent model and the fixed order of trust go together, by field."""
    return representatives.agreement(_records(spark, folder))


QUERIES = {f.__name__: f for f in (p2_found, p2_truth, p2_agreement)}

_DIRS = "|".join(sorted(DIRECTION_OF, key=len, reverse=True))
_STREET = r"lower(OPS_STREET)"
_REST = rf"regexp_replace(regexp_replace({_STREET}, '^\s*\d+[a-z]?[\s,]+', ''), '^((?:{_DIRS}|n\.e\.|n\.w\.|s\.e\.|s\.w\.)\.?(?:\s+|$))+', '')"
_SOURCE = """SELECT DISTINCT s.*, CASE WHEN GEOCODE_ACCURACY BETWEEN 0 AND 1 AND NOT isnan(GEOCODE_ACCURACY) THEN GEOCODE_ACCURACY END acc
  FROM soldto_location s WHERE DELETED_AT IS NULL
  AND DUP_GROUP_ID IN (SELECT DUP_GROUP_ID FROM soldto_location WHERE DELETED_AT IS NULL GROUP BY 1 HAVING count(DISTINCT ID) > 1)"""
_BEST = "SELECT DUP_GROUP_ID AS dup_group_id, '{0}' field_name, ID record_id FROM r WHERE ({1}) QUALIFY row_number() OVER (PARTITION BY DUP_GROUP_ID ORDER BY acc DESC NULLS LAST, UPDATED_AT DESC NULLS LAST, ID) = 1"
SQL = {
    "p2_found": f"WITH r AS ({_SOURCE})\n"
    + "\nUNION ALL\n".join(
        _BEST.format(f, ok)
        for f, ok in (
            ("OPS_STREET", rf"regexp_matches({_STREET}, '^\s*(?:p\.?\s*o\.?\s*|post\s+office\s+)(?:box|bx)\s*#?\s*\d+') OR (regexp_matches({_STREET}, '^\s*\d+[a-z]?[\s,]+') AND regexp_matches({_REST}, '^(?:\d+(?:st|nd|rd|th)\s+[a-z]|[a-z]{{2,}}|\d+(?:st|nd|rd|th)\s*$)') AND NOT regexp_matches({_REST}, '^(?:{SUBLOCATIONS.replace(' ', '|')})\b'))"),
            ("OPS_ZIP5", "EXISTS (SELECT 1 FROM zip_reference z WHERE z.ZIP5 = r.OPS_ZIP5 AND z.STATE = r.OPS_STATE)"),
            ("GEOCODE_ACCURACY", "acc IS NOT NULL"),
        )
    )
}
