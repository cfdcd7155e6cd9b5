"""Staging tables of an upload: declared schemas, and views that live as long as the upload."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The columns of a canonical location and of a sold-to location as they are uploaded.
LOCATION = (
    "ID string, OPS_LOC_NAME string, MAIN_LOC_NAME string, OPS_STREET string, OPS_CITY string, OPS_STATE string, OPS_ZIP5 string, OPS_SUBLOCATION string, OPS_MARKER string, ORGANIZATION_ID string, ORGANIZATION_NAME string, "
    "CURATED boolean, LATITUDE double, LONGITUDE double, IS_BUILDING boolean, IS_ADDRESS boolean, IS_SITE boolean, GEOCODE_ACCURACY double, GEOCODE_LEVEL string"
)
SOLDTO_LOCATION = (
    "ID string, ORGANIZATION_NAME string, ORGANIZATION_ID string, OPS_STREET string, OPS_CITY string, OPS_STATE string, OPS_LOC_NAME string, OPS_ZIP5 string, LATITUDE double, LONGITUDE double, GEOCODE_ACCURACY double, GEOCODE_LEVEL string"
)


def random_id() -> Column:
    """An id by chance; it changes when the plan runs again, so write the rows before using it twice."""
    return F.uuid()


def conformed(df: DataFrame, schema: str, new_ids: bool = False) -> DataFrame:
    """The rows with exactly the declared columns: others ignored, missing ones null, values that don't fit null; with
    `new_ids` a missing ID is made by chance."""
    declared = [field.split() for field in schema.split(", ")]
    pick = [(F.col(name).try_cast(kind) if name in df.columns else F.lit(None).cast(kind)).alias(name) for name, kind in declared]
    out = df.select(*pick)
    return out.withColumn("ID", F.coalesce("ID", random_id())) if new_ids else out


@contextmanager
def staged(df: DataFrame, name: str, schema: str) -> Iterator[DataFrame]:
    """The conformed rows under a view name, which ends with the block whatever happens in it."""
    rows = conformed(df, schema)
    rows.createOrReplaceTempView(name)
    try:
        yield rows
    finally:
        df.sparkSession.catalog.dropTempView(name)
