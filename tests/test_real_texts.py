"""The address queries read the real texts of every row; broken variants are cases of the operators here."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cairnfield.functions import text
from cairnfield.operators import address as A

DATA = "/root/testdata/sf0.001"
#: What the registered SQL puts in the place of the real texts, and those.
INJECTED = {
    "pobox_interstate": ("CASE WHEN ID % 7 = 0 THEN '12 I ' || STREET_NUM ELSE STREET END", "STREET"),
    "intersection_flag": ("CASE ID % 5 WHEN 0 THEN 'Hwy 59 & ' || STREET WHEN 1 THEN 'US 191 and AZ 264' WHEN 2 THEN 'I 26 & Hwy 21 St' ELSE STREET END", "STREET"),
    "ordinal_fix": ("(ID % 90) || ' ' || (['Street', 'Road', 'Th', 'Nd'])[ID % 4 + 1] || ' Avenue'", "STREET"),
    "garbage_after_suffix": ("CASE WHEN ID % 2 = 0 THEN STREET || ' Main Street garbage' ELSE STREET END", "STREET"),
}


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")
@pytest.mark.parametrize("name", sorted(INJECTED))
def test_query_reads_the_real_texts(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con, sql = duckdb.connect(), entry.oracle_sql()[name]
    for t in ("dim_location_sales_order", "dim_location_soldto"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got = {tuple(r) for r in entry.queries()[name](spark, DATA).collect()}
    assert got and got == set(con.execute(sql.replace(*INJECTED[name])).fetchall())


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")
def test_parsed_coordinates_are_those_of_every_location(spark):
    rows = spark.read.parquet(f"{DATA}/ops_location.parquet").select("ID", F.coalesce("LATITUDE", F.lit(0.0)), F.coalesce("LONGITUDE", F.lit(0.0)))
    got = entry.queries()["parsed_coordinates"](spark, DATA).select("ID", "lat", "lon")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))


def test_injected_variants(spark):
    one = lambda f, *texts: [r[0] for r in spark.createDataFrame([(x,) for x in texts], "t string").select(f(F.col("t"))).collect()]
    assert one(A.special, "12 I 44", "P.O. BOX 21667", "9 Oak St") == ["12 Interstate 44", "PO Box 21667", "9 Oak St"]
    assert one(A.is_intersection, "Hwy 59 & Oak St", "US 191 and AZ 264", "I 26 & Hwy 21 St", "9 Oak St") == [True, True, True, False]
    assert one(lambda c: A.ordinals(c, ["Avenue", "Road", "Street"]), "21 Street Avenue", "33 Road Avenue", "54 Th Avenue", "32 Nd Avenue") == ["21st Avenue", "33rd Avenue", "54th Avenue", "32nd Avenue"]
    assert one(A.without_garbage, "12 Oak Main Street garbage", "12 Oak Street") == ["12 Oak Main Street", "12 Oak Street"]
    assert one(text.coordinates, "(-7.25, 7.5)", "none", "(-1.0E-4, 7.5)") == [(7.5, -7.25), (0.0, 0.0), (7.5, -0.0001)]
