import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {t.stem} as select * from '{t}'")
    return con


#: Queries that SQL is too slow for on whole tables, each tested against brute force in a module of its own.
COMPARED_ELSEWHERE = {"similar_names"}


def names():
    from cairnfield.plans import registry

    return sorted(registry.QUERIES)


@pytest.mark.parametrize("name", names())
def test_query_equals_its_sql(spark, duck, name):
    from compare import rows

    import __spark_entry__ as entry

    df = entry.queries()[name](spark, DATA)
    got = rows(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    assert sql or name in COMPARED_ELSEWHERE
    if sql:
        cur = duck.execute(sql)
        columns = [x[0] for x in cur.description]
        assert sorted(columns) == sorted(df.columns) and got == rows(columns, cur.fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
