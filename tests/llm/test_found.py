import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")
COLUMNS = {
    "p2_found": ["dup_group_id bigint", "field_name string", "record_id string"], "p4_found": ["id_a bigint", "id_b bigint"], "p5_found": ["account_row_id bigint", "organization_id string"],
    "p6_found": ["source_table string", "source_id bigint", "ops_location_id string"], "p7_ids": ["doc_id bigint", "ids array<int>"], "p9_found": ["doc_id_a bigint", "doc_id_b bigint"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_distinct_rows(spark, name):
    import __spark_entry__ as entry

    df = entry.queries()[name](spark, DATA)
    assert [f"{c} {t}" for c, t in df.dtypes] == COLUMNS[name]
    rows = [str(tuple(r)) for r in df.collect()]
    assert len(rows) == len(set(rows))


def test_survivors_equal_their_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from compare import rows

    import __spark_entry__ as entry

    con = duckdb.connect()
    for t in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {t.stem} as select * from '{t}'")
    cur = con.execute(entry.oracle_sql()["p2_found"])
    df = entry.queries()["p2_found"](spark, DATA)
    assert rows(df.columns, df.collect()) == rows([x[0] for x in cur.description], cur.fetchall())
