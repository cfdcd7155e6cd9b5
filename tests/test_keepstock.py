"""Stock records against the canonical addresses of their account's organisations, as SQL has them."""

import sys
from pathlib import Path

import pytest

from cairnfield.plans import workflow

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
OPS = "ID string, ORGANIZATION_ID string, IS_ADDRESS boolean, DELETED_AT string, OPS_STREET string, OPS_CITY string, OPS_STATE string, OPS_ZIP5 string"
KEEP = "ID long, ACCOUNT string, ADDRESS1 string, CITY string, PROVINCE string, ZIP5 string"
ACCOUNTS = "ORGANIZATION_ID string, ACCOUNT string"


def write(spark, folder, ops, keep, accounts):
    for name, rows, schema in (("ops_location", [(i, o, True, None, s, "Oakton", "IL", "60001") for i, o, s in ops], OPS), ("dim_location_keepstock", [(i, a, s, "Oakton", "IL", "60001") for i, a, s in keep], KEEP), ("organization_soldto_account", accounts, ACCOUNTS)):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def test_shared_organisations_and_accounts_equal_sql(spark, tmp_path):
    from compare import rows

    duckdb = pytest.importorskip("duckdb")
    ops = [("m", "O1", "12 Main Street"), ("m", "O2", "99 Elm Road"), ("m", "O2", "12 Main Street"), ("n", "O1", "12 Maine St"), ("p", "O2", "99 Elm Rd"), ("q", "O3", "5 Ash Lane"), ("q", "O3", "5 Ash Ln Rear"), ("s", None, "12 Main Street"), ("t", "O4", "8 Fir Court"), ("a", "O1", "12 Maine St"), (None, "O1", "12 Main Str")]
    keep = [(1, "A", "12 main street"), (2, "A", "99 elm road"), (2, "B", "99 elm road 5"), (3, "B", "12 main street 99 elm"), (4, "C", "5 ash"), (4, "C", "5 ash lane rear"), (5, "Z", "8 fir court"), (6, None, "8 fir court"), (7, "C", ""), (8, "D", "12 main street")]
    accounts = [("O1", "A"), ("O2", "B"), ("O1", "B"), ("O3", "C"), ("O3", "C"), ("O2", None), (None, "A"), ("O4", "X"), ("O3", "D"), ("O2", "D")]
    write(spark, tmp_path, ops, keep, accounts)
    con = duckdb.connect()
    for t in ("ops_location", "dim_location_keepstock", "organization_soldto_account"):
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    found = con.execute(workflow.SQL["match_keepstock"])
    columns = [x[0] for x in found.description]
    df = workflow.match_keepstock(spark, str(tmp_path)).select(*columns)
    assert rows(columns, df.collect()) == rows(columns, found.fetchall())
    assert {r.dim_id for r in df.collect()} == {1, 2, 3, 4, 7, 8}


def test_addresses_are_not_repeated_for_each_account(spark, tmp_path):
    """A thousand addresses and accounts of one organisation: a million rows where each address is repeated."""
    write(spark, tmp_path, [(f"r{i:04d}", "O1", f"{i} Main Street") for i in range(1000)], [(i, f"A{i}", f"{i} Main Street") for i in range(1000)], [("O1", f"A{i}") for i in range(1000)])
    written = lambda: (spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30000), spark.sparkContext._jsc.sc().statusStore().executorList(True).head().totalShuffleWrite())[1]
    before = written()
    got = {r.dim_id: r.ops_id for r in workflow.match_keepstock(spark, str(tmp_path)).collect()}
    assert got == {i: f"r{i:04d}" for i in range(1000)}
    assert written() - before < 2_000_000
