from datetime import datetime as T

from cairnfield.operators.orphans import Reference, all_orphans, orphan_counts, orphans

REF = Reference("child", "REF", "parent")
U = "0a0b0c0d-0000-4000-8000-00000000000"


def frames(spark):
    parent = spark.createDataFrame(
        [(U + "1", T(2024, 1, 1), None), (U + "2", T(2024, 1, 1), T(2024, 2, 1)), (U + "2", T(2024, 3, 1), None), (U + "3", T(2024, 1, 1), T(2024, 2, 1)), (U + "4", T(2024, 9, 1), None), ("0042", T(2024, 1, 1), None), (None, T(2024, 1, 1), None)],
        "ID string, LOADED_AT timestamp, DELETED_AT timestamp",
    )
    rows = [(1, U + "1"), (2, " {" + U.upper() + "1} "), (3, U + "2"), (4, U + "3"), (5, U + "4"), (6, U + "9"), (6, U + "9"), (7, None), (8, "  "), (9, "42.0"), (10, "43")]
    return spark.createDataFrame([(i, k, T(2024, 5, 6), "x") for i, k in rows], "ID long, REF string, LOADED_AT timestamp, k string"), parent


def test_kinds(spark):
    child, parent = frames(spark)
    got = {(r.record_id, r.period, r.kind) for r in orphans(child, parent, REF).collect()}
    assert got == {("4", "2024-05", "deleted"), ("5", "2024-05", "late"), ("6", "2024-05", "missing"), ("10", "2024-05", "missing")}
    counts = {(r.kind, r.n_records) for r in orphan_counts(all_orphans({"child": child, "parent": parent}, [REF])).collect()}
    assert counts == {("deleted", 1), ("late", 1), ("missing", 2)}


def test_empty_tables_null_time_and_no_deletion(spark):
    child, parent = frames(spark)
    assert orphans(child.limit(0), parent, REF).count() == 0
    assert {r.kind for r in orphans(child, parent.limit(0), REF).collect()} == {"missing"}
    late = orphans(child.selectExpr("ID", "REF", "cast(null as timestamp) LOADED_AT"), parent, REF)
    assert {(r.record_id, r.period, r.kind) for r in late.collect()} == {("4", None, "deleted"), ("6", None, "missing"), ("10", None, "missing")}
    assert "deleted" not in {r.kind for r in orphans(child, parent.drop("DELETED_AT"), REF).collect()}


def test_skewed_key(spark):
    child = spark.range(3000).selectExpr("id ID", f"case when id % 3 = 0 then '{U}1' else concat('k', id % 7) end REF", "timestamp'2024-05-06' LOADED_AT")
    assert orphans(child, frames(spark)[1], REF).count() == 2000
