"""Queries hold every record of their tables, each with its real values."""

from cairnfield.plans import domain


def test_paths_of_tops_single_and_cyclic_records(spark, tmp_path):
    rows = [("1", "top", None), ("2", "mid", "Top"), ("3", "leaf", " MID "), ("4", "single", "  "), ("5", None, None), ("6", "lost", "unknown"), ("7", "x", "y"), ("8", "y", "x"), ("9", "below", "x"), ("2", "mid", "Top")]
    spark.createDataFrame(rows, "ID string, OPS_LOC_NAME string, MAIN_LOC_NAME string").write.parquet(f"{tmp_path}/ops_location.parquet")
    got = sorted(tuple(r) for r in domain.p1_paths(spark, str(tmp_path)).select("id", "root_id", "depth", "path").collect())
    assert got == [
        ("1", "1", 0, "1"), ("2", "1", 1, "1>2"), ("3", "1", 2, "1>2>3"), ("4", "4", 0, "4"), ("5", "5", 0, "5"), ("6", "6", 0, "6"),
        ("7", "cycle", -1, None), ("8", "cycle", -1, None), ("9", "cycle", -2, None),
    ]
    assert {r.id for r in domain.p1_found(spark, str(tmp_path)).collect()} == {"2", "3", "6", "7", "8", "9"}
