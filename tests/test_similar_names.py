"""Every organisation is a target."""

from cairnfield.functions.text import ratio_of
from cairnfield.plans import relational


def test_every_name_is_a_target(spark, tmp_path):
    names = {"O1": "Rynsobury Textile Incorporated", "O2": "Rynsoburg Textile", "O3": "RYNSOBURY TEXTILE INCORPORATED", "O4": "Water Authority", "O5": "Water Authority", "O6": "Urbzoven Steel", "O7": None}
    spark.createDataFrame(list(names.items()), "ID string, ORGANIZATION_NAME string").write.parquet(f"{tmp_path}/organization.parquet")
    got = {tuple(r) for r in relational.similar_names(spark, str(tmp_path)).select("target", "ID", "ORGANIZATION_NAME", "similarity").collect()}
    alike = {(a, b, y, ratio_of(x.upper(), y.upper())) for a, x in names.items() for b, y in names.items() if a != b and x and y}
    assert got == {r for r in alike if r[3] >= 60} and {"O1", "O2", "O3", "O4", "O5"} <= {r[0] for r in got}
