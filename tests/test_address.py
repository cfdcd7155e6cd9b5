import pytest
from pyspark.sql import functions as F

from cairnfield.operators import address as A
from cairnfield.operators import curate

RULES = A.Rules()
COLUMNS = ["STREET", "STREET_NUM", "CITY", "STATE", "ZIP5", "DEPARTMENT", "ATTENTION", "SUPPLEMENTAL", "RECEIVER", "ORGANIZATION_ID", "ORGANIZATION_NAME", "ID"]


def curated(spark, streets, soldto=False, **other):
    rows = []
    for i, s in enumerate(streets):
        row = dict.fromkeys(COLUMNS, "") | {"STREET": s, "CITY": "Olympia", "STATE": "WA", "ZIP5": "12345", "ORGANIZATION_ID": "1", "ORGANIZATION_NAME": "TEST", "ID": str(i)}
        rows.append(row | {k: v[i] for k, v in other.items()})
    df = spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], ", ".join(f"{c} string" for c in COLUMNS))
    pre = curate.precurate(df, ("ORGANIZATION_ID", "STATE"), RULES)
    return (curate.soldto_locations if soldto else curate.sales_locations)(pre).collect()


def streets_of(rows):
    return {r.OPS_STREET for r in rows}


def ids_of(rows, street):
    return {int(i) for r in rows if r.OPS_STREET == street for i in r.DIM_LOCATION_ID}


@pytest.mark.parametrize("soldto", [False, True])
def test_repairs_from_the_population(spark, soldto):
    rows = curated(spark, 9 * ["123 Main Street"] + ["Main Street"], soldto)
    assert streets_of(rows) == {"123 Main Street"} and ids_of(rows, "123 Main Street") == set(range(10))
    assert streets_of(curated(spark, 5 * ["1 North High Street"] + 3 * ["1 High Street North"] + 2 * ["1 High North Street"], soldto)) == {"1 North High Street"}
    assert streets_of(curated(spark, 8 * ["1203 Kirschbaum Drive"] + 2 * ["1203 Kirschbaum"], soldto)) == {"1203 Kirschbaum Drive"}
    garbage = curated(spark, 4 * ["45 Turtledove Lane"] + ["45 Turtledove Lane zzqxv"] + 3 * ["46 Turtledove Lane"] + 2 * ["46 Turtledove Lane leftover"], soldto)
    assert streets_of(garbage) == {"45 Turtledove Lane", "46 Turtledove Lane"} and len(garbage) == 2


def test_sublocations_from_other_fields(spark):
    rows = curated(
        spark, 10 * ["123 MAIN STREET"], SUPPLEMENTAL=8 * [""] + ["BLDG 1", ""], ATTENTION=7 * [""] + ["WAREHOUSE A", "", ""], RECEIVER=6 * [""] + ["WAREHOUSE B"] + 3 * [""], DEPARTMENT=5 * [""] + ["BUILDING 2"] + 4 * [""]
    )
    assert len(rows) == 5 and {r.OPS_SUBLOCATION for r in rows} == {"", "Building 1", "Building 2", "Warehouse A", "Warehouse B"}
    assert {r.MAIN_LOC_NAME for r in rows if r.IS_BUILDING} == {"1 @ 123 Main Street"}


def test_boxes_grids_and_named_roads(spark):
    boxes = curated(spark, ["PO BOX 123", "P.O. Box 123", "p o box 456", "P.O.Box 456"])
    assert {(r.OPS_STREET, tuple(r.DIM_LOCATION_ID)) for r in boxes} == {("PO Box 123", ("0", "1")), ("PO Box 456", ("2", "3"))}
    grid = curated(spark, ["N64W2031 Quarry Road", "N64W2031 Quarry Rd", "N 64W 2031 Quarry Road", "S96W3055 Cedar Way", "S 96 W 3055 Cedar Way", "S96 W3055 Cedar Wy", "N64 Willow Dr", "W40 Harvest Rd", "S360 Lantern St", "515 S 42nd Street"])
    assert streets_of(grid) == {"N64W2031 Quarry Road", "S96W3055 Cedar Way", "N64 Willow Drive", "W40 Harvest Road", "S360 Lantern Street", "515 South 42nd Street"}
    assert ids_of(grid, "N64W2031 Quarry Road") == {0, 1, 2} and ids_of(grid, "S96W3055 Cedar Way") == {3, 4, 5}
    plain = curated(spark, ["123 I-24", "123 I 24", "123 Interstate 24", "123 Int 24", "1441 Broadway", "1441 broadway", "456 Highway 1", "456 hwy 1", "600 market concourse"])
    assert streets_of(plain) == {"123 Interstate 24", "1441 Broadway", "456 Highway 1", "600 Market Concourse"} and ids_of(plain, "123 Interstate 24") == {0, 1, 2, 3}
    assert streets_of(curated(spark, ["123 US Hwy 10", "123 us Hiwy 10", "W456 Hway 9", "99 Hiway 9", "99 Highway 9", "W1234 US Hiway 1"])) == {"123 Us Highway 10", "W456 Highway 9", "99 Highway 9", "W1234 Us Highway 1"}


def test_sublocation_words_within_names(spark):
    names = ["45 Dock Road", "24 Old Building Way", "123 Quiet Suite Drive", "456 Warehouse Drive"]
    rows = curated(spark, names)
    assert streets_of(rows) == set(names) and {r.OPS_SUBLOCATION for r in rows} == {""}
    last = curated(spark, ["123 Main Street Building"])
    assert [r.OPS_STREET for r in last] == ["123 Main Street"]


def test_spanish_names_and_directions(spark):
    rows = curated(spark, ["61 W El Camino Verde Ste 100", "61 West El Camino Verde Suite 100", "871 W Calle Luna", "871 W Cll Luna", "2310 Cer Del Prado", "123 Pso Rd"])
    assert streets_of(rows) == {"61 West El Camino Verde", "871 West Calle Luna", "2310 Cerrada Del Prado", "123 Pso Road"} and ids_of(rows, "61 West El Camino Verde") == {0, 1}
    rows = curated(spark, ["123 Copper S", "Copper South", "123Copper South blahblah", "456 West Tanner", "W Tanner", "Main SW", "999main southwest"], STREET_NUM=["", "123", "", "", "456", "999", ""])
    assert streets_of(rows) == {"123 Copper South", "456 West Tanner", "999 Main South West"}


def test_row_rules():
    assert A.infer(None, "123 Main Street Building 1", ["", "", "Dock 2", ""], RULES) == ("123 Main Street", "Building 1", "Dock 2")
    assert A.infer(None, None, [None], RULES) == ("", "", "") and A.infer("12", "", [], RULES)[0] == "12"
    assert A.split_sublocation(["Building", "1", "123", "Main", "Street"], RULES) == (["123", "Main", "Street"], ["Building", "1"])
    assert A.found_in(["Ask", "Martha"], [], RULES) == [] and A.found_in(["Building", "1"], [], RULES) == ["Building", "1"] and A.found_in(["5", "Building"], [], RULES) == ["Building", "5"]
    assert A.clean("123main Street! Folks##").split() == ["123", "main", "Street!", "Folks"]
    assert len(A.infer(None, "1 " + "very " * 20000 + "long street", [], RULES)[0]) > 100000
    assert A.marker_of("Building") is None and A.marker_of(None) is None


def test_column_rules(spark):
    df = spark.createDataFrame([("12 I 24 east",), ("p o box 7",), ("US 19 and AZ 26",), ("22 Street Road",), (None,), ("",)], "s string")
    got = [tuple(r) for r in df.select(A.special(F.col("s")), A.is_intersection(F.col("s")), A.ordinals(F.col("s"), ["Road"]), A.is_valid(F.col("s"))).collect()]
    assert got[1:] == [("PO Box 7", False, "p o box 7", False), ("US 19 and AZ 26", True, "US 19 and AZ 26", True), ("22 Street Road", False, "22st Road", True), (None, None, None, False), ("", False, "", False)]
    assert got[0][0] == "12 Interstate 24"


def test_dictionary_file(tmp_path):
    path = tmp_path / "words.json"
    path.write_text('{" blvd ": " Boulevard", "via": "Viaduct", "ml": "Mill"}')
    assert A.load_dictionary(str(path)) == {"blvd": "Boulevard", "ml": "Mill"}
    assert A.infer(None, "5 Old Ml", [], A.Rules(suffixes=A.load_dictionary(str(path))))[0] == "5 Old Mill"


def test_every_suffix_spelling(spark):
    rows = curated(spark, [f"123 Oakley {key}" for key in RULES.suffixes])
    assert streets_of(rows) == {f"123 Oakley {value}" for value in RULES.suffix_values - {v for v in RULES.spanish.values() if v not in RULES.suffixes.values()}} and len(rows) == len(set(RULES.suffixes.values()))
    assert "Place" in RULES.suffixes.values() and "via" not in RULES.suffixes and len(set(RULES.suffixes.values())) > 200


def test_empty_table(spark):
    assert curated(spark, []) == []
