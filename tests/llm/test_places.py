import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnfield.llm import addresses as A
from cairnfield.llm import cross_match as C
from cairnfield.llm import same_address as S

ZIPS = [("35193", "Wexley", "AL"), ("64011", "Fort Varnbury", "MO"), ("64018", "Fort Varnbury", "MO"), ("05121", "Varnstead", "VT"), ("97074", "East Aldmont", "OR"), ("85235", "Jessburg", "AZ"), ("85200", "Jessbury", "AZ")]


@pytest.mark.parametrize(("street", "number", "others", "want"), [
    ("4914Brackenburrow Square", None, [], ("4914", "", "brackenburrow", "square")), ("16625W LANERNBANK STRT - Bld 283", None, [], ("16625", "west", "lanernbank", "street")), ("N.E. C.R. 593", "2042", [], ("2042", "north east", "county road 593", "")),
    ("P.O.BOX17264", None, [], ("17264", "", "po box", "")), ("Warehouse 55 2236  Ironledge Boulevard", None, [], ("2236", "", "ironledge", "boulevard")), ("M. Tarnwell", None, ["M. Tarnwell", "500  Ambbermead Drive"], ("500", "", "ambbermead", "drive")),
    ("6793 OLIVEREACH WAY WEST, Bay 15A", None, [], ("6793", "west", "olivereach", "way")), ("01441 bridlestead rd. do not bend", None, [], ("1441", "", "bridlestead", "road")), ("9243 69 Street", None, [], ("9243", "", "69", "street")), ("9243 69th St", None, [], ("9243", "", "69", "street")),
    ("Second Ave", "2027", [], ("2027", "", "2", "avenue")), (None, None, [None, ""], ("", "", "", "")), ("303CR 317", None, [], ("303", "", "county road 317", "")), ("16 Moss-Reach Street", None, [], ("16", "", "mossreach", "street")),
])
def test_parse(street, number, others, want):
    a = A.parse(street, number, others)
    assert (a.number, a.direction, a.name, a.suffix) == want


def test_long_text():
    assert A.parse("12 " + "very " * 20000 + "long street").number == "12"


@pytest.mark.parametrize(("city", "state", "code", "want"), [
    ("FT. VARNBURY", "MO", "64011", "MO|fortvarnbury"), ("Fort Varnbry, MO", "", "", "MO|fortvarnbury"), (None, "VT", "5121", "VT|varnstead"), ("E ALDMONT", "OR", "97074-2609", "OR|eastaldmont"), ("jessbur", "AZ", "85235", "AZ|jessburg"), ("", "", "", ""), ("Nowhere", "AL", "", "AL|nowhere"),
])
def test_city(city, state, code, want):
    assert A.CityIndex(ZIPS).find(city, state, code) == want


def test_distance_against_plain():
    def plain(a, b):
        d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
        for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    rng = random.Random(1)
    for _ in range(4000):
        a, b = ("".join(rng.choices("abc", k=rng.randrange(7))) for _ in range(2))
        assert A.distance(a, b, 9) == plain(a, b) and A.distance(a, b, 1) == min(2, plain(a, b))


def test_alignment():
    assert S.align(["12", "main", "st"], ["12", "main", "street"]) == 0
    assert S.align(["12", "main", "st"], ["13", "main", "street"]) > S.ACCEPT
    assert 0 < S.align(["12", "crowfirth"], ["12", "crowfirht"]) <= S.ACCEPT
    assert S.align(["1", "county", "road", "684"], ["1", "county", "road", "685"]) > S.ACCEPT
    assert S.align(["a", "b", "c"], ["a"]) == 1.5 and S.align([], []) == 0


def typo(rng, word):
    i = rng.randrange(1, len(word) - 1)
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + word[i] + word[i:], word[:i] + word[i + 1] + word[i] + word[i + 2 :], word[:i] + "x" + word[i + 1 :]])


def test_records_of_one_location(spark):
    rng = random.Random(7)
    names, rows, truth = ["Crowfirth", "Nettleedge", "Goldgarth", "Ironledge"], [], {}
    for number, (name, suffix, direction) in itertools.product((12, 130), itertools.product(names, ("Street", "Avenue"), ("", "North "))):
        if direction and suffix == "Avenue":
            continue
        for _ in range(4 if name != "Crowfirth" else 40):
            shown = typo(rng, name) if rng.random() < 0.4 else name
            end = {"Street": ["Street", "St.", "STRET"], "Avenue": ["Ave", "AVENUE"]}[suffix]
            i = len(rows)
            rows.append((i, f"{number} {direction}{shown} {rng.choice(end)}", rng.choice(["Ft Varnbury", "FORT VARNBURY", "Fort Varnbry"]), "MO", "64011", "extra"))
            truth[i] = (number, name, suffix, "")
    rows += [(900, None, None, None, None, "x"), (901, "", " ", "", "", "x"), (902, "Main Street", "Wexley", "AL", "", "x"), (0, *rows[0][1:])]
    df = spark.createDataFrame(rows, "ID long, STREET string, CITY string, STATE string, ZIP5 string, number string").withColumnRenamed("number", "location")
    zips = spark.createDataFrame(ZIPS, "ZIP5 string, CITY string, STATE string")
    got = {tuple(r) for r in S.pairs(S.locations(S.parsed(df, zips, "ID", "STREET", "CITY", "STATE", "ZIP5"))).collect()}
    want = {(a, b) for a, b in itertools.combinations(sorted(truth), 2) if truth[a] == truth[b]}
    assert got == want  # a missing direction is filled where the street has one
    assert S.pairs(S.locations(S.parsed(df.limit(0), zips, "ID", "STREET", "CITY", "STATE", "ZIP5"))).count() == 0


def test_large_reference_is_met_by_state(spark, monkeypatch):
    df = spark.createDataFrame([(1, "1 Main St", "Ft Varnbury", "MO", None), (2, "1 Main St", None, None, "05121"), (3, None, None, None, None)], "ID long, STREET string, CITY string, STATE string, ZIP5 string")
    zips = spark.createDataFrame(ZIPS, "ZIP5 string, CITY string, STATE string")
    run = lambda: {r.id: r.place for r in S.parsed(df, zips, "ID", "STREET", "CITY", "STATE", "ZIP5").collect()}
    small = run()
    monkeypatch.setattr(S, "INDEX_ROWS", 2)
    assert run() == small == {1: "MO|fortvarnbury", 2: "VT|varnstead", 3: ""}


def test_blocks_find_all_close_vectors(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdef", k=rng.randrange(4, 9))) for _ in range(40)]
    words += [typo(rng, w) for w in words]
    words = sorted(set(words))
    forms = [(w, "1" if i % 5 else "2", "P", w) for i, w in enumerate(words)]
    df = spark.createDataFrame(forms, "form string, number string, place string, name string")
    got = {(r.l, r.r): r.dice for r in C.close_pairs(df, df).collect()}
    bits = {w: np.unpackbits(C.vector(w).view(np.uint8)) for w in words}
    number = {f[0]: f[1] for f in forms}
    full = {w: int((C.vector(w).view(np.uint8) != 0).sum()) for w in words}  # blocks of eight bits that hold one
    want = {(a, b): 1 - (bits[a] != bits[b]).sum() / (bits[a].sum() + bits[b].sum()) for a in words for b in words if number[a] == number[b] and (bits[a] != bits[b]).sum() < max(full[a], full[b])}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_confidence():
    import pandas as pd

    rng = np.random.default_rng(0)
    same = rng.random(400) < 0.5
    x = pd.DataFrame({f: 0.0 for f in C.FEATURES}, index=range(400)).assign(dice=np.where(same, 0.9, 0.5) + rng.normal(0, 0.05, 400), same=same)
    w = C.fit(x)
    p = 1 / (1 + np.exp(-(w[0] + w[1] * x["dice"])))
    assert ((p > 0.5) == same).mean() > 0.98 and C.fit(x.head(3)) == C.DEFAULT_WEIGHTS


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def test_matches_across_sources(spark, tmp_path):
    from cairnfield.llm.queries_places import p6_found

    f = str(tmp_path)
    write(spark, f, "zip_reference", ZIPS, "ZIP5 string, CITY string, STATE string")
    ops = [("u1", "12 Crowfirth Street", True), ("u2", "12 Crowfirth Avenue", True), ("u3", "77 North Goldgarth Lane", True), ("u3", "77 North Goldgarth Lane", True), ("u4", "5 Nettleedge Road", False), ("u5", None, True), ("u6", "PO Box 44", True), ("u7", "88 Ironledge Way", True)]
    write(spark, f, "ops_location", [(i, s, "Fort Varnbury", "MO", "64011", a, "7.0" if i == "u7" else None) for i, s, a in ops], "ID string, OPS_STREET string, OPS_CITY string, OPS_STATE string, OPS_ZIP5 string, IS_ADDRESS boolean, DNB_DIM_LOCATION_ID string")
    dnb = [(1, "12 crowfirht st"), (2, "12 Crowfirth"), (3, "77 Goldgarth ln"), (4, "5 Nettleedge Rd"), (5, None), (6, "p.o. box 44"), (7, "88 Ironledge Way"), (8, "77 S Goldgarth Ln")]
    write(spark, f, "dim_location_dnb", [(i, s, "Ft Varnbury", "MO", "64011", "x") for i, s in dnb], "ID long, PHYS_STRT_AD string, PHYS_CTY string, PHYS_ST_ABRV string, PHYS_ZIP5 string, form string")
    write(spark, f, "dim_location_keepstock", [(1, "88 Ironledge", "Fort Varnbury", "MO", "64018", None), (2, "88 Ironledge", "Fort Varnbury", "MO", "64018", " "), (3, "88 Ironledge", "Fort Varnbury", "MO", "64018", "u7")], "ID long, ADDRESS1 string, CITY string, PROVINCE string, ZIP5 string, OPS_LOCATION_ID string")
    got = {tuple(r) for r in p6_found(spark, f).collect()}
    assert got == {("dnb", 1, "u1"), ("dnb", 3, "u3"), ("dnb", 6, "u6"), ("keepstock", 1, "u7"), ("keepstock", 2, "u7")}


def test_large_reference_gives_the_same_answers(spark, monkeypatch):
    data = "/root/testdata/sf0.01"
    if not __import__("pathlib").Path(data).exists():
        pytest.skip("no test data")
    zips = spark.read.parquet(f"{data}/zip_reference.parquet")
    sales, dnb = (spark.read.parquet(f"{data}/dim_location_{n}.parquet") for n in ("sales_order", "dnb"))
    sales = sales.select("ID", "STREET", "CITY", "STATE", "ZIP5").unionByName(dnb.select(F.col("ID") + 10**9, "PHYS_STRT_AD", "PHYS_CTY", "PHYS_ST_ABRV", "PHYS_ZIP5").toDF("ID", "STREET", "CITY", "STATE", "ZIP5"))
    odd = [(-1, "1 A St", "Zz", "XX", ""), (-2, "1 A St", "Varnstea", "??", None), (-3, "1 A St", "qq", "VT", "05"), (-4, "1 A St", "x" * 3000, "VT", ""), (-5, None, None, None, None), (-6, "1 A St", "VT", "", "05144"), (-7, "1 A St", "Aldmere VT", "", "0514")]
    sales = sales.unionByName(spark.createDataFrame(odd, sales.schema))
    run = lambda: sorted(map(tuple, S.parsed(sales, zips, "ID", "STREET", "CITY", "STATE", "ZIP5").collect()))
    small = run()
    monkeypatch.setattr(S, "INDEX_ROWS", 2)
    assert run() == small


def test_additions_that_the_data_lacks_are_learnt(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        name = "".join(rng.choices("bcdfglmnprst", k=3)) + "a" + "".join(rng.choices("elnorst", k=4))
        for shown in (f"{i} {name} Expressway kindly ring bell", f"{i} {name} Expy", f"{i} {name} kindly ring bell", "Foundry Clerk"):
            rows.append((len(rows), shown, f"{i} {name} expw" if shown == "Foundry Clerk" else "Foundry Clerk", i))
    df = spark.createDataFrame(rows, "ID long, STREET string, EXTRA string, truth long").selectExpr("*", "'Wexley' CITY", "'AL' STATE", "'35193' ZIP5")
    lexicon = S.learn(df, "STREET", ("EXTRA",))
    assert {"kindly", "ring", "bell"} <= lexicon.tails and "foundry clerk" in lexicon.fillers
    parsed = S.parsed(df, spark.createDataFrame(ZIPS, "ZIP5 string, CITY string, STATE string"), "ID", "STREET", "CITY", "STATE", "ZIP5", None, ("EXTRA",), lexicon)
    got = {tuple(r) for r in S.pairs(S.locations(parsed)).collect()}
    want = {(a, b) for t in range(300) for a, b in itertools.combinations([4 * t, 4 * t + 1, 4 * t + 2, 4 * t + 3], 2)}
    assert got <= want and len(got) > 0.9 * len(want)


def test_alignment_of_words():
    agree = lambda a, b: S.align(a.split(), b.split()) <= S.ACCEPT
    assert agree("12 st johns avenue", "12 saint johns ave") and agree("12 mt oak road", "12 mount oak") and agree("12 moss reach lane", "12 mossraech lane") and agree("12 north main street", "12 main")
    assert not agree("12 main street", "12 main oak street") and not agree("12 main street", "12 mian avenue") and not agree("12 5th street", "12 6th street") and not agree("12 ash b street", "12 ash c street")
    assert agree("12 mian street/avenue", "12 main avenue")
