import math
import random

import pytest
from pyspark.sql import functions as F

from cairnfield.functions import text as X
from cairnfield.functions.keys import key_form, name_form
from cairnfield.operators import accounts, bridge, dml, geo, match, metrics, scopes, stats_dict
from cairnfield.run_id import RunId


def rows_of(df):
    return {tuple(r) for r in df.collect()}


def test_keys(spark):
    df = spark.createDataFrame([(s,) for s in (" {0A0B0C0D-0000-4000-8000-00000000000A} ", "0a0b0c0d0000400080000000 0000000a".replace(" ", ""), "007", "7.0", "7.5", "", "  ", None, "A b ")], "s string")
    got = [r[0] for r in df.select(key_form(F.col("s"))).collect()]
    assert got == ["0a0b0c0d00004000800000000000000a", "0a0b0c0d0000400080000000" + "0000000a", "7", "7", "7.5", None, None, None, "ab"]
    assert [r[0] for r in df.select(name_form(F.lit(" A   b ")).alias("n")).limit(1).collect()] == ["a b"]


def test_insert_new_treats_nulls_as_equal(spark):
    old = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    new = spark.createDataFrame([(1, None, "x"), (3, None, "x"), (3, None, "y"), (2, "c", "x")], "a int, b string, extra string")
    assert rows_of(dml.insert_new(old, new, ["a", "b"])) == {(3, None), (2, "c")} and dml.insert_new(old, new.limit(0), ["a", "b"]).count() == 0


def test_changes(spark):
    df = spark.createDataFrame([(1, "x", True), (2, "y", None), (3, None, False)], "id int, v string, site boolean")
    assert rows_of(dml.delete(df, F.col("site"))) == {(2, "y", None), (3, None, False)}
    assert rows_of(dml.reset(df, ["v"])) == {(1, None, True), (2, None, None), (3, None, False)}
    assert rows_of(dml.reset(df, ["v"], F.col("site"))) == {(1, None, True), (2, "y", None), (3, None, False)}
    assert rows_of(dml.reset_in(df, "v", "id", spark.createDataFrame([(2,), (2,), (None,)], "k int"))) == {(1, "x", True), (2, None, None), (3, None, False)}
    assert rows_of(dml.merge(df, spark.createDataFrame([(1, None), (9, "n")], "id int, w string"), "id", {"v": "w"})) == {(1, None, True), (2, "y", None), (3, None, False)}
    parents = spark.createDataFrame([("P", [1, 3]), ("O", [1])], "name string, kids array<int>")
    assert rows_of(dml.merge_children(df, parents, "id", "kids", "name", "v")) == {(1, "O", True), (2, "y", None), (3, "P", False)}
    assert dml.truncate(df).count() == 0 and dml.apply(df, [dml.truncate, lambda d: dml.reset(d, ["v"])]).columns == df.columns


def test_scopes(spark):
    df = spark.createDataFrame([("a", "1", 1), ("a", "1", 1), ("a", "1", 2), ("b", "1", 3), ("b", None, 4)], "k string, s string, id int")
    sizes = scopes.sizes(df, ["k", "s"], "id")
    assert rows_of(sizes) == {("a", "1", 2), ("b", "1", 1)} and rows_of(scopes.sizes(df, ["k", "s"], None, 2, 9)) == {("a", "1", 3)}
    other = spark.createDataFrame([("a", "1", 5), ("c", "1", 7)], "k string, s string, size long")
    assert rows_of(scopes.match_sizes(sizes, other, ["k", "s"])) == {("a", "1", 10), ("b", "1", 0), ("c", "1", 0)}
    assert {r.id for r in scopes.in_scopes(df, other, ["k", "s"]).collect()} == {1, 2}
    assert {(r.k, r.group) for r in scopes.grouped(sizes, (1, 5), ("small", "large")).collect()} == {("a", "small")}
    seven = spark.range(7).select(F.col("id").alias("k"))
    assert [r.bucket for r in scopes.bucketed(seven, ["k"], 3).orderBy("k").collect()] == [0, 0, 0, 1, 1, 2, 2]
    assert [r.k for r in scopes.shuffled(seven, 1, "k").collect()] == [r.k for r in scopes.shuffled(seven, 1, "k").collect()]
    dim = spark.createDataFrame([("x", " 12345", None), ("x", "12399", "o")], "ORGANIZATION_ID string, ZIP5 string, OPS_LOCATION_ID string")
    assert [r.ZIP3 for r in scopes.SPECS["soldto"].dim_rows(dim, True).collect()] == ["123"]


def test_bridge_and_metrics(spark):
    df = spark.createDataFrame([("1", "S", "S"), ("2", "x", "S"), ("2", "x", "S"), ("4", "b", "T"), ("3", "a", "T"), ("5", "c", None), ("6", None, " ")], "id string, name string, main string")
    got = {(r[0], r[1], r[2]) for r in bridge.bridge(df, "id", "name", "main").collect()}
    assert got == {("1", "1", 0), ("2", "2", 0), ("1", "2", 1), ("3", "3", 0), ("4", "4", 0), ("3", "4", 1), ("5", "5", 0), ("6", "6", 0)}
    m = [metrics.Metric("c", "t", "count"), metrics.Metric("c", "t", "duplicates", "id"), metrics.Metric("c", "t", "missing", "main", "p", "k")]
    out = {(r.metric, r.result, r.run_id) for r in metrics.run_metrics({"t": df, "p": spark.createDataFrame([("S",)], "k string")}, m, "r").collect()}
    assert out == {("count", 7, "r"), ("duplicates", 1, "r"), ("missing", 3, "r")}


def test_texts(spark):
    df = spark.createDataFrame([("o'fallon ST. mary-ann", None, "", "(-71.5, 42.25)"), (None, "b", "c", "none")], "a string, b string, c string, d string")
    got = df.select(X.title_case(F.col("a")), X.joined("a", "b", "c"), X.coordinates(F.col("d")), X.content_id("a", "b")).collect()
    assert got[0][0] == "O'Fallon St. Mary-Ann" and got[0][1] == "o'fallon ST. mary-ann" and got[1][1] == "b c" and tuple(got[0][2]) == (42.25, -71.5) and tuple(got[1][2]) == (0.0, 0.0) and len(got[0][3]) == 64
    v = spark.createDataFrame([(0.0,), (1.0,), (9.9,), (10.0,), (None,)], "v double")
    assert [r[0] for r in v.select(X.equal_width_bin(F.col("v"), 0, 10, 10)).collect()] == [0, 1, 9, 9, None]
    assert [r[0] for r in v.select(X.edge_bin(F.col("v"), (0, 5), ("l", "h"))).collect()] == [None, "l", "h", "h", None]
    f = spark.createDataFrame([("Hi there, hi! :) *",), ("",)], "t string")
    row = f.select(*[c.alias(k) for k, c in X.features(F.col("t")).items()]).collect()
    assert (row[0].n_words, row[0].n_unique, row[0].n_capitals, row[0].n_exclamations, row[0].n_smileys, row[1].n_words, row[1].mean_word) == (5, 5, 1, 1, 1, 0, 0.0)


def test_ratios(spark):
    def slow(a, b):
        d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                d[i + 1][j + 1] = d[i][j] + 1 if x == y else max(d[i][j + 1], d[i + 1][j])
        return d[-1][-1]

    rng = random.Random(3)
    for _ in range(500):
        a, b = ("".join(rng.choices("abcd", k=rng.randrange(12))) for _ in range(2))
        assert X.longest_common(a, b) == slow(a, b)
    assert X.ratio_of("", "") == 100 and X.ratio_of("abcd", "abcx") == 75 and X.token_set_ratio_of("new york mets", "mets york new mets") == 100
    df = spark.createDataFrame([("a", "a"), (None, "a")], "a string, b string")
    assert [tuple(r) for r in df.select(X.ratio("a", "b"), X.token_set_ratio("a", "b")).collect()] == [(100, 100), (None, None)]


def test_account_samples_and_modes(spark):
    df = spark.createDataFrame([(i, float(i), "a/b" if i % 2 else "c") for i in range(40)], "id int, v double, n string")
    out = accounts.sample_bins(df, "v", "n", 4, 3, 1, "id").collect()
    assert len(out) == 4 * 2 * 3 and all(r.bin == min(3, int(r.v / 39 * 4)) for r in out) and {tuple(r) for r in out} == {tuple(r) for r in accounts.sample_bins(df, "v", "n", 4, 3, 1, "id").collect()}
    freq = accounts.domain_frequency(spark.createDataFrame([("k", "a"), ("k", "b"), ("k", "b"), ("k", "a"), ("j", "x"), ("j", None), ("j", "y")], "k string, d string"), "k", F.col("d"), ["y"])
    assert rows_of(freq) == {("k", "a", 2), ("k", "b", 2), ("j", "x", 1)} and rows_of(accounts.domain_mode(freq, "k")) == {("k", "a", 2), ("j", "x", 1)}
    lines = spark.createDataFrame([("k", 1, 0.005), ("k", 1, 1.0), ("k", 2, 2.0), ("j", 3, 0.1)], "k string, o int, v double")
    assert rows_of(accounts.revenue(lines, ["k"], "o", "v", 1.0)) == {("k", 2, 3.01, 1.51)}


def metres(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * geo.EARTH_M * math.asin(math.sqrt(min(1, h)))


@pytest.mark.parametrize("place", [(0, 0), (45.3, -93.2), (-60, 179.9999), (89.9995, 20), (71, -180)])
def test_clusters_against_brute_force(spark, place):
    rng = random.Random(str(place))
    points = []
    for i in range(70):
        lat = max(-90.0, min(90.0, place[0] + rng.uniform(-0.004, 0.004)))
        lon = (place[1] + rng.uniform(-0.004, 0.004) / max(0.01, math.cos(math.radians(lat))) + 180) % 360 - 180
        points.append((f"p{i:02}", "g" if i % 4 else "h", lat, lon))
    points += [("n1", "g", None, 1.0), ("n2", "g", float("nan"), 1.0), ("n3", None, *points[0][2:]), points[0]]
    parent = {}
    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    linked = set()
    for a in points[:70]:
        for b in points[:70]:
            if a[0] < b[0] and a[1] == b[1] and metres(a[2:], b[2:]) < 100:
                linked |= {a[0], b[0]}
                x, y = sorted((top(a[0]), top(b[0])))
                parent[y] = x
    got = {r.id: r.cluster for r in geo.clusters(spark.createDataFrame(points, "ID string, ORG string, LATITUDE double, LONGITUDE double"), "ID", "ORG").collect()}
    assert got == {x: top(x) for x in linked}


def test_sites(spark):
    rows = [("1", "N", "O", "1 A St", "C", "S", "Z", 44.0, -72.0, False), ("2", "N", "O", "2 B St", "C", "S", "Z", 44.0002, -72.0, False), ("3", "N", "O", "9 Z St", "C", "S", "Z", 44.5, -72.0, False), ("4", "N", "Q", "1 A St", "C", "S", "Z", 44.0, -72.0, False), ("5", "N", "O", "1 A St", "C", "S", "Z", 44.0, -72.0, None)]
    df = spark.createDataFrame(rows, "ID string, ORGANIZATION_NAME string, ORGANIZATION_ID string, OPS_STREET string, OPS_CITY string, OPS_STATE string, OPS_ZIP5 string, LATITUDE double, LONGITUDE double, IS_RESIDENTIAL boolean")
    out = geo.sites(df).collect()
    assert len(out) == 1 and out[0].children == ["1", "2"] and out[0].IS_SITE and not out[0].IS_ADDRESS and not out[0].IS_BUILDING and abs(out[0].LATITUDE - 44.0001) < 1e-9


def test_geocodes_and_flags(spark):
    import pandas as pd

    keys = "ops_street string, ops_city string, ops_state string, ops_zip5 string, organization_name string"
    asked = spark.createDataFrame([("a", "c", "s", "z", "o"), ("a", "c", "s", "z", "o"), ("b", "c", "s", "z", None), ("e", "c", "s", "z", "o")], keys)
    cache = spark.createDataFrame([("a", "c", "s", "z", "o", 0.5, "t", 1.0, 2.0, "x"), ("a", "c", "s", "z", "o", 0.9, "t", 3.0, 4.0, "x"), ("b", "c", "s", "z", None, 0.9, "t", 3.0, 4.0, None)], f"{keys}, accuracy double, type string, lat double, lon double, formatted_address string")
    assert {(r.ops_street, r.lat) for r in geo.geocode(asked, cache).collect()} == {("a", 3.0), ("b", None), ("e", None)}
    provider = lambda pdf: pd.DataFrame({"accuracy": 1.0, "type": "p", "lat": 7.0, "lon": 8.0, "formatted_address": pdf["ops_street"]})
    assert {(r.ops_street, r.lat) for r in geo.geocode(asked, cache, provider, batch=1).collect()} == {("a", 3.0), ("b", 7.0), ("e", 7.0)}
    look = spark.createDataFrame([("a", "R", None), ("b", None, "Residential"), ("c", None, None), ("d", "B", "Business")], "k string, svs_rdi string, ups_rdi string")
    df = spark.createDataFrame([(x,) for x in "abcde"], "k string")
    assert {r.k for r in geo.residential(df, look, ["k"]).where("IS_RESIDENTIAL").collect()} == {"a", "b"}


DIM = [(0, "123 main street", "murfreesboro", "tn", "37130", "acme dock"), (1, "123main st", "murfreesboro", "tn", "37130", "acme"), (2, "77 polaris pkwy", "columbus", "oh", "43081", ""), (3, "77 Polaris Parkwy", "columbus", "oh", "43018", "x"), (4, "9 railroad ave bldg 1", "antioch", "ca", "94509", ""), (5, "", "", "", "", "")]
OPS = [("1", "123 Main Street", "Murfreesboro", "TN", "37130", None), ("2", "77 Polaris Parkway", "Columbus", "OH", "43081", ""), ("3", "9 Railroad Avenue", "Antioch", "CA", "94509", "Building 1")]


def test_association(spark):
    from cairnfield.operators.address import marker

    dim = spark.createDataFrame([(*r, "B") for r in DIM], "ID int, STREET string, CITY string, STATE string, ZIP5 string, ATTENTION string, block string")
    ops = spark.createDataFrame([(*r, "B") for r in OPS], "ID string, OPS_STREET string, OPS_CITY string, OPS_STATE string, OPS_ZIP5 string, OPS_SUBLOCATION string, block string")
    dim_text, ops_text = X.joined("STREET", "CITY", "STATE", "ZIP5"), X.location_string("ops")
    ranked = match.rank(dim, ops, dim_text, ops_text, ["block"])
    assert {(r.left_id, r.right_id) for r in ranked.collect()} == {(0, "1"), (1, "1"), (2, "2"), (3, "2"), (4, "3")}
    assert {(r.right_id, r.left_id) for r in match.rank(dim, ops, dim_text, ops_text, per_ops=True).collect()} == {("1", 0), ("2", 3), ("3", 4)}  # parkwy is nearer to Parkway than pkwy
    assert match.rank(dim.withColumn("block", F.lit("other")), ops, dim_text, ops_text, ["block"]).count() == 0
    sure = match.training_pairs(ranked, 0.5)
    votes = match.neighbour_votes(sure.select(F.col("ID").alias("id"), F.col("ID_y").alias("label")), match.tfidf(dim, "ID", match.char_grams(dim_text)), 3)
    assert {(r.id, r.label) for r in votes.collect()} == {(0, "1"), (1, "1"), (2, "2"), (3, "2"), (4, "3")}
    marks = match.marked(dim, ops.withColumn("m", marker(F.col("OPS_SUBLOCATION"))), "STREET", "m", ["block"])
    assert rows_of(marks) == {(4, "3")}
    f1 = match.weighted_f1(spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b")], "t string, p string"), "t", "p").first()
    assert abs(f1.f1 - (2 * (2 / 3) + 1 * (2 / 3)) / 3) < 1e-12 and f1.n == 3
    assert match.rank(dim.limit(0), ops, dim_text, ops_text).count() == 0


def test_statistics_follow_chains_and_leave_cycles(spark):
    rules = spark.createDataFrame([("s", "a", "b"), ("s", "b", "c d"), ("s", "x", "y"), ("s", "y", "x"), ("t", "a", "z")], "scope string, key string, address string")
    assert rows_of(stats_dict.resolved(rules)) == {("s", "a", "c d"), ("s", "b", "c d"), ("t", "a", "z")}
    df = spark.createDataFrame([("9 Elm Street", "1"), ("9 Elm Street", "1"), ("Elm Street", "1"), ("Elm Street", "2"), (None, "1"), ("", "1")], "a string, k string")
    assert sorted(map(str, rows_of(stats_dict.repaired(df, "a", ["Street"], ["k"])))) == sorted(map(str, {("9 Elm Street", "1"), ("Elm Street", "2"), (None, "1"), ("", "1")}))


@pytest.mark.parametrize(("text", "generate", "want"), [("prod", True, ("9", None, "prod")), ("5_prod", True, ("5", "9", "prod")), ("5_6_prod", True, ("5", "6", "prod")), ("", True, ("9", None, None)), (None, True, ("9", None, None)), ("5_prod", False, ("5", None, "prod")), (" ___5_prod_ ", True, ("5", "9", "prod"))])
def test_run_ids(text, generate, want):
    run = RunId.parse(text, generate, lambda: "9")
    assert (run.initial, run.incremental, run.suffix) == want
    assert run.schema_suffix == "_" + "_".join(filter(None, (want[0], want[2]))) and run.name == "_".join(filter(None, want))


@pytest.mark.parametrize("text", ["prod", "", "5_6_p!@#rod", "1!@#6_7_prod", "5_1!@#6_prod", "5_6_7_prod", "5_a_b", "a_5_b", "a_b_c"])
def test_wrong_run_ids(text):
    with pytest.raises(ValueError):
        RunId.parse(text, False)
