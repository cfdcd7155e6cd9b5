import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cairnfield import control
from cairnfield.functions import text
from cairnfield.operators import accounts, curate, geo, match, metrics, scopes
from cairnfield.sources import files, staging


def test_ranks_and_buckets_against_windows(spark):
    rows = [(i * 7919 % 1009, i) for i in range(1009)]
    df = spark.createDataFrame(rows, "k long, v long")
    assert [r.rank for r in scopes.ranked(df, ["k"]).orderBy("k").collect()] == list(range(1, 1010))
    for n in (1, 7, 1009, 2000):
        got = {r.k: r.bucket for r in scopes.bucketed(df, ["k"], n).collect()}
        want = {r.k: r.b for r in df.selectExpr("k", f"ntile({n}) over (order by k) - 1 as b").collect()}
        assert got == want
    assert scopes.bucketed(df.limit(0), ["k"], 3).count() == 0 and scopes.ranked(df.limit(0), ["k"]).count() == 0
    workers = files.number_workers(df, ["k"], 3, 100)
    assert {r.bucket for r in workers.collect()} == {0, 1, 2} and workers.groupBy("bucket", "chunk").count().where("count > 100").count() == 0


def test_groups_chunks_and_caps(spark):
    df = spark.createDataFrame([(f"k{i}", s) for i, s in enumerate([1, 5, 1500, 2000, 2500, 40000])] + [("n", None)], "k string, size long")
    groups = (scopes.Group("small", -1, 2), scopes.Group("medium", 1000, 2), scopes.Group("huge", 30000, 1))
    got = {r.k: (r.group, r.chunk) for r in scopes.in_groups(df, groups, ["k"]).collect()}
    assert got == {"k0": ("small", 0), "k1": ("small", 0), "k2": ("medium", 1), "k3": ("medium", 0), "k4": ("medium", 0), "k5": ("huge", 0)}
    assert {r.k for r in scopes.in_groups(df, groups, ["k"], 1).collect()} == {"k1", "k4", "k5"}
    assert [r.k for r in scopes.capped(df, ["k"], 2).collect()] == ["k0", "k1"] and scopes.capped(df, ["k"], None).count() == 7


def test_staging(spark):
    df = spark.createDataFrame([("a", "x", "1.5", "extra"), (None, "y", "oops", "extra")], "ID string, OPS_STREET string, LATITUDE string, OTHER string")
    rows = staging.conformed(df, staging.SOLDTO_LOCATION)
    assert rows.columns == [f.split()[0] for f in staging.SOLDTO_LOCATION.split(", ")] and [r.LATITUDE for r in rows.orderBy("OPS_STREET").collect()] == [1.5, None]
    assert staging.conformed(df, staging.LOCATION, True).where("ID is null").count() == 0
    with pytest.raises(KeyError), staging.staged(df, "upload", staging.LOCATION):
        assert spark.table("upload").count() == 2
        raise KeyError
    assert not spark.catalog.tableExists("upload")


def test_geocoding_asks_once_retries_and_gives_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, "1 A St", "X", "AA", "1"), (2, "1 a st", "X", "AA", "1"), (3, "2 B St", "X", "AA", "1"), (4, None, None, None, None)], "ID long, S string, C string, T string, Z string")
    keys = ["ops_street", "ops_city", "ops_state", "ops_zip5"]
    cache = spark.createDataFrame([("2 b st", "X", "AA", "1", 0.9, "rooftop", 1.0, 2.0, "2 B St")], "ops_street string, ops_city string, ops_state string, ops_zip5 string, accuracy double, type string, lat double, lon double, formatted_address string")
    mark = str(tmp_path / "asked")

    def provider(part: pd.DataFrame) -> pd.DataFrame:
        with open(mark, "a") as out:
            out.write("x" * len(part))
        if (part["ops_street"] == "").any():
            raise OSError("down")
        return pd.DataFrame({"accuracy": 1.0, "type": "place", "lat": 5.0, "lon": 6.0, "formatted_address": part["ops_street"]})

    got = {r.ID: r.lat for r in geo.geocode_rows(df, ["S", "C", "T", "Z"], cache, provider, keys).collect()}
    assert got == {1: 5.0, 2: 5.0, 3: 1.0, 4: None} or got == {1: None, 2: None, 3: 1.0, 4: None}  # with the failing one in a batch or apart
    found = geo.geocode(df.select(F.lower("S").alias("ops_street"), F.col("C").alias("ops_city"), F.col("T").alias("ops_state"), F.col("Z").alias("ops_zip5")), cache, lambda p: pd.DataFrame({"accuracy": 1.0, "type": "place", "lat": 5.0, "lon": 6.0, "formatted_address": p["ops_street"]}), keys)
    fresh = geo.new_cache_rows(found, cache, keys)
    assert {r.ops_street for r in fresh.collect()} == {"1 a st", ""}
    assert {r.lat for r in geo.geocode(df.select(*[F.lit("q").alias(k) for k in keys]), cache, lambda p: p.head(0), keys).collect()} == {None}


def test_text_of_addresses(spark):
    df = spark.createDataFrame([(" 12b Main St, Suite 4",), ("Main St",), ("12",), ("7 1/2 Elm Road #9",), (None,), ("",)], "s string")
    got = [(r.a.number, r.a.street) for r in df.select(text.number_street(F.col("s")).alias("a")).collect()]
    assert got == [("12b", "Main St"), (None, "Main St"), ("12", None), ("7 1/2", "Elm Road"), (None, None), (None, None)]
    assert df.select(text.address_line("s", "s").alias("x")).first().x == "12b Main St, Suite 4, 12b Main St, Suite 4"


def test_account_selection(spark):
    df = spark.createDataFrame([("a", "T")] * 3 + [("b", "T"), ("c", "U"), (None, "T")], "SOLD_ACCOUNT string, TRACK_CODE string")
    assert {tuple(r) for r in accounts.by_track_code(df, "T", 2).collect()} == {("a", 3, 1), ("b", 1, 0)}
    freq = spark.createDataFrame([("k", "x", 2), ("k", "y", 2), ("k", "z", 1)], "key string, domain string, n long")
    assert {r.domain for r in accounts.domain_modes(freq, "key").collect()} == {"x", "y"}
    rows = spark.createDataFrame([("k",), ("m",)], "key string")
    assert {tuple(r) for r in accounts.with_mode(rows, freq, "key").collect()} == {("k", "x"), ("m", None)}
    names = spark.createDataFrame([("1", "ACME DAIRY"), ("2", "ACME DIARY"), ("3", "ZOO")], "id string, name string")
    assert [r.id for r in accounts.ranked_names(names, "id", "name", "ACME DAIRY INC", 60).collect()] == ["1", "2"]


def test_overrides_order_and_types(spark):
    rows = [("12 Main Stret", 1.0, 2.0, "rooftop", "12 Main Street"), ("12 Main Street", 1.0, 2.0, "rooftop", "12 Main Street"), ("Other", 1.0, 2.0, "place", "12 Main Street"), ("9 Elm", None, 2.0, "rooftop", "9 Elm Road")]
    df = spark.createDataFrame(rows, "OPS_STREET string, LATITUDE double, LONGITUDE double, GEOCODE_LEVEL string, GEOCODED_STREET string")
    assert sorted(r.OPS_STREET for r in curate.override_street(df).collect()) == ["12 Main Street"] * 3 + ["9 Elm"]
    typed = curate.sanitised(spark.createDataFrame([("1.5", "x", 7)], "LATITUDE string, LONGITUDE string, ORGANIZATION_ID int"))
    assert tuple(typed.first()) == (1.5, None, "7")
    zips = spark.createDataFrame([("1", "Kent"), ("1", "Essex")], "ZIP5 string, COUNTY string")
    assert [r.COUNTY for r in curate.with_county(spark.createDataFrame([("1",), ("2",)], "ZIP5 string"), zips).orderBy("ZIP5").collect()] == ["Essex", None]
    counted = spark.createDataFrame([("A", "S", "C", "Z", "L"), ("A", "S", "C", "Z", "L"), ("B", "T", "C", "Z", ""), (None, None, None, None, None)], "ADDRESS string, STREET string, CITY string, ZIP5 string, SUBLOCATION_LVL1 string").withColumn("STATE", F.lit("S"))
    got = curate.presented(curate.counts(counted)).collect()
    assert [(r.ADDRESS, r.ADDRESS_cnt, r.ADDRESS_RAW_cnt) for r in got] == [("A", 2, 2), ("A", 2, 2), ("B", 1, 1), (None, 0, 0)]


def test_tuning(spark):
    words = {"dairy": "milk cheese butter cream", "steel": "iron forge plate beam"}
    rows = [(f"{k}{i}", f"{v.split()[i % 4]} {v.split()[(i + 1) % 4]}", k) for k, v in words.items() for i in range(10)]
    df = spark.createDataFrame(rows, "id string, t string, label string")
    both = match.joint_weights(df, "id", [("w", match.word_grams(F.col("t")), 0.7), ("c", match.char_grams(F.col("t")), 0.3)])
    norms = both.groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert all(abs(r.n - (0.49 + 0.09)) < 1e-9 for r in norms)
    scores = match.cross_validated(df, both, "id", "label", 3, 5)
    assert scores.count() == 5 and match.mean_score(scores) > 0.9
    assert all(r.n in (2, 3, 4, 5) for r in match.folds(df, "id", "label", 5).groupBy("fold").agg(F.count("*").alias("n")).collect())
    found = match.random_search({"k": [1, 2, 3]}, lambda s: -abs(s["k"] - 2), 20)
    assert found[0][1] == {"k": 2} and len(found) == 3


def test_votes_and_left_scores(spark):
    dim = spark.createDataFrame([(1, "b", "12 main street"), (2, "b", "12 main st"), (3, "b", "99 oak"), (4, "z", "12 main street"), (5, None, "x")], "ID long, block string, text string")
    ops = spark.createDataFrame([("m", "b", "12 main street"), ("o", "b", "99 oak road")], "ID string, block string, text string")
    got = {r.dim_id: r.ops_id for r in match.voted(dim, ops, F.col("text"), F.col("text"), ["block"], 1).collect()}
    assert got == {1: "m", 2: "m", 3: "o"}
    left = {r.dim_id: (r.ops_id, r.score > 0) for r in match.scored_left(dim, ops, F.col("text"), F.col("text"), ["block"]).collect()}
    assert left[1] == ("m", True) and left[4] == (None, False) and left[5] == (None, False) and len(left) == 5


def test_nearest_equals_all_pairs(spark):
    import random

    rng = random.Random(5)
    rows = [(i, rng.choice("pq"), " ".join(rng.choices(["oak", "elm", "road", "street", "north", "12", "77", "dock", "zed", "mill"], k=rng.randrange(1, 6)))) for i in range(120)]
    df = spark.createDataFrame(rows, "ID long, block string, text string")
    w = match.tfidf(df, "ID", match.char_grams(F.col("text")), ["block"]).cache()
    every = w.alias("a").join(w.alias("b"), ["block", "token"]).groupBy("block", F.col("a.id").alias("l"), F.col("b.id").alias("r")).agg(F.round(F.sum(F.col("a.weight") * F.col("b.weight")), 9).alias("s")).where("s > 0 and l <> r")
    want = {}
    for r in every.collect():
        want.setdefault(r.l, []).append((-r.s, r.r))
    got = {}
    for r in match.nearest(w, w, ["block"], 3, 0.0, False).collect():
        got.setdefault(r.left_id, []).append((-r.score, r.right_id))
    assert {k: sorted(v)[:3] for k, v in want.items()} == {k: sorted(v) for k, v in got.items()}


def test_control(spark):
    records = []
    assert control.timed(records.append, state="GA")(lambda: [1, 2])() == [1, 2] and records[0]["n_rows"] == 2 and records[0]["state"] == "GA"
    assert control.within(spark, 60, lambda: spark.range(3).count()) == 3
    slow = F.udf(lambda x: time.sleep(5) or x, "long")
    with pytest.raises(TimeoutError):
        control.within(spark, 1, lambda: spark.range(4).select(slow("id")).collect())
    dim = spark.createDataFrame([(1, "old"), (2, None)], "ID long, OPS_LOCATION_ID string")
    links = spark.createDataFrame([(2, "b", 0.5), (2, "a", 0.9)], "DIM_LOCATION_ID long, OPS_LOCATION_ID string, OPS_MATCH_SCORE double")
    done = control.committed({"d": dim}, {"d": links})["d"]
    assert {tuple(r) for r in done.collect()} == {(1, "old", None), (2, "a", 0.9)}
    back = control.reset_all({"d": dim, "l": links}, ["l"], {"d": ["OPS_LOCATION_ID"]})
    assert back["l"].count() == 0 and back["d"].where("OPS_LOCATION_ID is not null").count() == 0
    ops = spark.createDataFrame([("1", "n1", None, False), ("s", "old site", None, True)], "ID string, OPS_LOC_NAME string, MAIN_LOC_NAME string, IS_SITE boolean")
    sites = spark.createDataFrame([("t", "new site", True, ["1"])], "ID string, OPS_LOC_NAME string, IS_SITE boolean, children array<string>")
    assert {(r.ID, r.MAIN_LOC_NAME) for r in control.replaced_clusters(ops, sites).collect()} == {("1", "new site"), ("t", None)}


def test_metrics_are_appended(spark, tmp_path):
    df = spark.createDataFrame([(1,), (1,)], "k long")
    found = metrics.run_metrics({"t": df}, (metrics.Metric("c", "t", "count"), metrics.Metric("c", "t", "duplicates", "k")), "r")
    spark.sql(f"create database if not exists runs location '{tmp_path}/db'")
    for _ in range(2):
        metrics.append_metrics(found, "runs.metrics")
    assert spark.table("runs.metrics").count() == 4
    spark.sql("drop database runs cascade")
