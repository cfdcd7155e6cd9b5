import itertools
import random
from datetime import datetime as T

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cairnfield.llm import names as N
from cairnfield.llm import representatives as R

LISTED = [("O1", "Gorgidorf Water Authority"), ("O2", "Hulyadril Precision Tool Company"), ("O3", "Hulyadril Laboratories Corporation"), ("O4", "Patricia Prukuhult Plumbing"), ("O5", "Lawrence Prukuhult Plumbing"), ("O6", "University of Ystsolund"), ("O7", "Balirkov Valve and Fitting and Sons")]


def linked(spark, typed):
    left = spark.createDataFrame([(i, n, "x") for i, n in enumerate(typed)], "id long, name string, tokens string").select("id", "name")
    return {typed[r.typed_id]: r.listed_id for r in N.link(left, spark.createDataFrame(LISTED, "id string, name string")).collect()}


def test_typed_names(spark):
    want = {
        "GROGIDORF WATER AUTH #12": "O1", "hulyadril prec. tool": "O2", "Labs Corp., Hulyadrl": "O3", "PAT PRUKUHULT": "O4", "prukuhult, larry plumb.": "O5", "U OF YSTSOLUND": "O6", "BalirkovValve &amp; Fitting / 76": "O7",
        "Hulyadril": None, "P. Prukuhult": "O4", "Prukuhult Plumbing": None, "Hulyadril Dairy": None, "Susan Prukuhult Plumbing": None, "Zorbat Water Authority": None, "": None, "TBD": None, None: None, "-": None, "CASH SALE": None,
    }
    typed = list(want)
    got = linked(spark, [*typed, "GROGIDORF WATER AUTH #12"])
    assert got == {k: v for k, v in want.items() if v}


def test_empty_and_long_names(spark):
    assert linked(spark, [None, "x" * 50000]) == {}
    empty = spark.createDataFrame([], "id long, name string")
    assert N.link(empty, spark.createDataFrame(LISTED, "id string, name string")).count() == 0 and N.link(spark.createDataFrame([(1, "a b")], "id long, name string"), empty).count() == 0


def test_prefix_filter_loses_nothing(spark):
    rng = random.Random(4)
    words = sorted({"".join(rng.choices("abcd", k=rng.randrange(2, 8))) for _ in range(120)})
    df = spark.createDataFrame([(w,) for w in words], "token string")
    got = {tuple(r) for r in N.similar_tokens(df, df, 0.4).collect()}
    grams = {w: {f"^{w}$"[i : i + 2] for i in range(len(w) + 1)} for w in words}
    assert got == {(a, b) for a, b in itertools.product(words, words) if len(grams[a] & grams[b]) >= 0.4 * len(grams[a] | grams[b])}


ZIPS = [("31011", "Town", "GA")]
ROWS = [
    # id, group, street, zip, state, accuracy, level, updated, deleted
    ("a", 1, "12 Main Street", "31011", "GA", 0.9, "rooftop", T(2024, 1, 1), None),
    ("b", 1, "12 Main St", "31011", "GA", 0.9, "place", T(2024, 2, 1), None),
    ("c", 1, "2714", "3101", "GA", 85.0, "rooftop", T(2025, 1, 1), None),
    ("d", 1, "9 Oak Ave", "31011", "GA", 0.99, "rooftop", T(2025, 1, 1), T(2025, 2, 1)),
    ("e", 2, "255 N", "31011", "AL", float("nan"), "rooftop", None, None),
    ("f", 2, "PO Box 7", " 31011", "GA", None, None, None, None),
    ("f", 2, "PO Box 7", " 31011", "GA", None, None, None, None),
    ("g", 3, "1 Elm Road", "31011", "GA", 0.5, "rooftop", None, None),
    ("h", 4, "5th floor", None, None, -1.0, "rooftop", None, None),
    ("i", 4, None, "", "GA", None, "rooftop", None, None),
    ("j", None, "1 Elm Road", "31011", "GA", 0.5, "rooftop", None, None),
    ("k", None, "1 Elm Road", "31011", "GA", 0.5, "rooftop", None, None),
    ("m", 5, "87th Street", "31011", "GA", 1.0, "rooftop", None, None),
    ("l", 5, "544 87th Street", "31011", "GA", 1.0, "rooftop", None, None),
]
SCHEMA = "ID string, DUP_GROUP_ID long, OPS_STREET string, OPS_ZIP5 string, OPS_STATE string, GEOCODE_ACCURACY double, GEOCODE_LEVEL string, UPDATED_AT timestamp, DELETED_AT timestamp"


def records(spark, rows=ROWS):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("listed", F.lit("clash"))
    return R.live_records(df, spark.createDataFrame(ZIPS, "ZIP5 string, CITY string, STATE string"))


def test_survivors(spark):
    got = {(r.dup_group_id, r.field_name): r.record_id for r in R.survivors(records(spark)).collect()}
    assert got == {
        (1, "OPS_STREET"): "b", (1, "OPS_ZIP5"): "b", (1, "GEOCODE_ACCURACY"): "b", (2, "OPS_STREET"): "f", (5, "OPS_STREET"): "l", (5, "OPS_ZIP5"): "l", (5, "GEOCODE_ACCURACY"): "l",
    }
    assert R.survivors(records(spark, [])).count() == 0


def test_usable_streets(spark):
    good = ["12 Main", "12 Main St", "12a North Main", "PO Box 9", "p.o. box #9", "17050 Highway 31", "544 87th Street", "18 County Road 5", "9 Baylor Street"]
    bad = ["2714", "9 N", "8878 S.", "Suite 674", "#523", "5th floor", "(555) 555-0129", "555-0172", "Main Street", "PO Box", "N/A", "", "12 North East", "c/o purchasing dept", "12 Suite 4"]
    df = spark.createDataFrame([(s,) for s in good + bad + [None]], "s string")
    got = {r.s for r in df.where(R.usable_street(F.col("s"))).collect()}
    assert got == set(good)


def test_truths_keep_what_sources_agree_on(spark):
    out = {(r.dup_group_id, r.field_name, r.value): r for r in R.truths(records(spark)).collect()}
    assert out[1, "OPS_STREET", "12 MAIN STREET"].n_sources == 2 and out[1, "OPS_STREET", "12 MAIN STREET"].kept
    assert all(0 <= r.probability <= 1 for r in out.values()) and R.truths(records(spark, [])).count() == 0


def test_inferred_quality(spark, monkeypatch):
    rng = np.random.default_rng(1)
    patterns = []
    for _ in range(4000):  # source 'good' states true values mostly and false ones rarely, 'bad' the other way
        true = rng.random() < 0.5
        p = {"good": (0.95, 0.05), "fair": (0.8, 0.3), "bad": (0.5, 0.45)}
        entry = "\t".join(("+" if rng.random() < q[0 if true else 1] else "-") + s for s, q in sorted(p.items()))
        if "+" in entry:
            patterns.append(("F", entry))
    df = spark.createDataFrame(pd.DataFrame(patterns, columns=["field_name", "pattern"])).groupBy("field_name", "pattern").agg(F.count("*").alias("n"))
    quality, prior = R.infer(df)
    assert quality["F", "good"][0] > quality["F", "bad"][0] + 0.2 and quality["F", "good"][1] < quality["F", "bad"][1] - 0.1 and 0.3 < prior["F"] < 0.8
    monkeypatch.setattr(R, "PATTERNS", 1)
    again, _ = R.infer(df, 3)
    monkeypatch.setattr(R, "PATTERNS", 10**6)
    assert all(np.allclose(again[k], v) for k, v in R.infer(df, 3)[0].items())


def test_short_names_numbers_and_exact_names(spark):
    listed = [("A", "HP Inc"), ("B", "3M Company"), ("C", "BP"), ("D", "GE Aerospace"), ("E", "Studio 54 Dance"), ("F", "Torvald Textile LLC"), ("G", "Torvald Textile Holdings"), ("H", "Torvald Textile Mills"), ("I", "Margaret Ostrum Bakery"), ("J", "Ostrum Manufacturing")]
    typed = {"HP Inc": "A", "hp": "A", "3M Company": "B", "3m": "B", "BP": "C", "GE Aerospace": "D", "STUDIO 54 DANCE #7": "E", "Studio 55 Dance": None, "Torvald Textile LLC": "F", "Peggy Ostrum Bakery": "I", "OSTRUM MFG": "J", "X": None, "B": None}
    left = spark.createDataFrame(list(enumerate(typed)), "id long, name string")
    got = {list(typed)[r.typed_id]: r.listed_id for r in N.link(left, spark.createDataFrame(listed, "id string, name string")).collect()}
    assert got == {k: v for k, v in typed.items() if v}


def test_additions_are_learnt(spark):
    listed = [(f"L{i}", f"{n} {k}") for i, (n, k) in enumerate(itertools.product(("Brondavik", "Cestomar", "Dulvernia", "Ekorwick"), ("Cheese", "Optics")))]
    names = [(i, n.replace(" ", "x " if k % 2 else "y ")) for k, (i, n) in enumerate(listed)]  # every name's first word its own
    typed_rows = spark.createDataFrame([(k, f"{n} annex ketteringhall {k}") for k, (_, n) in enumerate(names)] + [(90, "Ketteringhall Optics"), (91, "Zarkonia Optics")], "id long, name string")
    got = {r.typed_id: r.listed_id for r in N.link(typed_rows, spark.createDataFrame(names, "id string, name string")).collect()}
    assert got == {k: i for k, (i, _) in enumerate(names)}
