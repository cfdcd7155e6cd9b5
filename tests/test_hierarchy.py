import random

import pytest

from cairnfield.operators import hierarchy as H


def brute(parent):
    """Root and depth of every node of a dictionary node -> parent or None."""
    out = {}
    for n in parent:
        seen, at, d = [n], n, 0
        while parent.get(at) is not None:
            at, d = parent[at], d + 1
            if at in seen:
                out[n] = ("cycle", -1 if at == n else -2)
                break
            seen.append(at)
        else:
            out[n] = (at, d)
    return out


def links(spark, parent):
    return spark.createDataFrame([(k, v) for k, v in parent.items()], "id string, parent string")


@pytest.mark.parametrize("bucket", [10**6, 7])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_forests_with_cycles(spark, bucket, seed):
    rng = random.Random(seed)
    ids = [f"n{i}" for i in range(60)]
    parent = {x: rng.choice([None, *ids[max(0, i - 6) : i], *([rng.choice(ids)] if rng.random() < 0.1 else [])]) for i, x in enumerate(ids)}
    got = {r.id: (r.root_id, r.depth) for r in H.resolve(links(spark, parent), bucket).collect()}
    assert got == brute(parent)


@pytest.mark.parametrize("bucket", [10**6, 5])
def test_long_chain_and_long_cycle(spark, bucket):
    parent = {f"c{i}": f"c{i + 1}" for i in range(30)} | {"c30": None} | {f"r{i}": f"r{(i + 1) % 12}" for i in range(12)} | {"in": "r3", "self": "self", "to_self": "self"}
    got = {r.id: (r.root_id, r.depth) for r in H.resolve(links(spark, parent), bucket).collect()}
    assert got == brute(parent)
    assert got["c0"] == ("c30", 30) and got["in"] == ("cycle", -2) and got["self"] == ("cycle", -1)


def test_paths_and_descendants(spark):
    parent = {"a": None, "b": "a", "c": "b", "d": "c", "e": "b", "x": "y", "y": "x"}
    rows = {r.id: r.path for r in H.paths(links(spark, parent)).collect()}
    assert rows == {"a": ["a"], "b": ["a", "b"], "c": ["a", "b", "c"], "d": ["a", "b", "c", "d"], "e": ["a", "b", "e"]}
    below = {(r.ancestor_id, r.descendant_id, r.levels) for r in H.descendants(H.paths(links(spark, parent))).collect()}
    assert below == {("a", "b", 1), ("a", "c", 2), ("a", "d", 3), ("a", "e", 2), ("b", "c", 1), ("b", "d", 2), ("b", "e", 1), ("c", "d", 1)}


def test_links_by_name_with_odd_rows(spark):
    rows = [("1", "Top  One ", None, 0), ("2", "mid", " TOP one", 0), ("2", "mid", " TOP one", 0), ("3", None, "MID", 1), ("4", "x", "unknown", 2), ("5", "y", "  ", 3), (None, "z", "mid", 4), ("6", "", "", 5), ("7", "self", "Self", 6)]
    df = spark.createDataFrame(rows, "ID string, NAME string, MAIN string, name_extra int").withColumnRenamed("name_extra", "parent")
    got = {r.id: (r.root_id, r.depth) for r in H.resolve(H.links_by_name(df, "ID", "NAME", "MAIN")).collect()}
    assert got == {"2": ("1", 1), "3": ("1", 2), "4": ("4", 0), "7": ("cycle", -1)}


def test_empty(spark):
    empty = spark.createDataFrame([], "id string, parent string")
    assert H.resolve(empty).count() == 0 and H.paths(empty).count() == 0 and H.on_cycles(empty).count() == 0
