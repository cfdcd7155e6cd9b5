import random

import pytest

from cairnfield.operators.components import components


def brute(edges):
    at = {}
    def top(x):
        while at.setdefault(x, x) != x:
            x = at[x]
        return x
    for a, b in edges:
        a, b = top(a), top(b)
        at[max(a, b)] = min(a, b)
    return {x: top(x) for x in at}


@pytest.mark.parametrize("bucket", [10**6, 9])
def test_random_graphs(spark, bucket):
    rng = random.Random(5)
    edges = [(f"v{rng.randrange(80):02}", f"v{rng.randrange(80):02}") for _ in range(55)] + [(f"w{i:02}", f"w{i + 1:02}") for i in range(25)]
    got = {r.vertex: r.component for r in components(spark.createDataFrame(edges, "a string, b string"), bucket_edges=bucket).collect()}
    assert got == brute(edges)


def test_numbers_nulls_and_nothing(spark):
    df = spark.createDataFrame([(5, 3), (3, 5), (7, 7), (None, 1)], "a long, b long")
    assert {(r.vertex, r.component) for r in components(df).collect()} == {(5, 3), (3, 3), (7, 7)}
    assert components(df.limit(0)).count() == 0
