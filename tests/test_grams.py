"""The nearest texts equal brute force, whatever the pieces, and their pairs never reach the disk."""

import math
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cairnfield.operators import grams as G
from cairnfield.operators import match

WORDS = ["Oak", "Elm", "Ash", "Großer", "Hof", "Road", "Rd", "Street", "STREET", "1", "22", "333", "北大街", ""]


def texts(n, seed, of=lambda i: i):
    draw = random.Random(seed)
    return [(of(i), draw.choice("AB"), " ".join(draw.choices(WORDS, k=draw.randint(1, 4)))) for i in range(n)]


def cells(t):
    low = t.lower()
    return [low[i : i + 3] for i in range(len(low) - 2)]


def expected(left, right, vocabulary, k, threshold=0.0):
    """{left id: [(score, right id)]}, the best k over the blocks."""
    idf, ids = defaultdict(set), {i for i, _, _ in vocabulary}
    for i, _, t in vocabulary:
        for c in cells(t):
            idf[c].add(i)

    def vectors(rows):
        out = defaultdict(Counter)
        for i, b, t in rows:
            out[b, i].update(c for c in cells(t) if c in idf)
        w = {key: {c: n * (math.log((1 + len(ids)) / (1 + len(idf[c]))) + 1) for c, n in x.items()} for key, x in out.items() if x}
        return {key: {c: v / math.sqrt(sum(z * z for z in x.values())) for c, v in x.items()} for key, x in w.items()}

    found, r = defaultdict(list), vectors(right)
    for (b, i), x in vectors(left).items():
        for (c, j), y in r.items():
            s = round(sum(v * y.get(g, 0) for g, v in sorted(x.items())), 9)
            if b == c and s > 0 and s >= threshold:
                found[i].append((-s, j))
    return {i: [(pytest.approx(-s, abs=2e-9), j) for s, j in sorted(x)[:k]] for i, x in found.items()}


def by_left(rows):
    out = defaultdict(list)
    for i, j, s in sorted(rows, key=lambda r: (str(r[0]), -r[2], r[1])):
        out[i].append((s, j))
    return dict(out)


@pytest.mark.parametrize(("k", "threshold", "block", "pieces"), [(1, 0.0, ["block"], (4096, 32768)), (3, 0.3, ["block"], (7, 5)), (2, 0.0, [], (30, 11))])
def test_nearest_equals_brute_force_in_any_pieces(spark, monkeypatch, k, threshold, block, pieces):
    monkeypatch.setattr(G, "LEFT_ROWS", pieces[0])
    monkeypatch.setattr(G, "RIGHT_ROWS", pieces[1])
    monkeypatch.setattr(G, "BUCKET_ROWS", 40)
    left = texts(60, 1) + [(3, "A", "Oak Road 22"), (3, "A", "Elm Street 1"), (7, "B", "x"), (8, "C", "Oak")]
    right = texts(50, 2, lambda i: f"r{i:02d}") + [("r01", "B", "Ash Hof"), ("r77", "D", "Oak")]
    frame = lambda rows, kind: spark.createDataFrame([*rows, (None, "A", "Oak"), (rows[0][0], None, "Oak")], f"id {kind}, block string, text string")
    x, y = frame(left, "int"), frame(right, "string")
    words = G.vocabulary(x, "id", F.col("text"))
    got = G.nearest(G.rows(x, "id", F.col("text"), block), G.rows(y, "id", F.col("text"), block), words, block, k, threshold).collect()
    if not block:
        left, right = ([(i, "", t) for i, _, t in rows] + [(rows[0][0], "", "Oak")] for rows in (left, right))
    assert by_left((r.left_id, r.right_id, r.score) for r in got) == expected(left, right, [*left, (left[0][0], "A", "Oak")], k, threshold)


@pytest.mark.parametrize(("work", "matrix", "posting", "k"), [(100, 50, 3, 1), (37, 1, 10**9, 3), (10**6, 10**9, 1, 2), (1, 1, 20, 4)])
def test_sums_by_matrix_and_lists_agree(monkeypatch, work, matrix, posting, k):
    for name, value in (("WORK", work), ("MATRIX", matrix), ("POSTING", posting)):
        monkeypatch.setattr(G, name, value)
    left, right = texts(80, 3), texts(70, 4)
    tokens = sorted({c for _, _, t in left for c in cells(t)})
    df = Counter(c for _, _, t in left for c in set(cells(t)))
    code = {c: ord(c[0]) << 42 | ord(c[1]) << 21 | ord(c[2]) for c in tokens}
    rows = [(b, True, i, None, t.lower()) for i, b, t in left] + [(b, False, None, i, t.lower()) for i, b, t in right]
    table = pa.table({"no": [ord(r[0]) for r in rows], "p": [0] * len(rows), "q": [0] * len(rows), "is_left": [r[1] for r in rows], "left_id": pa.array([r[2] for r in rows], pa.int64()), "right_id": pa.array([r[3] for r in rows], pa.int64()), "text": [r[4] for r in rows]})
    known = pa.table({"token": [code[c] for c in tokens], "idf": [math.log((1 + len(left)) / (1 + df[c])) + 1 for c in tokens]})
    got = G.best(table, known, k, 0.0, 3).to_pylist()
    assert by_left((r["left_id"], r["right_id"], r["score"]) for r in got) == expected(left, right, left, k)


@pytest.mark.parametrize(("pieces", "products"), [((7, 5), 50), ((1, 1000), 300), ((1000, 3), 10**9)])
def test_blocks_of_several_buckets_equal_brute_force(spark, monkeypatch, pieces, products):
    for name, value in (("LEFT_ROWS", pieces[0]), ("RIGHT_ROWS", pieces[1]), ("PIECE_ROWS", 9), ("PIECE_PRODUCTS", products), ("BUCKET_ROWS", 10)):
        monkeypatch.setattr(G, name, value)
    left, right = texts(40, 7) + [(3, "A", "Oak Road 22"), (40, "C", "Oak")], texts(50, 8) + [(1, "B", "Ash Hof"), (5, "C", "Oak"), (4, "C", "Oak")]
    x, y = (spark.createDataFrame(rows, "id int, block string, text string") for rows in (left, right))
    words = G.vocabulary(x, "id", F.col("text"))
    got = G.nearest(G.rows(x, "id", F.col("text"), ["block"]), G.rows(y, "id", F.col("text"), ["block"]), words, ["block"], 2, 0.2).collect()
    assert by_left((r.left_id, r.right_id, r.score) for r in got) == expected(left, right, left, 2, 0.2)


def written(spark):
    """Bytes of shuffle files that the session has written."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30000)
    return spark.sparkContext._jsc.sc().statusStore().executorList(True).head().totalShuffleWrite()


@pytest.fixture
def one_block(spark):
    """Six hundred rows a side in one block: their pairs took megabytes of shuffle files."""
    draw = random.Random(5)
    some = [f"{draw.randint(1, 9999)} {draw.choice(WORDS)}{draw.choice(WORDS)} {draw.choice(WORDS)} Springfield IL 627{draw.randint(10, 99)}" for _ in range(600)]
    return [spark.createDataFrame([(i, "A", t) for i, t in enumerate(ts)], "ID int, block string, text string") for ts in (some, some[::-1])]


def test_pairs_of_a_block_are_not_shuffled(spark, one_block):
    before = written(spark)
    assert match.rank(*one_block, F.col("text"), F.col("text"), ["block"]).where("score < 0.999999").count() == 0
    assert written(spark) - before < 500_000


def test_pairs_are_not_shuffled_for_canonical_rows(spark, one_block):
    before = written(spark)
    assert match.rank(*one_block, F.col("text"), F.col("text"), ["block"], per_ops=True).where("score > 0.999999").count() == 600
    assert written(spark) - before < 500_000


def test_votes_of_a_block_are_not_shuffled(spark, one_block):
    before = written(spark)
    assert match.voted(*one_block, F.col("text"), F.col("text"), ["block"]).where("votes > 0.999999").count() == 600
    assert written(spark) - before < 1_000_000


def test_rows_of_a_block_move_once(spark, monkeypatch, one_block):
    """However few rows are held against each other at a time: each row went as often as the other side has such parts."""
    monkeypatch.setattr(G, "LEFT_ROWS", 10)
    monkeypatch.setattr(G, "RIGHT_ROWS", 10)
    before = written(spark)
    assert match.rank(*one_block, F.col("text"), F.col("text"), ["block"], per_ops=True).where("score > 0.999999").count() == 600
    assert written(spark) - before < 500_000
