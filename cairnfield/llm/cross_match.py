"""Matching entities across sources without keys: addresses of one source to the same address in another, each pair with
a confidence.

The q-grams of every attribute (street name, direction, suffix, zip) are encoded as fixed bit vectors. Close pairs of names
are found exactly by multi-index Hamming hashing. The vectors are sparse, so a radius is counted against what a vector
holds: a pair is close if fewer bits differ than the fuller of the two vectors has blocks with a bit in them. Then at least
one of those blocks is equal, so only blocks that hold a bit are joined, together with house number and city, which have to
agree; empty blocks bring nothing together. The pairs met get a Dice score of each field that both sides state; a logistic
model weighs the fields' scores into a confidence. It is fitted on two thirds of a bounded sample of records of both sources
that do carry a key (`SAMPLE_ROWS` a source, the lowest hashes), the last third serves to measure the calibration; all else
covers all rows. A record's confidence is shared out among the addresses that compete for it.

Cases: records without a house number (or box number), name or city match nothing. Nulls and blanks are missing parts.
Records that repeat give one row per pair. A tie between two addresses leaves both below one half. Empty tables give no
rows; without a usable sample fixed weights serve. Other columns play no part.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnfield.session import cut

BITS, FIELD_BITS, BLOCK_BITS, Q = 256, 64, 8, 2
#: Records with a key that the confidence is fitted and measured on, at most, of each source.
SAMPLE_ROWS = 20_000
#: Steps to which scores are rounded for the fit, so that a sample of any size is a bounded number of patterns.
STEPS = 32
#: Weights without a sample: constant, Dice of the name, differing parts of direction, suffix and zip, and the first two missing on one side.
DEFAULT_WEIGHTS = (-9.0, 16.0, -14.0, -14.0, -1.0, -0.7, -0.7)
FEATURES = ("dice", "direction_apart", "suffix_apart", "zip_apart", "direction_missing", "suffix_missing")


def vector(name: str, bits: int = BITS) -> np.ndarray:
    """The bit vector of a text's q-grams, as 64-bit words."""
    padded = f"^{name}$"
    words = [0] * (bits // 64)
    for i in range(len(padded) - Q + 1):
        bit = zlib.crc32(padded[i : i + Q].encode()) % bits
        words[bit // 64] |= 1 << bit % 64
    return np.array(words, np.uint64).view(np.int64)


def encoding(c: Column, bits: int = BITS) -> Column:
    """`vector` as a Column: an array of 64-bit words."""
    padded = F.concat(F.lit("^"), c, F.lit("$"))
    places = F.transform(F.sequence(F.lit(1), F.length(padded) - Q + 1), lambda i: (F.crc32(F.encode(padded.substr(i, F.lit(Q)), "UTF-8")) % bits).cast("int"))
    # the places are made once and then looked through for each word
    return F.transform(F.array(F.struct(places.alias("p"))), lambda x: F.array(*[_word(x["p"], k) for k in range(bits // 64)]))[0]


def _word(places: Column, k: int) -> Column:
    held = F.filter(places, lambda b: (b >= 64 * k) & (b < 64 * k + 64))
    return F.aggregate(held, F.lit(0).cast("bigint"), lambda s, b: s.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), b - 64 * k)))


def full_blocks(v: Column) -> Column:
    """(block, bits) of the blocks of a vector that hold a bit."""
    per = 64 // BLOCK_BITS
    every = [F.struct(F.lit(k).alias("block"), F.call_function("shiftrightunsigned", v[k // per], F.lit(k % per * BLOCK_BITS)).bitwiseAND(F.lit(2**BLOCK_BITS - 1)).cast("int").alias("bits")) for k in range(BITS // BLOCK_BITS)]
    return F.filter(F.array(*every), lambda b: b["bits"] != 0)


def _ones(v: Column, words: int) -> Column:
    return sum((F.bit_count(v[i]) for i in range(words)), F.lit(0))


def _apart(a: Column, b: Column, words: int) -> Column:
    return sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(words)), F.lit(0))


def dice(a: Column, b: Column, bits: int) -> Column:
    """The Dice score of two vectors."""
    words = bits // 64
    return 1 - _apart(a, b, words) / (_ones(a, words) + _ones(b, words))


def close_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """(l, r, dice) of the forms (form, number, place, name) of both sides that share number and city and whose names' vectors
    differ in fewer bits than the fuller one has blocks with a bit."""
    where = ["number", "place"]
    shared = left.select(where).distinct().join(right.select(where).distinct(), where)
    with_blocks = lambda x: x.join(shared, where, "left_semi").select("form", *where, "name", encoding(F.col("name")).alias("v")).select("*", full_blocks(F.col("v")).alias("blocks"))
    left, right = (cut(with_blocks(x)) for x in (left, right))
    spread = lambda x, k: x.select(F.col("form").alias(k), F.xxhash64(*where).alias("at"), F.explode("blocks").alias("b")).select(k, "at", "b.block", "b.bits")
    met = spread(left, "l").join(spread(right, "r"), ["at", "block", "bits"]).select("l", "r").distinct()
    side = lambda x, s: x.select(F.col("form").alias(s), F.struct(*where).alias(f"w{s}"), F.col("v").alias(f"v{s}"), F.col("name").alias(f"n{s}"), F.size("blocks").alias(f"k{s}"))
    pairs = met.join(side(left, "l"), "l").join(side(right, "r"), "r").where("wl = wr")
    pairs = pairs.where(_apart(F.col("vl"), F.col("vr"), BITS // 64) < F.greatest("kl", "kr"))
    digits = lambda c: F.regexp_replace(c, "[^0-9]", "")
    pairs = pairs.where(digits("nl") == digits("nr"))  # numbered roads and boxes
    return pairs.select("l", "r", dice(F.col("vl"), F.col("vr"), BITS).alias("dice"))


def encoded_parts(forms: DataFrame) -> DataFrame:
    """The rows with the vectors of their direction, suffix and zip (its digits with their places)."""
    placed = F.array_join(F.transform(F.split("zip", ""), lambda d, i: F.concat(i.cast("string"), d)), "")
    return forms.withColumns({"direction_v": encoding(F.col("direction"), FIELD_BITS), "suffix_v": encoding(F.col("suffix"), FIELD_BITS), "zip_v": encoding(placed, FIELD_BITS)})


def scored(pairs: DataFrame) -> DataFrame:
    """The pairs with the scores of their parts (direction, suffix and zip of both sides with their vectors)."""
    stated = lambda c: (F.col(f"{c}_l") != "") & (F.col(f"{c}_r") != "")
    apart = lambda c: F.when(stated(c), 1 - dice(F.col(f"{c}_v_l"), F.col(f"{c}_v_r"), FIELD_BITS)).otherwise(0.0).alias(f"{c}_apart")
    missing = lambda c: ((F.col(f"{c}_l") == "") != (F.col(f"{c}_r") == "")).cast("double").alias(f"{c}_missing")
    return pairs.select("*", apart("direction"), apart("suffix"), apart("zip"), missing("direction"), missing("suffix"))


def patterns(labelled: DataFrame) -> DataFrame:
    """(features, same, n): how often each combination of rounded scores occurs."""
    rounded = [(F.round(F.col(f) * STEPS) / STEPS).alias(f) for f in FEATURES]
    return labelled.select(*rounded, "same").groupBy(*FEATURES, "same").agg(F.count("*").alias("n"))


def fit(sample: pd.DataFrame) -> tuple[float, ...]:
    """Weights of a logistic model with a ridge towards the fixed ones, from features, `same` and, where given, counts `n`."""
    start = np.array(DEFAULT_WEIGHTS)
    n = sample["n"].to_numpy(float) if "n" in sample else np.ones(len(sample))
    if n.sum() < 50 or sample["same"].nunique() < 2:
        return DEFAULT_WEIGHTS
    x = np.column_stack([np.ones(len(sample)), sample[list(FEATURES)].to_numpy(float)])
    y, w, ridge = sample["same"].to_numpy(float), start.copy(), np.diag([0.05] * len(start))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (n * (y - p)) - ridge @ (w - start))
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


def confidences(features: DataFrame, weights: tuple[float, ...], record: str, address: str) -> DataFrame:
    """(record, address, confidence), a record's confidence shared out among its addresses by their odds."""
    z = F.lit(weights[0]) + sum((F.lit(w) * F.col(f) for w, f in zip(weights[1:], FEATURES, strict=True)), F.lit(0.0))
    odds = features.select(record, address, F.exp(F.least(z, F.lit(30.0))).alias("odds")).groupBy(record, address).agg(F.max("odds").alias("odds"))
    total = odds.groupBy(record).agg(F.sum("odds").alias("total"))
    return odds.join(total, record).select(record, address, (F.col("odds") / (1 + F.col("total"))).alias("confidence"))
