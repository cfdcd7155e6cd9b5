"""Mixing sources to target weights by cube-method balanced sampling.

The largest total is taken at which every source that has any size can still give its share within its cap of repeats;
shares of absent sources fall to the others in proportion. Each document of a source is then due the same number of
copies: the whole part for certain, the fraction as the probability of one copy more. The cube method decides those:
a walk in the null-space of the balancing constraints (tokens and documents of the source) moves the probabilities of
three documents at a time until one of them is 0 or 1. It runs in buckets of bounded size; the two documents that each
bucket leaves undecided walk on together, until only the landing of two per source and mixture remains. Large documents
are decided first, so the last ones are small; where the landing still misses the tokens due by more than `TOLERANCE`, it
exchanges chosen documents for ones left out.

Cases: documents without tokens, and those of null source, take no part. Sources that no mixture names play no part. A
mixture all of whose sources are absent has no rows in the list and null shares. Repeated rows of a document are separate documents; ties
are decided by the seed. Empty tables give no rows. Other columns play no part.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnfield.session import cut

#: Documents that one task balances at once, and the seed of all draws.
BUCKET_DOCS, SEED = 20_000, 42
EPS = 1e-9


def flight(sizes: np.ndarray, p: np.ndarray, draws: np.random.Generator, land: bool = False) -> np.ndarray:
    """The probabilities after the walk: all but two are 0 or 1, the expected total of sizes and of units kept; with
    `land` the last ones are decided too."""
    p = np.clip(p.astype(float), 0.0, 1.0)
    t = (sizes / max(float(sizes.max(initial=1.0)), 1.0)).tolist()
    out, held = p.tolist(), []
    luck = draws.random(2 * len(out) + 8)
    k = 0
    for i in np.argsort(-sizes, kind="stable").tolist():  # large ones first, so that the last to decide are small
        if EPS < out[i] < 1 - EPS:
            held.append(i)
        while len(held) == 3:
            a, b, c = held
            u = (t[b] - t[c], t[c] - t[a], t[a] - t[b])  # null-space of the sizes and the count of three units
            if max(map(abs, u)) < EPS:
                u = (1.0, -1.0, 0.0)  # equal sizes
            up = min(((1 - out[x]) if v > 0 else out[x]) / abs(v) for x, v in zip(held, u, strict=True) if abs(v) > EPS)
            down = min((out[x] if v > 0 else (1 - out[x])) / abs(v) for x, v in zip(held, u, strict=True) if abs(v) > EPS)
            step = up if luck[k] < down / (up + down) else -down
            k += 1
            for x, v in zip(held, u, strict=True):
                out[x] = min(1.0, max(0.0, out[x] + step * v))
            held = [x for x in held if EPS < out[x] < 1 - EPS]
    if land and held:
        _land(t, p, out, held, draws)
    return np.array(out)


#: The share of the due total that the landing may miss without an exchange, and the exchanges it tries at most.
TOLERANCE, EXCHANGES = 1e-3, 32


def _exchange(size: np.ndarray, taken: np.ndarray, left: np.ndarray, lack: float, enough: float, draws: np.random.Generator) -> tuple[float, int, int] | None:
    """What is still missed after exchanging a taken unit for a left one, and the two: drawn from the exchanges that miss
    little enough, else the best."""
    if not len(taken) or not len(left):
        return None
    left = left[np.argsort(size[left], kind="stable")]
    at = np.searchsorted(size[left], size[taken] + lack)
    near = np.stack([np.clip(at - 1, 0, len(left) - 1), np.clip(at, 0, len(left) - 1)])
    miss = lack + size[taken] - size[left[near]]
    good = np.flatnonzero(np.abs(miss).ravel() <= enough)
    k = int(draws.choice(good)) if len(good) else int(np.argmin(np.abs(miss)))
    return float(miss.ravel()[k]), int(taken[k % len(taken)]), int(left[near.ravel()[k]])


def _land(t: list[float], p: np.ndarray, out: list[float], held: list[int], draws: np.random.Generator) -> None:
    """Decide the last units by their probabilities, their count kept where two are left; then exchange chosen units for
    ones left out while the total of sizes is missed by more than the tolerance and an exchange helps."""
    size = np.array(t)
    if len(held) == 2:
        a, b = held
        up, down = min(1 - out[a], out[b]), min(out[a], 1 - out[b])
        step = up if draws.random() < down / (up + down) else -down
        out[a], out[b] = out[a] + step, out[b] - step
    for x in held:
        if EPS < out[x] < 1 - EPS:
            out[x] = float(draws.random() < out[x])
    now, due, free = np.round(out), float(size @ p), (p > EPS) & (p < 1 - EPS)
    lack, enough = due - float(size @ now), TOLERANCE * due
    for _ in range(EXCHANGES):
        if abs(lack) <= enough:
            break
        found = _exchange(size, np.flatnonzero(free & (now > 0.5)), np.flatnonzero(free & (now <= 0.5)), lack, enough, draws)
        if found is None or abs(found[0]) > abs(lack) - EPS:
            break
        lack, now[found[1]], now[found[2]] = found[0], 0.0, 1.0
    out[:] = now.tolist()


def plan(sizes: DataFrame, targets: DataFrame, size: str = "tokens") -> DataFrame:
    """(mix_id, source, target_share, max_repeats, n, total, copies) of each target: the copies due to every document of the source."""
    have = sizes.where(f"{size} > 0 and source is not null").groupBy("source").agg(F.count("*").alias("n"), F.sum(size).alias("total"))
    t = targets.select("mix_id", "source", "target_share", "max_repeats").distinct().join(have, "source", "left").na.fill(0, ["n", "total"])
    able = (F.col("total") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    bound = t.where(able).groupBy("mix_id").agg(F.sum("target_share").alias("present"), F.min(F.col("total") * F.col("max_repeats") / F.col("target_share")).alias("most"))
    t = t.join(bound, "mix_id", "left")
    return t.select("mix_id", "source", "target_share", "max_repeats", "n", "total", F.when(able, F.least(F.col("max_repeats").cast("double"), F.col("most") * F.col("target_share") / F.col("total"))).otherwise(0.0).alias("copies"))


def mixture(sizes: DataFrame, targets: DataFrame, id_col: str = "doc_id", size: str = "tokens", bucket_docs: int = BUCKET_DOCS, seed: int = SEED) -> DataFrame:
    """(mix_id, source, `id_col`, tokens, repeats), repeats > 0: how often each mixture takes each document."""
    kind = sizes.schema[id_col].dataType.simpleString()
    due = cut(plan(sizes, targets, size).where("copies > 0"))
    units = sizes.where(f"{size} > 0").select("source", F.col(id_col).alias("unit"), F.col(size).cast("long").alias("tokens")).join(due.select("mix_id", "source", "copies", "n"), "source")
    sure = F.floor(F.col("copies") + EPS)
    units = cut(units.select("mix_id", "source", "unit", "tokens", sure.cast("int").alias("sure"), F.greatest(F.lit(0.0), F.col("copies") - sure).alias("p"), F.ceil(F.col("n") / bucket_docs).alias("parts")))
    schema = f"mix_id {units.schema['mix_id'].dataType.simpleString()}, source string, bucket long, unit {kind}, tokens long, sure int, p double, parts long"

    def walk(land: bool, level: int):
        def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["unit", "tokens"], kind="stable")
            draws = np.random.default_rng(zlib.crc32(repr((seed, level, *map(str, key))).encode()))
            pdf = pdf.iloc[draws.permutation(len(pdf))]
            return pdf.assign(p=flight(pdf["tokens"].to_numpy(), pdf["p"].to_numpy(), draws, land))

        return run

    open_ = (F.col("p") > EPS) & (F.col("p") < 1 - EPS)
    settled, state, level = [units.where(~open_)], units.where(open_), 0
    most = due.agg(F.max(F.ceil(F.col("n") / bucket_docs))).first()[0] or 1
    while True:
        last = most <= 1
        rows = state.withColumn("bucket", F.pmod(F.xxhash64("unit", F.lit(level)), F.greatest(F.col("parts"), F.lit(1))))
        state = cut(rows.groupBy("mix_id", "source", "bucket").applyInPandas(walk(last, level), schema)).drop("bucket")
        settled.append(state.where(~open_))
        if last:
            break
        state = state.where(open_).withColumn("parts", F.ceil(2 * F.col("parts") / bucket_docs))
        most, level = -(-2 * most // bucket_docs), level + 1
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out.select("mix_id", "source", F.col("unit").alias(id_col), "tokens", (F.col("sure") + F.round("p").cast("int")).alias("repeats")).where("repeats > 0")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(mix_id, source, target_share, reachable_share, n_docs, n_repeats, tokens, actual_share) of every target;
    `reachable_share` is the target where the shares of the sources that give nothing fall to the others in proportion."""
    got = mixed.groupBy("mix_id", "source").agg(F.count("*").alias("n_docs"), F.max("repeats").alias("n_repeats"), F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"))
    t = targets.select("mix_id", "source", "target_share").distinct().join(got, ["mix_id", "source"], "left").na.fill(0, ["n_docs", "n_repeats", "tokens"])
    whole = t.groupBy("mix_id").agg(F.sum("tokens").alias("whole"), F.sum(F.when(F.col("tokens") > 0, F.col("target_share"))).alias("present"))
    t = t.join(whole, "mix_id")
    share = F.when(F.col("tokens") > 0, F.col("target_share") / F.col("present")).otherwise(0.0)
    return t.select("mix_id", "source", "target_share", F.when(F.col("whole") > 0, share).alias("reachable_share"), "n_docs", "n_repeats", "tokens", F.when(F.col("whole") > 0, F.col("tokens") / F.col("whole")).alias("actual_share"))
