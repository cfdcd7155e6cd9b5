"""The nearest texts of a block by the TF-IDF product of their character grams, without rows of tokens or pairs.

Only the texts move: the rows of a block go together into one bucket, with the weights of the grams met there, and are held
against each other there, so many at a time. Only a block that is more than a bucket's share of all products, or that has
more texts than a task should hold, goes to several buckets in pieces, each row as often as the other side has pieces; so the
rows moved grow not much faster than the rows until blocks pass `PIECE_ROWS`. A bucket's products are summed in arrays, the grams that most
rows hold by a matrix product, the rest by lists of the rows that hold them; what comes within the error of that sum of the
k-th best is scored exactly. Nothing is left out: all rows of a block are held against all others of it.

Cases: null ids, texts and blocks, and texts shorter than a gram, match nothing; several texts of an id in a block count
as one row. Scores are compared to nine digits; ties go to the smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnfield.session import buckets, cut, parallelism

#: Characters that a gram's number holds, 21 bits each.
LONGEST = 3
DIGITS = 9
#: Rows held against each other at a time, and about so many rows to a bucket.
LEFT_ROWS, RIGHT_ROWS, BUCKET_ROWS = 4096, 32768, 32768
#: Texts of a piece at most, and products from which a block may go in pieces.
PIECE_ROWS, PIECE_PRODUCTS = 262144, 32_000_000
#: Sums held at a time; products from which a piece has a matrix; a posting costs so many cells of it; more than the error of sums.
WORK, MATRIX, POSTING, ERROR = 2_000_000, 200_000, 150, 1e-4


def rows(df: DataFrame, id_col: str, text: Column, block: Sequence[str] = ()) -> DataFrame:
    """(block, id, text): what `nearest` takes, the texts in lower case."""
    return df.select(*block, F.col(id_col).alias("id"), F.lower(text).alias("text")).dropna()


def codes(texts: pa.Array, grams: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of the text, number of the gram) for every run of so many characters."""
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.int64)
    counts = np.maximum(lengths - grams + 1, 0)
    of = np.repeat(np.arange(len(lengths)), counts)
    at = np.repeat(np.cumsum(lengths) - lengths - (np.cumsum(counts) - counts), counts) + np.arange(len(of))
    code = np.zeros(len(of), np.int64)
    for k in range(grams):
        code = code << 21 | points[at + k]
    return of, code


def vocabulary(df: DataFrame, id_col: str, text: Column, grams: int = LONGEST) -> DataFrame:
    """(token, idf) over the distinct ids of a table: ln((1 + n) / (1 + df)) + 1 of every gram."""
    known = df.where(F.col(id_col).isNotNull())
    texts = known.select(F.col(id_col).alias("id"), F.lower(text).alias("text")).groupBy("id").agg(F.collect_set("text").alias("texts")).select("texts")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            of, code = codes(pc.list_flatten(lists), grams)
            of = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)[of]
            order = np.lexsort((of, code))
            of, code = of[order], code[order]
            new = np.r_[True, (of[1:] != of[:-1]) | (code[1:] != code[:-1])] if len(of) else np.zeros(0, bool)
            token, n = np.unique(code[new], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token, pa.int64()), pa.array(n, pa.int64())], ["token", "df"])

    seen = texts.mapInArrow(count, "token long, df long").groupBy("token").agg(F.sum("df").alias("df"))
    n = known.select(id_col).distinct().agg(F.count("*").alias("n"))
    return seen.crossJoin(F.broadcast(n)).select("token", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


def nearest(left: DataFrame, right: DataFrame, words: DataFrame, block: Sequence[str] = (), k: int = 1, threshold: float = 0.0, grams: int = LONGEST) -> DataFrame:
    """(left_id, right_id, score): the k most alike rows of `right` for every id of `left` among those of its blocks that share
    a gram of `words` (token, idf) and score the threshold at least."""
    size = lambda x, n: x.groupBy(*block).agg(F.count("*").alias(n))
    sizes = size(left, "_l").join(size(right, "_r"), list(block)) if block else size(left, "_l").crossJoin(size(right, "_r"))
    sizes = cut(sizes.where("_l > 0 and _r > 0").select(*block, F.monotonically_increasing_id().alias("no"), "_l", "_r"))
    total, products = (x or 0 for x in sizes.agg(F.sum(F.col("_l") + F.col("_r")), F.sum(F.col("_l").cast("double") * F.col("_r"))).first())
    n = max(2 * parallelism(left.sparkSession), buckets(int(total), BUCKET_ROWS))
    # a block in as many pieces as it has a bucket's share of the products, such that the fewest rows are repeated
    shares = F.ceil(F.col("_l").cast("double") * F.col("_r") / max(products / n, PIECE_PRODUCTS))
    cl = F.least(shares, F.greatest(F.lit(1), F.round(F.sqrt(shares * F.col("_l") / F.col("_r")))))
    pieces = lambda own, c: F.greatest(F.least(c, F.col(own)), F.ceil(F.col(own) / PIECE_ROWS)).cast("long")
    sizes = sizes.select(*block, "no", pieces("_l", cl).alias("_cl"), pieces("_r", F.ceil(shares / cl)).alias("_cr"))

    def spread(x: DataFrame, is_left: bool) -> DataFrame:
        """The rows with the pieces that they are held against."""
        met = x.join(sizes, list(block)) if block else x.crossJoin(F.broadcast(sizes))
        own, other = ("_cl", "_cr") if is_left else ("_cr", "_cl")
        met = met.withColumn("_own", F.pmod(F.xxhash64("id"), own)).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))
        p, q = ("_own", "_other") if is_left else ("_other", "_own")
        ids = [F.col("id") if which is x else F.lit(None).cast(which.schema["id"].dataType) for which in (left, right)] if left is not right else [F.col("id")] * 2
        return met.select(F.pmod(F.xxhash64("no", p, q), F.lit(n)).alias("bucket"), "no", F.col(p).alias("p"), F.col(q).alias("q"), F.lit(is_left).alias("is_left"), ids[0].alias("left_id"), ids[1].alias("right_id"), "text")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, code = codes(batch.column("text"), grams)
            pairs = pd.DataFrame({"bucket": batch.column("bucket").to_numpy()[of], "token": code}).drop_duplicates()
            yield pa.RecordBatch.from_pandas(pairs, preserve_index=False)

    both = spread(left, True).unionByName(spread(right, False)).repartition(n, "bucket")
    # of whole rows, so that they are shuffled once for both uses
    met = both.mapInArrow(meet, "bucket long, token long").distinct().join(words, "token").select("bucket", "token", "idf").repartition(n, "bucket")
    kinds = [x.schema["id"].dataType.simpleString() for x in (left, right)]
    most = LEFT_ROWS, RIGHT_ROWS
    work = lambda texts, known: best(texts, known, k, threshold, grams, most)
    found = both.groupBy("bucket").cogroup(met.groupBy("bucket")).applyInArrow(work, f"left_id {kinds[0]}, right_id {kinds[1]}, score double")
    # the limit of a window is kept while rows come in
    return found.withColumn("_n", F.row_number().over(Window.partitionBy("left_id").orderBy(F.desc("score"), "right_id"))).where(F.col("_n") <= k).drop("_n")


class _Side:
    """The unit vectors of one side of a bucket, by piece and id: `first` row and `piece` of each, and its entries `v` (vector), `t` (word), `w`."""

    def __init__(self, ids: pa.Array, texts: pa.Array, piece: np.ndarray, tokens: np.ndarray, idf: np.ndarray, grams: int, alike: int | None = None):
        """With `alike`, so many of the rows of the same text are kept in a piece, those of the smallest ids: no other can be among the nearest."""
        known = ids.dictionary_encode()
        place = np.empty(len(known.dictionary), np.int64)
        place[pc.sort_indices(known.dictionary).to_numpy()] = np.arange(len(place))
        _, self.first, of_row, n = np.unique(piece * max(len(place), 1) + place[known.indices.to_numpy()], return_index=True, return_inverse=True, return_counts=True)
        use = np.ones(len(piece), bool)
        if alike:
            text = texts.dictionary_encode().indices.to_numpy().astype(np.int64)[self.first]
            group = np.where(n == 1, piece[self.first] * len(texts) + text, -1 - np.arange(len(text)))
            order = np.argsort(group, kind="stable")
            start = np.flatnonzero(np.r_[True, np.diff(group[order]) != 0]) if len(order) else np.zeros(0, np.int64)
            kept = np.empty(len(order), bool)
            kept[order] = np.arange(len(order)) - np.repeat(start, np.diff(np.r_[start, len(order)])) < alike
            use, self.first, of_row = kept[of_row], self.first[kept], (np.cumsum(kept) - 1)[of_row]
        of, code = codes(texts, grams)
        of, code = of[use[of]], code[use[of]]
        at = np.minimum(np.searchsorted(tokens, code), len(tokens) - 1)
        ok = tokens[at] == code
        entries, tf = np.unique(of_row[of[ok]] * len(tokens) + at[ok], return_counts=True)
        self.v, self.t = np.divmod(entries, len(tokens))
        w = tf * idf[self.t]
        self.w = w / np.sqrt(np.bincount(self.v, w * w, len(self.first)))[self.v]
        self.key, self.piece = entries, piece[self.first]


def best(texts: pa.Table, known: pa.Table, k: int, threshold: float, grams: int, most: tuple[int, int] = (LEFT_ROWS, RIGHT_ROWS)) -> pa.Table:
    """(left_id, right_id, score) of the k nearest rows of every left row in each piece of a bucket; of a piece with more rows than
    `most` of a side, in each part of its right side."""
    texts = texts.combine_chunks()
    get = lambda t, c: t.column(c).to_numpy()
    out_i, out_j, out_s = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    is_left = get(texts, "is_left").astype(bool)
    sides = [texts.filter(pa.array(is_left)), texts.filter(pa.array(~is_left))]
    flat = lambda t, c: t.column(c).combine_chunks() if t.num_rows else pa.array([], t.schema.field(c).type)
    if all(x.num_rows for x in sides) and known.num_rows:
        order = np.argsort(get(known, "token"))
        tokens, idf = get(known, "token")[order], get(known, "idf")[order]
        piece = pd.DataFrame({c: get(texts, c) for c in ("no", "p", "q")}).groupby(["no", "p", "q"]).ngroup().to_numpy().astype(np.int64)
        pieces = [piece[is_left], piece[~is_left]]
        ids, words = [flat(x, c) for x, c in zip(sides, ("left_id", "right_id"), strict=True)], [flat(x, "text") for x in sides]

        def side(x: int, at: np.ndarray, alike: int | None = None) -> _Side:
            take = pa.array(at)
            return _Side(ids[x].take(take), words[x].take(take), pieces[x][at], tokens, idf, grams, alike)

        for at_right, lefts in _parts(pieces, ids, most):
            right = side(1, at_right, k)
            for at_left in lefts:
                left = side(0, at_left)
                for i, j in _near(left, right, len(tokens), k, threshold):
                    score = _product(left, right, len(tokens), i, j)
                    ok = (score > 0) & (score >= threshold)
                    i, j, score = i[ok], j[ok], score[ok]
                    order = np.lexsort((j, -score, i))
                    i, j, score = i[order], j[order], score[order]
                    start = np.flatnonzero(np.r_[True, np.diff(i) != 0]) if len(i) else np.zeros(0, np.int64)
                    top = np.arange(len(i)) - np.repeat(start, np.diff(np.r_[start, len(i)])) < k
                    out_i.append(at_left[left.first[i[top]]]), out_j.append(at_right[right.first[j[top]]]), out_s.append(score[top])
    found = [flat(x, c).take(pa.array(np.concatenate(o))) for x, c, o in zip(sides, ("left_id", "right_id"), (out_i, out_j), strict=True)]
    return pa.table([*found, pa.array(np.concatenate(out_s), pa.float64())], ["left_id", "right_id", "score"])


def _parts(pieces: list[np.ndarray], ids: list[pa.Array], most: tuple[int, int]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """(right rows, left rows of each part) that are held against each other: small pieces together, a large one in parts of whole ids."""
    count = max(int(x.max()) for x in pieces) + 1
    rows = [np.bincount(x, minlength=count) for x in pieces]
    met = np.all([n > 0 for n in rows], 0)
    large = met & np.any([n > m for n, m in zip(rows, most, strict=True)], 0)
    small = np.where(met & ~large, rows[0] + rows[1], 0)
    group = np.where(small > 0, (np.cumsum(small) - small) // most[1], -1)
    group[large] = group.max() + 1 + np.arange(large.sum())
    sorts = [np.argsort(group[x], kind="stable") for x in pieces]
    ends = [np.searchsorted(group[x][order], np.arange(group.max() + 2)) for x, order in zip(pieces, sorts, strict=True)]
    alone = np.zeros(group.max() + 1, bool)
    alone[group[large]] = True
    for g in range(len(alone)):
        sides = [order[e[g] : e[g + 1]] for order, e in zip(sorts, ends, strict=True)]
        if not all(len(x) for x in sides):
            continue
        if not alone[g]:
            yield sides[1], [sides[0]]
            continue
        parts = []
        for at, known, m in zip(sides, ids, most, strict=True):
            n = -(-len(at) // m)
            of = known.take(pa.array(at)).dictionary_encode().indices.to_numpy() % n if n > 1 else np.zeros(len(at), np.int64)
            parts.append([x for c in range(n) if len(x := at[of == c])])
        for at_right in parts[1]:
            yield at_right, parts[0]


def _product(left: _Side, right: _Side, words: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The products of pairs of vectors to nine digits, each summed in the order of its words."""
    ptr = np.searchsorted(left.v, np.arange(len(left.first) + 1))
    out = np.zeros(len(i))
    n = ptr[i + 1] - ptr[i]
    ends = np.cumsum(n)
    s = 0
    while s < len(i):
        e = max(s + 1, int(np.searchsorted(ends, (ends[s - 1] if s else 0) + WORK, "right")))
        m = n[s:e]
        of = np.repeat(np.arange(e - s), m)
        at = np.repeat(ptr[i[s:e]] - (np.cumsum(m) - m), m) + np.arange(len(of))
        want = j[s:e][of] * words + left.t[at]
        place = np.minimum(np.searchsorted(right.key, want), len(right.key) - 1)
        out[s:e] = np.bincount(of, np.where(right.key[place] == want, left.w[at] * right.w[place], 0.0), e - s)
        s = e
    return np.round(out, DIGITS)


def _near(left: _Side, right: _Side, words: int, k: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(left vectors, right vectors): pairs that hold the k nearest of every left vector, in runs of whole left vectors."""
    if not len(left.v) or not len(right.v):
        return
    pieces = int(max(left.piece[-1], right.piece[-1])) + 1
    r_at = np.searchsorted(right.piece, np.arange(pieces + 1))
    r_n, l_at = np.diff(r_at), np.searchsorted(left.piece, np.arange(pieces + 1))
    area = np.diff(l_at) * r_n
    # the right rows that hold a word in a piece
    key = right.piece[right.v] * words + right.t
    order = np.argsort(key, kind="stable")
    key, who, weight = key[order], right.v[order] - r_at[right.piece[right.v[order]]], right.w[order]
    mine = left.piece[left.v] * words + left.t
    distinct, back, held = np.unique(mine, return_inverse=True, return_counts=True)
    lo, hi = np.searchsorted(key, distinct), np.searchsorted(key, distinct, "right")
    # words of so many pairs that a matrix product is the cheaper sum
    of = area[distinct // words]
    common = (of >= MATRIX) & (held * (hi - lo) * POSTING > of)
    lo, n, dense = lo[back], np.where(common, 0, hi - lo)[back], common[back]
    ptr = np.searchsorted(left.v, np.arange(len(left.first) + 1))
    wide = r_n[left.piece]
    ends = np.cumsum(wide + np.bincount(left.v, n, len(left.first)).astype(np.int64))
    big = np.flatnonzero(area >= MATRIX)
    bounds = np.unique(np.r_[0, l_at[big], l_at[big + 1], len(left.first)])
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        p = int(left.piece[a])
        matrix = None
        if area[p] >= MATRIX:
            mark = distinct[common & (distinct // words == p)]
            at = np.searchsorted(mark, key) if len(mark) else None
            if at is not None:
                hit = np.flatnonzero(mark[np.minimum(at, len(mark) - 1)] == key)
                matrix = np.zeros((len(mark), int(r_n[p])), np.float32)
                matrix[at[hit], who[hit]] = weight[hit]
        s = int(a)
        while s < b:
            e = min(int(b), max(s + 1, int(np.searchsorted(ends, (ends[s - 1] if s else 0) + WORK, "right"))))
            x, y, m = ptr[s], ptr[e], wide[s:e]
            base = np.cumsum(m) - m
            cells, c = int(m.sum()), n[x:y]
            at = np.repeat(lo[x:y] - (np.cumsum(c) - c), c) + np.arange(int(c.sum()))
            if cells:
                sums = np.bincount(np.repeat(base[left.v[x:y] - s], c) + who[at], np.repeat(left.w[x:y], c) * weight[at], cells)
                if matrix is not None:
                    sums = sums.astype(np.float64, copy=False)  # whole numbers where nothing was counted
                    own = np.zeros((e - s, len(matrix)), np.float32)
                    d = np.flatnonzero(dense[x:y]) + x
                    own[left.v[d] - s, np.searchsorted(mark, mine[d])] = left.w[d]
                    sums += (own @ matrix).reshape(-1)
                yield from _candidates(sums, s, m, base, r_at[left.piece[s:e]], k, threshold)
            s = e


def _candidates(sums: np.ndarray, s: int, wide: np.ndarray, base: np.ndarray, first: np.ndarray, k: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of the left vectors from s on whose sum comes within the error of the k-th largest."""
    some = np.flatnonzero(wide)
    start, length, found, picked = base[some], wide[some], np.zeros(len(some), np.int64), []
    for _ in range(k):
        top = np.maximum.reduceat(sums, start)
        ask = (found < k) & (top > 0) & (top >= threshold - ERROR)
        if not ask.any():
            break
        hit = np.flatnonzero(sums >= np.repeat(np.where(ask, np.maximum(top - ERROR, 1e-12), np.inf), length))
        sums[hit] = -1
        of = np.searchsorted(start, hit, "right") - 1
        found += np.bincount(of, minlength=len(some))
        picked.append((of, hit))
    if picked:
        of, hit = (np.concatenate(x) for x in zip(*picked, strict=True))
        yield some[of] + s, first[some[of]] + hit - start[of]
