"""Association by text: TF-IDF similarity within blocks, sub-location markers, and neighbours' votes.

Rows are unit vectors of (token, weight). The nearest rows are found without meeting through common tokens: a first search
by each row's few heaviest tokens, of which the k best are scored, gives a score that its k-th nearest row has at least. A second search goes by the tokens
before the rest of the vector is shorter than half that score; what a row gives by these tokens and can give at most by the
rest tells whether it may score as high, so the search is exact. Only such rows are scored, vector against vector.
Texts by their character grams are matched block by block (`grams`), without rows of tokens or pairs.

Cases: rows without tokens or whose block is null match nothing. Scores are compared to nine digits; ties go to the smallest
id. Empty tables give no rows.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnfield.operators import grams as G
from cairnfield.session import cut

#: The lowest similarity that counts, unless stated otherwise.
THRESHOLD = 0.1


def word_grams(c: Column, n: int = 1) -> Column:
    """The lower-case runs of 1 … n words of a text."""
    words = F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    runs = [words]
    for k in range(2, n + 1):
        runs.append(F.transform(F.filter(F.sequence(F.lit(1), F.greatest(F.size(words) - k + 1, F.lit(1))), lambda i, k=k: i + k - 1 <= F.size(words)), lambda i, k=k: F.array_join(F.slice(words, i, k), " ")))
    return F.flatten(F.array(*runs))


def char_grams(c: Column, n: int = 3) -> Column:
    """The runs of n characters of a lower-case text."""
    low = F.lower(c)
    return F.transform(F.filter(F.sequence(F.lit(1), F.greatest(F.length(low) - n + 1, F.lit(1))), lambda i: i + n - 1 <= F.length(low)), lambda i: low.substr(i, F.lit(n)))


def _weighed(df: DataFrame, id_col: str, tokens: Column, block: Sequence[str], vocabulary: DataFrame) -> DataFrame:
    """(block, id, token, weight): term counts times idf."""
    rows = df.select(*block, F.col(id_col).alias("id"), F.explode(tokens).alias("token")).groupBy(*block, "id", "token").agg(F.count("*").alias("tf"))
    return rows.join(vocabulary, "token").select(*block, "id", "token", (F.col("tf") * F.col("idf")).alias("weight"))


def tfidf(df: DataFrame, id_col: str, tokens: Column, block: Sequence[str] = (), vocabulary: DataFrame | None = None, min_df: int = 1, max_df: float = 1.0) -> DataFrame:
    """(block, id, token, weight), unit length per row: term counts times ln((1 + n) / (1 + df)) + 1. `vocabulary`
    (token, idf) of another table is used where given, else that of this one, which holds tokens of `min_df` rows at
    least and of a share `max_df` at most."""
    if vocabulary is None:
        vocabulary = idf(df, id_col, tokens, min_df, max_df)
    rows = _weighed(df, id_col, tokens, block, vocabulary)
    norms = rows.groupBy(*block, "id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    return rows.join(norms, [*block, "id"]).select(*block, "id", "token", (F.col("weight") / F.col("norm")).alias("weight"))


def idf(df: DataFrame, id_col: str, tokens: Column, min_df: int = 1, max_df: float = 1.0) -> DataFrame:
    """(token, idf) over the distinct rows of a table."""
    n = df.select(id_col).distinct().agg(F.count("*").alias("n"))
    seen = df.select(F.col(id_col).alias("id"), F.explode(tokens).alias("token")).distinct().groupBy("token").agg(F.count("*").alias("df"))
    both = seen.crossJoin(F.broadcast(n)).where((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * F.col("n")))
    return both.select("token", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


#: Tokens of a row that the first search uses.
FIRST = 4
DIGITS = 9


def vectors(weights: DataFrame, block: Sequence[str] = (), unit: bool = False) -> DataFrame:
    """(block, id, v, tokens, weights): the tokens of every row with their weights, the heaviest first, together and apart;
    with `unit` each row is brought to unit length."""
    entry = F.struct((-F.col("weight")).alias("w"), "token")
    out = weights.groupBy(*block, "id").agg(F.array_sort(F.collect_list(entry)).alias("v"), F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    if unit:
        out = out.withColumn("v", F.transform("v", lambda x: F.struct((x["w"] / F.col("norm")).alias("w"), x["token"].alias("token"))))
    return out.select(*block, "id", "v", F.col("v.token").alias("tokens"), F.transform("v.w", lambda w: -w).alias("weights"))


def _scored(pairs: DataFrame, left: DataFrame, right: DataFrame, block: Sequence[str]) -> DataFrame:
    """(block, left_id, right_id, score): the product of the vectors of every pair."""
    side = lambda rows, k: rows.select(*block, F.col("id").alias(f"{k}_id"), F.col("tokens").alias(f"t_{k}"), F.col("weights").alias(f"w_{k}"))
    both = pairs.join(side(left, "left"), [*block, "left_id"]).join(side(right, "right"), [*block, "right_id"])
    other = lambda t: F.coalesce(F.get("w_right", (F.array_position("t_right", t) - 1).cast("int")), F.lit(0.0))
    product = F.aggregate(F.zip_with("t_left", "w_left", lambda t, w: w * other(t)), F.lit(0.0), lambda s, x: s + x)
    return both.select(*block, "left_id", "right_id", F.round(product, DIGITS).alias("score"))


def nearest(left: DataFrame, right: DataFrame, block: Sequence[str] = (), k: int = 1, threshold: float = 0.0, itself: bool = True, unit: bool = False) -> DataFrame:
    """(block, left_id, right_id, score): the k most alike rows of `right` for every row of `left` within its block, of those
    that share a token and score the threshold at least; rows of the same id count or not."""
    left, right = (cut(vectors(x.dropna(subset=list(block)) if block else x, block, unit)) for x in (left, right))
    index = right.select(*block, F.col("id").alias("right_id"), F.explode("v").alias("x")).select(*block, "right_id", "x.token", (-F.col("x.w")).alias("wr"))
    other = F.lit(True) if itself else F.col("left_id") != F.col("right_id")
    # the limit of a window is kept while rows come in, so no row's partners are ever held together
    top = lambda rows, by: rows.withColumn("_r", F.row_number().over(Window.partitionBy(*block, "left_id").orderBy(F.desc(by), "right_id"))).where(F.col("_r") <= k)

    def search(rows: DataFrame) -> DataFrame:
        """The pairs that share a probed token, with the product over those tokens and the length that they have on the right."""
        probes = rows.select(*block, F.col("id").alias("left_id"), F.explode("p").alias("x")).select(*block, "left_id", "x.token", (-F.col("x.w")).alias("wl"))
        return probes.join(index, [*block, "token"]).where(other).groupBy(*block, "left_id", "right_id").agg(F.sum(F.col("wl") * F.col("wr")).alias("part"), F.sum(F.col("wr") * F.col("wr")).alias("held"))

    promising = top(search(left.withColumn("p", F.slice("v", 1, FIRST))), "part").select(*block, "left_id", "right_id")
    first = cut(_scored(promising, left, right, block).where(F.col("score") > 0))
    # the least score of the first k, 0 where there are fewer
    least = first.groupBy(*block, F.col("left_id").alias("id")).agg(F.count("*").alias("n"), F.min("score").alias("s")).select(*block, "id", F.when(F.col("n") == k, F.col("s")).otherwise(0.0).alias("least"))
    bound = F.greatest(F.coalesce("least", F.lit(0.0)), F.lit(threshold)) - 10.0**-DIGITS
    rest = lambda i: F.sqrt(F.aggregate(F.slice("v", i + 1, F.size("v")), F.lit(0.0), lambda s, x: s + x["w"] * x["w"]))
    # tokens until the rest is half as long as the score needed: what they give must then be the other half
    used = F.size(F.filter(F.transform("v", lambda x, i: rest(i) >= F.col("bound") / 2), lambda u: u))
    full = cut(left.select(*block, "id", "v").join(least, [*block, "id"], "left").withColumn("bound", bound).withColumn("used", used).select(*block, "id", "bound", F.slice("v", F.lit(1), F.col("used")).alias("p"), rest(F.col("used")).alias("rest")))
    met = search(full).join(full.select(*block, F.col("id").alias("left_id"), "bound", "rest"), [*block, "left_id"])
    able = met.where(F.col("part") + F.col("rest") * F.sqrt(F.greatest(F.lit(0.0), 1 - F.col("held"))) >= F.col("bound") - 10.0**-DIGITS).select(*block, "left_id", "right_id")
    more = able.join(first.select(*block, "left_id", "right_id"), [*block, "left_id", "right_id"], "left_anti")
    found = first.unionByName(_scored(more, left, right, block)).where((F.col("score") > 0) & (F.col("score") >= threshold))
    return top(found, "score").select(*block, "left_id", "right_id", "score")


def rank(dim: DataFrame, ops: DataFrame, dim_text: Column, ops_text: Column, block: Sequence[str] = (), dim_id: str = "ID", ops_id: str = "ID", per_ops: bool = False, grams: int = 3, threshold: float = 0.0, words: DataFrame | None = None) -> DataFrame:
    """(left_id, right_id, score): the best canonical row of every raw row of its block (or the best raw row of every
    canonical one) by their character grams; weights by the raw side (`words`, where they are known, as of
    `grams.vocabulary`). A row of several blocks takes the best of them."""
    if grams > G.LONGEST:
        vocabulary = cut(idf(dim, dim_id, char_grams(dim_text, grams)))
        left = _weighed(dim, dim_id, char_grams(dim_text, grams), block, vocabulary)
        right = _weighed(ops, ops_id, char_grams(ops_text, grams), block, vocabulary)
        found = nearest(right, left, block, 1, threshold, unit=True) if per_ops else nearest(left, right, block, 1, threshold, unit=True)
    else:
        left, right = G.rows(dim, dim_id, dim_text, block), G.rows(ops, ops_id, ops_text, block)
        words = G.vocabulary(dim, dim_id, dim_text, grams) if words is None else words
        found = G.nearest(*((right, left) if per_ops else (left, right)), words, block, 1, threshold, grams)
    best = found.groupBy("left_id").agg(F.min(F.struct((-F.col("score")).alias("s"), "right_id")).alias("b"))
    key, other = ("right_id", "left_id") if per_ops else ("left_id", "right_id")
    return best.select(F.col("left_id").alias(key), F.col("b.right_id").alias(other), (-F.col("b.s")).alias("score"))


def rank_by_account(dim: DataFrame, ops: DataFrame, accounts: DataFrame, dim_text: Column, ops_text: Column, threshold: float = 0.0) -> DataFrame:
    """(left_id, right_id, score): the best canonical row (ID, ORGANIZATION_ID) of every raw row (ID, ACCOUNT) among those whose
    organisation has the account by `accounts` (ORGANIZATION_ID, ACCOUNT), each pair once.

    Raw rows go to the organisations of their account, as a canonical row for each account of its organisation would make
    organisations' rows times accounts. Only canonical ids of several organisations, whose texts count together where an
    account has more than one of them, are repeated for each account."""
    raw = dim.select(F.to_json(F.struct("ID", "ACCOUNT")).alias("ID"), "ACCOUNT", dim_text.alias("text")).where("ACCOUNT is not null")
    listed = ops.where("ORGANIZATION_ID is not null").select("ID", "ORGANIZATION_ID", ops_text.alias("text")).distinct()
    several = cut(listed.groupBy("ID").agg(F.count_distinct("ORGANIZATION_ID").alias("n")).where("n > 1").select("ID"))
    named = lambda kind, c: F.concat(F.lit(f"{kind}:"), F.col(c).cast("string")).alias("block")
    shared = listed.join(several, "ID").join(accounts, "ORGANIZATION_ID")
    right = listed.join(several, "ID", "left_anti").select("ID", named("organisation", "ORGANIZATION_ID"), "text").unionByName(shared.select("ID", named("account", "ACCOUNT"), "text").distinct())
    left = raw.join(accounts, "ACCOUNT").select("ID", named("organisation", "ORGANIZATION_ID"), "text").unionByName(raw.join(shared.select("ACCOUNT").distinct(), "ACCOUNT").select("ID", named("account", "ACCOUNT"), "text"))
    found = G.nearest(G.rows(left, "ID", F.col("text"), ["block"]), G.rows(right, "ID", F.col("text"), ["block"]), G.vocabulary(dim.where("ACCOUNT is not null"), "ID", dim_text), ["block"], 1, threshold)
    own = found.select(F.from_json("left_id", f"ID {dim.schema['ID'].dataType.simpleString()}")["ID"].alias("left_id"), "right_id", "score").where("left_id is not null")
    best = own.groupBy("left_id").agg(F.min(F.struct((-F.col("score")).alias("s"), "right_id")).alias("b"))
    return best.select("left_id", F.col("b.right_id").alias("right_id"), (-F.col("b.s")).alias("score"))


def training_pairs(ranked: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(ID, ID_y): the raw rows whose best partner is surely theirs."""
    return ranked.where(F.col("score") >= threshold).select(F.col("left_id").alias("ID"), F.col("right_id").alias("ID_y"))


def neighbour_votes(labelled: DataFrame, weights: DataFrame, k: int = 5, itself: bool = True, block: Sequence[str] = ()) -> DataFrame:
    """(id, label, votes): for every row of `weights` the label with the highest summed score among its k nearest labelled
    rows (id, label) of its block, `itself` included or not."""
    return _elected(nearest(weights, weights.join(labelled.select("id").distinct(), "id"), block, k, 0.0, itself), labelled)


def _elected(near: DataFrame, labelled: DataFrame) -> DataFrame:
    """(id, label, votes): the label with the highest summed score among the near rows (left_id, right_id, score)."""
    votes = near.join(labelled.select(F.col("id").alias("right_id"), "label"), "right_id").groupBy("left_id", "label").agg(F.sum("score").alias("votes"))
    top = votes.groupBy("left_id").agg(F.min(F.struct((-F.round("votes", DIGITS)).alias("v"), "label")).alias("b"))
    return top.select(F.col("left_id").alias("id"), F.col("b.label").alias("label"), (-F.col("b.v")).alias("votes"))


def voted(dim: DataFrame, ops: DataFrame, dim_text: Column, ops_text: Column, block: Sequence[str], k: int = 5, threshold: float = THRESHOLD) -> DataFrame:
    """(dim_id, ops_id, votes): a canonical row for every raw row: raw rows whose best one is sure are labelled with it, and the
    k nearest labelled rows of its blocks, itself among them, vote."""
    words = cut(G.vocabulary(dim, "ID", dim_text))
    sure = training_pairs(rank(dim, ops, dim_text, ops_text, block, words=words), threshold)
    labelled = cut(sure.select(F.col("ID").alias("id"), F.col("ID_y").alias("label")))
    rows = G.rows(dim, "ID", dim_text, block)
    found = _elected(G.nearest(rows, rows.join(labelled.select("id"), "id"), words, block, k), labelled)
    return found.select(F.col("id").alias("dim_id"), F.col("label").alias("ops_id"), "votes")


def scored_left(dim: DataFrame, ops: DataFrame, dim_text: Column, ops_text: Column, block: Sequence[str]) -> DataFrame:
    """(dim_id, ops_id, score) of every raw row with its best canonical row of the block; without any the id is null and the score 0."""
    best = rank(dim, ops, dim_text, ops_text, block)
    rows = dim.select(F.col("ID").alias("dim_id")).distinct().join(best.withColumnRenamed("left_id", "dim_id"), "dim_id", "left")
    return rows.select("dim_id", F.col("right_id").alias("ops_id"), F.coalesce("score", F.lit(0.0)).alias("score"))


def joint_weights(df: DataFrame, id_col: str, parts: Sequence[tuple[str, Column, float]], min_df: int = 1, max_df: float = 1.0) -> DataFrame:
    """(id, token, weight): several kinds of features (name, tokens, weight) side by side, each of unit length before its weight."""
    out = None
    for name, tokens, weight in parts:
        rows = tfidf(df, id_col, tokens, (), None, min_df, max_df).select("id", F.concat(F.lit(f"{name}:"), "token").alias("token"), (F.col("weight") * weight).alias("weight"))
        out = rows if out is None else out.unionByName(rows)
    return out


def folds(df: DataFrame, id_col: str, label: str, n: int = 5, seed: int = 42) -> DataFrame:
    """The rows with `fold` 0 … n-1, every label's rows spread evenly in an order that the seed decides."""
    return df.withColumn("fold", (F.row_number().over(Window.partitionBy(label).orderBy(F.xxhash64(F.lit(seed), id_col), id_col)) - 1) % n)


def cross_validated(df: DataFrame, weights: DataFrame, id_col: str, label: str, k: int, n: int = 5, seed: int = 42) -> DataFrame:
    """(fold, f1, n): the weighted F1 of votes of the k nearest rows, each fold judged by the others."""
    rows = cut(folds(df, id_col, label, n, seed).select(F.col(id_col).alias("id"), F.col(label).alias("label"), "fold"))
    out = None
    for fold in range(n):
        held = rows.where(F.col("fold") == fold)
        found = neighbour_votes(rows.where(F.col("fold") != fold).select("id", "label"), weights, k).select("id", F.col("label").alias("found"))
        one = weighted_f1(held.join(found, "id", "left"), "label", "found").select(F.lit(fold).alias("fold"), "f1", "n")
        out = one if out is None else out.unionByName(one)
    return out


def mean_score(scores: DataFrame) -> float:
    """The mean of the folds' scores, weighted by their rows; 0 without rows."""
    return float(scores.agg(F.sum(F.col("f1") * F.col("n")) / F.sum("n")).first()[0] or 0.0)


def random_search(space: dict[str, Sequence], evaluate: Callable[[dict], float], tries: int, seed: int = 42) -> list[tuple[float, dict]]:
    """(score, setting) of so many settings drawn from the space, the best first; each distinct setting is evaluated once."""
    draws = random.Random(seed)
    drawn = [{k: draws.choice(list(v)) for k, v in space.items()} for _ in range(tries)]
    distinct = list({repr(sorted(d.items())): d for d in drawn}.values())
    return sorted(((evaluate(d), d) for d in distinct), key=lambda x: -x[0])


def marked(dim: DataFrame, ops: DataFrame, text: str, marker: str, block: Sequence[str], dim_id: str = "ID", ops_id: str = "ID") -> DataFrame:
    """(dim_id, ops_id): raw rows of a block in whose text a canonical row's marker is found, whatever the case."""
    rows = dim.select(*block, F.col(dim_id).alias("dim_id"), F.col(text).alias("_text"))
    marks = ops.where(F.col(marker).isNotNull()).select(*block, F.col(ops_id).alias("ops_id"), F.concat(F.lit("(?i)"), F.col(marker)).alias("_marker"))
    return rows.join(marks, list(block)).where(F.regexp_like("_text", "_marker")).select("dim_id", "ops_id")


def weighted_f1(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row: the F1 scores of the labels weighted by how often each is true, as `f1`, over `n` rows."""
    rows = df.select(F.col(truth).alias("t"), F.col(predicted).alias("p"))
    stats = rows.select(F.explode(F.array(F.struct(F.col("t").alias("label"), F.lit(1).alias("t"), F.lit(0).alias("p"), F.lit(0).alias("h")), F.struct(F.col("p").alias("label"), F.lit(0).alias("t"), F.lit(1).alias("p"), (F.col("t") == F.col("p")).cast("int").alias("h")))).alias("s")).select("s.*")
    per = stats.groupBy("label").agg(F.sum("t").alias("t"), F.sum("p").alias("p"), F.sum("h").alias("h")).where("label is not null")
    return per.agg((F.sum(F.col("t") * 2 * F.col("h") / (F.col("t") + F.col("p"))) / F.sum("t")).alias("f1"), F.sum("t").alias("n"))
