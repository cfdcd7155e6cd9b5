"""Variant spellings of names typed by people: which listed organisation each typed name denotes.

Names are cut into tokens; a token weighs the more the fewer listed names hold it, and legal forms weigh little. The
distinct tokens of both sides are joined by set similarity of their q-grams with prefix filtering: of each token only
the rarest q-grams are indexed, so many that two tokens of the stated similarity must share one. Beside them meet tokens
that are equal, a nickname and its given name, an abbreviation and the words whose letters it has in order (by its first
three), and a word run together with the listed one it starts or ends with. Of these pairs of tokens only those that are
alike stay. A listed name is a candidate where one of the heaviest typed tokens, again as many as the needed share of the
weight demands, has an alike token in it. Candidates are verified by soft weighted token similarity: every token takes its best
partner; the similarity is the weight of what found a partner, both ways, so a rare token without a partner on either side
forbids the match. What people add to names (stores, plants, remarks) is learnt: a word that no listed name has, and that
stands beside the own words of three listed names or more which mostly have nothing alike, weighs little, as do bare numbers.

Typed names with the same tokens are linked once, however many records have them.

Cases: null, blank and filler names denote nothing. A name with the very tokens of one listed name denotes that one; any
other that fits two listed names nearly equally well denotes neither. A typed token of one or two letters makes a name a
candidate only where it equals the listed one. Repeated rows give one row. Empty tables give no rows. Other columns play
no part.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnfield.llm.addresses import distance
from cairnfield.session import cut, parallelism

#: Legal forms and the like, which tell names apart the least.
LEGAL = "company corporation incorporated llc limited holdings group associates and sons international of the"
LEGAL_SHORT = "ll l co comp cmpny corp inc incorp ltd hldgs holding grp gp assoc assocs intl internatl internl l c"
#: Given names and their usual short forms.
NICKNAMES = {
    "abigail": "abby gail", "abraham": "abe", "albert": "al bert", "alexander": "alex al sandy alec xander", "alfred": "al fred alfie", "andrew": "andy drew", "anthony": "tony", "arthur": "art artie", "barbara": "barb babs",
    "benjamin": "ben benny", "bernard": "bernie", "catherine": "cathy kate katie cat", "charles": "charlie chuck chas", "christine": "chris chrissy tina", "christopher": "chris kit topher", "cynthia": "cindy", "daniel": "dan danny",
    "david": "dave davey", "deborah": "deb debbie", "dennis": "denny", "donald": "don donny", "dorothy": "dot dottie dolly", "douglas": "doug", "edward": "ed eddie ted ned", "eleanor": "ellie nell nora", "elizabeth": "liz beth betty eliza lizzie betsy",
    "ernest": "ernie", "eugene": "gene", "florence": "flo", "frances": "fran frannie", "francis": "frank", "francisco": "frank paco pancho cisco", "franklin": "frank", "frederick": "fred freddy rick", "gabriel": "gabe", "george": "geo",
    "gerald": "jerry gerry", "gregory": "greg", "guadalupe": "lupe", "harold": "hal harry", "henry": "hank harry", "ignacio": "nacho", "isabel": "bella izzy", "jacob": "jake", "james": "jim jimmy jamie jas", "janet": "jan", "jeffrey": "jeff",
    "jennifer": "jen jenny", "jeremiah": "jerry", "jesus": "chuy", "john": "jack johnny", "jonathan": "jon", "jose": "pepe", "joseph": "joe joey jos", "joshua": "josh", "judith": "judy", "katherine": "kathy kate katie kat kitty", "kenneth": "ken kenny",
    "kimberly": "kim", "lawrence": "larry lars", "leonard": "len lenny leo", "louis": "lou louie", "manuel": "manny", "margaret": "maggie meg peggy marge", "martin": "marty", "matthew": "matt", "michael": "mike mick mickey", "nancy": "nan",
    "nathaniel": "nate nat", "nicholas": "nick nicky", "oliver": "ollie", "pamela": "pam", "patricia": "pat patty trish tricia", "patrick": "pat paddy", "peter": "pete", "philip": "phil", "rafael": "rafa", "randall": "randy", "raymond": "ray",
    "rebecca": "becky becca", "richard": "rick dick rich ricky", "robert": "bob rob bobby robbie bert", "ronald": "ron ronnie", "rosemary": "rose rosie", "russell": "russ", "samuel": "sam sammy", "sandra": "sandy", "stanley": "stan", "stephanie": "steph",
    "stephen": "steve", "steven": "steve", "susan": "sue susie suzy", "theodore": "ted teddy theo", "theresa": "terry tess", "thomas": "tom tommy", "timothy": "tim timmy", "victor": "vic", "victoria": "vicky vicki tori", "vincent": "vince vinny",
    "virginia": "ginny", "walter": "walt wally", "william": "bill will billy willie wm",
}
NICK: dict[str, set[str]] = {}
for _full, _shorts in NICKNAMES.items():
    for _short in _shorts.split():
        NICK.setdefault(_short, set()).add(_full)
_LEGAL = {*LEGAL.split(), *LEGAL_SHORT.split()}
_CAMEL = re.compile(r"(?<=[a-zà-ɏ]{3})(?=[A-ZÀ-Þ][a-z])")
Q, SIMILAR, NEEDED = 2, 0.3, 0.5
#: How alike tokens are at least to make a name a candidate, and beside how many listed names' own words an addition stands.
ALIKE, BESIDE = 0.7, 3
#: Letters of a word that is abbreviated, at most.
LONGEST = 40
#: In which share of those names an addition has an alike token at most.
MEANT = 0.2


def tokens(name: str | None) -> list[str]:
    """The words and numbers of a name without signs."""
    text = _CAMEL.sub(" ", html.unescape(name or "")).lower()
    text = re.sub(r"\b([a-z])\.\s?(?=[a-z]\b)", r"\1", text)
    text = re.sub(r"\bl\s?l\s?c\b", "llc", text)
    text = re.sub(r"['’]", "", text)
    found = re.findall(r"[^\W_]+", text)
    if "dba" in found:  # the trade name repeats the surname
        at = found.index("dba")
        found = [*found[:at], *[w for w in found[at + 1 :] if w not in found[:at]]]
    return found


def grams(token: Column) -> Column:
    """The distinct q-grams of a token with its ends marked."""
    padded = F.concat(F.lit("^"), token, F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - Q + 1), lambda i: padded.substr(i, F.lit(Q))))


@lru_cache(200_000)
def likeness(a: str, b: str) -> float:
    """How surely token `a`, typed, stands for token `b`, listed."""
    if a == b:
        return 1.0
    if a.isdigit() or b.isdigit():
        return 0.0
    if b in NICK.get(a, ()):
        return 0.97
    if len(a) == 1:
        return 0.8 if b[0] == a else 0.0
    short = min(len(a), len(b))
    most = 0 if short < 4 else 1 if short < 6 else 2
    if most and (d := distance(a, b, most)) <= most:
        return 1 - 0.8 * d / max(len(a), len(b))
    if len(a) < len(b) <= LONGEST and a[0] == b[0]:
        if b.startswith(a):
            return 0.9 if len(a) > 2 else 0.75
        rest = iter(b)
        if len(a) <= len(b) - 2 and all(c in rest for c in a):
            return 0.88 if len(a) > 2 else 0.75
        if len(a) >= 4:  # an abbreviation with a slip
            stem = b[: len(a)]
            if distance(a, stem, 1) <= 1:
                return 0.8
    return 0.0


@lru_cache(200_000)
def is_legal(token: str) -> bool:
    """Whether a typed token is a legal form, one slip allowed."""
    return token in _LEGAL or (len(token) >= 4 and any(distance(token, x, 1) <= 1 for x in _LEGAL if len(x) >= 4))


def split_by(word: str, listed: Sequence[str]) -> tuple[str, str] | None:
    """A word cut in two where it starts or ends with a listed one of five letters or more."""
    for b in listed:
        if len(b) >= 5 and len(word) >= len(b) + 2:
            if word.startswith(b):
                return b, word[len(b) :]
            if word.endswith(b):
                return word[: -len(b)], b
    return None


def soft_similarity(typed: Sequence[str], listed: Sequence[str], weights: dict[str, float], heaviest: float, light: Sequence[str] = ()) -> tuple[float, float]:
    """The share of the listed name's weight that found a typed partner, and the share of the typed weight with a listed one;
    `light` are the typed tokens that weigh little. A number of the listed name must be typed."""
    if any(b.isdigit() and b not in typed for b in listed):
        return 0.0, 0.0
    weigh = lambda t: 0.05 * heaviest if t in _LEGAL else weights.get(t, heaviest)
    words = []
    for w in typed:
        halves = None if w in listed or len(w) < 7 or any(likeness(w, x) >= 0.85 for x in listed) else split_by(w, listed)
        words += halves or [w]
    forward = back = total = all_typed = 0.0
    best = {w: 0.0 for w in words}
    partner = dict.fromkeys(words, "")
    for b in listed:
        w = weigh(b)
        total += w
        score = 0.0
        for a in words:
            s = likeness(a, b)
            score = max(score, s)
            if s > best[a]:
                best[a], partner[a] = s, b
        forward += w * score
    for a in words:
        if is_legal(a):
            continue
        alone = 0.15 if len(a) == 1 else 0.05 if a in light or a.isdigit() else 0.0
        w = weigh(partner[a]) if best[a] >= 0.7 else (alone * heaviest or weights.get(a, heaviest))
        all_typed += w
        back += w * best[a]
    return forward / total if total else 0.0, back / all_typed if all_typed else 0.0


def _tokenised(df: DataFrame) -> DataFrame:
    """(id, tokens) of (id, name)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "tokens": [tokens(n if isinstance(n, str) else None) for n in pdf["name"]]})

    return df.select("id", "name").mapInPandas(work, f"id {df.schema['id'].dataType.simpleString()}, tokens array<string>")


def similar_tokens(left: DataFrame, right: DataFrame, threshold: float = SIMILAR) -> DataFrame:
    """(a, b): pairs of a token of `left` and one of `right` (columns `token`) whose q-gram sets have at least the given
    Jaccard similarity, by prefix filtering: both sides index only their rarest grams."""
    both = left.select("token", F.lit(True).alias("l")).unionByName(right.select("token", F.lit(False).alias("l"))).distinct()
    both = cut(both.withColumn("grams", grams(F.col("token"))))
    rarity = both.select(F.explode("grams").alias("g")).groupBy("g").agg(F.count("*").alias("n"))
    ranked = both.select("token", "l", F.explode("grams").alias("g")).join(rarity, "g").groupBy("token", "l").agg(F.array_sort(F.collect_list(F.struct("n", "g"))).alias("order"))
    size = F.size("order")
    prefix = ranked.select("token", "l", F.explode(F.slice("order", 1, size - F.ceil(F.lit(threshold) * size).cast("int") + 1)).alias("p"))
    sides = [prefix.where("l" if x else "not l").select(F.col("token").alias("a" if x else "b"), F.col("p.g").alias("g")) for x in (True, False)]
    pairs = sides[0].join(sides[1], "g").select("a", "b").distinct()
    of = both.select("token", "grams").distinct()
    met = pairs.join(of.select(F.col("token").alias("a"), F.col("grams").alias("ga")), "a").join(of.select(F.col("token").alias("b"), F.col("grams").alias("gb")), "b")
    shared = F.size(F.array_intersect("ga", "gb"))
    return met.where(shared >= threshold * (F.size("ga") + F.size("gb") - shared)).select("a", "b")


def _abbreviations(left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b): typed tokens of three letters or more and the longer listed ones whose letters start as theirs and have their
    second and third in this order; nicknames and given names; words run together and the listed ones at their ends."""
    word, letters = F.col("token"), F.length("token")
    ahead = lambda i, f: F.transform(F.sequence(i + 1, letters), f)
    pairs = F.flatten(F.transform(F.sequence(F.lit(2), letters - 1), lambda i: ahead(i, lambda j: F.concat(word.substr(1, 1), word.substr(i, F.lit(1)), word.substr(j, F.lit(1))))))
    starts = right.where(f"length(token) between 4 and {LONGEST}").select(word.alias("b"), F.explode(F.array_distinct(pairs)).alias("key"))
    short = left.where("length(token) > 2").select(word.alias("a"), F.left("token", F.lit(3)).alias("key"))
    short = short.join(starts, "key").where("length(a) < length(b)").select("a", "b")
    nick = F.expr(f"explode(map_from_entries(array({', '.join(f"struct('{k}', array({', '.join(repr(v) for v in sorted(full))}))" for k, full in sorted(NICK.items()))}))[token])")
    named = left.where(word.isin(*NICK)).select(word.alias("a"), nick.alias("b")).join(right.select(word.alias("b")), "b").select("a", "b")
    long = right.where("length(token) > 4")
    lengths = long.agg(F.collect_set(F.length("token")).alias("lengths"))
    cuts = F.flatten(F.transform(F.filter("lengths", lambda k: k <= letters - 2), lambda k: F.array(F.left("token", k), F.right("token", k))))
    ends = left.where("length(token) > 6").crossJoin(F.broadcast(lengths)).select(word.alias("a"), F.explode(F.array_distinct(cuts)).alias("b"))
    return short.unionByName(named).unionByName(ends.join(long.select(word.alias("b")), "b").select("a", "b"))


def alike(left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b, s): the alike pairs of a typed token of `left` and a listed one of `right` (columns `token`), and how alike; a
    word run together with a listed one counts as that one."""
    same = left.join(right, "token").select(F.col("token").alias("a"), F.col("token").alias("b"))
    met = same.unionByName(similar_tokens(left.where("length(token) > 2"), right)).unionByName(_abbreviations(left, right)).distinct()

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            scores = [max(likeness(a, b), 1.0 if split_by(a, (b,)) else 0.0) for a, b in zip(pdf["a"], pdf["b"], strict=True)]
            out = pdf.assign(s=scores)
            yield out[out["s"] >= ALIKE]

    return met.repartition(parallelism(left.sparkSession), "a", "b").mapInPandas(work, "a string, b string, s double")


def link(typed: DataFrame, listed: DataFrame, needed: float = NEEDED) -> DataFrame:
    """(typed_id, listed_id, similarity) for (id, name) rows: the listed name that each typed name denotes, if any."""
    parts_n = parallelism(typed.sparkSession)
    listed = cut(_tokenised(listed.distinct()).where("size(tokens) > 0"))
    rendered = cut(_tokenised(typed.where("name is not null").groupBy("name").agg(F.collect_set("id").alias("id")).repartition(parts_n)).where("size(tokens) > 0").withColumn("key", F.array_join("tokens", " ")))
    names = cut(rendered.select("key", "tokens").distinct())
    n = listed.count()
    spread = listed.select("id", F.explode(F.array_distinct("tokens")).alias("token"))
    weight = F.when(F.col("token").isin(list(_LEGAL)), 0.3).otherwise(F.log(1 + F.lit(n) / F.col("df")))
    weights = cut(spread.groupBy("token").agg(F.count("*").alias("df")).select("token", "df", weight.alias("w")))
    own = cut(spread.join(weights, "token").groupBy("id").agg(F.collect_list(F.struct("w", "token")).alias("order")))
    heaviest = float(weights.agg(F.max("w")).first()[0] or 1.0)
    parts = cut(names.select("key", F.explode(F.array_distinct("tokens")).alias("a")))
    near = cut(alike(parts.select(F.col("a").alias("token")).distinct(), weights.select("token")))
    # additions: no listed token, and beside the own words of several listed names that have nothing alike
    strange = parts.where("length(a) > 1 and not a rlike '^[0-9]+$'").join(weights.select(F.col("token").alias("a")), "a", "left_anti")
    rare = weights.where("df = 1 and length(token) > 3").join(spread, "token").select(F.col("token").alias("a"), F.col("id").alias("listed_id"))
    met = cut(strange.join(parts.join(rare, "a").select("key", "listed_id"), "key").select("a", "listed_id").distinct())
    meant = met.join(spread.select(F.col("id").alias("listed_id"), F.col("token").alias("b")), "listed_id").join(near.select("a", "b"), ["a", "b"]).select("a", "listed_id").distinct().groupBy("a").agg(F.count("*").alias("m"))
    beside = met.groupBy("a").agg(F.count("*").alias("k")).join(meant, "a", "left").where((F.col("k") >= BESIDE) & (F.coalesce("m", F.lit(0)) <= MEANT * F.col("k"))).select("a")
    light = strange.join(beside, "a").groupBy("key").agg(F.collect_set("a").alias("light"))
    # typed tokens, the heaviest first, until the rest can't hold three times the weight that they have without a partner
    legal = F.col("a").isin(list(_LEGAL)) | (F.length("a").between(4, LONGEST) & F.exists(F.array(*[F.lit(x) for x in sorted(_LEGAL) if len(x) > 3]), lambda x: F.levenshtein(F.left("a", F.lit(LONGEST)), x) < 3))
    alone = F.when(F.col("legal"), 0.0).when(F.col("a").rlike("^[0-9]+$") | F.col("few"), 0.05 * heaviest).when(F.length("a") == 1, 0.15 * heaviest).otherwise(F.coalesce("w", F.lit(heaviest)))
    most = near.join(weights.select(F.col("token").alias("b"), F.col("w").alias("wb")), "b").groupBy("a").agg(F.max("wb").alias("most"))
    weighed = parts.join(weights.select(F.col("token").alias("a"), "w"), "a", "left").join(beside.withColumn("few", F.lit(True)), "a", "left").join(most, "a", "left")
    weighed = weighed.join(parts.select("a").distinct().where(legal).withColumn("legal", F.lit(True)), "a", "left")
    weighed = weighed.select("key", F.struct(alone.alias("alone"), F.coalesce("most", F.lit(0.0)).alias("most"), "a").alias("x")).groupBy("key").agg(F.reverse(F.array_sort(F.collect_list("x"))).alias("order"))
    weigh = lambda part, c: F.aggregate(part, F.lit(0.0), lambda s, x: s + x[c])
    firsts = F.filter(F.transform("order", lambda x, i: F.when(weigh(F.slice("order", i + 1, F.size("order")), "most") >= 3 * weigh(F.slice("order", F.lit(1), i), "alone"), x["a"])), lambda a: a.isNotNull())
    asked = weighed.select("key", F.explode(firsts).alias("a"))
    candidates = asked.join(near, "a").join(spread.select(F.col("id").alias("listed_id"), F.col("token").alias("b")), "b").select("key", "listed_id").distinct()
    rows = candidates.join(names.join(light, "key", "left").select("key", F.col("tokens").alias("ta"), F.coalesce("light", F.array().cast("array<string>")).alias("light")), "key")
    rows = rows.join(listed.select(F.col("id").alias("listed_id"), F.col("tokens").alias("tb")), "listed_id").join(own.select(F.col("id").alias("listed_id"), "order"), "listed_id")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            scores = []
            for ta, tb, order, few in zip(pdf["ta"], pdf["tb"], pdf["order"], pdf["light"], strict=True):
                forward, back = soft_similarity(list(ta), list(tb), {x["token"]: x["w"] for x in order}, heaviest, list(few))
                scores.append(min(forward, 1.0) * 0.4 + back * 0.6 if forward >= needed and back >= 0.75 else 0.0)
            out = pdf[["key", "listed_id"]].assign(similarity=scores, exact=[list(a) == list(b) for a, b in zip(pdf["ta"], pdf["tb"], strict=True)])
            yield out[out["similarity"] > 0]

    kinds = f"key string, listed_id {listed.schema['id'].dataType.simpleString()}, similarity double, exact boolean"
    scored = cut(rows.select("key", "listed_id", "ta", "tb", "order", "light").repartition(parts_n, "key", "listed_id").mapInPandas(verify, kinds))
    top = scored.groupBy("key").agg(F.max("exact").alias("any"), F.max("similarity").alias("top"))
    close = scored.join(top, "key").where(F.when(F.col("any"), F.col("exact")).otherwise(F.col("similarity") >= F.col("top") - 0.03))
    best = close.groupBy("key").agg(F.max("listed_id").alias("listed_id"), F.max("similarity").alias("similarity"), F.count("*").alias("n")).where("n = 1")
    return best.join(rendered.select("key", F.explode("id").alias("typed_id")), "key").select("typed_id", "listed_id", "similarity").distinct()
