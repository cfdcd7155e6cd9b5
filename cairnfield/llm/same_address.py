"""Same postal address written differently: which address records denote the same location.

Every record is parsed to house number, direction, words of the street's name, suffix and the listed city it means; what
people add to an address is learnt from the records themselves. Forms are the distinct (number, city, name). MinHash
banding over their token shingles (number, city) and the q-gram shingles of the name gives the candidates: a band is the
number, the city and one minimum over the name's q-grams, so forms that share a number and a city and two fifths of their
q-grams miss each other once in thousands. In a band's bucket every form is held against the bucket's most frequent one;
only forms that don't agree with it are held against all others, which gives the same components as all pairs would.
Candidates are verified by an affine-gap alignment of their tokens (number, direction, words, suffix in the ways seen),
whose substitution costs know the dictionaries of abbreviations, with words that were run together. Components of verified
forms are one street name; its records are one location where direction and suffix agree too, a missing one being filled
where the component has only one.

The city reference is sent to every task while it has at most `INDEX_ROWS` rows; a larger one is met by joins on the
q-grams of its names, with the same answers.

Cases: records without a house number (or box number) or without any city denote nothing and have no partner. A suffix
that is missing where the street name has several suffixes is left open, so such records only pair among themselves.
Nulls and blanks are missing parts. Repeated rows count once. Empty tables give no rows. Other columns play no part.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnfield.llm import addresses
from cairnfield.llm.addresses import CityIndex, Lexicon
from cairnfield.operators.components import components
from cairnfield.session import cut, parallelism, spread

#: Rows of the city reference up to which it is sent to every task.
INDEX_ROWS = 200_000
#: The least share of the rows that a learnt word or text is in, which bounds their number.
LEARNT_SHARE, LEARNT_ROWS = 1e-4, 3
BANDS, Q = 16, 2
#: Rows of one location and task for which pairs are made.
HOT_ROWS = 2_000
PARTS = "number string, direction string, name string, suffix string, words string"


def _plain(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(F.lower(c), ".'’", ""), "[^a-z0-9#&À-ɏ]+", " "))


def learn(df: DataFrame, street: str, others: Sequence[str] = ()) -> Lexicon:
    """The words that follow a kind of road in streets four times as often as they stand before one, and the texts without
    a number that fill the other fields, each in at least `LEARNT_SHARE` of the rows."""
    roads = sorted(k for k, v in addresses.SUFFIX_OF.items() if v in addresses.ROADS)
    lines = df.select(F.split(F.translate(F.lower(street), ".'’", ""), "[^a-z0-9#&À-ɏ]+").alias("words"))
    marked = lines.select("words", F.array_position(F.transform("words", lambda w, i: (i > 0) & w.isin(roads)), True).cast("int").alias("at")).where("at > 0")
    known = F.transform("words", lambda w, i: F.when(i + 1 != F.col("at"), F.struct(w.alias("text"), (i + 1 > F.col("at")).cast("int").alias("tail"))))
    words = marked.select(F.explode(known).alias("x")).select("x.*").groupBy("text").agg(F.sum("tail").alias("n"), F.count("*").alias("all")).where(r"not text rlike '\\d|^.?$'").select(F.lit("w").alias("kind"), "text", "n", "all")
    counted = words
    if others:
        texts = df.select(F.explode(F.array(*others)).alias("raw")).where("raw <> ''").groupBy("raw").agg(F.count("*").alias("n"))
        texts = texts.select(_plain(F.col("raw")).alias("text"), "n").where(r"text <> '' and not text rlike '\\d' and length(text) < 100").groupBy("text").agg(F.sum("n").alias("n"))
        counted = words.unionByName(texts.select(F.lit("f").alias("kind"), "text", "n", F.col("n").alias("all")))
    least = df.agg(F.greatest(F.lit(LEARNT_ROWS), F.count("*") * LEARNT_SHARE).alias("least"))
    found = counted.crossJoin(F.broadcast(least)).where("n >= least and n > 0.8 * all").select("kind", "text").collect()
    return Lexicon(*(frozenset(r["text"] for r in found if r["kind"] == k and r["text"] not in addresses.DIRECTION_OF) for k in "wf"))


#: The index of the last reference a worker met: its process serves many tasks.
_HELD: dict[str, CityIndex] = {}


def _by_index(rows: DataFrame, listed: list[tuple], schema: str, work_on) -> DataFrame:
    shared, mark = rows.sparkSession.sparkContext.broadcast(listed), uuid.uuid4().hex

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = _HELD.get(mark)
        if index is None:
            _HELD.clear()
            index = _HELD[mark] = CityIndex(shared.value)
        for pdf in batches:
            yield work_on(pdf, index)

    return spread(rows).mapInPandas(work, schema)


def _asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Typed cities with their name, the state word at their end and the name without it."""
    for pdf in batches:
        out = []
        for city in pdf["city"]:
            words = addresses.city_words(city)
            out.append(("".join(words), words[-1].upper() if len(words) > 1 else "", "".join(words[:-1])))
        yield pdf.assign(**dict(zip(("whole", "tail", "rest"), map(list, zip(*out, strict=True)) if out else ([], [], []), strict=True)), zip=pdf["code"].map(addresses.zip_form))


def _listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pdf.assign(name=["".join(addresses.city_words(c)) for c in pdf["CITY"]], s=pdf["STATE"].str.strip().str.upper())[["s", "name", "ZIP5"]]


def _grams(c: str) -> Column:
    """The 2-grams of a name with its ends marked, numbered where they repeat."""
    padded = F.concat(F.lit("^"), c, F.lit("$"))
    grams = F.transform(F.sequence(F.lit(1), F.length(padded) - 1), lambda i: padded.substr(i, F.lit(2)))
    return F.transform(grams, lambda g, i: F.concat(g, F.size(F.filter(F.slice(grams, 1, i), lambda h: h == g)).cast("string")))


def _rate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for name, code, listed, zips in zip(pdf["name"], pdf["zip"], pdf["city_name"], pdf["zips"], strict=True):
            most = addresses.slips(name)
            edits = addresses.distance(name, listed, most)
            out.append(addresses.rated(edits, code, set(zips)) if edits <= most else (99.0, 99))
        yield pdf[["city", "state", "code", "s", "city_name"]].assign(score=[float(x[0]) for x in out], edits=[x[1] for x in out])


def _by_joins(asked: DataFrame, zips: DataFrame) -> DataFrame:
    """(city, state, code, place) of the distinct typed triples, by joins with a reference of any size: the candidates of a
    name with at most k edits share one of its 3k + 1 rarest 2-grams, as an edit changes three of them at most."""
    keys = ["city", "state", "code"]
    cities = cut(zips.where("CITY is not null and STATE is not null").select("ZIP5", "CITY", "STATE").mapInPandas(_listed, "s string, name string, ZIP5 string").distinct())
    cities = cut(cities.groupBy("s", "name").agg(F.collect_set(F.when(F.col("ZIP5") != "", F.col("ZIP5"))).alias("zips")))
    states = cities.where("s <> ''").select(F.col("s").alias("tail"), F.lit(True).alias("known")).distinct()
    typed = asked.mapInPandas(_asked, "city string, state string, code string, whole string, tail string, rest string, zip string")
    typed = typed.join(states, "tail", "left").withColumn("ends", F.col("known") & ((F.col("state") == "") | (F.col("state") == F.col("tail"))))
    typed = typed.select(*keys, "zip", F.when(F.col("ends"), F.col("rest")).otherwise(F.col("whole")).alias("name"), F.when(F.col("ends") & (F.col("state") == ""), F.col("tail")).otherwise(F.col("state")).alias("own"))
    typed = cut(typed.join(cities.select(F.col("s").alias("own"), F.lit(True).alias("listed")).distinct(), "own", "left"))
    # without a name the only city of the zip
    of_zip = cities.select("s", F.col("name").alias("city_name"), "zips", F.explode("zips").alias("zip"))
    bare = typed.where("name = ''").join(of_zip, "zip", "left").where("s is null or own = '' or s = own").groupBy(*keys).agg(F.count_distinct("s", "city_name").alias("n"), F.min(F.concat_ws("|", "s", "city_name")).alias("only"))
    bare = typed.where("name = ''").select(*keys).join(bare, keys, "left").select(*keys, F.when(F.col("n") == 1, F.col("only")).otherwise("").alias("place"))
    named = typed.where("name <> ''")
    lost = named.where("listed is null")
    near = lost.join(of_zip, "zip").select(*keys, "name", "zip", "s", "city_name", "zips").unionByName(lost.join(cities.select("s", F.col("name").alias("city_name"), "zips"), F.col("name") == F.col("city_name")).select(*keys, "name", "zip", "s", "city_name", "zips"))
    near = cut(near.distinct())
    everywhere = lost.join(near.select(*keys).distinct(), keys, "left_anti").withColumn("block", F.lit("*"))
    blocked = named.where("listed").withColumn("block", F.col("own")).select(*keys, "name", "zip", "block").unionByName(everywhere.select(*keys, "name", "zip", "block"))
    index = cities.select("s", "name", F.explode(_grams("name")).alias("gram"))
    index = cut(index.select("s", F.col("name").alias("city_name"), "gram", F.explode(F.array(F.col("s"), F.lit("*"))).alias("block")))
    rarity = index.where("block = '*'").groupBy("gram").agg(F.count("*").alias("n"))
    slips = F.when(F.length("name") < 6, 1).when(F.length("name") < 9, 2).otherwise(3)
    grams = blocked.select("*", F.explode(_grams("name")).alias("gram")).join(rarity, "gram", "left")
    # a name so short that no gram need be shared is met by every name of its length
    ordered = grams.groupBy(*keys, "name", "zip", "block").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))).alias("order"))
    probes = ordered.select(*keys, "name", "zip", "block", F.explode(F.slice("order", F.lit(1), 3 * slips + 1)).alias("g")).select(*keys, "name", "zip", "block", F.col("g.gram").alias("gram"))
    met = probes.join(index, ["block", "gram"]).select(*keys, "name", "zip", "s", "city_name")
    short = blocked.where("length(name) < 3").join(cities.where("length(name) < 4").select("s", F.col("name").alias("city_name"), F.explode(F.array(F.col("s"), F.lit("*"))).alias("block")), "block").select(*keys, "name", "zip", "s", "city_name")
    met = met.unionByName(short).distinct().join(cities.select("s", F.col("name").alias("city_name"), "zips"), ["s", "city_name"]).unionByName(near.select("s", "city_name", *keys, "name", "zip", "zips"))
    rated = met.mapInPandas(_rate, "city string, state string, code string, s string, city_name string, score double, edits long").where("edits < 99")
    best = rated.groupBy(*keys).agg(F.min(F.struct("score", "edits")).alias("b"))
    firsts = rated.join(best, keys).where("score = b.score and edits = b.edits").groupBy(*keys).agg(F.count("*").alias("n"), F.min(F.concat_ws("|", "s", "city_name")).alias("only"))
    found = named.join(firsts, keys, "left").select(*keys, F.when(F.col("n") == 1, F.col("only")).otherwise(F.concat_ws("|", "own", "name")).alias("place"))
    return bare.unionByName(found)


def parsed(df: DataFrame, zips: DataFrame, id_col: str, street: str, city: str, state: str | None, code: str, number: str | None = None, others: Sequence[str] = (), lexicon: Lexicon = addresses.NOTHING) -> DataFrame:
    """(id, number, direction, name, suffix, words, place, zip) of every row; '' where a part is missing."""
    none = F.lit(None).cast("string")
    pick = lambda c: F.col(c) if c else none
    rows = df.select(
        F.col(id_col).alias("id"), pick(street).alias("street"), pick(number).alias("number"), F.coalesce(pick(city), F.lit("")).alias("city"), F.coalesce(F.upper(F.trim(pick(state))), F.lit("")).alias("state"), F.coalesce(pick(code), F.lit("")).alias("code"),
        *[F.col(c).alias(f"other{i}") for i, c in enumerate(others)],
    )
    listed = zips.select("ZIP5", "CITY", "STATE").distinct()
    found = listed.limit(INDEX_ROWS + 1).collect()
    n, wide = len(others), len(found) > INDEX_ROWS

    def parts(pdf: pd.DataFrame, index: CityIndex | None) -> pd.DataFrame:
        text = pdf.astype(object).where(pdf.notna(), None)
        out = []
        for row in zip(*[text[c] for c in text.columns[1:]], strict=True):
            a = addresses.parse(row[0], row[1], row[5 : 5 + n], lexicon)
            out.append((a.number, a.direction, a.name, a.suffix, a.words, *row[2:5]) if index is None else (a.number, a.direction, a.name, a.suffix, a.words, index.find(*row[2:5]), addresses.zip_form(row[4])))
        got = pd.DataFrame(out, columns=["number", "direction", "name", "suffix", "words", *(("city", "state", "code") if index is None else ("place", "zip"))])
        got.insert(0, "id", pdf["id"].to_numpy())
        return got

    kind = rows.schema["id"].dataType.simpleString()
    if not wide:
        return _by_index(rows, [tuple(r) for r in found], f"id {kind}, {PARTS}, place string, zip string", parts)
    places = _by_joins(cut(rows.select("city", "state", "code").distinct()), listed)
    split = spread(rows).mapInPandas(lambda batches: (parts(pdf, None) for pdf in batches), f"id {kind}, {PARTS}, city string, state string, code string")
    code_form = F.coalesce(F.lpad(F.nullif(F.regexp_extract("code", r"^\s*(\d{4,5})(?:-\d{4})?\s*$", 1), F.lit("")), 5, "0"), F.lit(""))
    # a place that many rows name is spread over copies of its answer
    salted = split.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(8)))
    answers = places.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))))
    return salted.join(answers, ["city", "state", "code", "salt"]).select("id", "number", "direction", "name", "suffix", "words", "place", code_form.alias("zip"))


@lru_cache(100_000)
def _gram_hashes(gram: str) -> np.ndarray:
    return _mixed(np.uint64(zlib.crc32(gram.encode())) ^ (np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))


def minhash(name: str) -> np.ndarray:
    """The minimum of every band's hash over the q-gram shingles of a name."""
    padded = f"^{name}$"
    return np.minimum.reduce([_gram_hashes(padded[i : i + Q]) for i in range(len(padded) - Q + 1)]).view(np.int64)


@lru_cache(200_000)
def _substitution(a: str, b: str) -> float:
    """Cost of reading one token for another: none within a dictionary, else by the edits; numbers must agree. A token may
    state alternatives parted by a slash."""
    if "/" in a or "/" in b:
        return min(_substitution(x, y) for x in a.split("/") for y in b.split("/"))
    if a == b or any(table.get(a, a) == table.get(b, b) for table in (addresses.SUFFIX_OF, addresses.DIRECTION_OF, addresses.CITY_WORD_OF)):
        return 0.0
    if [c for c in a if c.isdigit()] != [c for c in b if c.isdigit()]:
        return 9.0
    most = 0 if min(len(a), len(b)) < 3 else 1 if min(len(a), len(b)) < 5 else 2 if min(len(a), len(b)) < 8 else 3
    edits = addresses.distance(a, b, most)
    return edits / 4 if edits <= most else 9.0


def _together(x: str, y: str, whole: str) -> float:
    """Cost of reading two tokens as one that runs them together, with slips only where both are longer than a letter or two."""
    cost = _substitution(x + y, whole)
    return 0.1 + cost if cost == 0 or min(len(x), len(y)) > 2 else 9.0


#: Cost of leaving out a direction or a suffix, which people often do.
OMITTED = 0.3


def align(a: Sequence[str], b: Sequence[str], gap_open: float = 1.0, gap_more: float = 0.5) -> float:
    """Cost of the best alignment of two token sequences with affine gaps; two tokens may also stand for one that runs them
    together."""
    inf = float("inf")
    first = lambda t: min(gap_open, OMITTED) if (u := t.split("/")[0]) in addresses.DIRECTION_OF or addresses.SUFFIX_OF.get(u) in addresses.ROADS else gap_open
    best = [[inf] * (len(b) + 1) for _ in range(len(a) + 1)]
    down, across = ([[inf] * (len(b) + 1) for _ in range(len(a) + 1)] for _ in range(2))
    best[0][0] = 0.0
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if i:
                down[i][j] = min(best[i - 1][j] + first(a[i - 1]), down[i - 1][j] + min(gap_more, first(a[i - 1])))
            if j:
                across[i][j] = min(best[i][j - 1] + first(b[j - 1]), across[i][j - 1] + min(gap_more, first(b[j - 1])))
            here = min(best[i][j], down[i][j], across[i][j])
            if i and j:
                here = min(here, best[i - 1][j - 1] + _substitution(a[i - 1], b[j - 1]))
                if i > 1:
                    here = min(here, best[i - 2][j - 1] + _together(a[i - 2], a[i - 1], b[j - 1]))
                if j > 1:
                    here = min(here, best[i - 1][j - 2] + _together(b[j - 2], b[j - 1], a[i - 1]))
            best[i][j] = here
    return best[-1][-1]


#: The highest cost of an alignment that still denotes one street.
ACCEPT = 0.8


@lru_cache(100_000)
def agree(a: str, b: str) -> bool:
    """Whether two forms, their tokens parted by tabs with the city last, denote one street."""
    x, y = a.split("\t"), b.split("\t")
    return x[-1] == y[-1] and align(x[:-1], y[:-1]) <= ACCEPT


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        keep = [agree(a, b) for a, b in zip(pdf["ta"], pdf["tb"], strict=True)]
        yield pdf.loc[keep, ["a", "b"]]


def _banded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    bands = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for pdf in batches:
        low = np.array([minhash(x) for x in pdf["name"]], np.int64).reshape(len(pdf), BANDS).view(np.uint64)
        bucket = _mixed(_mixed(low ^ bands) ^ pdf["block"].to_numpy().view(np.uint64)[:, None]).view(np.int64)
        yield pd.DataFrame({"bucket": bucket.ravel(), "node": np.repeat(pdf["node"].to_numpy(), BANDS), "n": np.repeat(pdf["n"].to_numpy(), BANDS)})


def candidates(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bucket, node, n) of the nodes (number, place, name, node, n) in the bands' buckets, and (bucket, leader) of the
    buckets that hold several. Equal buckets of different blocks would be an accident, which the verification undoes."""
    several = nodes.groupBy("number", "place").agg(F.count("*").alias("k")).where("k > 1").select("number", "place")
    rows = nodes.join(several, ["number", "place"], "left_semi").select("name", F.xxhash64("number", "place").alias("block"), "node", "n")
    members = cut(rows.mapInPandas(_banded, "bucket long, node long, n long"))
    leaders = members.groupBy("bucket").agg(F.max_by("node", F.struct("n", "node")).alias("leader"), F.count("*").alias("k")).where("k > 1").select("bucket", "leader")
    return members, leaders


def same_street(nodes: DataFrame) -> DataFrame:
    """(vertex, component) of the nodes (number, place, name, tokens, node, n) that have a verified neighbour; `node` is a
    number, stable as the nodes are a checkpoint."""
    n = parallelism(nodes.sparkSession)
    members, leaders = candidates(nodes)
    led = cut(members.join(leaders, "bucket").where("node <> leader").select("bucket", "node", "leader"))
    text = lambda k, t: nodes.select(F.col("node").alias(k), F.col("tokens").alias(t))
    verified = lambda pairs: pairs.join(text("a", "ta"), "a").join(text("b", "tb"), "b").repartition(n, "a", "b").mapInPandas(_verify, "a long, b long")
    first = cut(verified(led.select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()))
    loose = led.join(first.select(F.col("a").alias("node"), F.col("b").alias("leader")), ["node", "leader"], "left_anti").select("bucket", F.col("node").alias("a"))
    pairs = loose.join(members.select("bucket", F.col("node").alias("b")), "bucket").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return components(first.unionByName(verified(pairs)))


def _fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The direction and suffix that each combination of a component stands for, where that is another one."""
    for pdf in batches:
        rows = []
        for component, seen in zip(pdf["component"], pdf["seen"], strict=True):
            for d, s in ((x["direction"], x["suffix"]) for x in seen):
                suffixes = Counter()
                for x in seen:
                    if x["suffix"] and (not d or not x["direction"] or x["direction"] == d):
                        suffixes[x["suffix"]] += x["n"]
                s2 = s or (next(iter(suffixes)) if len(suffixes) == 1 else "")
                directions = {x["direction"] for x in seen if x["direction"] and (not s2 or not x["suffix"] or x["suffix"] == s2)}
                d2 = d or (next(iter(directions)) if len(directions) == 1 else "")
                if (d2, s2) != (d, s):
                    rows.append((component, d, s, d2, s2))
        yield pd.DataFrame(rows, columns=["component", "direction", "suffix", "direction2", "suffix2"])


def forms(stated: DataFrame) -> DataFrame:
    """(number, place, name, tokens, n, node) of the distinct forms of the parsed rows, with the words as most often written,
    all directions and suffixes seen with them, and a number each; a checkpoint, so the numbers stay."""
    ways = stated.groupBy("number", "place", "name", "words").agg(F.count("*").alias("m"), F.collect_set(F.nullif("direction", F.lit(""))).alias("d"), F.collect_set(F.nullif("suffix", F.lit(""))).alias("s"))
    every = lambda c: F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))), "/")
    out = ways.groupBy("number", "place", "name").agg(F.sum("m").alias("n"), every("d").alias("d"), every("s").alias("s"), F.max_by("words", F.struct("m", "words")).alias("words"))
    tokens = F.array_join(F.filter(F.array("number", "d", F.replace("words", F.lit(" "), F.lit("\t")), "s", "place"), lambda t: t != ""), "\t")
    return cut(out.select("number", "place", "name", "n", tokens.alias("tokens"), F.monotonically_increasing_id().alias("node")))


def locations(rows: DataFrame) -> DataFrame:
    """(id, location) of the parsed rows that denote a location; equal exactly where they denote the same one."""
    stated = cut(rows.where("number <> '' and name <> '' and place <> ''").select("id", "number", "place", "name", "direction", "suffix", "words"))
    nodes = forms(stated)
    merged = nodes.select("number", "place", "name", "node").join(same_street(nodes).withColumnRenamed("vertex", "node"), "node", "left").select("number", "place", "name", F.coalesce("component", "node").alias("component"))
    known = cut(stated.join(merged, ["number", "place", "name"]).select("id", "component", "direction", "suffix"))
    combos = known.groupBy("component", "direction", "suffix").agg(F.count("*").alias("n")).groupBy("component").agg(F.collect_list(F.struct("direction", "suffix", "n")).alias("seen")).where("size(seen) > 1")
    filled = combos.mapInPandas(_fill, "component long, direction string, suffix string, direction2 string, suffix2 string")
    full = known.join(filled, ["component", "direction", "suffix"], "left")
    return full.select("id", F.concat_ws("\t", "component", F.coalesce("direction2", "direction"), F.coalesce("suffix2", "suffix")).alias("location")).distinct()


def classes(found: DataFrame) -> DataFrame:
    """(id, class_id, n_links) of the ids of `locations`: the smallest id of each location and how many others it has."""
    of = found.groupBy("location").agg(F.min("id").alias("class_id"), (F.count("*") - 1).alias("n_links"))
    return found.join(of, "location").select("id", "class_id", "n_links")


def pairs(found: DataFrame) -> DataFrame:
    """(id_a, id_b), id_a < id_b, of the ids of each location; a large location is made by as many tasks as its rows need."""
    found = cut(found)
    several = found.groupBy("location").agg(F.count("*").alias("m")).where("m > 1")
    several = several.select("location", "m", F.xxhash64("location", F.lit(1)).alias("k"))
    members = cut(found.join(several, "location").select("id", "location", "k", "m"))
    parts = F.ceil(F.col("m") / HOT_ROWS).cast("int")
    a = members.select(F.col("id").alias("id_a"), "k", "location", F.pmod(F.xxhash64("id"), parts).cast("int").alias("salt"))
    b = members.select(F.col("id").alias("id_b"), "k", F.col("location").alias("_l"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("salt"))
    return a.join(b, ["k", "salt"]).where("location = _l and id_a < id_b").select("id_a", "id_b")
