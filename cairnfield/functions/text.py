"""Text expressions: location strings, ids from content, number formats, similarity ratios and text features."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

#: The fields of each location string, in their order.
STRING_FIELDS = {
    "full": ("SOLD_ACCOUNT", "SHIP_ACCOUNT", "TRACK_CODE", "SUB_TRACK_CODE", "DEPARTMENT", "ATTENTION", "SUPPLEMENTAL", "RECEIVER", "STREET_NUM", "STREET", "CITY", "STATE", "ZIP5", "COUNTRY"),
    "no_account": ("TRACK_CODE", "DEPARTMENT", "ATTENTION", "SUPPLEMENTAL", "RECEIVER", "STREET_NUM", "STREET", "CITY", "STATE", "ZIP5", "COUNTRY"),
    "simple": ("DEPARTMENT", "ATTENTION", "SUPPLEMENTAL", "RECEIVER", "STREET_NUM", "STREET", "CITY", "STATE", "ZIP5"),
    "address": ("STREET_NUM", "STREET", "CITY", "STATE", "ZIP5"),
    "ops": ("OPS_STREET", "OPS_SUBLOCATION", "OPS_CITY", "OPS_STATE", "OPS_ZIP5"),
    "ops_no_sublocation": ("OPS_STREET", "OPS_CITY", "OPS_STATE", "OPS_ZIP5"),
    "dnb": ("PHYS_STRT_AD", "PHYS_CTY", "PHYS_ST_ABRV", "PHYS_ZIP5"),
    "keepstock": ("ADDRESS1", "CITY", "PROVINCE", "ZIP5"),
}
ID_FIELDS = ("ORGANIZATION_NAME", "OPS_STREET", "OPS_CITY", "OPS_STATE", "OPS_ZIP5", "OPS_SUBLOCATION")


def joined(*columns: Column | str, sep: str = " ") -> Column:
    """The given texts one after the other, null and empty ones left out."""
    parts = F.array(*[F.col(c) if isinstance(c, str) else c for c in columns])
    return F.array_join(F.filter(parts, lambda x: x.isNotNull() & (x != "")), sep)


def location_string(kind: str) -> Column:
    """The location string of a kind in `STRING_FIELDS`."""
    return joined(*STRING_FIELDS[kind])


def location_tokens(columns: Sequence[str], ignored: Sequence[str] = (), dictionary: dict[str, str] | None = None) -> Column:
    """The distinct lower-case tokens of the given columns, replaced by a dictionary, without ignored ones."""
    tokens = F.split(F.lower(joined(*columns)), r"\s+")
    if dictionary:
        known = F.create_map(*[F.lit(x) for pair in dictionary.items() for x in pair])
        tokens = F.transform(tokens, lambda t: F.coalesce(known[t], t))
    banned = F.array(*map(F.lit, ignored)) if ignored else F.array().cast("array<string>")
    return F.array_distinct(F.filter(tokens, lambda t: (t != "") & ~F.array_contains(banned, t)))


def address_line(*columns: str) -> Column:
    """The trimmed texts of the columns as one line, parted by commas, missing ones left out."""
    return joined(*[F.trim(F.col(c).cast("string")) for c in columns], sep=", ")


def number_street(c: Column) -> Column:
    """(number, street) of an address: a house number that the text starts with (digits, perhaps a letter or a fraction), and
    what follows it up to a word for a part of a site or a comma; null where the text has none."""
    number = F.regexp_extract(c, r"^\s*(\d+[A-Za-z]?(?:\s+\d/\d)?)(?:\s|,|$)", 1)
    rest = F.regexp_replace(c, r"^\s*(\d+[A-Za-z]?(?:\s+\d/\d)?)(?:[\s,]+|$)", "")
    street = F.trim(F.regexp_replace(rest, r"(?i)(,|#|\b(?:suite|ste|unit|apt|apartment|room|rm|floor|dock|door|gate|building|bldg)\b).*$", ""))
    return F.struct(F.nullif(number, F.lit("")).alias("number"), F.nullif(street, F.lit("")).alias("street"))


def content_id(*columns: str) -> Column:
    """A SHA-256 over the texts joined by a blank, nulls as empty: the same for the same content on every run."""
    return F.sha2(F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256)


def title_case(c: Column) -> Column:
    """Every letter that follows no letter in upper case, all others in lower case."""
    spread = F.regexp_replace(F.lower(c), r"(?<![\p{L}])(?=\p{L})", "\u0001")
    parts = F.split(spread, "\u0001")
    return F.concat(parts[0], F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.concat(F.upper(p.substr(1, 1)), p.substr(F.lit(2), F.length(p)))), ""))


def equal_width_bin(c: Column, low: Column | float, high: Column | float, n: int) -> Column:
    """The bin 0 … n-1 of equal widths from `low` to `high`, closed on the left, the highest value in the last."""
    low, high = (x if isinstance(x, Column) else F.lit(float(x)) for x in (low, high))
    return F.when((high > low) & c.isNotNull(), F.least(F.floor((c - low) / (high - low) * n), F.lit(n - 1))).otherwise(F.when(c.isNotNull(), 0)).cast("int")


def edge_bin(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """The label of the interval (edge, next edge] that holds the value; null at or below the first edge, the last one open."""
    out = F.lit(None).cast("string")
    for low, label in zip(edges, labels, strict=True):
        out = F.when(c > low, label).otherwise(out)
    return out


def coordinates(c: Column) -> Column:
    """(lat, lon) of a text '(lon, lat)', 0.0 for what it lacks."""
    number = lambda i: F.coalesce(F.expr("double(null)") if i is None else F.regexp_extract(c, r"\(?\s*(-?\d+(?:\.\d+)?(?:E-?\d+)?)\s*,\s*(-?\d+(?:\.\d+)?(?:E-?\d+)?)", i).try_cast("double"), F.lit(0.0))
    return F.struct(number(2).alias("lat"), number(1).alias("lon"))


def features(c: Column) -> dict[str, Column]:
    """Counts and ratios that describe a text."""
    words = F.filter(F.split(c, r"\s+"), lambda w: w != "")
    size, chars = F.size(words), F.length(c)
    over = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    capitals, unique = F.regexp_count(c, F.lit("[A-Z]")), F.size(F.array_distinct(F.transform(words, F.lower)))
    return {
        "n_chars": chars, "n_capitals": capitals, "capital_ratio": over(capitals, chars), "n_words": size, "n_unique": unique, "unique_ratio": over(unique, size), "n_exclamations": F.regexp_count(c, F.lit("!")),
        "n_questions": F.regexp_count(c, F.lit(r"\?")), "n_punctuation": F.regexp_count(c, F.lit("[.,;:]")), "n_symbols": F.regexp_count(c, F.lit("[*&$%]")), "n_smileys": F.regexp_count(c, F.lit(r"[:;]-?\)")), "mean_word": over(F.aggregate(words, F.lit(0), lambda s, w: s + F.length(w)), size),
    }


def longest_common(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bits."""
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | 1 << i
    mask = full = (1 << len(a)) - 1
    for ch in b:
        hit = mask & places.get(ch, 0)
        mask = ((mask + hit) | (mask - hit)) & full
    return len(a) - mask.bit_count()


def ratio_of(a: str, b: str) -> int:
    """Similarity 0 … 100 by insertions and deletions."""
    whole = len(a) + len(b)
    return round(200 * longest_common(a, b) / whole) if whole else 100


def token_set_ratio_of(a: str, b: str) -> int:
    """The best ratio between the common words and the common words with either side's others."""
    x, y = set(a.split()), set(b.split())
    both = " ".join(sorted(x & y))
    ones = [" ".join(filter(None, [both, " ".join(sorted(d))])) for d in (x - y, y - x)]
    if both and (not x - y or not y - x):
        return 100
    return max(ratio_of(*ones), *([ratio_of(both, one) for one in ones] if both else [0]))


@F.pandas_udf(IntegerType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """`ratio_of` by rows; null where either is."""
    return pd.Series([None if x is None or y is None else ratio_of(x, y) for x, y in zip(a, b, strict=True)], dtype="Int32")


@F.pandas_udf(IntegerType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """`token_set_ratio_of` by rows; null where either is."""
    return pd.Series([None if x is None or y is None else token_set_ratio_of(x, y) for x, y in zip(a, b, strict=True)], dtype="Int32")
