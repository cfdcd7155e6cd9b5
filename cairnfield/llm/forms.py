"""Visually identical text with different characters: one form under which such texts compare equal.

A text is scanned for the characters that can make it unstable: those outside the quick-check sets of the canonical
composition, and those this form maps (wide forms, blanks, look-alike letters, hyphens, characters that show nothing).
Only the segments around them, widened to the starters on both sides, are normalised; the rest is spliced in unchanged.

The form: line ends become a line feed, any other blank but a tab becomes a blank, characters that show nothing are
dropped, wide and narrow forms become the ordinary ones, look-alike letters of other alphabets become Latin ones, and
the result is composed canonically. Other compatibility forms (superscripts, ligatures) look different and are kept.

Cases: null stays null, empty stays empty; both are without partners. Long texts are treated whole. Repeated rows give no
pair with themselves. Empty tables give no rows. Only the named columns are used.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnfield.session import cut, spread

#: Letters of other alphabets drawn like a Latin letter, by alphabet, each alphabet's letters and what they become.
LOOK_ALIKE_LETTERS = {
    "Cyrillic small": ("аеорсухіјѕһԁԛԝӏѵ", "aeopcyxijshdqwlv"),
    "Cyrillic capital": ("ҮԌАВЕКМНОРСТХІЈЅԚԜӀѴ", "YGABEKMHOPCTXIJSQWIV"),
    "Greek": ("οϲϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ", "ocjABEZHIKMNOPTYXCJ"),
    "Armenian": ("օսոհցՍՏՕ", "ounhgUSO"),
    "Latin script g": ("ɡ", "g"),
    "Cherokee": ("ᎪᏴᏟᎠᎬᎻᎫᏦᏞᎷᏢᏚᎢᏙᎳᏃ", "ABCDEHJKLMPSTVWZ"),
    "Lisu": ("ꓮꓐꓚꓓꓰꓝꓖꓧꓲꓙꓗꓡꓟꓠꓳꓑꓣꓢꓔꓴꓦꓪꓫꓬꓜ", "ABCDEFGHIJKLMNOPRSTUVWXYZ"),
    "Coptic capital": ("ⲂⲎⲒⲔⲘⲚⲞⲢⲤⲦⲬ", "BHIKMNOPCTX"),
}
LOOK_ALIKES = {a: b for letters, to in LOOK_ALIKE_LETTERS.values() for a, b in zip(letters, to, strict=True)}
#: Hyphens drawn alike, the micro sign and the increment, drawn like Greek letters.
SIGNS = {"‐": "-", "‑": "-", "µ": "μ", "∆": "Δ"}
BLANKS = dict.fromkeys("               　", " ")
#: Format characters that a reader does see.
SHOWN = {chr(c) for r in (range(0x600, 0x606), (0x6DD, 0x70F, 0x890, 0x891, 0x8E2, 0x110BD, 0x110CD)) for c in r}


@cache
def mapping() -> dict[int, str]:
    """What single characters become, apart from composition."""
    table = LOOK_ALIKES | SIGNS | BLANKS
    for c in map(chr, range(sys.maxunicode + 1)):
        kind = unicodedata.category(c)
        if c in table:
            continue
        if (kind == "Cf" and c not in SHOWN) or (kind == "Cc" and c not in "\t\n\r") or "ㅤ" == c or "ᅟ" <= c <= "ᅠ":
            table[c] = ""
        elif unicodedata.decomposition(c).startswith(("<wide>", "<narrow>")):
            ordinary = unicodedata.normalize("NFKC", c)
            table[c] = table.get(ordinary, ordinary)
    return {ord(c): to for c, to in table.items()}


def char_class(chars: list[str]) -> str:
    """A pattern for one of the characters that stays fast: the standard module keeps a bitmap only of the basic plane."""
    spans: list[list[int]] = []
    for c in sorted(map(ord, chars)):
        if spans and spans[-1][1] == c - 1:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    write = lambda picked: "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in picked)
    low, high = [x for x in spans if x[0] < 0x10000], [x for x in spans if x[0] >= 0x10000]
    return "(?:" + "|".join([f"[{write(low)}]"] * bool(low) + [f"(?=[\U00010000-\U0010ffff])[{write(high)}]"] * bool(high)) + ")"


@cache
def _unstable() -> re.Pattern[str]:
    """A run of characters that are mapped, aren't composed, or may combine with the one before."""
    mapped = mapping()
    loose = [chr(c) for c in mapped]
    for c in map(chr, range(0x80, sys.maxunicode + 1)):
        if ord(c) in mapped or 0xD800 <= ord(c) < 0xE000:
            continue
        decomposed = unicodedata.normalize("NFD", c)
        if unicodedata.category(c) in ("Mn", "Mc") or 0x1160 <= ord(c) < 0x1200 or not unicodedata.is_normalized("NFC", c) or any(ord(d) in mapped for d in decomposed):
            loose.append(c)
    return re.compile(char_class(loose) + "+")


def _settle(segment: str) -> str:
    decomposed = unicodedata.normalize("NFD", segment).translate(mapping())
    return unicodedata.normalize("NFC", decomposed)


def canonical(text: str | None) -> str | None:
    """The one form of the text; null stays null."""
    if not text:
        return text
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    parts, done = [], 0
    for found in _unstable().finditer(text):
        start, end = found.span()
        if start > done:  # the starter before the run may combine with it
            start -= 1
        parts += text[done:start], _settle(text[start:end])
        done = end
    return "".join([*parts, text[done:]]) if parts else text


def canonical_corpus(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(`id_col`, form) of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = pa.array([canonical(t) for t in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), forms], names=["id", "form"])

    df = spread(df.select(id_col, text))
    return df.mapInArrow(work, f"id {df.schema[0].dataType.simpleString()}, form string").withColumnRenamed("id", id_col)


def alike(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_a, id_b), id_a < id_b: rows whose non-empty texts differ but have one form. Only ids and 256-bit digests are
    shuffled; the different texts of a form are paired before their copies are added, so copies never meet each other."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, forms, texts = [], [], []
            for i, t in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                raw = t.encode("utf-8", "surrogatepass")
                form = canonical(t)
                ids.append(i)
                texts.append(sha256(raw).digest())
                forms.append(texts[-1] if form is t else sha256(form.encode("utf-8", "surrogatepass")).digest())
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema[0].type), pa.array(forms, pa.binary()), pa.array(texts, pa.binary())], names=["id", "form", "raw"])

    rows = spread(df.where(f"`{text}` <> ''").select(F.col(id_col), F.col(text)))
    marked = rows.mapInArrow(work, f"id {rows.schema[0].dataType.simpleString()}, form binary, raw binary").distinct()
    several = marked.groupBy("form").agg(F.min("raw").alias("a"), F.max("raw").alias("b")).where("a <> b").select("form")
    members = cut(marked.join(several, "form", "left_semi"))
    texts = members.select("form", "raw").distinct()
    pairs = texts.withColumnRenamed("raw", "x").join(texts.withColumnRenamed("raw", "y"), "form").where("x < y")
    one, two = (members.select(F.col("raw").alias(t), F.col("id").alias(i)) for t, i in (("x", "i"), ("y", "j")))
    return pairs.join(one, "x").join(two, "y").select(F.least("i", "j").alias("id_a"), F.greatest("i", "j").alias("id_b"))
