"""Encoding of a corpus with a public byte-level BPE tokenizer.

The vocabulary (token bytes with their ranks) is serialised directly as a sentencepiece BPE model: every byte is mapped
to one character, every token to the string of its characters, scored by its negative rank, without normalisation,
prefix or special pieces, so a piece's number is the token's id. Texts are cut into pre-tokens by the vocabulary's
pattern, each pre-token is encoded on its own, and decoding is the inverse mapping.

A line break before a non-blank is always a pre-token of its own, so the lines between such breaks are encoded apart and
those met before are taken from a bounded cache of ids. The model (about 1 MB, bounded by the vocabulary) is broadcast.

Cases: null and empty texts have an empty list. Long texts are encoded whole, in a batch of their own. Repeated rows are
kept, empty tables give no rows, other columns are dropped, so their names can't clash.
"""

from __future__ import annotations

import base64
import re
import struct
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnfield.llm.forms import char_class
from cairnfield.session import spread

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Characters that the pattern's \s stands for, by the Unicode property White_Space.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PATTERN = f"'s|'t|'re|'ve|'m|'ll|'d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{SPACE}\\p{{L}}\\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
#: The same pattern by the faster standard module: for ASCII lines, and for lines whose numbers are all decimal digits.
ASCII_PATTERN = r" ?[A-Za-z]+| ?[0-9]+|'(?:s|t|re|ve|m|ll|d)| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
DECIMAL_PATTERN = f" ?[^\\W\\d_]+| ?\\d+|'(?:s|t|re|ve|m|ll|d)| ?(?:[^{SPACE}\\w]|_)+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
OTHER_NUMBERS = char_class([c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.category(c) in ("No", "Nl")])
BREAK = re.compile(f"\n(?=[^{SPACE}])")
#: Bytes that stand for themselves; any other byte is mapped to the character so far above it.
PLAIN, BYTE_AT = range(0x20, 0x7F), 0x100
CACHED_LINES, CACHED_PIECES, LINE_CHARS, BATCH_CHARS = 200_000, 400_000, 160, 8_000_000
_TO_CHARS = {b: BYTE_AT + b for b in range(256) if b not in PLAIN}


def read_vocabulary(path: str = VOCABULARY) -> dict[bytes, int]:
    """Token bytes and their ids."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def _field(number: int, payload: bytes | int | float) -> bytes:
    """One protobuf field: a length-delimited one, a varint or a 32-bit float by the payload's type."""

    def varint(n: int) -> bytes:
        n &= (1 << 64) - 1
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes([*out, n])

    if isinstance(payload, bytes):
        return varint(number << 3 | 2) + varint(len(payload)) + payload
    if isinstance(payload, float):
        return varint(number << 3 | 5) + struct.pack("<f", payload)
    return varint(number << 3) + varint(payload)


def _chars(token: bytes) -> str:
    return token.decode("latin-1").translate(_TO_CHARS)


def sentencepiece_model(vocabulary: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model whose piece numbers are the vocabulary's ids; one more piece stands for the unknown."""
    by_id = sorted(vocabulary.items(), key=lambda x: x[1])
    if [i for _, i in by_id] != list(range(len(by_id))):
        raise ValueError("the ids of the vocabulary have gaps")
    normal, unknown, bpe = 1, 2, 2
    pieces = [_field(1, _chars(token).encode()) + _field(2, float(-rank)) + _field(3, normal) for token, rank in by_id]
    pieces.append(_field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown))
    trainer = _field(3, bpe) + _field(4, len(pieces)) + _field(40, len(by_id)) + b"".join(_field(n, -1) for n in (41, 42, 43))
    normalizer = _field(1, b"identity") + b"".join(_field(n, 0) for n in (3, 4, 5))
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encodes texts to ids and back by a serialised model."""

    def __init__(self, model: bytes) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.whole = {self.model.id_to_piece(i): np.int32(i).tobytes() for i in range(self.model.vocab_size() - 1)}
        self.find = regex.compile(PATTERN).findall
        self.find_ascii, self.find_decimal, self.other_number = re.compile(ASCII_PATTERN).findall, re.compile(DECIMAL_PATTERN).findall, re.compile(OTHER_NUMBERS).search
        self.pieces: dict[str, bytes] = {}
        self.lines: dict[str, bytes] = {}
        self.line_break = self._piece("\n")

    def _piece(self, piece: str) -> bytes:
        mapped = piece if piece.isascii() and piece.isprintable() else _chars(piece.encode("utf-8", "replace"))
        found = self.whole.get(mapped)
        if found is None:
            found = np.array(self.model.encode(mapped), np.int32).tobytes()
        if len(self.pieces) >= CACHED_PIECES:
            self.pieces.clear()
        self.pieces[piece] = found
        return found

    def _line(self, line: str) -> bytes:
        known = self.pieces.get
        find = self.find_ascii if line.isascii() else self.find if self.other_number(line) else self.find_decimal
        out = b"".join([known(p) or self._piece(p) for p in find(line)])
        if len(line) <= LINE_CHARS:
            if len(self.lines) >= CACHED_LINES:
                self.lines.clear()
            self.lines[line] = out
        return out

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian 32-bit integers."""
        if not text:
            return b""
        known = self.lines.get
        return self.line_break.join([known(line) or self._line(line) for line in BREAK.split(text)])

    def decode(self, ids: Iterable[int]) -> str:
        """The text of the ids."""
        return b"".join(bytes(ord(c) - BYTE_AT * (ord(c) >= BYTE_AT) for c in self.model.id_to_piece(int(i))) for i in ids).decode("utf-8", "replace")


def _apply(df: DataFrame, columns: list[str], text: str, counts_only: bool, vocabulary: str) -> DataFrame:
    model = df.sparkSession.sparkContext.broadcast(sentencepiece_model(read_vocabulary(vocabulary)))
    df = spread(df.select(*columns, F.col(text).alias("_text")))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for whole in batches:
            codec = codec or Codec(model.value)
            start = 0
            texts = whole.column(whole.num_columns - 1)
            while start < whole.num_rows:
                out, chars, end = [], 0, start
                while end < whole.num_rows and (end == start or chars < BATCH_CHARS):
                    value = texts[end].as_py()
                    chars += len(value or "")
                    out.append(codec.encode(value))
                    end += 1
                sizes = np.fromiter(map(len, out), np.int64, len(out)) // 4
                if counts_only:
                    result = pa.array(sizes)
                else:
                    values = pa.Array.from_buffers(pa.int32(), int(sizes.sum()), [None, pa.py_buffer(b"".join(out))])
                    result = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], sizes.cumsum()]).astype(np.int32)), values)
                kept = whole.slice(start, end - start)
                yield pa.RecordBatch.from_arrays([*kept.columns[:-1], result], names=[*whole.schema.names[:-1], "ids"])
                start = end

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[:-1]]
    return df.mapInArrow(encode, ", ".join([*fields, "ids " + ("bigint" if counts_only else "array<int>")]))


def encode_corpus(df: DataFrame, id_col: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(`id_col`, ids) of every row."""
    return _apply(df, [id_col], text, False, vocabulary)


def token_counts(df: DataFrame, columns: list[str], text: str = "text", vocabulary: str = VOCABULARY, out: str = "tokens") -> DataFrame:
    """The given columns of every row with the number of its text's tokens."""
    return _apply(df, columns, text, True, vocabulary).withColumnRenamed("ids", out)
