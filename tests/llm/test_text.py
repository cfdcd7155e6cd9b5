import random
import unicodedata

import numpy as np
import pytest

from cairnfield.llm import forms, mixing, tokens

pytestmark = pytest.mark.filterwarnings("ignore")


@pytest.fixture(scope="module")
def codec():
    return tokens.Codec(tokens.sentencepiece_model(tokens.read_vocabulary()))


def ids(codec, text):
    return memoryview(codec.encode(text)).cast("i").tolist() if codec.encode(text) else []


def reference():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(tokens.VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


TEXTS = ["", "a", "Hello, world! it's we'll I'M x² ½ Ⅻ", "\n\n\n a\n\n  b \n\tc\r\n d\n\n", " " * 70 + "x", "a" * 4000, "日本語 テキスト 🚚🚚\n x", "\n", "x\n", "<|endoftext|>", "naïve µ-scale é ​­\x00\x1b[31m", "iVBORw0KGgo" * 300, "_a_b__c 1_2"]


def test_ids_equal_the_public_tokenizer(codec):
    encode = reference()
    rng = random.Random(1)
    alphabet = "ab cZ09'\"\n\t .,_-²µéß日🚚​́½\r#%"
    for text in [*TEXTS, *("".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(1500))]:
        assert ids(codec, text) == encode(text), text
        assert codec.decode(ids(codec, text)) == text


def test_corpus_encoding_and_counts(spark):
    rows = [(i, t, "z") for i, t in enumerate(TEXTS)] + [(99, None, "z"), (99, None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encode = reference()
    got = sorted((r.doc_id, list(r.ids)) for r in tokens.encode_corpus(df).collect())
    assert got == sorted((i, encode(t) if t else []) for i, t, _ in rows)
    counts = {r.doc_id: r.tokens for r in tokens.token_counts(df, ["doc_id"]).collect()}
    assert counts == {i: len(x) for i, x in got}
    assert tokens.encode_corpus(df.limit(0)).count() == 0


def full_form(text):
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", text).translate(forms.mapping()))


def test_forms_equal_whole_text_normalisation():
    rng = random.Random(2)
    alphabet = [chr(c) for c in [*range(0x20, 0x7F), 0x300, 0x301, 0x327, 0x308, 0x435, 0x451, 0x438, 0x306, 0xAC00, 0x1100, 0x1161, 0x11A8, 0x3099, 0x304B, 0xFF76, 0xFF9E, 0x200B, 0xAD, 0xA0, 0x212B, 0x3000, 0xFF21, 10, 13, 9, 0xE9, 0x1B, 0x323, 0x344, 0x958, 0x1D15E]]
    for _ in range(30000):
        text = "".join(rng.choices(alphabet, k=rng.randrange(1, 9)))
        form = forms.canonical(text)
        assert form == full_form(text) and forms.canonical(form) == form, ascii(text)


@pytest.mark.parametrize(("a", "b", "same"), [
    ("ｆｕｌｌ　１", "full 1", True), ("été", "été", True), ("a​b­c﻿", "abc", True), ("x y z", "x y z", True), ("раssроrt", "passport", True), ("Å K µ", "Å K μ", True), ("a\r\nb", "a\nb", True),
    ("non‑break", "non-break", True), ("x²", "x2", False), ("cafe", "café", False), ("Case", "case", False), ("a b", "a  b", False), ("l1", "I1", False), ("O", "0", False), ("ﬁ", "fi", False), ("а́", "á", True), ("ё", "ë", True), ("a\tb", "a b", False), ("ß", "ss", False),
])
def test_what_looks_the_same(a, b, same):
    assert (forms.canonical(a) == forms.canonical(b)) is same


def test_alike_pairs(spark):
    rows = [(1, "pass"), (2, "раss"), (3, "pаss"), (4, "pass"), (5, None), (6, ""), (7, "​"), (8, "x" * 300000), (9, "x" * 300000 + "​"), (9, "x" * 300000 + "​")]
    df = spark.createDataFrame([(i, t, b"q") for i, t in rows], "doc_id long, text string, form binary")
    got = {(r.doc_id_a, r.doc_id_b) for r in forms.alike(df).toDF("doc_id_a", "doc_id_b").collect()}
    assert got == {(1, 2), (1, 3), (2, 3), (2, 4), (3, 4), (8, 9)}
    assert forms.alike(df).count() == 6 and forms.alike(df.limit(0)).count() == 0
    out = {r.doc_id: r.form for r in forms.canonical_corpus(df).collect()}
    assert out[5] is None and out[6] == "" and out[7] == "" and out[2] == "pass"


def test_flight_keeps_totals():

    sizes = np.random.default_rng(3).integers(1, 2000, 500)
    p = np.full(500, 0.37)
    out = mixing.flight(sizes, p, np.random.default_rng(4))
    assert ((out < 1e-9) | (out > 1 - 1e-9)).sum() >= 498
    assert abs((out * sizes).sum() - (p * sizes).sum()) < 1e-6 * sizes.sum() and abs(out.sum() - p.sum()) < 1e-6
    draws = np.mean([mixing.flight(sizes[:30], p[:30], np.random.default_rng(s), True) for s in range(600)], axis=0)
    assert np.abs(draws - 0.37).max() < 0.09  # the probabilities are kept


@pytest.mark.parametrize("bucket", [20000, 40])
def test_mixture_reaches_its_shares(spark, bucket):
    rng = random.Random(6)
    rows = [(i, "big", rng.randrange(5, 400)) for i in range(600)] + [(1000 + i, "small", rng.randrange(5, 400)) for i in range(40)] + [(2000, "big", 0), (2001, None, 50), (2002, "other", 9)]
    sizes = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, source string, tokens long, repeats string")
    targets = spark.createDataFrame([(1, "big", 0.7, 1), (1, "small", 0.3, 3), (2, "big", 0.5, 2), (2, "gone", 0.5, 4), (3, "gone", 1.0, 1)], "mix_id int, source string, target_share double, max_repeats int")
    mixed = mixing.mixture(sizes, targets, bucket_docs=bucket)
    found = mixed.collect()
    caps = {(1, "big"): 1, (1, "small"): 3, (2, "big"): 2}
    assert {(r.mix_id, r.source) for r in found} == set(caps) and all(1 <= r.repeats <= caps[r.mix_id, r.source] for r in found)
    assert len({(r.mix_id, r.doc_id) for r in found}) == len(found)
    got = {(r.mix_id, r.source): r.actual_share for r in mixing.shares(mixed, targets).collect()}
    assert abs(got[1, "big"] - 0.7) < 0.01 and abs(got[1, "small"] - 0.3) < 0.01 and got[2, "big"] == 1.0 and got[2, "gone"] == 0.0 and got[3, "gone"] is None
    assert sorted(map(tuple, found)) == sorted(map(tuple, mixing.mixture(sizes, targets, bucket_docs=bucket).collect()))
    assert mixing.mixture(sizes.limit(0), targets).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_landing_misses_by_little(seed):
    rng = np.random.default_rng(seed)
    sizes = np.concatenate([rng.integers(50, 900, 400), rng.integers(20_000, 60_000, 6)])
    p = np.full(len(sizes), rng.uniform(0.2, 0.8))
    out = mixing.flight(sizes, p, rng, True)
    assert set(np.round(out, 9)) <= {0.0, 1.0} and abs(out.sum() - p.sum()) <= 2 and abs(sizes @ out - sizes @ p) < 0.002 * (sizes @ p)


def test_shares_of_absent_sources_fall_to_the_others(spark):
    mixed = spark.createDataFrame([(1, "a", 5, 10, 2), (1, "b", 6, 20, 1)], "mix_id long, source string, doc_id long, tokens long, repeats int")
    targets = spark.createDataFrame([(1, "a", 0.3, 2), (1, "b", 0.3, 2), (1, "c", 0.4, 2), (2, "c", 1.0, 1)], "mix_id long, source string, target_share double, max_repeats int")
    got = {(r.mix_id, r.source): (r.reachable_share, r.actual_share) for r in mixing.shares(mixed, targets).collect()}
    assert got == {(1, "a"): (0.5, 0.5), (1, "b"): (0.5, 0.5), (1, "c"): (0.0, 0.0), (2, "c"): (None, None)}


def test_look_alikes_of_more_alphabets():
    assert forms.canonical("ꓮꓐꓚ օսո ɡ ӏ Ϲ Ꭺ") == "ABC oun g l C A"
    for shown in ("ıi", "𝐀A", "²2", "ﬁfi", "αa", "ɑa", "νv"):  # a reader sees a difference
        assert forms.canonical(shown[0]) != shown[1:]
    assert all(len(a) == len(b) == 1 and b.isascii() for a, b in forms.LOOK_ALIKES.items())
