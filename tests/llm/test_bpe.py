"""The pair index against the public library, on awkward words and on generated text."""

import hashlib
import random
import unicodedata

import numpy as np
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from docketry.llm import bpe

PATH = bpe.vocabulary_path()

TEXTS = [
    None, "", "a", "<|endoftext|>x <|startoftext|>", "<|endoftext|><|endoftext|>", "x<|EndOfText|>", "ΑΣ ΣΑΣ Σ.",
    "İstanbul ǅ", "a\x1cb c\x85d e\u200bf\u3000g", "e\u0301 \u0301a  café", "don't I'LL we've 'S 12345 ½²",
    "aaaa aaaaaaa aaaaaaaaaaaaaa", "\U0001f600🤦🏼‍♂️ 漢字 かな", "!!!@@## $$$", "\x00\x01 \ufffd", "ﬁ Å Å", "x" * 3000,
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.Encoder(PATH)


def agrees(own, library, texts):
    for text, (ids, decoded) in zip(texts, own.encode(texts), strict=True):
        wanted = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == wanted, text
        assert decoded == library.decode(wanted, skip_special_tokens=False)
        assert bpe.decode(ids, own.tokens) == decoded


def test_awkward_texts(own, library):
    agrees(own, library, TEXTS)


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs", "Cn"]), st.sampled_from("aeinorst '<|>\n")), max_size=60), max_size=6))
def test_generated_texts(own, library, texts):
    agrees(own, library, texts)


def test_marks_are_ordered_as_the_library_does(own, library):
    """Every combining mark before and after marks of low and high class, all canonical pairs, and mixed runs of marks."""
    nfc = tokenizers.normalizers.NFC().normalize_str
    characters = list(map(chr, range(0x110000)))
    marks = [c for c in characters if unicodedata.combining(c)]
    texts = [f"b{x}" for m in marks for k in "\u0334\u0327\u0301\u0345" for x in (m + k, k + m)]
    for c in characters:
        parts = unicodedata.decomposition(c)
        if parts and "<" not in parts:
            pair = "".join(chr(int(x, 16)) for x in parts.split())
            texts += [c, pair, unicodedata.normalize("NFD", c), pair + "\u0334"]
    rng = random.Random(3)
    late = [m for m in marks if bpe.NORMALISED_PARTS.sub("", m)]
    starters = "aeo\u1100\u1161\u11a8\u0bc6\u0b47\u0d46\u0f71\U00011935\U00011930\U00011938"
    for _ in range(20_000):
        pool = [marks, late, starters]
        texts.append("".join(rng.choice(rng.choice(pool)) for _ in range(rng.randint(2, 7))))
    assert len(late) == 108
    assert [t for t in texts if bpe.composed(t) != nfc(t)] == []
    agrees(own, library, ["\u032b\u0d3c", *texts[-2000:]])


def test_decoded_text_comes_from_the_ids():
    encoder = bpe.Encoder(PATH)
    list(encoder.encode(["two words"]))
    encoder.ids["two"] = encoder.ids["words"]
    [(ids, decoded)] = encoder.encode(["two words"])
    assert ids == 2 * encoder.ids["words"] and decoded == "words</w> words</w>"


def test_memory_does_not_change_results(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_WORDS", 3)
    monkeypatch.setattr(bpe, "INDEX_WORDS", 2)
    agrees(bpe.Encoder(PATH), library, TEXTS * 2)


def test_short_lists_and_arrays_agree(library, monkeypatch):
    texts = ["there are other theories " * 40, "banana bandana cabana"]
    for limit in (1, 10_000):
        monkeypatch.setattr(bpe, "ARRAY_FROM", limit)
        agrees(bpe.Encoder(PATH), library, texts)


def test_every_document(spark, docs, doc_rows, no_docs, library):
    found = sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(docs, PATH).collect())
    wanted = []
    for r in doc_rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        wanted.append((r[0] or (-1 if r[0] is None else 0) or -1, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert found == sorted(wanted)
    assert bpe.digests(no_docs, PATH).count() == 0
    sample = {r["doc_id"]: r for r in bpe.encode(docs.filter("doc_id = 1005"), PATH).collect()}
    assert sample[1005]["decoded"] == "two</w> words</w>"
