from __future__ import annotations

import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from concord.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def own():
    return bpe.ByteBPE(PATH)


def agrees(own, tokenizer, text):
    wanted = tokenizer.encode(text, add_special_tokens=False).ids
    found = own.encode_slab([text])[0]
    assert found.tolist() == wanted
    assert own.decode(found) == tokenizer.decode(wanted, skip_special_tokens=False)


@pytest.mark.parametrize(
    "text",
    ["", " ", "  ", "a  b", " a", "a ", "a \n b", "\n\nfoo", "foo\n\n", "x y  z", "it's 's we'RE", " 's", "<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|><|endoftext|>  c", "a" * 5000, "日本語 😀😀", "\x1c \x1d a\x1cb", "\x85 a\xa0b", "\x00 a", "1234 567"],
)
def test_agrees_with_the_library(own, tokenizer, text):
    agrees(own, tokenizer, text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'saé日1!"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_agrees_with_the_library_on_any_text(own, tokenizer, text):
    agrees(own, tokenizer, text)


def test_words_are_merged_together(own, tokenizer):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(1, 25))) for _ in range(500)] + ["aaaaaaa", "a"]
    assert [i.tolist() for i in own.encode_words([w.encode() for w in words])] == [tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    assert own.encode_words([]) == []


def test_dictionaries_stay_bounded(tokenizer):
    small = bpe.ByteBPE(PATH, most=10)
    for k in range(30):
        agrees(small, tokenizer, " ".join(f"w{k}x{i}" for i in range(5)))
        assert len(small.parts) <= 20 and len(small.words) <= 60


def expected(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), digest(",".join(map(str, ids))), digest(tokenizer.decode(ids, skip_special_tokens=False))


def test_documents(spark, sf_dir, documents, tokenizer):
    rows = {r["doc_id"]: tuple(r)[1:] for r in bpe.op5_numpy_bpe(spark, sf_dir).collect()}
    assert rows == {r["doc_id"]: expected(tokenizer, r["text"]) for r in documents.collect()}


def test_odd_documents(odd_documents, no_documents, tokenizer):
    texts = {r["doc_id"]: r["text"] for r in odd_documents.collect()}
    rows = bpe.digest_documents(odd_documents, PATH).collect()
    assert len(rows) == odd_documents.count()
    assert all(tuple(r)[1:] == expected(tokenizer, texts[r["doc_id"]]) for r in rows)
    assert bpe.digest_documents(no_documents, PATH).collect() == []
    whole = bpe.encode_documents(odd_documents, PATH).collect()
    assert all(r["decoded"] == (texts[r["doc_id"]] or "") for r in whole)
    assert [r["ids"] for r in whole if r["doc_id"] == 4] == [[]]


def test_slabs():
    assert [len(x) for x in bpe.slabs(["a" * 5] * 7, most=10)] == [2, 2, 2, 1]
    assert list(bpe.slabs([])) == [] and np.array_equal(np.concatenate([[1]]), [1])


def test_long_words(own, tokenizer):
    """Words that are merged by rank: letters in any order, runs of one letter, and several such words in one text."""
    rng = random.Random(7)
    any_letters = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    for text in (any_letters(6000, "abcdefghijklmnopqrstuvwxyz"), any_letters(3001, "ab"), "a" * 2999, any_letters(4000, "theandofing"), "é" * 700, " ".join(any_letters(900, "etaoin") for _ in range(5)) + " and short ones"):
        agrees(own, tokenizer, text)
    words = [any_letters(n, "estarnd").encode() for n in (513, 512, 5, 2000, 1, 700)]
    assert [i.tolist() for i in own._by_rank(words)] == [i.tolist() for i in own._rounds(words)] == [i.tolist() for i in own.encode_words(words)]


def test_a_word_of_a_megabyte_takes_seconds(own):
    rng = np.random.default_rng(1)
    word = rng.choice(np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", dtype=np.uint8), 1 << 20).tobytes()
    began = time.perf_counter()
    ids = own.encode_words([word])[0]
    assert time.perf_counter() - began < 60 and own.decode(ids).encode() == word


def test_dictionaries_hold_bounded_bytes(own, monkeypatch):
    monkeypatch.setattr(bpe, "HELD", 1000)
    small = bpe.ByteBPE(PATH)
    for k in range(20):
        small.encode_slab([f"{'x' * 300}{k} y"])
        assert small.held < 2000
