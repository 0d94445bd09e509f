"""Token counts and byte-level BPE against the libraries."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from odd import DOCUMENTS, documents, rows
from tokenizers import Tokenizer

from partysieve.llm import bpe_matrix, token_counts

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
_draw = random.Random(1)
_ALPHABET = "ab '\n\t  \x0b\x0c\x1c\x1d\x1f\x85\xa0​　éßñ漢字🙂²½٣12'st're!?.,-_́﻿"
TEXTS = ["".join(_draw.choice(_ALPHABET) for _ in range(_draw.randint(0, 60))) for _ in range(800)] + [
    "a" * 3000, "abcdefghij" * 300, "<|endoftext|> x<|endoftext|><|endoftext|>", "x <|endoftext|>\n\n y"]


@pytest.fixture(scope="module")
def libraries():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return Tokenizer.from_file(JSON), tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_against_libraries(libraries):
    tokenizer, encoding = libraries
    counter, codec = token_counts.counter(JSON, PATTERN), bpe_matrix.codec(RANKS, PATTERN)
    assert [counter.count(t) for t in TEXTS] == [len(e.ids) for e in tokenizer.encode_batch(TEXTS, add_special_tokens=False)]
    for text in TEXTS:
        ids = codec.encode(text)
        assert ids == encoding.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_forgotten_pieces(monkeypatch, libraries):
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    monkeypatch.setattr(bpe_matrix, "REMEMBERED", 3)
    monkeypatch.setattr(bpe_matrix, "CELLS", 16)
    counter, codec = token_counts.Counter(JSON, PATTERN), bpe_matrix.Codec(RANKS, PATTERN)
    for text in TEXTS[:100]:
        assert counter.count(text) == len(libraries[0].encode(text, add_special_tokens=False).ids)
        assert codec.encode(text) == libraries[1].encode_ordinary(text)


def test_frames(spark, libraries):
    tokenizer, encoding = libraries
    want = []
    for d, t in DOCUMENTS:
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        want.append((d, len((t or "").encode()), n, n > 512))
    assert rows(token_counts.count_tokens(documents(spark), JSON, PATTERN)) == sorted(want, key=repr)
    want = []
    for d, t in DOCUMENTS:
        ids = encoding.encode_ordinary(t or "")
        want.append((d, len(ids), *(hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (t or "").encode()))))
    assert rows(bpe_matrix.digests(documents(spark), RANKS, PATTERN)) == sorted(want, key=repr)
    got = bpe_matrix.encoded(documents(spark), RANKS, PATTERN)
    assert set(got.columns) == set(documents(spark).columns)  # `ids` is replaced
    assert rows(got.select("doc_id", "ids")) == sorted([(d, encoding.encode_ordinary(t or "")) for d, t in DOCUMENTS], key=repr)


def test_empty(spark):
    none = documents(spark).where("false")
    assert token_counts.count_tokens(none, JSON, PATTERN).collect() == []
    assert bpe_matrix.digests(none, RANKS, PATTERN).collect() == []


@pytest.mark.parametrize("alphabet", ["abcdefghijklmnopqrstuvwxyz", "ab", "the rain in".replace(" ", ""), "漢字éx"])
def test_long_pieces(monkeypatch, libraries, alphabet):
    """Unbroken runs of letters: the merges of long pieces are those of short ones, and of the library."""
    import time

    draw = random.Random(len(alphabet))
    codec = bpe_matrix.codec(RANKS, PATTERN)
    for size in (3, 700, 2100, 5000):
        text = "".join(draw.choice(alphabet) for _ in range(size))
        want = libraries[1].encode_ordinary(text)
        assert codec.encode(text) == want
        monkeypatch.setattr(bpe_matrix, "LONG", 2)
        assert codec.encode_pieces([text.encode()])[0] == want
        monkeypatch.undo()
    text = "".join(draw.choice(alphabet) for _ in range(32_000))
    start = time.perf_counter()
    found = codec.encode(text)
    assert time.perf_counter() - start < 10  # by rounds over the whole row it took more than that even on an idle machine
    assert codec.decode(found).decode() == text
