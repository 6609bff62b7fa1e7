"""Tokens of random strings, whole and cut up, against the libraries."""

from __future__ import annotations

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from txmon.llm import bpe, packing

ALPHABETS = (
    "abc dEF", "aA'stvmrelld ", "0123456789 .,-", "é ß İ ſ K Σς ﬁ ½ ǅ", "日本 テキスト。한국",
    "👩‍👧🏽🇩🇪 ", "\x00\x01\x1c\x1d\x85\xa0 　\t\r\n ", "áëक् ", "<|endoftext|> <|startoftext|>",
)


def strings(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        own = "".join(rng.sample(ALPHABETS, rng.randint(1, 3)))
        out.append("".join(rng.choices(own, k=rng.randint(0, 60))))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_words(seed):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    texts = strings(seed, 500) + ["", "x" * 5000, "don't won't 'S 'LL a'sb", "Word, word. WORD! word's"]
    found = [np.frombuffer(x, dtype="<u4").tolist() for x in packing.WordTokens(path).encode_batch(texts)]
    assert found == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_words_are_forgotten_between_single_texts(monkeypatch):
    monkeypatch.setattr(packing, "_MEMORY", 50)
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    own = packing.WordTokens(path)
    for i in range(100):
        text = " ".join(["often", *(f"w{i}x{j}" for j in range(20))])
        # As the operator does: one text each, and the iterator is left alone after it.
        ids = np.frombuffer(next(own.encode_batch([text])), dtype="<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
        # At most a text's words and their parts more.
        assert len(own._memory) <= 50 + 42


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("group", [bpe._GROUP, 50])
def test_bytes(monkeypatch, seed, group):
    monkeypatch.setattr(bpe, "_GROUP", group)
    monkeypatch.setattr(bpe, "_MEMORY", 60 if group == 50 else bpe._MEMORY)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    texts = strings(seed, 500) + ["", " ", "x" * 3000, "a\n b \n c", "a  b", " a", "a ", "it's we'll 1a a1 a_b"]
    own = bpe.ByteBpe(ranks, public_tokenizers.PATTERN)
    for text, ids in zip(texts, own.encode_batch(texts), strict=True):
        assert ids.tolist() == library.encode_ordinary(text)
        assert own.decode(ids).decode() == text
    assert max(map(len, own._memory), default=0) <= bpe._LONG
