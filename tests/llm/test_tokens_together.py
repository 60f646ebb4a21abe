"""Words encoded together have the ids they have alone."""

import random

import numpy as np
import public_tokenizers
import pytest

from dxweave.llm import tokens

ODD = ["", "a", "<", "<|", "<|endoftext|>", "x<|endoftext|>y", "<|startoftext|>", "|>", "endoftext", "naïve", "你好", "🙂🙂", "İ", "ﬁ", "don't", "5<6", "\x00", "‍", "é", "A.B,c", "a" * 700]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("prefix", ["", " "])
def test_together_as_alone(name, prefix, monkeypatch):
    path, rng = public_tokenizers.path(name), random.Random(4)
    words = [prefix + w for w in ODD + ["".join(rng.choices("abcdeéß'.,<|>你Z", k=rng.randrange(1, 9))) for _ in range(1500)] + ODD]
    alone = sorted((w, e.ids) for w, e in zip(words, tokens.library(path).encode_batch(words, add_special_tokens=False)))
    for joined in (512, 3):
        monkeypatch.setattr(tokens, "JOINED", joined)
        order, flat, sizes = tokens.encode_each(path, words)
        assert sorted(zip(order, [p.tolist() for p in np.split(flat, np.cumsum(sizes)[:-1])])) == alone
    assert [len(x) for x in tokens.encode_each(path, [])] == [0, 0, 0]
    assert tokens.encode_each(path, ["<|endoftext|>"])[1].tolist() == tokens.library(path).encode("<|endoftext|>", add_special_tokens=False).ids
