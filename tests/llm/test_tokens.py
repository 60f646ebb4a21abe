"""Packing, byte-level BPE and token counts against the libraries themselves."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
tiktoken = pytest.importorskip("tiktoken")
public = pytest.importorskip("public_tokenizers")

from dxweave.llm import byte_bpe, packing, token_counts, tokens  # noqa: E402


def test_chunks_keep_every_pre_token():
    import regex

    pattern, rng = regex.compile(public.PATTERN), random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choices("ab1'.s \n\t\x1c\u3000\x85é", k=rng.randrange(25)))
        first, *rest = tokens.chunks(text)
        found = pattern.findall(first) + [w for c in rest for w in pattern.findall(" " + c)]
        assert found == pattern.findall(text), repr(text)


def test_token_counts(odd_docs, odd_rows, no_docs):
    library = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    expected = Counter()
    for i, t in odd_rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        expected[i, len((t or "").encode()), n, n > 1024] += 1
    got = token_counts.count_tokens(odd_docs)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert Counter(tuple(r) for r in got.collect()) == expected
    assert token_counts.count_tokens(no_docs).count() == 0


def test_short_words_without_windows():
    """A word is one row in the query of short words, whose steps sort nothing; lengths around the border to long words."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(17)
    given = ["a", "aa", "aaa" * 15, "é", "🙂"] + ["".join(rng.choices("aeinorst", k=n)) for n in range(1, byte_bpe.LONG + 9)]
    encoder = byte_bpe.Encoder(public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    expected = [(" ".join(map(str, library.encode_ordinary(w))), w.encode()) for w in given]
    assert encoder.words(given) == expected and " OVER " not in byte_bpe._SHORT
    assert encoder.words(given[-3:]) == expected[-3:] and encoder.words(["", "a"]) == [("", b""), expected[0]]


def test_byte_bpe(odd_docs, odd_rows, no_docs):
    path = public.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expected = Counter()
    for i, t in odd_rows:
        ids = encoding.encode_ordinary(t or "")
        expected[i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())] += 1
    assert Counter(tuple(r) for r in byte_bpe.encode_decode(odd_docs).collect()) == expected
    assert byte_bpe.encode_decode(no_docs).count() == 0
    row = byte_bpe.encode_decode(odd_docs.where("doc_id = 8"), outputs=True).first()
    assert row.ids == encoding.encode_ordinary(odd_rows[11][1]) and row.decoded.decode() == odd_rows[11][1]


def test_long_words_contract_like_short_ones():
    encoder = byte_bpe.Encoder(public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public.path("byte_bpe_50k.tiktoken"), "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=".+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    words = ["".join(rng.choices("abehtinr", k=rng.randrange(1, 150))) for _ in range(150)] + ["a" * 200, "ab" * 99, "=" * 77]
    for word, (ids, decoded) in zip(words, encoder.words(words)):
        assert ids == " ".join(map(str, encoding.encode_ordinary(word))) and decoded == word.encode()


def check_packing(rows, capacity):
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing(odd_docs, odd_rows, no_docs):
    library = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    expected, total = Counter(), 0
    for i, t in odd_rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        for piece, at in enumerate(range(0, len(ids), 256)):
            own = ids[at : at + 256]
            expected[i, piece, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    rows = packing.pack(odd_docs, capacity=256).collect()
    assert Counter(tuple(r)[:5] for r in rows) == expected
    assert check_packing(rows, 256) <= -(-total // 256) * 1.05 + 2
    assert packing.pack(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_every_piece_once(seed):
    rng = random.Random(seed)
    draw = [lambda: rng.randrange(1, 4097), lambda: min(4096, int(rng.expovariate(1 / 500)) + 1), lambda: rng.choice([1500, 1400, 2700]), lambda: 3000][seed]
    histogram = Counter(draw() for _ in range(3000))
    bins = packing.plan(dict(histogram))
    held = Counter()
    for b in bins:
        assert b.used() <= 4096
        held.update({n: c * b.count for n, c in Counter(b.lengths).items()})
    assert held == histogram
    best = -(-sum(n * c for n, c in histogram.items()) // 4096)
    if seed < 2:
        assert sum(b.count for b in bins) <= best * (1.03, 1.01)[seed] + 1
    if seed == 3:
        assert sum(b.count for b in bins) == 3000


def test_no_pieces():
    assert packing.plan({}) == []
