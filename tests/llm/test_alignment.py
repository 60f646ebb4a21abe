"""Alignment of two tokenizers against an alignment of whole texts, byte by byte."""

import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dxweave.llm import alignment

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
ENTRIES = {i: t for t, i in A.get_vocab().items()}


def plain_characters():
    bytes_ = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = {chr(b): b for b in bytes_}, 0
    for b in range(256):
        if b not in bytes_:
            out[chr(256 + n)] = b
            n += 1
    return out


CHARACTERS = plain_characters()


def brute_tokens(text):
    """(id, bytes) of both tokenizers over the whole text; nothing if either does not give the text back."""
    if not text:
        return [], []
    a = [(i, bytes(CHARACTERS[c] for c in ENTRIES[i])) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in B.encode(text):
        piece = B.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if len(piece) == 6 and piece.startswith("<0x") else piece.replace("▁", " ").encode()))
    raw = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b) else ([], [])


def brute_groups(text):
    a, b = brute_tokens(text)
    ends = [set(np.cumsum([len(x) for _, x in side]).tolist()) for side in (a, b)]
    cuts = sorted(ends[0] & ends[1])
    groups = [([], []) for _ in cuts]
    for k, side in enumerate((a, b)):
        place = 0
        for i, raw in side:
            place += len(raw)
            groups[bisect_left(cuts, place)][k].append(i)
    return a, b, groups


def brute_align(rows):
    made, holds = [], Counter()
    for i, text in rows:
        a, b, groups = brute_groups(text)
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        holds.update(set(links))
        written = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        made.append((i, len(a), len(b), len(groups), links, written))
    highest = defaultdict(int)
    for (x, _), n in holds.items():
        highest[x] = max(highest[x], n)
    return Counter(
        (i, na, nb, ng, len(links), sum(holds[x] == highest[x[0]] for x in links), sum(holds[x] for x in links), hashlib.sha256(w.encode()).hexdigest() if w else "")
        for i, na, nb, ng, links, w in made
    )


TEXTS = [
    "The cat", " leading", "two  spaces", "a   b    c", "trailing ", "\ttab\n newline \n\n x", "naïve café 你好 🙂🙂", "x▁y", "<0x41> <s> </s>", "<|endoftext|> a<|endoftext|>",
    "\0 nul \x00x", "a b c 　d", "1234567 89.01", "aaaa" * 300, "  ", " ", "\n", "é ﬁ ퟿", "it's we'll  they've", "\x85 \x1c x \x1f y", "__init__( self ):\n        return  x",
]


@pytest.fixture(scope="module")
def known():
    return alignment.KnownChunks(alignment._tokens(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")))


def check_texts(known, texts):
    """Groups of chunks put together are those of the whole text."""
    for text in texts:
        parts = alignment.chunks(text)
        known.learn(set(parts))
        places = [known.place[c] for c in parts]
        a, b, groups = brute_groups(text)
        if any(known.counts[0][k] == 0 for k in places):
            assert not a and not b
        else:
            written = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
            assert ";".join(known.text[k] for k in places) == written, text
            links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
            mine = Counter()
            for k in places:
                for e in range(known.start[k], known.start[k + 1]):
                    mine[int(known.pair[e]) >> 32, int(known.pair[e]) & 0xFFFFFFFF] += int(known.links[e])
            assert mine == links, text


def test_chunks_are_aligned_as_whole_texts(known):
    check_texts(known, TEXTS)


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.sampled_from("  \t\n\r\x0b\x85 　▁ab'sAé你🙂1.<0x>|-"), max_size=25))
def test_any_text(known, text):
    check_texts(known, [text])


def test_products_of_sparse_matrices():
    rng = np.random.default_rng(4)
    for _ in range(20):
        a, b = rng.integers(0, 3, (5, 7)) * rng.integers(0, 2, (5, 7)), rng.integers(0, 3, (7, 4)) * rng.integers(0, 2, (7, 4))
        rows = [alignment.compressed(*np.nonzero(m), m[np.nonzero(m)], len(m)) for m in (a, b)]
        made = alignment.gustavson(*rows)
        dense = np.zeros((5, 4), np.int64)
        dense[made.rows(), made.column] = made.value
        assert (dense == a @ b).all()
        turned = alignment.transposed(rows[0], 7)
        assert (alignment.gustavson(rows[0], turned).value.sum()) == (a @ a.T).sum()


def test_overlaps_count_bytes():
    links = alignment.overlaps(np.array([2, 3, 1]), np.array([1, 4, 1]))
    assert list(zip(links.rows().tolist(), links.column.tolist(), links.value.tolist())) == [(0, 0, 1), (0, 1, 1), (1, 1, 3), (2, 2, 1)]
    assert [g.tolist() for g in alignment.grouped(links, 3)] == [[0, 0, 1], [0, 0, 1]]


def test_align(odd_docs, odd_rows, no_docs):
    columns = alignment.SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    got = alignment.align(odd_docs)
    assert got.columns == columns
    assert Counter(map(tuple, got.collect())) == brute_align(odd_rows)
    assert alignment.align(no_docs).count() == 0


def test_many_batches_and_outputs(spark):
    rng = random.Random(9)
    texts = TEXTS + [" ".join(rng.choices(["the", "thething", "of", "x▁", "ünd", "aa" * 9, "  b"], k=rng.randrange(1, 30))) for _ in range(60)]
    rows = [(i % 70 if i % 9 else None, t) for i, t in enumerate([*texts, None, "", texts[0], texts[0]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = alignment.align(docs, outputs=True).collect()
    assert Counter(tuple(r)[:-1] for r in got) == brute_align(rows)
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 if r.groups else r.groups_sha256 == "" for r in got)
