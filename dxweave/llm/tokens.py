"""Cutting texts where no token can cross, so that a library's result for a short chunk can be kept and reused."""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import public_tokenizers

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: A space before something that no library counts as white space; such a space starts a pre-token of its own.
_CUT = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?!\S)")


def chunks(text: str) -> list[str]:
    """Cuts at every space that begins a pre-token; all chunks but the first have lost that space.

    The pre-tokens of a text are those of its first chunk and of ``" " + chunk`` for the others:
    white space before such a space is matched the same at the end of a chunk as before a space.
    """
    return _CUT.split(text) if _ODD.search(text) else text.split(" ")


def vocabulary(name: str, path: str | None = None) -> str:
    return path or public_tokenizers.path(name)


_TOKENIZERS: dict[str, object] = {}


def library(path: str):
    """The tokenizers library's object for a .json file, loaded once per worker."""
    if path not in _TOKENIZERS:
        from tokenizers import Tokenizer

        _TOKENIZERS[path] = Tokenizer.from_file(path)
    return _TOKENIZERS[path]


#: Words that go to the library in one text.
JOINED = 256
#: A word that is one pre-token, also after normalisation, with the space before it if there is one.
_PLAIN = re.compile("( ?)[A-Za-zÀ-ÖØ-öø-ÿ]+")


@lru_cache(8)
def _borders(path: str) -> tuple[np.ndarray, bool]:
    """Ids that stand at a border of a word, and whether that is its end (or its space at the beginning)."""
    entries = library(path).get_vocab()
    ends = any(t.endswith("</w>") for t in entries)
    out = np.zeros(max(entries.values()) + 1, bool)
    for entry, i in entries.items():
        out[i] = entry.endswith("</w>") if ends else entry.startswith("Ġ")
    return out, ends


def encode_each(path: str, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The words in another order, the ids of each by itself one after the other, and how many each has.

    The library takes longer to begin a text than to encode a word.  Plain words are joined to texts and told apart by
    ids that only stand at a border of a word: its end, or a space at its beginning.  All other words, and texts whose borders are not
    as many as their words, are encoded one by one.
    """
    border, ends = _borders(path)
    plain, alone = [], []
    for word in words:
        match = _PLAIN.fullmatch(word)
        (plain if match and (match[1] == "") == ends else alone).append(word)
    order: list[str] = []
    flat, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    groups = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
    joined = library(path).encode_batch_fast([(" " if ends else "").join(g) for g in groups], add_special_tokens=False)
    for group, encoding in zip(groups, joined):
        ids = np.array(encoding.ids, np.uint32)
        at = np.flatnonzero(border[ids])
        if len(at) != len(group):
            alone += group
            continue
        order += group
        flat.append(ids)
        sizes.append(np.diff(at, prepend=-1) if ends else np.diff(at, append=len(ids)))
    found = [e.ids for e in library(path).encode_batch_fast(alone, add_special_tokens=False)]
    flat.append(np.array([i for ids in found for i in ids], np.uint32))
    sizes.append(np.array([len(ids) for ids in found], np.int64))
    return order + alone, np.concatenate(flat), np.concatenate(sizes)


class Kept:
    """A worker's bounded cache in two generations: once the young one is full, what is not asked for again goes."""

    def __init__(self, limit: int):
        self.limit = limit
        self.young: dict = {}
        self.old: dict = {}

    def missing(self, keys: set) -> list:
        """The keys that are not known; all others are in ``young`` until the next call."""
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young
        new = []
        for key in keys.difference(self.young):
            if key in self.old:
                self.young[key] = self.old[key]
            else:
                new.append(key)
        return new
