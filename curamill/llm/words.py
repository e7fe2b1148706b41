"""Words, their hashes and the hashes of word sequences, as the operators on shared text compare them."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import xxhash

_WORD = re.compile(r"[^\W_]+")
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def words(text: str) -> list[str]:
    """Runs of letters or digits, case aside; composed and decomposed letters are the same."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    return _WORD.findall(text.lower())


class WordHasher:
    """64-bit hashes of words; remembers the words it has met, up to a bound."""

    def __init__(self, most: int = 200_000):
        self.known: dict[str, int] = {}
        self.most = most

    def __call__(self, run: list[str]) -> np.ndarray:
        if len(self.known) > self.most:
            self.known.clear()
        known = self.known
        for w in set(run).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, run), dtype=np.uint64, count=len(run))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * _MIX
        return x ^ (x >> np.uint64(29))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words of a text given as word hashes; empty if it is shorter."""
    n = len(hashes) - k + 1
    if n < 1:
        return np.empty(0, np.uint64)
    grams = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            grams = grams * _BASE + hashes[j : j + n]
    return mixed(grams)
