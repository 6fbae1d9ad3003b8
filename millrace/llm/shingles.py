"""Words of whole texts as 64-bit hashes, and the hashes of their runs."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS_PER_SHINGLE = 5
CACHED, LONGEST_CACHED = 200_000, 64  # words remembered at a time, some 30 MB; longer ones are not
# Odd multipliers of the places in a run, and of the final mix.
PLACE = np.array([
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
], dtype=np.uint64)
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
S30, S27, S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on all others."""
    x = (x ^ (x >> S30)) * MIX_A
    x = (x ^ (x >> S27)) * MIX_B
    return x ^ (x >> S31)


class WordHashes(dict):
    """Hash of a word's bytes, remembered; emptied before a text when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= LONGEST_CACHED:
            self[word] = value
        return value

    def trim(self) -> None:
        if len(self) > CACHED:
            self.clear()

    def of(self, text: str | None) -> np.ndarray:
        """Hashes of the words of a text: what lies between ASCII white space, A-Z lower-cased."""
        self.trim()
        words = text.encode().lower().split() if text else []
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def shingles(words: np.ndarray, size: int = WORDS_PER_SHINGLE) -> np.ndarray:
    """Hash of each run of ``size`` words, in order; a shorter text is one run; none has none."""
    n = len(words)
    if n == 0:
        return np.empty(0, dtype=np.uint64)
    if n < size:
        h = np.full(1, n, dtype=np.uint64)
        for i in range(n):
            h = mix(h ^ words[i:i + 1] * PLACE[i % len(PLACE)])
        return h
    h = words[:n - size + 1] * PLACE[0]
    for i in range(1, size):
        h = h + words[i:n - size + 1 + i] * PLACE[i % len(PLACE)] if i < len(PLACE) else mix(h) + words[i:n - size + 1 + i]
    return mix(h)


def shingle_set(words: np.ndarray, size: int = WORDS_PER_SHINGLE) -> np.ndarray:
    return np.unique(shingles(words, size))
