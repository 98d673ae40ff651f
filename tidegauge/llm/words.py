"""Words of texts as numbers, fast enough for whole corpora."""

from __future__ import annotations

import re

import numpy as np
import xxhash

# all but what isalnum() holds for
_OTHERS = re.compile(r"[\W_]+").sub
#: Distinct raw tokens a task keeps.
KEPT_TOKENS = 1_000_000


def normal(token: str) -> str:
    """A token in lower case without anything but letters and digits; may be empty."""
    lower = token.lower()
    return lower if lower.isalnum() else _OTHERS("", lower)


class WordHashes(dict):
    """Raw token to a 64-bit hash of its normal form; 0 for a token without letters or digits."""

    def __missing__(self, token: str) -> int:
        if len(self) >= KEPT_TOKENS:
            self.clear()
        word = normal(token)
        value = (xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace")) or 1) if word else 0
        self[token] = value
        return value

    def of(self, text: str) -> np.ndarray:
        """Hashes of the words of a whole text, in order."""
        tokens = text.split()
        hashes = np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))
        return hashes[hashes != 0]


def shingles(hashes: np.ndarray, words: int) -> np.ndarray:
    """The distinct runs of so many words as sorted hashes; a shorter text is one run."""
    count = max(1, len(hashes) - words + 1) if len(hashes) else 0
    out = np.zeros(count, np.uint64)
    factor = np.uint64(0x9E3779B97F4A7C15)
    for k in range(min(words, len(hashes))):
        out = (out ^ hashes[k : k + count]) * factor
        out ^= out >> np.uint64(29)
    return np.unique(out)
