"""Word-shingle sets and their bottom-k sketches, from one 64-bit hash function."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MOST_WORDS = 100_000


class _WordHashes(dict):
    """Hashes of the words met before; forgotten when they become too many to keep."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MOST_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHashes()


def words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case; ``bytes`` splits and lowers by ASCII alone."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_hashes(of: list[bytes]) -> np.ndarray:
    return np.fromiter((_hashes[w] for w in of), dtype=np.uint64, count=len(of))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; a shorter text is one shingle, no word none."""
    single = word_hashes(words(text))
    if not len(single):
        return single
    width = min(width, len(single))
    last = len(single) - width + 1
    mixed = np.full(last, width, dtype=np.uint64)
    for i in range(width):
        mixed = (mixed ^ single[i : i + last]) * _MIX
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
