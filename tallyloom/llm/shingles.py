"""Word shingles as sets of 64-bit hashes."""

import hashlib

import numpy as np
import xxhash

#: Words of a shingle.
SIZE = 5

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def word_hashes(text: str | None) -> np.ndarray:
    """A hash of each word; A-Z are lowered, words are parted by space, tab, LF, VT, FF, CR."""
    words = (text or "").encode("utf-8").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def windows(hashes: np.ndarray, size: int = SIZE) -> np.ndarray:
    """A hash of each run of ``size`` words; of all words where they are fewer."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(size, n)
    found = np.full(n - width + 1, np.uint64(width))
    for i in range(width):
        found = found * _STEP + hashes[i : i + len(found)]
        found ^= found >> np.uint64(29)
    found *= _MIX
    return found ^ (found >> np.uint64(32))


def shingle_set(text: str | None, size: int = SIZE) -> np.ndarray:
    """The sorted distinct shingles of a whole text."""
    return np.unique(windows(word_hashes(text), size))


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
