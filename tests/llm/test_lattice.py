"""Words whose plain sums are too small for a double."""

import math

import numpy as np

from tallyloom.llm import lattice_lm


def test_short_words_of_rare_bytes():
    pieces = [*(f"<0x{b:02X}>" for b in range(256)), "▁", "a"]
    lattice = lattice_lm.Lattice(pieces, [math.log(1e-12)] * 256 + [math.log(0.5)] * 2)
    for n in range(1, 24):
        for char, size in (("\U0001f6a8", 4), ("ᚠ", 3)):
            word = (char * n).encode()
            assert math.isclose(lattice.score(word), math.log10(0.5) - 12 * size * n, rel_tol=1e-9)
            counts = [0.0] * len(pieces)
            lattice.expected(word, 2.0, counts)
            assert np.isclose(sum(counts), 2.0 + 2.0 * size * n) and np.isclose(counts[256], 2.0)
