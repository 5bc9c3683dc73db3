"""Hashed n-grams of the bytes of many texts at once."""

from __future__ import annotations

import numpy as np


def _folds() -> np.ndarray:
    """Bytes as n-grams see them: letters and everything beyond ASCII stay, the rest
    reads as a space."""
    keep = np.full(256, ord(" "), dtype=np.uint8)
    letters = [*range(ord("a"), ord("z") + 1), *range(128, 256)]
    keep[letters] = letters
    return keep


FOLDS = _folds()


def folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in lower case as one array of bytes, a space before and after each,
    and where each text begins, with the end of all."""
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    bounds = np.cumsum([0, *(len(r) + 1 for r in raw)])
    data = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
    return FOLDS[data], bounds


def hashed(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    """A number below ``2**bits`` for the n-gram at every place of ``data``."""
    count = max(len(data) - n + 1, 0)
    value = np.zeros(count, dtype=np.uint32)
    for i in range(n):
        value *= np.uint32(0x01000193)
        value ^= data[i:i + count]
    value *= np.uint32(0x9E3779B1)
    value >>= np.uint32(32 - bits)
    return value


def slices(bounds: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Where the n-grams of each text lie in ``hashed``: within its spaces."""
    return [(a, max(a, b + 2 - n)) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
