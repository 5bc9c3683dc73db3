"""Pre-tokens of many texts at once, as arrays.

A batch of texts becomes one array of code points. Rules on the classes of
neighbouring characters give the places where pre-tokens begin, so there is no
matching per text. Equal pre-tokens get one number.

Two styles, both by the patterns of the public vocabularies:

* ``bytes``: a space belongs to the letters, digits or signs after it, other white
  space stands alone.
* ``words``: white space goes, every digit stands alone.
"""

from __future__ import annotations

import functools
from typing import NamedTuple

import numpy as np
import pandas as pd
from tokenizers import Regex, pre_tokenizers

LETTER, NUMBER, OTHER, SPACE, BREAK = 1, 2, 3, 4, 5

# Code points with the Unicode property White_Space.
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
               0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Endings that the patterns split off after an apostrophe.
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]

_LOW = [np.uint64((1 << (8 * n)) - 1) for n in range(9)]
LOW_BYTES = np.array(_LOW, dtype=np.uint64)


class Pretokens(NamedTuple):
    """Pre-tokens of a batch: their numbers, and where each text's begin."""

    codes: np.ndarray     # of every pre-token, the number of its distinct form
    bounds: np.ndarray    # text i has codes[bounds[i]:bounds[i + 1]]
    data: np.ndarray      # UTF-8 bytes that hold the distinct forms
    starts: np.ndarray    # of every distinct form, its place in data
    lengths: np.ndarray   # and its bytes


@functools.cache
def _classes() -> np.ndarray:
    """The class of every code point as the tokenizers library's own patterns have it, so
    that no other table of Unicode, nor its age, plays a part."""
    points = [*range(0xD800), *range(0xE000, 0x110000)]     # all but surrogates
    text = "".join(map(chr, points))
    found = np.full(len(points), OTHER, dtype=np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        of_kind = np.ones(len(points), dtype=bool)
        rest = pre_tokenizers.Split(Regex(pattern), "removed").pre_tokenize_str(text)
        for _, (begin, end) in rest:
            of_kind[begin:end] = False
        found[of_kind] = kind
    classes = np.full(0x110000, OTHER, dtype=np.uint8)
    classes[points] = found
    classes[WHITE_SPACE] = SPACE
    return classes


def _begins(cp: np.ndarray, kind: np.ndarray, style: str) -> np.ndarray:
    """True where a pre-token, or white space, begins."""
    first = np.empty(len(cp), dtype=bool)
    first[0] = True
    np.not_equal(kind[1:], kind[:-1], out=first[1:])
    breaks = np.flatnonzero(kind == BREAK)
    first[breaks] = True
    first[breaks[:-1] + 1] = True
    quote = np.flatnonzero(cp == ord("'"))
    before = np.where(quote > 0, kind[quote - 1], BREAK)
    free = before != OTHER
    if style == "bytes":
        last = (kind[:-1] == SPACE) & (kind[1:] <= OTHER)
        first[:-1] |= last
        joined = last & (cp[:-1] == 32)
        first[1:] &= ~joined
        free &= ~((quote > 0) & (cp[quote - 1] == 32))
    else:
        first |= kind == NUMBER
    quote = quote[free]
    if len(quote):
        after = np.zeros(len(cp) + 2, dtype=cp.dtype)
        after[:len(cp)] = cp
        taken = np.zeros(len(quote), dtype=np.int64)
        for ending in ENDINGS:
            same = np.logical_and.reduce(
                [after[quote + 1 + i] == ord(c) for i, c in enumerate(ending)])
            taken[same & (taken == 0)] = len(ending)
        quote, taken = quote[taken > 0], taken[taken > 0]
        first[quote + 1] = False
        two = quote[taken == 2]
        first[two + 2] = False
        first[quote + taken + 1] = True
    return first


def _mixed(value: np.ndarray, factor: np.uint64) -> np.ndarray:
    value = value * factor
    value ^= value >> np.uint64(32)
    value *= np.uint64(0xD6E8FEB86659FD93)
    value ^= value >> np.uint64(29)
    return value


def distinct_slices(padded: bytes, starts: np.ndarray, lengths: np.ndarray):
    """Numbers slices of ``padded`` by content; returns them and a first slice of each.

    Slices are told apart by a 64-bit hash, and every slice is then compared with
    the first of its number; should two differ, the hash changes its factor.
    """
    words = np.ndarray((len(padded) - 7,), "<u8", buffer=padded, strides=(1,))

    def chunk(rows, at):
        return words[starts[rows] + at] & LOW_BYTES[np.minimum(lengths[rows] - at, 8)]

    everything = np.arange(len(starts))
    for factor in range(0x9E3779B97F4A7C15, 2**64, 0x1000000):
        odd = np.uint64(factor | 1)
        key = _mixed(chunk(everything, 0) ^ (lengths.astype(np.uint64) << np.uint64(56)), odd)
        rows, at = np.flatnonzero(lengths > 8), 8
        while len(rows):
            key[rows] = _mixed(key[rows] ^ chunk(rows, at), odd)
            at += 8
            rows = rows[lengths[rows] > at]
        codes, _ = pd.factorize(key)
        first = np.empty(codes.max() + 1 if len(codes) else 0, dtype=np.int64)
        first[codes[::-1]] = everything[::-1]
        twin = first[codes]
        same = bool((lengths == lengths[twin]).all())
        rows, at = everything, 0
        while same and len(rows):
            same = bool((chunk(rows, at) == chunk(twin[rows], at)).all())
            at += 8
            rows = rows[lengths[rows] > at]
        if same:
            return codes, first
    raise AssertionError("no factor tells the slices apart")


def split(texts: list[str], style: str) -> Pretokens:
    """Pre-tokens of ``texts``; an empty text has none."""
    joined = "\n".join(texts) + "\n"
    data = joined.encode("utf-8", "surrogatepass")
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _classes()[cp]
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    kind[ends] = BREAK
    begin = np.flatnonzero(_begins(cp, kind, style))
    over = np.append(begin[1:], len(cp))
    real = kind[begin] != BREAK
    if style == "words":
        real &= kind[begin] != SPACE
    begin, over = begin[real], over[real]
    bounds = np.searchsorted(begin, np.concatenate([[0], ends]))
    if len(data) != len(cp):
        place = np.ones(len(cp) + 1, dtype=np.int32 if len(data) < 2**31 else np.int64)
        place[0] = 0
        for limit in (0x7F, 0x7FF, 0xFFFF):
            place[1:] += cp > limit
        np.cumsum(place, out=place, dtype=place.dtype)
        begin, over = place[begin].astype(np.int64), place[over].astype(np.int64)
    lengths = over - begin
    codes, first = distinct_slices(data + bytes(8), begin, lengths)
    return Pretokens(codes, bounds, np.frombuffer(data, np.uint8), begin[first], lengths[first])


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places starts[i], ..., starts[i] + lengths[i] - 1 of all i in a row."""
    total = np.cumsum(lengths)
    if not len(total):
        return np.zeros(0, dtype=np.int64)
    return np.repeat(starts - total + lengths, lengths) + np.arange(total[-1])
