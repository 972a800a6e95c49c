"""Hashes of word shingles, computed for many texts at once with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Words in a shingle.
WIDTH = 5
# odd multipliers: a byte's base and its inverse modulo 2^64, and one for each place in a shingle
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACES = np.array(
    [0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64
)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out) if n else out


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text the number of words before its end."""
    joined = np.frombuffer(b"\n".join(texts).translate(_LOWER) + b"\n", np.uint8)
    blank = _BLANK[joined]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], blank]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(joined)), out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _powers(_INVERSE, len(joined))[starts] + (ends - starts).astype(np.uint64))
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.searchsorted(starts, text_ends)


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles; fewer words make one shingle, none make none."""
    pending: list[bytes] = []
    size = 0
    for t in texts:
        pending.append((t or "").encode())
        size += len(pending[-1])
        if size > 1 << 20:
            yield from _sets(pending)
            pending, size = [], 0
    if pending:
        yield from _sets(pending)


def _sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    words, ends = word_hashes(texts)
    full = max(len(words) - WIDTH + 1, 0)
    rolled = np.zeros(full, np.uint64)
    for k in range(WIDTH):
        rolled += words[k : k + full] * _PLACES[k]
    rolled = mix(rolled)
    at = 0
    for end in ends:
        n = end - at
        if n >= WIDTH:
            found = np.sort(rolled[at : end - WIDTH + 1])
            yield found[np.concatenate([[True], found[1:] != found[:-1]])]
        elif n:
            short = (words[at:end] * _PLACES[:n]).sum(dtype=np.uint64) + np.uint64(n)
            yield mix(np.array([short], np.uint64))
        else:
            yield words[:0]
        at = end
