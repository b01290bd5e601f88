"""Words of texts as 64-bit hashes, many texts at once.

A word's hash is a polynomial in its bytes, each byte read as a random 64-bit
number, modulo 2^64; running sums over the bytes of many words give all of
them by array operations.  Such polynomials agree on some pairs of long words
whatever the numbers are (Thue-Morse words and their complements, from some
thousand bytes on), so words longer than ``LONG`` bytes are hashed by BLAKE2.
"""

from __future__ import annotations

import hashlib

import numpy as np

#: Bytes of a word beyond which it is hashed by itself.
LONG = 128
#: Bytes that are hashed at once (a longer word alone).
CHUNK = 1 << 20

_RNG = np.random.default_rng(20_240_229)
_VALUE = _RNG.integers(0, 2**64, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_IN_WORD = np.ones(256, bool)
_IN_WORD[list(b" \t\n\x0b\x0c\r")] = False
_SALT = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_POWERS, _INVERSES = _powers(_BASE, CHUNK), _powers(_INVERSE, CHUNK)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (splitmix64's last steps)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z lower-cased, cut at ASCII white space) of all texts, and the place where each text's begin, plus the end."""
    joined = b"\n".join([*texts, b""]).lower()
    data = np.frombuffer(joined, np.uint8)
    edges = np.flatnonzero(np.diff(_IN_WORD[data].view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    starts, stops = edges[::2], edges[1::2]
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        first = starts[i]
        j = max(i + 1, int(np.searchsorted(stops, first + CHUNK, "right")))
        n = int(stops[j - 1] - first)
        powers, inverses = (_POWERS, _INVERSES) if n <= CHUNK else (_powers(_BASE, n), _powers(_INVERSE, n))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUE[data[first : first + n]] * powers[:n], out=sums[1:])
        a, b = starts[i:j] - first, stops[i:j] - first
        out[i:j] = mixed((sums[b] - sums[a]) * inverses[a] + (b - a).astype(np.uint64))
        i = j
    for i in np.flatnonzero(stops - starts > LONG).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(joined[starts[i] : stops[i]], digest_size=8).digest(), "little")
    bounds = np.cumsum([0, *(len(x) + 1 for x in texts)])
    return out, np.searchsorted(starts, bounds)


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``width``-word shingles; with fewer words, one for the whole; without any, none."""
    words, ends = word_hashes(texts)
    total = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for i in range(width):
        total = mixed(total + words[i : i + len(total)] + _BASE)
    out = []
    for a, b in zip(ends.tolist(), ends[1:].tolist()):
        if b - a >= width:
            own = np.sort(total[a : b - width + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif b > a:
            short = np.array([b - a], np.uint64)
            for w in words[a:b]:
                short = mixed(short * _SALT + w)
            out.append(short)
        else:
            out.append(np.empty(0, np.uint64))
    return out
