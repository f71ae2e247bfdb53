"""Vectorised text features: letters, hashed character n-grams and hashed words, over whole texts in bounded blocks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: Characters that are looked at together. A word longer than that counts as several.
BLOCK = 1 << 16
_R = 0x9E3779B97F4A7C15 | 1
_R_INVERSE = pow(_R, -1, 2**64)


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_R, _R_INVERSE):
        p = np.full(BLOCK + 2, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _blocks(cp: np.ndarray, letter: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of at most BLOCK characters, cut between words where that can be."""
    at = 0
    while at < len(cp):
        end = min(len(cp), at + BLOCK)
        if end < len(cp) and letter[end - 1]:
            gaps = np.flatnonzero(~letter[at:end])
            end = at + int(gaps[-1]) + 1 if len(gaps) else end
        yield cp[at:end], letter[at:end]
        at = end


def has_letter(text: str | None) -> bool:
    return bool(text) and (any(map(str.isalpha, text[:64])) or bool(letter_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].any()))


def word_hashes(text: str | None, prefixes: tuple[int, ...] = ()) -> np.ndarray:
    """A 64-bit hash of each run of letters, lower-cased, in order; then of the first letters of the longer ones, for each of `prefixes`."""
    if not text:
        return np.empty(0, np.uint64)
    cp, out = code_points(text), []
    up, down = _powers()
    for c, letter in _blocks(cp, letter_table()[cp]):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], letter.view(np.int8), [0]])))
        start, end = edge[::2], edge[1::2]
        if not len(start):
            continue
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((c.astype(np.uint64) + np.uint64(1)) * up[: len(c)], dtype=np.uint64)])
        parts = [(total[end] - total[start]) * down[start]]
        for k in prefixes:
            s = start[end - start > k]
            parts.append((total[s + k] - total[s]) * down[s] + np.uint64(k))
        h = np.concatenate(parts)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        out.append(h ^ (h >> np.uint64(29)))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def char_ngrams(text: str | None, bits: int, most: int = 3) -> np.ndarray:
    """Hashes to `bits` bits of the 1- to `most`-grams of the letters; what lies between words is one space."""
    if not text:
        return np.empty(0, np.uint32)
    cp, out = code_points(text), []
    gap = np.array([32], np.uint32)
    for c, letter in _blocks(cp, letter_table()[cp]):
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # the first gap after a word
        c = np.concatenate([gap, np.where(letter, c, np.uint32(32))[keep], gap])
        h = np.zeros(len(c), np.uint32)
        for n in range(1, min(most, len(c)) + 1):
            h = h[: len(c) - n + 1] * np.uint32(0x01000193) + c[n - 1 :]
            out.append(((h + np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits))
    return np.concatenate(out) if out else np.empty(0, np.uint32)
