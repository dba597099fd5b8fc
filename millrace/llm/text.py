"""Words of many texts at once, as 64-bit hashes in numpy arrays.

A word is a maximal run of letters and digits of the lower-cased text; every
character outside ASCII counts as a letter. Hashes are polynomial over the UTF-8
bytes, mixed, and the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SHINGLE = np.uint64(0xD6E8FEB86659FD93)
_WORD_BYTE = np.zeros(256, np.bool_)
_WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

#: Bytes of text handled at once; a longer text is handled alone.
BLOCK_BYTES = 1 << 18

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(18, (n - 1).bit_length())
        have = np.ones(size, np.uint64)
        done = 1
        while done < size:
            step = np.uint64(pow(base, done, 1 << 64))
            have[done : 2 * done] = have[:done] * step
            done *= 2
        if size <= 1 << 22:
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass(frozen=True)
class Words:
    """Hashes of the words in order; text i has words[offsets[i]:offsets[i + 1]]."""

    hashes: np.ndarray
    offsets: np.ndarray
    prefixes: tuple[np.ndarray, ...] = ()

    @property
    def text(self) -> np.ndarray:
        """The number of each word's text."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def hash_words(texts: Sequence[str | None], prefixes: Sequence[int] = ()) -> Words:
    """The words; with them, of each word longer than so many bytes, the hash of its beginning (else 0)."""
    raw = [(t or "").lower().encode("utf-8", "replace") for t in texts]
    joined = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    ends_of_text = np.cumsum([len(r) + 1 for r in raw]) if raw else np.zeros(0, np.int64)
    inside = np.zeros(len(joined) + 2, np.int8)
    inside[1:-1] = _WORD_BYTE[joined]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(joined)), out=sums[1:])
    back = powers(_INVERSE, len(joined) + 1)[starts]
    hashes = mix((sums[ends] - sums[starts]) * back)
    heads = []
    for n in prefixes:
        head = mix((sums[np.minimum(starts + n, ends)] - sums[starts]) * back + np.uint64(n))
        heads.append(np.where(ends - starts > n, head, np.uint64(0)))
    return Words(hashes, np.concatenate([[0], np.searchsorted(starts, ends_of_text)]).astype(np.int64), tuple(heads))


def shingles(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each run of ``size`` words; a text of fewer words has one, of all it has."""
    n = len(words.hashes)
    counts = np.diff(words.offsets)
    of = words.text
    padded = np.concatenate([words.hashes, np.zeros(size, np.uint64)])
    total = np.zeros(n, np.uint64)
    left = words.offsets[1:][of] - np.arange(n) if n else np.zeros(0, np.int64)
    for j in range(size):
        total = total * _SHINGLE + np.where(left > j, padded[j : j + n], np.uint64(0))
    first = np.zeros(n, np.bool_)
    first[words.offsets[:-1][counts > 0]] = True
    keep = (left >= size) | (first & (counts[of] < size) if n else first)
    return mix(total[keep]), of[keep]


def blocks(texts: Sequence[str | None], most: int = BLOCK_BYTES) -> Iterator[slice]:
    """Consecutive slices of the texts of about ``most`` characters."""
    start = held = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if held and held + n > most:
            yield slice(start, i)
            start, held = i, 0
        held += n
    if start < len(texts):
        yield slice(start, len(texts))
