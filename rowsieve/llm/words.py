"""Words of many texts at once, as arrays of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# White space is space, tab, line feed, vertical tab, form feed, return.
SPACES = b" \t\n\x0b\x0c\r"

# A term is a run of ASCII letters, digits and everything beyond ASCII.
_TERM_BYTES = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True
BETWEEN_TERMS = np.ones(256, dtype=bool)
BETWEEN_TERMS[list(_TERM_BYTES)] = False

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C55  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}
# Powers of one base that a worker keeps at most, 8 bytes each.
KEPT_POWERS = 1 << 20
# Bytes whose words are hashed at once; one longer word stands alone.
HASHED_BYTES = 1 << 18


def powers(base: int, count: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64; lengthened as needed and kept, unless very many."""
    have = _powers.get(base)
    if have is None or len(have) < count:
        have = np.ones(1, dtype=np.uint64)
        size = 1 << max(16, (count - 1).bit_length())
        while len(have) < size:
            step = np.uint64(pow(base, len(have), 1 << 64))
            have = np.concatenate([have, have * step])
        if size <= KEPT_POWERS:
            _powers[base] = have
    return have[:count]


def forget_powers() -> None:
    _powers.clear()


def mix(values: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit values, one to one."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Words:
    """The words of some texts: runs of bytes that are not ``between`` words.

    ``hashes`` are of the lower-cased (A-Z only) bytes, ``starts`` and ``ends`` are byte
    places in the joined buffer, ``bounds[i]:bounds[i + 1]`` are the words of text i.
    """

    def __init__(self, texts: list[bytes], between: np.ndarray = _IS_SPACE):
        joined = b"\n".join(texts) + b"\n"
        self.raw = np.frombuffer(joined, dtype=np.uint8)
        low = _LOWER[self.raw]
        space = between[low]
        word = ~space
        edge = np.diff(np.concatenate([[False], word, [False]]).view(np.int8))
        self.starts = np.flatnonzero(edge == 1)
        self.ends = np.flatnonzero(edge == -1)
        lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.hashes = mix(self._sums(low, space))

    def _sums(self, low: np.ndarray, space: np.ndarray) -> np.ndarray:
        """Each word as a polynomial of its bytes. Words are taken together up to about
        ``HASHED_BYTES``, so that the powers, which a worker keeps, and the arrays for a
        part do not grow with the texts."""
        sums = np.zeros(len(self.starts), dtype=np.uint64)
        first = 0
        while first < len(sums):
            lo = int(self.starts[first])
            last = max(first + 1, int(np.searchsorted(self.starts, lo + HASHED_BYTES)))
            part = slice(lo, int(self.ends[last - 1]))
            values = np.where(space[part], np.uint64(0), low[part].astype(np.uint64) + np.uint64(1))
            values *= powers(_BASE, len(values))
            at = self.starts[first:last] - lo
            sums[first:last] = np.add.reduceat(values, at) * powers(_INVERSE, len(values))[at]
            first = last
        return sums

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.bounds[i] : self.bounds[i + 1]]


def pieces(text: bytes, limit: int, between: np.ndarray = _IS_SPACE) -> Iterator[bytes]:
    """A text in parts of at most ``limit`` bytes, cut between words only: a longer word
    stays whole."""
    start = 0
    while len(text) - start > limit:
        end = start + limit
        cuts = np.flatnonzero(between[np.frombuffer(text, np.uint8, limit, start)])
        if len(cuts):
            end = start + int(cuts[-1]) + 1
        while not len(cuts) and end < len(text):
            cuts = np.flatnonzero(between[np.frombuffer(text, np.uint8, min(limit, len(text) - end), end)])
            end = end + int(cuts[0]) if len(cuts) else min(len(text), end + limit)
        yield text[start:end]
        start = end
    yield text[start:]


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``size`` words.

    A text of fewer words has one shingle of all of them, one without words none.
    """
    words = Words(texts)
    hashes = words.hashes
    if len(hashes) >= size:
        runs = np.zeros(len(hashes) - size + 1, dtype=np.uint64)
        for k in range(size):
            runs = mix(runs + hashes[k : k + len(runs)] + np.uint64(k + 1))
    out = []
    for i in range(len(texts)):
        lo, hi = words.bounds[i], words.bounds[i + 1]
        if hi - lo >= size:
            out.append(np.unique(runs[lo : hi - size + 1]))
        elif hi > lo:
            whole = np.uint64(0)
            for k, h in enumerate(hashes[lo:hi]):
                whole = mix(np.array([(int(whole) + int(h) + k + 1) & _MASK], dtype=np.uint64))[0]
            # Marked by its length, so that it differs from a full run.
            out.append(mix(np.array([int(whole) ^ (int(hi - lo) << 56)], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out
