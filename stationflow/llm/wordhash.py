"""Hashes of words and of runs of words, for all texts of a batch side by side.

Words are maximal runs of bytes other than white space (0x20, 0x09-0x0D). A
word's hash is a polynomial over its bytes modulo 2^64, mixed; words longer than
``LONG_WORD`` bytes are hashed by BLAKE2, since a polynomial modulo 2^64 has
known collisions between very long words. A run's hash is a polynomial over its
words' hashes. Both come from prefix sums, so a text costs a few passes over
its bytes, whatever the length of the runs.
"""

from __future__ import annotations

import hashlib

import numpy as np

LONG_WORD = 64
BLOCK = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, count: int) -> np.ndarray:
    """base^0, base^1, ... modulo 2^64."""
    out = np.ones(count, np.uint64)
    step, done = base, 1
    while done < count:
        part = out[:count - done][:done]
        out[done:done + len(part)] = part * np.uint64(step)
        step, done = step * step % (1 << 64), done * 2
    return out


class Powers:
    """Powers of an odd number modulo 2^64 and of its inverse, as many as were asked for so far."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(0, np.uint64)

    def upto(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < count:
            self.up, self.down = _powers(self.base, count), _powers(self.inverse, count)
        return self.up[:count], self.down[:count]


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input changes about half of the output."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


_IN_WORD = Powers(0x9E3779B97F4A7C15)


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in these bytes."""
    edge = np.diff(np.concatenate([[True], _SPACE[data], [True]]).view(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def _hashes(data: np.ndarray) -> np.ndarray:
    start, end = spans(data)
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _IN_WORD.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], out=sums[1:])
    out = mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    for i in np.flatnonzero(end - start > LONG_WORD):
        out[i] = np.frombuffer(hashlib.blake2b(data[start[i]:end[i]].tobytes(), digest_size=8).digest(), np.uint64)[0]
    return out


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words of all texts in a row, place of each text's first word and one more at the end)."""
    parts, counts = [], np.zeros(len(texts) + 1, np.int64)
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) < BLOCK):
            size += len(texts[to]) + 1
            to += 1
        some = texts[at:to]
        if to == at + 1 and len(some[0]) > BLOCK:
            own = [_hashes(np.frombuffer(p, np.uint8)) for p in _pieces(some[0])]
            counts[to] = sum(map(len, own))
            parts += own
        else:
            data = np.frombuffer(b" ".join(some), np.uint8)
            start, _ = spans(data)
            begin = np.cumsum([0] + [len(t) + 1 for t in some])
            counts[at + 1:to + 1] = np.diff(np.searchsorted(start, begin))
            parts.append(_hashes(data))
        at = to
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.cumsum(counts)


def _pieces(text: bytes):
    """A long text in pieces of about a block, cut at white space only."""
    data, at = np.frombuffer(text, np.uint8), 0
    while at < len(text):
        to = min(at + BLOCK, len(text))
        while to < len(text):
            gap = np.flatnonzero(_SPACE[data[to:to + BLOCK]])
            if len(gap):
                to += int(gap[0])
                break
            to = min(to + BLOCK, len(text))
        yield text[at:to]
        at = to


class Runs:
    """Hashes of runs of words, from any start, of any length that stays inside one text."""

    def __init__(self, words: np.ndarray, powers: Powers):
        up, self.down = powers.upto(len(words) + 1)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[:-1], out=self.sums[1:])

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        return mixed((self.sums[starts + length] - self.sums[starts]) * self.down[starts])
