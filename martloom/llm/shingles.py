"""Word shingles as 64-bit hashes, and one-permutation MinHash signatures with optimal densification."""

from __future__ import annotations

from itertools import chain

import numpy as np
import xxhash


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    """The hash of a word, remembered up to a number of words."""

    def __init__(self, remembered: int = 500_000):
        self.remembered = remembered

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.remembered:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


class Shingler:
    """Sets of word shingles. Words are lower-cased in A-Z and end at the six ASCII blanks."""

    def __init__(self, words: int):
        self.words, self.hashes = words, WordHashes()

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        """For each UTF-8 text its distinct shingles in ascending order; of a shorter text, all its words as one."""
        words = [t.lower().split() for t in texts]
        counts = np.array([*map(len, words), 0])
        h = np.fromiter(map(self.hashes.__getitem__, chain.from_iterable(words)), np.uint64, counts.sum())
        width = self.words
        # A text of fewer words than a shingle never equals a full shingle: the number of words goes in.
        x = np.full(max(0, len(h) - width + 1), width, np.uint64)
        for i in range(width if len(x) else 0):
            x = mixed(x ^ h[i : len(h) - width + 1 + i]) + np.uint64(0x9E3779B97F4A7C15)
        x = mixed(x)
        sets, at = [], 0
        for n in counts[:-1].tolist():
            if n >= width:
                s = np.sort(x[at : at + n - width + 1])
                s = s[np.concatenate(([True], s[1:] != s[:-1]))]
            elif n:
                s = np.full(1, n, np.uint64)
                for i in range(n):
                    s = mixed(s ^ h[at + i]) + np.uint64(0x9E3779B97F4A7C15)
                s = mixed(s)
            else:
                s = np.zeros(0, np.uint64)
            sets.append(s)
            at += n
        return sets


class OnePermutation:
    """Signatures: the hash range is cut into bins, and a bin's value is the smallest shingle in it.

    An empty bin borrows from a bin drawn by hashing its number and the attempt, until one is found that is not
    empty. All texts draw in the same order, so each bin of two signatures agrees with the probability of their
    sets' similarity.
    """

    def __init__(self, bands: int, rows: int, seed: int = 1):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        draws = np.random.default_rng(seed)
        # Drawing without repetition ends after at most ``bins`` attempts.
        self.draws = np.argsort(draws.random((self.bins, self.bins)), axis=1).astype(np.int32)

    def signatures(self, sets: list[np.ndarray]) -> np.ndarray:
        """The signatures of ascending, non-empty sets, one row each."""
        lengths = np.array([*map(len, sets)])
        x = np.concatenate(sets)
        bins = ((x >> np.uint64(32)) * np.uint64(self.bins) >> np.uint64(32)).astype(np.int64)
        place = np.repeat(np.arange(len(sets)) * self.bins, lengths) + bins
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        value = np.zeros(len(sets) * self.bins, np.uint64)
        full = np.zeros(len(value), bool)
        value[place[first]], full[place[first]] = x[first], True
        empty = np.flatnonzero(~full)
        row, bin_ = empty - empty % self.bins, empty % self.bins
        source, waiting, attempt = empty.copy(), np.arange(len(empty)), 0
        while len(waiting):
            drawn = row[waiting] + self.draws[bin_[waiting], attempt]
            hit = full[drawn]
            source[waiting[hit]] = drawn[hit]
            waiting, attempt = waiting[~hit], attempt + 1
        value[empty] = value[source]
        return value.reshape(len(sets), self.bins)

    def band_hashes(self, sets: list[np.ndarray]) -> np.ndarray:
        """One signed 64-bit hash per set and band; the band's number is part of it."""
        x = np.arange(1, self.bands + 1, dtype=np.uint64)
        for row in np.moveaxis(self.signatures(sets).reshape(len(sets), self.bands, self.rows), 2, 0):
            x = mixed(x ^ row) + np.uint64(0x9E3779B97F4A7C15)
        return mixed(x).view(np.int64)
