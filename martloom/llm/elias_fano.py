"""Elias-Fano sequences and an n-gram trie made of them, laid out to be mapped into memory."""

from __future__ import annotations

import io

import numpy as np

# Lookups done at a time, so that what they touch stays in the processor's cache.
AT_ONCE = 1 << 15
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def _left(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    """``x << by``, nothing where that is 64 bits or more."""
    return np.where(by < np.uint64(64), x << np.minimum(by, np.uint64(63)), np.uint64(0))


def _select(words: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Place of the one in each 64-bit word that has ``left`` ones below it."""
    left, place = left.astype(np.int64), np.zeros(len(words), np.int64)
    for half in (32, 16, 8, 4, 2, 1):
        low = words & np.uint64((1 << half) - 1)
        ones = np.bitwise_count(low).astype(np.int64)
        above = left >= ones
        left = np.where(above, left - ones, left)
        words = np.where(above, words >> np.uint64(half), low)
        place += half * above
    return place


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and the place of each value among them."""
    values = np.unique(x)
    return values, np.searchsorted(values, x)


class EliasFano:
    """A sequence of integers that never falls, in about 2 + log2(range / length) bits each.

    The low bits stand packed one after the other; the high bits are a run of ones in unary, so the i-th one at place p
    says that the high part of value i is p - i. Ones before each byte of a 64-bit word are counted on the way, ones before
    a word are in a directory.
    """

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.width, self.low, self.high, self.ones = n, width, low, high, ones
        self.zeros: np.ndarray | None = None

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // max(1, n)).bit_length() - 1)
        bits = np.zeros(max(1, n) * width, np.uint8).reshape(-1, width) if width else np.zeros((0, 0), np.uint8)
        for b in range(width if n else 0):
            bits[:, b] = (values >> np.uint64(b)) & np.uint64(1)
        low = np.packbits(bits.ravel(), bitorder="little")
        places = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        size = (int(places[-1]) // 64 + 1) * 64 if n else 64
        marks = np.zeros(size, np.uint8)
        marks[places] = 1
        high = np.packbits(marks, bitorder="little")
        per_word = marks.reshape(-1, 64).sum(axis=1, dtype=np.int64)
        return cls(n, width, low, high, (np.cumsum(per_word) - per_word).astype(np.uint32))

    def decode(self) -> np.ndarray:
        """All values, read front to back."""
        places = np.flatnonzero(np.unpackbits(np.asarray(self.high), bitorder="little"))[: self.n]
        values = (places - np.arange(self.n)).astype(np.uint64) << np.uint64(self.width)
        if self.width and self.n:
            bits = np.unpackbits(np.asarray(self.low), bitorder="little")[: self.n * self.width].reshape(self.n, self.width)
            for b in range(self.width):
                values |= bits[:, b].astype(np.uint64) << np.uint64(b)
        return values

    def __getitem__(self, i: int) -> int:
        """Value ``i`` without reading the others."""
        word = int(np.searchsorted(self.ones, i, "right")) - 1
        left = i - int(self.ones[word])
        for byte in range(word * 8, word * 8 + 8):
            here = int(_POPCOUNT[self.high[byte]])
            if left < here:
                place = byte * 8 + [b for b in range(8) if self.high[byte] >> b & 1][left]
                break
            left -= here
        value = (place - i) << self.width
        start = i * self.width
        for b in range(self.width):
            value |= int(self.low[(start + b) // 8] >> ((start + b) % 8) & 1) << b
        return value

    def successor(self, x: int, start: int, stop: int) -> int:
        """The first place in ``start`` .. ``stop`` whose value is at least ``x``, or ``stop``."""
        while start < stop:
            middle = (start + stop) // 2
            if self[middle] < x:
                start = middle + 1
            else:
                stop = middle
        return start

    def _low_bits(self, i: np.ndarray) -> np.ndarray:
        """The low bits of the values at some places."""
        out = np.zeros(len(i), np.uint64)
        if not self.width or not len(i):
            return out
        at, shift = np.divmod(i * self.width, 8)
        shift = shift.astype(np.uint64)
        last = len(self.low) - 1
        for byte in range((self.width + 14) // 8):
            # Bits beyond the last byte are not used.
            here = self.low[np.minimum(at + byte, last)].astype(np.uint64)
            out |= here >> shift if byte == 0 else _left(here, np.uint64(8 * byte) - shift)
        return out & np.uint64((1 << self.width) - 1)

    def take(self, i: np.ndarray) -> np.ndarray:
        """Values at some places, each read on its own."""
        i = np.asarray(i, np.int64)
        word = np.searchsorted(self.ones, i, "right") - 1
        place = word * 64 + _select(self.high.view(np.uint64)[word], i - self.ones[word])
        return ((place - i).astype(np.uint64) << np.uint64(self.width)) | self._low_bits(i)

    def _zeros(self) -> np.ndarray:
        """Zeros before each word, from the directory of ones."""
        if self.zeros is None:
            self.zeros = np.arange(len(self.ones)) * 64 - self.ones
        return self.zeros

    def _below(self, high: np.ndarray) -> np.ndarray:
        """How many values have a high part below each of the given ones: the ones before the zero that ends it."""
        words = self.high.view(np.uint64)
        zero = np.minimum(high, np.uint64(64 * len(words))).astype(np.int64) - 1
        out = np.full(len(high), self.n)
        out[zero < 0] = 0
        inside = np.flatnonzero((zero >= 0) & (zero < 64 * len(words) - self.n))
        zero = zero[inside]
        zeros = self._zeros()
        word = np.searchsorted(zeros, zero, "right") - 1
        out[inside] = word * 64 + _select(~words[word], zero - zeros[word]) - zero
        return out

    def successors(self, x: np.ndarray, start: np.ndarray | int, stop: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """As ``successor`` for many values in ranges of their own, and whether the value itself is there.

        The high bits tell where values with the same high part are, so only the low bits of those few are compared.
        """
        x = np.asarray(x, np.uint64)
        if len(x) > AT_ONCE:
            start, stop = np.broadcast_to(start, x.shape), np.broadcast_to(stop, x.shape)
            parts = [slice(a, a + AT_ONCE) for a in range(0, len(x), AT_ONCE)]
            places, founds = zip(*[self.successors(x[p], start[p], stop[p]) for p in parts], strict=True)
            return np.concatenate(places), np.concatenate(founds)
        high, wanted = x >> np.uint64(self.width), x & np.uint64((1 << self.width) - 1)
        first = np.clip(self._below(high), start, stop)
        # A high part that has no greater one is followed by nothing.
        end = np.clip(self._below(high + np.uint64(1)), first, stop)
        end = np.where(high == np.uint64(0xFFFFFFFFFFFFFFFF), stop, end)
        at, after = first.copy(), end.copy()
        active = np.flatnonzero(at < after)
        while len(active):
            middle = (at[active] + after[active]) // 2
            less = self._low_bits(middle) < wanted[active]
            at[active] = np.where(less, middle + 1, at[active])
            after[active] = np.where(less, after[active], middle)
            active = active[at[active] < after[active]]
        found = at < end
        here = np.flatnonzero(found)
        found[here] = self._low_bits(at[here]) == wanted[here]
        return at, found

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.width], np.int64), self.low, self.high, self.ones]


class BigramTrie:
    """Contexts, the words that follow each, and quantised log probabilities of the pairs.

    Level 1 holds the contexts and, as a second sequence, where the followers of each begin: both never fall. Level 2
    holds the followers. A follower is stored by its rank among this trie's words, on top of its context's share of the
    range, so the level never falls as a whole and within a context a word is found as a successor relative to it.
    """

    def __init__(self, contexts: EliasFano, pointers: EliasFano, words: EliasFano, followers: EliasFano, codes: np.ndarray):
        self.contexts, self.pointers, self.words, self.followers, self.codes = contexts, pointers, words, followers, codes

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, codes: np.ndarray) -> BigramTrie:
        """From distinct pairs sorted by context, then word."""
        contexts, first = np.unique(context, return_index=True)
        words, rank = np.unique(word, return_inverse=True)
        share = np.repeat(np.arange(len(contexts)), np.diff([*first, len(context)])) * len(words)
        return cls(
            EliasFano.build(contexts), EliasFano.build(np.append(first, len(context))), EliasFano.build(words),
            EliasFano.build((share + rank).astype(np.uint64)), codes.astype(np.uint16),
        )

    def find(self, context: int, word: int) -> int:
        """The code of a pair, or -1."""
        c = self.contexts.successor(context, 0, self.contexts.n)
        w = self.words.successor(word, 0, self.words.n)
        if c == self.contexts.n or w == self.words.n or self.contexts[c] != context or self.words[w] != word:
            return -1
        key = c * self.words.n + w
        stop = self.pointers[c + 1]
        at = self.followers.successor(key, self.pointers[c], stop)
        return int(self.codes[at]) if at < stop and self.followers[at] == key else -1

    def find_all(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The codes of many pairs, -1 where a pair is missing.

        Contexts and words are looked up once each; the pointers give the range of a context's followers, in which the word is
        found as a successor. The levels stay packed.
        """
        codes = np.full(len(context), -1, np.int32)
        if not self.contexts.n or not len(context):
            return codes
        contexts, of_context = _distinct(context.astype(np.uint64))
        words, of_word = _distinct(word.astype(np.uint64))
        c, c_ok = self.contexts.successors(contexts, 0, self.contexts.n)
        w, w_ok = self.words.successors(words, 0, self.words.n)
        c = np.minimum(c, self.contexts.n - 1)
        begin, end = (self.pointers.take(at).astype(np.int64) for at in (c, c + 1))
        known = np.flatnonzero(c_ok[of_context] & w_ok[of_word])
        # Each distinct pair is looked up once, those of one context after each other.
        asked, of_pair = _distinct(of_context[known] * len(words) + of_word[known])
        at_context, at_word = np.divmod(asked, len(words))
        key = c[at_context] * self.words.n + w[at_word]
        at, ok = self.followers.successors(key, begin[at_context], end[at_context])
        found = np.full(len(asked), -1, np.int32)
        found[ok] = self.codes[at[ok]]
        codes[known] = found[of_pair]
        return codes

    def write(self, sink) -> None:
        for level in (self.contexts, self.pointers, self.words, self.followers):
            for array in level.arrays():
                self._put(sink, array)
        self._put(sink, self.codes)

    @staticmethod
    def _put(sink, array: np.ndarray) -> None:
        out = io.BytesIO()
        np.lib.format.write_array(out, np.ascontiguousarray(array), allow_pickle=False)
        sink.write(out.getvalue() + bytes(-len(out.getvalue()) % 64))

    @classmethod
    def open(cls, buffer) -> BigramTrie:
        """Over the bytes of a file, which are not copied."""
        view, at, found = memoryview(buffer), 0, []
        while at < len(view):
            head = io.BytesIO(bytes(view[at : at + 256]))
            np.lib.format.read_magic(head)
            shape, _, dtype = np.lib.format.read_array_header_1_0(head)
            start = at + head.tell()
            found.append(np.frombuffer(view, dtype, shape[0], start))
            end = start + shape[0] * dtype.itemsize
            at += -(-(end - at) // 64) * 64
        levels = [EliasFano(int(n[0]), int(n[1]), *found[4 * i + 1 : 4 * i + 4]) for i, n in enumerate(found[0:16:4])]
        return cls(*levels, found[16])
