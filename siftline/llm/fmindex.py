"""A compressed full-text index over words: a truncated Burrows-Wheeler transform in a wavelet matrix.

Suffixes are sorted by their first `k` symbols only. Backward search is exact for patterns of up to k symbols, and many
patterns advance by a symbol at once. Beside the matrix, bit vectors mark where suffixes differ in their first k and k - 1
symbols, and each group of suffixes that share k symbols keeps the number of the first passage that has them. That is all
that stays: some 7 bytes a symbol.
"""

from __future__ import annotations

import numpy as np

from .common import U64


def dense(keys: np.ndarray) -> np.ndarray:
    """The ranks of keys among their distinct values."""
    order = np.argsort(keys, kind="stable")
    own = keys[order]
    out = np.empty(len(keys), np.int64)
    out[order] = np.concatenate(([0], np.cumsum(own[1:] != own[:-1])))
    return out


def later(r: np.ndarray, by: int) -> np.ndarray:
    """r moved to the left, with the least rank, that of the separator, behind its end."""
    out = np.zeros_like(r)
    out[: max(0, len(r) - by)] = r[by:]
    return out


class Bits:
    """A packed bit vector that counts its ones up to any place, and finds any of them."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = (np.cumsum(np.bitwise_count(self.words), dtype=np.int64) - np.bitwise_count(self.words)).astype(np.uint32)
        self.zeros = len(bits) - int(bits.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        return self.before[word].astype(np.int64) + np.bitwise_count(self.words[word] & ((U64(1) << (at & 63).astype(U64)) - U64(1)))

    def place(self, r: np.ndarray) -> np.ndarray:
        """Where the r-th one is, from 0."""
        word = np.searchsorted(self.before, r.astype(np.uint32), "right") - 1
        rest, w, at = r - self.before[word], self.words[word], word << 6
        for step in (32, 16, 8, 4, 2, 1):
            low = np.bitwise_count(w & U64((1 << step) - 1)).astype(np.int64)
            on = low <= rest
            rest, w, at = rest - np.where(on, low, 0), np.where(on, w >> U64(step), w), at + np.where(on, step, 0)
        return at


class Index:
    """Of passages of word hashes, one behind the other, `size` words each; finds patterns of up to k words."""

    def __init__(self, words: np.ndarray, size: np.ndarray, k: int):
        #: The words that have a symbol, from 1 on; 0 separates passages.
        self.symbols, which = np.unique(words, return_inverse=True)
        long = size + 1
        begin = np.cumsum(long) - long
        text = np.zeros(int(long.sum()), np.int64)
        inside = np.ones(len(text), bool)
        inside[begin + size] = False
        text[inside] = which + 1
        n, self.k, self.n = len(text), k, len(text)
        steps, r = 1, text
        while 2 * steps < k:
            r = dense(r * (int(r.max()) + 1) + later(r, steps))
            steps *= 2
        base = int(r.max()) + 1
        key = r * base + later(r, k - steps)
        order = np.argsort(key, kind="stable")
        #: Where suffixes begin to differ from those before in k symbols, and in k - 1; with an end.
        self.groups, starts = self._starts(key[order])
        self.wider = self._starts((r * base + later(r, k - 1 - steps) if k - 1 > steps else r)[order])[0]
        #: The first passage of each group.
        self.first = np.minimum.reduceat(np.repeat(np.arange(len(size), dtype=np.uint32), long)[order], starts)
        symbols = len(self.symbols) + 1
        smaller = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))[:-1]))
        v = text[order - 1]
        self.levels: list[tuple[int, Bits]] = []
        for shift in range(max(1, (symbols - 1).bit_length()) - 1, -1, -1):
            bit = (v >> shift) & 1
            self.levels.append((shift, Bits(bit)))
            v = np.concatenate((v[bit == 0], v[bit == 1]))
        self.base = (smaller - self._descend(np.arange(symbols), np.zeros(symbols, np.int64))).astype(np.int32)

    def _starts(self, key: np.ndarray) -> tuple[Bits, np.ndarray]:
        new = np.concatenate(([True], key[1:] != key[:-1], [True]))
        return Bits(new), np.flatnonzero(new[:-1])

    def _descend(self, c: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits in self.levels:
            ones = bits.ones(at)
            at = np.where((c >> shift) & 1, bits.zeros + ones, at - ones)
        return at

    def bytes(self) -> int:
        held = [b for _, b in self.levels] + [self.groups, self.wider]
        return self.symbols.nbytes + self.first.nbytes + self.base.nbytes + sum(b.words.nbytes + b.before.nbytes for b in held)

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the patterns with the symbols c before them."""
        both = self._descend(np.concatenate((c, c)), np.concatenate((lo, hi))) + np.concatenate((self.base[c], self.base[c]))
        return both[: len(c)], both[len(c) :]

    def widen(self, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the first k - 1 symbols of patterns of k symbols."""
        g = self.wider.ones(lo + 1) - 1
        return self.wider.place(g), self.wider.place(g + 1)

    def search(self, words: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Streams the passages words[first : first + size] through the index: matching statistics, cut off at k.

        For each place of a passage from which k words stand somewhere in the index: the passage, the place in it and the
        number of the first indexed passage that has them. A pattern grows to the left; with k words it loses its last,
        and where it can't grow it begins anew one word further to the left of its end.
        """
        text = np.minimum(np.searchsorted(self.symbols, words), len(self.symbols) - 1)
        text = np.where(self.symbols[text] == words, text + 1, 0)
        lane = np.flatnonzero(size >= self.k)
        begin, end = first[lane], (first + size)[lane]
        place, matched, lo, hi = end.copy(), np.zeros(len(lane), np.int64), np.zeros(len(lane), np.int64), np.full(len(lane), self.n)
        who, at, owner = [], [], []
        while len(lane):
            full = np.flatnonzero(matched == self.k)
            lo[full], hi[full] = self.widen(lo[full])
            matched[full] -= 1
            end[full] -= 1
            place -= 1
            c = text[place]
            lo, hi = self.extend(c, lo, hi)
            lost = (lo >= hi) | (c == 0)
            end[lost] = np.where(c[lost] == 0, place[lost], end[lost] - 1)
            place[lost] = end[lost]
            lo[lost], hi[lost] = 0, self.n
            matched = np.where(lost, 0, matched + 1)
            found = np.flatnonzero(matched == self.k)
            who.append(lane[found])
            at.append((place - begin)[found])
            owner.append(self.first[self.groups.ones(lo[found] + 1) - 1])
            live = np.flatnonzero(end - (matched == self.k) - begin >= self.k)
            if len(live) < len(lane):
                lane, begin, end, place, matched, lo, hi = (x[live] for x in (lane, begin, end, place, matched, lo, hi))
        cat = lambda x: np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64)
        return cat(who), cat(at), cat(owner)
