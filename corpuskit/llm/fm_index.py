"""A compressed FM-index in numpy: wavelet matrix over the Burrows-Wheeler transform, sampled suffix array.

All searches are batched: one step of backward search moves every pattern by one symbol. Of the suffix
array only every SAMPLE-th position is kept, in four bytes; other places are found by walking back
through the transform. The text stays beside it in one or two bytes a symbol, for extensions to the right.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16
PLACES = 200_000  # occurrences extended at once


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Prefix doubling in which only suffixes of still equal rank are sorted again."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, np.int64)
    new = np.ones(n, bool)
    new[1:] = text[order[1:]] != text[order[:-1]]
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    bounds, k = np.append(new, True), 1
    while True:
        tied = ~(bounds[:-1] & bounds[1:])
        at = np.nonzero(tied)[0]
        if not len(at) or k > n:
            return order
        items = order[at]
        after = np.where(items + k < n, rank[np.minimum(items + k, n - 1)] + 1, 0)
        group = rank[items]
        perm = np.argsort(group * (n + 1) + after)
        items, group, after = items[perm], group[perm], after[perm]
        order[at] = items
        fresh = np.ones(len(at), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (after[1:] != after[:-1])
        bounds[at] = fresh
        rank[items] = np.maximum.accumulate(np.where(fresh, at, 0))
        k *= 2


class BitRank:
    """Bits packed in 64-bit words with a running count per word."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(np.pad(bits, (0, -len(bits) % 64 + 64)), bitorder="little")
        self.words = packed.view(np.uint64)
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)

    def rank1(self, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, sigma: int) -> None:
        self.levels = max(1, int(sigma - 1).bit_length())
        self.bits: list[BitRank] = []
        self.zeros: list[int] = []
        now = symbols
        for level in range(self.levels - 1, -1, -1):
            bit = (now >> level) & 1 == 1
            self.bits.append(BitRank(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            now = np.concatenate([now[~bit], now[bit]])
        self.first = self._descend(np.arange(sigma), np.zeros(sigma, np.int64))

    def _descend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, bits, zeros in zip(range(self.levels - 1, -1, -1), self.bits, self.zeros):
            ones = bits.rank1(i)
            i = np.where((symbol >> level) & 1 == 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often symbol occurs before i."""
        return self._descend(symbol, i) - self.first[symbol]

    def at(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at i, and how often it occurs before i."""
        symbol = np.zeros(len(i), np.int64)
        for bits, zeros in zip(self.bits, self.zeros):
            bit, ones = bits.get(i), bits.rank1(i)
            symbol = symbol << 1 | bit
            i = np.where(bit, zeros + ones, i - ones)
        return symbol, i - self.first[symbol]


class FMIndex:
    """Over texts joined by a separator; positions refer to ``self.text``."""

    SEPARATOR, END = 1, 0

    def __init__(self, parts: list[np.ndarray]) -> None:
        self.alphabet = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint32)
        sigma = len(self.alphabet) + 2
        body = []
        for part in parts:
            body += [np.searchsorted(self.alphabet, part) + 2, [self.SEPARATOR]]
        text = np.concatenate([*body, [self.END]]).astype(np.int64)
        self.text = text.astype(np.uint8 if sigma <= 256 else np.uint16 if sigma <= 65536 else np.uint32)
        lengths = np.array([len(p) + 1 for p in parts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        order = suffix_array(text)
        self.bwt = WaveletMatrix(text[order - 1], sigma)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        sampled = order % SAMPLE == 0
        self.marks, self.samples = BitRank(sampled), (order[sampled] // SAMPLE).astype(np.int32)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix array."""
        out, rows, open_, steps = np.empty(len(rows), np.int64), rows.copy(), np.arange(len(rows)), 0
        while len(open_):
            known = self.marks.get(rows[open_])
            done = open_[known]
            out[done] = self.samples[self.marks.rank1(rows[done])].astype(np.int64) * SAMPLE + steps
            open_ = open_[~known]
            symbol, before = self.bwt.at(rows[open_])
            rows[open_] = self.less[symbol] + before
            steps += 1
        return out

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """Symbols of the index for code points; -1 where the index doesn't have the code point."""
        if not len(self.alphabet):
            return np.full(len(codes), -1)
        at = np.minimum(np.searchsorted(self.alphabet, codes), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == codes, at + 2, -1)

    def backward(self, symbols: np.ndarray, ends: np.ndarray, length: int, most: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Suffix-array intervals of ``symbols[end - length : end]`` for every end, empty: lo = hi; and the
        matching statistics up to ``most``: how long a stretch before each end occurs in the index."""
        most = max(most, length)
        lo, hi = np.zeros(len(ends), np.int64), np.full(len(ends), len(self.text), np.int64)
        found, statistics = [lo, hi], np.zeros(len(ends), np.int64)
        alive = np.arange(len(ends))
        for step in range(1, most + 1):
            alive = alive[ends[alive] >= step]
            s = symbols[ends[alive] - step]
            alive, s = alive[s >= 0], s[s >= 0]
            both = self.bwt.rank(np.concatenate([s, s]), np.concatenate([lo[alive], hi[alive]]))
            lo[alive], hi[alive] = self.less[s] + both[: len(s)], self.less[s] + both[len(s) :]
            alive = alive[lo[alive] < hi[alive]]
            statistics[alive] = step
            if step == length:
                found = [lo.copy(), hi.copy()]
            if not len(alive):
                break
        whole = statistics >= length
        return np.where(whole, found[0], 0), np.where(whole, found[1], 0), statistics


def common_prefix(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray, most: int, step: int) -> np.ndarray:
    """Length, up to ``most``, of the match of a[at], a[at + step], ... with b[bt], ...; arrays have margins."""
    span = np.arange(most) * step
    out = np.empty(len(at), np.int64)
    for i in range(0, len(at), 8192):
        same = a[at[i : i + 8192, None] + span] == b[bt[i : i + 8192, None] + span]
        out[i : i + 8192] = np.where(same.all(1), most, same.argmin(1))
    return out


def long_matches(index: FMIndex, query: np.ndarray, starts: np.ndarray, least: int) -> np.ndarray:
    """Matching statistics at block ends, extended to intervals.

    Rows (query row, index part, start, end) of spans of at least ``least`` symbols that a query row
    shares with a part. Such a span holds a block of least // 2 aligned to the row, and the last of its
    block ends has a matching statistic above least - block; only these ends are looked up. The reported
    intervals reach least - block beyond their block, and their union is the whole span.
    """
    block = least // 2
    lengths = np.diff(starts)
    counts = np.maximum(lengths, 0) // block
    rows = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = starts[:-1][rows] + within * block
    # margins: rows of the query end in -2, which no text has
    symbols = index.symbols(query)
    wide = np.full(len(query) + len(lengths) + 2 * least, -2, np.int64)
    wide[np.arange(len(query)) + np.repeat(np.arange(len(lengths)), lengths) + least] = symbols
    at = begin + rows + least  # blocks in the query with its margins
    lo, hi, statistics = index.backward(wide, at + block, block, least)
    pick = np.nonzero((statistics > least - block) | (statistics >= least))[0]
    n = (hi - lo)[pick]
    text = np.concatenate([np.full(least, -3), index.text, np.full(least, -3)]).astype(np.int32)
    out = [np.zeros((0, 4), np.int64)]
    cuts = np.searchsorted(np.cumsum(n), np.arange(PLACES, int(n.sum()) + PLACES, PLACES), side="left") + 1
    for a, b in zip(np.r_[0, cuts[:-1]].tolist(), cuts.tolist()):
        some, m = pick[a:b], n[a:b]
        which = np.repeat(some, m)
        if not len(which):
            continue
        places = index.locate(np.repeat(lo[some] - np.cumsum(m) + m, m) + np.arange(int(m.sum())))
        part = np.searchsorted(index.starts, places, side="right") - 1
        q = at[which]
        left = common_prefix(wide, q - 1, text, places + least - 1, least - block, -1)
        right = common_prefix(wide, q + block, text, places + least + block, least - block, 1)
        keep = left + block + right >= least
        head = within[which] * block
        out.append(np.stack([rows[which], part, head - left, head + block + right], 1)[keep])
    return np.concatenate(out)
