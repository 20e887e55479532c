"""Sentence alignment in bilingual documents (problem 5).

Words, the sentences they stand in and their neighbours are counted over all records. Skip-gram
vectors of both languages are trained on these counts, all at once, and brought into one space by
orthogonal Procrustes, seeded with a glossary and then with the word pairs that a first alignment of all
records suggests. A sentence is the weighted sum of its words' vectors; numbers are compared beside it, in one
unit. Every record is then aligned: time warping at half resolution gives a corridor, recursively, and
only its cells are visited at full resolution; what stays unaligned is matched anew without regard to
order.

Defined cases: a null or blank side gives no rows; repeated sentences align each; any number of
sentences and clauses is aligned; records without a match give no rows; more than MOST_TERMS terms or
MOST_WORDS words raise an error.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

DIM, WINDOW, NEGATIVES = 64, 8, 6
ROUNDS, RATE, BLOCK = 40, 0.5, 512  # of the training: rounds over all counts, length of steps, words at once
INIT, START = 0.2, 1e-2  # random values as large keep words apart that few sentences tell apart; squares of gradients at the start
TALLY_ROWS, TALLY_PARTS = 1 << 22, 32  # keys counted at once, parts of the counts
LEAST_COUNT, RAREST = 3, 5_000  # a word stands in at least so many sentences, and in one of so many
MOST_TERMS, MOST_WORDS = 100_000, 500_000
BEST, MERGED = 0.42, 0.70
SURE = 0.45  # score from which a first alignment proposes seeds
MOST_CLAUSES = 12  # clauses that a sentence of the other language may cover, besides all of them
SMALL = 16  # sentences on a side up to which the whole matrix is warped
TOGETHER = 256  # sections scored together

EN_END = re.compile(r"(?<=[.!?])\s+")
ZH_END = re.compile(r"(?<=[。！？])")
# Words for numbers.
ORDINALS = {w: i for i, w in enumerate("first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth".split(), 1)}
MONTHS = {w: i for i, w in enumerate("january february march april may june july august september october november december".split(), 1)}
ZH_DIGIT = {c: i for i, c in enumerate("零一二三四五六七八九")} | {"〇": 0, "两": 2}
ZH_NUMBER = re.compile(r"\d+(?:\.\d+)?|[零〇一二两三四五六七八九十百]+")


def split_en(text: str) -> list[str]:
    return [s for s in (x.strip() for x in EN_END.split(text.strip())) if s]


def split_zh(text: str) -> list[str]:
    return [s for s in (x.strip() for x in ZH_END.split(text.strip())) if s]


def zh_value(word: str) -> float:
    if word[0].isdigit():
        return float(word)
    total, now = 0, 0
    for c in word:
        if c == "百":
            total, now = total + (now or 1) * 100, 0
        elif c == "十":
            total, now = total + (now or 1) * 10, 0
        else:
            now = ZH_DIGIT[c]
    return float(total + now)


def numbers_en(text: str) -> Counter:
    out: Counter = Counter()
    low = text.lower()
    for m in re.finditer(r"\d+(?:\.\d+)?", low):
        unit = low[m.end() : m.end() + 3].strip()
        out[f"{float(m[0]) * (10 if unit == 'cm' else 1):.4g}"] += 1
    for w in re.findall(r"[a-z]+", low):
        if w in ORDINALS:
            out[f"{ORDINALS[w]}"] += 1
        elif w in MONTHS:
            out[f"m{MONTHS[w]}"] += 1
    return out


def numbers_zh(text: str) -> Counter:
    out: Counter = Counter()
    for m in ZH_NUMBER.finditer(text):
        unit = text[m.end() : m.end() + 2]
        value = zh_value(m[0])
        out[f"m{int(value)}" if unit[:1] == "月" else f"{value * (10 if unit == '厘米' else 1):.4g}"] += 1
    return out


def words_en(text: str) -> list[str]:
    return re.findall(r"[a-z]+", text.lower())


def words_zh(text: str) -> list[str]:
    out = []
    for run in re.findall(r"[A-Za-z]+|[一-鿿]+", text):
        out += [run.lower()] if run[0].isascii() else [*run, *(run[i : i + 2] for i in range(len(run) - 1))]
    return out


class Tally:
    """Counts of whole numbers, kept sorted."""

    def __init__(self) -> None:
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.n = 0

    def add(self, keys: np.ndarray) -> None:
        self.waiting.append(keys)
        self.n += len(keys)
        if self.n > TALLY_ROWS:
            self.settle()

    def settle(self) -> None:
        if self.waiting:
            keys, counts = np.unique(np.concatenate(self.waiting), return_counts=True)
            self.keys, self.counts = summed(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))
            self.waiting, self.n = [], 0

    def rows(self, side: int) -> Iterator[tuple[int, int, bytes, bytes]]:
        self.settle()
        part = self.keys % TALLY_PARTS
        for p in np.unique(part).tolist():
            yield side, p, self.keys[part == p].tobytes(), self.counts[part == p].tobytes()


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in their order, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.nonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])[0]
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts


TALLIES = "side int, part int, keys binary, counts binary"


def tally_batch(rows: list[tuple[int, int, bytes, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["side", "part", "keys", "counts"])


def _together(group: pa.Table) -> pa.Table:
    keys, counts = (np.frombuffer(b"".join(group.column(c).to_pylist()), np.int64) for c in ("keys", "counts"))
    keys, counts = summed(keys, counts)
    return pa.Table.from_batches([tally_batch([(group.column("side")[0].as_py(), group.column("part")[0].as_py(), keys.tobytes(), counts.tobytes())])])


def tallies(df: DataFrame, run) -> DataFrame:
    """The tallies of all tasks, united by part."""
    return cut(df.mapInArrow(run, TALLIES).groupBy("side", "part").applyInArrow(_together, TALLIES))


def skip_gram(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Skip-gram with negative sampling, its expected loss over all counted pairs, in rounds with adaptive steps.

    ``counts`` of words row <= column at ``keys`` = row * size + column. Each round takes all pairs and, for
    negatives, all words by their weight; time grows with the square of the words, not with the rows.
    """
    rng, scale = np.random.default_rng(11), INIT
    w, c = rng.uniform(-scale, scale, (size, DIM)).astype(np.float32), rng.uniform(-scale, scale, (size, DIM)).astype(np.float32)
    if not len(keys):
        return w
    row, column = np.divmod(keys, size)
    row, column, counts = np.concatenate([row, column]), np.concatenate([column, row]), np.concatenate([counts, counts])
    total = np.bincount(row, counts, size)
    order = np.argsort(row, kind="stable")
    row, column = row[order], column[order]
    share = (counts[order] / total[row]).astype(np.float32)
    noise = (NEGATIVES * total**0.75 / (total**0.75).sum()).astype(np.float32)
    weight = (total / total.mean()).astype(np.float32)[:, None]
    begin = np.arange(0, size, BLOCK)
    at = np.searchsorted(row, [*begin, size])
    gw, gc = np.full(size, START, np.float32), np.full(size, START, np.float32)
    for _ in range(ROUNDS):
        dc = np.zeros_like(c)
        for k, first in enumerate(begin.tolist()):
            here, some = slice(first, first + BLOCK), slice(at[k], at[k + 1])
            x = w[here]
            near = x @ c.T
            np.clip(near, -30, 30, out=near)
            np.exp(np.negative(near, out=near), out=near)
            near += 1
            np.reciprocal(near, out=near)
            pull = share[some] * (near[row[some] - first, column[some]] - 1)
            near *= noise
            # a pair of the same word has two entries
            np.add.at(near, (row[some] - first, column[some]), pull)
            dw = near @ c
            dc += near.T @ (weight[here] * x)
            gw[here] += (dw**2).mean(1)
            w[here] -= RATE * dw / np.sqrt(gw[here])[:, None]
        dc /= np.maximum(weight, 1e-9)
        gc += (dc**2).mean(1)
        c -= RATE * dc / np.sqrt(gc)[:, None]
    return w


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)


def warp(score: np.ndarray, lo: np.ndarray | None = None, hi: np.ndarray | None = None) -> list[tuple[int, int, bool]]:
    """Best monotone path of matches, repeats (merges) and gaps through the cells ``lo[i] <= j < hi[i]``.

    Its cells as (i, j, whether they match).
    """
    n, m = score.shape
    lo, hi = ([0] * n, [m] * n) if lo is None else (lo.tolist(), hi.tolist())
    gain = (score - 0.35).tolist()
    none = -1e18
    before, left_of, upto = [0.0] * (m + 1), 0, m  # best values of the row before, and its columns
    moves: list[list[int]] = []
    for i in range(n):
        a, b = lo[i], hi[i]
        row, move = [], []
        left = none if a else 0.0
        if not a:
            row.append(0.0)  # column 0: nothing of the other side used
        for j in range(a, b):
            up = before[j + 1 - left_of] if left_of <= j + 1 <= upto else none
            back = before[j - left_of] if left_of <= j <= upto else none
            g = gain[i][j]
            best, k = (up, 1) if up >= left else (left, 2)
            if g > 0:
                if back + g > best:
                    best, k = back + g, 3
                if up + g > best:
                    best, k = up + g, 4
                if left + g > best:
                    best, k = left + g, 5
            row.append(best)
            move.append(k)
            left = best
        moves.append(move)
        before, left_of, upto = row, a + (a > 0), b
    out, i, j = [], n, m
    while i and j:
        if not lo[i - 1] <= j - 1 < hi[i - 1]:
            break
        k = moves[i - 1][j - 1 - lo[i - 1]]
        out.append((i - 1, j - 1, k >= 3))
        i -= k in (1, 3, 4)
        j -= k in (2, 3, 5)
    return out[::-1]


def corridor(score: np.ndarray) -> tuple[np.ndarray, np.ndarray] | tuple[None, None]:
    """For each row the columns near the path found at half resolution (blocks of two sentences)."""
    n, m = score.shape
    if min(n, m) <= SMALL:
        return None, None
    coarse = np.full(((n + 1) // 2 * 2, (m + 1) // 2 * 2), -1.0, score.dtype)
    coarse[:n, :m] = score
    coarse = coarse.reshape(coarse.shape[0] // 2, 2, coarse.shape[1] // 2, 2).max((1, 3))
    low, high = np.full(len(coarse), m), np.zeros(len(coarse), np.int64)
    for i, j, _ in [(0, 0, False), *warp(coarse, *corridor(coarse)), (len(coarse) - 1, coarse.shape[1] - 1, False)]:
        low[i], high[i] = min(low[i], 2 * j - 2), max(high[i], 2 * j + 4)
    # rows that the path skips, and one block more on either side; the columns never go back
    low = np.minimum.accumulate(np.r_[low[1:], low[-1]][::-1])[::-1]
    low = np.minimum(low, np.r_[low[0], low[:-1]])
    high = np.maximum.accumulate(np.r_[high[0], high[:-1]])
    high = np.maximum(high, np.r_[high[1:], m])
    low, high = np.repeat(low, 2)[:n].clip(0, m - 1), np.repeat(high, 2)[:n].clip(1, m)
    low[0], high[-1] = 0, m
    return low, np.maximum(np.maximum.accumulate(high), low + 1)


class Sections:
    """Sentences, clauses, word vectors and numbers of the sections of one language, laid out flat."""

    def __init__(self, texts: list[str], side: int, vocab: dict[str, int], table: np.ndarray) -> None:
        words, split = (words_zh, split_zh) if side else (words_en, split_en)
        self.sentences: list[int] = []  # sentences of each section
        ids: list[int] = []
        bounds, first, last = [0], [], []  # words of each part; first part and end of each span of parts
        per_sentence: list[int] = []
        self.numbers: list[list[str]] = []
        none = len(vocab)
        for text in texts:
            sentences = split(text)
            self.sentences.append(len(sentences))
            for s in sentences:
                parts = [p for p in (re.split(r"[；;，,]", s) if side else re.split(r";|,? and (?=[a-z]+ )", s)) if p.strip()] or [s]
                if not side and len(parts) > 1:
                    parts = [s, *parts]  # the words between parts count for the whole
                at, n = len(bounds) - 1, len(parts)
                found = []
                for p in parts:
                    ids += [vocab[w] for w in words(p) if w in vocab]
                    ids.append(none)  # a word without weight: no part is empty
                    bounds.append(len(ids))
                    found.append(list((numbers_zh if side else numbers_en)(p).elements()) if side or HAS_NUMBER.search(p) else [])
                spans = [(i, i + 1) for i in range(n)]
                if side:
                    spans = [(i, j) for i in range(n) for j in range(i + 1, min(n, i + MOST_CLAUSES) + 1)]
                    spans += [(0, n)] * (n > MOST_CLAUSES)
                for i, j in spans:
                    first.append(at + i)
                    last.append(at + j)
                    self.numbers.append(found[i] if j == i + 1 else [x for f in found[i:j] for x in f])
                per_sentence.append(len(spans))
        self.rows = np.array(per_sentence, np.int64)
        # running sums over the parts: a span of parts is a difference of two of them
        sums = np.zeros((len(bounds), table.shape[1]))
        np.cumsum(bag_sums(table, np.array(ids, np.int64), np.array(bounds, np.int64)), axis=0, out=sums[1:])
        self.vectors = unit((sums[last] - sums[first]).astype(np.float32))


def bag_sums(table: np.ndarray, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the table's rows over each stretch of ids: the first words of all stretches, then the second ones, ..."""
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    begin, left = bounds[:-1][order], np.sort(lengths)
    sums = np.zeros((len(lengths), table.shape[1]), np.float32)
    for k in range(int(left[-1]) if len(left) else 0):
        n = len(left) - int(np.searchsorted(left, k, side="right"))  # stretches longer than k
        sums[:n] += table[ids[begin[:n] + k]]
    out = np.empty_like(sums)
    out[order] = sums
    return out


# English words that name numbers, as a quick test.
HAS_NUMBER = re.compile(r"\d|\b(?:" + "|".join([*ORDINALS, *MONTHS]) + r")\b", re.I)


def number_dice(a: list[list[str]], b: list[list[str]]) -> np.ndarray:
    """Dice coefficients of bags of numbers."""
    where = {x: i for i, x in enumerate({x for xs in a for x in xs})}
    size = len(where) + 1
    bags = []
    for side in (a, b):
        bag = np.zeros((len(side), size), np.int16)
        for i, xs in enumerate(side):
            for x in xs:
                bag[i, where.get(x, size - 1)] += 1
        bags.append(bag)
    x, y = bags
    total = x.sum(1)[:, None] + y.sum(1)[None, :]
    both = np.zeros(total.shape, np.int64)
    for k in range(size - 1):
        both += np.minimum(x[:, k][:, None], y[:, k][None, :])
    return 2 * both / np.maximum(total, 1)


class Aligner:
    """Word vectors of both languages in one space, and the alignment by them."""

    def __init__(self, counts: list[dict[str, int]], sentences: list[int], vectors: list[np.ndarray]) -> None:
        self.vocab = [{w: i for i, w in enumerate(c)} for c in counts]
        self.vectors, self.weights = [], []
        for side in (0, 1):
            n = np.array(list(counts[side].values()) or [1], np.float64)
            v = unit(vectors[side])
            self.vectors.append(unit(v - v.mean(0)) if len(v) else v)
            self.weights.append(np.log1p(max(1, sentences[side]) / n).astype(np.float32))

    def table(self, side: int) -> np.ndarray:
        """Weighted word vectors; the last one is no word."""
        if not self.vocab[side]:
            return np.zeros((1, DIM), np.float32)
        return np.concatenate([self.weights[side][:, None] * self.vectors[side], np.zeros((1, DIM), np.float32)])

    def phrase(self, text: str, side: int) -> np.ndarray:
        ids = [self.vocab[side][w] for w in (words_zh if side else words_en)(text) if w in self.vocab[side]]
        return self.vectors[side][ids].mean(0) if ids else np.zeros(DIM, np.float32)

    def rotate(self, pairs: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Orthogonal Procrustes: turn the English vectors onto the Chinese ones."""
        pairs = [(a, b) for a, b in pairs if np.any(a) and np.any(b)]
        if len(pairs) >= 2:
            x, y = (unit(np.stack(v)) for v in zip(*pairs))
            u, _, vt = np.linalg.svd(x.T @ y)
            self.vectors[0] = (self.vectors[0] @ (u @ vt)).astype(np.float32)

    def companions(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tallies over surely aligned sentences: side 0 and 1 of the words of each language, side 2 of pairs of words."""
        seen, both, size = (Tally(), Tally()), Tally(), len(self.vocab[1])
        for batch in batches:
            records = list(zip(batch.column("en").to_pylist(), batch.column("zh").to_pylist()))
            for (e, z), s in zip(records, self.scores(records)):
                sure = [(i, j) for i, j, match in warp(s, *corridor(s)) if match and s[i, j] >= SURE] if s.size else []
                if not sure:
                    continue
                ids = [
                    {k: np.unique(np.array([v[w] for w in words(sentences[k]) if w in v], np.int64)) for k in {x[side] for x in sure}}
                    for side, (v, words, sentences) in enumerate(zip(self.vocab, (words_en, words_zh), (split_en(e), split_zh(z))))
                ]
                for i, j in sure:
                    a, b = ids[0][i], ids[1][j]
                    seen[0].add(a)
                    seen[1].add(b)
                    both.add((a[:, None] * size + b[None, :]).ravel())
        yield tally_batch([r for side, t in enumerate((*seen, both)) for r in t.rows(side)])

    def company(self, seen: list[dict[int, int]]):
        """``(en, zh, dice)`` of the words that keep company in a tally of pairs."""
        size = max(1, len(self.vocab[1]))
        n = [np.array([seen[side].get(i, 0) for i in range(len(self.vocab[side]))], np.int64) for side in (0, 1)]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for keys, counts in zip(*(batch.column(c).to_pylist() for c in ("keys", "counts"))):
                    counts = np.frombuffer(counts, np.int64)
                    en, zh = np.divmod(np.frombuffer(keys, np.int64), size)
                    dice = 2 * counts / (n[0][en] + n[1][zh])
                    keep = (counts >= 4) & (dice > 0.3)
                    yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (en, zh, dice)], names=["en", "zh", "dice"])

        return run

    def seeded(self, glossary: list[tuple[str, str]], df: DataFrame) -> Aligner:
        """Rotated by a glossary, then by it and the words that keep company in surely aligned sentences of ``df(en, zh)``."""
        seeds = [(e, z) for e, z in glossary if e and z]
        self.rotate([(self.phrase(e, 0), self.phrase(z, 1)) for e, z in seeds])
        found = tallies(df, self.companions)
        seen: list[dict[int, int]] = [{}, {}]
        for r in found.filter("side < 2").collect():
            seen[r["side"]].update(zip(*(np.frombuffer(r[c], np.int64).tolist() for c in ("keys", "counts"))))
        top: dict[int, list[tuple[float, int]]] = {}
        for r in found.filter("side = 2").mapInArrow(self.company(seen), "en long, zh long, dice double").collect():
            top.setdefault(r["en"], []).append((r["dice"], r["zh"]))
        pairs = [(self.phrase(e, 0), self.phrase(z, 1)) for e, z in seeds]
        for x, ys in sorted(top.items()):
            pairs.append((self.vectors[0][x], sum(d * self.vectors[1][y] for d, y in sorted(ys, reverse=True)[:3])))
        self.rotate(pairs)
        return self

    def scores(self, records: list[tuple[str, str]]) -> Iterator[np.ndarray]:
        """Sentence by sentence scores of each record; a sentence counts by its best clause or span of clauses."""
        tables = [self.table(side) for side in (0, 1)]
        for start in range(0, len(records), TOGETHER):
            some = records[start : start + TOGETHER]
            en, zh = (Sections([r[side] for r in some], side, self.vocab[side], tables[side]) for side in (0, 1))
            at, row = [0, 0], [0, 0]
            for n, m in zip(en.sentences, zh.sentences):
                sizes = en.rows[row[0] : row[0] + n], zh.rows[row[1] : row[1] + m]
                ends = [at[k] + int(sizes[k].sum()) for k in (0, 1)]
                if n and m:
                    score = en.vectors[at[0] : ends[0]] @ zh.vectors[at[1] : ends[1]].T
                    numbers = en.numbers[at[0] : ends[0]], zh.numbers[at[1] : ends[1]]
                    have = [np.array([bool(x) for x in side]) for side in numbers]
                    if have[0].any() or have[1].any():
                        score *= np.where(have[0][:, None] != have[1][None, :], np.float32(0.85), np.float32(1.0))
                        if have[0].any() and have[1].any():
                            ix = np.ix_(*(np.nonzero(h)[0] for h in have))
                            score[ix] = 0.65 * score[ix] + 0.35 * number_dice(*([x for x in side if x] for side in numbers))
                    starts = [np.concatenate([[0], np.cumsum(x[:-1])]) for x in sizes]
                    yield np.maximum.reduceat(np.maximum.reduceat(score, starts[0], 0), starts[1], 1)
                else:
                    yield np.zeros((n, m), np.float32)
                at, row = ends, [row[0] + n, row[1] + m]

    def align(self, records: list[tuple[str, str]]) -> Iterator[list[tuple[int, int]]]:
        for s in self.scores(records):
            yield self.matched(s) if s.size else []

    @staticmethod
    def matched(s: np.ndarray) -> list[tuple[int, int]]:
        row, column = s.argmax(1).tolist(), s.argmax(0).tolist()
        most = s.max(1).tolist(), s.max(0).tolist()

        def good(i: int, j: int) -> bool:
            # a sentence may share its counterpart with another one, if both fit well
            mine, its = row[i] == j, column[j] == i
            return bool(s[i, j] >= (BEST if mine and its else MERGED if mine or its else 2.0))

        found = {(i, j) for i, j, match in warp(s, *corridor(s)) if match and good(i, j)}
        # what stays unaligned on either side is matched anew, whatever its place
        left, right = {i for i, _ in found}, {j for _, j in found}
        if len(left) == s.shape[0] and len(right) == s.shape[1]:
            return sorted(found)
        rest = [(i, j) for i, j in np.argwhere(s >= BEST).tolist() if i not in left or j not in right]
        for i, j in sorted(rest, key=lambda x: -s[x]):
            if (i not in left or j not in right) and good(i, j) and s[i, j] >= 0.85 * max(most[0][i], most[1][j]):
                found.add((i, j))
                left.add(i)
                right.add(j)
        return sorted(found)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(side, word, sentences with it); the null word stands for all sentences."""
    for batch in batches:
        out: list[list] = [[], [], []]
        for side, column in ((0, "en"), (1, "zh")):
            words, split = (words_zh, split_zh) if side else (words_en, split_en)
            has, sentences = Counter(), 0
            for text in batch.column(column).to_pylist():
                for s in split(text):
                    has.update(set(words(s)))
                    sentences += 1
            for word, n in (*has.items(), (None, sentences)):
                for c, x in zip(out, (side, word, n)):
                    c.append(x)
        kinds = (pa.int32(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["side", "word", "n"])


def _neighbours(vocab: list[dict[str, int]]):
    """Tallies of each language's pairs of words at most WINDOW places apart, the lower number first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = (Tally(), Tally())
        for batch in batches:
            for side, column in ((0, "en"), (1, "zh")):
                words, split, of = (words_zh, split_zh, vocab[1]) if side else (words_en, split_en, vocab[0])
                got = [[of[w] for w in words(s) if w in of] for text in batch.column(column).to_pylist() for s in split(text)]
                lengths = [len(g) for g in got]
                ids, owner = np.array([i for g in got for i in g], np.int64), np.repeat(np.arange(len(got)), lengths)
                for gap in range(1, min(WINDOW, len(ids) - 1) + 1):
                    same = owner[gap:] == owner[:-gap]
                    a, b = ids[:-gap][same], ids[gap:][same]
                    tally[side].add(np.minimum(a, b) * len(of) + np.maximum(a, b))
        yield tally_batch([r for side in (0, 1) for r in tally[side].rows(side)])

    return run


def word_vectors(df: DataFrame, vocab: list[dict[str, int]]) -> list[np.ndarray]:
    """Vectors of each language's words, from all neighbours in all rows; to the driver come the sums."""
    found: list[list[tuple[bytes, bytes]]] = [[], []]
    for r in tallies(df, _neighbours(vocab)).sort("side", "part").collect():
        found[r["side"]].append((r["keys"], r["counts"]))
    return [skip_gram(*(np.frombuffer(b"".join(x[i] for x in found[side]), np.int64) for i in (0, 1)), len(vocab[side])) for side in (0, 1)]


def _least(whole: dict, side: int) -> int:
    return max(LEAST_COUNT, whole[side]["n"] // RAREST) if side in whole else LEAST_COUNT


def fitted(df: DataFrame, glossary: DataFrame) -> Aligner:
    """An aligner for ``df(id, section, en, zh)``; pass it to ``aligned_sentences`` to use it again.

    Words, sentences, neighbours and the company that words keep in a first alignment are counted over all
    rows. To the driver come the words in at least LEAST_COUNT sentences and one of RAREST (at every size, as
    rarer words' vectors say nothing yet), what their neighbours tell of them, and the words that keep company.
    """
    df = df.select("id", "section", "en", "zh").filter("en is not null and zh is not null")
    stats = cut(df.mapInArrow(_counted, "side int, word string, n long").groupBy("side", "word").agg(F.sum("n").alias("n")))
    whole = {r["side"]: r for r in stats.filter("word is null").collect()}
    least = F.when(F.col("side") == 0, F.lit(_least(whole, 0))).otherwise(F.lit(_least(whole, 1)))
    rows = stats.filter(F.col("word").isNotNull() & (F.col("n") >= least)).limit(MOST_WORDS + 1).collect()
    if len(rows) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} words in at least one of {RAREST} sentences")
    counts = [{r["word"]: r["n"] for r in sorted((r for r in rows if r["side"] == side), key=lambda r: r["word"])} for side in (0, 1)]
    sentences = [whole[side]["n"] if side in whole else 0 for side in (0, 1)]
    vocab = [{w: i for i, w in enumerate(c)} for c in counts]
    terms = glossary.select("term_en", "term_zh").filter("term_en is not null and term_zh is not null").limit(MOST_TERMS + 1).collect()
    if len(terms) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} glossary terms")
    aligner = Aligner(counts, sentences, word_vectors(df, vocab))
    return aligner.seeded(sorted((t["term_en"], t["term_zh"]) for t in terms), df)


def aligned_sentences(df: DataFrame, glossary: DataFrame, aligner: Aligner | None = None) -> DataFrame:
    """``df(id, section, en, zh)``, ``glossary(term_en, term_zh)`` -> ``(id, section, en_idx, zh_idx)``."""
    df = df.select("id", "section", "en", "zh").filter("en is not null and zh is not null")
    aligner = aligner or fitted(df, glossary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            keys, sections, en, zh = (batch.column(c).to_pylist() for c in ("id", "section", "en", "zh"))
            for key, section, found in zip(keys, sections, aligner.align(list(zip(en, zh)))):
                for i, j in found:
                    for column, value in zip(out, (key, section, i, j)):
                        column.append(value)
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["id", "section", "en_idx", "zh_idx"])

    return df.mapInArrow(run, "id long, section string, en_idx int, zh_idx int")
