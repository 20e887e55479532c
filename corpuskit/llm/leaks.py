"""Evaluation texts leaking into training text (problem 7).

The held-out items are a stated, bounded set; their BM25 inverted index (terms: hashed character
grams of the normalised text) is built once on the driver and shipped with the task. Every passage
of every document queries it:

1. the grams of all passages are looked up in the vocabulary in one vectorised step; a passage whose
   summed list maxima stay under the lowest threshold can't reach any item and ends here;
2. block-max WAND over the posting lists of the rest retrieves every item at or above its threshold.
   An item's threshold is the lowest score that a passage holding any of its runs of the required
   length can have, so retrieval loses no such passage;
3. the common run is verified on the normalised document.

Defined cases: null or short texts match nothing; items shorter than their required length match
nothing; repeated items each match; an empty table on either side gives no rows.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import U64, flat, gram_hashes, normalise, slices, texts, window_rows

GRAM, BLOCK = 12, 8
K1, B = 1.5, 0.75
RUN = {"en": 70, "zh": 34}
MOST_ITEMS, MOST_CHARS = 100_000, 20_000_000


class Index:
    """Posting lists with block maxima; impacts are BM25 weights at the term's frequency in the item."""

    def __init__(self, ids: list[int], raw: list[str], langs: list[str], runs: dict[str, int], gram: int = GRAM) -> None:
        codes, starts = normalise(*flat(pa.array(raw, pa.string())))
        self.ids, self.items, self.gram = ids, texts(codes, starts), gram
        self.run = [runs.get(x, max(runs.values())) for x in langs]
        hashes, rows = gram_hashes(codes, gram), window_rows(starts, gram)
        hashes = hashes[rows[0]]
        lists: dict[int, Counter] = defaultdict(Counter)
        per_item: list[list[int]] = [[] for _ in ids]
        for h, r in zip(hashes.tolist(), rows[1].tolist()):
            lists[h][r] += 1
            per_item[r].append(h)
        n = max(1, len(ids))
        mean = max(1.0, len(hashes) / n)
        self.terms = np.array(sorted(lists), U64)
        self.postings: list[list[tuple[int, float]]] = []
        impact: dict[int, dict[int, float]] = {}
        for t in self.terms.tolist():
            idf = np.log1p((n - len(lists[t]) + 0.5) / (len(lists[t]) + 0.5))
            impact[t] = {
                i: float(idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(per_item[i]) / mean))) for i, tf in sorted(lists[t].items())
            }
            self.postings.append(list(impact[t].items()))
        self.docs = [[i for i, _ in p] for p in self.postings]
        self.block_max = [[max(w for _, w in p[a : a + BLOCK]) for a in range(0, len(p), BLOCK)] for p in self.postings]
        self.block_last = [[p[min(a + BLOCK, len(p)) - 1][0] for a in range(0, len(p), BLOCK)] for p in self.postings]
        self.list_max = np.array([max(m) for m in self.block_max], np.float64)
        self.threshold = []
        for i, grams in enumerate(per_item):
            span = self.run[i] - gram + 1
            sums = [sum(impact[g][i] for g in set(grams[a : a + span])) for a in range(len(grams) - span + 1)]
            self.threshold.append(min(sums) * (1 - 1e-9) if sums else float("inf"))
        self.lowest = min(self.threshold, default=float("inf"))
        self.filter = np.zeros(1 << 22, bool)
        self.filter[(self.terms >> U64(42)).astype(np.int64)] = True

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, term numbers) of the hashes in the vocabulary."""
        at = np.nonzero(self.filter[(hashes >> U64(42)).astype(np.int64)])[0]
        if not len(at) or not len(self.terms):
            return at[:0], at[:0]
        term = np.minimum(np.searchsorted(self.terms, hashes[at]), len(self.terms) - 1)
        ok = self.terms[term] == hashes[at]
        return at[ok], term[ok]

    def retrieve(self, terms: list[int]) -> list[int]:
        """Block-max WAND: all items whose score over the distinct query terms reaches their threshold."""
        heads = [[self.docs[t][0], t, 0] for t in terms]
        heapq.heapify(heads)
        out = []
        while heads:
            heads.sort()
            bound, pivot = 0.0, -1
            for k, (_, t, _) in enumerate(heads):
                bound += self.list_max[t]
                if bound >= self.lowest:
                    pivot = k
                    break
            if pivot < 0:
                return out
            item = heads[pivot][0]
            while pivot + 1 < len(heads) and heads[pivot + 1][0] == item:
                pivot += 1
            shallow, nearest = 0.0, len(self.ids)
            for _, t, _ in heads[: pivot + 1]:
                block = bisect_left(self.block_last[t], item)
                if block < len(self.block_max[t]):
                    shallow += self.block_max[t][block]
                    nearest = min(nearest, self.block_last[t][block] + 1)
            if shallow < self.threshold[item] and shallow < self.lowest:
                target = min(max(nearest, item + 1), heads[pivot + 1][0] if pivot + 1 < len(heads) else len(self.ids))
            elif heads[0][0] == item:
                score = sum(self.postings[t][p][1] for d, t, p in heads[: pivot + 1])
                if score >= self.threshold[item]:
                    out.append(item)
                target = item + 1
            else:
                target = item
            moved = []
            for d, t, p in heads[: pivot + 1]:
                if d < target:
                    p = bisect_left(self.docs[t], target, p)
                if p < len(self.docs[t]):
                    moved.append([self.docs[t][p], t, p])
            heads[: pivot + 1] = moved
        return out

    def holds(self, item: int, text: str) -> bool:
        own, n = self.items[item], self.run[item]
        return any(own[a : a + n] in text for a in range(len(own) - n + 1))


def _found(index: Index):
    longest = max(index.run, default=0)
    passage = 2 * longest
    stride = max(1, passage - longest + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                codes, starts = normalise(*flat(batch.column("text")))
                pos, rows = window_rows(starts, index.gram)
                at, term = index.lookup(gram_hashes(codes, index.gram)[pos])
                where = pos[at] - starts[rows[at]]
                row = rows[at]
                docs, items = [], []
                # a gram lies in each passage [j * stride, j * stride + passage) that holds it whole
                last = where // stride
                first = np.maximum(0, -((passage - index.gram - where) // stride))
                copies = last - first + 1
                number = np.repeat(first, copies) + np.arange(int(copies.sum())) - np.repeat(np.cumsum(copies) - copies, copies)
                key = np.stack([np.repeat(row, copies), number, np.repeat(term, copies)], 1)
                key = np.unique(key, axis=0) if len(key) else key
                if len(key):
                    new = np.nonzero((np.diff(key[:, :2], axis=0) != 0).any(1))[0] + 1
                    begin = np.concatenate([[0], new])
                    reach = np.add.reduceat(index.list_max[key[:, 2]], begin) >= index.lowest
                    ends = np.append(begin[1:], len(key))
                    got: dict[int, set[int]] = defaultdict(set)
                    for a, b in zip(begin[reach].tolist(), ends[reach].tolist()):
                        got[int(key[a, 0])].update(index.retrieve(key[a:b, 2].tolist()))
                    ids = batch.column("id")
                    for r, candidates in got.items():
                        text = codes[starts[r] : starts[r + 1]].astype("<u4").tobytes().decode("utf-32-le")
                        for i in sorted(candidates):
                            if index.holds(i, text):
                                docs.append(ids[r].as_py())
                                items.append(index.ids[i])
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(items, pa.int64())], names=["id", "item_id"])

    return run


def leaked_items(df: DataFrame, items: DataFrame, runs: dict[str, int] = RUN, most_items: int = MOST_ITEMS) -> DataFrame:
    """``df(id, text)`` and ``items(item_id, text, lang)`` -> ``(id, item_id)``.

    The items are indexed on the driver, and the index ships with the tasks: more than ``most_items``, or
    more than MOST_CHARS characters in them, raise an error before any is read; pass them in blocks then
    and unite the results.
    """
    if (items.agg(F.sum(F.length("text"))).first()[0] or 0) > MOST_CHARS:
        raise ValueError(f"more than {MOST_CHARS} characters in held-out items; pass them in blocks")
    rows = items.select("item_id", "text", "lang").filter("text is not null and item_id is not null").limit(most_items + 1).collect()
    if len(rows) > most_items:
        raise ValueError(f"more than {most_items} held-out items; pass them in blocks")
    rows.sort(key=lambda r: r["item_id"])
    index = Index([r["item_id"] for r in rows], [r["text"] for r in rows], [r["lang"] for r in rows], runs)
    return df.select("id", "text").filter("id is not null").mapInArrow(_found(index), "id long, item_id long")
