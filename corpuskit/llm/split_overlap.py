"""Same or near-same records across splits (problem 6).

1. Each record's substrings of 5 characters are put in one order for all records: by how often their
   bucket occurs on either side (rare products first), then by hash. A substring whose bucket has one
   side only joins nothing, but keeps its place.
2. Records of n and m substrings and similarity of at least t share at least
   need = ceil(t / (1 + t) * (n + m)) of them, so the first one they share stands at most at place
   n - need in one and m - need in the other (prefix filter). Records send their first substrings, by
   parts of the hash range, with a bitmap: bits that differ are a lower bound of the substrings that do.
   A pair is dropped only where these bounds rule the threshold out.
3. The texts of the other pairs are put together and the exact similarity decides, whatever the overlap.
4. The overlap of a pair found is its shared length in content-defined chunks: a cut follows each window
   whose rolling hash falls into one of ``divisor`` classes, so equal passages are cut alike wherever
   they stand; of several independent cuttings (layers) the best counts.

No pair of the threshold is lost, copies are paired in full. The comparisons grow with the square of the
rows where texts are made of the same phrases.

Defined cases: null text counts as empty; a null split is no training split; texts without a
5-character substring are in no pair; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Sieve, cut, sieve
from .kernels import U64, flat, gram_hashes, normalise, row_hashes, slices, texts, window_rows
from .near_duplicates import GRAM, class_members, exact_jaccard, sided

DIVISOR, WIDTH, LAYERS = 8, 3, 4
BUCKETS, PARTS = 1 << 20, 32
LEAST_RANGES, RANGE_RECORDS = 12, 25_000  # parts of the hash range, and records for each
LEAST_BITS, MOST_BITS = 512, 8192  # of a bitmap; it only spares comparisons
AT_ONCE = 1 << 20  # pairs compared at once


class Cutter:
    """Cuts a flat batch; the rolling hash of every window serves all layers."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, divisor: int = DIVISOR, width: int = WIDTH) -> None:
        self.starts, self.n, self.divisor = starts, len(codes), divisor
        pos, _ = window_rows(starts, width)  # only windows inside a row cut it
        self.after = pos + width
        self.h = gram_hashes(codes, width)[pos]

    def bounds(self, layer: int) -> np.ndarray:
        """Positions of all cuts of a layer, row starts included."""
        cut_at = np.zeros(self.n + 1, bool)
        cut_at[self.after[(self.h >> U64(layer * 12)) % U64(self.divisor) == 0]] = True
        cut_at[self.starts] = True
        return np.nonzero(cut_at)[0]


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Normalised texts, each once a task and side."""
    seen: set[tuple[int, bool]] = set()
    for whole in batches:
        for batch in slices(whole, "text"):
            codes, starts = normalise(*flat(batch.column("text")))
            cls, train, words = row_hashes(codes, starts), batch.column("train").to_pylist(), texts(codes, starts)
            rows = []
            for i in np.nonzero(np.diff(starts) >= GRAM)[0].tolist():
                if (key := (int(cls[i]), train[i])) not in seen:
                    seen.add(key)
                    rows.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cls[rows].view(np.int64)), pa.array([train[i] for i in rows], pa.bool_()), pa.array([words[i] for i in rows], pa.string())],
                names=["cls", "train", "text"],
            )


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = np.zeros((2, BUCKETS), np.int64)
    for whole in batches:
        for batch in slices(whole, "text"):
            codes, starts = flat(batch.column("text"))
            side = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
            pos, row = window_rows(starts, GRAM)
            at = (gram_hashes(codes, GRAM)[pos] % U64(BUCKETS)).astype(np.int64)
            for k in (0, 1):
                table[k] += np.bincount(at[side[row] == bool(k)], minlength=BUCKETS)
    if table.any():
        parts = table.reshape(2, PARTS, -1).swapaxes(0, 1)
        yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], names=["part", "counts"])


def _summed(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.int64) for x in group.column("counts"))
    return pa.table({"part": pa.array([group.column("part")[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def bucket_ranks(records: DataFrame) -> np.ndarray:
    """Of each bucket of substrings its rank by the product of their numbers on both sides, 0 where one has none."""
    schema = "part int, counts binary"
    table = np.zeros((PARTS, 2, BUCKETS // PARTS), np.int64)
    for r in records.mapInArrow(_counts, schema).groupBy("part").applyInArrow(_summed, schema).collect():
        table[r["part"]] = np.frombuffer(r["counts"], np.int64).reshape(2, -1)
    there, here = (table[:, k].ravel().astype(np.float64) for k in (0, 1))
    return np.where(here * there > 0, 1 + np.minimum(4 * np.log2(np.maximum(here * there, 1)), 254), 0).astype(np.uint8)


def need(n: np.ndarray, m: np.ndarray, threshold: float) -> np.ndarray:
    """The least number of substrings that records of n and m ones share from the threshold on."""
    return np.ceil(threshold / (1 + threshold) * (n.astype(np.int64) + m) - 1e-6).astype(np.int64)


def ordered_grams(codes: np.ndarray, starts: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, place) of each different substring of each row, in the order of all records; a key begins with its rank."""
    pos, row = window_rows(starts, GRAM)
    h = gram_hashes(codes, GRAM)[pos]
    key = h >> U64(8) | ranks[(h % U64(BUCKETS)).astype(np.int64)].astype(U64) << U64(56)
    order = np.argsort(key)
    row = row.astype(np.uint16 if len(starts) <= 1 << 16 else np.int64)
    order = order[np.argsort(row[order], kind="stable")]
    row, key = row[order].astype(np.int64), key[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    row, key = row[fresh], key[fresh]
    return row, key, np.arange(len(row)) - np.searchsorted(row, np.arange(len(starts) - 1))[row]


def bit_level(n: np.ndarray) -> np.ndarray:
    """A bitmap has LEAST_BITS bits times two to this power: levels of sizes that can meet differ by one at most."""
    return np.ceil(np.log2(np.clip(1.3 * n / LEAST_BITS, 1, MOST_BITS / LEAST_BITS))).astype(np.int64)


def _prefixes(ranks: np.ndarray, ranges: int, threshold: float):
    """Rows of a record and a part of the hash range: its keys there with their places, its bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                cls = batch.column("cls").to_numpy()
                row, key, place = ordered_grams(*flat(batch.column("text")), ranks)
                n = np.bincount(row, minlength=len(cls))
                level = bit_level(n)
                begin = np.concatenate([[0], np.cumsum(LEAST_BITS << level)])
                bits = np.bincount(begin[row] + (key & (LEAST_BITS << level[row]).astype(U64) - U64(1)).astype(np.int64), minlength=begin[-1]) & 1
                bits, begin = np.packbits(bits.astype(np.uint8)).tobytes(), begin // 8
                keep = (place <= n[row] - np.ceil(threshold * n[row] - 1e-6)) & (key >> U64(56) > 0)
                row, key, place = row[keep], key[keep], place[keep].astype(np.int32)
                part = (key >> U64(20) & U64(0xFFFFFFFF)) % U64(ranges)
                order = np.lexsort((part, row))
                row, key, place, part = (x[order] for x in (row, key, place, part))
                first = np.nonzero(np.r_[True, (row[1:] != row[:-1]) | (part[1:] != part[:-1])][: len(row)])[0]
                at, rows = [*first.tolist(), len(row)], row[first]
                keys, places = key.tobytes(), place.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part[first].astype(np.int32)), pa.array(cls[rows]), pa.array(n[rows].astype(np.int32)),
                        pa.array([bits[begin[i] : begin[i + 1]] for i in rows.tolist()], pa.binary()),
                        pa.array([keys[8 * i : 8 * j] for i, j in pairwise(at)], pa.binary()), pa.array([places[4 * i : 4 * j] for i, j in pairwise(at)], pa.binary()),
                    ],
                    names=["part", "cls", "n", "bits", "keys", "places"],
                )

    return run


class Side:
    """Records of one side in a part of the hash range; ``short`` marks keys that a pair with a record as large or larger can need."""

    def __init__(self, group: pa.Table, threshold: float) -> None:
        self.cls, self.n = group.column("cls").to_numpy(), group.column("n").to_numpy().astype(np.int64)
        keys = group.column("keys").to_pylist()
        self.key, self.place = np.frombuffer(b"".join(keys), U64), np.frombuffer(b"".join(group.column("places").to_pylist()), np.int32)
        self.owner = np.repeat(np.arange(len(keys)), [len(k) // 8 for k in keys])
        n = self.n[self.owner]
        self.short = self.place <= n - need(n, n, threshold)
        self.level = bit_level(self.n)
        self.spot = np.zeros(len(keys), np.int64)  # place of a record in the bitmaps of its level
        self.bits: dict[int, np.ndarray] = {}
        bits = group.column("bits").to_pylist()
        for level in np.unique(self.level).tolist():
            rows = np.nonzero(self.level == level)[0]
            self.spot[rows] = np.arange(len(rows))
            self.bits[level] = np.frombuffer(b"".join(bits[i] for i in rows.tolist()), U64).reshape(len(rows), -1)

    def folded(self, level: int, to: int) -> np.ndarray:
        """Words by records of the bitmaps of a level, made as short as those of a lower one."""
        bits = self.bits[level].reshape(len(self.bits[level]), -1, (LEAST_BITS << to) // 64)
        return np.ascontiguousarray(np.bitwise_xor.reduce(bits, axis=1).T)


def _near(threshold: float):
    """Pairs of records that share a substring both can need and whose bitmaps don't rule the threshold out."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = Side(left, threshold), Side(right, threshold)
        found = []
        words = {(i, j): (a.folded(i, min(i, j)), b.folded(j, min(i, j))) for i in a.bits for j in b.bits if abs(i - j) < 2}
        for mine, its in ((np.ones(len(a.key), bool), b.short), (a.short, ~b.short)):
            x, y = np.nonzero(mine)[0], np.nonzero(its)[0]
            y = y[np.argsort(b.key[y])]
            lo, hi = (np.searchsorted(b.key[y], a.key[x], side=s) for s in ("left", "right"))
            x, lo, count = x[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            total = np.concatenate([[0], np.cumsum(count)])
            for start in range(0, int(total[-1]), AT_ONCE):
                upto = min(start + AT_ONCE, int(total[-1]))
                i, j = np.searchsorted(total, start, side="right") - 1, np.searchsorted(total, upto)
                at = np.arange(start, upto)
                which = np.repeat(np.arange(i, j), np.minimum(total[i + 1 : j + 1], upto) - np.maximum(total[i:j], start))
                p, q = x[which], y[lo[which] + at - total[which]]
                u, v = a.owner[p], b.owner[q]
                n, m = a.n[u], b.n[v]
                least = need(n, m, threshold)
                keep = (a.place[p] <= n - least) & (b.place[q] <= m - least) & (a.cls[u] != b.cls[v])
                u, v = u[keep], v[keep]
                differ = (n + m - 2 * least)[keep]
                levels = a.level[u] * 64 + b.level[v]
                for level in np.unique(levels).tolist():
                    some = np.nonzero(levels == level)[0]
                    s, t = a.spot[u[some]], b.spot[v[some]]
                    bits = np.zeros(len(some), np.int64)
                    for xs, ys in zip(*words[divmod(level, 64)]):
                        bits += np.bitwise_count(xs[s] ^ ys[t])
                    some = some[bits <= differ[some]]
                    found.append(np.unique(u[some] * len(b.cls) + v[some]))
        pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        u, v = np.divmod(pairs, max(1, len(b.cls)))
        return pa.table({"cls_a": pa.array(a.cls[u], pa.int64()), "cls_b": pa.array(b.cls[v], pa.int64())})

    return run


def _wanted(known: Sieve):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(known.has(batch.column("cls").to_numpy())))

    return run


def chunk_overlap(a: str, b: str, layers: int = LAYERS) -> tuple[float, float]:
    """Largest shared chunk length over the layers, as fractions of a and of b."""
    best = 0
    cutters = []
    for s in (a, b):
        codes = np.frombuffer(s.encode("utf-32-le"), np.uint32)
        cutters.append(Cutter(codes, np.array([0, len(codes)])))
    for layer in range(layers):
        bags = [Counter(s[x:y] for x, y in pairwise(c.bounds(layer).tolist())) for s, c in zip((a, b), cutters)]
        best = max(best, sum(len(k) * n for k, n in (bags[0] & bags[1]).items()))
    return best / max(1, len(a)), best / max(1, len(b))


def _verified(threshold: float, layers: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for ca, cb, a, b in zip(*(batch.column(c).to_pylist() for c in ("cls_a", "cls_b", "text_a", "text_b"))):
                if (j := exact_jaccard(a, b)) >= threshold:
                    rows.append((ca, cb, *chunk_overlap(a, b, layers), j))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64()] * 2 + [pa.float64()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["cls_a", "cls_b", "overlap_a", "overlap_b", "similarity"]
            )

    return run


def split_overlaps(df: DataFrame, threshold: float = 0.7, layers: int = LAYERS, exact: bool = True) -> DataFrame:
    """``df(id, train, text)`` -> ``(id_train, id_other)`` and the overlap of each pair across the split.

    Columns: ``overlap_train``, ``overlap_other`` (shared chunk length as a fraction of the record)
    and ``similarity``. All pairs are found, those of copies, too: a text m times on one side and n times
    on the other makes m * n rows. ``exact`` is kept for callers; there is no other way.
    """
    if not exact:
        raise ValueError("there is only the exact way")
    df = df.select("id", F.coalesce("train", F.lit(False)).alias("train"), "text").filter("id is not null")
    distinct = "cls long, train boolean, text string"
    records = cut(df.select("train", "text").mapInArrow(_distinct, distinct).dropDuplicates(["cls", "train"]))
    ranges = max(LEAST_RANGES, records.count() // RANGE_RECORDS)
    sent = _prefixes(bucket_ranks(records), ranges, threshold)
    left, right = (
        records.filter(side).select("cls", "text").mapInArrow(sent, "part int, cls long, n int, bits binary, keys binary, places binary").groupBy("part")
        for side in (F.col("train"), ~F.col("train"))
    )
    pairs = cut(left.cogroup(right).applyInArrow(_near(threshold), "cls_a long, cls_b long").distinct())
    known = sieve(pairs.select(F.explode(F.array("cls_a", "cls_b")).alias("cls")).distinct(), "cls")
    sides = cut(df.select(F.col("train").cast("string").alias("grp"), "id", "text").mapInArrow(class_members(salted=False), "grp string, id long, cls long"))
    some = records.mapInArrow(_wanted(known), distinct)
    a, b = (sided(some.filter(side).select("cls", "text"), x) for side, x in ((F.col("train"), "a"), (~F.col("train"), "b")))
    near = pairs.join(a, "cls_a").join(b, "cls_b").mapInArrow(
        _verified(threshold, layers), "cls_a long, cls_b long, overlap_a double, overlap_b double, similarity double"
    )
    here, there = (sides.filter(F.col("grp") == s).select(F.col("cls").alias(c), F.col("id").alias(i)) for s, c, i in (("true", "cls_a", "id_train"), ("false", "cls_b", "id_other")))
    across = near.join(here, "cls_a").join(there, "cls_b").select(
        "id_train", "id_other", F.col("overlap_a").alias("overlap_train"), F.col("overlap_b").alias("overlap_other"), "similarity"
    )
    equal = here.withColumnRenamed("cls_a", "cls").join(there.withColumnRenamed("cls_b", "cls"), "cls").select("id_train", "id_other")
    one = F.lit(1.0)
    return across.unionByName(equal.withColumns({"overlap_train": one, "overlap_other": one, "similarity": one}))
