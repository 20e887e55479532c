"""Near-duplicate records with small edits (problem 3).

1. Each record's set of k-character substrings of its normalised text becomes a one-permutation
   MinHash signature with densification (one pass over the text whatever its length). Exact copies
   are one class, which goes on once.
2. Bands of the signature propose pairs of classes, in a plain equi-join that adaptive execution can
   split where one band key holds a large part of all rows.
3. Bayesian pruning (BayesLSH-Lite): one-bit MinHash values are compared block by block, and a pair is
   dropped as soon as the posterior probability of reaching the threshold falls below the tolerance.
   A text too short to fill its bins counts for as many independent values as it filled.
4. The texts are read again, only those of surviving classes leave the scan (a Bloom filter of bounded
   size), and the Jaccard similarity of the pairs is computed exactly.

Defined cases: null text counts as empty; a text without a k-character substring is in no pair;
identical texts are links of similarity 1; a null group is a group; rows without an id and other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Sieve, cut, expand_pairs, sieve
from .kernels import MULT, U64, flat, gram_hashes, mix, normalise, row_hashes, slices, texts, window_rows

NONE = np.uint32(0xFFFFFFFF)
BANDS, ROWS, GRAM = 36, 6, 5
TOLERANCE = 1e-4
STEP, STEPS = 64, 3  # one-bit values compared at once, and how often
KEY_BYTES = 5


def signatures(codes: np.ndarray, starts: np.ndarray, k: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, size) one-permutation MinHash values and the bins filled without densification; a row
    without a window has NONE everywhere."""
    n = len(starts) - 1
    sig = np.full(n * size, NONE, np.uint32)
    pos, rows = window_rows(starts, k)
    if len(pos):
        h = gram_hashes(codes, k)[pos]
        bins = ((h >> U64(32)) * U64(size) >> U64(32)).astype(np.int64)
        np.minimum.at(sig, rows * size + bins, (h & U64(0xFFFFFFFE)).astype(np.uint32))
    sig = sig.reshape(n, size)
    full = sig != NONE
    todo = np.nonzero(~full & full.any(1)[:, None])
    out = sig.copy()
    for attempt in range(1, 48):
        if not len(todo[0]):
            return out, full.sum(1)
        source = (mix(np.arange(size, dtype=U64) * MULT + U64(attempt)) % U64(size)).astype(np.int64)[todo[1]]
        hit = full[todo[0], source]
        out[todo[0][hit], todo[1][hit]] = sig[todo[0][hit], source[hit]]
        todo = todo[0][~hit], todo[1][~hit]
    for i, j in zip(*todo):  # a few bins of very short texts: the next filled one
        filled = np.nonzero(full[i])[0]
        out[i, j] = sig[i, filled[np.searchsorted(filled, j) % len(filled)]]
    return out, full.sum(1)


def band_keys(sig: np.ndarray, bands: int, rows: int, salts: np.ndarray) -> np.ndarray:
    weights = mix(np.arange(1, rows + 1, dtype=U64) * MULT) | U64(1)
    with np.errstate(over="ignore"):
        acc = (sig.reshape(len(sig), bands, rows).astype(U64) * weights).sum(2, dtype=U64)
        acc += np.arange(bands, dtype=U64)[None, :] * MULT + salts[:, None]
        return mix(acc)


@cache
def most_differing(threshold: float, values: int, effective: int, tolerance: float = TOLERANCE) -> int:
    """The most of ``values`` one-bit MinHash values that may differ while the posterior
    P(similarity >= threshold | values that differ), under a uniform prior, is at the tolerance or
    above. ``effective``: how many of the values are independent."""
    grid = (np.arange(4000) + 0.5) / 4000
    scale = effective / values
    for d in range(values + 1):
        logs = (values - d) * scale * np.log((1 + grid) / 2) + d * scale * np.log((1 - grid) / 2)
        p = np.exp(logs - logs.max())
        if p[grid >= threshold].sum() / p.sum() < tolerance:
            return d - 1
    return values


def likely(threshold: float, size: int, step: int = STEP, steps: int = STEPS) -> Column:
    """Whether a pair with sketches ``s0, s1, ...`` and ``filled`` bins on sides a and b survives."""
    differ, keep = F.lit(0), F.lit(True)
    filled = F.least("filled_a", "filled_b")
    for i in range(steps):
        n = step * (i + 1)
        limits = [most_differing(threshold, n, max(1, n * f // size)) for f in range(size + 1)]
        differ = differ + F.bit_count(F.col(f"s{i}_a").bitwiseXOR(F.col(f"s{i}_b")))
        keep &= differ <= F.element_at(F.array(*[F.lit(x) for x in limits]), filled + 1)
    return keep


def sketches(sig: np.ndarray, step: int = STEP, steps: int = STEPS) -> np.ndarray:
    """(rows, steps) words of ``step`` one-bit values each."""
    bits = (sig[:, : step * steps] >> np.uint32(1) & np.uint32(1)).astype(np.uint8)
    return np.packbits(bits, axis=1).view(np.int64).reshape(len(sig), steps)


def exact_jaccard(a: str, b: str, k: int = GRAM) -> float:
    x, y = ({s[i : i + k] for i in range(len(s) - k + 1)} for s in (a, b))
    both = len(x & y)
    return both / (len(x) + len(y) - both) if both else 0.0


def _salts(column: pa.Array) -> np.ndarray:
    enc = column.dictionary_encode(null_encoding="encode")
    values = np.array([xxhash.xxh3_64_intdigest(str(v.as_py()).encode()) for v in enc.dictionary] or [0], U64)
    return values[enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)] if len(column) else np.zeros(0, U64)


def class_members(k: int = GRAM, salted: bool = True):
    """``(grp, id, text)`` -> ``(grp, id, cls)`` of the records that have a substring of k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                codes, starts = normalise(*flat(batch.column("text")))
                cls = row_hashes(codes, starts) ^ (_salts(batch.column("grp")) if salted else U64(0))
                pick = np.nonzero(np.diff(starts) >= k)[0]
                at = pa.array(pick)
                columns = [batch.column("grp").take(at), batch.column("id").take(at), pa.array(cls[pick].view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["grp", "id", "cls"])

    return run


def _fresh(cls: np.ndarray, pick: np.ndarray, seen: set[int]) -> np.ndarray:
    """The picked rows whose class this task hasn't had yet."""
    out = []
    for i, c in zip(pick.tolist(), cls[pick].tolist()):
        if c not in seen:
            seen.add(c)
            out.append(i)
    return np.array(out, np.int64)


def _signed(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for batch in slices(whole, "text"):
                codes, starts = normalise(*flat(batch.column("text")))
                salts = _salts(batch.column("grp"))
                cls = row_hashes(codes, starts) ^ salts
                fresh = _fresh(cls, np.nonzero(np.diff(starts) >= k)[0], seen)
                if not len(fresh):
                    continue
                sig, filled = signatures(codes, starts, k, bands * rows)
                sig, filled = sig[fresh], filled[fresh]
                keys = band_keys(sig, bands, rows, salts[fresh]).view(np.uint8).reshape(len(fresh), bands, 8)[:, :, :KEY_BYTES]
                packed = keys.reshape(len(fresh), -1).tobytes()
                width = bands * KEY_BYTES
                s = sketches(sig)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cls[fresh].view(np.int64)), pa.array([packed[i : i + width] for i in range(0, len(packed), width)], pa.binary()),
                        *[pa.array(s[:, i]) for i in range(STEPS)], pa.array(filled.astype(np.int32)),
                    ],
                    names=["cls", "keys", *[f"s{i}" for i in range(STEPS)], "filled"],
                )

    return run


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of classes that this task hasn't had yet; a class is in one partition."""
    seen: set[int] = set()
    for batch in batches:
        cls = batch.column("cls").to_numpy()
        yield batch.take(pa.array(_fresh(cls, np.arange(len(cls)), seen)))


def _bands(bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _once(batches):
            if batch.num_rows:
                raw = np.frombuffer(b"".join(batch.column("keys").to_pylist()), np.uint8).reshape(-1, KEY_BYTES)
                keys = np.zeros((len(raw), 8), np.uint8)
                keys[:, :KEY_BYTES] = raw
                cls = np.repeat(batch.column("cls").to_numpy(), bands)
                yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(keys.view(np.int64).ravel())], names=["cls", "key"])

    return run


def wanted_texts(known: Sieve, k: int = GRAM, salted: bool = True):
    """``(grp, id, text)`` -> ``(cls, text)``, normalised, once a task, of the classes the sieve lets pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for batch in slices(whole, "text"):
                codes, starts = normalise(*flat(batch.column("text")))
                cls = row_hashes(codes, starts) ^ (_salts(batch.column("grp")) if salted else U64(0))
                fresh = _fresh(cls, np.nonzero((np.diff(starts) >= k) & known.has(cls))[0], seen)
                words = texts(codes, starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cls[fresh].view(np.int64)), pa.array([words[i] for i in fresh.tolist()], pa.string())], names=["cls", "text"]
                )

    return run


def _verified(threshold: float, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()
            j = np.array([exact_jaccard(x, y, k) for x, y in zip(a, b)], np.float64)
            out = batch.select(["cls_a", "cls_b"]).append_column("similarity", pa.array(j))
            yield out.filter(pa.array(j >= threshold))

    return run


def sided(df: DataFrame, side: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}_{side}" for c in df.columns})


def proposed(band: DataFrame) -> DataFrame:
    """``band(cls, key)`` -> pairs of classes that share a key.

    A sort-merge join of two plain shuffles, so that adaptive execution splits a partition in which one
    key holds a large part of all rows; no aggregate and no explicit partitioning stands in between.
    """
    a, b = (band.select(F.col("cls").alias(c), "key") for c in ("cls_a", "cls_b"))
    return a.hint("merge").join(b, "key").filter("cls_a < cls_b").select("cls_a", "cls_b").distinct()


def near_duplicate_links(
    df: DataFrame, threshold: float = 0.7, k: int = GRAM, bands: int = BANDS, rows: int = ROWS
) -> tuple[DataFrame, DataFrame]:
    """``df(grp, id, text)`` -> (links between classes, members of classes).

    links: ``cls_a < cls_b``, ``similarity``; members: ``grp, id, cls``. Records of different
    ``grp`` never meet. Shuffled are a row of keys and sketch for each class, a row of 13 bytes for
    each of its bands, and the texts of pairs that survive the pruning.
    """
    df = df.select("grp", "id", "text").filter("id is not null")
    members = cut(df.mapInArrow(class_members(k), "grp string, id long, cls long"))
    words = [f"s{i}" for i in range(STEPS)]
    schema = f"cls long, keys binary, {', '.join(f'{w} long' for w in words)}, filled int"
    signed = df.mapInArrow(_signed(k, bands, rows), schema).repartition("cls")
    # both branches read all columns, so that they share one exchange
    band = signed.mapInArrow(_bands(bands), "cls long, key long")
    sketch = signed.mapInArrow(_once, schema).select("cls", *words, "filled")
    pairs = cut(
        proposed(band).join(sided(sketch, "a"), "cls_a").join(sided(sketch, "b"), "cls_b")
        .filter(likely(threshold, bands * rows)).select("cls_a", "cls_b")
    )
    known = sieve(pairs.select(F.explode(F.array("cls_a", "cls_b")).alias("cls")).distinct(), "cls")
    text = df.mapInArrow(wanted_texts(known, k), "cls long, text string").dropDuplicates(["cls"])
    links = pairs.join(sided(text, "a"), "cls_a").join(sided(text, "b"), "cls_b").mapInArrow(
        _verified(threshold, k), "cls_a long, cls_b long, similarity double"
    )
    return links, members


def near_duplicate_pairs(df: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """``(grp, id_a, id_b)`` of all records with similarity of at least ``threshold``."""
    links, members = near_duplicate_links(df, threshold, **options)
    return expand_pairs(links, members, ["grp"])
