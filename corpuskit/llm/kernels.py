"""Vectorised text kernels shared by the operators of this subpackage.

A *flat* batch is one array of code points for all rows of an Arrow string column together
with the ``n + 1`` row starts. Everything below works on flat batches, so the cost of Python
is per batch and not per row or per character.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
MULT = U64(0x9E3779B97F4A7C15)
SLICE_BYTES = 3 << 20


@cache
def normal_table() -> np.ndarray:
    """Code point -> lower-cased code point of a letter or digit, 0 for anything else."""
    table = np.zeros(0x110000, np.uint32)
    for lo, hi in ((0, 0xD800), (0xE000, 0x32400)):
        for cp in range(lo, hi):
            c = chr(cp).lower()[0]
            if c.isalnum():
                table[cp] = ord(c)
    return table


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that ``column`` has about ``limit`` bytes a slice; a longer value is its own slice."""
    n = batch.num_rows
    if not n:
        return
    off = _offsets(batch.column(column))
    at = 0
    while at < n:
        end = int(np.searchsorted(off, off[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield batch.slice(at, end - at)
        at = end


def _offsets(col: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(col.type)
    buf = col.buffers()[1]
    if buf is None or len(col) == 0:
        return np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(buf, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1]


def flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points, row starts) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    off = _offsets(col)
    if col.null_count:
        col = col.fill_null("")
        off = _offsets(col)
    data = col.buffers()[2]
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint32), np.zeros(len(col) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]]
    try:
        text = raw.tobytes().decode("utf-8")
    except UnicodeDecodeError:
        rows = [raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(off[:-1] - off[0], off[1:] - off[0])]
        return flat(pa.array(rows, pa.large_string()))
    lead = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=lead[1:])
    return np.frombuffer(text.encode("utf-32-le"), np.uint32), lead[off - off[0]]


def normalise(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case and keep letters and digits only (the *normalised text*)."""
    mapped = normal_table()[codes]
    keep = mapped != 0
    pos = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(keep, out=pos[1:])
    return mapped[keep], pos[starts]


def texts(codes: np.ndarray, starts: np.ndarray) -> list[str]:
    whole = codes.astype("<u4", copy=False).tobytes().decode("utf-32-le", "replace")
    return [whole[a:b] for a, b in zip(starts[:-1], starts[1:])]


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (murmur3), in place."""
    h ^= h >> U64(33)
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


BASE = 0x9E3779B97F4A7C15
BACK = pow(BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse, modulo 2^64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, BACK)):
            steps = np.full(n, base, U64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=U64)
    return _powers[0], _powers[1]


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each window of k code points, by doubling: about 2 log2 k passes."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        power, length = codes.astype(U64) + U64(0x1F3D5B79), 1
        mix(power)
        acc, done, m = None, 0, MULT
        rest = k
        while rest:
            if rest & 1:
                part = power[done : done + n]
                acc = part.copy() if acc is None else acc * m + part
                done += length
            rest >>= 1
            if rest:
                power = power[: len(power) - length] * m + power[length:]
                length *= 2
                m = U64((int(m) * int(m) + 0x2545F4914F6CDD1D) & 0xFFFFFFFFFFFFFFFF | 1)
        return mix(acc)


def window_rows(starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For all windows of k inside a row: (window positions, row numbers)."""
    count = np.maximum(np.diff(starts) - k + 1, 0)
    rows = np.repeat(np.arange(len(count)), count)
    first = np.cumsum(count) - count
    return np.arange(int(count.sum())) - np.repeat(first - starts[:-1], count), rows


def row_hashes(codes: np.ndarray, starts: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit hash of each row's code points."""
    view = memoryview(np.ascontiguousarray(codes)).cast("B")
    out = [xxhash.xxh3_64_intdigest(view[a:b], salt) for a, b in zip((starts[:-1] * 4).tolist(), (starts[1:] * 4).tolist())]
    return np.array(out, U64)


def running_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values (doubling)."""
    out, length = h, 1
    while length < w:
        step = min(length, w - length)
        out = np.minimum(out[: len(out) - step], out[step:])
        length += step
    return out


def list_column(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    off = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values))
