"""Exact and near-duplicate removal."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.functions.text import clean, dedup_key, hamming

from .graph import components, cut

TOKEN = re.compile(r"[一-鿿]{1,3}|[a-z0-9]+")


def dedup_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row of counters of a run: rows read, kept and removed."""
    n = [d.agg(F.count(F.lit(1)).alias(name)) for d, name in ((before, "n_input"), (after, "n_kept"))]
    return n[0].join(F.broadcast(n[1])).withColumn("n_removed", F.col("n_input") - F.col("n_kept"))


def seeded_sample(df: DataFrame, key: str, size: int, seed: int = 42) -> DataFrame:
    """``size`` rows by the order of a seeded hash of ``key``; all rows if ``size`` isn't positive."""
    return df.orderBy(F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))), key).limit(size) if size > 0 else df


def exact_dedup(df: DataFrame, order: str, *columns: str) -> DataFrame:
    """The first row, by ``order``, of each dedup key; ``dedup_sha256`` is added.

    Keys are reduced before the shuffle, so a key that a third of the rows share costs one row a task.
    """
    keyed = df.withColumn("dedup_sha256", dedup_key(*[F.col(c) for c in columns]))
    first = keyed.groupBy("dedup_sha256").agg(F.min(order).alias(order))
    return keyed.join(first, ["dedup_sha256", order], "left_semi")


def bounded_unique(df: DataFrame, order: str, columns: list[str], required: list[str], target: int, max_scan: int) -> DataFrame:
    """Of the first ``max_scan`` rows those complete and new, at most ``target``: a bounded sample."""
    head = df.orderBy(order).limit(max_scan)
    for c in required:
        head = head.filter(clean(c) != "")
    return exact_dedup(head, order, *columns).orderBy(order).limit(target)


@lru_cache(maxsize=1 << 18)
def _token_bits(token: str) -> int:
    return int(hashlib.md5(token.encode()).hexdigest()[16:], 16)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shifts = np.arange(64, dtype=np.uint64)
    for batch in batches:
        out = []
        for text in batch.column("text").to_pylist():
            t = (text or "").strip().lower()
            parts = TOKEN.findall(t)
            if len(parts) < 3:
                parts.extend(t.replace(" ", ""))
            if not text:
                parts = []
            elif not parts:
                parts = ["_"]
            h = np.fromiter((_token_bits(p) for p in parts), np.uint64, len(parts))
            ones = ((h[:, None] >> shifts) & np.uint64(1)).sum(0)
            bits = (2 * ones > len(parts)).astype(np.uint64)
            out.append(int((bits << shifts).sum().astype(np.int64)) if len(parts) else 0)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.int64())], names=["id", "simhash"])


def simhash(df: DataFrame) -> DataFrame:
    """``df(id, text)`` -> ``(id, simhash)``: the 64-bit majority of the token hashes (md5, low half)."""
    return df.select("id", "text").mapInArrow(_signatures, "id long, simhash long")


def hamming_pairs(sigs: DataFrame, k: int = 3) -> DataFrame:
    """Pairs of different signatures within ``k`` bits: ``(a, b, distance)``, ``a < b``.

    64 bits in k + 3 blocks: two signatures within distance k agree on three blocks at least, so a
    table for each three blocks loses nothing. For k = 3 that makes 20 tables keyed by about 32 bits:
    10^8 signatures meet some 20 others by chance, where four tables of 16 bits would bring 6,000.
    Equal signatures are one row here; the caller maps records to them.
    """
    edges = [64 * i // (k + 3) for i in range(k + 4)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    tables = [sum(chosen) for chosen in combinations(masks, 3)]
    signed = [m - (1 << 64) if m >> 63 else m for m in tables]
    keys = F.array(*[F.struct(F.lit(i).alias("block"), F.col("simhash").bitwiseAND(F.lit(m)).alias("part")) for i, m in enumerate(signed)])
    rows = sigs.select("simhash").distinct().select("simhash", F.inline(keys))
    a, b = rows.withColumnRenamed("simhash", "a"), rows.withColumnRenamed("simhash", "b")
    return (
        a.join(b, ["block", "part"]).filter((F.col("a") < F.col("b")) & (hamming(F.col("a"), F.col("b")) <= k))
        .select("a", "b").distinct().withColumn("distance", hamming(F.col("a"), F.col("b")))
    )


def near_dedup(df: DataFrame, k: int = 3, keep: str = "first") -> DataFrame:
    """Ids kept by the greedy rule over ``df(id, text)`` in order of id.

    A row within ``k`` bits of a kept one is dropped; with ``keep="longest"`` it takes that row's place
    when it is longer. Blank texts vanish. ``first`` is found in distributed rounds: a row is kept when
    all its earlier neighbours are dropped, and dropped when one is kept. ``longest`` is decided
    component by component.
    """
    df = df.filter(clean("text") != "")
    sigs = cut(simhash(df).join(df.select("id", F.length(F.col("text")).alias("len")), "id"))
    pairs = hamming_pairs(sigs, k)
    if keep == "first":
        nodes = sigs.groupBy("simhash").agg(F.min("id").alias("id"))
        x, y = (nodes.select(F.col("simhash").alias(s), F.col("id").alias(i)) for s, i in (("a", "ia"), ("b", "ib")))
        edges = cut(pairs.join(x, "a").join(y, "b").select(F.least("ia", "ib").alias("first"), F.greatest("ia", "ib").alias("later")))
        kept, open_ = nodes.select("id").join(edges.select(F.col("later").alias("id")), "id", "left_anti"), edges
        dropped = None
        while True:
            gone = cut(open_.join(kept.withColumnRenamed("id", "first"), "first", "left_semi").select(F.col("later").alias("id")).distinct())
            dropped = gone if dropped is None else cut(dropped.union(gone).distinct())
            open_ = cut(
                open_.join(dropped.withColumnRenamed("id", "later"), "later", "left_anti")
                .join(dropped.withColumnRenamed("id", "first"), "first", "left_anti")
            )
            if open_.isEmpty():
                return nodes.select("id").join(dropped, "id", "left_anti")
            kept = open_.select(F.col("first").alias("id")).distinct().join(open_.select(F.col("later").alias("id")), "id", "left_anti")
    both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
    grouped = sigs.join(components(both), sigs["simhash"] == F.col("u"), "left").withColumn("root", F.coalesce("root", "simhash"))

    def greedy(pdf):
        pdf = pdf.sort_values("id")
        slots: list[list[int]] = []
        for i, h, n in zip(pdf["id"].tolist(), pdf["simhash"].tolist(), pdf["len"].tolist()):
            for slot in slots:
                if ((h ^ slot[1]) & (1 << 64) - 1).bit_count() <= k:
                    if n > slot[2]:
                        slot[:] = [i, h, n]
                    break
            else:
                slots.append([i, h, n])
        return pdf[pdf["id"].isin([s[0] for s in slots])][["id"]]

    return grouped.select("root", "id", "simhash", "len").groupBy("root").applyInPandas(greedy, "id long")
