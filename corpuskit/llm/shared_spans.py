"""Long exact spans shared between records (problem 9).

1. Winnowed fingerprints: of every ``least`` consecutive characters at least one window of ``k`` is
   an anchor, so two texts sharing a span of ``least`` share an anchor. Only anchors standing in two
   different texts go on, with the text around them (*regions*).
2. Regions are put into shards of bounded size, those with the same smallest anchor together. Each
   shard is a compressed FM-index; the regions that share an anchor with one of its texts are
   streamed through it by backward search over the wavelet matrix, which reports the intervals above
   the threshold and the texts that hold them.
3. Exact copies are one class and expanded at the end.

Defined cases: null or shorter than ``least``: in no pair; a text repeating a span within itself is
no case; rows without an id are ignored; characters are compared as they stand; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, expand_pairs
from .fm_index import FMIndex, long_matches
from .kernels import U64, flat, gram_hashes, list_column, row_hashes, running_min, slices

LEAST, WINDOW = 200, 81
SHARD_CHARS = 400_000
QUERY_CHARS = 1_000_000


def _anchors(least: int, window: int, members: bool):
    k = least - window + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for batch in slices(whole, "text"):
                codes, starts = flat(batch.column("text"))
                cls = row_hashes(codes, starts).view(np.int64)
                pick = np.nonzero(np.diff(starts) >= least)[0]
                if members:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(pa.array(pick)), pa.array(cls[pick]), pa.array(np.diff(starts)[pick])],
                        names=["id", "cls", "n_chars"],
                    )
                    continue
                fresh = np.zeros(len(cls), bool)
                for i, c in zip(pick.tolist(), cls[pick].tolist()):
                    if c not in seen:
                        seen.add(c)
                        fresh[i] = True
                if not fresh.any():
                    continue
                h = gram_hashes(codes, k)
                low = running_min(h, window)
                row = np.repeat(np.arange(len(cls)), np.diff(starts))
                low[row[: len(low)] != row[least - 1 :][: len(low)]] = 0  # such a window is in two rows
                low = np.where(fresh[row[: len(low)]], low, U64(0))
                padded = np.concatenate([np.zeros(window - 1, U64), low, np.zeros(window - 1, U64)])
                top = ~running_min(~padded, window)  # for each window of k: the largest minimum it is part of
                at = np.nonzero((top == h) & (top != 0))[0]
                ids = batch.column("id").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row[at]]), pa.array(cls[row[at]]), pa.array((at - starts[row[at]]).astype(np.int32)), pa.array(h[at].view(np.int64))],
                    names=["id", "cls", "pos", "fp"],
                )

    return run


def _regions(least: int, window: int):
    k = least - window + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"cls": [], "start": [], "text": [], "fps": [], "home": [], "n": []}
            for cls, text, found in zip(*(batch.column(c).to_pylist() for c in ("cls", "text", "found"))):
                found = sorted((x["pos"], x["fp"]) for x in found)
                i = 0
                while i < len(found):
                    j = i + 1
                    while j < len(found) and found[j][0] - found[j - 1][0] <= k + 2 * least:
                        j += 1
                    a, b = max(0, found[i][0] - least), found[j - 1][0] + k + least
                    fps = sorted({fp for _, fp in found[i:j]})
                    for name, value in zip(out, (cls, a, text[a:b], fps, fps[0], len(text[a:b]))):
                        out[name].append(value)
                    i = j
            yield pa.RecordBatch.from_pydict(
                out, pa.schema([("cls", pa.int64()), ("start", pa.int32()), ("text", pa.string()), ("fps", pa.list_(pa.int64())), ("home", pa.int64()), ("n", pa.int32())])
            )

    return run


def _searched(least: int):
    schema = pa.schema([("cls_a", pa.int64()), ("cls_b", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])

    def run(group: pa.Table) -> pa.Table:
        own = group.filter(group["part"].is_null()).combine_chunks()
        asked = group.filter(group["part"].is_valid()).combine_chunks()
        if not own.num_rows or not asked.num_rows:
            return schema.empty_table()
        codes, starts = flat(own["text"])
        index = FMIndex([codes[a:b] for a, b in zip(starts[:-1], starts[1:])])
        holders = own["cls"].to_numpy()
        query, qstarts = flat(asked["text"])
        hits = long_matches(index, query, qstarts, least)
        a, b = asked["cls"].to_numpy()[hits[:, 0]], holders[hits[:, 1]]
        other = a != b
        a, b, hits = a[other], b[other], hits[other]
        base = asked["start"].to_numpy()[hits[:, 0]]
        pairs = np.unique(np.stack([a, b], 1), axis=0)
        order = np.lexsort((hits[:, 2] + base, a))
        spans: list[list[int]] = []
        for who, s, e in zip(a[order].tolist(), (hits[:, 2] + base)[order].tolist(), (hits[:, 3] + base)[order].tolist()):
            if spans and spans[-1][0] == who and s <= spans[-1][2]:
                spans[-1][2] = max(spans[-1][2], e)
            else:
                spans.append([who, s, e])
        whom, begin, end = ([x[i] for x in spans] for i in range(3))
        none = [None] * len(pairs)
        return pa.Table.from_arrays(
            [
                pa.array(pairs[:, 0].tolist() + whom, pa.int64()),
                pa.array(pairs[:, 1].tolist() + [None] * len(spans), pa.int64()),
                pa.array(none + begin, pa.int32()),
                pa.array(none + end, pa.int32()),
            ],
            schema=schema,
        )

    return run


def shared_spans(
    df: DataFrame, least: int = LEAST, window: int = WINDOW, shard_chars: int = SHARD_CHARS, query_chars: int = QUERY_CHARS
) -> tuple[DataFrame, DataFrame]:
    """``df(id, text)`` -> (found, members).

    found: ``(cls_a, cls_b)`` of two texts sharing a span, or ``(cls_a, start, end)``, a part of a
    text shared elsewhere; members: ``id, cls, n_chars`` of the texts long enough.
    """
    df = df.select("id", "text").filter("id is not null")
    members = df.mapInArrow(_anchors(least, window, True), "id long, cls long, n_chars long")
    anchors = df.mapInArrow(_anchors(least, window, False), "id long, cls long, pos int, fp long")
    common = anchors.groupBy("fp").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).filter("low <> high").select("fp")
    found = (
        anchors.join(common, "fp").groupBy("cls")
        .agg(F.min("id").alias("id"), F.collect_set(F.struct("pos", "fp")).alias("found"))
    )
    regions = cut(
        found.join(df, "id").select("cls", "text", "found").mapInArrow(
            _regions(least, window), "cls long, start int, text string, fps array<long>, home long, n int"
        )
    )
    total = regions.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // shard_chars))
    sizes = regions.groupBy("home").agg(F.sum("n").alias("size"))
    homes = sizes.select(
        "home",
        F.when(F.col("size") > shard_chars, F.col("home")).otherwise(F.pmod("home", F.lit(shards))).alias("shard"),
        F.ceil(F.col("size") / shard_chars).cast("int").alias("subs"),
    )
    placed = regions.join(homes, "home").withColumn("rid", F.xxhash64("cls", "start"))
    index = placed.withColumn("sub", F.pmod("rid", F.col("subs")).cast("int"))
    there = placed.select(F.explode("fps").alias("fp"), "shard", "subs").distinct()
    routes = (
        placed.select("rid", "n", F.explode("fps").alias("fp")).join(there, "fp").select("rid", "n", "shard", "subs").distinct()
    )
    load = routes.groupBy("shard").agg(F.ceil(F.sum("n") / query_chars).cast("int").alias("parts"))
    asked = (
        routes.join(load, "shard")
        .select("rid", "shard", F.pmod("rid", "parts").cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.col("subs") - 1)).alias("sub"))
        .join(placed.select("rid", "cls", "start", "text"), "rid")
        .select("shard", "sub", F.col("part").alias("slot"), "part", "cls", "start", "text")
    )
    stored = index.join(load, "shard").select(
        "shard", "sub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("slot"), F.lit(None).cast("int").alias("part"), "cls", "start", "text"
    )
    hits = stored.unionByName(asked).groupBy("shard", "sub", "slot").applyInArrow(_searched(least), "cls_a long, cls_b long, start int, end int")
    return hits, members


def shared_span_pairs(df: DataFrame, **options) -> DataFrame:
    """``(id_a, id_b)`` of records sharing a span of at least ``least`` characters."""
    found, members = shared_spans(df, **options)
    links = found.filter("cls_b is not null").select(F.least("cls_a", "cls_b").alias("cls_a"), F.greatest("cls_a", "cls_b").alias("cls_b")).distinct()
    return expand_pairs(links, members, [])


def shared_portions(df: DataFrame, **options) -> DataFrame:
    """``id, n_chars, shared_chars, share`` of each record of which something is shared elsewhere."""
    found, members = shared_spans(df, **options)
    spans = found.filter("cls_b is null").groupBy("cls_a").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("upto"))
    covered = F.aggregate(
        "spans",
        start,
        lambda acc, s: F.struct(
            (acc["total"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], acc["upto"]))).alias("total"),
            F.greatest(acc["upto"], s["end"]).alias("upto"),
        ),
        lambda acc: acc["total"],
    )
    spans = spans.select(F.col("cls_a").alias("cls"), covered.cast("long").alias("covered"))
    copies = members.groupBy("cls").agg(F.count(F.lit(1)).alias("copies"))
    return (
        members.join(spans, "cls", "left").join(copies, "cls")
        .withColumn("shared_chars", F.when(F.col("copies") > 1, F.col("n_chars")).otherwise(F.coalesce("covered", F.lit(0))))
        .filter("shared_chars > 0")
        .select("id", "n_chars", "shared_chars", (F.col("shared_chars") / F.col("n_chars")).alias("share"))
    )
