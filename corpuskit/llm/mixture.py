"""Mixing sources to target weights (problem 8).

Sizes are tokens of a public tokenizer, counted over every document. Target weights are propagated
through a tree domain - language - source; what a leaf can't give, because its source is small or
absent and its repeats are used up, goes to its siblings first and then to the next level up. Each
leaf then takes whole epochs of its source and a prefix, in tokens, of one more seeded epoch.

Defined cases: a null source is no source; a null text has no tokens and is never taken; a source
without a weight, or with weight 0 or no repeats, gives nothing; an absent source's share goes to
its siblings; an empty table gives no rows. Ties of the seeded order break by id.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from public_tokenizers import PATTERN  # the split pattern that belongs to the public vocabularies
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

MOST_SOURCES = 10_000
BUCKET_DOCS = 2_000


@cache
def tokenizer(path: str):
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, path: str) -> DataFrame:
    """``df(id, source, text)`` -> ``(id, source, n_tokens)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode_ordinary
        for batch in batches:
            n = [len(encode(t)) if t else 0 for t in batch.column("text").to_pylist()]
            yield batch.select(["id", "source"]).append_column("n_tokens", pa.array(n, pa.int64()))

    return df.select("id", "source", "text").mapInArrow(run, "id long, source string, n_tokens long")


@dataclass
class Node:
    """A node of the weight tree; ``room`` of a leaf is its tokens times its repeats."""

    name: str
    weight: float = 0.0
    room: float = 0.0
    children: list[Node] = field(default_factory=list)

    def settle(self) -> None:
        for c in self.children:
            c.settle()
        if self.children:
            self.weight = sum(c.weight for c in self.children)
            self.room = sum(c.room for c in self.children if c.weight > 0)


def share_out(budget: float, weights: list[float], rooms: list[float]) -> list[float]:
    """Split a budget by weights; what exceeds a child's room goes to the others by their weights."""
    got = [0.0] * len(weights)
    open_ = [i for i, (w, r) in enumerate(zip(weights, rooms)) if w > 0 and r > 0]
    left = min(budget, sum(rooms[i] for i in open_))
    while open_ and left > 1e-9:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total >= rooms[i]]
        if not full:
            for i in open_:
                got[i] = left * weights[i] / total
            break
        for i in full:
            got[i] = rooms[i]
        left -= sum(rooms[i] for i in full)
        open_ = [i for i in open_ if i not in full]
    return got


def budgets(root: Node, budget: float) -> dict[str, float]:
    """Budget of each leaf: shortages stay among siblings while these have room."""
    root.settle()
    out: dict[str, float] = {}

    def walk(node: Node, mine: float) -> None:
        if not node.children:
            out[node.name] = mine
            return
        for child, part in zip(node.children, share_out(mine, [c.weight for c in node.children], [c.room for c in node.children])):
            walk(child, part)

    walk(root, min(budget, root.room))
    return out


def tree(leaves: list[tuple[str, float, float]], domain_of: dict[str, str]) -> Node:
    """Domain - language - source; the language is the last part of a source's name."""
    root = Node("")
    for source, weight, room in sorted(leaves):
        stem, _, lang = source.rpartition("_")
        at = root
        for name in (domain_of.get(stem, stem or source), lang):
            nxt = next((c for c in at.children if c.name == name), None)
            if nxt is None:
                at.children.append(nxt := Node(name))
            at = nxt
        at.children.append(Node(source, weight, room))
    return root


def largest_total(leaves: list[tuple[str, float, float]], domain_of: dict[str, str]) -> float:
    """The largest total at which no source that has tokens runs short of its target."""
    low, high = 0.0, sum(room for _, _, room in leaves)
    for _ in range(80):
        mid = (low + high) / 2
        given = budgets(tree(leaves, domain_of), mid)
        short = any(w > 0 and 0 < room <= given[s] + 1e-6 or given[s] < w * mid * (1 - 1e-9) and room > 0 for s, w, room in leaves)
        low, high = (low, mid) if short else (mid, high)
    return low


def mixture(
    docs: DataFrame, weights: DataFrame, domain_of: dict[str, str], path: str, total_tokens: int | None = None, times: float | None = None, seed: int = 17
) -> tuple[DataFrame, DataFrame]:
    """``docs(id, source, text)``, ``weights(source, target_share, max_repeats)`` -> (mixture, report).

    ``path``: the vocabulary file of a public tokenizer, which every machine must have. mixture: ``id,
    source, n_tokens, n_copies``; report: a row per weighted source. The mixture has ``total_tokens``, or
    ``times`` the tokens of all weighted sources. Without either it is the largest in which every source that has documents reaches its
    target; a larger total makes sources run short, and the others take over their shares.
    """
    spark = docs.sparkSession
    sizes = cut(token_counts(docs, path).filter("source is not null and id is not null"))
    rows = weights.filter("source is not null").limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} weighted sources")
    want = {r["source"]: (max(0.0, r["target_share"] or 0.0), max(0, r["max_repeats"] or 0)) for r in rows}
    have = {
        r["source"]: (r["n"], r["docs"])
        for r in sizes.filter(F.col("source").isin(list(want))).groupBy("source").agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("docs")).collect()
    }
    leaves = [(s, w, have.get(s, (0, 0))[0] * most) for s, (w, most) in want.items()]
    weight = sum(w for _, w, _ in leaves) or 1.0
    leaves = [(s, w / weight, room) for s, w, room in leaves]
    if times is not None:
        total_tokens = int(times * sum(n for n, _ in have.values()))
    budget = largest_total(leaves, domain_of) if total_tokens is None else total_tokens
    given = budgets(tree(leaves, domain_of), budget)
    plan = []
    for s, (w, most) in want.items():
        n, count = have.get(s, (0, 0))
        epochs = min(most, int((given[s] + 0.5) // n)) if n else 0
        rest = int(round(given[s] - epochs * n)) if epochs < most else 0
        plan.append((s, w, most, n, count, float(given[s]), epochs, max(0, rest), max(16, -(-count // BUCKET_DOCS))))
    leaf = spark.createDataFrame(
        plan, "source string, target_share double, max_repeats int, source_tokens long, source_docs long, budget double, epochs int, rest long, buckets long"
    )
    order = F.xxhash64("id", F.lit(seed), "epochs")
    rank = F.shiftrightunsigned(order, 33)
    placed = (
        sizes.filter("n_tokens > 0").join(F.broadcast(leaf), "source")
        .withColumn("order", rank)
        .withColumn("bucket", F.shiftright(rank * F.col("buckets"), 31))
    )
    byte = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    heads = (
        placed.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("in_bucket"))
        .withColumn("before", F.coalesce(F.sum("in_bucket").over(byte), F.lit(0)))
    )
    placed = placed.join(heads, ["source", "bucket"])
    inside = placed.filter("before + in_bucket <= rest").withColumn("extra", F.lit(1))
    beyond = placed.filter("before >= rest").withColumn("extra", F.lit(0))
    run = Window.partitionBy("source", "bucket").orderBy("order", "id").rowsBetween(Window.unboundedPreceding, 0)
    edge = placed.filter("before < rest and before + in_bucket > rest").withColumn("upto", F.col("before") + F.sum("n_tokens").over(run))
    edge = edge.withColumn("extra", (F.col("upto") <= F.col("rest")).cast("int")).drop("upto")
    mixed = (
        inside.unionByName(beyond).unionByName(edge)
        .withColumn("n_copies", F.col("epochs") + F.col("extra")).filter("n_copies > 0")
        .select("id", "source", "n_tokens", "n_copies")
    )
    reached = mixed.groupBy("source").agg(
        F.sum(F.col("n_tokens") * F.col("n_copies")).alias("tokens"), F.count(F.lit(1)).alias("n_documents"), F.max("n_copies").alias("most_copies")
    )
    report = leaf.join(reached, "source", "left").select(
        "source", "target_share", "max_repeats", "source_tokens",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("tokens", "n_documents", "most_copies")],
    )
    report = report.withColumn("share", F.coalesce(F.try_divide("tokens", F.sum("tokens").over(Window.partitionBy())), F.lit(0.0)))
    return mixed, report
