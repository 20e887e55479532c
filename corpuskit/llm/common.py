"""Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.operators.graph import components, cut

__all__ = ["COPIES", "Sieve", "components", "copy_classes", "cut", "expand_pairs", "sieve", "table", "text_of"]

COPIES = 8
SIEVE_BITS, SIEVE_PARTS = 26, 16  # a Bloom filter has at most 2^26 bits, 8 MB


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(*columns: str) -> Column:
    """Columns joined by a newline, null as empty."""
    return F.concat_ws("\n", *[F.coalesce(F.col(c), F.lit("")) for c in columns])


def copy_classes(members: DataFrame, by: list[str]) -> DataFrame:
    """Members (``cls``, ``id``, ...) with ``rep`` and ``n`` of their class of exact copies.

    Counted with map-side combine; a class holding a third of the rows is joined to one row,
    which adaptive skew handling can split.
    """
    stats = members.groupBy(*by).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))
    return members.join(stats.filter("n > 1"), by, "left").withColumns(
        {"rep": F.coalesce("rep", "id"), "n": F.coalesce("n", F.lit(1))}
    )


def expand_pairs(links: DataFrame, members: DataFrame, keep: list[str], copies: int = COPIES) -> DataFrame:
    """Links between classes -> pairs of members ``id_a < id_b``.

    A class of at most ``copies`` exact copies is expanded in full. A larger one stands by its
    smallest id in links to other texts, and each of its members is paired with that id: the
    number of rows stays linear in the rows, and no link between different texts is lost.
    """
    m = copy_classes(members, ["cls"])
    shown = m.filter((F.col("n") <= copies) | (F.col("id") == F.col("rep"))).select("cls", "id", *keep)
    a = shown.withColumnsRenamed({"cls": "cls_a", "id": "x"})
    b = shown.select(F.col("cls").alias("cls_b"), F.col("id").alias("y"))
    across = links.select("cls_a", "cls_b").join(a, "cls_a").join(b, "cls_b").select(*keep, "x", "y")
    twice = m.filter((F.col("n") > 1) & (F.col("n") <= copies)).select("cls", "id", *keep)
    inside = (
        twice.withColumnRenamed("id", "x")
        .join(twice.select("cls", F.col("id").alias("y")), "cls")
        .filter("x < y")
        .select(*keep, "x", "y")
    )
    star = m.filter((F.col("n") > copies) & (F.col("id") > F.col("rep"))).select(
        *keep, F.col("rep").alias("x"), F.col("id").alias("y")
    )
    return across.unionByName(inside).unionByName(star).select(
        *keep, F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")
    )


class Sieve:
    """A Bloom filter of 64-bit hashes: lets all wanted ones pass, and few others."""

    def __init__(self, bits: np.ndarray | None) -> None:
        self.bits = bits

    @staticmethod
    def probes(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        h = hashes.view(np.uint64)
        return (h & np.uint64(size - 1)).astype(np.int64), (h >> np.uint64(32) & np.uint64(size - 1)).astype(np.int64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        if self.bits is None:
            return np.ones(len(hashes), bool)
        out = np.ones(len(hashes), bool)
        for at in self.probes(hashes, len(self.bits) * 8):
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return out


def sieve(values: DataFrame, column: str) -> Sieve:
    """A filter of a column of hashes, built by the tasks in parts and united by part.

    Its size follows their number up to 2^SIEVE_BITS bits; beyond a quarter of that it lets all pass,
    and the joins behind it do the work alone.
    """
    values = cut(values.select(column))
    n = values.count()
    size = 1 << min(SIEVE_BITS, max(16, (16 * n).bit_length()))
    if 4 * n > size:
        return Sieve(None)
    part_bytes = size // 8 // SIEVE_PARTS

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size, bool)
        for batch in batches:
            for at in Sieve.probes(batch.column(0).to_numpy(), size):
                table[at] = True
        parts = np.packbits(table, bitorder="little").reshape(SIEVE_PARTS, -1)
        some = [i for i in range(SIEVE_PARTS) if parts[i].any()]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([parts[i].tobytes() for i in some], pa.binary())], names=["part", "bits"])

    def united(group: pa.Table) -> pa.Table:
        out = np.zeros(part_bytes, np.uint8)
        for x in group.column("bits"):
            out |= np.frombuffer(x.as_py(), np.uint8)
        return pa.table({"part": group.column("part").slice(0, 1), "bits": pa.array([out.tobytes()], pa.binary())})

    schema = "part int, bits binary"
    whole = np.zeros((SIEVE_PARTS, part_bytes), np.uint8)
    for r in values.mapInArrow(bits, schema).groupBy("part").applyInArrow(united, schema).collect():
        whole[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return Sieve(whole.ravel())
