"""Lineage cuts and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines share, as ``spark.checkpoint.dir`` names it; without one there is no safe default."""
    folder = spark.sparkContext.getCheckpointDir() or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return folder.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with an eager checkpoint in the shared folder the session names."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``(u, v)`` as ``(u, root)``, by alternating large and small star.

    Each round is two shuffles on (u) with map-side minima and is cut with a checkpoint; the
    number of rounds grows with the logarithm of the longest chain. Stops early when stable;
    raises if it isn't after ``max_rounds``.
    """
    e = cut(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
            .union(down.select("u", F.col("m").alias("v")))
            .distinct()
        )
        e = cut(small)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            members = e.groupBy("u").agg(F.min("v").alias("root"))
            return members.union(members.select(F.col("root").alias("u"), "root").distinct())
        before = now
    raise RuntimeError(f"components aren't stable after {max_rounds} rounds")
