"""Rule-based rewards as columns, their weighted sum and group-relative advantages.

A reward is null where it doesn't apply to the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.functions.models import REWARDS, reward
from corpuskit.functions.text import pystrip

# Canonical region and its other names, in order of precedence.
ALIASES = (
    ("左上肺野", ("左上肺野", "左上肺", "left upper lung")), ("左中肺野", ("左中肺野", "左中肺", "left middle lung", "left mid lung")),
    ("左下肺野", ("左下肺野", "左下肺", "left lower lung")), ("右上肺野", ("右上肺野", "右上肺", "right upper lung")),
    ("右中肺野", ("右中肺野", "右中肺", "right middle lung", "right mid lung")), ("右下肺野", ("右下肺野", "右下肺", "right lower lung")),
    ("左肺野", ("左肺野", "左肺", "left lung")), ("右肺野", ("右肺野", "右肺", "right lung")),
    ("双肺野", ("双肺野", "双肺", "bilateral lung", "bilateral lungs")), ("心影纵隔区", ("心影纵隔区", "心影", "纵隔", "cardiomediastinal", "mediastinum")),
    ("左肋膈角", ("左肋膈角", "left costophrenic")), ("右肋膈角", ("右肋膈角", "right costophrenic")),
    ("左肺门", ("左肺门", "left hilum", "left hilar")), ("右肺门", ("右肺门", "right hilum", "right hilar")),
)
# Words of a negative and of a positive label.
SAYS_NO = "不一致|不匹配|不是|mismatch|not consistent|incorrect"
SAYS_YES = "一致|匹配|是|match|consistent|correct"


def expected_label(text: Column) -> Column:
    low = F.lower(text)
    return F.when(text.contains("不一致") | low.contains("mismatch"), "mismatch").when(text.contains("一致") | low.contains("match"), "match")


def predicted_label(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low.rlike(SAYS_NO), "mismatch").when(low.rlike(SAYS_YES), "match")


def _any(low: Column, names: tuple[str, ...]) -> Column:
    return low.rlike("|".join(names))


def expected_region(text: Column) -> Column:
    return F.coalesce(*[F.when(_any(F.lower(text), names), F.lit(key)) for key, names in ALIASES])


def mentions(text: Column, region: Column) -> Column:
    out = text.contains(region)
    for key, names in ALIASES:
        out = F.when(region == key, _any(F.lower(text), names)).otherwise(out)
    return out


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("double")


@reward
def accuracy_reward(completion: Column, reference: Column) -> Column:
    return _flag(F.lower(pystrip(completion)) == F.lower(pystrip(reference)))


@reward
def format_reward(completion: Column, reference: Column) -> Column:
    return _flag(completion.rlike(r"(?sm)\A<think>\n.*?\n</think>\n<answer>\n.*?\n</answer>$"))


@reward
def grounding_label_reward(completion: Column, reference: Column) -> Column:
    want = expected_label(reference)
    return F.when(want.isNotNull(), _flag(predicted_label(completion) == want))


@reward
def grounding_region_reward(completion: Column, reference: Column) -> Column:
    region = expected_region(reference)
    return F.when(region.isNotNull(), _flag(mentions(completion, region)))


@reward
def grounding_cot_format_reward(completion: Column, reference: Column) -> Column:
    applies = reference.isNull() | expected_label(reference).isNotNull()
    good = completion.rlike(r"(?s)<think>.*?</think>") & predicted_label(completion).isNotNull()
    return F.when(applies, _flag(good))


def reward_matrix(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """``df(.., completion, assistant)`` with a column for each registered reward."""
    return df.withColumns({n: REWARDS[n](F.col("completion"), F.col("assistant")) for n in names or list(REWARDS)})


def total_reward(names: list[str], weights: dict[str, float] | None = None) -> Column:
    """Weighted sum; rewards that don't apply are left out."""
    parts = [F.coalesce((weights or {}).get(n, 1.0) * F.col(n), F.lit(0.0)) for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def advantages(df: DataFrame, group: str, value: str = "reward", scale: str = "group") -> DataFrame:
    """Reward minus the group's mean, over its (or the whole table's) sample deviation plus 1e-4; scale "none" leaves that out."""
    if scale not in ("group", "batch", "none"):
        raise ValueError(scale)
    own = df.groupBy(F.col(group).alias("_g")).agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_std"))
    out = df.join(own, F.col(group).eqNullSafe(F.col("_g")))
    gap = F.col(value) - F.col("_mean")
    if scale == "batch":
        out = out.join(F.broadcast(df.agg(F.stddev_samp(value).alias("_all"))))
        return out.withColumn("advantage", gap / (F.col("_all") + 1e-4)).drop("_g", "_mean", "_std", "_all")
    return out.withColumn("advantage", gap / (F.col("_std") + 1e-4) if scale == "group" else gap).drop("_g", "_mean", "_std")


def reward_summary(df: DataFrame, names: list[str], group: str | None = None, reward: str = "reward") -> DataFrame:
    """Mean and deviation of each reward where it applies; with ``group`` also the mean reward, the mean
    deviation of the groups and the share of groups without deviation."""
    own = df.agg(*[F.avg(n).alias(f"{n}_mean") for n in names], *[F.stddev_samp(n).alias(f"{n}_std") for n in names])
    if group is None:
        return own
    groups = df.groupBy(group).agg(F.sum(reward).alias("s"), F.count(reward).alias("n"), F.stddev_samp(reward).alias("std"))
    whole = groups.agg((F.sum("s") / F.sum("n")).alias("reward_mean"), F.avg("std").alias("reward_std"), F.avg((F.coalesce("std", F.lit(0.0)) < 1e-8).cast("double")).alias("zero_std_share"))
    return own.join(F.broadcast(whole))
