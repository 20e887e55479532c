"""Slots for models: every one is a column function, and these stand-ins are deterministic."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Generate = Callable[[Column], Column]
REWARDS: dict[str, Callable[[Column, Column], Column]] = {}


def reward(f: Callable[[Column, Column], Column]) -> Callable[[Column, Column], Column]:
    """Register a reward function under its name."""
    REWARDS[f.__name__] = f
    return f


def echo(c: Column) -> Column:
    """Stand-in for a text generator: the prompt's last line."""
    return F.element_at(F.split(c, "\n"), -1)


@F.pandas_udf(T.ArrayType(T.FloatType()))
def hashed_embedding(texts: pd.Series) -> pd.Series:
    """Stand-in for an embedding model: hashed character bigrams, unit length (64)."""
    out = []
    for t in texts.fillna(""):
        v = np.zeros(64, np.float32)
        for i in range(len(t) - 1):
            h = zlib.crc32(t[i : i + 2].encode())
            v[h % 64] += 1 if h & 64 else -1
        n = float(np.linalg.norm(v))
        out.append((v / n if n else v).tolist())
    return pd.Series(out)


def overlap_rerank(query: Column, text: Column) -> Column:
    """Stand-in for a cross-encoder: share of the query's characters that the text has."""
    q, t = F.array_distinct(F.split(query, "")), F.array_distinct(F.split(text, ""))
    return F.coalesce(F.try_divide(F.size(F.array_intersect(q, t)), F.size(q)), F.lit(0.0))
