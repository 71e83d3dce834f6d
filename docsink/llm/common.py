"""What several operators share: written intermediate tables and joining group facts back."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsink.plans.tables import work_dir

# Groups with more rows than this share of the input are few (at most 1 / share).
HOT_SHARE = 0.001


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def written(frame: DataFrame, purpose: str, *by: str) -> DataFrame:
    """Write to the shared folder and read again: lost executors cost no recomputation."""
    path = f"{work_dir(frame.sparkSession, purpose)}/{purpose}"
    frame.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """Give each row the facts of its group, without sending a large group to one task.

    Groups with more than ``HOT_SHARE`` of ``total`` rows number at most
    ``1 / HOT_SHARE``, so they are broadcast; the others are joined by key.
    """
    limit = max(1000, int(total * HOT_SHARE))
    hot = F.broadcast(groups.where(F.col(size) > limit))
    facts = [c for c in groups.columns if c not in keys]
    found = rows.join(hot, keys, "left")
    done = found.where(F.col(size).isNotNull())
    rest = found.where(F.col(size).isNull()).drop(*facts)
    return done.unionByName(rest.join(groups.where(F.col(size) <= limit), keys, "left"))


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (the finaliser of SplitMix64)."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
