"""Training frames from the history of keys: what was known before each row, and targets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import as_of_join, top_keys_semi
from .sequence import sequence_features


def load_history(facts: DataFrame, values: DataFrame, key: str, time: str, season: str, value: str, *, seasons: int = 3, n_keys: int | None = None) -> DataFrame:
    """Facts of the newest seasons, of the first n_keys keys where given, with the value that
    was known at their time. values(key, time, value) has one row for each key and time."""
    newest = facts.agg((F.max(season) - (seasons - 1)).alias("_floor"))  # one row
    kept = facts.join(F.broadcast(newest), F.col(season) >= F.col("_floor")).drop("_floor")
    if n_keys is not None:
        kept = top_keys_semi(kept, key, n_keys)
    return as_of_join(kept, values, key, time, time, [value])


def training_frame(facts: DataFrame, key: str, time: str, tie: str, value: str, target: Column, features: Mapping[str, Column]) -> DataFrame:
    """facts with the sequence features of value, further features and the target. Rows
    without a time or a target are dropped, but count as history of the rows after them."""
    seen = sequence_features(facts, key, [F.col(time).asc_nulls_last(), F.col(tie)], value)
    return seen.withColumns({**features, "target": target}).where(F.col(time).isNotNull() & F.col("target").isNotNull())
