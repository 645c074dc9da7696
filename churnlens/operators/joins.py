"""Key-checked attach of per-customer facts (J1, J2), and joins of two sides that both grow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assert_unique(df: DataFrame, keys: Sequence[str] | str) -> None:
    """Raise if a key occurs twice; a duplicate key would multiply join rows.

    One aggregation on the key (partial aggregation map-side); stops at the
    first duplicate found.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"key {keys} is not unique, e.g. {dup[0].asDict()}")


def attach_by_key(left: DataFrame, right: DataFrame, key: str | Sequence[str],
                  check_unique: bool = True) -> DataFrame:
    """Inner equi-join of per-customer facts (segment, score) onto customers.

    Both sides are keyed by the customer; the planner shuffles both on the key
    (or broadcasts a side it measures small).  Uniqueness of the right key is
    checked first because the reference pasted arrays by position.
    """
    if check_unique:
        assert_unique(right, key)
    return left.join(right, on=key, how="inner")


def merged(left: DataFrame, right: DataFrame, key: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join of two sides that both grow with the customers, always by shuffle, sort and merge.

    Left to itself the planner broadcasts a side whose shuffled (compressed)
    bytes are below its threshold, and a broadcast is collected on the driver:
    what passes through the driver would grow with the input up to there.
    """
    return left.join(right.hint("merge"), on=key, how=how)
