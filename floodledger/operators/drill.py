"""Combine two facts that share no key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drill_across(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join of two aggregates on their shared grain.

    Both sides must hold one row per key already. Keys are compared null-safe, so that an unknown
    year of one side meets the unknown year of the other, and appear once in the output.
    """
    left_on = left.select(*(F.col(c).alias(f"_l_{c}" if c in keys else c) for c in left.columns))
    right_on = right.select(*(F.col(c).alias(f"_r_{c}" if c in keys else c) for c in right.columns))
    match = [F.col(f"_l_{k}").eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    measures = [c for side in (left, right) for c in side.columns if c not in keys]
    return left_on.join(right_on, match, "full_outer").select(
        *(F.coalesce(f"_l_{k}", f"_r_{k}").alias(k) for k in keys), *measures
    )
