"""Key lookups from facts to dimensions, and the checks that go with them.

No join below carries a broadcast hint. Dimensions are read back from written tables, so the
planner knows their size: below the broadcast threshold the lookup is a map-side hash join, above
it a sort-merge join whose skewed partitions are split at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodledger.functions.derive import known_key


def resolve_key(
    fact: DataFrame, dim: DataFrame, on: Mapping[str, str], key: str, alias: str | None = None
) -> DataFrame:
    """Add the dimension key of each fact row, -1 where nothing matches.

    ``on`` maps fact columns to the dimension columns that are unique together.
    """
    alias = alias or key
    side = dim.select(
        F.col(key).alias(f"_{alias}"), *(F.col(d).alias(f"_{alias}_{i}") for i, d in enumerate(on.values()))
    )
    match = [F.col(f) == F.col(f"_{alias}_{i}") for i, f in enumerate(on)]
    return (
        fact.join(side, match, "left")
        .withColumn(alias, known_key(F.col(f"_{alias}")))
        .drop(*side.columns)
    )


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose key is missing from the dimension."""
    side = dim.select(F.col(dim_key).alias("_key"))
    return fact.join(side, F.col(fact_key) == F.col("_key"), "left_anti")


def probe_keys(
    fact: DataFrame,
    edges: Sequence[tuple[str, DataFrame, str]],
    carry: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """The fact with a column ``_<fact_key>`` per ``(fact_key, dim, dim_key)``, NULL for orphans.

    ``carry`` names dimension columns to bring along, by fact key. Dimensions with repeated keys
    are reduced to one row per key first, so the fact keeps its rows.
    """
    for fact_key, dim, dim_key in edges:
        extra = list((carry or {}).get(fact_key, ()))
        side = dim.select(F.col(dim_key).alias(f"_{fact_key}"), *extra).dropDuplicates([f"_{fact_key}"])
        fact = fact.join(side, F.col(fact_key) == F.col(f"_{fact_key}"), "left")
    return fact


def is_orphan(fact_key: str) -> Column:
    return F.col(f"_{fact_key}").isNull()


def orphan_counts(fact: DataFrame, edges: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """One row with the number of orphans of every edge, from a single pass over the fact."""
    keys = list(dict.fromkeys(fact_key for fact_key, _, _ in edges))
    probed = probe_keys(fact.select(*keys), edges)
    return probed.agg(*(F.count_if(is_orphan(key)).alias(key) for key in keys))
