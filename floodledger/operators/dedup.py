"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: What ends a text among packed ones, and what begins one and replaces both inside of it.
_END, _MARK = "\u0000", "\u0001"
_ESCAPED = {_MARK: _MARK + "\u0002", _END: _MARK + _MARK}


def pack(columns: Sequence[str]) -> Column:
    """Text columns as one text that sorts as they do one after the other, NULL first.

    A row of many short texts takes eight bytes or more for each beside the text itself, in sorts and shuffles.
    """

    def part(c: str) -> Column:
        text = safe = F.col(c)
        for plain, escaped in _ESCAPED.items():
            safe = F.replace(safe, F.lit(plain), F.lit(escaped))
        # looking is far cheaper than replacing nothing
        odd = text.contains(_MARK) | text.contains(_END)
        return F.coalesce(F.concat(F.lit(_MARK), F.when(odd, safe).otherwise(text)), F.lit(""))

    return F.concat_ws(_END, *map(part, columns))


def unpacked(part: Column) -> Column:
    """A text from its part between the ends of a packed text."""
    text = plainer = F.substring(part, 2, 2**31 - 1)
    for plain, escaped in reversed(_ESCAPED.items()):
        plainer = F.replace(plainer, F.lit(escaped), F.lit(plain))
    return F.when(part != "", F.when(text.contains(_MARK), plainer).otherwise(text))


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """The newest row of every key; NULL keys form one group.

    All remaining columns break ties, so the survivor does not depend on partitioning. Because the
    filter keeps rank one only, Spark limits each key to one row inside every map task before the
    shuffle, and a key with very many copies arrives as one row per task.
    """
    rest = [c for c in df.columns if c not in set(keys) | set(newest_first)]
    if len(rest) < 2 or any(df.schema[c].dataType != T.StringType() for c in rest):
        return _first_per_key(df, keys, newest_first, rest)
    # only keys, times and one text beside them are sorted and shuffled
    slim = df.select(*keys, *newest_first, pack(rest).alias("_rest"))
    kept = _first_per_key(slim, keys, newest_first, ["_rest"]).withColumn("_rest", F.split("_rest", _END))
    place = {c: i for i, c in enumerate(rest)}
    return kept.select(*(unpacked(F.col("_rest")[place[c]]).alias(c) if c in place else c for c in df.columns))


def _first_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str], rest: Sequence[str]) -> DataFrame:
    # Keys are listed from coarse to fine; sorting by the finest first settles most comparisons on
    # the first column.
    within = Window.partitionBy(*reversed(keys))
    order = [F.desc_nulls_last(c) for c in newest_first] + [F.asc_nulls_first(c) for c in rest]
    rank = F.row_number().over(within.orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def surplus_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows, how many keys, and how many rows a dedup on the keys would drop."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"),
        F.count(F.lit(1)).alias("rows_kept"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows_dropped"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Keys held by more than one row, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
