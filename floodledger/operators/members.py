"""Dimension members: distinct values of several tables, numbered, with an Unknown row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from floodledger.schemas import conform, inline_rows
from floodledger.session import written
from floodledger.sources.sinks import exists, overwrite, remove, switch


def distinct_union(*sides: DataFrame) -> DataFrame:
    """Distinct rows of all sides, aligned by column name."""
    return reduce(DataFrame.unionByName, sides).distinct()


def number_members(members: DataFrame, key: str, order: Sequence[str], after: int = 0) -> DataFrame:
    """Keys 1..n in the order of the attributes, or the n keys behind ``after``.

    The members are dealt into ranges of the attributes, the ranges are counted, and each is
    numbered on its own from where the one before it ends, so no task sorts all members. The dealt
    rows are written first: another evaluation could draw other ranges.
    """
    spark = members.sparkSession
    by = [F.asc_nulls_first(c) for c in order]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = written(members.repartitionByRange(ranges, *by).withColumn("_range", F.spark_partition_id()), "members")
    # one row per range, so this window is small whatever the number of members
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored.groupBy("_range").count().select(
        "_range", (F.coalesce(F.sum("count").over(earlier), F.lit(0)) + after).alias("_start")
    )
    place = F.col("_start") + F.row_number().over(Window.partitionBy("_range").orderBy(*by))
    return stored.join(starts, "_range").withColumn(key, place.cast("int")).drop("_range", "_start")


def registered(members: DataFrame, key: str, registry: str) -> DataFrame:
    """All members ever seen with their keys: the new ones of ``members`` are added to the table at ``registry``.

    All columns of ``members`` identify a member and are never NULL. New members are found by an anti join and
    numbered behind the highest key, so members keep their keys and keys have no gaps. An addition
    is written beside the table and then moved into it as a folder of its own.
    """
    spark, order = members.sparkSession, members.columns
    schema = T.StructType([*members.schema.fields, T.StructField(key, T.IntegerType())])
    read = lambda: spark.read.schema(schema).parquet(f"{registry}/*")
    last, fresh = 0, members
    if exists(spark, registry):
        known = read()
        last = known.agg(F.max(key)).first()[0] or 0
        fresh = members.join(known.select(*order), order, "left_anti")
    staged = f"{registry}_staged"
    numbered = number_members(fresh, key, order, last).select(*schema.names)
    if overwrite(numbered, staged) or not last:
        switch(spark, staged, f"{registry}/after_{last}")
    remove(spark, staged)
    return read()


def without_unknown(members: DataFrame, unknown: dict[str, object]) -> DataFrame:
    """Leave out a member that spells the Unknown row, in any case; facts would have two matches."""

    def spells(c: str, v: object):
        return F.upper(c).eqNullSafe(F.lit(v.upper())) if isinstance(v, str) else F.col(c).eqNullSafe(F.lit(v))

    same = reduce(lambda a, b: a & b, (spells(c, v) for c, v in unknown.items()))
    return members.where(~same)


def with_unknown(members: DataFrame, unknown: tuple, ddl: str) -> DataFrame:
    """The members as the table schema says, plus the row for facts without a match."""
    return inline_rows(members.sparkSession, [unknown], ddl).unionByName(conform(members, ddl))
