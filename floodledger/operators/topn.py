"""Leading rows of a table or of every group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from floodledger.session import written

# Fan-in of the salted rounds below.
FAN_IN = 32


def _rest(df: DataFrame) -> list[Column]:
    """All columns that can be sorted, to break ties."""
    return [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def _leading(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def top_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rounds: int = 2
) -> DataFrame:
    """The first ``n`` rows of every group, exactly; ties in ``order`` go by the other columns.

    The rows are found in rounds: each group is split into ``FAN_IN ** rounds`` hashed shares, each
    share keeps its own first ``n``, and shares are merged ``FAN_IN`` at a time. A task of a later
    round sees at most ``FAN_IN * n`` rows of a group, so no task receives a whole hot group. The
    input partition is part of the hash: it spreads exact copies, and a retried task assigns the
    same share again.
    """
    order = [*order, *_rest(df)]
    shares = FAN_IN**rounds
    salt = F.xxhash64(*df.columns, F.spark_partition_id())
    salted = df.withColumn("_share", F.pmod(salt, F.lit(shares)))
    for _ in range(rounds):
        salted = _leading(salted, [*by, "_share"], order, n)
        salted = salted.withColumn("_share", F.floor(F.col("_share") / FAN_IN))
    return _leading(salted.drop("_share"), by, order, n)


def completeness(found: DataFrame, landed: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows found at the source and rows landed per group, with a flag where they differ."""
    sides = found.select(*by, F.lit(1).alias("_found")).unionByName(landed.select(*by, F.lit(0).alias("_found")))
    counted = sides.groupBy(*by).agg(
        F.sum("_found").alias("rows_found"), F.count_if(F.col("_found") == 0).alias("rows_landed")
    )
    return counted.withColumn("truncated", (F.col("rows_found") != F.col("rows_landed")).cast("int"))


def page(
    df: DataFrame, key: str, top: int, skip: int = 0, after: object | None = None
) -> DataFrame:
    """``top`` rows in key order, after ``skip`` rows or after a key value; ties go by the other columns.

    A skip is exact at any depth and sorts nothing in one place: the rows are dealt into ranges of
    the key, the ranges are counted, and only those that the page lies in are numbered.
    """
    rows = df if after is None else df.where(F.col(key) > after)
    order = [F.col(key), *_rest(df)]
    if not skip:
        return rows.orderBy(*order).limit(top)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written: another evaluation could draw other ranges
    dealt = written(rows.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "pages")
    counts = dict(dealt.groupBy("_part").count().collect())
    start, wanted = 0, []
    for part in sorted(counts):
        if start < skip + top and start + counts[part] > skip:
            wanted.append((part, start))
        start += counts[part]
    if not wanted:
        return rows.limit(0)
    before = F.element_at(F.create_map(*[F.lit(x) for pair in wanted for x in pair]), F.col("_part"))
    place = before + F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    numbered = dealt.where(F.col("_part").isin([p for p, _ in wanted])).withColumn("_place", place)
    page = numbered.where((F.col("_place") > skip) & (F.col("_place") <= skip + top))
    return page.orderBy("_place").drop("_place", "_part")
