"""Cleaned tables and facts in buckets of the landed key, so that a load touches only its buckets.

A stored cleaned row keeps, beside its typed columns, the landed text and ingestion time that decide
which row of a key is the newest; of the text, only what the typed columns do not spell. A new load is deduplicated together with the stored rows of the
buckets that its keys fall into; these buckets are written anew, all others keep their files.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floodledger.operators.dedup import duplicate_keys, latest_per_key
from floodledger.plans.silver import ENTITIES, INGESTED, Entity, bucket_of, row_key, usable
from floodledger.schemas import BUCKET, ROW_KEY, SILVER, struct, text_schema
from floodledger.session import passing_shuffles
from floodledger.sources.landing import LOAD, read_bronze
from floodledger.sources.sinks import exists, length_of, overwrite, remove

LANDED = "landed"
#: How landed text is stored; a table of another form is built anew.
FORM = 2
#: Stored bytes that a merge takes in at once: what it shuffles and writes beside the old files stays in proportion to them.
ROUND = 4 << 30
#: What a stored landed text begins with, so that an empty one can stand for NULL.
_AS_IS = "="


class KeyCollision(RuntimeError):
    """Two landed keys have the same identity."""


def default_buckets(spark: SparkSession) -> int:
    """As many as tasks that deduplicate, each of which then writes whole buckets."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _spelled(kind: Entity, c: str) -> Column:
    return F.col(kind.spelled[c]).cast("string") if c in kind.spelled else F.lit(None).cast("string")


def _short(kind: Entity, c: str) -> Column:
    """A landed text as it is stored: NULL if its typed column spells it."""
    text = F.col(f"{LANDED}.{c}")
    return F.when(~text.eqNullSafe(_spelled(kind, c)), F.coalesce(F.concat(F.lit(_AS_IS), text), F.lit(""))).alias(c)


def _long(kind: Entity, c: str) -> Column:
    """The landed text of a stored one."""
    stored = F.col(f"{LANDED}.{c}")
    return F.when(stored.isNull(), _spelled(kind, c)).when(stored != "", F.substring(stored, 2, 2**31 - 1)).alias(c)


def stored_rows(raw: DataFrame, entity: str, buckets: int) -> DataFrame:
    """The newest usable row of every key as the cleaned table stores it."""
    kind = ENTITIES[entity]
    kept = latest_per_key(raw, kind.key, [INGESTED]).withColumns(
        {
            ROW_KEY: row_key(kind.key),
            BUCKET: bucket_of(kind.key, buckets),
            LANDED: F.struct(*kind.columns, INGESTED),
        }
    )
    typed = kind.typed(kept, [ROW_KEY, LANDED, BUCKET])
    short = F.struct(*(_short(kind, c) for c in kind.columns), F.col(f"{LANDED}.{INGESTED}").alias(INGESTED))
    return typed.withColumn(LANDED, short)


def check_keys(spark: SparkSession, path: str, touched: list[int] | None = None) -> None:
    """Raise if a written table has an identity twice. Collisions share a bucket, so new ones are in touched buckets."""
    rows = spark.read.schema(f"{ROW_KEY} string, {BUCKET} int").parquet(path)
    if touched is not None:
        rows = rows.where(F.col(BUCKET).isin(touched))
    with passing_shuffles(spark):
        # equal identities have equal numbers: where there are as many numbers as rows, no identity is looked at as text
        if rows.select(F.xxhash64(ROW_KEY)).distinct().count() == rows.count():
            return
        twice = duplicate_keys(rows, [BUCKET, ROW_KEY]).head(1)
    if twice:
        raise KeyCollision(f"{path}: {twice[0][ROW_KEY]} stands for more than one row")


def rebuild(bronze: DataFrame, path: str, entity: str, buckets: int) -> int:
    """The whole cleaned table from all of bronze; returns its rows."""
    rows = overwrite(stored_rows(usable(bronze, ENTITIES[entity]), entity, buckets), path, [BUCKET])
    check_keys(bronze.sparkSession, path)
    return rows


def read_stored(spark: SparkSession, path: str, entity: str, touched: list[int]) -> DataFrame:
    """Landed text and ingestion time of the stored rows of some buckets."""
    kind = ENTITIES[entity]
    landed = text_schema(kind.columns).add(INGESTED, "timestamp")
    schema = struct(f"{SILVER[f'{entity}_cleaned']}, {LANDED} {landed.simpleString()}, {BUCKET} int")
    rows = spark.read.schema(schema).parquet(path).where(F.col(BUCKET).isin(touched))
    return rows.select(*(_long(kind, c) for c in kind.columns), f"{LANDED}.{INGESTED}")


def of_loads(spark: SparkSession, bronze: str, entity: str, names: Iterable[str]) -> DataFrame:
    """The usable rows of some loads of a bronze table; the other loads are pruned as partitions."""
    return usable(read_bronze(spark, bronze, entity, sorted(names)), ENTITIES[entity])


def touched_buckets(rows: DataFrame, entity: str, buckets: int) -> list[int]:
    """The buckets that the keys of some rows fall into: at most as many numbers as there are buckets."""
    found = rows.select(bucket_of(ENTITIES[entity].key, buckets).alias(BUCKET)).distinct()
    return sorted(row[BUCKET] for row in found.collect())


def rounds(spark: SparkSession, path: str, buckets: int, touched: list[int]) -> list[list[int]]:
    """The touched buckets in parts of about ``ROUND`` stored bytes, but of no fewer buckets than tasks run at once."""
    share = length_of(spark, path) * len(touched) / buckets
    most = max(1, len(touched) // spark.sparkContext.defaultParallelism)
    parts = min(most, math.ceil(share / ROUND) or 1)
    return [touched[i::parts] for i in range(parts)]


def merge(new: DataFrame, path: str, entity: str, buckets: int, touched: list[int]) -> int:
    """Take new usable rows into the cleaned table; returns the rows that it has then.

    Deduplicating the survivors of all earlier rows with the new rows keeps the same row of each key as
    deduplicating everything, since the order of a key's rows is total. A key is in one bucket, so large tables are
    merged some buckets at a time: the shuffled rows and the replaced files of a round go before the next one.
    """
    spark, key = new.sparkSession, ENTITIES[entity].key
    if touched:
        parts = rounds(spark, path, buckets, touched)
        for part in parts:
            came = new if len(parts) == 1 else new.where(bucket_of(key, buckets).isin(part))
            both = read_stored(spark, path, entity, part).unionByName(came)
            overwrite(stored_rows(both, entity, buckets), path, [BUCKET], touched_only=True)
        check_keys(spark, path, touched)
    return spark.read.schema(f"{BUCKET} int").parquet(path).count()


def built_from(spark: SparkSession, mark: str) -> tuple[set[str], int] | None:
    """Names of the loads that a table was last built from and its number of buckets, None if it was not finished."""
    if not exists(spark, mark):
        return None
    rows = spark.read.schema(f"{LOAD} string, buckets int, form int").parquet(mark).collect()
    # a mark without buckets is of a table that was not stored in buckets
    numbers = {row["buckets"] if row["form"] == FORM else None for row in rows}
    return ({row[LOAD] for row in rows}, numbers.pop()) if len(numbers) == 1 and None not in numbers else None


def mark_built(spark: SparkSession, mark: str, names: set[str], buckets: int) -> None:
    overwrite(spark.createDataFrame([(n, buckets, FORM) for n in sorted(names)], f"{LOAD} string, buckets int, form int"), mark)


def unmark(spark: SparkSession, mark: str) -> None:
    """A table is unmarked while it changes: if the run dies meanwhile, the next one builds the table anew."""
    remove(spark, mark)
