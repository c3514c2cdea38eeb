"""Cut points, shared by all executors, and joins against id lists of a checked size."""

from __future__ import annotations

import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodledger.session import work_folder

#: Ids up to this number are sent to every executor (24 MB at most); more are joined by shuffling.
SENT_IDS = 1_000_000


def cut(df: DataFrame, name: str = "part") -> DataFrame:
    """Write a table to the shared folder and read it: ends lineage, survives lost executors."""
    path = work_folder(df.sparkSession, f"{name}-{uuid.uuid4().hex[:8]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sent(ids: DataFrame) -> DataFrame:
    """A written list of ids, for a join: sent to every executor if few enough."""
    return F.broadcast(ids) if ids.count() <= SENT_IDS else ids


def shared(spark: SparkSession, thing):
    """Sends an object to every executor by value, its class included; ``taken`` gives it back in a task.

    A plain broadcast names the class, which workers without a copy of this package cannot find.
    """
    return spark.sparkContext.broadcast(cloudpickle.dumps(thing))


def taken(sent):
    return cloudpickle.loads(sent.value)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def kept(df: DataFrame, gone: DataFrame, again: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` is not in ``gone``, one for each key in ``again``.

    Both lists hold distinct keys and are written. A row without key stays.
    """
    lists = [sent(gone), sent(again)]
    rest = df.join(lists[0], key, "left_anti")
    once = rest.join(lists[1], key, "left_anti")
    twice = rest.join(lists[1], key, "left_semi").dropDuplicates([key])
    return once.unionByName(twice) if again.head(1) else rest
