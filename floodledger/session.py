"""Session settings and the shared work folder."""

from __future__ import annotations

import threading
import uuid
from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # recording the Python call site of every column expression slows plan building
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # larger generated methods are never compiled by the JVM and run slower than no fusion at all
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # of zstd files: a task that sorts the rows of a split four times as large spills them
    "spark.sql.files.maxPartitionBytes": "32m",
}
#: Those that a session which was made elsewhere is given as well, as they decide about time and spills.
NEEDED = ["spark.sql.codegen.hugeMethodLimit", "spark.sql.files.maxPartitionBytes"]

#: Of written tables. Keys and identities are digits in texts: half as large as with the default of Spark.
CODEC = "zstd"
#: With the lowest level: tables of ours are no larger at the default of three, and cost an eighth more to write.
CODEC_LEVEL = "1"
#: Of written tables, in compressed bytes: a row group is read by one task, however small the splits.
ROW_GROUP = 32 << 20
STORAGE = {"compression": CODEC, "parquet.compression.codec.zstd.level": CODEC_LEVEL, "parquet.block.size": ROW_GROUP}


def builder(app: str = "floodledger") -> SparkSession.Builder:
    """A builder with the settings above; master, memory and parallelism are left to the caller."""
    b = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


def tuned(spark: SparkSession) -> SparkSession:
    """The session, with the settings of ``NEEDED`` that nobody has set in it."""
    given = spark.conf.getAll
    for key in NEEDED:
        if key not in given:
            spark.conf.set(key, SETTINGS[key])
    return spark


def at_once(spark: SparkSession, steps: Mapping[str, Callable[[], object]]) -> dict[str, object]:
    """Results of a few independent steps whose jobs share the executors, so short ones do not wait for each other."""
    if not steps:
        return {}
    with ThreadPoolExecutor(len(steps)) as pool:
        started = {name: pool.submit(inheritable_thread_target(spark)(step)) for name, step in steps.items()}
        return {name: step.result() for name, step in started.items()}


#: Makes a query delete its shuffle files when it ends; else they stay until the JVM collects the query as garbage.
_PASSING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: By session: how many are inside, and the value outside.
_inside: Counter[str] = Counter()
_before: dict[str, str] = {}
_counting = threading.Lock()


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries started inside delete their shuffle files when they end: for those that nobody runs a second time.

    Results handed out are not started inside, so whoever reads one twice finds its shuffle files again.
    """
    session = spark._jsparkSession.sessionUUID()
    with _counting:
        if not _inside[session]:
            _before[session] = spark.conf.get(_PASSING)
            spark.conf.set(_PASSING, "true")
        _inside[session] += 1
    try:
        yield
    finally:
        with _counting:
            _inside[session] -= 1
            if not _inside[session]:
                spark.conf.set(_PASSING, _before.pop(session))


def work_folder(spark: SparkSession, *parts: str) -> str:
    """A new folder below the shared checkpoint folder of the session, else below the warehouse.

    Both are folders that the driver and all executors reach; a machine's own folder is never used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir", None)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return "/".join([root.rstrip("/"), "floodledger", uuid.uuid4().hex, *parts])


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows from a table in the work folder, so that they stay the same whatever executors are lost."""
    path = work_folder(df.sparkSession, name)
    with passing_shuffles(df.sparkSession):
        df.write.options(**STORAGE).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
