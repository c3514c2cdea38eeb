"""Incremental loading: each landed file once, newest row per key."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from floodledger.operators.dedup import latest_per_key
from floodledger.sources.landing import FILE, MAX_BAD_ROWS, as_path, first_lines, land_lines


def load_new_files(
    spark: SparkSession,
    source: str,
    table: str,
    checkpoint: str,
    entity: str,
    files_per_batch: int = 1000,
    limit: int = MAX_BAD_ROWS,
    kind: str = "csv",
) -> StreamingQuery:
    """Add every file not loaded before to the bronze table, then stop.

    The stream is one of files, not of their rows: a batch lands its files as a batch load does, by
    the header of each file, from a folder beside the table. It is a load of its own named after the
    checkpoint and the batch, and replaced as a whole when it is written again, so a run that died half-way neither repeats
    nor loses rows when it is started again. Too many malformed lines in a file fail the batch
    before the table changes.
    """
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        files = [as_path(row[FILE]) for row in batch.select(FILE).collect()]
        lines = first_lines(spark, files) if files else {}
        if lines:
            land_lines(spark, lines, table, entity, f"{name}-{batch_id}", limit, kind)

    # the contents are never asked for
    whole = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.readStream.format("binaryFile").schema(whole).option("maxFilesPerTrigger", files_per_batch)
    stream = reader.load(source).select(F.col("_metadata.file_path").alias(FILE))
    query = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def upsert_new_rows(
    stream: DataFrame,
    store: str,
    checkpoint: str,
    keys: Sequence[str],
    newest_first: Sequence[str],
) -> StreamingQuery:
    """Take in new batches so that ``read_current`` shows the newest row of every key.

    A batch is reduced to one row per key and written to a folder named after the batch. Writing
    the same batch again replaces its folder, so a restart changes nothing. Older batches are not
    rewritten: the work follows the batch, not the table or its largest state.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        latest_per_key(batch, keys, newest_first).write.mode("overwrite").parquet(
            f"{store}/batch={batch_id}"
        )

    query = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_current(
    spark: SparkSession, store: str, keys: Sequence[str], newest_first: Sequence[str]
) -> DataFrame:
    """The newest row of every key over all batches.

    The order column decides, not the arrival: a late batch with an older row changes nothing.
    """
    return latest_per_key(spark.read.parquet(store).drop("batch"), keys, newest_first)


def compact(
    spark: SparkSession, store: str, target: str, keys: Sequence[str], newest_first: Sequence[str]
) -> None:
    """Write the current rows as the first batch of a new store.

    The stream goes on with the new store and the same checkpoint; the old store stays as it is.
    """
    read_current(spark, store, keys, newest_first).write.mode("overwrite").parquet(
        f"{target}/batch=-1"
    )
