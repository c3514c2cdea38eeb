"""Writing tables and reporting what was written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from floodledger.operators.shares import count_by_with_total
from floodledger.session import STORAGE, passing_shuffles


def overwrite(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), touched_only: bool = False
) -> int:
    """Replace a Parquet table, return the rows written.

    The count is observed while writing, without a second pass. ``touched_only`` replaces just the
    partitions that occur in ``df``.
    """
    return _write(df, path, "overwrite", partition_by, touched_only)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Add to a Parquet table, return the rows written."""
    return _write(df, path, "append", partition_by)


def _write(
    df: DataFrame, path: str, mode: str, partition_by: Sequence[str], touched_only: bool = False
) -> int:
    seen = Observation("load")
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows_written")).write.mode(mode).options(**STORAGE)
    if partition_by:
        overwrite_mode = "dynamic" if touched_only else "static"
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", overwrite_mode)
    with passing_shuffles(df.sparkSession):
        writer.parquet(path)
    return seen.get["rows_written"]


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _files(spark, path)
    return files.exists(place)


def length_of(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a folder."""
    files, place = _files(spark, path)
    return files.getContentSummary(place).getLength()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    files, place = _files(spark, path)
    files.delete(place, True)


def switch(spark: SparkSession, staged: str, path: str) -> None:
    """Put a finished folder in the place of another, which goes.

    The old folder is moved aside first and deleted last; if the new one cannot be moved the old one goes back.
    """
    (_, new), (files, old), (_, aside) = _files(spark, staged), _files(spark, path), _files(spark, f"{path}_aside")
    files.mkdirs(old.getParent())
    if files.exists(old):
        files.delete(aside, True)
        if not files.rename(old, aside):
            raise OSError(f"{path} could not be moved aside")
    try:
        moved = files.rename(new, old)
    except Exception:
        moved = False
    if not moved:
        if files.exists(aside) and not files.exists(old):
            files.rename(aside, old)
        raise OSError(f"{staged} could not be moved to {path}")
    files.delete(aside, True)


def write_csv_by_state(df: DataFrame, path: str, state_column: str, compression: str = "none") -> None:
    """One CSV folder per state, with header.

    A state is a folder of part files, not one file: a single file would send a whole state
    through one task. The state stays a column inside the files too. ``compression`` is one that
    Spark's readers take from the name of a file, like ``gzip``; such a file is read by one task.
    """
    (
        df.withColumn("_state", F.col(state_column))
        .write.mode("overwrite")
        .partitionBy("_state")
        .option("compression", compression)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def load_summary(df: DataFrame, state_column: str) -> DataFrame:
    """Rows per state and a total row."""
    return count_by_with_total(df, state_column)


def column_listing(df: DataFrame) -> DataFrame:
    """Columns in order with type and filled rows."""
    names = F.create_map(
        *(
            part
            for i, f in enumerate(df.schema, start=1)
            for part in (F.lit(f.name), F.struct(F.lit(i).alias("position"), F.lit(f.dataType.simpleString()).alias("type")))
        )
    )
    filled = df.agg(*(F.count(F.col(c)).alias(c) for c in df.columns))
    return filled.unpivot([], df.columns, "column", "filled").select(
        names[F.col("column")]["position"].alias("position"),
        "column",
        names[F.col("column")]["type"].alias("type"),
        "filled",
    )
