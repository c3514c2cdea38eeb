"""Reading landed CSV and JSON files as all-string tables, and preparing them for bronze."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodledger.functions.cleaning import blank_to_null, normalise_missing
from floodledger.schemas import (
    ENDPOINT,
    ENVELOPE,
    LINEAGE,
    SOURCE_COLUMNS,
    STATE_CANDIDATES,
    TARGET_STATES,
    bronze_schema,
    struct,
    text_schema,
)
from floodledger.sources.sinks import exists, overwrite, remove, switch

BAD = "_bad_row"
FILE = "_file"
REJECTED = "rejected"
#: Malformed rows of a file that a load puts up with, unless the caller says otherwise.
MAX_BAD_ROWS = 100
LOAD = "load"
#: As the size of a split: every file is one task of its own.
WHOLE_FILE = 1 << 40
#: Distinct keys up to this number are sent to every task instead of shuffling the rows to them.
SENT_KEYS = 10_000
#: Quotes inside quoted values are doubled in the landed files; Spark's own default is a backslash.
DIALECT = {"quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """CSV files with a header in the given column order, every column a string.

    A file whose header differs is an error rather than misplaced values.
    """
    return (
        spark.read.schema(text_schema(list(columns)))
        .options(**DIALECT)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )


def read_csv_by_header(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """CSV files whose common header names the columns, every column a string."""
    return spark.read.options(**DIALECT).option("header", True).option("enforceSchema", False).csv(path)


def list_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The files below a path with length and time of change, as ``_file, length, changed``; none is opened."""
    found = spark.read.format("binaryFile").load(path)
    return found.select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("changed"),
    )


def unseen_files(spark: SparkSession, path: str | Sequence[str], landed: str, ledger: str, loads: Iterable[str]) -> DataFrame:
    """The files of a path that no load of a landed table has taken in as they are now.

    The ledger says what length and time of change a file had when it was landed. Of loads that it does not
    know (those of streams, or of a run that died before it wrote there) the rows name the files.
    """
    listed, loads = list_files(spark, path), set(loads)
    noted = set()
    if exists(spark, ledger):
        known = spark.read.schema(f"{FILE} string, length bigint, changed timestamp, {LOAD} string").parquet(ledger)
        known = known.where(F.col(LOAD).isin(list(loads)))
        noted = {row[LOAD] for row in known.select(LOAD).distinct().collect()}
        listed = listed.join(known.drop(LOAD), [FILE, "length", "changed"], "left_anti")
    if loads - noted:
        rows = spark.read.schema(_stored(text_schema([FILE]))).parquet(landed)
        rows = rows.where(F.col(LOAD).isin(list(loads - noted)))
        listed = listed.join(rows.select(FILE).distinct(), FILE, "left_anti")
    return listed


def first_lines(spark: SparkSession, path: str | Sequence[str]) -> dict[str, str]:
    """File and first line of all files.

    One job with a task per file, which stops after the line. Files without text are left out. The
    driver holds as much as it does for the list of files of any scan.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # of one line each
            if batch.num_rows and (batch.column(0)[0].as_py() or "").strip():
                yield batch
                return

    own = spark.newSession()
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(key, str(WHOLE_FILE))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    text = own.read.text(path).select("value", F.col("_metadata.file_path").alias(FILE))
    return {row[FILE]: row["value"] for row in text.mapInArrow(first, text.schema).collect()}


def as_path(file: str) -> str:
    """A file as Spark reports it, as a path to read: decoded, and without wildcards."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file))


def by_header(lines: dict[str, str]) -> dict[tuple[str, ...], list[str]]:
    """The files of every header."""
    files: dict[tuple[str, ...], list[str]] = {}
    for file, line in sorted(lines.items()):
        files.setdefault(tuple(next(csv.reader([line]))), []).append(as_path(file))
    return files


def read_csv_aligned(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """CSV files whose headers differ in order or content, aligned by column name.

    Files with the same header are read together: the plan has one scan per distinct header.
    """
    files = by_header(first_lines(spark, path))
    if not files:
        raise FileNotFoundError(f"no CSV files with a header in {path}")
    parts = [read_csv_by_header(spark, same) for same in files.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def marked_schema(columns: Sequence[str]) -> T.StructType:
    return text_schema([*columns, BAD])


# Column pruning is off: a pruned parser does not notice a wrong column count.
MARKED_OPTIONS = DIALECT | {
    "enforceSchema": False,
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": BAD,
    "columnPruning": False,
}


def mark_bad_rows(rows: DataFrame) -> DataFrame:
    """Put the malformed text and the file beside the source columns of a read with the options above."""
    columns = [c for c in rows.columns if c != BAD]
    # Spark refuses a query on text files that needs nothing but the malformed text. The second
    # part is never filled; it makes every query on the mark look at a parsed column as well.
    first = F.col(columns[0])
    mark = F.coalesce(F.col(BAD), F.when(F.length(first) < 0, first))
    return rows.select(*columns, mark.alias(BAD), F.col("_metadata.file_path").alias(FILE))


def read_csv_marked(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], header: bool = True
) -> DataFrame:
    """Like ``read_csv`` with two more columns: the text of a malformed line, and the file."""
    reader = spark.read.schema(marked_schema(columns)).options(**MARKED_OPTIONS)
    return mark_bad_rows(reader.option("header", header).csv(path))


def _names(header: Sequence[str], columns: Sequence[str]) -> list[str]:
    """Names for the columns of a header: wanted ones as spelt here, no empty, repeated or reserved ones."""
    wanted = {c.lower(): c for c in columns}
    used = {BAD, FILE, LOAD, REJECTED}
    names = []
    for i, text in enumerate(header):
        name = wanted.get(text.strip().lower(), text.strip())
        if not name or name.lower() in used:
            name = f"_column_{i}"
        used.add(name.lower())
        names.append(name)
    return names


def read_csv_marked_aligned(
    spark: SparkSession, files: dict[tuple[str, ...], list[str]], columns: Sequence[str]
) -> DataFrame:
    """Like ``read_csv_marked`` for files with various headers, aligned by name.

    Columns that a file lacks are NULL, further ones are kept. A file with none of the columns, one
    without a header for instance, is an error.
    """
    parts = []
    for header, same in files.items():
        names = _names(header, columns)
        if not set(names) & set(columns):
            raise ValueError(f"none of the expected columns in the header of {same[0]}")
        # the header has been looked at already, and its names may have been mended
        options = MARKED_OPTIONS | {"enforceSchema": True, "header": True}
        rows = mark_bad_rows(spark.read.schema(marked_schema(names)).options(**options).csv(same))
        lacking = {c: F.lit(None).cast("string") for c in columns if c not in names}
        parts.append(rows.withColumns(lacking))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def land_lines(
    spark: SparkSession, lines: dict[str, str], path: str, entity: str, name: str, limit: int, kind: str = "csv", whole: bool = False
) -> tuple[int, int]:
    """Files, known by their first lines, as a load of the table at ``path``; returns good and malformed rows.

    The load is written beside the table and takes its place after the check of malformed rows: that of the load
    of the same name, or with ``whole`` that of the table.
    """
    columns = SOURCE_COLUMNS[entity]
    if kind == "csv":
        marked = read_csv_marked_aligned(spark, by_header(lines), columns)
    else:
        marked = read_envelope_marked(spark, [as_path(f) for f in lines], ENVELOPE[entity], columns, kind == "json")
    staged, load = f"{path}_staged_{name}", f"{LOAD}={name}"
    try:
        total = overwrite(to_landed_table(marked, entity), f"{staged}/{load}", [REJECTED])
        per_file = bad_row_counts(read_rejected(spark, staged, entity)).select(FILE, "bad_rows").persist()
        check_bad_rows(per_file, limit)
        bad = per_file.agg(F.coalesce(F.sum("bad_rows"), F.lit(0))).first()[0]
        per_file.unpersist()
        switch(spark, staged if whole else f"{staged}/{load}", path if whole else f"{path}/{load}")
    finally:
        remove(spark, staged)
    return total - bad, bad


def good_rows(marked: DataFrame) -> DataFrame:
    return marked.where(F.col(BAD).isNull()).drop(BAD, FILE)


def bad_rows(marked: DataFrame) -> DataFrame:
    """Malformed lines with their file, for a quarantine table."""
    return marked.where(F.col(BAD).isNotNull()).select(FILE, F.col(BAD).alias("line"))


def bad_row_counts(marked: DataFrame) -> DataFrame:
    """Rows and malformed rows per file."""
    return marked.groupBy(FILE).agg(
        F.count(F.lit(1)).alias("rows_read"), F.count_if(F.col(BAD).isNotNull()).alias("bad_rows")
    )


class TooManyBadRows(ValueError):
    """A file has more malformed rows than tolerated."""


def check_bad_rows(counts: DataFrame, limit: int = MAX_BAD_ROWS) -> None:
    """Raise if any file of ``bad_row_counts`` is over the limit."""
    over = counts.where(F.col("bad_rows") > limit).orderBy(F.desc("bad_rows")).limit(20).collect()
    if over:
        worst = ", ".join(f"{row[FILE]}: {row['bad_rows']}" for row in over)
        raise TooManyBadRows(f"more than {limit} malformed rows in {worst}")


def read_envelope(
    spark: SparkSession,
    path: str | Sequence[str],
    entity: str,
    columns: Sequence[str],
    multi_line: bool = True,
) -> DataFrame:
    """Landed JSON pages ``{entity: [record, ...]}``, one row per record.

    A page without the entity has no rows. By default a file is one page; with ``multi_line=False``
    a line is one page and large files are split between tasks.
    """
    marked = read_envelope_marked(spark, path, entity, columns, multi_line)
    return marked.where(F.col(BAD).isNull()).drop(BAD, FILE)


def read_envelope_marked(
    spark: SparkSession,
    path: str | Sequence[str],
    entity: str,
    columns: Sequence[str],
    multi_line: bool = True,
) -> DataFrame:
    """Like ``read_envelope`` with two more columns: the text of a page that is no JSON, and the file."""
    record = text_schema(list(columns))
    page = T.StructType([T.StructField(entity, T.ArrayType(record)), T.StructField(BAD, T.StringType())])
    reader = spark.read.schema(page).option("columnNameOfCorruptRecord", BAD)
    pages = reader.option("multiLine", multi_line).json(path)
    # a page that is no JSON is one row without a record; one without the entity has no rows
    records = F.when(F.col(BAD).isNotNull(), F.array(F.lit(None).cast(record))).otherwise(F.col(entity))
    exploded = pages.select(F.explode(records).alias("_record"), BAD, F.col("_metadata.file_path").alias(FILE))
    return exploded.select("_record.*", BAD, FILE)


def select_source(
    df: DataFrame,
    columns: Sequence[str],
    state_column: str,
    states: Iterable[str] = TARGET_STATES,
) -> DataFrame:
    """The wanted states and columns; both reach a columnar scan."""
    return df.where(F.col(state_column).isin(list(states))).select(*columns)


def state_of(columns: Sequence[str], candidates: Sequence[str] = STATE_CANDIDATES) -> Column:
    """The first candidate column that exists, NULL if none does."""
    present = [c for c in candidates if c in columns]
    return F.col(present[0]) if present else F.lit(None).cast("string")


def with_lineage(
    df: DataFrame, endpoint: str, batch_id: int = 1, ingested: Column | None = None
) -> DataFrame:
    """Add the lineage columns; an existing ``source_state`` is kept where it is filled."""
    state = state_of(df.columns)
    if "source_state" in df.columns:
        state = F.coalesce(F.col("source_state"), state)
    lineage = {
        "batch_id": F.lit(batch_id),
        "ingestion_timestamp": F.current_timestamp() if ingested is None else ingested,
        "source_state": state,
        "source_api_endpoint": F.lit(endpoint),
    }
    return df.withColumns({f.name: lineage[f.name].cast(f.dataType) for f in struct(LINEAGE)})


def to_bronze(
    df: DataFrame, entity: str, batch_id: int = 1, ingested: Column | None = None
) -> DataFrame:
    """Missing texts to NULL, then lineage."""
    return with_lineage(normalise_missing(df), ENDPOINT[entity], batch_id, ingested)


def to_landed_table(marked: DataFrame, entity: str, batch_id: int = 1) -> DataFrame:
    """Bronze columns plus the partition column ``rejected``: 1 for malformed lines.

    Only source columns are normalised: the text of a malformed line stays as it is, also where it
    looks like a missing value.
    """
    sources = [c for c in marked.columns if c not in (BAD, FILE)]
    clean = marked.withColumns({c: blank_to_null(F.col(c)) for c in sources})
    landed = with_lineage(clean, ENDPOINT[entity], batch_id)
    return landed.withColumn(REJECTED, F.col(BAD).isNotNull().cast("int"))


def _stored(schema: T.StructType) -> T.StructType:
    """With the partition columns of a landed table: which load, and whether malformed."""
    return schema.add(LOAD, T.StringType()).add(REJECTED, T.IntegerType())


def read_bronze(spark: SparkSession, path: str, entity: str, loads: Sequence[str] | None = None) -> DataFrame:
    """The well-formed rows of a landed table, or of some of its loads; the others are pruned as partitions."""
    rows = spark.read.schema(_stored(bronze_schema(entity))).parquet(path)
    if loads is not None:
        rows = rows.where(F.col(LOAD).isin(list(loads)))
    return rows.where(F.col(REJECTED) == 0).drop(LOAD, REJECTED)


def read_rejected(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """The malformed lines of a landed table with their file, and what could be read of them."""
    schema = _stored(text_schema([*SOURCE_COLUMNS[entity], BAD, FILE]))
    rows = spark.read.schema(schema).parquet(path)
    return rows.where(F.col(REJECTED) == 1).drop(LOAD, REJECTED)


def not_loaded(incoming: DataFrame, loaded: DataFrame, key: str = "source_state") -> DataFrame:
    """Incoming rows whose state has no rows in the loaded table yet."""
    known = loaded.select(key).distinct()
    # a list of states is short; its size is looked at all the same before it is sent
    few = len(known.head(SENT_KEYS + 1)) <= SENT_KEYS
    return incoming.join(F.broadcast(known) if few else known, key, "left_anti")
