"""Malformed lines taken up again: mended, landed as a load of their own, each line once.

A ledger names for every replay the lines that it replaced. The lines stay where they were landed;
a line in the ledger of a load that exists counts as replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floodledger.plans.warehouse import NEW, bronze_path, loads
from floodledger.schemas import SOURCE_COLUMNS
from floodledger.session import written
from floodledger.sources.landing import BAD, DIALECT, FILE, LOAD, REJECTED, marked_schema, to_landed_table
from floodledger.sources.sinks import exists, overwrite, remove, switch

#: What tells a malformed line: the load that brought it, its file, its text.
LINE = ("of_load", FILE, BAD)


def ledger_path(out: str, entity: str) -> str:
    return f"{out}/replayed/{entity}"


def replaced_lines(spark: SparkSession, out: str, entity: str) -> DataFrame:
    """The malformed lines that replays have replaced, with the replay's load: those of loads that are there."""
    schema = ", ".join(f"{c} string" for c in (*LINE, LOAD))
    ledger = ledger_path(out, entity)
    if not exists(spark, ledger):
        return spark.createDataFrame([], schema)
    known = loads(spark, out, entity)
    return spark.read.schema(schema).parquet(ledger).where(F.col(LOAD).isin(list(known)))


def rejected_lines(spark: SparkSession, out: str, entity: str) -> DataFrame:
    """The malformed lines that wait for a replay: ``of_load, _file, _bad_row``, and ``n``, how often a file holds one."""
    rows = spark.read.schema(f"{BAD} string, {FILE} string, {LOAD} string, {REJECTED} int").parquet(bronze_path(out, entity))
    lines = rows.where(F.col(REJECTED) == 1).groupBy(F.col(LOAD).alias("of_load"), FILE, BAD).agg(F.count(F.lit(1)).alias("n"))
    return lines.join(replaced_lines(spark, out, entity).drop(LOAD), list(LINE), "left_anti")


def replay(spark: SparkSession, out: str, entity: str, mended: Column, columns: Sequence[str] | None = None) -> dict[str, int]:
    """Land the malformed lines that ``mended`` makes well-formed, and return the rows landed and those left.

    ``mended`` is the CSV line to read instead, from ``_bad_row`` (the text) and ``_file``; NULL leaves
    a line where it is, and so does text that is malformed still. ``columns`` are those of the
    line, in order. A line that a file holds several times is landed as often. The rows name no file, so a
    file that changes later is landed as before. The ledger is written first and counts once the load
    is there: a replay that dies changes nothing, and a second one finds nothing left to do. As a
    further load the rows reach the cleaned tables with the next ``run(only_new=True)``.
    """
    columns = list(columns or SOURCE_COLUMNS[entity])
    options = DIALECT | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    row = F.from_csv(mended, ", ".join(f"`{f.name}` string" for f in marked_schema(columns)), options)
    # written: the ledger and the load have to agree on what was mended
    read = written(rejected_lines(spark, out, entity).withColumns({"_line": mended, "_row": row}), "replay")
    good = read.where(F.col("_line").isNotNull() & F.col("_row").isNotNull() & F.col(f"_row.{BAD}").isNull())
    counts = read.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], good.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if counts[1]:
        path, name = bronze_path(out, entity), f"{NEW}-{uuid.uuid4().hex}"
        overwrite(good.select(*LINE), f"{ledger_path(out, entity)}/{LOAD}={name}")
        rows = good.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "n"))).select("_row.*", F.lit(None).cast("string").alias(FILE))
        lacking = {c: F.lit(None).cast("string") for c in SOURCE_COLUMNS[entity] if c not in columns}
        staged = f"{path}_staged_{name}"
        try:
            overwrite(to_landed_table(rows.withColumns(lacking), entity), staged, [REJECTED])
            switch(spark, staged, f"{path}/{LOAD}={name}")
        finally:
            remove(spark, staged)
    return {f"{entity}_replayed": counts[1], f"{entity}_rejected": counts[0] - counts[1]}
