"""Registration of a Spark query together with its comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harness.sql import with_ctes
from harness.workspace import Workspace, workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, so that both engines hand over the same types."""
    casts = {}
    for f in df.schema:
        if isinstance(f.dataType, T.DecimalType):
            casts[f.name] = F.col(f.name).cast("double")
        elif isinstance(f.dataType, T.DateType):
            casts[f.name] = F.col(f.name).cast("string")
    return df.withColumns(casts) if casts else df


def query(name: str, ctes: str = "", sql: str | None = None):
    """Register ``fn(workspace) -> DataFrame``; without SQL only the rows are checked."""

    def register(fn: Callable[[Workspace], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(workspace(spark, sf_dir)))

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_ctes(ctes, sql)
        return fn

    return register
