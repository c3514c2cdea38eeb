"""The tables of a layer, passed around together."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodledger.schemas import BUCKET, GOLD, SILVER, STORED, struct


@dataclass(frozen=True)
class Silver:
    claims_cleaned: DataFrame
    policies_cleaned: DataFrame
    ref_state_info: DataFrame
    ref_flood_zone_info: DataFrame


@dataclass(frozen=True)
class Star:
    dim_date: DataFrame
    dim_location: DataFrame
    dim_flood_zone: DataFrame
    dim_building_type: DataFrame
    dim_occupancy: DataFrame
    fact_claims: DataFrame
    fact_policies: DataFrame


def read_layer(spark: SparkSession, path: str, kind: type, only: set[str] | None = None):
    """Read the tables of a layer below ``path`` with their fixed schemas.

    Cleaned tables have the identity and the bucket of a row as further columns.
    """
    names = [f.name for f in fields(kind) if only is None or f.name in only]
    return kind(**{n: read_table(spark, path, n) for n in names})


def read_table(spark: SparkSession, path: str, name: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """A table of a layer, or some of the buckets of one that is stored in buckets."""
    if name in SILVER:
        ddl = SILVER[name] + (f", {STORED}" if name.endswith("_cleaned") else "")
        rows = spark.read.schema(struct(ddl)).parquet(f"{path}/{name}")
        return rows if buckets is None else rows.where(F.col(BUCKET).isin(list(buckets)))
    if not name.startswith("fact_"):
        return spark.read.schema(struct(GOLD[name])).parquet(f"{path}/{name}")
    rows = spark.read.schema(struct(f"{GOLD[name]}, {BUCKET} int")).parquet(f"{path}/{name}")
    return (rows if buckets is None else rows.where(F.col(BUCKET).isin(list(buckets)))).drop(BUCKET)
