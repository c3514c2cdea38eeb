"""Incremental loading (T-01 and T-02)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodledger.schemas import CLAIM_COLUMNS, CLAIM_KEY, text_schema
from floodledger.sources.landing import DIALECT, read_bronze
from floodledger.streaming.incremental import compact, load_new_files, read_current, upsert_new_rows
from harness import bindings
from harness.catalog.reading import PER_STATE, per_state
from harness.registry import query
from harness.workspace import Workspace

SHARES = 3


def _share(ws: Workspace, share: int):
    seq = F.col(bindings.INGEST_SEQ)
    return bindings.landed_claims(ws.spark, ws.sf_dir).where(seq % SHARES == share)


def _add_files(ws: Workspace, path: str, share: int) -> None:
    _share(ws, share).select(*CLAIM_COLUMNS).write.mode("append").option("header", True).option(
        "ignoreLeadingWhiteSpace", False
    ).options(**DIALECT).option("ignoreTrailingWhiteSpace", False).csv(path)


@query("t01_incremental_files", "landed_claims", PER_STATE)
def t01(ws):
    """Three deliveries, one run after each and one run without anything new: each file once."""
    base = ws.scratch("stream")
    source, table, checkpoint = f"{base}/in", f"{base}/table", f"{base}/checkpoint"
    for share in range(SHARES):
        _add_files(ws, source, share)
        load_new_files(ws.spark, source, table, checkpoint, "claims")
    load_new_files(ws.spark, source, table, checkpoint, "claims")
    return per_state(read_bronze(ws.spark, table, "claims"))


_KEY = ", ".join(CLAIM_KEY)
_UPSERT = (
    f"SELECT state, count(*) AS n, CAST(sum(ingest_seq) AS BIGINT) AS newest, CAST(sum(CAST(totalBuildingInsuranceCoverage AS DECIMAL(18,2))) AS DOUBLE) AS coverage"
    f" FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY ingest_seq DESC, "
    + ", ".join(f"{c} ASC NULLS FIRST" for c in CLAIM_COLUMNS if c not in CLAIM_KEY)
    + ") AS r FROM landed_claims) WHERE r = 1 GROUP BY state"
)


def _upserted(ws: Workspace):
    """Deliveries arrive newest first, so later batches hold older duplicates."""
    base = ws.scratch("upsert")
    source, store, checkpoint = f"{base}/in", f"{base}/store", f"{base}/checkpoint"
    schema = text_schema(CLAIM_COLUMNS).add(bindings.INGEST_SEQ, T.LongType())
    for share in reversed(range(SHARES)):
        _share(ws, share).write.mode("append").parquet(source)
        stream = ws.spark.readStream.schema(schema).parquet(source)
        upsert_new_rows(stream, store, checkpoint, CLAIM_KEY, [bindings.INGEST_SEQ])
    return base, store


def _state(current):
    return current.groupBy("state").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(bindings.INGEST_SEQ).alias("newest"),
        F.sum(F.col("totalBuildingInsuranceCoverage").cast("decimal(18,2)")).alias("coverage"),
    )


@query("t02_latest_per_key_upsert", "landed_claims", _UPSERT)
def t02(ws):
    _, store = _upserted(ws)
    return _state(read_current(ws.spark, store, CLAIM_KEY, [bindings.INGEST_SEQ]))


@query("t02_compacted_store", "landed_claims", _UPSERT)
def t02_compacted(ws):
    base, store = _upserted(ws)
    compact(ws.spark, store, f"{base}/compacted", CLAIM_KEY, [bindings.INGEST_SEQ])
    return _state(read_current(ws.spark, f"{base}/compacted", CLAIM_KEY, [bindings.INGEST_SEQ]))
