"""What a query builds before it reads."""

from pathlib import Path

import pytest
from conftest import bronze
from pyspark.sql import functions as F

from harness import bindings
from harness.workspace import Workspace

ROWS = {"claims": [{}, {"state": "FL", "at": 5}], "policies": [{}, {"propertyState": "FL"}, {"policyEffectiveDate": "bad"}]}


@pytest.mark.parametrize("entity, other", [("claims", "policies"), ("policies", "claims")])
def test_the_rows_of_one_entity_are_cleaned_without_the_other(spark, monkeypatch, entity, other):
    built = []
    monkeypatch.setattr(bindings, "bronze", lambda _, __, e: built.append(e) or bronze(spark, e, ROWS[e]))
    monkeypatch.setattr(bindings, "state_reference", lambda *_: spark.createDataFrame([("TX", "Texas", 6)], "state_abbrev string, state_name string, fema_region int"))
    ws = Workspace(spark, "")
    first = getattr(ws, entity)
    assert first.count() == 2 and built == [entity]
    files = set(first.inputFiles())
    # the layer takes the rows that are there and adds those of the other entity
    assert getattr(ws.silver, f"{entity}_cleaned").count() == getattr(ws.silver, f"{other}_cleaned").count() == 2
    assert built == [entity, other] and set(getattr(ws, entity).inputFiles()) == files == set(getattr(ws.silver, f"{entity}_cleaned").inputFiles())


@pytest.mark.parametrize("entity", ["claims", "policies"])
def test_the_loads_of_one_entity_are_merged_without_the_other(spark, monkeypatch, entity):
    built = []
    monkeypatch.setattr(bindings, "bronze", lambda _, __, e: built.append(e) or bronze(spark, e, ROWS[e]))
    monkeypatch.setattr(bindings, "state_reference", lambda *_: spark.createDataFrame([("TX", "Texas", 6)], "state_abbrev string, state_name string, fema_region int"))
    ws = Workspace(spark, "")
    typed = lambda df: sorted(map(repr, df.drop("landed", "row_key", "bucket").collect()))
    alone = typed(ws.merged_cleaned(entity))
    assert built == [entity] and "merged" not in vars(ws)
    assert alone == typed(getattr(ws, entity)) == typed(getattr(ws.merged.silver, f"{entity}_cleaned"))
    assert set(ws.merged_cleaned(entity).inputFiles()) == set(getattr(ws.merged.silver, f"{entity}_cleaned").inputFiles())


def test_the_bronze_tables_are_written_at_the_same_time(spark, monkeypatch):
    """Neither write waits for the other: each is held up until the other one has begun."""
    import threading

    from harness import workspace as module

    both, write = threading.Barrier(2), module.overwrite
    monkeypatch.setattr(bindings, "bronze", lambda _, __, e: bronze(spark, e, ROWS[e]))
    monkeypatch.setattr(bindings, "state_reference", lambda *_: spark.createDataFrame([("TX", "Texas", 6)], "state_abbrev string, state_name string, fema_region int"))
    monkeypatch.setattr(module, "overwrite", lambda df, path: both.wait(60) is not None and write(df, path))
    ws = Workspace(spark, "")
    assert ws.merged.rows["claims_cleaned"] == ws.merged.rows["policies_cleaned"] == 2


def test_a_session_made_elsewhere_gets_what_is_not_set_in_it(spark):
    from floodledger.session import NEEDED, SETTINGS, tuned

    other = spark.newSession()
    for key in NEEDED:
        other.conf.unset(key)
    other.conf.set(NEEDED[1], "7m")
    tuned(other)
    assert other.conf.get(NEEDED[0]) == SETTINGS[NEEDED[0]] and other.conf.get(NEEDED[1]) == "7m"


def test_no_split_holds_more_rows_than_a_row_group(spark, tmp_path):
    """Row groups of a written table end at a size, so that splits can be cut and tasks need not spill what they sort."""
    from floodledger.session import ROW_GROUP
    from floodledger.sources import sinks

    rows = spark.range(1_500_000, numPartitions=1).selectExpr("id", "sha2(cast(id as string), 256) AS text")
    sinks.overwrite(rows, f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    assert len(table.inputFiles()) == 1
    import pyarrow.parquet as pq

    found = pq.ParquetFile(next((tmp_path / "t").glob("*.parquet"))).metadata
    assert found.num_row_groups > 1 and max(sum(found.row_group(i).column(c).total_compressed_size for c in range(2)) for i in range(found.num_row_groups)) < 1.3 * ROW_GROUP


def test_shuffle_files_of_a_write_go_when_it_ends(spark, tmp_path):
    """A table is written from a shuffle once; what a caller runs twice keeps its files, and the setting is as it was."""
    import threading
    import time

    from floodledger.session import _PASSING, passing_shuffles
    from floodledger.sources import sinks

    local = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    held = lambda: {p.name for p in local.rglob("shuffle_*.data")}

    def gone(before):
        for _ in range(50):
            if held() <= before:
                return True
            time.sleep(0.1)
        return False

    before = held()
    rows = spark.range(20_000, numPartitions=4).withColumn("k", F.col("id") % 1000)
    grouped = rows.groupBy("k").count()
    assert sinks.overwrite(grouped, f"{tmp_path}/t") == 1000 and gone(before)
    assert spark.conf.get(_PASSING) == "false"
    both = threading.Barrier(2)

    def write(i):
        with passing_shuffles(spark):
            both.wait(30)
            assert spark.conf.get(_PASSING) == "true"
            both.wait(30)
        sinks.overwrite(grouped, f"{tmp_path}/t{i}")

    threads = [threading.Thread(target=write, args=(i,)) for i in range(2)]
    [t.start() for t in threads]
    [t.join(60) for t in threads]
    assert spark.conf.get(_PASSING) == "false" and gone(before)
    kept = rows.groupBy("k").agg(F.max("id").alias("m"))
    assert len(kept.collect()) == len(kept.collect()) == 1000 and held() - before
