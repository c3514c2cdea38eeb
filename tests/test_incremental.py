import pytest
from conftest import CLAIM
from test_landing import text, write

from floodledger.plans.warehouse import bronze_path, land_csv
from floodledger.schemas import CLAIM_COLUMNS
from floodledger.sources.landing import BAD, read_bronze, read_rejected
from floodledger.streaming.incremental import compact, load_new_files, read_current, upsert_new_rows


def test_each_file_is_loaded_once(spark, tmp_path):
    source, table, checkpoint = (str(tmp_path / n) for n in ("in", "table", "checkpoint"))

    def load():
        load_new_files(spark, source, table, checkpoint, "claims")
        return sorted(r.state for r in read_bronze(spark, table, "claims").collect())

    write(tmp_path / "in", "TX.csv", [text(CLAIM, CLAIM_COLUMNS)])
    assert load() == ["TX"]
    assert load() == ["TX"]
    write(tmp_path / "in", "FL.csv", [text(CLAIM | {"state": "FL"}, CLAIM_COLUMNS), "bad,line"])
    assert load() == ["FL", "TX"]
    assert [r[BAD] for r in read_rejected(spark, table, "claims").collect()] == ["bad,line"]
    row = read_bronze(spark, table, "claims").first()
    assert row.source_state in ("FL", "TX") and row.ingestion_timestamp is not None


def test_full_load_then_stream_then_full_load(spark, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    table = bronze_path(out, "claims")
    count = lambda: read_bronze(spark, table, "claims").count()
    write(tmp_path / "full", "TX.csv", [text(CLAIM, CLAIM_COLUMNS)] * 5)
    land_csv(spark, str(tmp_path / "full"), out, "claims")
    write(tmp_path / "new", "FL.csv", [text(CLAIM | {"state": "FL"}, CLAIM_COLUMNS)] * 2)
    for _ in range(2):  # the second run is a restart without anything new
        load_new_files(spark, str(tmp_path / "new"), table, checkpoint, "claims")
        assert count() == 7
    land_csv(spark, str(tmp_path / "full"), out, "claims")
    assert count() == 5


def test_stream_refuses_a_file_of_malformed_lines(spark, tmp_path):
    write(tmp_path / "in", "a.csv", [text(CLAIM, CLAIM_COLUMNS), *["bad"] * 4])
    with pytest.raises(Exception, match="malformed"):
        load_new_files(spark, str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "checkpoint"), "claims", limit=3)
    assert not (tmp_path / "table").exists()
    load_new_files(spark, str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "checkpoint"), "claims", limit=4)
    assert read_bronze(spark, str(tmp_path / "table"), "claims").count() == 1


def test_late_batch_with_an_older_row_changes_nothing(spark, tmp_path):
    source, store, checkpoint = (str(tmp_path / n) for n in ("in", "store", "checkpoint"))
    keys, order = ["k"], ["seq"]

    def deliver(*rows):
        spark.createDataFrame(list(rows), "k string, seq int, v string").write.mode("append").parquet(source)
        stream = spark.readStream.schema("k string, seq int, v string").parquet(source)
        upsert_new_rows(stream, store, checkpoint, keys, order)
        return {r.k: r.v for r in read_current(spark, store, keys, order).collect()}

    assert deliver(("a", 5, "new"), ("a", 4, "old"), ("b", 1, "b1")) == {"a": "new", "b": "b1"}
    assert deliver(("a", 3, "late"), ("b", 2, "b2"), (None, 1, "n")) == {"a": "new", "b": "b2", None: "n"}

    compacted = str(tmp_path / "compacted")
    compact(spark, store, compacted, keys, order)
    assert spark.read.parquet(compacted).count() == 3
    stream_in = spark.createDataFrame([("a", 9, "newest")], "k string, seq int, v string")
    stream_in.write.mode("append").parquet(source)
    upsert_new_rows(spark.readStream.schema("k string, seq int, v string").parquet(source), compacted, checkpoint, keys, order)
    assert {r.k: r.v for r in read_current(spark, compacted, keys, order).collect()} == {"a": "newest", "b": "b2", None: "n"}


def test_columns_of_streamed_files_go_by_name(spark, tmp_path):
    turned = list(reversed(CLAIM_COLUMNS))
    write(tmp_path / "in", "a.csv", [text(CLAIM, turned)], turned)
    few = [c for c in CLAIM_COLUMNS if c != "countyCode"]
    write(tmp_path / "in", "b.csv", [text(CLAIM | {"state": "FL"}, few)], few)
    load_new_files(spark, str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "checkpoint"), "claims")
    rows = {r.state: r for r in read_bronze(spark, str(tmp_path / "table"), "claims").collect()}
    assert {s: r.countyCode for s, r in rows.items()} == {"TX": "48201", "FL": None}
    assert {r.dateOfLoss for r in rows.values()} == {CLAIM["dateOfLoss"]}
