import json

import pytest
from conftest import CLAIM, POLICY
from pyspark.sql import functions as F

from floodledger import run
from floodledger.plans import profile
from floodledger.plans.profile import profile_entity
from floodledger.plans.warehouse import bronze_path, land_csv, land_files
from floodledger.schemas import CLAIM_COLUMNS, ENDPOINT, ENVELOPE, POLICY_COLUMNS
from floodledger.sources import landing, sinks


def text(row, columns):
    return ",".join("" if row[c] is None else row[c] for c in columns)


def write(folder, name, lines, columns=CLAIM_COLUMNS):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([",".join(columns), *lines]) + "\n")


def test_fixed_and_header_schema_agree(spark, tmp_path):
    write(tmp_path, "TX.csv", [text(CLAIM, CLAIM_COLUMNS)])
    fixed = landing.read_csv(spark, str(tmp_path), CLAIM_COLUMNS)
    named = landing.read_csv_by_header(spark, str(tmp_path))
    assert fixed.collect() == named.collect()
    assert {t for _, t in fixed.dtypes} == {t for _, t in named.dtypes} == {"string"}


def test_other_column_order_fails_loudly_or_is_aligned(spark, tmp_path):
    write(tmp_path, "a.csv", [text(CLAIM, CLAIM_COLUMNS)])
    turned = CLAIM_COLUMNS[::-1][:-1] + ["extra"]
    write(tmp_path, "b.csv", [text(CLAIM | {"extra": "1", "state": "FL"}, turned)], turned)
    with pytest.raises(Exception, match="CSV header"):
        landing.read_csv(spark, str(tmp_path), CLAIM_COLUMNS).collect()
    aligned = landing.read_csv_aligned(spark, str(tmp_path))
    assert {(r.state, r.countyCode, r.dateOfLoss is None, r.extra) for r in aligned.collect()} == {
        ("TX", "48201", False, None), ("FL", "48201", True, "1"),
    }
    with pytest.raises(Exception):
        landing.read_csv_aligned(spark, str(tmp_path / "nothing"))


def test_bad_rows_are_quarantined_and_counted(spark, tmp_path):
    good = text(CLAIM, CLAIM_COLUMNS)
    write(tmp_path / "in", "a.csv", [good, "too,short", good + ",too,long"])
    write(tmp_path / "in", "b.csv", [good])
    marked = landing.read_csv_marked(spark, str(tmp_path / "in"), CLAIM_COLUMNS)
    assert landing.good_rows(marked).count() == 2
    assert {r.line for r in landing.bad_rows(marked).collect()} == {"too,short", good + ",too,long"}
    counts = landing.bad_row_counts(marked)
    assert {r[landing.FILE].rsplit("/", 1)[1]: (r.rows_read, r.bad_rows) for r in counts.collect()} == {"a.csv": (3, 2), "b.csv": (1, 0)}
    landing.check_bad_rows(counts, 2)
    with pytest.raises(landing.TooManyBadRows, match="a.csv: 2"):
        landing.check_bad_rows(counts, 1)


def test_landing_writes_good_and_bad_rows_in_one_pass(spark, tmp_path):
    good = text(CLAIM | {"countyCode": "nan"}, CLAIM_COLUMNS)
    write(tmp_path / "in", "a.csv", [good, "bad", good])
    out = str(tmp_path / "out")
    assert land_csv(spark, str(tmp_path / "in"), out, "claims") == {"claims_raw": 2, "claims_rejected": 1}
    row = landing.read_bronze(spark, bronze_path(out, "claims"), "claims").first()
    assert (row.countyCode, row.source_state, row.batch_id, row.source_api_endpoint) == (None, "TX", 1, ENDPOINT["claims"])
    assert [r[landing.BAD] for r in landing.read_rejected(spark, bronze_path(out, "claims"), "claims").collect()] == ["bad"]
    write(tmp_path / "in", "a.csv", [good])
    assert land_csv(spark, str(tmp_path / "in"), out, "claims") == {"claims_raw": 1, "claims_rejected": 0}
    assert landing.read_rejected(spark, bronze_path(out, "claims"), "claims").count() == 0
    with pytest.raises(landing.TooManyBadRows):
        write(tmp_path / "in", "a.csv", ["bad", "bad"])
        land_csv(spark, str(tmp_path / "in"), out, "claims", limit=1)
    # the refused load left the table as it was
    assert landing.read_bronze(spark, bronze_path(out, "claims"), "claims").count() == 1
    assert landing.read_rejected(spark, bronze_path(out, "claims"), "claims").count() == 0


def test_lines_that_look_like_missing_values_are_malformed(spark, tmp_path):
    write(tmp_path / "in", "a.csv", [text(CLAIM, CLAIM_COLUMNS), "NA", "null"])
    out = str(tmp_path / "out")
    assert land_csv(spark, str(tmp_path / "in"), out, "claims") == {"claims_raw": 1, "claims_rejected": 2}
    rejected = landing.read_rejected(spark, bronze_path(out, "claims"), "claims")
    assert {r[landing.BAD] for r in rejected.collect()} == {"NA", "null"}


def test_quotes_and_commas_inside_values(spark, tmp_path):
    (tmp_path / "q.csv").write_text('a,b\n"x ""y"", z",2\n"5"" pipe", c \n"",\n')
    expected = [('x "y", z', "2"), ('5" pipe', " c "), (None, None)]
    path = str(tmp_path / "q.csv")
    assert [tuple(r) for r in landing.read_csv(spark, path, ["a", "b"]).collect()] == expected
    assert [tuple(r) for r in landing.read_csv_by_header(spark, path).collect()] == expected
    marked = landing.read_csv_marked(spark, path, ["a", "b"])
    assert landing.bad_rows(marked).count() == 0 and landing.good_rows(marked).count() == 3
    rows = spark.createDataFrame([("TX", 'x "y", z'), ("TX", '"'), ("TX", "a,b")], "state string, v string")
    sinks.write_csv_by_state(rows, str(tmp_path / "out"), "state")
    stored = landing.read_csv(spark, str(tmp_path / "out") + "/*", ["state", "v"])
    assert sorted(r.v for r in stored.collect()) == sorted(['x "y", z', '"', "a,b"])


def test_envelope(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps({"Claims": [{"state": "TX", "other": 1}, {"state": "FL"}], "metadata": {}}, indent=1))
    (tmp_path / "2.json").write_text(json.dumps({"metadata": {}}))
    rows = landing.read_envelope(spark, str(tmp_path), "Claims", ["state", "countyCode"])
    assert sorted(tuple(r) for r in rows.collect()) == [("FL", None), ("TX", None)]


def test_lineage_fills_only_missing_states(spark):
    df = spark.createDataFrame([("TX", "given"), ("FL", None)], "propertyState string, source_state string")
    assert {r.source_state for r in landing.with_lineage(df, "e").collect()} == {"given", "FL"}
    bare = spark.createDataFrame([("x",)], "other string")
    assert landing.with_lineage(bare, "e").first().source_state is None


def test_only_new_states_are_loaded(spark):
    incoming = spark.createDataFrame([("TX",), ("TX",), ("FL",)], "source_state string")
    loaded = spark.createDataFrame([("FL",)], "source_state string")
    assert [r[0] for r in landing.not_loaded(incoming, loaded).collect()] == ["TX", "TX"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("TX", " a "), ("FL", "b")], "state string, v string")
    path = str(tmp_path / "t")
    assert sinks.overwrite(df, path) == 2 and sinks.append(df, path) == 2
    assert spark.read.parquet(path).count() == 4
    parts = str(tmp_path / "p")
    sinks.overwrite(df, parts, ["state"])
    sinks.overwrite(df.where("state = 'FL'").withColumn("v", F.lit("c")), parts, ["state"], touched_only=True)
    assert {(r.state, r.v) for r in spark.read.parquet(parts).collect()} == {("TX", " a "), ("FL", "c")}
    csv = str(tmp_path / "csv")
    sinks.write_csv_by_state(df, csv, "state")
    stored = landing.read_csv(spark, csv + "/*", ["state", "v"])
    assert {tuple(r) for r in stored.collect()} == {("TX", " a "), ("FL", "b")}
    assert {(r.position, r.column, r.type, r.filled) for r in sinks.column_listing(df).collect()} == {(1, "state", "string", 2), (2, "v", "string", 2)}


def test_whole_run_from_files(spark, tmp_path):
    write(tmp_path / "claims", "TX.csv", [text(CLAIM, CLAIM_COLUMNS), text(CLAIM | {"dateOfLoss": "x"}, CLAIM_COLUMNS), "bad"])
    write(tmp_path / "policies", "TX.csv", [text(POLICY, POLICY_COLUMNS)], POLICY_COLUMNS)
    for _ in range(2):
        result = run(spark, str(tmp_path / "claims"), str(tmp_path / "policies"), str(tmp_path / "out"), stop_on_failure=True)
    assert result.rows["claims_raw"] == 2 and result.rows["claims_rejected"] == 1
    assert result.rows["claims_cleaned"] == result.rows["fact_claims"] == result.star.fact_claims.count() == 1
    assert result.checks.where("status = 'FAIL'").count() == 0


def test_landing_takes_columns_from_each_header(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    write(source, "a b[1].csv", [text(CLAIM, CLAIM_COLUMNS)])
    turned = ["", "extra", "extra", "_file", *(" STATE" if c == "state" else c for c in CLAIM_COLUMNS[::-1] if c != "yearOfLoss")]
    claim = CLAIM | {" STATE": "FL"}
    row = ["", "1", "2", "x", *(claim[c] or "" for c in turned[4:])]
    write(source, "b.csv", [",".join(row), "bad"], turned)
    (source / "empty.csv").write_text("")
    assert land_csv(spark, str(source), out, "claims") == {"claims_raw": 2, "claims_rejected": 1}
    rows = {r.source_state: r for r in landing.read_bronze(spark, bronze_path(out, "claims"), "claims").collect()}
    assert {k: (r.state, r.countyCode, r.yearOfLoss, r.dateOfLoss[:10]) for k, r in rows.items()} == {
        "TX": ("TX", "48201", "2017", "2017-08-25"), "FL": ("FL", "48201", None, "2017-08-25"),
    }
    write(tmp_path / "other", "c.csv", ["1,2"], ["x", "y"])
    with pytest.raises(ValueError, match="none of the expected columns"):
        land_csv(spark, str(tmp_path / "other"), out, "claims")
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "d.csv").write_text("\n")
    with pytest.raises(FileNotFoundError):
        land_csv(spark, str(tmp_path / "none"), out, "claims")
    assert landing.read_bronze(spark, bronze_path(out, "claims"), "claims").count() == 2


def test_run_takes_up_where_it_stopped(spark, tmp_path):
    claims, policies, out = str(tmp_path / "claims"), str(tmp_path / "policies"), str(tmp_path / "out")
    write(tmp_path / "claims", "TX.csv", [text(CLAIM, CLAIM_COLUMNS)] * 2)
    write(tmp_path / "policies", "TX.csv", [text(POLICY, POLICY_COLUMNS)], POLICY_COLUMNS)
    first = run(spark, claims, policies, out, only_new=True)
    assert (first.rows["claims_raw"], first.rows["fact_claims"], first.rows["fact_policies"]) == (2, 1, 1)
    again = run(spark, claims, policies, out, only_new=True)
    assert again.rows["claims_raw"] == 0 and not {"claims_cleaned", "policies_cleaned", "fact_claims"} & set(again.rows)
    assert again.star.fact_claims.count() == 1 and again.checks.where("status = 'FAIL'").count() == 0
    write(tmp_path / "claims", "FL.csv", [text(CLAIM | {"state": "FL"}, CLAIM_COLUMNS)], CLAIM_COLUMNS)
    more = run(spark, claims, policies, out, only_new=True)
    assert (more.rows["claims_raw"], more.rows["claims_cleaned"], more.rows["fact_claims"]) == (1, 2, 2)
    assert "policies_cleaned" not in more.rows and more.bronze["claims"].count() == 3
    # a refused file leaves the table as it was, and is tried again once mended
    write(tmp_path / "claims", "NY.csv", ["bad"] * 101)
    with pytest.raises(landing.TooManyBadRows):
        land_csv(spark, claims, out, "claims", only_new=True)
    assert landing.read_bronze(spark, bronze_path(out, "claims"), "claims").count() == 3
    assert sorted(p.name for p in (tmp_path / "out" / "bronze").iterdir()) == ["claims_raw", "policies_raw"]
    write(tmp_path / "claims", "NY.csv", [text(CLAIM | {"state": "NY"}, CLAIM_COLUMNS)], CLAIM_COLUMNS)
    assert land_csv(spark, claims, out, "claims", only_new=True)["claims_raw"] == 1
    assert land_csv(spark, claims, out, "claims")["claims_raw"] == 4


def test_pages_are_landed(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "1.json").write_text(json.dumps({ENVELOPE["claims"]: [CLAIM, CLAIM | {"state": "FL"}]}, indent=1))
    (source / "2.json").write_text(json.dumps({"metadata": {}}))
    (source / "3.json").write_text("{broken")
    assert land_files(spark, str(source), out, "claims", kind="json") == {"claims_raw": 2, "claims_rejected": 1}
    assert [r[landing.BAD] for r in landing.read_rejected(spark, bronze_path(out, "claims"), "claims").collect()] == ["{broken"]
    (source / "4.json").write_text(json.dumps({ENVELOPE["claims"]: [CLAIM]}))
    assert land_files(spark, str(source), out, "claims", only_new=True, kind="json")["claims_raw"] == 1
    assert landing.read_bronze(spark, bronze_path(out, "claims"), "claims").count() == 3


def test_profile(spark):
    rows = [CLAIM, CLAIM | {"countyCode": None, "amountPaidOnBuildingClaim": "10"}, CLAIM | {"state": "FL", "amountPaidOnBuildingClaim": "40", "dateOfLoss": "bad"}]
    df = spark.createDataFrame([tuple(r[c] for c in CLAIM_COLUMNS) for r in rows], ", ".join(f"{c} string" for c in CLAIM_COLUMNS))
    out = {(r.section, r.column, r.item, r.text): r.number for r in profile_entity(df, "claims").collect()}
    assert out["rows", "", "total", ""] == 3
    assert out["states", "state", "count", "TX"] == 2
    assert ("types", "yearOfLoss", "type", "int64") in out and ("types", "countyCode", "type", "float64") in out
    assert ("types", "primaryResidenceIndicator", "type", "bool") in out and ("types", "dateOfLoss", "type", "object") in out
    assert out["nulls", "countyCode", "count", ""] == 1 and round(out["nulls", "countyCode", "percent", ""], 1) == 33.3
    amounts = {m: out["numbers", "amountPaidOnBuildingClaim", m, ""] for m in ("min", "max", "mean", "median")}
    assert amounts == {"min": 10.0, "max": 45000.0, "mean": pytest.approx(45050 / 3), "median": 40.0}
    assert out["values", "state", "1", "TX"] == 2 and out["values", "state", "2", "FL"] == 1
    assert ("dates", "dateOfLoss", "min", "2017-08-25") in out


def test_profile_reads_the_text_once(spark, tmp_path):
    rows = [CLAIM | {"amountPaidOnBuildingClaim": str(i % 7), "yearOfLoss": None if i % 3 else "2017"} for i in range(50)]
    schema = ", ".join(f"{c} string" for c in CLAIM_COLUMNS)
    spark.createDataFrame([tuple(r[c] for c in CLAIM_COLUMNS) for r in rows], schema).write.parquet(str(tmp_path / "claims"))
    df = spark.read.parquet(str(tmp_path / "claims"))
    counted = profile.tally(df)
    assert counted.where("column = 'yearOfLoss'").orderBy("value").collect() == [("yearOfLoss", None, 33), ("yearOfLoss", "2017", 17)]
    whole = {tuple(r) for r in profile.column_facts(df, ["dateOfLoss"]).collect()}
    assert {tuple(r) for r in profile.facts_of(counted, ["dateOfLoss"]).collect()} == whole
    assert profile.medians_of(counted.where("column LIKE 'amount%'")).collect() == profile.medians(df, [c for c in df.columns if c.startswith("amount")]).collect()
    # what is left to do reads only the tally
    assert not set(profile_entity(df, "claims").inputFiles()) & set(df.inputFiles())
    assert profile_entity(df.limit(0), "claims").where("section <> 'rows'").count() == 0


def test_files_are_told_by_length_and_time(spark, tmp_path, monkeypatch):
    import os

    source, out = tmp_path / "in", str(tmp_path / "out")
    write(source, "a.csv", [text(CLAIM, CLAIM_COLUMNS)])
    write(source, "b [1].csv", [text(CLAIM | {"state": "FL"}, CLAIM_COLUMNS)])
    assert land_csv(spark, str(source), out, "claims", only_new=True)["claims_raw"] == 2
    with monkeypatch.context() as m:  # without news no file is opened
        from floodledger.plans import warehouse

        m.setattr(warehouse, "first_lines", lambda *a: 1 / 0)
        assert land_csv(spark, str(source), out, "claims", only_new=True)["claims_raw"] == 0
    # a changed file is landed again under its name, and counts with its new rows
    write(source, "a.csv", [text(CLAIM | {"occupancyType": "3"}, CLAIM_COLUMNS), text(CLAIM | {"state": "NY"}, CLAIM_COLUMNS)])
    assert land_csv(spark, str(source), out, "claims", only_new=True)["claims_raw"] == 2
    os.utime(source / "a.csv", (1, 1))
    assert land_csv(spark, str(source), out, "claims", only_new=True)["claims_raw"] == 2
    assert land_csv(spark, str(source), out, "claims", only_new=True)["claims_raw"] == 0
    # loads that the ledger does not know are asked for their files
    landing.remove(spark, f"{out}/landed_files/claims")
    assert land_csv(spark, str(source), out, "claims", only_new=True)["claims_raw"] == 0
    # a full load forgets the earlier ones
    assert land_csv(spark, str(source), out, "claims")["claims_raw"] == 3
    assert land_csv(spark, str(source), out, "claims", only_new=True)["claims_raw"] == 0


def test_state_files_can_be_compressed(spark, tmp_path):
    """The columns from the header and all values are there again, and the text takes less space than its values."""
    df = spark.range(2000).selectExpr("if(id % 2 = 0, 'TX', 'FL') AS state", "concat('a \"b\", c ', id % 7) AS v")
    sinks.write_csv_by_state(df, str(tmp_path / "out"), "state", "gzip")
    files = [f for f in (tmp_path / "out").rglob("part-*") if not f.name.endswith(".crc")]
    assert files and all(f.name.endswith(".csv.gz") for f in files)
    assert sum(f.stat().st_size for f in files) < df.selectExpr("sum(length(state) + length(v))").first()[0] / 4
    stored = landing.read_csv_by_header(spark, f"{tmp_path}/out/*")
    assert stored.columns == ["state", "v"] and stored.exceptAll(df).isEmpty() and df.exceptAll(stored).isEmpty()


def _own_claims(spark, monkeypatch, tmp_path):
    """Claims in the place of the driver's, and a workspace that writes below the folder of the test."""
    from types import SimpleNamespace

    from harness import bindings

    rows = [tuple((CLAIM | {"state": s, "occupancyType": str(i)})[c] for c in CLAIM_COLUMNS) + (i,) for i, s in enumerate(["ASIA", "TX", "FL"] * 50)]
    claims = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in CLAIM_COLUMNS) + f", {bindings.INGEST_SEQ} bigint")
    monkeypatch.setattr(bindings, "landed_claims", lambda *_: claims)
    monkeypatch.setitem(bindings.LANDED, "claims", lambda *_: claims)
    return claims, SimpleNamespace(spark=spark, sf_dir="", path=str(tmp_path), scratch=lambda name: str(tmp_path / name))


def test_pages_are_written_compressed(spark, monkeypatch, tmp_path):
    from harness.catalog import reading

    claims, ws = _own_claims(spark, monkeypatch, tmp_path)
    folder = reading.page_folder(ws)
    files = [f for f in (tmp_path / "pages").rglob("part-*")]
    assert files and all(f.name.endswith(".json.gz") for f in files)
    pages = landing.read_envelope(spark, folder, reading.ENVELOPE["claims"], CLAIM_COLUMNS, multi_line=False)
    assert pages.select(*CLAIM_COLUMNS).exceptAll(claims.select(*CLAIM_COLUMNS)).isEmpty() and pages.count() == 150


def test_query_files_are_written_compressed(spark, monkeypatch, tmp_path):
    from harness.catalog import reading

    claims, ws = _own_claims(spark, monkeypatch, tmp_path)
    folder = reading.csv_folder(ws, "claims")
    assert all(f.name.endswith(".csv.gz") for f in (tmp_path / "csv_claims").rglob("part-*"))
    assert landing.read_csv_by_header(spark, folder + "/*").count() == claims.count()
