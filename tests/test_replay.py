import pytest
from conftest import CLAIM, POLICY
from pyspark.sql import functions as F
from test_landing import text, write

from floodledger import run
from floodledger.plans import replay
from floodledger.plans.warehouse import bronze_path, land_csv, loads
from floodledger.schemas import CLAIM_COLUMNS, POLICY_COLUMNS
from floodledger.sources import landing

def mended():
    return F.when(F.col(landing.BAD).endswith(",too,long"), F.regexp_replace(landing.BAD, ",too,long$", ""))


@pytest.fixture
def landed(spark, tmp_path):
    good = text(CLAIM, CLAIM_COLUMNS)
    other = text(CLAIM | {"state": "FL"}, CLAIM_COLUMNS) + ",too,long"
    write(tmp_path / "claims", "a.csv", [good, "too,short", other, other])
    write(tmp_path / "claims", "b.csv", [text(CLAIM | {"state": "NY"}, CLAIM_COLUMNS) + ",too,long"])
    write(tmp_path / "policies", "a.csv", [text(POLICY, POLICY_COLUMNS)], POLICY_COLUMNS)
    return tmp_path


def states(spark, out):
    rows = landing.read_bronze(spark, bronze_path(out, "claims"), "claims")
    return sorted(r.state for r in rows.collect())


def test_replay_lands_each_mended_line_once(spark, landed):
    out = str(landed / "out")
    assert land_csv(spark, str(landed / "claims"), out, "claims") == {"claims_raw": 1, "claims_rejected": 4}
    assert replay.replay(spark, out, "claims", F.lit(None).cast("string")) == {"claims_replayed": 0, "claims_rejected": 4}
    # what is malformed still stays
    assert replay.replay(spark, out, "claims", F.col(landing.BAD)) == {"claims_replayed": 0, "claims_rejected": 4}
    assert replay.replay(spark, out, "claims", mended()) == {"claims_replayed": 3, "claims_rejected": 1}
    before = loads(spark, out, "claims")
    assert states(spark, out) == ["FL", "FL", "NY", "TX"]
    assert replay.replay(spark, out, "claims", mended()) == {"claims_replayed": 0, "claims_rejected": 1}
    assert loads(spark, out, "claims") == before and states(spark, out) == ["FL", "FL", "NY", "TX"]
    assert [r[landing.BAD] for r in replay.rejected_lines(spark, out, "claims").collect()] == ["too,short"]
    assert {r[landing.FILE].rsplit("/", 1)[1] for r in replay.replaced_lines(spark, out, "claims").collect()} == {"a.csv", "b.csv"}
    # a changed file is landed again, mended lines or not
    write(landed / "claims", "b.csv", [text(CLAIM | {"state": "NY"}, CLAIM_COLUMNS)])
    assert land_csv(spark, str(landed / "claims"), out, "claims", only_new=True)["claims_raw"] == 1
    # a full load brings the lines anew
    assert land_csv(spark, str(landed / "claims"), out, "claims") == {"claims_raw": 2, "claims_rejected": 3}
    assert replay.replaced_lines(spark, out, "claims").count() == 0
    assert replay.replay(spark, out, "claims", mended()) == {"claims_replayed": 2, "claims_rejected": 1}


def test_replay_that_dies_changes_nothing(spark, landed, monkeypatch):
    out = str(landed / "out")
    land_csv(spark, str(landed / "claims"), out, "claims")
    with monkeypatch.context() as m:
        m.setattr(replay, "switch", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            replay.replay(spark, out, "claims", mended())
    assert states(spark, out) == ["TX"] and replay.rejected_lines(spark, out, "claims").agg(F.sum("n")).first()[0] == 4
    assert replay.replay(spark, out, "claims", mended()) == {"claims_replayed": 3, "claims_rejected": 1}


def test_replayed_lines_reach_the_star(spark, landed):
    out = str(landed / "out")
    first = run(spark, str(landed / "claims"), str(landed / "policies"), out, checks=False)
    assert first.silver.claims_cleaned.count() == 1
    replay.replay(spark, out, "claims", mended())
    again = run(spark, str(landed / "claims"), str(landed / "policies"), out, only_new=True, checks=False)
    keys = landing.read_bronze(spark, bronze_path(out, "claims"), "claims").select("state", "dateOfLoss", "countyCode").distinct().count()
    assert again.silver.claims_cleaned.count() == again.star.fact_claims.count() == keys == 3
