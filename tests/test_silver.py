from datetime import date
from decimal import Decimal

from floodledger.plans.silver import clean_claims, clean_policies, rejected
from floodledger.schemas import SILVER, struct


def test_newest_duplicate_is_kept(claims_rows):
    out = clean_claims(claims_rows({"at": 1, "causeOfDamage": "old"}, {"at": 2, "causeOfDamage": "new"})).collect()
    assert [r.causeOfDamage for r in out] == ["new"]


def test_tie_has_the_same_survivor_for_any_partitioning(claims_rows):
    rows = claims_rows({"causeOfDamage": "b"}, {"causeOfDamage": "a"}, {"causeOfDamage": None}, {"causeOfDamage": "c"})
    survivors = {clean_claims(rows.repartition(n)).first().causeOfDamage for n in (1, 2, 3, 7)}
    assert survivors == {None}


def test_null_amounts_form_one_group(claims_rows):
    nothing = {"amountPaidOnBuildingClaim": None, "amountPaidOnContentsClaim": None}
    assert clean_claims(claims_rows(nothing | {"at": 1}, nothing | {"at": 2})).count() == 1


def test_key_columns_are_a_parameter(claims_rows):
    rows = claims_rows({"causeOfDamage": "1"}, {"causeOfDamage": "2"})
    assert clean_claims(rows, ["state", "causeOfDamage"]).count() == 2


def test_unusable_dates_are_left_out_and_reported(claims_rows):
    rows = claims_rows({}, *({"dateOfLoss": d} for d in ("not-a-date", None, "2017")))
    assert clean_claims(rows).count() == 1
    assert {r.dateOfLoss for r in rejected(rows, "dateOfLoss").collect()} == {"not-a-date", None, "2017"}


def test_claim_columns(claims_rows):
    out = clean_claims(claims_rows({"ratedFloodZone": None, "floodZoneCurrent": " x ", "amountPaidOnContentsClaim": "$5"}))
    assert out.schema.names == struct(SILVER["claims_cleaned"]).names
    assert [f.dataType for f in out.schema] == [f.dataType for f in struct(SILVER["claims_cleaned"])]
    row = out.first()
    assert (row.dateOfLoss, row.accident_year, row.yearOfLoss) == (date(2017, 8, 25), 2017, 2017)
    assert (row.floodZone, row.zone_category, row.is_special_flood_hazard) == ("X", "X", 0)
    assert (row.amountPaidTotal, row.amountPaidOnContentsClaim) == (Decimal("45000.00"), Decimal("0.00"))
    assert (row.occupancyType, row.numberOfFloors, row.basementEnclosureCrawlspaceType, row.yearBuilt) == ("1", "1", "0", "1985")


def test_policy_columns(policy_rows):
    out = clean_policies(policy_rows({"buildingDeductibleCode": "F", "policyTerminationDate": None}))
    assert [f.dataType for f in out.schema] == [f.dataType for f in struct(SILVER["policies_cleaned"])]
    row = out.first()
    assert (row.exposure, row.deductibleAmount, row.crsClassificationCode) == (Decimal("0.000000"), Decimal("0.00"), "7")


def test_dedup_limits_rows_before_the_shuffle(claims_rows):
    plan = clean_claims(claims_rows({}))._jdf.queryExecution().executedPlan().toString()
    partial = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert len(partial) == 2 and "Partial" in partial[1]
    assert plan.count("Exchange hashpartitioning") == 1
