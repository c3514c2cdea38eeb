from dataclasses import replace
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from floodledger.operators.members import number_members
from floodledger.plans import dims, quality, views
from floodledger.plans.warehouse import build_gold, build_silver
from floodledger.session import work_folder


@pytest.fixture(scope="module")
def build(spark, claims_rows, policy_rows):
    def make(claims, policies):
        bronze = {"claims": claims_rows(*claims), "policies": policy_rows(*policies)}
        out = work_folder(spark)
        silver, _ = build_silver(bronze, out)
        star, _ = build_gold(silver, out)
        return bronze, silver, star

    return make


def test_date_dimension(spark):
    table = dims.dim_date(spark)
    assert table.count() == 19_358 + 1
    first = table.where("date_key = 19780101").first()
    assert (first.month_name, first.day_of_week, first.is_weekend, first.fiscal_year, first.fiscal_quarter) == ("January", "Sunday", 1, 1978, 2)
    assert table.where("date_key = -1").first().year is None


def test_missing_occupancy_does_not_fan_out(build):
    _, silver, star = build([{"occupancyType": None}, {"occupancyType": "4.0", "amountPaidOnBuildingClaim": "1"}], [{"occupancyType": None}])
    assert star.fact_claims.count() == silver.claims_cleaned.count() == 2
    assert {r.occupancy_key for r in star.fact_claims.collect()} == {-1, 1}
    assert star.dim_occupancy.count() == 2


def test_a_building_of_unknowns_meets_the_unknown_row_once(build):
    unknown = {
        "construction": None, "numberOfFloorsInInsuredBuilding": None, "originalConstructionDate": None,
        "elevatedBuildingIndicator": None, "basementEnclosureCrawlspaceType": None,
    }
    _, _, star = build([{}], [unknown])
    assert [r.building_type_key for r in star.fact_policies.collect()] == [-1]


def test_zone_codes_are_unique_whatever_the_spelling(build):
    zones = ["ae", " AE", "AE ", "AE"]
    claims = [{"ratedFloodZone": z, "amountPaidOnBuildingClaim": str(i)} for i, z in enumerate(zones)]
    _, _, star = build(claims, [{}])
    codes = [r.flood_zone_code for r in star.dim_flood_zone.collect()]
    assert sorted(codes) == ["AE", "Unknown", "X"]
    assert star.fact_claims.count() == 4


def test_missing_county_keeps_its_state(build):
    _, _, star = build([{"countyCode": None, "state": "FL"}, {"state": None}], [{}])
    named = star.fact_claims.join(star.dim_location, "location_key")
    assert {(r.state_name, r.county_fips) for r in named.collect()} == {("Florida", "00000"), ("Unknown", "00000")}


def test_states_without_reference_are_unknown(build):
    _, _, star = build([{"state": "CA"}], [{}])
    row = star.dim_location.where("state_abbrev = 'CA'").first()
    assert (row.state_name, row.fema_region) == ("Unknown", 0)


def test_dates_outside_the_calendar(build):
    _, _, star = build(
        [{"dateOfLoss": "1977-12-31"}, {"dateOfLoss": "2030-12-31"}],
        [{"policyTerminationDate": None}, {"policyTerminationDate": "2031-01-01", "countyCode": "1"}],
    )
    assert sorted(r.date_key for r in star.fact_claims.collect()) == [-1, 20301231]
    assert {r.termination_date_key for r in star.fact_policies.collect()} == {-1}


def test_surrogate_keys_are_unique(build):
    _, _, star = build([{"amountPaidOnBuildingClaim": str(i)} for i in range(50)], [{}])
    assert star.fact_claims.select("claim_sk").distinct().count() == 50


def test_lookups_are_broadcast_from_the_written_dimensions(build):
    from floodledger.plans.facts import fact_claims

    _, silver, star = build([{}], [{}])
    tables = {n: df for n, df in vars(star).items() if n.startswith("dim_")}
    plan = fact_claims(silver.claims_cleaned, **tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 5
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


# -------------------------------------------------------------------------------- views


def claim(state, day, paid, **more):
    return {"state": state, "dateOfLoss": day, "yearOfLoss": day[:4], "amountPaidOnBuildingClaim": str(paid), "amountPaidOnContentsClaim": "0"} | more


def policy(state, day, premium, **more):
    end = date.fromisoformat(day).replace(year=int(day[:4]) + 1)
    return {"propertyState": state, "policyEffectiveDate": day, "policyTerminationDate": str(end), "totalInsurancePremiumOfThePolicy": str(premium)} | more


@pytest.fixture(scope="module")
def star(build):
    claims = [
        claim("FL", "2010-01-05", 100), claim("FL", "2010-02-05", 300, countyCode="1"), claim("FL", "2012-03-05", 50),
        claim("TX", "2012-03-05", 1000, ratedFloodZone="VE"), claim("NY", "2009-01-01", -20),
    ]
    policies = [
        policy("FL", "2010-01-01", 1000), policy("FL", "2012-01-01", 500), policy("LA", "2012-01-01", 0),
    ]
    return build(claims, policies)[2]


def test_loss_ratio_keeps_places_of_one_side_only(star):
    rows = {(r.state_name, r.year): (r.total_claims_paid, r.total_premium, r.loss_ratio) for r in views.loss_ratio(star, "state").collect()}
    assert rows == {
        ("Florida", 2010): (Decimal(400), Decimal(1000), 0.4),
        ("Florida", 2012): (Decimal(50), Decimal(500), 0.1),
        ("Texas", 2012): (Decimal(1000), Decimal(0), None),
        ("Louisiana", 2012): (Decimal(0), Decimal(0), None),
        ("New York", 2009): (Decimal(-20), Decimal(0), None),
    }


def test_location_grain_sums_to_state_grain(star):
    location = views.loss_ratio(star, "location")
    assert location.where("state_name = 'Florida' AND year = 2010").count() == 2
    for grain in ("location", "state"):
        total = views.loss_ratio(star, grain).agg(F.sum("total_claims_paid"), F.sum("total_premium")).first()
        assert tuple(total) == (Decimal(1430), Decimal(1500))
    with pytest.raises(KeyError):
        views.loss_ratio(star, "galaxy")


def test_frequency_and_severity(star):
    rows = {(r.zone_category, r.year): r for r in views.frequency_severity(star).collect()}
    assert rows["A", 2010].claim_count == 2 and rows["A", 2010].frequency is None and rows["A", 2010].avg_severity == 200.0
    assert rows["X", 2010].claim_count == 0 and rows["X", 2010].avg_severity is None and rows["X", 2010].frequency == 0.0


def test_large_losses(star):
    rows = {r.state_name: r for r in views.large_loss_concentration(star).collect()}
    # positive amounts 50, 100, 300, 1000: position 0.95 * 3 = 2.85 lies between 300 and 1000
    assert rows["Texas"].p95_threshold == pytest.approx(895.0)
    assert rows["Texas"].large_loss_count == 1 and rows["Texas"].pct_of_total_paid == 100.0
    assert rows["Florida"].large_loss_count == 0 and rows["Florida"].total_paid == Decimal(450)


def test_large_losses_without_positive_claims(build):
    star = build([claim("FL", "2010-01-05", 0)], [policy("FL", "2010-01-01", 10)])[2]
    row = views.large_loss_concentration(star).first()
    assert (row.large_loss_count, row.p95_threshold, row.pct_of_total_paid) == (0, None, None)


def test_severity_by_zone(star):
    rows = {r.zone_category: r for r in views.severity_by_zone(star).collect()}
    assert (rows["A"].claim_count, rows["A"].avg_severity, rows["A"].median_severity, rows["A"].building_share) == (3, 150.0, 100.0, 1.0)
    assert rows["V"].median_severity == 1000.0


def test_premium_adequacy(star):
    both = {(r.occupancy_type, r.construction_class): r.adequacy_flag for r in views.premium_adequacy(star).collect()}
    assert both == {("1", "N/A"): "No Policy Data", ("1", "False"): "Adequate"}
    one = views.premium_adequacy(star, ["occupancy_type"]).first()
    assert (one.policy_count, one.total_claims, one.avg_premium) == (3, Decimal(1430), 500.0)
    assert one.pure_premium == pytest.approx(1430 / float(one.total_exposure)) and one.adequacy_flag == "Adequate"


def test_development_uses_the_stated_year(build):
    star = build([claim("FL", "2010-01-05", 100, yearOfLoss="2009"), claim("FL", "2010-01-06", 50, yearOfLoss=None)], [policy("FL", "2010-01-01", 10)])[2]
    assert [(r.year_of_loss, r.claim_count) for r in views.claims_development(star).collect()] == [(2009, 1)]


def test_portfolio_compares_with_the_row_before(star):
    rows = {r.year: r for r in views.portfolio_summary(star).collect()}
    assert set(rows) == {2010, 2012}
    assert rows[2010].prior_year_premium is None
    assert (rows[2012].prior_year_premium, rows[2012].premium_growth_pct) == (Decimal(1000), -50.0)
    assert (rows[2012].total_policies, rows[2012].claim_count, rows[2012].claims_growth_pct) == (2, 2, 162.5)


def test_policies_outside_the_calendar_stay_out_of_the_growth_chain(build):
    star = build([claim("FL", "2010-01-05", 1)], [policy("FL", "1970-01-01", 7), policy("FL", "2010-01-01", 10)])[2]
    rows = {r.year: r for r in views.portfolio_summary(star).collect()}
    assert rows[None].total_premium == 7 and rows[2010].prior_year_premium is None


def test_earned_premium_and_sanity_report(star):
    earned = {(r.state_name, r.year): r.earned_premium for r in views.earned_premium(star).collect()}
    assert earned["Florida", 2010] == pytest.approx(Decimal("999.316"))
    report = views.claims_by_state_year(star, since=2010).collect()
    assert [(r.year, r.state_name, r.claims) for r in report] == [(2012, "Florida", 1), (2012, "Texas", 1), (2010, "Florida", 2)]


def test_views_answer_in_sql(spark, star):
    names = views.register_views(star)
    assert len(names) == 14
    top = spark.sql("SELECT * FROM vw_loss_ratio_by_state ORDER BY year DESC, state_name LIMIT 1").first()
    assert (top.year, top.state_name) == (2012, "Florida")
    assert spark.sql("SELECT count(*) FROM fact_claims").first()[0] == 5


# -------------------------------------------------------------------------------- checks


def statuses(df):
    return {(r.suite, r.entity, r.check_name): (r.status, r.observed) for r in df.collect()}


def test_suites_on_good_data(build):
    bronze, silver, star = build([{}, {"at": 5}], [{}])
    silver_rows, gold_rows = statuses(quality.silver_suite(bronze, silver)), statuses(quality.gold_suite(bronze, silver, star))
    assert not [k for k, (s, _) in {**silver_rows, **gold_rows}.items() if s == "FAIL"]
    assert silver_rows["silver", "claims", "bronze_to_silver_delta"] == ("INFO", 1)
    assert silver_rows["silver", "claims", "null_state"] == ("PASS", 0)
    # one paid claim of 57000 over a premium of 1250
    assert gold_rows["business_rules", "portfolio", "loss_ratio_sane"] == ("WARNING", 1)
    assert gold_rows["row_counts", "dim_date", "dim_rows"] == ("INFO", 19_359)


def test_negative_amounts_fail_only_under_strict_rules(build):
    _, _, star = build([{"amountPaidOnBuildingClaim": "-5", "amountPaidOnContentsClaim": "1"}], [{"totalInsurancePremiumOfThePolicy": "-1"}])
    key = ("business_rules", "claims", "paid_building_not_negative")
    assert statuses(quality.claim_rules(star))[key] == ("WARNING", 1)
    assert statuses(quality.claim_rules(star, strict=True))[key] == ("FAIL", 1)
    assert statuses(quality.policy_rules(star, strict=True))["business_rules", "policies", "premium_not_negative"] == ("FAIL", 1)


def test_orphan_is_counted_exactly_once(build):
    _, _, star = build([{}, {"amountPaidOnBuildingClaim": "1"}], [{}])
    broken = star.fact_claims.withColumn("location_key", F.when(F.col("amount_paid_building") == 1, 99).otherwise(F.col("location_key")))
    rows = statuses(quality.fact_orphans(replace(star, fact_claims=broken), "claims"))
    assert rows["referential_integrity", "claims", "orphan_location_key"] == ("FAIL", 1)
    assert rows["referential_integrity", "claims", "orphan_date_key"] == ("PASS", 0)


def test_rows_of_the_unknown_member_are_counted_per_key(build):
    _, _, star = build([{}, {"dateOfLoss": "1950-01-01"}, {"occupancyType": None, "countyCode": "1"}], [{}])
    rows = statuses(quality.unknown_members(star, "claims"))
    assert rows["referential_integrity", "claims", "unknown_date_key"] == ("WARNING", 1)
    assert rows["referential_integrity", "claims", "unknown_occupancy_key"] == ("WARNING", 1)
    assert rows["referential_integrity", "claims", "unknown_location_key"] == ("PASS", 0)


def test_members_are_numbered_in_order_across_ranges(spark):
    members = spark.range(1000).selectExpr("CASE WHEN id > 0 THEN id * 7 % 1000 END AS a", "CAST(id AS string) AS b")
    rows = number_members(members, "k", ["a", "b"]).orderBy("k").collect()
    assert [r.k for r in rows] == list(range(1, 1001))
    assert [r.a for r in rows] == [None, *range(1, 1000)]
    assert number_members(members.limit(0), "k", ["a"]).count() == 0


def test_repeated_dimension_key_is_found(build):
    _, _, star = build([{}], [{}])
    twice = star.dim_occupancy.unionByName(star.dim_occupancy.where("occupancy_key = -1"))
    rows = statuses(quality.dim_keys(replace(star, dim_occupancy=twice)))
    assert rows["dimensions", "dim_occupancy", "duplicate_key"] == ("FAIL", 1)
    assert rows["dimensions", "dim_location", "duplicate_key"] == ("PASS", 0)


def test_failures_can_stop_a_run(build):
    bronze, silver, star = build([{}], [{}])
    doubled = star.fact_claims.unionByName(star.fact_claims)
    counts = quality.layer_counts("row_counts", "claims", bronze["claims"], silver.claims_cleaned, doubled)
    with pytest.raises(quality.ChecksFailed, match="gold_within_silver=1"):
        quality.raise_on_failure(counts)


def test_shares_sum_to_a_hundred(star):
    shares = quality.zone_distribution(star.fact_claims.join(star.dim_flood_zone, "flood_zone_key"))
    assert shares.agg(F.sum("pct")).first()[0] == 100
    assert [r.n for r in shares.collect()] == [4, 1]


def test_year_mismatch(build):
    _, silver, _ = build([{"yearOfLoss": "2016"}, {"yearOfLoss": None, "countyCode": "1"}, {"countyCode": "2"}], [{}])
    assert statuses(quality.year_mismatch(silver.claims_cleaned))["silver", "claims", "year_of_loss_differs"] == ("INFO", 2)
