from pathlib import Path

import pytest
from conftest import bronze
from pyspark.sql import functions as F

from floodledger.plans import condensed, merge, views, warehouse
from floodledger.plans.silver import row_key
from floodledger.schemas import CLAIM_KEY
from floodledger.sources import sinks


@pytest.fixture(scope="module")
def wide(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def claim(i, **more):
    return {"state": ["TX", "FL", "NY"][i % 3], "countyCode": f"{i % 7:05d}", "dateOfLoss": f"20{10 + i % 9}-03-04", "amountPaidOnBuildingClaim": str(100 * i)} | more


def policy(i, **more):
    return {"propertyState": ["TX", "FL", "NY"][i % 3], "countyCode": f"{i % 7:05d}", "policyEffectiveDate": f"20{10 + i % 9}-05-01", "policyTerminationDate": f"20{11 + i % 9}-05-01", "totalInsurancePremiumOfThePolicy": str(100 + i)} | more


#: Three loads: new keys, newer and older versions of earlier rows, unusable rows, NULLs in keys, a new zone and occupancy.
LOADS = [
    ([claim(i, at=10) for i in range(40)] + [claim(3, at=9, occupancyType="7"), claim(50, at=1, dateOfLoss="bad")], [policy(i, at=10) for i in range(30)]),
    ([claim(3, at=20, ratedFloodZone="V9", occupancyType="9", amountPaidOnContentsClaim="12000.00"), claim(60, at=20, amountPaidOnContentsClaim=None, countyCode=None)], [policy(2, at=20, occupancyType="4", totalBuildingInsuranceCoverage="7")]),
    ([claim(4, at=5, ratedFloodZone="D"), claim(60, at=30, amountPaidOnContentsClaim=None, countyCode=None, yearOfLoss="1999"), claim(61, at=30, state="NJ")], []),
]

NATURAL = ["state_abbrev", "county_fips", "flood_zone_code", "occupancy_type", "construction_class", "number_of_floors", "year_built_band", "elevated_flag", "basement_type"]


def natural(star, entity):
    """Fact rows with the attributes of their dimension rows in the place of keys."""
    fact = getattr(star, f"fact_{entity}")
    for dim, key in ((star.dim_location, "location_key"), (star.dim_flood_zone, "flood_zone_key"), (star.dim_occupancy, "occupancy_key"), (star.dim_building_type, "building_type_key")):
        fact = fact.join(dim.select(key, *(c for c in dim.columns if c in NATURAL)), key).drop(key)
    return sorted(map(repr, fact.select(sorted(fact.columns)).collect()))


def files(folder):
    return {p.parent.name: {q.name for q in p.parent.glob("*.parquet")} for p in Path(folder).glob("bucket=*/*.parquet")}


@pytest.fixture(scope="module")
def runs(wide, tmp_path_factory):
    """The results and bucket files after each of three runs, and one run over everything."""
    out = str(tmp_path_factory.mktemp("merged"))
    made = lambda e, rows: bronze(wide, e, rows)
    steps, kept = [], []
    for claims, policies in LOADS:
        result = warehouse.run(wide, made("claims", claims), made("policies", policies), out, only_new=True)
        steps.append({
            "rows": result.rows, "members": {r.location_key: (r.state_abbrev, r.county_fips) for r in result.star.dim_location.collect()},
            "zones": {r.flood_zone_key: r.flood_zone_code for r in result.star.dim_flood_zone.collect()},
            "failed": result.checks.where("status = 'FAIL'").count()})
        kept.append({t: files(f"{out}/{t}") for t in ("silver/claims_cleaned", "silver/policies_cleaned", "gold/fact_claims", "gold/fact_policies")})
    whole = warehouse.run(wide, made("claims", sum((c for c, _ in LOADS), [])), made("policies", sum((p for _, p in LOADS), [])), str(tmp_path_factory.mktemp("whole")))
    return out, result, steps, kept, whole


def test_three_loads_equal_a_full_rebuild(runs):
    _, result, steps, _, whole = runs
    for entity in ("claims", "policies"):
        assert natural(result.star, entity) == natural(whole.star, entity)
        of = lambda r: sorted(map(repr, getattr(r.silver, f"{entity}_cleaned").drop("bucket").collect()))  # noqa: E731,B023
        assert of(result) == of(whole)
    assert [s["rows"]["fact_claims"] for s in steps] == [40, 41, 42] and steps[1]["rows"]["fact_policies"] == 31
    assert "fact_policies" not in steps[2]["rows"]
    assert not any(s["failed"] for s in steps)


def test_untouched_buckets_keep_their_files(runs):
    kept = runs[3]
    for table in kept[0]:
        changed = {b for b in kept[1][table] if kept[0][table].get(b) != kept[1][table][b]}
        assert 0 < len(changed) <= 2 < len(kept[1][table]) - 2, table
    assert kept[2]["silver/policies_cleaned"] == kept[1]["silver/policies_cleaned"]
    assert kept[2]["gold/fact_policies"] == kept[1]["gold/fact_policies"]


def test_members_keep_their_keys_and_new_ones_follow(runs):
    steps = runs[2]
    for name in ("members", "zones"):
        for before, after in zip(steps, steps[1:]):
            assert before[name].items() <= after[name].items()
        last = steps[-1][name]
        assert sorted(last) == [-1, *range(1, len(last))]
    assert {"V9"} == set(steps[1]["zones"].values()) - set(steps[0]["zones"].values())
    assert ("NJ", "00005") in set(steps[2]["members"].values()) - set(steps[1]["members"].values())


def test_views_from_merged_sums_equal_views_of_the_facts(runs):
    out, result, _, _, whole = runs
    for name, grain in condensed.VIEW_GRAIN.items():
        view = views.VIEWS.get(name, views.earned_premium)
        short = view(condensed.condensed_star(result.star, f"{out}/gold", grain))
        of = lambda df: sorted([tuple(float(v) if k != "year" and hasattr(v, "as_tuple") else v for k, v in r.asDict().items()) for r in df.collect()], key=repr)
        assert of(short) == of(view(result.star)) == of(view(whole.star)), name


def test_percentile_views_from_merged_histograms_equal_views_of_the_facts(runs):
    out, result, _, _, whole = runs
    of = lambda df: sorted([{k: float(v) if hasattr(v, "as_tuple") else v for k, v in r.asDict().items()} for r in df.collect()], key=repr)
    for p in (0.0, 0.5, 0.95, 1.0):
        short = of(condensed.large_loss_concentration(result.star, f"{out}/gold", p))
        assert short == of(views.large_loss_concentration(result.star, p)) == of(views.large_loss_concentration(whole.star, p))
        assert sum(r["large_loss_count"] for r in short) > 0
    assert of(condensed.severity_by_zone(result.star, f"{out}/gold")) == of(views.severity_by_zone(result.star)) == of(views.severity_by_zone(whole.star))


def test_percentile_views_read_only_the_bucket_of_the_percentile(runs):
    out, result, *_ = runs
    plan = condensed.large_loss_concentration(result.star, f"{out}/gold")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "paid_bucket" not in line and "amount_paid_total" in line]
    assert len(scans) == 1 and "LessThanOrEqual(am" in scans[0] and "amount_paid_total:decimal(18,2)>" in scans[0]


def test_large_losses_without_any_paid_claim(wide, runs, monkeypatch):
    out, result, *_ = runs
    stored = condensed.read
    monkeypatch.setattr(condensed, "read", lambda *a: stored(*a).where("paid_bucket IS NULL"))
    rows = condensed.large_loss_concentration(result.star, f"{out}/gold").collect()
    assert all(r.p95_threshold is None and r.large_loss_count == 0 for r in rows)
    assert condensed.severity_by_zone(result.star, f"{out}/gold").count() == 0


def test_sums_of_a_group_whose_rows_are_gone(wide, runs):
    """A zone that no row has any more is in no view."""
    out, result = runs[0], runs[1]
    merged = condensed.read(wide, f"{out}/gold", "fact_claims", "zone").join(result.star.dim_flood_zone, "flood_zone_key")
    counts = {(r.flood_zone_code): r.row_count for r in merged.groupBy("flood_zone_code").agg(F.sum("row_count").alias("row_count")).collect()}
    assert counts == {r.flood_zone_code: r["count"] for r in result.star.fact_claims.join(result.star.dim_flood_zone, "flood_zone_key").groupBy("flood_zone_code").count().collect()}
    year = condensed.read(wide, f"{out}/gold", "fact_claims", "loss_year").where("year_of_loss = 1999").first()
    assert (year.row_count, year.amount_paid_contents, year.amount_paid_total) == (1, 0, 6000)


def test_sums_tell_null_from_nothing(wide):
    fact = lambda *paid: wide.createDataFrame([(20100101, 1, 1, 1, 1, 2010, p, p, p) for p in paid], "date_key int, location_key int, flood_zone_key int, occupancy_key int, building_type_key int, year_of_loss int, amount_paid_total decimal(18,2), amount_paid_building decimal(18,2), amount_paid_contents decimal(18,2)")
    from decimal import Decimal

    came, went = fact(None, Decimal(5)), fact(Decimal(5), None)
    both = condensed.signed(came, "fact_claims", 1).unionByName(condensed.signed(went, "fact_claims", -1))
    assert condensed.sums(both, "fact_claims").count() == 0
    left = condensed.signed(came, "fact_claims", 1).unionByName(condensed.signed(fact(Decimal(5)), "fact_claims", -1))
    row = condensed.sums(left, "fact_claims").where("grain = 'loss_year'").first()
    assert (row.row_count, row.amount_paid_total, row.amount_paid_total_filled) == (1, 0, 0)


def test_an_unfinished_merge_is_built_anew(wide, tmp_path, monkeypatch):
    out = str(tmp_path)
    made = lambda e, rows: bronze(wide, e, rows)
    run = lambda c: warehouse.run(wide, made("claims", c), made("policies", []), out, only_new=True)
    warehouse.run(wide, made("claims", [claim(i, at=1) for i in range(10)]), made("policies", [policy(1)]), out)
    with monkeypatch.context() as m:
        m.setattr(merge, "mark_built", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run([claim(3, at=5, occupancyType="8")])
    assert merge.built_from(wide, f"{out}/silver/claims_built_from") is None
    result = run([claim(20, at=5)])
    assert result.star.fact_claims.count() == 11
    assert result.silver.claims_cleaned.where("occupancyType = '8'").count() == 1


def test_keys_do_not_depend_on_files_or_buckets(wide, tmp_path):
    rows = [claim(i) for i in range(30)] + [claim(1, countyCode=None), claim(1, countyCode="null")]
    keys = []
    for n, (split, buckets) in enumerate(((1, 3), (7, 8))):
        raw = bronze(wide, "claims", rows).repartition(split)
        raw.write.parquet(f"{tmp_path}/raw{n}")
        silver, _ = warehouse.build_silver({"claims": wide.read.parquet(f"{tmp_path}/raw{n}"), "policies": bronze(wide, "policies", [{}])}, f"{tmp_path}/out{n}", buckets=buckets)
        star, _ = warehouse.build_gold(silver, f"{tmp_path}/out{n}")
        keys.append(sorted((r.claim_sk, r.amount_paid_building) for r in star.fact_claims.collect()))
    assert keys[0] == keys[1] and len({k for k, _ in keys[0]}) == 32 and {len(k) for k, _ in keys[0]} == {32}


def test_a_collision_of_keys_stops_the_build(wide, tmp_path, monkeypatch):
    monkeypatch.setattr(merge, "row_key", lambda key: F.substring(row_key(key), 1, 0))
    with pytest.raises(merge.KeyCollision):
        merge.rebuild(bronze(wide, "claims", [claim(i) for i in range(9)]), f"{tmp_path}/t", "claims", 2)


def test_keys_are_counted_as_numbers_and_files_are_small(wide, tmp_path, monkeypatch):
    """Texts of identities are only grouped if their numbers are fewer than the rows."""
    grouped = []
    look = merge.duplicate_keys
    monkeypatch.setattr(merge, "duplicate_keys", lambda rows, keys: grouped.append(keys) or look(rows, keys))
    path = f"{tmp_path}/t"
    assert merge.rebuild(bronze(wide, "claims", [claim(i) for i in range(9)]), path, "claims", 2) == 9 and not grouped
    merge.merge(bronze(wide, "claims", [claim(3, at=7), claim(12)]).select(*merge.ENTITIES["claims"].columns, merge.INGESTED), path, "claims", 2, [0, 1])
    assert not grouped and wide.read.parquet(path).count() == 10
    written = list(Path(path).rglob("*.parquet"))
    assert written and all(p.name.endswith(".zstd.parquet") for p in written)


def test_key_parts_are_told_apart(wide):
    texts = [("a", "b"), ("ab", ""), ("ab", None), (None, "ab"), ("a|1:b", ""), ("a", "|1:b")]
    df = wide.createDataFrame([t + ("x", "y", "z") for t in texts], ", ".join(f"{c} string" for c in CLAIM_KEY))
    assert df.select(row_key(CLAIM_KEY).alias("k")).distinct().count() == len(texts)


def test_a_failed_switch_keeps_the_old_table(spark, tmp_path, monkeypatch):
    old, new = f"{tmp_path}/old", f"{tmp_path}/new"
    spark.range(3).write.parquet(old)
    with pytest.raises(OSError):
        sinks.switch(spark, new, old)  # there is nothing to move
    assert spark.read.parquet(old).count() == 3 and not sinks.exists(spark, f"{old}_aside")
    spark.range(5).write.parquet(new)
    sinks.switch(spark, new, old)
    assert spark.read.parquet(old).count() == 5 and not sinks.exists(spark, new) and not sinks.exists(spark, f"{old}_aside")


def test_a_load_in_every_bucket_replaces_the_sums(wide, tmp_path, monkeypatch):
    """Rows that all went are not read again, buckets are looked for once a load, and the sums are those of the new rows."""
    out, searched = str(tmp_path), []
    look = merge.touched_buckets
    monkeypatch.setattr(merge, "touched_buckets", lambda rows, entity, buckets: searched.append(entity) or look(rows, entity, buckets))
    for at, more in ((10, {}), (20, {"occupancyType": "9", "ratedFloodZone": "V9"})):
        claims = bronze(wide, "claims", [claim(i, at=at, **more) for i in range(150)] + [claim(200 + at, at=at, countyCode=None)])
        policies = bronze(wide, "policies", [policy(1, at=at, **more)])
        result = warehouse.run(wide, claims, policies, out, only_new=True, checks=False)
    assert sorted(searched) == ["claims", "policies"]
    kept = lambda name: {p.name.split("=")[1].split("-")[0] for p in Path(f"{out}/gold/condensed/{name}").glob("load=*")}
    assert kept("fact_claims") == {"all"} and kept("fact_policies") == {"all", "new"}
    sums = condensed.read(wide, f"{out}/gold", "fact_claims", "loss_year").agg(F.sum("row_count"), F.sum("amount_paid_total")).first()
    assert tuple(sums) == tuple(result.star.fact_claims.agg(F.count("*"), F.sum("amount_paid_total")).first()) and sums[0] == 152


def test_landed_text_that_the_typed_columns_spell_is_stored_once(wide, tmp_path):
    """Every landed text comes back as it was, and of those that are spelled by a typed column nothing is kept beside it."""
    odd = [
        claim(1), claim(2, occupancyType=" 1.0", amountPaidOnContentsClaim="1200"), claim(3, amountPaidOnContentsClaim=None, countyCode=""),
        claim(4, amountPaidOnContentsClaim="=", yearOfLoss="02010", causeOfDamage="="), claim(5, occupancyType=None, state=None, dateOfLoss="2010-03-04"),
        claim(6, state="tx", ratedFloodZone=None, floodZoneCurrent="X", yearOfLoss=None, amountPaidOnBuildingClaim="0.00"), claim(7, occupancyType="\u0001", causeOfDamage="\u0000")]
    kind = merge.ENTITIES["claims"]
    raw = merge.usable(bronze(wide, "claims", odd), kind)
    path = f"{tmp_path}/t"
    sinks.overwrite(merge.stored_rows(raw, "claims", 3), path, ["bucket"])
    back = merge.read_stored(wide, path, "claims", [0, 1, 2])
    assert back.columns == raw.columns and sorted(map(repr, back.collect())) == sorted(map(repr, raw.collect()))
    kept = {r.amountPaidOnBuildingClaim: r.landed for r in wide.read.parquet(path).collect()}
    assert kept[100].amountPaidOnContentsClaim is kept[100].state is kept[100].causeOfDamage is None and kept[200].amountPaidOnContentsClaim == "=1200"
    rows = [policy(1), policy(2, buildingDeductibleCode="F", crsClassCode=None, totalInsurancePremiumOfThePolicy="1250.00")]
    raw = merge.usable(bronze(wide, "policies", rows), merge.ENTITIES["policies"])
    sinks.overwrite(merge.stored_rows(raw, "policies", 3), f"{tmp_path}/p", ["bucket"])
    assert sorted(map(repr, merge.read_stored(wide, f"{tmp_path}/p", "policies", [0, 1, 2]).collect())) == sorted(map(repr, raw.collect()))


def test_a_table_of_an_earlier_form_is_built_anew(wide, tmp_path):
    mark = f"{tmp_path}/mark"
    merge.mark_built(wide, mark, {"a"}, 3)
    assert merge.built_from(wide, mark) == ({"a"}, 3)
    sinks.overwrite(wide.createDataFrame([("a", 3)], "load string, buckets int"), mark)
    assert merge.built_from(wide, mark) is None


def test_sums_are_grouped_by_the_number_of_the_grain(wide):
    """Each row is compared with its grain for every key: with a number, while the stored sums have the names."""
    kinds = "date_key int, location_key int, flood_zone_key int, occupancy_key int, building_type_key int, year_of_loss int, amount_paid_total decimal(18,2), amount_paid_building decimal(18,2), amount_paid_contents decimal(18,2)"
    made = condensed.sums(condensed.signed(wide.createDataFrame([(20100101, 1, 2, 3, 4, 2010, None, None, None)], kinds), "fact_claims", 1), "fact_claims")
    assert {r.grain for r in made.collect()} == set(condensed.GRAINS["fact_claims"])
    zone = made.where("grain = 'zone'").first()
    assert (zone.flood_zone_key, zone.location_key, zone.row_count, zone.year_key) == (2, None, 1, 20100101)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "explode([0,1,2,3,4,5])" in plan


def test_a_large_table_is_merged_some_buckets_at_a_time(wide, tmp_path, monkeypatch):
    """Rounds take disjoint buckets and leave what one merge of all leaves; a small table takes one."""
    kind = merge.ENTITIES["claims"]
    old = [claim(i, at=10) for i in range(60)] + [claim(100, at=10, countyCode=None)]
    new = [claim(i, at=20, occupancyType="9") for i in range(0, 60, 3)] + [claim(i, at=5) for i in range(1, 60, 3)] + [claim(200 + i, at=20) for i in range(9)]
    load = merge.usable(bronze(wide, "claims", new), kind)
    left, reads = [], []
    read = merge.read_stored
    monkeypatch.setattr(merge, "read_stored", lambda spark, path, entity, touched: reads.append(touched) or read(spark, path, entity, touched))
    monkeypatch.setattr(type(wide.sparkContext), "defaultParallelism", 4)
    for at, size in enumerate((merge.ROUND, 1)):
        path = f"{tmp_path}/t{at}"
        merge.rebuild(bronze(wide, "claims", old), path, "claims", 12)
        touched = merge.touched_buckets(load, "claims", 12)
        monkeypatch.setattr(merge, "ROUND", size)
        assert merge.merge(load, path, "claims", 12, touched) == 70
        left.append(sorted(map(repr, wide.read.parquet(path).collect())))
    assert left[0] == left[1] and reads[0] == touched == list(range(12))
    assert len(reads) == 4 and sorted(sum(reads[1:], [])) == touched and {len(r) for r in reads[1:]} == {4}


def test_decimals_are_summed_up_exactly_as_numbers(wide):
    """Sums of the largest and of negative amounts; of the measures only those of more than 18 digits are added as decimals."""
    from decimal import Decimal

    most = Decimal("9999999999999999.99")
    paid = [most] * 7 + [Decimal("-0.01"), -most, Decimal("42949672.96"), Decimal("-42949672.97"), None]
    keys = "date_key int, location_key int, flood_zone_key int, occupancy_key int, building_type_key int, year_of_loss int"
    fact = wide.createDataFrame([(20100101, 1, 2, 3, 4, 2010, p, p and -p, Decimal("0.05")) for p in paid], f"{keys}, amount_paid_total decimal(18,2), amount_paid_building decimal(18,2), amount_paid_contents decimal(18,2)")
    for sign in (1, -1):
        made = condensed.sums(condensed.signed(fact, "fact_claims", sign), "fact_claims")
        assert {made.schema[m].dataType.simpleString() for m in condensed.MEASURES["fact_claims"]} == {"decimal(30,2)"}
        row = made.where("grain = 'zone'").first()
        total = sum(p for p in paid if p is not None)
        assert (row.amount_paid_total, row.amount_paid_building, row.amount_paid_contents) == (sign * total, -sign * total, sign * Decimal("0.60"))
        assert row.amount_paid_total_filled == sign * 11
        added = [e for line in made._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate" in line for e in line.split("sum(")[1:]]
        assert added and not any(e.startswith("amount_paid_total#") or e.startswith("amount_paid_building#") for e in added)
