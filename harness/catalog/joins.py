"""Joins (J-01 to J-14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from floodledger.operators.drill import drill_across
from floodledger.operators.lookup import orphan_counts, orphans, resolve_key
from floodledger.plans import dims
from floodledger.plans.quality import edges
from floodledger.plans.views import large_loss_threshold
from harness.registry import query
from harness.sql import band

def n_rows():
    return F.count(F.lit(1)).alias("n")


@query(
    "j01_left_lookup_one_key",
    "claims states",
    "SELECT c.state, s.state_name, s.fema_region, count(*) AS n FROM claims c LEFT JOIN states s ON s.state_abbrev = c.state GROUP BY 1, 2, 3",
)
def j01(ws):
    rows = ws.claims.groupBy("state").agg(n_rows())
    return rows.join(ws.silver.ref_state_info, F.col("state") == F.col("state_abbrev"), "left").select(
        "state", "state_name", "fema_region", "n"
    )


@query(
    "j02_left_lookup_two_keys",
    "claims dim_location",
    "SELECT COALESCE(l.location_key, -1) AS location_key, count(*) AS n FROM claims c LEFT JOIN dim_location l"
    " ON l.state_abbrev = c.state AND l.county_fips = COALESCE(c.countyCode, '00000') GROUP BY 1",
)
def j02(ws):
    rows = ws.claims.withColumn("county", dims.county_or_default(F.col("countyCode")))
    found = resolve_key(
        rows, ws.star.dim_location, {"state": "state_abbrev", "county": "county_fips"}, "location_key"
    )
    return found.groupBy("location_key").agg(n_rows())


@query(
    "j03_left_lookup_computed_keys",
    "policies dim_building_type",
    "SELECT COALESCE(bt.building_type_key, -1) AS building_type_key, count(*) AS n FROM policies p LEFT JOIN dim_building_type bt"
    " ON bt.construction_class = COALESCE(p.constructionClass, 'Unknown') AND bt.number_of_floors = COALESCE(p.numberOfFloors, 'Unknown')"
    f" AND bt.year_built_band = {band('p.yearBuilt')}"
    " AND bt.elevated_flag = CASE WHEN upper(p.elevatedBuildingIndicator) = 'TRUE' THEN 1 ELSE 0 END"
    " AND bt.basement_type = COALESCE(p.basementEnclosureCrawlspaceType, 'Unknown') GROUP BY 1",
)
def j03(ws):
    rows = dims.with_building_attributes(ws.policies)
    found = resolve_key(rows, ws.star.dim_building_type, {c: c for c in dims.BUILDING}, "building_type_key")
    return found.groupBy("building_type_key").agg(n_rows())


@query(
    "j04_left_lookup_defaulted_key",
    "claims dim_occupancy",
    "SELECT o.occupancy_key, o.occupancy_type, count(*) AS n FROM claims c LEFT JOIN dim_occupancy o"
    " ON o.occupancy_type = COALESCE(c.occupancyType, 'Unknown') GROUP BY 1, 2",
)
def j04(ws):
    """The missing code meets exactly one Unknown member: no fan-out."""
    rows = ws.claims.select(F.coalesce("occupancyType", F.lit("Unknown")).alias("code"))
    joined = rows.join(ws.star.dim_occupancy, F.col("code") == F.col("occupancy_type"), "left")
    return joined.groupBy("occupancy_key", "occupancy_type").agg(n_rows())


@query(
    "j05_unknown_member",
    "fact_claims",
    "SELECT 'occupancy' AS key, count(*) FILTER (WHERE occupancy_key = -1) AS unresolved, count(*) AS n FROM fact_claims"
    " UNION ALL SELECT 'flood_zone', count(*) FILTER (WHERE flood_zone_key = -1), count(*) FROM fact_claims",
)
def j05(ws):
    totals = ws.star.fact_claims.agg(
        F.count_if(F.col("occupancy_key") == -1).alias("occupancy"),
        F.count_if(F.col("flood_zone_key") == -1).alias("flood_zone"),
        n_rows(),
    )
    return totals.unpivot(["n"], ["occupancy", "flood_zone"], "key", "unresolved").select("key", "unresolved", "n")


@query(
    "j06_star_join",
    "claims_star",
    "SELECT state_name, zone_category, year_built_band, occupancy_type, count(*) AS n, CAST(sum(amount_paid_total) AS DOUBLE) AS paid"
    " FROM claims_star GROUP BY 1, 2, 3, 4",
)
def j06(ws):
    s = ws.star
    joined = (
        s.fact_claims.join(s.dim_location, "location_key")
        .join(s.dim_flood_zone, "flood_zone_key")
        .join(s.dim_building_type, "building_type_key")
        .join(s.dim_occupancy, "occupancy_key")
    )
    return joined.groupBy("state_name", "zone_category", "year_built_band", "occupancy_type").agg(
        n_rows(), F.sum("amount_paid_total").alias("paid")
    )


@query(
    "j07_inner_fact_to_dim",
    "claims_star",
    "SELECT year, zone_category, CAST(sum(amount_paid_total) AS DOUBLE) AS paid FROM claims_star GROUP BY 1, 2",
)
def j07(ws):
    s = ws.star
    joined = s.fact_claims.join(s.dim_date, "date_key").join(s.dim_flood_zone, "flood_zone_key")
    return joined.groupBy("year", "zone_category").agg(F.sum("amount_paid_total").alias("paid"))


@query(
    "j08_role_playing_date",
    "fact_policies dim_date",
    "SELECT a.year AS start_year, b.year AS end_year, count(*) AS n FROM fact_policies f JOIN dim_date a ON a.date_key = f.effective_date_key"
    " JOIN dim_date b ON b.date_key = f.termination_date_key GROUP BY 1, 2",
)
def j08(ws):
    dates = ws.star.dim_date
    start = dates.select(F.col("date_key").alias("effective_date_key"), F.col("year").alias("start_year"))
    end = dates.select(F.col("date_key").alias("termination_date_key"), F.col("year").alias("end_year"))
    joined = ws.star.fact_policies.join(start, "effective_date_key").join(end, "termination_date_key")
    return joined.groupBy("start_year", "end_year").agg(n_rows())


_SIDES = (
    "(SELECT state, accident_year AS year, count(*) AS claims FROM claims GROUP BY 1, 2) c FULL OUTER JOIN"
    " (SELECT propertyState AS state, CAST(year(policyEffectiveDate) AS INT) AS year, count(*) AS policies FROM policies GROUP BY 1, 2) p"
    " ON c.state = p.state AND c.year = p.year"
)


def _claims_side(ws):
    return ws.claims.groupBy("state", F.col("accident_year").alias("year")).agg(F.count(F.lit(1)).alias("claims"))


def _policies_side(ws, shift: int = 0):
    year = (F.year("policyEffectiveDate") + shift).alias("year")
    return ws.policies.groupBy(F.col("propertyState").alias("state"), year).agg(F.count(F.lit(1)).alias("policies"))


@query(
    "j09_full_outer_two_keys",
    "claims policies",
    "SELECT COALESCE(c.state, p.state) AS state, COALESCE(c.year, p.year) AS year, claims, policies FROM "
    + _SIDES.replace("CAST(year(policyEffectiveDate) AS INT)", "CAST(year(policyEffectiveDate) + 3 AS INT)"),
)
def j09(ws):
    """The policy side is shifted by three years, so that both sides have rows without a partner."""
    return _claims_side(ws).join(_policies_side(ws, 3), ["state", "year"], "full_outer")


@query(
    "j10_join_on_coalesced_key",
    "claims policies states",
    "SELECT state_name, COALESCE(c.year, p.year) AS year, claims, policies FROM " + _SIDES
    + " JOIN states s ON s.state_abbrev = COALESCE(c.state, p.state)",
)
def j10(ws):
    both = _claims_side(ws).join(_policies_side(ws), ["state", "year"], "full_outer")
    names = ws.silver.ref_state_info.select(F.col("state_abbrev").alias("state"), "state_name")
    return both.join(names, "state").select("state_name", "year", "claims", "policies")


@query(
    "j11_drill_across",
    "claims policies",
    "SELECT COALESCE(c.county, p.county) AS county, paid, premium FROM (SELECT countyCode AS county, CAST(sum(amountPaidTotal) AS DOUBLE) AS paid"
    " FROM claims GROUP BY 1) c FULL OUTER JOIN (SELECT countyCode AS county, CAST(sum(totalPremium) AS DOUBLE) AS premium FROM policies GROUP BY 1) p"
    " ON c.county IS NOT DISTINCT FROM p.county",
)
def j11(ws):
    """Counties with a NULL among them: the grain is compared null-safe."""
    county = F.col("countyCode").alias("county")
    claims = ws.claims.groupBy(county).agg(F.sum("amountPaidTotal").alias("paid"))
    policies = ws.policies.groupBy(county).agg(F.sum("totalPremium").alias("premium"))
    return drill_across(claims, policies, ["county"])


@query(
    "j12_left_join_of_aggregates",
    "claims policies",
    "SELECT p.year, policies, claims FROM (SELECT CAST(year(policyEffectiveDate) + 2 AS INT) AS year, count(*) AS policies FROM policies GROUP BY 1) p"
    " LEFT JOIN (SELECT accident_year AS year, count(*) AS claims FROM claims GROUP BY 1) c ON c.year = p.year",
)
def j12(ws):
    policies = ws.policies.groupBy((F.year("policyEffectiveDate") + 2).alias("year")).agg(
        F.count(F.lit(1)).alias("policies")
    )
    claims = ws.claims.groupBy(F.col("accident_year").alias("year")).agg(F.count(F.lit(1)).alias("claims"))
    return policies.join(claims, "year", "left")


@query(
    "j13_anti_join",
    "fact_policies dim_date",
    "SELECT termination_date_key, count(*) AS n FROM fact_policies f LEFT JOIN (SELECT * FROM dim_date WHERE year <= 1999) d"
    " ON f.termination_date_key = d.date_key WHERE d.date_key IS NULL GROUP BY 1",
)
def j13(ws):
    early = ws.star.dim_date.where("year <= 1999")
    missing = orphans(ws.star.fact_policies, early, "termination_date_key", "date_key")
    return missing.groupBy("termination_date_key").agg(n_rows())


@query(
    "j13_orphans_one_pass",
    "fact_policies dim_date dim_location",
    "SELECT count(*) FILTER (WHERE d1.date_key IS NULL) AS effective_date_key, count(*) FILTER (WHERE d2.date_key IS NULL) AS termination_date_key,"
    " count(*) FILTER (WHERE l.location_key IS NULL) AS location_key FROM fact_policies f"
    " LEFT JOIN (SELECT * FROM dim_date WHERE year <= 1999) d1 ON f.effective_date_key = d1.date_key"
    " LEFT JOIN (SELECT * FROM dim_date WHERE year <= 1999) d2 ON f.termination_date_key = d2.date_key"
    " LEFT JOIN dim_location l ON f.location_key = l.location_key",
)
def j13_all(ws):
    early = ws.star.dim_date.where("year <= 1999")
    wanted = [
        (key, early if dim_key == "date_key" else dim, dim_key)
        for key, dim, dim_key in edges(ws.star, "policies")[:3]
    ]
    return orphan_counts(ws.star.fact_policies, wanted)


@query(
    "j14_scalar_threshold",
    "fact_claims",
    "SELECT location_key, count(*) AS n, (SELECT round(percentile_cont(0.95) WITHIN GROUP (ORDER BY CAST(amount_paid_total AS DOUBLE)), 6)"
    " FROM fact_claims WHERE amount_paid_total > 0) AS threshold FROM fact_claims WHERE CAST(amount_paid_total AS DOUBLE) >="
    " (SELECT percentile_cont(0.95) WITHIN GROUP (ORDER BY CAST(amount_paid_total AS DOUBLE)) FROM fact_claims WHERE amount_paid_total > 0) GROUP BY 1",
)
def j14(ws):
    fact = ws.star.fact_claims
    threshold = large_loss_threshold(fact).scalar()
    large = fact.where(F.col("amount_paid_total").cast("double") >= threshold)
    return large.groupBy("location_key").agg(n_rows()).withColumn("threshold", F.round(threshold, 6))
