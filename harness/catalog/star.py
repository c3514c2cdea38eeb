"""Composite steps and views (K and V)."""

from __future__ import annotations

from pyspark.sql import functions as F

from floodledger.plans import dims, profile, silver, views
from floodledger.schemas import (
    CLAIM_COLUMNS,
    POLICY_COLUMNS,
    PROFILE_CATEGORICAL,
    PROFILE_DATES,
    PROFILE_STATE,
)
from harness.registry import query
from harness.sql import date, growth, ratio

CLAIMS_OUT = (
    "CAST(dateOfLoss AS VARCHAR) AS dateOfLoss, state, countyCode, floodZone, CAST(amountPaidOnBuildingClaim AS DOUBLE) AS amountPaidOnBuildingClaim,"
    " CAST(amountPaidOnContentsClaim AS DOUBLE) AS amountPaidOnContentsClaim, CAST(amountPaidTotal AS DOUBLE) AS amountPaidTotal,"
    " CAST(totalBuildingInsuranceCoverage AS DOUBLE) AS totalBuildingInsuranceCoverage, CAST(totalContentsInsuranceCoverage AS DOUBLE) AS totalContentsInsuranceCoverage,"
    " occupancyType, yearOfLoss, causeOfDamage, ratedFloodZone, primaryResidence, yearBuilt, numberOfFloors, elevatedBuildingIndicator,"
    " basementEnclosureCrawlspaceType, accident_year, zone_category, is_special_flood_hazard"
)
POLICIES_OUT = (
    "propertyState, countyCode, floodZone, CAST(totalPremium AS DOUBLE) AS totalPremium, CAST(deductibleAmount AS DOUBLE) AS deductibleAmount,"
    " CAST(buildingCoverage AS DOUBLE) AS buildingCoverage, CAST(contentsCoverage AS DOUBLE) AS contentsCoverage,"
    " CAST(policyEffectiveDate AS VARCHAR) AS policyEffectiveDate, CAST(policyTerminationDate AS VARCHAR) AS policyTerminationDate, constructionClass, occupancyType,"
    " numberOfFloors, primaryResidenceIndicator, crsClassificationCode, ratedFloodZone, yearBuilt, elevatedBuildingIndicator,"
    " basementEnclosureCrawlspaceType, CAST(exposure AS DOUBLE) AS exposure, zone_category, is_special_flood_hazard"
)


@query("k01_clean_claims", "claims", f"SELECT {CLAIMS_OUT} FROM claims")
def k01(ws):
    return silver.clean_claims(ws.bronze("claims"))


@query("k02_clean_policies", "policies", f"SELECT {POLICIES_OUT} FROM policies")
def k02(ws):
    return silver.clean_policies(ws.bronze("policies"))


@query(
    "k03_date_dimension",
    "claims",
    "SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, CAST(CAST(d AS DATE) AS VARCHAR) AS full_date, CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter,"
    " CAST(month(d) AS INT) AS month, monthname(d) AS month_name, CAST(CASE WHEN month(d) >= 10 THEN year(d) + 1 ELSE year(d) END AS INT) AS fiscal_year,"
    " CAST(CASE WHEN month(d) >= 10 THEN 1 WHEN month(d) <= 3 THEN 2 WHEN month(d) <= 6 THEN 3 ELSE 4 END AS INT) AS fiscal_quarter,"
    " dayname(d) AS day_of_week, CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend, count(c.dateOfLoss) AS claims"
    " FROM (SELECT unnest(generate_series(CAST(min(dateOfLoss) AS TIMESTAMP), CAST(max(dateOfLoss) AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM claims)"
    " LEFT JOIN claims c ON c.dateOfLoss = CAST(d AS DATE) GROUP BY d",
)
def k03(ws):
    """The calendar over the loss dates, with the claims of each day."""
    bounds = ws.claims.agg(F.min("dateOfLoss").alias("start"), F.max("dateOfLoss").alias("end"))
    losses = ws.claims.groupBy(F.col("dateOfLoss").alias("full_date")).agg(F.count(F.lit(1)).alias("claims"))
    days = dims.date_attributes(dims.calendar(bounds)).join(losses, "full_date", "left")
    return days.withColumn("claims", F.coalesce("claims", F.lit(0).cast("bigint")))


@query(
    "k04_location_dimension",
    "dim_location",
    "SELECT location_key, state_abbrev, state_name, county_fips, fema_region FROM dim_location",
)
def k04(ws):
    return dims.dim_location(ws.claims, ws.policies, ws.states)


@query("k05_flood_zone_dimension", "dim_flood_zone", "SELECT * FROM dim_flood_zone")
def k05(ws):
    return dims.dim_flood_zone(ws.claims, ws.policies, ws.silver.ref_flood_zone_info)


@query("k06_building_type_dimension", "dim_building_type", "SELECT * FROM dim_building_type")
def k06(ws):
    return dims.dim_building_type(ws.claims, ws.policies)


@query("k07_occupancy_dimension", "dim_occupancy", "SELECT * FROM dim_occupancy")
def k07(ws):
    return dims.dim_occupancy(ws.claims, ws.policies)


@query(
    "k08_claims_fact",
    "fact_claims",
    "SELECT date_key, location_key, flood_zone_key, building_type_key, occupancy_key, CAST(amount_paid_building AS DOUBLE) AS amount_paid_building,"
    " CAST(amount_paid_contents AS DOUBLE) AS amount_paid_contents, CAST(amount_paid_total AS DOUBLE) AS amount_paid_total,"
    " CAST(total_building_coverage AS DOUBLE) AS total_building_coverage, CAST(total_contents_coverage AS DOUBLE) AS total_contents_coverage,"
    " cause_of_damage, year_of_loss FROM fact_claims",
)
def k08(ws):
    """The fact without its surrogate key, which depends on the layout of the stored table."""
    return ws.star.fact_claims.drop("claim_sk")


@query(
    "k09_policies_fact",
    "fact_policies",
    "SELECT effective_date_key, termination_date_key, location_key, flood_zone_key, building_type_key, occupancy_key, CAST(total_premium AS DOUBLE) AS total_premium,"
    " CAST(deductible_amount AS DOUBLE) AS deductible_amount, CAST(building_coverage AS DOUBLE) AS building_coverage, CAST(contents_coverage AS DOUBLE) AS contents_coverage,"
    " CAST(exposure AS DOUBLE) AS exposure, crs_class, policy_count FROM fact_policies",
)
def k09(ws):
    return ws.star.fact_policies.drop("policy_sk")


@query(
    "k09_surrogate_keys_unique",
    "fact_claims fact_policies",
    "SELECT 'claims' AS entity, count(*) AS n, count(*) AS keys FROM fact_claims UNION ALL SELECT 'policies', count(*), count(*) FROM fact_policies",
)
def k09_unique(ws):
    def side(fact, key, entity):
        counted = fact.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(key).alias("keys"))
        return counted.select(F.lit(entity).alias("entity"), "n", "keys")

    return side(ws.star.fact_claims, "claim_sk", "claims").unionByName(
        side(ws.star.fact_policies, "policy_sk", "policies")
    )


@query(
    "k10_claims_by_state_year",
    "claims_star",
    "SELECT state_name, year, count(*) AS claims, CAST(sum(amount_paid_total) AS DOUBLE) AS total_paid FROM claims_star WHERE year >= 1998 GROUP BY 1, 2",
)
def k10(ws):
    return views.claims_by_state_year(ws.star, since=1998)


_NUMBER = "^[+-]?[0-9]+([.][0-9]+)?$"


def _column_facts(table: str, column: str, dates: list[str]) -> str:
    """Type, nulls, numeric range and date range of one column."""
    day = date(column) if column in dates else "CAST(NULL AS DATE)"
    return (
        f"SELECT '{column}' AS col, *, CASE WHEN f = 0 THEN 'float64' WHEN t = f AND f = n THEN 'bool' WHEN w = f AND f = n THEN 'int64'"
        f" WHEN k = f THEN 'float64' ELSE 'object' END AS type FROM (SELECT count({column}) AS f, count(*) AS n,"
        f" count(*) FILTER (WHERE regexp_matches({column}, '^[+-]?[0-9]+$')) AS w, count(*) FILTER (WHERE regexp_matches({column}, '{_NUMBER}')) AS k,"
        f" count(*) FILTER (WHERE lower({column}) IN ('true', 'false')) AS t, min(v) AS lo, max(v) AS hi, avg(v) AS mean, median(v) AS mid,"
        f" CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day FROM (SELECT {column},"
        f" CASE WHEN regexp_matches({column}, '{_NUMBER}') THEN CAST({column} AS DOUBLE) END AS v, {day} AS day FROM {table}))"
    )


def _profile_sql(entity: str, columns: list[str]) -> str:
    table, state, dates = f"raw_{entity}", PROFILE_STATE[entity], PROFILE_DATES[entity]
    none, empty = "CAST(NULL AS DOUBLE)", "''"

    def rows(section: str, column: str, item: str, text: str, number: str, source: str) -> str:
        return f"SELECT '{section}' AS section, {column} AS \"column\", {item} AS item, {text} AS text, {number} AS number FROM {source}"

    facts = "facts WHERE type IN ('int64', 'float64')"
    dated = "facts WHERE col IN (" + ", ".join(f"'{d}'" for d in dates) + ")"
    counts = " UNION ALL ".join(
        f"SELECT '{c}' AS col, {c} AS val, count(*) AS n FROM {table} WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in PROFILE_CATEGORICAL[entity]
    )
    ranked = f"(SELECT *, row_number() OVER (PARTITION BY col ORDER BY n DESC, val) AS r FROM ({counts})) WHERE r <= 15"
    parts = [
        rows("rows", empty, "'total'", empty, "CAST(count(*) AS DOUBLE)", table),
        rows("types", "col", "'type'", "type", none, "facts"),
        rows("nulls", "col", "'count'", empty, "CAST(n - f AS DOUBLE)", "facts"),
        rows("nulls", "col", "'percent'", empty, "CAST(n - f AS DOUBLE) / n * 100", "facts"),
        *(rows("numbers", "col", f"'{m}'", empty, f"round({e}, 4)", facts) for m, e in (("min", "lo"), ("max", "hi"), ("mean", "mean"), ("median", "mid"))),
        rows("dates", "col", "'min'", "first_day", none, dated),
        rows("dates", "col", "'max'", "last_day", none, dated),
        rows("values", "col", "CAST(r AS VARCHAR)", "val", "CAST(n AS DOUBLE)", ranked),
        rows("states", f"'{state}'", "'count'", state, "CAST(count(*) AS DOUBLE)", f"{table} GROUP BY {state}"),
    ]
    facts_cte = " UNION ALL ".join(_column_facts(table, c, dates) for c in columns)
    return f"SELECT * FROM (WITH facts AS ({facts_cte}) {' UNION ALL '.join(parts)})"


def _profile(ws, entity: str, columns: list[str]):
    """Means are summed in any order, so numeric statistics are compared to four digits."""
    rows = profile.profile_entity(ws.bronze(entity).select(*columns), entity)
    rounded = F.when(F.col("section") == "numbers", F.round("number", 4)).otherwise(F.col("number"))
    return rows.withColumn("number", rounded)


@query("k11_profile_claims", "raw_claims", _profile_sql("claims", CLAIM_COLUMNS))
def k11(ws):
    return _profile(ws, "claims", CLAIM_COLUMNS)


@query("k11_profile_policies", "raw_policies", _profile_sql("policies", POLICY_COLUMNS))
def k11_policies(ws):
    return _profile(ws, "policies", POLICY_COLUMNS)


@query(
    "k11_column_types",
    "raw_claims",
    'SELECT col AS "column", type FROM (' + " UNION ALL ".join(_column_facts("raw_claims", c, []) for c in CLAIM_COLUMNS) + ")",
)
def k11_types(ws):
    return profile.column_types(ws.bronze("claims").select(*CLAIM_COLUMNS))


@query(
    "k12_full_run",
    "raw_claims raw_policies claims policies fact_claims fact_policies",
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) AS n FROM {cte}"
        for name, cte in (
            ("bronze.claims_raw", "raw_claims"), ("bronze.policies_raw", "raw_policies"),
            ("silver.claims_cleaned", "claims"), ("silver.policies_cleaned", "policies"),
            ("gold.fact_claims", "fact_claims"), ("gold.fact_policies", "fact_policies"),
        )
    ),
)
def k12(ws):
    """Everything from the raw rows to the checks, built anew, then counted."""
    result = ws.fresh_run()
    tables = {
        "bronze.claims_raw": result.bronze["claims"],
        "bronze.policies_raw": result.bronze["policies"],
        "silver.claims_cleaned": result.silver.claims_cleaned,
        "silver.policies_cleaned": result.silver.policies_cleaned,
        "gold.fact_claims": result.star.fact_claims,
        "gold.fact_policies": result.star.fact_policies,
    }
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n") for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --------------------------------------------------------------------------------- views


def _drill(by: str, claims: str, policies: str) -> str:
    keys = [k.strip() for k in by.split(",")]
    match = " AND ".join(f"c.{k} = p.{k}" for k in keys)
    return (
        f"(SELECT {by}, {claims} FROM claims_star GROUP BY ALL) c FULL OUTER JOIN"
        f" (SELECT {by}, {policies} FROM policies_star GROUP BY ALL) p ON {match}"
    )


def _keys(by: str) -> str:
    return ", ".join(f"COALESCE(c.{k.strip()}, p.{k.strip()}) AS {k.strip()}" for k in by.split(","))


def _loss_ratio_sql(by: str) -> str:
    return (
        f"SELECT {_keys(by)}, CAST(COALESCE(paid, 0) AS DOUBLE) AS total_claims_paid, CAST(COALESCE(premium, 0) AS DOUBLE) AS total_premium,"
        f" CAST(COALESCE(exposure, 0) AS DOUBLE) AS total_exposure, {ratio('COALESCE(paid, 0)', 'premium')} AS loss_ratio FROM "
        + _drill(by, "sum(amount_paid_total) AS paid", "sum(total_premium) AS premium, sum(exposure) AS exposure")
    )


LOSS_RATIO_STATE = _loss_ratio_sql("state_name, year")
LOSS_RATIO_LOCATION = _loss_ratio_sql("state_name, state_abbrev, county_fips, year")


@query("v01_loss_ratio_by_state", "claims_star policies_star", LOSS_RATIO_STATE)
def v01(ws):
    return views.loss_ratio(ws.star, "state")


@query("v01_loss_ratio_by_location", "claims_star policies_star", LOSS_RATIO_LOCATION)
def v01_location(ws):
    return views.loss_ratio(ws.star, "location")


@query(
    "v02_frequency_severity",
    "claims_star policies_star",
    f"SELECT {_keys('zone_category, year')}, COALESCE(claims, 0) AS claim_count, CAST(COALESCE(paid, 0) AS DOUBLE) AS total_paid,"
    f" CAST(COALESCE(exposure, 0) AS DOUBLE) AS total_exposure, {ratio('COALESCE(claims, 0)', 'exposure')} AS frequency,"
    f" {ratio('COALESCE(paid, 0)', 'COALESCE(claims, 0)')} AS avg_severity FROM "
    + _drill("zone_category, year", "count(*) AS claims, sum(amount_paid_total) AS paid", "sum(exposure) AS exposure"),
)
def v02(ws):
    return views.frequency_severity(ws.star)


_P95 = "(SELECT percentile_cont(0.95) WITHIN GROUP (ORDER BY CAST(amount_paid_total AS DOUBLE)) FROM fact_claims WHERE amount_paid_total > 0)"
_LARGE = f"CAST(amount_paid_total AS DOUBLE) >= {_P95}"


@query(
    "v03_large_loss_concentration",
    "claims_star",
    f"SELECT state_name, CAST(sum(CASE WHEN {_LARGE} THEN 1 ELSE 0 END) AS BIGINT) AS large_loss_count,"
    f" CAST(sum(CASE WHEN {_LARGE} THEN amount_paid_total ELSE 0 END) AS DOUBLE) AS large_loss_total, CAST(sum(amount_paid_total) AS DOUBLE) AS total_paid,"
    f" {ratio(f'sum(CASE WHEN {_LARGE} THEN amount_paid_total ELSE 0 END)', 'sum(amount_paid_total)')} * 100 AS pct_of_total_paid,"
    f" round({_P95}, 6) AS p95_threshold FROM claims_star GROUP BY 1",
)
def v03(ws):
    return views.large_loss_concentration(ws.star).withColumn("p95_threshold", F.round("p95_threshold", 6))


@query(
    "v04_severity_by_zone",
    "claims_star",
    f"SELECT zone_category, zone_description, count(*) AS claim_count, {ratio('sum(amount_paid_total)', 'count(*)')} AS avg_severity,"
    f" round(median(CAST(amount_paid_total AS DOUBLE)), 6) AS median_severity, {ratio('sum(amount_paid_building)', 'count(*)')} AS avg_building_paid,"
    f" {ratio('sum(amount_paid_contents)', 'count(*)')} AS avg_contents_paid, {ratio('sum(amount_paid_building)', 'sum(amount_paid_total)')} AS building_share,"
    f" {ratio('sum(amount_paid_contents)', 'sum(amount_paid_total)')} AS contents_share FROM claims_star WHERE amount_paid_total > 0 GROUP BY 1, 2",
)
def v04(ws):
    return views.severity_by_zone(ws.star).withColumn("median_severity", F.round("median_severity", 6))


def _adequacy(by: str) -> str:
    pure = ratio("COALESCE(paid, 0)", "exposure")
    avg = ratio("premium", "n")
    return (
        f"SELECT {_keys(by)}, CAST(COALESCE(paid, 0) AS DOUBLE) AS total_claims, CAST(COALESCE(exposure, 0) AS DOUBLE) AS total_exposure,"
        f" COALESCE(n, 0) AS policy_count, {pure} AS pure_premium, {avg} AS avg_premium, CASE WHEN {avg} >= {pure} THEN 'Adequate'"
        f" WHEN {avg} IS NULL OR exposure IS NULL THEN 'No Policy Data' ELSE 'Inadequate' END AS adequacy_flag FROM "
        + _drill(by, "sum(amount_paid_total) AS paid", "sum(exposure) AS exposure, sum(total_premium) AS premium, count(*) AS n")
    )


@query("v05_premium_adequacy", "claims_star policies_star", _adequacy("occupancy_type, construction_class"))
def v05(ws):
    return views.premium_adequacy(ws.star)


@query("v05_premium_adequacy_by_occupancy", "claims_star policies_star", _adequacy("occupancy_type"))
def v05_occupancy(ws):
    return views.premium_adequacy(ws.star, ["occupancy_type"])


@query(
    "v06_claims_development",
    "fact_claims",
    f"SELECT year_of_loss, count(*) AS claim_count, CAST(sum(amount_paid_total) AS DOUBLE) AS total_paid, {ratio('sum(amount_paid_total)', 'count(*)')} AS avg_paid_per_claim,"
    " CAST(sum(amount_paid_building) AS DOUBLE) AS total_building_paid, CAST(sum(amount_paid_contents) AS DOUBLE) AS total_contents_paid"
    " FROM fact_claims WHERE year_of_loss IS NOT NULL GROUP BY 1",
)
def v06(ws):
    return views.claims_development(ws.star)


@query(
    "v07_portfolio_summary",
    "claims_star policies_star",
    "SELECT year, total_policies, CAST(exposure AS DOUBLE) AS total_exposure, CAST(premium AS DOUBLE) AS total_premium, CAST(paid AS DOUBLE) AS total_claims_paid,"
    f" claim_count, {ratio('paid', 'premium')} AS loss_ratio, {ratio('paid', 'claim_count')} AS avg_severity, CAST(pp AS DOUBLE) AS prior_year_premium,"
    f" {growth('premium', 'pp')} AS premium_growth_pct, CAST(pc AS DOUBLE) AS prior_year_claims, {growth('paid', 'pc')} AS claims_growth_pct FROM"
    " (SELECT *, lag(premium) OVER (ORDER BY year) AS pp, lag(paid) OVER (ORDER BY year) AS pc FROM (SELECT p.year, total_policies, exposure, premium,"
    " COALESCE(paid, 0) AS paid, COALESCE(n, 0) AS claim_count FROM (SELECT year, count(*) AS total_policies, sum(exposure) AS exposure, sum(total_premium) AS premium"
    " FROM policies_star GROUP BY 1) p LEFT JOIN (SELECT year, sum(amount_paid_total) AS paid, count(*) AS n FROM claims_star GROUP BY 1) c ON c.year = p.year))",
)
def v07(ws):
    return views.portfolio_summary(ws.star)


@query(
    "v08_earned_premium",
    "policies_star",
    "SELECT state_name, year, CAST(sum(total_premium * exposure) AS DOUBLE) AS earned_premium, CAST(sum(total_premium) AS DOUBLE) AS written_premium"
    " FROM policies_star GROUP BY 1, 2",
)
def v08(ws):
    return views.earned_premium(ws.star)
