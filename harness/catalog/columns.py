"""Projections, predicates, derived columns and scalar functions (P, B and F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from floodledger.functions import cleaning, derive
from floodledger.plans.silver import rejected
from harness import sql as q
from harness.registry import query
from harness.sql import band, date, date_key, hazard, integer, money, ratio, zone_category

def n_rows():
    return F.count(F.lit(1)).alias("n")


def counted(df, **columns):
    """Rows per combination of the given expressions."""
    return df.groupBy(*(c.alias(n) for n, c in columns.items())).agg(n_rows())


# ------------------------------------------------------------- projections, predicates


@query(
    "p01_project_and_rename",
    "claims",
    "SELECT causeOfDamage AS cause_of_damage, yearOfLoss AS year_of_loss, count(*) AS n FROM claims GROUP BY 1, 2",
)
def p01(ws):
    renamed = ws.claims.select(F.col("causeOfDamage").alias("cause_of_damage"), F.col("yearOfLoss").alias("year_of_loss"))
    return renamed.groupBy("cause_of_damage", "year_of_loss").agg(n_rows())


@query(
    "p02_first_non_null",
    "raw_claims",
    "SELECT COALESCE(ratedFloodZone, floodZoneCurrent) AS zone, count(*) AS n FROM raw_claims GROUP BY 1",
)
def p02(ws):
    return counted(ws.bronze("claims"), zone=F.coalesce("ratedFloodZone", "floodZoneCurrent"))


@query(
    "p03_null_defaults",
    "raw_claims",
    f"SELECT COALESCE(basementEnclosureCrawlspaceType, 'Unknown') AS basement, COALESCE(occupancyType, 'Unknown') AS occupancy,"
    f" count(*) AS n, CAST(sum({money('amountPaidOnBuildingClaim')}) AS DOUBLE) AS paid FROM raw_claims GROUP BY 1, 2",
)
def p03(ws):
    return (
        ws.bronze("claims")
        .groupBy(
            cleaning.or_unknown(F.col("basementEnclosureCrawlspaceType")).alias("basement"),
            cleaning.or_unknown(F.col("occupancyType")).alias("occupancy"),
        )
        .agg(n_rows(), F.sum(cleaning.to_money(F.col("amountPaidOnBuildingClaim"))).alias("paid"))
    )


@query(
    "p04_rejected_dates",
    "raw_claims",
    f"SELECT dateOfLoss AS text, state, count(*) AS n FROM raw_claims WHERE ({date('dateOfLoss')}) IS NULL GROUP BY 1, 2",
)
def p04(ws):
    return counted(rejected(ws.bronze("claims"), "dateOfLoss"), text=F.col("dateOfLoss"), state=F.col("state"))


@query(
    "p05_null_filters",
    "claims",
    "SELECT state, count(*) AS n FROM claims WHERE countyCode IS NULL AND floodZone IS NOT NULL GROUP BY 1",
)
def p05(ws):
    rows = ws.claims.where(F.col("countyCode").isNull() & F.col("floodZone").isNotNull())
    return counted(rows, state=F.col("state"))


@query(
    "p06_comparisons",
    "claims",
    "SELECT state, count(*) AS n FROM claims WHERE accident_year >= 1998 AND amountPaidTotal > 0"
    " AND amountPaidOnContentsClaim > amountPaidOnBuildingClaim GROUP BY 1",
)
def p06(ws):
    rows = ws.claims.where(
        (F.col("accident_year") >= 1998)
        & (F.col("amountPaidTotal") > 0)
        & (F.col("amountPaidOnContentsClaim") > F.col("amountPaidOnBuildingClaim"))
    )
    return counted(rows, state=F.col("state"))


@query(
    "p07_between",
    "claims",
    "SELECT accident_year, count(*) AS n FROM claims WHERE accident_year BETWEEN 1996 AND 1998 GROUP BY 1",
)
def p07(ws):
    return counted(ws.claims.where(F.col("accident_year").between(1996, 1998)), accident_year=F.col("accident_year"))


@query(
    "p08_in_list",
    "policies",
    "SELECT occupancyType AS occupancy, count(*) AS n FROM policies WHERE occupancyType IN ('1', '2', '3') GROUP BY 1",
)
def p08(ws):
    return counted(ws.policies.where(F.col("occupancyType").isin("1", "2", "3")), occupancy=F.col("occupancyType"))


@query(
    "p09_prefix",
    "claims",
    "SELECT floodZone AS zone, count(*) AS n FROM claims WHERE floodZone LIKE 'A%' GROUP BY 1",
)
def p09(ws):
    return counted(ws.claims.where(F.col("floodZone").startswith("A")), zone=F.col("floodZone"))


@query(
    "p10_searched_case",
    "policies",
    "SELECT CASE WHEN exposure = 0 THEN 'none' WHEN exposure < 0.5 THEN 'short' WHEN exposure < 1 THEN 'part' ELSE 'full' END AS term,"
    " count(*) AS n FROM policies GROUP BY 1",
)
def p10(ws):
    term = F.col("exposure")
    label = F.when(term == 0, "none").when(term < 0.5, "short").when(term < 1, "part").otherwise("full")
    return counted(ws.policies, term=label)


@query(
    "p11_constant_columns",
    "claims",
    "SELECT 'N/A' AS construction_class, 1 AS policy_count, count(*) AS n FROM claims",
)
def p11(ws):
    return counted(ws.claims, construction_class=F.lit("N/A"), policy_count=F.lit(1))


@query("p12_distinct", "claims", "SELECT DISTINCT state, countyCode AS county FROM claims")
def p12(ws):
    return ws.claims.select("state", F.col("countyCode").alias("county")).distinct()


# ---------------------------------------------------------------------- derived columns

_RAW_ZONE = "upper(trim(COALESCE(ratedFloodZone, floodZoneCurrent)))"


def _zone():
    return derive.flood_zone(F.col("ratedFloodZone"), F.col("floodZoneCurrent"))


@query(
    "b01_zone_category",
    "raw_claims",
    f"SELECT ratedFloodZone AS rated, floodZoneCurrent AS cur, {zone_category(_RAW_ZONE)} AS category, count(*) AS n"
    " FROM raw_claims GROUP BY 1, 2, 3",
)
def b01(ws):
    return counted(
        ws.bronze("claims"), rated=F.col("ratedFloodZone"), cur=F.col("floodZoneCurrent"),
        category=derive.zone_category(_zone()),
    )


@query(
    "b02_special_hazard",
    "raw_policies",
    f"SELECT {_RAW_ZONE} AS zone, {hazard(_RAW_ZONE)} AS hazard, count(*) AS n FROM raw_policies GROUP BY 1, 2",
)
def b02(ws):
    return counted(ws.bronze("policies"), zone=_zone(), hazard=derive.special_hazard(_zone()))


@query(
    "b03_total_paid",
    "raw_claims",
    f"SELECT state, CAST(sum({money('amountPaidOnBuildingClaim')} + {money('amountPaidOnContentsClaim')}) AS DOUBLE) AS paid"
    " FROM raw_claims GROUP BY 1",
)
def b03(ws):
    total = cleaning.to_money(F.col("amountPaidOnBuildingClaim")) + cleaning.to_money(F.col("amountPaidOnContentsClaim"))
    return ws.bronze("claims").groupBy("state").agg(F.sum(total).alias("paid"))


@query(
    "b04_accident_year",
    "raw_claims",
    f"SELECT CAST(year({date('dateOfLoss')}) AS INT) AS accident_year, {integer('yearOfLoss')} AS stated, count(*) AS n"
    " FROM raw_claims GROUP BY 1, 2",
)
def b04(ws):
    return counted(
        ws.bronze("claims"), accident_year=F.year(cleaning.to_date(F.col("dateOfLoss"))),
        stated=cleaning.to_int(F.col("yearOfLoss")),
    )


@query(
    "b05_exposure",
    "policies",
    "SELECT datediff('day', policyEffectiveDate, policyTerminationDate) AS days, CAST(exposure AS DOUBLE) AS exposure, count(*) AS n"
    " FROM policies GROUP BY 1, 2",
)
def b05(ws):
    days = F.datediff("policyTerminationDate", "policyEffectiveDate").cast("bigint")
    term = derive.exposure(F.col("policyEffectiveDate"), F.col("policyTerminationDate"))
    return counted(ws.policies, days=days, exposure=term)


@query(
    "b06_year_built",
    "raw_claims",
    "SELECT substr(trim(originalConstructionDate), 1, 4) AS year_built, count(*) AS n FROM raw_claims GROUP BY 1",
)
def b06(ws):
    return counted(ws.bronze("claims"), year_built=derive.year_built(F.col("originalConstructionDate")))


@query(
    "b07_year_built_band",
    "claims",
    f"SELECT yearBuilt AS year_built, {band('yearBuilt')} AS band, count(*) AS n FROM claims GROUP BY 1, 2",
)
def b07(ws):
    return counted(ws.claims, year_built=F.col("yearBuilt"), band=derive.year_built_band(F.col("yearBuilt")))


@query(
    "b08_elevated_flag",
    "raw_policies",
    "SELECT elevatedBuildingIndicator AS indicator, CASE WHEN upper(elevatedBuildingIndicator) = 'TRUE' THEN 1 ELSE 0 END AS elevated,"
    " count(*) AS n FROM raw_policies GROUP BY 1, 2",
)
def b08(ws):
    col = F.col("elevatedBuildingIndicator")
    return counted(ws.bronze("policies"), indicator=col, elevated=derive.elevated_flag(col))


@query(
    "b09_residential_flag",
    "claims",
    "SELECT occupancyType AS occupancy, CASE WHEN occupancyType IN ('1', '2', '3', '11', '12', '15', '18') THEN 1 ELSE 0 END AS residential,"
    " count(*) AS n FROM claims GROUP BY 1, 2",
)
def b09(ws):
    col = F.col("occupancyType")
    return counted(ws.claims, occupancy=col, residential=derive.residential_flag(col))


@query(
    "b10_date_key",
    "policies",
    f"SELECT {date_key('policyTerminationDate')} AS date_key, count(*) AS n FROM policies GROUP BY 1",
)
def b10(ws):
    return counted(ws.policies, date_key=derive.date_key(F.col("policyTerminationDate")))


@query(
    "b11_fiscal_calendar",
    "claims",
    "SELECT CAST(CASE WHEN month(dateOfLoss) >= 10 THEN year(dateOfLoss) + 1 ELSE year(dateOfLoss) END AS INT) AS fiscal_year,"
    " CASE WHEN month(dateOfLoss) IN (10, 11, 12) THEN 1 WHEN month(dateOfLoss) IN (1, 2, 3) THEN 2"
    " WHEN month(dateOfLoss) IN (4, 5, 6) THEN 3 ELSE 4 END AS fiscal_quarter, count(*) AS n FROM claims GROUP BY 1, 2",
)
def b11(ws):
    day = F.col("dateOfLoss")
    return counted(ws.claims, fiscal_year=derive.fiscal_year(day), fiscal_quarter=derive.fiscal_quarter(day))


@query(
    "b12_weekend_flag",
    "claims",
    "SELECT CASE WHEN dayofweek(dateOfLoss) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend, count(*) AS n FROM claims GROUP BY 1",
)
def b12(ws):
    return counted(ws.claims, is_weekend=derive.weekend_flag(F.col("dateOfLoss")))


@query(
    "b13_large_loss_flag",
    "claims",
    "SELECT CASE WHEN CAST(amountPaidTotal AS DOUBLE) >= (SELECT percentile_cont(0.95) WITHIN GROUP (ORDER BY CAST(amountPaidTotal AS DOUBLE))"
    " FROM claims WHERE amountPaidTotal > 0) THEN 1 ELSE 0 END AS is_large, count(*) AS n FROM claims GROUP BY 1",
)
def b13(ws):
    from floodledger.plans.views import large_loss_threshold

    paid = ws.claims.select(F.col("amountPaidTotal").alias("amount_paid_total"))
    threshold = large_loss_threshold(paid).scalar()
    flagged = paid.select(derive.large_loss_flag(F.col("amount_paid_total").cast("double"), threshold).alias("is_large"))
    return flagged.groupBy("is_large").agg(n_rows())


@query(
    "b14_adequacy_flag",
    "policies",
    "SELECT countyCode AS county, CASE WHEN a >= b THEN 'Adequate' WHEN a IS NULL OR e IS NULL THEN 'No Policy Data' ELSE 'Inadequate' END AS flag"
    f" FROM (SELECT countyCode, {ratio('sum(totalPremium)', 'count(*)')} AS a,"
    f" {ratio('sum(deductibleAmount) * 80000', 'sum(exposure)')} AS b, sum(exposure) AS e FROM policies GROUP BY 1)",
)
def b14(ws):
    per = ws.policies.groupBy("countyCode").agg(
        derive.safe_ratio(F.sum("totalPremium"), F.count(F.lit(1))).alias("a"),
        derive.safe_ratio(F.sum("deductibleAmount") * 80000, F.sum("exposure")).alias("b"),
        F.sum("exposure").alias("e"),
    )
    return per.select(F.col("countyCode").alias("county"), derive.adequacy_flag(F.col("a"), F.col("b"), F.col("e")).alias("flag"))


@query(
    "b15_safe_ratio",
    "policies",
    f"SELECT floodZone AS zone, {ratio('sum(totalPremium)', 'sum(CASE WHEN exposure >= 1 THEN exposure ELSE 0 END)')} AS ratio"
    " FROM policies GROUP BY 1",
)
def b15(ws):
    full = F.when(F.col("exposure") >= 1, F.col("exposure")).otherwise(0)
    return ws.policies.groupBy(F.col("floodZone").alias("zone")).agg(
        derive.safe_ratio(F.sum("totalPremium"), F.sum(full)).alias("ratio")
    )


@query(
    "b16_growth_percent",
    "claims",
    "SELECT accident_year, " + q.growth("paid", "prev") + " AS growth FROM (SELECT accident_year, paid, lag(paid) OVER (ORDER BY accident_year) AS prev"
    " FROM (SELECT accident_year, sum(amountPaidTotal) AS paid FROM claims GROUP BY 1))",
)
def b16(ws):
    from pyspark.sql.window import Window

    yearly = ws.claims.groupBy("accident_year").agg(F.sum("amountPaidTotal").alias("paid"))
    prev = F.lag("paid").over(Window.orderBy("accident_year"))
    lagged = yearly.withColumn("prev", prev)
    return lagged.select("accident_year", derive.growth_percent(F.col("paid"), F.col("prev")).alias("growth"))


# --------------------------------------------------------------------- scalar functions


@query(
    "f01_safe_cast_date",
    "raw_claims",
    f"SELECT dateOfLoss AS text, CAST({date('dateOfLoss')} AS VARCHAR) AS day, count(*) AS n FROM raw_claims GROUP BY 1, 2",
)
def f01(ws):
    return counted(ws.bronze("claims"), text=F.col("dateOfLoss"), day=cleaning.to_date(F.col("dateOfLoss")))


@query(
    "f02_safe_cast_money",
    "raw_policies",
    f"SELECT buildingDeductibleCode AS text, CAST({money('buildingDeductibleCode')} AS DOUBLE) AS amount, count(*) AS n"
    " FROM raw_policies GROUP BY 1, 2",
)
def f02(ws):
    col = F.col("buildingDeductibleCode")
    return counted(ws.bronze("policies"), text=col, amount=cleaning.to_money(col))


@query(
    "f03_safe_cast_int",
    "raw_claims",
    f"SELECT occupancyType AS text, {integer('occupancyType')} AS number, count(*) AS n FROM raw_claims GROUP BY 1, 2",
)
def f03(ws):
    return counted(ws.bronze("claims"), text=F.col("occupancyType"), number=cleaning.to_int(F.col("occupancyType")))


@query(
    "f04_casts",
    "claims",
    "SELECT CAST(CAST(accident_year AS VARCHAR) AS INT) AS accident_year, CAST(sum(CAST(amountPaidTotal AS DECIMAL(10,2))) AS DOUBLE) AS paid,"
    " CAST(max(accident_year) AS DOUBLE) AS as_float FROM claims GROUP BY 1",
)
def f04(ws):
    return ws.claims.groupBy(F.col("accident_year").cast("string").cast("int").alias("accident_year")).agg(
        F.sum(F.col("amountPaidTotal").cast("decimal(10,2)")).alias("paid"),
        F.max("accident_year").cast("double").alias("as_float"),
    )


@query(
    "f05_date_to_compact_text",
    "claims",
    "SELECT strftime(dateOfLoss, '%Y%m%d') AS compact, count(*) AS n FROM claims GROUP BY 1",
)
def f05(ws):
    return counted(ws.claims, compact=F.date_format("dateOfLoss", "yyyyMMdd"))


@query(
    "f06_trim",
    "raw_claims",
    "SELECT trim(ratedFloodZone) AS zone, count(*) AS n FROM raw_claims GROUP BY 1",
)
def f06(ws):
    return counted(ws.bronze("claims"), zone=F.trim("ratedFloodZone"))


@query(
    "f07_left",
    "raw_policies",
    "SELECT left(originalConstructionDate, 4) AS year_text, count(*) AS n FROM raw_policies GROUP BY 1",
)
def f07(ws):
    return counted(ws.bronze("policies"), year_text=F.left("originalConstructionDate", F.lit(4)))


@query("f08_upper", "raw_claims", "SELECT upper(ratedFloodZone) AS zone, count(*) AS n FROM raw_claims GROUP BY 1")
def f08(ws):
    return counted(ws.bronze("claims"), zone=F.upper("ratedFloodZone"))


@query(
    "f09_coalesce",
    "raw_policies",
    "SELECT COALESCE(ratedFloodZone, floodZoneCurrent, 'none') AS zone, count(*) AS n FROM raw_policies GROUP BY 1",
)
def f09(ws):
    return counted(ws.bronze("policies"), zone=F.coalesce("ratedFloodZone", "floodZoneCurrent", F.lit("none")))


@query(
    "f10_nullif",
    "policies",
    "SELECT CAST(NULLIF(exposure, 0) AS DOUBLE) AS term, count(*) AS n FROM policies GROUP BY 1",
)
def f10(ws):
    return counted(ws.policies, term=F.nullif(F.col("exposure"), F.lit(0).cast("decimal(8,6)")))


@query(
    "f11_year_month",
    "claims",
    "SELECT CAST(year(dateOfLoss) AS INT) AS y, CAST(month(dateOfLoss) AS INT) AS m, count(*) AS n FROM claims GROUP BY 1, 2",
)
def f11(ws):
    return counted(ws.claims, y=F.year("dateOfLoss"), m=F.month("dateOfLoss"))


@query(
    "f12_quarter_weekday",
    "claims",
    "SELECT CAST(quarter(dateOfLoss) AS INT) AS q, CAST(dayofweek(dateOfLoss) + 1 AS INT) AS weekday, count(*) AS n FROM claims GROUP BY 1, 2",
)
def f12(ws):
    return counted(ws.claims, q=F.quarter("dateOfLoss"), weekday=F.dayofweek("dateOfLoss"))


@query(
    "f13_date_names",
    "claims",
    "SELECT monthname(dateOfLoss) AS month_name, dayname(dateOfLoss) AS day_name, count(*) AS n FROM claims GROUP BY 1, 2",
)
def f13(ws):
    return counted(ws.claims, month_name=F.date_format("dateOfLoss", "MMMM"), day_name=F.date_format("dateOfLoss", "EEEE"))


@query(
    "f14_datediff",
    "policies",
    "SELECT datediff('day', policyEffectiveDate, policyTerminationDate) AS days, count(*) AS n FROM policies GROUP BY 1",
)
def f14(ws):
    days = F.datediff("policyTerminationDate", "policyEffectiveDate").cast("bigint")
    return counted(ws.policies, days=days)


@query(
    "f15_dateadd",
    "claims",
    "SELECT CAST(CAST(dateOfLoss + 1 AS DATE) AS VARCHAR) AS next_day, count(*) AS n FROM claims GROUP BY 1",
)
def f15(ws):
    return counted(ws.claims, next_day=F.date_add("dateOfLoss", 1))


@query(
    "f16_current_time",
    "raw_claims",
    "SELECT state, count(*) AS n, count(*) FILTER (WHERE to_timestamp(1700000000 + ingest_seq) < now()) AS before_now,"
    " CAST(max(1700000000 + ingest_seq) AS BIGINT) AS newest FROM raw_claims GROUP BY 1",
)
def f16(ws):
    """Ingestion times by state, and how many of them lie before the current time."""
    rows = ws.bronze("claims").withColumn("now", F.current_timestamp())
    return rows.groupBy("state").agg(
        n_rows(),
        F.count_if(F.col("ingestion_timestamp") < F.col("now")).alias("before_now"),
        F.unix_timestamp(F.max("ingestion_timestamp")).alias("newest"),
    )


@query(
    "f17_text_concatenation",
    "claims",
    "SELECT 'state ' || state || ': ' || CAST(count(*) AS VARCHAR) || ' claims' AS line FROM claims GROUP BY state",
)
def f17(ws):
    line = F.concat(F.lit("state "), F.col("state"), F.lit(": "), F.col("n").cast("string"), F.lit(" claims"))
    return ws.claims.groupBy("state").agg(n_rows()).select(line.alias("line"))


@query(
    "f18_arithmetic",
    "policies",
    "SELECT propertyState AS state, CAST(sum(buildingCoverage + contentsCoverage) AS DOUBLE) AS cover,"
    " CAST(sum(buildingCoverage - contentsCoverage) AS DOUBLE) AS gap, CAST(sum(totalPremium * exposure) AS DOUBLE) AS earned,"
    f" {ratio('sum(totalPremium)', 'sum(buildingCoverage)')} AS rate FROM policies GROUP BY 1",
)
def f18(ws):
    building, contents = F.col("buildingCoverage"), F.col("contentsCoverage")
    return ws.policies.groupBy(F.col("propertyState").alias("state")).agg(
        F.sum(building + contents).alias("cover"),
        F.sum(building - contents).alias("gap"),
        F.sum(F.col("totalPremium") * F.col("exposure")).alias("earned"),
        derive.safe_ratio(F.sum("totalPremium"), F.sum(building)).alias("rate"),
    )


@query(
    "f19_date_or_null",
    "raw_policies",
    f"SELECT count(*) AS n, count({date('policyTerminationDate')}) AS usable, CAST(min({date('policyTerminationDate')}) AS VARCHAR) AS first_day"
    " FROM raw_policies",
)
def f19(ws):
    day = cleaning.to_date(F.col("policyTerminationDate"))
    return ws.bronze("policies").agg(n_rows(), F.count(day).alias("usable"), F.min(day).alias("first_day"))


@query(
    "f20_missing_test",
    "landed_claims",
    "SELECT count(*) FILTER (WHERE amountPaidOnContentsClaim IS NULL) AS nulls,"
    " count(*) FILTER (WHERE amountPaidOnContentsClaim IN ('', 'nan', 'None')) AS tokens FROM landed_claims",
)
def f20(ws):
    from harness.catalog.reading import landed

    col = F.col("amountPaidOnContentsClaim")
    return landed(ws, "claims").agg(
        F.count_if(col.isNull()).alias("nulls"), F.count_if(col.isin("", "nan", "None")).alias("tokens")
    )


@query(
    "q06_normalised_codes",
    "raw_claims",
    f"SELECT occupancyType AS text, {q.code('occupancyType')} AS code, {q.code('numberOfFloorsInTheInsuredBuilding')} AS floors, count(*) AS n"
    " FROM raw_claims GROUP BY 1, 2, 3",
)
def q06(ws):
    return counted(
        ws.bronze("claims"), text=F.col("occupancyType"), code=cleaning.code(F.col("occupancyType")),
        floors=cleaning.code(F.col("numberOfFloorsInTheInsuredBuilding")),
    )
