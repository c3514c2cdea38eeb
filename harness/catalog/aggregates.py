"""Aggregations, windows, sorting, set operations and generators (A, W and O)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from floodledger.functions import derive
from floodledger.functions.cleaning import to_date
from floodledger.operators.dedup import duplicate_keys, latest_per_key, surplus_per_key
from floodledger.operators.members import distinct_union, number_members
from floodledger.operators.order_stats import exact_percentiles
from floodledger.operators.shares import null_counts, share_of_total, value_counts
from floodledger.operators.topn import top_per_group
from floodledger.plans import dims, profile
from floodledger.schemas import CLAIM_COLUMNS, CLAIM_KEY, POLICY_COLUMNS, POLICY_KEY
from harness.registry import query
from harness.sql import date, percent2, ratio

def n_rows():
    return F.count(F.lit(1)).alias("n")


@query(
    "a01_count_all",
    "raw_claims claims fact_claims",
    "SELECT 'bronze' AS layer, count(*) AS n FROM raw_claims UNION ALL SELECT 'silver', count(*) FROM claims"
    " UNION ALL SELECT 'gold', count(*) FROM fact_claims",
)
def a01(ws):
    layers = {"bronze": ws.bronze("claims"), "silver": ws.claims, "gold": ws.star.fact_claims}
    counts = [df.agg(n_rows()).select(F.lit(layer).alias("layer"), "n") for layer, df in layers.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("a02_count_grouped", "claims", "SELECT zone_category, accident_year, count(*) AS n FROM claims GROUP BY 1, 2")
def a02(ws):
    return ws.claims.groupBy("zone_category", "accident_year").agg(n_rows())


@query(
    "a03_count_distinct",
    "claims",
    "SELECT state, accident_year, count(DISTINCT dateOfLoss) AS days, count(DISTINCT countyCode) AS counties FROM claims GROUP BY 1, 2",
)
def a03(ws):
    return ws.claims.groupBy("state", "accident_year").agg(
        F.countDistinct("dateOfLoss").alias("days"), F.countDistinct("countyCode").alias("counties")
    )


@query(
    "a04_sum",
    "policies",
    "SELECT propertyState AS state, CAST(sum(totalPremium) AS DOUBLE) AS premium, CAST(sum(exposure) AS DOUBLE) AS exposure,"
    " CAST(sum(buildingCoverage) AS DOUBLE) AS building FROM policies GROUP BY 1",
)
def a04(ws):
    return ws.policies.groupBy(F.col("propertyState").alias("state")).agg(
        F.sum("totalPremium").alias("premium"), F.sum("exposure").alias("exposure"), F.sum("buildingCoverage").alias("building")
    )


@query(
    "a05_average",
    "policies",
    f"SELECT occupancyType AS occupancy, {ratio('sum(totalPremium)', 'count(totalPremium)')} AS avg_premium,"
    f" {ratio('sum(exposure)', 'count(exposure)')} AS avg_exposure FROM policies GROUP BY 1",
)
def a05(ws):
    """Exact decimal sum over count, divided as doubles: the same in every engine."""

    def mean(column: str):
        return derive.safe_ratio(F.sum(column), F.count(column))

    return ws.policies.groupBy(F.col("occupancyType").alias("occupancy")).agg(
        mean("totalPremium").alias("avg_premium"), mean("exposure").alias("avg_exposure")
    )


@query(
    "a06_min_max",
    "claims",
    "SELECT state, CAST(min(dateOfLoss) AS VARCHAR) AS first_day, CAST(max(dateOfLoss) AS VARCHAR) AS last_day,"
    " CAST(min(amountPaidTotal) AS DOUBLE) AS lowest, CAST(max(amountPaidTotal) AS DOUBLE) AS highest FROM claims GROUP BY 1",
)
def a06(ws):
    return ws.claims.groupBy("state").agg(
        F.min("dateOfLoss").alias("first_day"), F.max("dateOfLoss").alias("last_day"),
        F.min("amountPaidTotal").alias("lowest"), F.max("amountPaidTotal").alias("highest"),
    )


@query(
    "a07_conditional_sum",
    "claims",
    "SELECT state, CAST(sum(CASE WHEN amountPaidTotal < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negatives,"
    " CAST(sum(CASE WHEN is_special_flood_hazard = 1 THEN amountPaidTotal ELSE 0 END) AS DOUBLE) AS hazard_paid FROM claims GROUP BY 1",
)
def a07(ws):
    hazard_paid = F.when(F.col("is_special_flood_hazard") == 1, F.col("amountPaidTotal")).otherwise(0)
    return ws.claims.groupBy("state").agg(
        F.count_if(F.col("amountPaidTotal") < 0).alias("negatives"), F.sum(hazard_paid).alias("hazard_paid")
    )


@query(
    "a08_continuous_percentile",
    "claims",
    "SELECT round(percentile_cont(0.95) WITHIN GROUP (ORDER BY CAST(amountPaidTotal AS DOUBLE)), 6) AS p95 FROM claims WHERE amountPaidTotal > 0",
)
def a08(ws):
    positive = ws.claims.where("amountPaidTotal > 0")
    return exact_percentiles(positive, "amountPaidTotal", [0.95]).select(F.round("percentile", 6).alias("p95"))


@query(
    "a08_percentiles_by_group",
    "",
    "SELECT grp, round(percentile_cont(0.25) WITHIN GROUP (ORDER BY v), 6) AS p25, round(percentile_cont(0.5) WITHIN GROUP (ORDER BY v), 6) AS p50,"
    " round(percentile_cont(0.99) WITHIN GROUP (ORDER BY v), 6) AS p99 FROM (SELECT l_returnflag || l_linestatus AS grp,"
    " CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS v FROM lineitem) GROUP BY 1",
)
def a08_groups(ws):
    rows = ws.table("lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("grp"), F.col("l_extendedprice").cast("decimal(18,2)").alias("v")
    )
    long = exact_percentiles(rows, "v", [0.25, 0.5, 0.99], ["grp"], few_groups=True)
    wide = {"p25": 0.25, "p50": 0.5, "p99": 0.99}
    return long.groupBy("grp").agg(
        *(F.round(F.max(F.when(F.col("p") == p, F.col("percentile"))), 6).alias(n) for n, p in wide.items())
    )


@query(
    "a09_median",
    "claims",
    "SELECT zone_category, round(percentile_cont(0.5) WITHIN GROUP (ORDER BY CAST(amountPaidTotal AS DOUBLE)), 6) AS median_paid"
    " FROM claims WHERE amountPaidTotal > 0 GROUP BY 1",
)
def a09(ws):
    positive = ws.claims.where("amountPaidTotal > 0")
    median = exact_percentiles(positive, "amountPaidTotal", [0.5], ["zone_category"], few_groups=True)
    return median.select("zone_category", F.round("percentile", 6).alias("median_paid"))


@query(
    "a10_group_by_two_keys",
    "policies",
    "SELECT occupancyType AS occupancy, constructionClass AS class, count(*) AS n, CAST(sum(totalPremium) AS DOUBLE) AS premium FROM policies GROUP BY 1, 2",
)
def a10(ws):
    return ws.policies.groupBy(F.col("occupancyType").alias("occupancy"), F.col("constructionClass").alias("class")).agg(
        n_rows(), F.sum("totalPremium").alias("premium")
    )


@query(
    "a11_having_duplicates",
    "raw_claims",
    f"SELECT {', '.join(CLAIM_KEY)}, count(*) AS n FROM raw_claims GROUP BY {', '.join(CLAIM_KEY)} HAVING count(*) > 1",
)
def a11(ws):
    return duplicate_keys(ws.bronze("claims"), CLAIM_KEY)


@query(
    "a12_share_of_total",
    "claims",
    f"SELECT zone_category, is_special_flood_hazard AS hazard, n, {percent2('n', 'total')} AS pct FROM (SELECT zone_category, is_special_flood_hazard,"
    " count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM claims GROUP BY 1, 2)",
)
def a12(ws):
    return share_of_total(ws.claims, ["zone_category", "is_special_flood_hazard"]).withColumnRenamed(
        "is_special_flood_hazard", "hazard"
    )


_CATS = ["floodZoneCurrent", "occupancyType", "state", "causeOfDamage", "ratedFloodZone"]
_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM raw_claims WHERE {c} IS NOT NULL GROUP BY {c}" for c in _CATS
)


@query(
    "a13_value_counts_top15",
    "raw_claims",
    f'SELECT "column", value, n, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank FROM ({_LONG})) WHERE rank <= 15',
)
def a13(ws):
    return value_counts(ws.bronze("claims"), _CATS, 15)


@query("a13_rows_per_state", "raw_claims", "SELECT state, count(*) AS n FROM raw_claims GROUP BY state ORDER BY state")
def a13_states(ws):
    return ws.bronze("claims").groupBy("state").agg(n_rows()).orderBy("state")


@query(
    "a14_null_counts",
    "raw_claims",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS null_count,"
        f" CAST(count(*) - count({c}) AS DOUBLE) / count(*) * 100 AS null_pct FROM raw_claims"
        for c in CLAIM_COLUMNS
    ),
)
def a14(ws):
    return null_counts(ws.bronze("claims"), CLAIM_COLUMNS)


_NUMBERS = ["amountPaidOnBuildingClaim", "totalBuildingInsuranceCoverage", "yearOfLoss", "numberOfFloorsInTheInsuredBuilding"]


@query(
    "a15_numeric_profile",
    "raw_claims",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", min(v) AS min, max(v) AS max, round(avg(v), 6) AS mean, round(median(v), 4) AS median"
        f" FROM (SELECT CAST({c} AS DOUBLE) AS v FROM raw_claims)"
        for c in _NUMBERS
    ),
)
def a15(ws):
    long = profile.numeric_stats(ws.bronze("claims"), _NUMBERS)

    def pick(metric: str, digits: int | None = None):
        value = F.max(F.when(F.col("metric") == metric, F.col("number")))
        return (value if digits is None else F.round(value, digits)).alias(metric)

    return long.groupBy("column").agg(pick("min"), pick("max"), pick("mean", 6), pick("median", 4))


@query(
    "a16_date_ranges",
    "raw_policies",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(min({date(c)}) AS VARCHAR) AS min, CAST(max({date(c)}) AS VARCHAR) AS max FROM raw_policies"
        for c in ("policyEffectiveDate", "policyTerminationDate")
    ),
)
def a16(ws):
    return profile.date_ranges(ws.bronze("policies"), ["policyEffectiveDate", "policyTerminationDate"])


# ------------------------------------------------------------------------------ windows


@query("w01_latest_claim_per_key", "latest_claims", f"SELECT {', '.join(CLAIM_COLUMNS)} FROM latest_claims")
def w01(ws):
    usable = ws.bronze("claims").where(to_date(F.col("dateOfLoss")).isNotNull())
    kept = latest_per_key(usable.select(*CLAIM_COLUMNS, "ingestion_timestamp"), CLAIM_KEY, ["ingestion_timestamp"])
    return kept.drop("ingestion_timestamp")


@query("w02_latest_policy_per_key", "latest_policies", f"SELECT {', '.join(POLICY_COLUMNS)} FROM latest_policies")
def w02(ws):
    usable = ws.bronze("policies").where(to_date(F.col("policyEffectiveDate")).isNotNull())
    kept = latest_per_key(usable.select(*POLICY_COLUMNS, "ingestion_timestamp"), POLICY_KEY, ["ingestion_timestamp"])
    return kept.drop("ingestion_timestamp")


@query(
    "w01_dedup_lineitem",
    "",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS VARCHAR) AS shipped FROM (SELECT *, row_number() OVER"
    " (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey) AS r FROM lineitem) WHERE r = 1",
)
def w01_lines(ws):
    lines = ws.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    kept = latest_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    shipped = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipped")
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", shipped)


@query(
    "q07_rows_dropped_by_key",
    "raw_claims",
    "SELECT CAST(sum(n) AS BIGINT) AS rows_in, count(*) AS rows_kept, CAST(sum(n - 1) AS BIGINT) AS rows_dropped"
    f" FROM (SELECT count(*) AS n FROM raw_claims GROUP BY {', '.join(CLAIM_KEY)})",
)
def q07(ws):
    return surplus_per_key(ws.bronze("claims"), CLAIM_KEY)


@query(
    "w03_dense_member_keys",
    "claims",
    "SELECT CAST(row_number() OVER (ORDER BY state NULLS FIRST, county NULLS FIRST) AS INT) AS member_key, state, county"
    " FROM (SELECT DISTINCT state, countyCode AS county FROM claims)",
)
def w03(ws):
    members = ws.claims.select("state", F.col("countyCode").alias("county")).distinct()
    return number_members(members, "member_key", ["state", "county"]).select("member_key", "state", "county")


@query(
    "w04_lag_by_year",
    "policies",
    "SELECT year, CAST(premium AS DOUBLE) AS premium, CAST(lag(premium) OVER (ORDER BY year) AS DOUBLE) AS prior FROM"
    " (SELECT CAST(year(policyEffectiveDate) + CASE WHEN year(policyEffectiveDate) >= 1998 THEN 1 ELSE 0 END AS INT) AS year,"
    " sum(totalPremium) AS premium FROM policies GROUP BY 1)",
)
def w04(ws):
    """Years from 1998 on are moved by one, which leaves a gap: the prior row is two years back."""
    year = F.year("policyEffectiveDate")
    shifted = F.when(year >= 1998, year + 1).otherwise(year)
    yearly = ws.policies.groupBy(shifted.alias("year")).agg(F.sum("totalPremium").alias("premium"))
    return yearly.withColumn("prior", F.lag("premium").over(Window.orderBy("year")))


@query(
    "w05_sum_over_groups",
    "policies",
    "SELECT zone_category, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM policies GROUP BY 1",
)
def w05(ws):
    grouped = ws.policies.groupBy("zone_category").agg(n_rows())
    return grouped.withColumn("total", F.sum("n").over(Window.partitionBy()))


@query(
    "w06_percentile_beside_rows",
    "claims",
    "SELECT state, count(*) AS n, max(p95) AS p95 FROM claims, (SELECT round(percentile_cont(0.95) WITHIN GROUP"
    " (ORDER BY CAST(amountPaidTotal AS DOUBLE)), 6) AS p95 FROM claims WHERE amountPaidTotal > 0) GROUP BY 1",
)
def w06(ws):
    """The aggregate stands in for the windowed percentile; its one value goes beside the groups."""
    positive = ws.claims.where("amountPaidTotal > 0")
    p95 = exact_percentiles(positive, "amountPaidTotal", [0.95]).select(F.round("percentile", 6)).scalar()
    return ws.claims.groupBy("state").agg(n_rows()).withColumn("p95", p95)


# -------------------------------------------------------- sorting, sets and generators


@query(
    "o01_order_by",
    "claims",
    "SELECT state, accident_year, count(*) AS n FROM claims GROUP BY 1, 2 ORDER BY accident_year DESC, state",
)
def o01(ws):
    return ws.claims.groupBy("state", "accident_year").agg(n_rows()).orderBy(F.desc("accident_year"), "state")


@query(
    "o02_top_n",
    "claims",
    "SELECT state, countyCode AS county, CAST(sum(amountPaidTotal) AS DOUBLE) AS paid FROM claims GROUP BY 1, 2"
    " ORDER BY sum(amountPaidTotal) DESC, state, county LIMIT 5",
)
def o02(ws):
    paid = ws.claims.groupBy("state", F.col("countyCode").alias("county")).agg(F.sum("amountPaidTotal").alias("paid"))
    return paid.orderBy(F.desc("paid"), "state", "county").limit(5)


_TOP = (
    "SELECT propertyState AS state, policyEffectiveDate AS start, CAST(totalInsurancePremiumOfThePolicy AS DOUBLE) AS premium, countyCode AS county FROM"
    " (SELECT *, row_number() OVER (PARTITION BY propertyState ORDER BY CAST(totalInsurancePremiumOfThePolicy AS DECIMAL(18,2)) DESC, policyEffectiveDate, countyCode) AS r"
    " FROM raw_policies) WHERE r <= {n}"
)


def _top(ws, n: int):
    rows = ws.bronze("policies").select(
        F.col("propertyState").alias("state"), F.col("policyEffectiveDate").alias("start"),
        F.col("totalInsurancePremiumOfThePolicy").cast("decimal(18,2)").alias("premium"), F.col("countyCode").alias("county"),
    )
    return top_per_group(rows, ["state"], [F.desc("premium"), F.asc("start"), F.asc("county")], n)


@query("o03_top_k_per_group", "raw_policies", _TOP.format(n=15))
def o03(ws):
    return _top(ws, 15)


@query("o03_top_k_per_group_large_k", "raw_policies", _TOP.format(n=1500))
def o03_large(ws):
    return _top(ws, 1500)


@query(
    "o04_union_distinct",
    "claims policies",
    "SELECT state, countyCode AS county FROM claims UNION SELECT propertyState, countyCode FROM policies",
)
def o04(ws):
    county = F.col("countyCode").alias("county")
    return distinct_union(
        ws.claims.select("state", county), ws.policies.select(F.col("propertyState").alias("state"), county)
    )


@query(
    "o05_union_all",
    "claims policies",
    "SELECT state, count(*) AS n FROM (SELECT state FROM claims UNION ALL SELECT propertyState FROM policies) GROUP BY 1",
)
def o05(ws):
    both = ws.claims.select("state").unionByName(ws.policies.select(F.col("propertyState").alias("state")))
    return both.groupBy("state").agg(n_rows())


@query(
    "o06_date_series",
    "claims",
    "SELECT CAST(year(d) AS INT) AS year, count(*) AS days FROM (SELECT unnest(generate_series(CAST(min(dateOfLoss) AS TIMESTAMP), CAST(max(dateOfLoss) AS TIMESTAMP), INTERVAL 1 DAY)) AS d"
    " FROM claims) GROUP BY 1",
)
def o06(ws):
    """Every day from the first to the last loss."""
    bounds = ws.claims.agg(F.min("dateOfLoss").alias("start"), F.max("dateOfLoss").alias("end"))
    return dims.calendar(bounds).groupBy(F.year("full_date").alias("year")).agg(F.count(F.lit(1)).alias("days"))
