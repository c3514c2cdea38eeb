"""Loads merged one after the other into buckets, members and sums: the same answers as a full build.

The comparison SQL is that of the full build, as the loads leave the same rows behind.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from floodledger.plans import condensed, views
from harness.catalog import star  # noqa: F401  (its SQL is taken below)
from harness.registry import ORACLES, query
from harness.workspace import Workspace


def _same_as(name: str, of: str):
    return query(name, "", ORACLES[of])


@_same_as("k01_merged_claims", "k01_clean_claims")
def k01(ws: Workspace):
    return ws.merged_cleaned("claims").drop("row_key", "bucket")


@_same_as("k02_merged_policies", "k02_clean_policies")
def k02(ws):
    return ws.merged_cleaned("policies").drop("row_key", "bucket")


_PLACE = "state_abbrev, county_fips, flood_zone_code, occupancy_type, construction_class, year_built_band, year"


def _by_attributes(star, fact, date_key, **sums):
    joined = (
        fact.join(star.dim_date.withColumnRenamed("date_key", date_key), date_key)
        .join(star.dim_location, "location_key")
        .join(star.dim_flood_zone, "flood_zone_key")
        .join(star.dim_occupancy, "occupancy_key")
        .join(star.dim_building_type, "building_type_key")
    )
    return joined.groupBy(*_PLACE.split(", ")).agg(F.count("*").alias("n"), *(F.sum(c).alias(a) for a, c in sums.items()))


@query(
    "k08_merged_claims_fact",
    "claims_star",
    f"SELECT {_PLACE}, count(*) AS n, CAST(sum(amount_paid_total) AS DOUBLE) AS paid, CAST(sum(total_building_coverage) AS DOUBLE) AS coverage"
    " FROM claims_star GROUP BY ALL",
)
def k08(ws):
    """Facts by the attributes of their dimensions, since members of other builds may have other keys."""
    star = ws.merged.star
    return _by_attributes(star, star.fact_claims, "date_key", paid="amount_paid_total", coverage="total_building_coverage")


@query(
    "k09_merged_policies_fact",
    "policies_star",
    f"SELECT {_PLACE}, count(*) AS n, CAST(sum(total_premium) AS DOUBLE) AS premium, CAST(sum(exposure) AS DOUBLE) AS exposure FROM policies_star GROUP BY ALL",
)
def k09(ws):
    star = ws.merged.star
    return _by_attributes(star, star.fact_policies, "effective_date_key", premium="total_premium", exposure="exposure")


@query(
    "k08_durable_keys",
    "fact_claims fact_policies",
    "SELECT 'claims' AS entity, count(*) AS n, count(*) AS same_key FROM fact_claims UNION ALL SELECT 'policies', count(*), count(*) FROM fact_policies",
)
def k08_keys(ws):
    """Fact rows of two builds, one from three loads, that have the same key and the same amounts."""
    def side(name, key, amounts):
        one, other = getattr(ws.star, name), getattr(ws.merged.star, name)
        same = one.select(key, *amounts).join(other.select(key, *amounts), [key, *amounts]).agg(F.count("*").alias("same_key"))
        return other.agg(F.count("*").alias("n")).withColumn("same_key", same.scalar()).select(F.lit(name.split("_")[1]).alias("entity"), "n", "same_key")

    return side("fact_claims", "claim_sk", ["amount_paid_total", "total_building_coverage"]).unionByName(
        side("fact_policies", "policy_sk", ["total_premium", "exposure"])
    )


@query(
    "w03_registered_members",
    "dim_location dim_building_type",
    "SELECT 'location' AS dimension, count(*) - 1 AS members, CAST(max(location_key) AS BIGINT) AS highest FROM dim_location"
    " UNION ALL SELECT 'building_type', count(*) - 1, CAST(max(building_type_key) AS BIGINT) FROM dim_building_type",
)
def w03(ws):
    """Members that came with three loads: as many as in one build, numbered without gaps."""
    star = ws.merged.star
    side = lambda name, key: getattr(star, f"dim_{name}").agg((F.countDistinct(key) - 1).alias("members"), F.max(key).cast("bigint").alias("highest")).select(
        F.lit(name).alias("dimension"), "members", "highest")
    return side("location", "location_key").unionByName(side("building_type", "building_type_key"))


@_same_as("v01_merged_loss_ratio", "v01_loss_ratio_by_location")
def v01(ws):
    return views.loss_ratio(ws.condensed("place"))


@_same_as("v02_merged_frequency_severity", "v02_frequency_severity")
def v02(ws):
    return views.frequency_severity(ws.condensed("zone"))


@_same_as("v03_merged_large_loss", "v03_large_loss_concentration")
def v03(ws):
    merged = condensed.large_loss_concentration(ws.merged.star, f"{ws.merged.path}/gold")
    return merged.withColumn("p95_threshold", F.round("p95_threshold", 6))


@_same_as("v04_merged_severity", "v04_severity_by_zone")
def v04(ws):
    merged = condensed.severity_by_zone(ws.merged.star, f"{ws.merged.path}/gold")
    return merged.withColumn("median_severity", F.round("median_severity", 6))


@_same_as("v05_merged_premium_adequacy", "v05_premium_adequacy")
def v05(ws):
    return views.premium_adequacy(ws.condensed("building"))


@_same_as("v06_merged_claims_development", "v06_claims_development")
def v06(ws):
    return views.claims_development(ws.condensed("loss_year"))


@_same_as("v07_merged_portfolio_summary", "v07_portfolio_summary")
def v07(ws):
    return views.portfolio_summary(ws.condensed("place"))


@_same_as("v08_merged_earned_premium", "v08_earned_premium")
def v08(ws):
    return views.earned_premium(ws.condensed("place"))
