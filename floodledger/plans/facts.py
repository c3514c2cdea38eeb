"""Silver to gold facts: one pass over the silver table, four lookups and the date keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodledger.functions import derive
from floodledger.operators.lookup import resolve_key
from floodledger.plans.dims import BUILDING, county_or_default, with_building_attributes
from floodledger.schemas import BUCKET, GOLD, ROW_KEY, conform


def _resolve(
    silver: DataFrame,
    state: str,
    dates: dict[str, Column],
    dim_date: DataFrame,
    dim_location: DataFrame,
    dim_flood_zone: DataFrame,
    dim_building_type: DataFrame,
    dim_occupancy: DataFrame,
) -> DataFrame:
    fact = with_building_attributes(silver).withColumn(
        "_county", county_or_default(F.col("countyCode"))
    )
    fact = resolve_key(
        fact, dim_location, {state: "state_abbrev", "_county": "county_fips"}, "location_key"
    )
    fact = resolve_key(fact, dim_flood_zone, {"floodZone": "flood_zone_code"}, "flood_zone_key")
    fact = resolve_key(fact, dim_building_type, {c: c for c in BUILDING}, "building_type_key")
    fact = resolve_key(fact, dim_occupancy, {"occupancyType": "occupancy_type"}, "occupancy_key")
    for alias, date in dates.items():
        fact = fact.withColumn("_date", derive.date_key(date))
        fact = resolve_key(fact, dim_date, {"_date": "date_key"}, "date_key", alias)
    return fact


def fact_claims(claims: DataFrame, **dims: DataFrame) -> DataFrame:
    """Claims with their dimension keys; takes the five dimensions by name.

    The key of a fact row is the identity of its cleaned row, so every build gives it the same key.
    """
    numbered = claims.withColumn("claim_sk", F.col(ROW_KEY))
    fact = _resolve(numbered, "state", {"date_key": F.col("dateOfLoss")}, **dims)
    renamed = fact.withColumnsRenamed(
        {
            "amountPaidOnBuildingClaim": "amount_paid_building",
            "amountPaidOnContentsClaim": "amount_paid_contents",
            "amountPaidTotal": "amount_paid_total",
            "totalBuildingInsuranceCoverage": "total_building_coverage",
            "totalContentsInsuranceCoverage": "total_contents_coverage",
            "causeOfDamage": "cause_of_damage",
            "yearOfLoss": "year_of_loss",
        }
    )
    return conform(renamed, GOLD["fact_claims"], [BUCKET])


def fact_policies(policies: DataFrame, **dims: DataFrame) -> DataFrame:
    """Policies with their dimension keys; the date dimension plays two roles."""
    numbered = policies.withColumn("policy_sk", F.col(ROW_KEY))
    dates = {
        "effective_date_key": F.col("policyEffectiveDate"),
        "termination_date_key": F.col("policyTerminationDate"),
    }
    fact = _resolve(numbered, "propertyState", dates, **dims)
    renamed = fact.withColumnsRenamed(
        {
            "totalPremium": "total_premium",
            "deductibleAmount": "deductible_amount",
            "buildingCoverage": "building_coverage",
            "contentsCoverage": "contents_coverage",
            "crsClassificationCode": "crs_class",
        }
    ).withColumn("policy_count", F.lit(1))
    return conform(renamed, GOLD["fact_policies"], [BUCKET])
