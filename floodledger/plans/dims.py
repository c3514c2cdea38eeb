"""Silver to gold dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodledger.functions import derive
from floodledger.functions.cleaning import or_unknown
from floodledger.operators.members import (
    distinct_union,
    number_members,
    registered,
    with_unknown,
    without_unknown,
)
from floodledger.schemas import DATE_RANGE, GOLD, NO_COUNTY, UNKNOWN, UNKNOWN_KEY


def date_series(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every day from start to end, both included."""
    return calendar(
        spark.range(1).select(F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"))
    )


def calendar(bounds: DataFrame) -> DataFrame:
    """Every day between the ``start`` and ``end`` columns of a one-row table."""
    return bounds.select(F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("full_date"))


def date_attributes(days: DataFrame) -> DataFrame:
    day = F.col("full_date")
    return days.select(
        derive.date_key(day).alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        derive.fiscal_year(day).alias("fiscal_year"),
        derive.fiscal_quarter(day).alias("fiscal_quarter"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        derive.weekend_flag(day).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, start: str = DATE_RANGE[0], end: str = DATE_RANGE[1]) -> DataFrame:
    """The calendar, and a member for missing dates and dates outside of it."""
    unknown = (UNKNOWN_KEY, None, None, None, None, UNKNOWN, None, None, UNKNOWN, 0)
    return with_unknown(date_attributes(date_series(spark, start, end)), unknown, GOLD["dim_date"])


def _keyed(members: DataFrame, key: str, registry: str | None) -> DataFrame:
    """Members with keys: numbered anew, or by a registry that keeps the keys given before.

    ``registry`` is the folder of the registries of all dimensions.
    """
    if registry is None:
        return number_members(members, key, members.columns)
    return registered(members, key, f"{registry}/{key}")


def county_or_default(county):
    return F.coalesce(county, F.lit(NO_COUNTY))


def dim_location(
    claims: DataFrame, policies: DataFrame, states: DataFrame, registry: str | None = None
) -> DataFrame:
    """State and county pairs of both entities; a missing county is a member of its state."""
    members = distinct_union(
        *(
            side.where(F.col(state).isNotNull()).select(
                F.col(state).alias("state_abbrev"),
                county_or_default(F.col("countyCode")).alias("county_fips"),
            )
            for side, state in ((claims, "state"), (policies, "propertyState"))
        )
    )
    known = without_unknown(members, {"state_abbrev": "ZZ", "county_fips": NO_COUNTY})
    named = _keyed(known, "location_key", registry).join(states, "state_abbrev", "left").withColumns(
        {"state_name": or_unknown(F.col("state_name")), "fema_region": F.coalesce("fema_region", F.lit(0))}
    )
    return with_unknown(
        named, (UNKNOWN_KEY, "ZZ", UNKNOWN, NO_COUNTY, 0), GOLD["dim_location"]
    )


def dim_flood_zone(
    claims: DataFrame, policies: DataFrame, zones: DataFrame, registry: str | None = None
) -> DataFrame:
    """Zone codes of both entities with their category, which follows from the code alone."""
    members = distinct_union(
        *(
            side.where(F.col("floodZone").isNotNull()).select(F.col("floodZone").alias("flood_zone_code"))
            for side in (claims, policies)
        )
    )
    known = _keyed(without_unknown(members, {"flood_zone_code": UNKNOWN}), "flood_zone_key", registry)
    categorised = known.withColumn("zone_category", derive.zone_category(F.col("flood_zone_code")))
    described = categorised.join(zones, "zone_category", "left").withColumns(
        {
            "zone_description": F.coalesce("zone_description", F.lit("Zone not mapped")),
            "is_special_flood_hazard": F.coalesce("is_special_flood_hazard", F.lit(0)),
        }
    )
    return with_unknown(
        described, (UNKNOWN_KEY, UNKNOWN, UNKNOWN, "Zone not mapped", 0), GOLD["dim_flood_zone"]
    )


BUILDING = ["construction_class", "number_of_floors", "year_built_band", "elevated_flag", "basement_type"]


def with_building_attributes(df: DataFrame) -> DataFrame:
    """Add the five attributes of a building profile; claims carry no construction class."""
    construction = (
        or_unknown(F.col("constructionClass")) if "constructionClass" in df.columns else F.lit("N/A")
    )
    return df.withColumns(
        {
            "construction_class": construction,
            "number_of_floors": or_unknown(F.col("numberOfFloors")),
            "year_built_band": derive.year_built_band(F.col("yearBuilt")),
            "elevated_flag": derive.elevated_flag(F.col("elevatedBuildingIndicator")),
            "basement_type": or_unknown(F.col("basementEnclosureCrawlspaceType")),
        }
    )


def dim_building_type(claims: DataFrame, policies: DataFrame, registry: str | None = None) -> DataFrame:
    members = distinct_union(
        *(with_building_attributes(side).select(*BUILDING) for side in (claims, policies))
    )
    unknown = (UNKNOWN, UNKNOWN, UNKNOWN, 0, UNKNOWN)
    known = without_unknown(members, dict(zip(BUILDING, unknown)))
    return with_unknown(
        _keyed(known, "building_type_key", registry),
        (UNKNOWN_KEY, *unknown),
        GOLD["dim_building_type"],
    )


def dim_occupancy(claims: DataFrame, policies: DataFrame, registry: str | None = None) -> DataFrame:
    """Occupancy codes of both entities. A missing code is no member: facts use the Unknown row."""
    code = F.col("occupancyType")
    members = distinct_union(
        *(
            side.where(code.isNotNull()).select(code.alias("occupancy_type")) for side in (claims, policies)
        )
    )
    known = _keyed(without_unknown(members, {"occupancy_type": UNKNOWN}), "occupancy_key", registry)
    return with_unknown(
        known.withColumn("residential_flag", derive.residential_flag(F.col("occupancy_type"))),
        (UNKNOWN_KEY, UNKNOWN, 0),
        GOLD["dim_occupancy"],
    )
