"""Column lists, table schemas and fixed reference rows of the three layers."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# ---------------------------------------------------------------- fixed values
# Source column order of the two landed entities; every one is a string at bronze.
CLAIM_COLUMNS = [
    "dateOfLoss",
    "state",
    "countyCode",
    "floodZoneCurrent",
    "amountPaidOnBuildingClaim",
    "amountPaidOnContentsClaim",
    "totalBuildingInsuranceCoverage",
    "totalContentsInsuranceCoverage",
    "occupancyType",
    "yearOfLoss",
    "causeOfDamage",
    "ratedFloodZone",
    "primaryResidenceIndicator",
    "originalConstructionDate",
    "numberOfFloorsInTheInsuredBuilding",
    "elevatedBuildingIndicator",
    "basementEnclosureCrawlspaceType",
]
POLICY_COLUMNS = [
    "propertyState",
    "countyCode",
    "floodZoneCurrent",
    "totalInsurancePremiumOfThePolicy",
    "buildingDeductibleCode",
    "totalBuildingInsuranceCoverage",
    "totalContentsInsuranceCoverage",
    "policyEffectiveDate",
    "policyTerminationDate",
    "construction",
    "occupancyType",
    "numberOfFloorsInInsuredBuilding",
    "primaryResidenceIndicator",
    "crsClassCode",
    "ratedFloodZone",
    "originalConstructionDate",
    "elevatedBuildingIndicator",
    "basementEnclosureCrawlspaceType",
]
SOURCE_COLUMNS = {"claims": CLAIM_COLUMNS, "policies": POLICY_COLUMNS}

# Name of the record array inside one landed JSON page, and the default endpoint recorded as lineage.
ENVELOPE = {"claims": "FimaNfipClaims", "policies": "FimaNfipPolicies"}
ENDPOINT = {
    "claims": "https://www.fema.gov/api/open/v2/FimaNfipClaims",
    "policies": "https://www.fema.gov/api/open/v2/FimaNfipPolicies",
}

# Columns that may hold the state, in the order they are tried.
STATE_CANDIDATES = ["state", "propertyState"]

# States in scope.
TARGET_STATES = ["FL", "LA", "TX", "NJ", "NY"]

# Natural keys of the deduplication.
CLAIM_KEY = ["state", "countyCode", "dateOfLoss", "amountPaidOnBuildingClaim", "amountPaidOnContentsClaim"]
POLICY_KEY = [
    "propertyState",
    "countyCode",
    "policyEffectiveDate",
    "totalInsurancePremiumOfThePolicy",
    "totalBuildingInsuranceCoverage",
]

# Texts that mean "missing": the loader's own list, then the reader's default list.
MISSING_TOKENS = [
    "nan", "None", "NaT", "", "null", "NULL",
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NaN", "n/a",
]

# Columns profiled by value counts and by date range.
PROFILE_CATEGORICAL = {
    "claims": [
        "floodZoneCurrent", "occupancyType", "state", "causeOfDamage", "ratedFloodZone",
        "primaryResidenceIndicator", "elevatedBuildingIndicator", "basementEnclosureCrawlspaceType",
    ],
    "policies": [
        "floodZoneCurrent", "occupancyType", "propertyState", "ratedFloodZone", "construction",
        "primaryResidenceIndicator", "crsClassCode", "elevatedBuildingIndicator",
        "basementEnclosureCrawlspaceType",
    ],
}
PROFILE_DATES = {"claims": ["dateOfLoss"], "policies": ["policyEffectiveDate", "policyTerminationDate"]}
PROFILE_STATE = {"claims": "state", "policies": "propertyState"}

RESIDENTIAL_CODES = ["1", "2", "3", "11", "12", "15", "18"]

STATE_ROWS = [
    ("FL", "Florida", 4),
    ("LA", "Louisiana", 6),
    ("TX", "Texas", 6),
    ("NJ", "New Jersey", 2),
    ("NY", "New York", 2),
]
ZONE_ROWS = [
    ("A", "High-risk 1% annual chance", 1),
    ("V", "Coastal high-risk with wave action", 1),
    ("X", "Moderate-to-low risk", 0),
    ("D", "Undetermined risk", 0),
    ("Unknown", "Zone not mapped", 0),
]
UNKNOWN_KEY = -1
UNKNOWN = "Unknown"
NO_COUNTY = "00000"
DATE_RANGE = ("1978-01-01", "2030-12-31")
LOSS_YEARS = (1978, 2026)
# ----------------------------------------------------------- end of fixed values


# Table schemas as DDL text; ``struct`` turns one into a StructType once a session exists.
LINEAGE = "batch_id int, ingestion_timestamp timestamp, source_state string, source_api_endpoint string"


@lru_cache
def _parsed(ddl: str) -> str:
    return T.StructType.fromDDL(ddl).json()


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(_parsed(ddl)))


def text_schema(columns: list[str]) -> T.StructType:
    """Every source column as a nullable string."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def bronze_schema(entity: str) -> T.StructType:
    return T.StructType(text_schema(SOURCE_COLUMNS[entity]).fields + struct(LINEAGE).fields)


SILVER = {
    "claims_cleaned": (
        "dateOfLoss date, state string, countyCode string, floodZone string,"
        " amountPaidOnBuildingClaim decimal(18,2), amountPaidOnContentsClaim decimal(18,2),"
        " amountPaidTotal decimal(18,2), totalBuildingInsuranceCoverage decimal(18,2),"
        " totalContentsInsuranceCoverage decimal(18,2), occupancyType string, yearOfLoss int,"
        " causeOfDamage string, ratedFloodZone string, primaryResidence string, yearBuilt string,"
        " numberOfFloors string, elevatedBuildingIndicator string,"
        " basementEnclosureCrawlspaceType string, accident_year int, zone_category string,"
        " is_special_flood_hazard int"
    ),
    "policies_cleaned": (
        "propertyState string, countyCode string, floodZone string, totalPremium decimal(18,2),"
        " deductibleAmount decimal(18,2), buildingCoverage decimal(18,2),"
        " contentsCoverage decimal(18,2), policyEffectiveDate date, policyTerminationDate date,"
        " constructionClass string, occupancyType string, numberOfFloors string,"
        " primaryResidenceIndicator string, crsClassificationCode string, ratedFloodZone string,"
        " yearBuilt string, elevatedBuildingIndicator string,"
        " basementEnclosureCrawlspaceType string, exposure decimal(8,6), zone_category string,"
        " is_special_flood_hazard int"
    ),
    "ref_state_info": "state_abbrev string, state_name string, fema_region int",
    "ref_flood_zone_info": (
        "zone_category string, zone_description string, is_special_flood_hazard int"
    ),
}

#: Identity of a cleaned row, and the folder that it is stored in.
ROW_KEY, BUCKET = "row_key", "bucket"
STORED = f"{ROW_KEY} string, {BUCKET} int"

GOLD = {
    "dim_date": (
        "date_key int, full_date date, year int, quarter int, month int, month_name string,"
        " fiscal_year int, fiscal_quarter int, day_of_week string, is_weekend int"
    ),
    "dim_location": (
        "location_key int, state_abbrev string, state_name string, county_fips string, fema_region int"
    ),
    "dim_flood_zone": (
        "flood_zone_key int, flood_zone_code string, zone_category string, zone_description string,"
        " is_special_flood_hazard int"
    ),
    "dim_building_type": (
        "building_type_key int, construction_class string, number_of_floors string,"
        " year_built_band string, elevated_flag int, basement_type string"
    ),
    "dim_occupancy": "occupancy_key int, occupancy_type string, residential_flag int",
    "fact_claims": (
        "claim_sk string, date_key int, location_key int, flood_zone_key int, building_type_key int,"
        " occupancy_key int, amount_paid_building decimal(18,2), amount_paid_contents decimal(18,2),"
        " amount_paid_total decimal(18,2), total_building_coverage decimal(18,2),"
        " total_contents_coverage decimal(18,2), cause_of_damage string, year_of_loss int"
    ),
    "fact_policies": (
        "policy_sk string, effective_date_key int, termination_date_key int, location_key int,"
        " flood_zone_key int, building_type_key int, occupancy_key int, total_premium decimal(18,2),"
        " deductible_amount decimal(18,2), building_coverage decimal(18,2),"
        " contents_coverage decimal(18,2), exposure decimal(8,6), crs_class string, policy_count int"
    ),
}

CHECK = (
    "suite string, check_name string, entity string, status string, observed bigint,"
    " threshold bigint, detail string"
)
PROFILE = "section string, column string, item string, text string, number double"


def inline_rows(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A handful of constant rows as a local table, so that the planner knows they are small."""
    target = struct(ddl)
    records = [dict(zip(target.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, to_arrow_schema(target)), target)


def ref_state_info(spark: SparkSession) -> DataFrame:
    return inline_rows(spark, STATE_ROWS, SILVER["ref_state_info"])


def ref_flood_zone_info(spark: SparkSession) -> DataFrame:
    return inline_rows(spark, ZONE_ROWS, SILVER["ref_flood_zone_info"])


def conform(df: DataFrame, ddl: str, carry: Sequence[str] = ()) -> DataFrame:
    """Order and type the columns as the table schema says; a missing column is an error.

    ``carry`` names columns to keep behind them as they are.
    """
    return df.selectExpr(
        *(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in struct(ddl)),
        *(f"`{c}`" for c in carry),
    )
