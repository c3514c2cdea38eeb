"""Bronze to silver: deduplicate, cast, enrich."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodledger.functions import derive
from floodledger.functions.cleaning import code, to_date, to_int, to_money
from floodledger.operators.dedup import latest_per_key
from floodledger.schemas import CLAIM_COLUMNS, CLAIM_KEY, POLICY_COLUMNS, POLICY_KEY, SILVER, conform

INGESTED = "ingestion_timestamp"


def clean_claims(raw: DataFrame, key: Sequence[str] = CLAIM_KEY) -> DataFrame:
    """Latest row per claim key with a usable loss date, typed and enriched."""
    return typed_claims(latest_per_key(usable(raw, ENTITIES["claims"]), key, [INGESTED]))


def typed_claims(kept: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Typed and enriched rows; ``carry`` names columns to hand through behind them."""
    zone = derive.flood_zone(F.col("ratedFloodZone"), F.col("floodZoneCurrent"))
    typed = kept.select(
        to_date(F.col("dateOfLoss")).alias("dateOfLoss"),
        code(F.col("state")).alias("state"),
        code(F.col("countyCode")).alias("countyCode"),
        zone.alias("floodZone"),
        to_money(F.col("amountPaidOnBuildingClaim")).alias("amountPaidOnBuildingClaim"),
        to_money(F.col("amountPaidOnContentsClaim")).alias("amountPaidOnContentsClaim"),
        to_money(F.col("totalBuildingInsuranceCoverage")).alias("totalBuildingInsuranceCoverage"),
        to_money(F.col("totalContentsInsuranceCoverage")).alias("totalContentsInsuranceCoverage"),
        code(F.col("occupancyType")).alias("occupancyType"),
        to_int(F.col("yearOfLoss")).alias("yearOfLoss"),
        F.trim("causeOfDamage").alias("causeOfDamage"),
        F.upper(F.trim("ratedFloodZone")).alias("ratedFloodZone"),
        F.trim("primaryResidenceIndicator").alias("primaryResidence"),
        derive.year_built(F.col("originalConstructionDate")).alias("yearBuilt"),
        code(F.col("numberOfFloorsInTheInsuredBuilding")).alias("numberOfFloors"),
        F.trim("elevatedBuildingIndicator").alias("elevatedBuildingIndicator"),
        code(F.col("basementEnclosureCrawlspaceType")).alias("basementEnclosureCrawlspaceType"),
        *carry,
    )
    enriched = typed.withColumns(
        {
            "amountPaidTotal": F.col("amountPaidOnBuildingClaim") + F.col("amountPaidOnContentsClaim"),
            "accident_year": F.year("dateOfLoss"),
            "zone_category": derive.zone_category(F.col("floodZone")),
            "is_special_flood_hazard": derive.special_hazard(F.col("floodZone")),
        }
    )
    return conform(enriched, SILVER["claims_cleaned"], carry)


def clean_policies(raw: DataFrame, key: Sequence[str] = POLICY_KEY) -> DataFrame:
    """Latest row per policy key with a usable effective date, typed and enriched."""
    return typed_policies(latest_per_key(usable(raw, ENTITIES["policies"]), key, [INGESTED]))


def typed_policies(kept: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Typed and enriched rows; ``carry`` names columns to hand through behind them."""
    zone = derive.flood_zone(F.col("ratedFloodZone"), F.col("floodZoneCurrent"))
    typed = kept.select(
        code(F.col("propertyState")).alias("propertyState"),
        code(F.col("countyCode")).alias("countyCode"),
        zone.alias("floodZone"),
        to_money(F.col("totalInsurancePremiumOfThePolicy")).alias("totalPremium"),
        to_money(F.col("buildingDeductibleCode")).alias("deductibleAmount"),
        to_money(F.col("totalBuildingInsuranceCoverage")).alias("buildingCoverage"),
        to_money(F.col("totalContentsInsuranceCoverage")).alias("contentsCoverage"),
        to_date(F.col("policyEffectiveDate")).alias("policyEffectiveDate"),
        to_date(F.col("policyTerminationDate")).alias("policyTerminationDate"),
        F.trim("construction").alias("constructionClass"),
        code(F.col("occupancyType")).alias("occupancyType"),
        code(F.col("numberOfFloorsInInsuredBuilding")).alias("numberOfFloors"),
        F.trim("primaryResidenceIndicator").alias("primaryResidenceIndicator"),
        code(F.col("crsClassCode")).alias("crsClassificationCode"),
        F.upper(F.trim("ratedFloodZone")).alias("ratedFloodZone"),
        derive.year_built(F.col("originalConstructionDate")).alias("yearBuilt"),
        F.trim("elevatedBuildingIndicator").alias("elevatedBuildingIndicator"),
        code(F.col("basementEnclosureCrawlspaceType")).alias("basementEnclosureCrawlspaceType"),
        *carry,
    )
    enriched = typed.withColumns(
        {
            "exposure": derive.exposure(F.col("policyEffectiveDate"), F.col("policyTerminationDate")),
            "zone_category": derive.zone_category(F.col("floodZone")),
            "is_special_flood_hazard": derive.special_hazard(F.col("floodZone")),
        }
    )
    return conform(enriched, SILVER["policies_cleaned"], carry)


@dataclass(frozen=True)
class Entity:
    """What the cleaning of an entity goes by."""

    columns: list[str]
    key: list[str]
    date: str
    typed: Callable[..., DataFrame]
    #: The typed columns that most often spell what was landed, by landed column.
    spelled: dict[str, str]


def _alike(columns: Sequence[str], table: str, other: dict[str, str]) -> dict[str, str]:
    typed = {part.split()[0] for part in SILVER[table].split(", ")}
    return {c: c for c in columns if c in typed} | other


ENTITIES = {
    "claims": Entity(
        CLAIM_COLUMNS, CLAIM_KEY, "dateOfLoss", typed_claims,
        _alike(CLAIM_COLUMNS, "claims_cleaned", {
            "primaryResidenceIndicator": "primaryResidence",
            "numberOfFloorsInTheInsuredBuilding": "numberOfFloors",
        }),
    ),
    "policies": Entity(
        POLICY_COLUMNS, POLICY_KEY, "policyEffectiveDate", typed_policies,
        _alike(POLICY_COLUMNS, "policies_cleaned", {
            "totalInsurancePremiumOfThePolicy": "totalPremium",
            "buildingDeductibleCode": "deductibleAmount",
            "totalBuildingInsuranceCoverage": "buildingCoverage",
            "totalContentsInsuranceCoverage": "contentsCoverage",
            "construction": "constructionClass",
            "numberOfFloorsInInsuredBuilding": "numberOfFloors",
            "crsClassCode": "crsClassificationCode",
        }),
    ),
}


def usable(raw: DataFrame, entity: Entity) -> DataFrame:
    """The source columns and ingestion time of the rows whose date can be read."""
    return raw.select(*entity.columns, INGESTED).where(to_date(F.col(entity.date)).isNotNull())


def _key_hash(key: Sequence[str]) -> Column:
    # in the order in which the dedup deals rows to tasks, so a task of it holds whole buckets
    return F.hash(*reversed(key))


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(_key_hash(key), F.lit(buckets))


def row_key(key: Sequence[str]) -> Column:
    """128 bits of the landed key as hexadecimal digits, the same in every build.

    The first 32 bits are the hash that buckets go by: two keys that collided would share a bucket
    at any number of buckets, so looking for collisions inside buckets finds them all.
    """
    spelled = F.concat_ws("|", *(F.coalesce(F.concat(F.length(k), F.lit(":"), F.col(k)), F.lit("-")) for k in key))
    lead = F.hex(F.pmod(_key_hash(key).cast("bigint"), F.lit(1 << 32)))
    return F.concat(F.lower(F.lpad(lead, 8, "0")), F.substring(F.md5(spelled), 1, 24))


def rejected(raw: DataFrame, date_column: str) -> DataFrame:
    """Rows the cleaning leaves out because their date is missing or unusable."""
    return raw.where(to_date(F.col(date_column)).isNull())
