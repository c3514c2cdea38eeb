"""The driver tables in the roles of landed claims and policies.

Returned line items play claims and orders play policies. Dirt is seeded by key remainders: bad
dates, missing counties, missing occupancies, missing terminations, blank zones, negative amounts.
The comparison SQL in ``harness.sql`` states the same expressions for the other engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floodledger.schemas import CLAIM_COLUMNS, POLICY_COLUMNS
from floodledger.sources.landing import to_bronze

INGEST_SEQ = "ingest_seq"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(12,2)")


def _rate(column: str) -> Column:
    return F.col(column).cast("decimal(4,2)")


def _text(col: Column) -> Column:
    return col.cast("string")


def _flag(condition: Column) -> Column:
    return F.when(condition, "True").otherwise("False")


def _unless(condition: Column, col: Column) -> Column:
    return F.when(~condition, col)


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with customer, county (nation) and state (region)."""
    read = lambda name: table(spark, sf_dir, name)
    return (
        read("orders")
        .join(read("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )


def landed_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claim rows as landed: all strings, plus the order of ingestion."""
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    size, price = F.col("p_size"), _money("l_extendedprice")
    building = price * _rate("l_discount")
    contents = price * _rate("l_tax")
    zone = (
        F.when(line >= 6, None)
        .when(F.col("p_type") == "ECONOMY", " AE ")
        .when(F.col("p_type") == "LARGE", "VE")
        .when(F.col("p_type") == "MEDIUM", "x")
        .when(F.col("p_type") == "PROMO", "C")
        .when(F.col("p_type") == "SMALL", "D")
        .otherwise(F.concat(F.lit("A"), F.lpad(_text(size), 2, "0")))
    )
    occupancy = F.concat(
        F.substring("o_orderpriority", 1, 1), F.when(order % 2 == 0, ".0").otherwise("")
    )
    columns = {
        "dateOfLoss": F.when(order % 97 == 0, "not-a-date").otherwise(
            _text(F.col("l_shipdate").cast("date"))
        ),
        "state": F.col("r_name"),
        "countyCode": _unless(order % 89 == 0, F.lpad(_text(F.col("n_nationkey")), 5, "0")),
        "floodZoneCurrent": F.when(line == 7, "X"),
        "amountPaidOnBuildingClaim": _unless(
            line == 5, _text(F.when(order % 101 == 0, -building).otherwise(building))
        ),
        "amountPaidOnContentsClaim": F.when(line == 5, "").otherwise(_text(contents)),
        "totalBuildingInsuranceCoverage": _text(price),
        "totalContentsInsuranceCoverage": _text(
            (_money("l_quantity") * 1000).cast("decimal(18,2)")
        ),
        "occupancyType": _unless(order % 83 == 0, occupancy),
        "yearOfLoss": _text(F.year("l_shipdate")),
        "causeOfDamage": F.col("l_linestatus"),
        "ratedFloodZone": zone,
        "primaryResidenceIndicator": _flag(F.col("o_orderstatus") == "F"),
        "originalConstructionDate": F.when(size == 50, "unknown").otherwise(
            F.concat(_text(1960 + size + line * 3), F.lit("-01-01"))
        ),
        "numberOfFloorsInTheInsuredBuilding": F.concat(_text(line), F.lit(".0")),
        "elevatedBuildingIndicator": _flag(size % 4 == 0),
        "basementEnclosureCrawlspaceType": _unless(size % 2 == 0, _text(size % 5)),
    }
    rows = (
        table(spark, sf_dir, "lineitem")
        .join(_places(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    return rows.select(
        *(columns[c].alias(c) for c in CLAIM_COLUMNS), order.alias(INGEST_SEQ)
    )


def landed_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policy rows as landed: all strings, plus the order of ingestion."""
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    premium = F.col("o_totalprice").cast("decimal(18,2)")
    start = F.col("o_orderdate").cast("date")
    end = F.when(order % 103 == 0, F.date_sub(start, 10)).otherwise(
        F.date_add(start, (order % 400).cast("int"))
    )
    zone = (
        F.when(F.col("c_mktsegment") == "BUILDING", "AE")
        .when(F.col("c_mktsegment") == "MACHINERY", "VE")
        .when(F.col("c_mktsegment") == "AUTOMOBILE", "X")
        .when(F.col("c_mktsegment") == "FURNITURE", "C")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "D")
    )
    columns = {
        "propertyState": F.col("r_name"),
        "countyCode": F.lpad(_text(F.col("n_nationkey")), 5, "0"),
        "floodZoneCurrent": F.when(order % 3 == 0, "X"),
        "totalInsurancePremiumOfThePolicy": _text(premium),
        "buildingDeductibleCode": F.when(order % 10 == 9, "F").otherwise(_text(order % 10)),
        "totalBuildingInsuranceCoverage": _text((premium * 200).cast("decimal(18,2)")),
        "totalContentsInsuranceCoverage": _text((premium * 50).cast("decimal(18,2)")),
        "policyEffectiveDate": _text(start),
        "policyTerminationDate": _unless(order % 107 == 0, _text(end)),
        "construction": _flag(F.col("o_orderstatus") == "P"),
        "occupancyType": F.substring("o_orderpriority", 1, 1),
        "numberOfFloorsInInsuredBuilding": _text(order % 6 + 1),
        "primaryResidenceIndicator": _flag(F.col("o_orderstatus") == "F"),
        "crsClassCode": _unless(order % 2 == 0, F.concat(_text(order % 10 + 1), F.lit(".0"))),
        "ratedFloodZone": _unless(order % 109 == 0, zone),
        "originalConstructionDate": F.concat(_text(1960 + customer % 65), F.lit("-01-01")),
        "elevatedBuildingIndicator": _flag(customer % 4 == 0),
        "basementEnclosureCrawlspaceType": _text(order % 5),
    }
    return _places(spark, sf_dir).select(
        *(columns[c].alias(c) for c in POLICY_COLUMNS), order.alias(INGEST_SEQ)
    )


LANDED = {"claims": landed_claims, "policies": landed_policies}


def ingestion_time(seq: Column) -> Column:
    """A time that grows with the order of ingestion."""
    return F.timestamp_seconds(seq + 1_700_000_000)


def bronze(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    landed = LANDED[entity](spark, sf_dir)
    return to_bronze(landed, entity, ingested=ingestion_time(F.col(INGEST_SEQ))).drop(INGEST_SEQ)


#: Loads of a delivery in parts, and the columns outside of the keys that outdated versions differ in.
LOADS = 3
OUTDATED = {
    "claims": {"occupancyType": "9", "ratedFloodZone": "V99", "totalBuildingInsuranceCoverage": "1.00"},
    "policies": {"occupancyType": "9", "ratedFloodZone": "V99"},
}


def delivery(bronze: DataFrame, entity: str, load: int) -> DataFrame:
    """The bronze rows of one of several loads, by their ingestion second.

    The last part comes first, so later loads hold older versions of some keys. The first load also
    has an outdated version of every row, older than all others and with other values: what the
    loads leave behind is what all rows together give.
    """
    second = F.unix_timestamp("ingestion_timestamp")
    part = bronze.where(second % LOADS == LOADS - 1 - load)
    if load:
        return part
    old = bronze.withColumns(
        {c: F.lit(v) for c, v in OUTDATED[entity].items()}
        | {"ingestion_timestamp": F.timestamp_seconds(second - 1_000_000_000)}
    )
    return part.unionByName(old)


def state_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as the state reference table."""
    return table(spark, sf_dir, "region").select(
        F.col("r_name").alias("state_abbrev"),
        F.concat(F.lit("State of "), F.col("r_name")).alias("state_name"),
        (F.col("r_regionkey") + 1).alias("fema_region"),
    )
