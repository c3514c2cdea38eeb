import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from floodledger.schemas import CLAIM_COLUMNS, POLICY_COLUMNS, bronze_schema  # noqa: E402
from floodledger.session import builder  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        builder("tests")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


CLAIM = {
    "dateOfLoss": "2017-08-25T00:00:00.000Z", "state": "TX", "countyCode": "48201", "floodZoneCurrent": None,
    "amountPaidOnBuildingClaim": "45000.00", "amountPaidOnContentsClaim": "12000.00",
    "totalBuildingInsuranceCoverage": "250000.00", "totalContentsInsuranceCoverage": "100000.00",
    "occupancyType": "1.0", "yearOfLoss": "2017", "causeOfDamage": "4", "ratedFloodZone": "AE",
    "primaryResidenceIndicator": "True", "originalConstructionDate": "1985-01-01",
    "numberOfFloorsInTheInsuredBuilding": "1.0", "elevatedBuildingIndicator": "False",
    "basementEnclosureCrawlspaceType": "0.0",
}
POLICY = {
    "propertyState": "TX", "countyCode": "48201", "floodZoneCurrent": None,
    "totalInsurancePremiumOfThePolicy": "1250", "buildingDeductibleCode": "2",
    "totalBuildingInsuranceCoverage": "250000", "totalContentsInsuranceCoverage": "100000",
    "policyEffectiveDate": "2017-01-01", "policyTerminationDate": "2018-01-01", "construction": "False",
    "occupancyType": "1", "numberOfFloorsInInsuredBuilding": "1.0", "primaryResidenceIndicator": "True",
    "crsClassCode": "7.0", "ratedFloodZone": "X", "originalConstructionDate": "1985-01-01",
    "elevatedBuildingIndicator": "False", "basementEnclosureCrawlspaceType": "0.0",
}


def bronze(spark, entity, rows):
    """Bronze rows from partial records; ``at`` is the ingestion second."""
    base, columns = (CLAIM, CLAIM_COLUMNS) if entity == "claims" else (POLICY, POLICY_COLUMNS)
    from datetime import datetime, timedelta

    data = []
    for row in rows:
        full = base | {k: v for k, v in row.items() if k != "at"}
        stamp = datetime(2024, 1, 1) + timedelta(seconds=row.get("at", 0))
        data.append((*(full[c] for c in columns), 1, stamp, full.get("state"), "here"))
    return spark.createDataFrame(data, bronze_schema(entity))


@pytest.fixture(scope="session")
def claims_rows(spark):
    return lambda *rows: bronze(spark, "claims", rows)


@pytest.fixture(scope="session")
def policy_rows(spark):
    return lambda *rows: bronze(spark, "policies", rows)
