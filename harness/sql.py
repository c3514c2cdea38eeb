"""The comparison SQL: shared expressions and common table expressions.

Written independently of the Spark plans, for an engine that reads the same Parquet files. Every
table expression names the ones it needs; ``with_ctes`` puts the needed ones in front of a query.
"""

from __future__ import annotations

from floodledger.schemas import CLAIM_COLUMNS, CLAIM_KEY, MISSING_TOKENS, POLICY_COLUMNS, POLICY_KEY


def code(x: str) -> str:
    return rf"regexp_replace(upper(trim({x})), '^(\d+)\.0+$', '\1')"


def date(x: str) -> str:
    return (
        rf"CASE WHEN regexp_matches(trim({x}), '^\d{{4}}-\d{{2}}-\d{{2}}([T ].*)?$')"
        rf" THEN TRY_CAST(substr(trim({x}), 1, 10) AS DATE) END"
    )


def money(x: str) -> str:
    return f"COALESCE(TRY_CAST(trim({x}) AS DECIMAL(18,2)), 0)"


def integer(x: str) -> str:
    return f"TRY_CAST({code(x)} AS INT)"


def zone_category(z: str) -> str:
    return (
        f"CASE WHEN {z} LIKE 'V%' THEN 'V' WHEN {z} LIKE 'A%' THEN 'A'"
        f" WHEN {z} LIKE 'X%' OR {z} LIKE 'B%' OR {z} LIKE 'C%' THEN 'X'"
        f" WHEN {z} = 'D' THEN 'D' ELSE 'Unknown' END"
    )


def hazard(z: str) -> str:
    return f"CASE WHEN {z} LIKE 'V%' OR {z} LIKE 'A%' THEN 1 ELSE 0 END"


def band(y: str) -> str:
    year = f"TRY_CAST(substr({y}, 1, 4) AS INT)"
    decades = " ".join(
        f"WHEN {year} BETWEEN {d} AND {d + 9} THEN '{d}-{d + 9}'" for d in range(1970, 2020, 10)
    )
    return (
        f"CASE WHEN {year} < 1970 THEN 'Pre-1970' {decades}"
        f" WHEN {year} >= 2020 THEN '2020+' ELSE 'Unknown' END"
    )


def date_key(d: str) -> str:
    return f"CAST(strftime({d}, '%Y%m%d') AS INT)"


def ratio(n: str, d: str) -> str:
    return f"CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0)"


def percent2(n: str, total: str) -> str:
    """Percentage with two digits, rounded half up in whole numbers."""
    return f"CAST((({n}) * 20000 + ({total})) // (2 * ({total})) AS DOUBLE) / 100"


def growth(cur: str, prev: str) -> str:
    return f"CASE WHEN {prev} > 0 THEN {ratio(f'({cur} - {prev})', prev)} * 100 END"


def _flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'True' ELSE 'False' END"


_P = "CAST(l_extendedprice AS DECIMAL(12,2))"
_B = f"{_P} * CAST(l_discount AS DECIMAL(4,2))"
_PREMIUM = "CAST(o_totalprice AS DECIMAL(18,2))"
_START = "CAST(o_orderdate AS DATE)"

_CLAIM_SQL = {
    "dateOfLoss": "CASE WHEN l_orderkey % 97 = 0 THEN 'not-a-date' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END",
    "state": "r_name",
    "countyCode": "CASE WHEN l_orderkey % 89 <> 0 THEN lpad(CAST(n_nationkey AS VARCHAR), 5, '0') END",
    "floodZoneCurrent": "CASE WHEN l_linenumber = 7 THEN 'X' END",
    "amountPaidOnBuildingClaim": f"CASE WHEN l_linenumber <> 5 THEN CAST(CASE WHEN l_orderkey % 101 = 0 THEN -({_B}) ELSE {_B} END AS VARCHAR) END",
    "amountPaidOnContentsClaim": f"CASE WHEN l_linenumber = 5 THEN '' ELSE CAST({_P} * CAST(l_tax AS DECIMAL(4,2)) AS VARCHAR) END",
    "totalBuildingInsuranceCoverage": f"CAST({_P} AS VARCHAR)",
    "totalContentsInsuranceCoverage": "CAST(CAST(CAST(l_quantity AS DECIMAL(12,2)) * 1000 AS DECIMAL(18,2)) AS VARCHAR)",
    "occupancyType": "CASE WHEN l_orderkey % 83 <> 0 THEN substr(o_orderpriority, 1, 1) || CASE WHEN l_orderkey % 2 = 0 THEN '.0' ELSE '' END END",
    "yearOfLoss": "CAST(year(l_shipdate) AS VARCHAR)",
    "causeOfDamage": "l_linestatus",
    "ratedFloodZone": (
        "CASE WHEN l_linenumber >= 6 THEN NULL WHEN p_type = 'ECONOMY' THEN ' AE ' WHEN p_type = 'LARGE' THEN 'VE'"
        " WHEN p_type = 'MEDIUM' THEN 'x' WHEN p_type = 'PROMO' THEN 'C' WHEN p_type = 'SMALL' THEN 'D'"
        " ELSE 'A' || lpad(CAST(p_size AS VARCHAR), 2, '0') END"
    ),
    "primaryResidenceIndicator": _flag("o_orderstatus = 'F'"),
    "originalConstructionDate": "CASE WHEN p_size = 50 THEN 'unknown' ELSE CAST(1960 + p_size + l_linenumber * 3 AS VARCHAR) || '-01-01' END",
    "numberOfFloorsInTheInsuredBuilding": "CAST(l_linenumber AS VARCHAR) || '.0'",
    "elevatedBuildingIndicator": _flag("p_size % 4 = 0"),
    "basementEnclosureCrawlspaceType": "CASE WHEN p_size % 2 <> 0 THEN CAST(p_size % 5 AS VARCHAR) END",
}
_POLICY_SQL = {
    "propertyState": "r_name",
    "countyCode": "lpad(CAST(n_nationkey AS VARCHAR), 5, '0')",
    "floodZoneCurrent": "CASE WHEN o_orderkey % 3 = 0 THEN 'X' END",
    "totalInsurancePremiumOfThePolicy": f"CAST({_PREMIUM} AS VARCHAR)",
    "buildingDeductibleCode": "CASE WHEN o_orderkey % 10 = 9 THEN 'F' ELSE CAST(o_orderkey % 10 AS VARCHAR) END",
    "totalBuildingInsuranceCoverage": f"CAST(CAST({_PREMIUM} * 200 AS DECIMAL(18,2)) AS VARCHAR)",
    "totalContentsInsuranceCoverage": f"CAST(CAST({_PREMIUM} * 50 AS DECIMAL(18,2)) AS VARCHAR)",
    "policyEffectiveDate": f"CAST({_START} AS VARCHAR)",
    "policyTerminationDate": (
        f"CASE WHEN o_orderkey % 107 = 0 THEN NULL WHEN o_orderkey % 103 = 0 THEN CAST({_START} - 10 AS VARCHAR)"
        f" ELSE CAST({_START} + CAST(o_orderkey % 400 AS INT) AS VARCHAR) END"
    ),
    "construction": _flag("o_orderstatus = 'P'"),
    "occupancyType": "substr(o_orderpriority, 1, 1)",
    "numberOfFloorsInInsuredBuilding": "CAST(o_orderkey % 6 + 1 AS VARCHAR)",
    "primaryResidenceIndicator": _flag("o_orderstatus = 'F'"),
    "crsClassCode": "CASE WHEN o_orderkey % 2 <> 0 THEN CAST(o_orderkey % 10 + 1 AS VARCHAR) || '.0' END",
    "ratedFloodZone": (
        "CASE WHEN o_orderkey % 109 = 0 THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 'AE'"
        " WHEN c_mktsegment = 'MACHINERY' THEN 'VE' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'X'"
        " WHEN c_mktsegment = 'FURNITURE' THEN 'C' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'D' END"
    ),
    "originalConstructionDate": "CAST(1960 + o_custkey % 65 AS VARCHAR) || '-01-01'",
    "elevatedBuildingIndicator": _flag("o_custkey % 4 = 0"),
    "basementEnclosureCrawlspaceType": "CAST(o_orderkey % 5 AS VARCHAR)",
}
_PLACES = (
    "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
    " JOIN region ON n_regionkey = r_regionkey"
)
_TOKENS = ", ".join(f"'{t}'" for t in MISSING_TOKENS)


def _landed(columns: list[str], expressions: dict[str, str], seq: str, source: str) -> str:
    items = ", ".join(f"{expressions[c]} AS {c}" for c in columns)
    return f"SELECT {items}, {seq} AS ingest_seq FROM {source}"


def _raw(columns: list[str], landed: str) -> str:
    items = ", ".join(f"CASE WHEN {c} IN ({_TOKENS}) THEN NULL ELSE {c} END AS {c}" for c in columns)
    return f"SELECT {items}, ingest_seq FROM {landed}"


def _latest(columns: list[str], key: list[str], raw: str, date_column: str) -> str:
    rest = ", ".join(f"{c} ASC NULLS FIRST" for c in columns if c not in key)
    return (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(key)}"
        f" ORDER BY ingest_seq DESC, {rest}) AS rn FROM {raw} WHERE {date(date_column)} IS NOT NULL) WHERE rn = 1"
    )


_ZONE = "upper(trim(COALESCE(ratedFloodZone, floodZoneCurrent)))"
_BUILDING_MATCH = (
    "bt.construction_class = s.construction_class AND bt.number_of_floors = s.number_of_floors"
    " AND bt.year_built_band = s.year_built_band AND bt.elevated_flag = s.elevated_flag"
    " AND bt.basement_type = s.basement_type"
)
_FLOORS = "COALESCE(numberOfFloors, 'Unknown') AS number_of_floors"
_ELEVATED = "CASE WHEN upper(elevatedBuildingIndicator) = 'TRUE' THEN 1 ELSE 0 END AS elevated_flag"
_BASEMENT = "COALESCE(basementEnclosureCrawlspaceType, 'Unknown') AS basement_type"


def _building(construction: str) -> str:
    return f"{construction} AS construction_class, {_FLOORS}, {band('yearBuilt')} AS year_built_band, {_ELEVATED}, {_BASEMENT}"


# name -> (needed table expressions, SQL)
CTES: dict[str, tuple[str, str]] = {
    "landed_claims": (
        "",
        _landed(
            CLAIM_COLUMNS, _CLAIM_SQL, "l_orderkey",
            f"lineitem JOIN ({_PLACES}) ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey",
        ),
    ),
    "landed_policies": ("", _landed(POLICY_COLUMNS, _POLICY_SQL, "o_orderkey", _PLACES)),
    "raw_claims": ("landed_claims", _raw(CLAIM_COLUMNS, "landed_claims")),
    "raw_policies": ("landed_policies", _raw(POLICY_COLUMNS, "landed_policies")),
    "latest_claims": ("raw_claims", _latest(CLAIM_COLUMNS, CLAIM_KEY, "raw_claims", "dateOfLoss")),
    "latest_policies": (
        "raw_policies", _latest(POLICY_COLUMNS, POLICY_KEY, "raw_policies", "policyEffectiveDate")
    ),
    "claims": (
        "latest_claims",
        f"SELECT *, amountPaidOnBuildingClaim + amountPaidOnContentsClaim AS amountPaidTotal,"
        f" CAST(year(dateOfLoss) AS INT) AS accident_year, {zone_category('floodZone')} AS zone_category,"
        f" {hazard('floodZone')} AS is_special_flood_hazard FROM (SELECT"
        f" {date('dateOfLoss')} AS dateOfLoss, {code('state')} AS state, {code('countyCode')} AS countyCode,"
        f" {_ZONE} AS floodZone, {money('amountPaidOnBuildingClaim')} AS amountPaidOnBuildingClaim,"
        f" {money('amountPaidOnContentsClaim')} AS amountPaidOnContentsClaim,"
        f" {money('totalBuildingInsuranceCoverage')} AS totalBuildingInsuranceCoverage,"
        f" {money('totalContentsInsuranceCoverage')} AS totalContentsInsuranceCoverage,"
        f" {code('occupancyType')} AS occupancyType, {integer('yearOfLoss')} AS yearOfLoss,"
        f" trim(causeOfDamage) AS causeOfDamage, upper(trim(ratedFloodZone)) AS ratedFloodZone,"
        f" trim(primaryResidenceIndicator) AS primaryResidence,"
        f" substr(trim(originalConstructionDate), 1, 4) AS yearBuilt,"
        f" {code('numberOfFloorsInTheInsuredBuilding')} AS numberOfFloors,"
        f" trim(elevatedBuildingIndicator) AS elevatedBuildingIndicator,"
        f" {code('basementEnclosureCrawlspaceType')} AS basementEnclosureCrawlspaceType FROM latest_claims)",
    ),
    "policies": (
        "latest_policies",
        f"SELECT *, CASE WHEN policyEffectiveDate IS NULL OR policyTerminationDate IS NULL THEN CAST(0 AS DECIMAL(8,6))"
        f" ELSE CAST(least(1.0, greatest(0.0, CAST(datediff('day', policyEffectiveDate, policyTerminationDate) AS DOUBLE) / 365.25)) AS DECIMAL(8,6)) END AS exposure,"
        f" {zone_category('floodZone')} AS zone_category, {hazard('floodZone')} AS is_special_flood_hazard FROM (SELECT"
        f" {code('propertyState')} AS propertyState, {code('countyCode')} AS countyCode, {_ZONE} AS floodZone,"
        f" {money('totalInsurancePremiumOfThePolicy')} AS totalPremium, {money('buildingDeductibleCode')} AS deductibleAmount,"
        f" {money('totalBuildingInsuranceCoverage')} AS buildingCoverage, {money('totalContentsInsuranceCoverage')} AS contentsCoverage,"
        f" {date('policyEffectiveDate')} AS policyEffectiveDate, {date('policyTerminationDate')} AS policyTerminationDate,"
        f" trim(construction) AS constructionClass, {code('occupancyType')} AS occupancyType,"
        f" {code('numberOfFloorsInInsuredBuilding')} AS numberOfFloors,"
        f" trim(primaryResidenceIndicator) AS primaryResidenceIndicator, {code('crsClassCode')} AS crsClassificationCode,"
        f" upper(trim(ratedFloodZone)) AS ratedFloodZone, substr(trim(originalConstructionDate), 1, 4) AS yearBuilt,"
        f" trim(elevatedBuildingIndicator) AS elevatedBuildingIndicator,"
        f" {code('basementEnclosureCrawlspaceType')} AS basementEnclosureCrawlspaceType FROM latest_policies)",
    ),
    "states": (
        "", "SELECT r_name AS state_abbrev, 'State of ' || r_name AS state_name, r_regionkey + 1 AS fema_region FROM region"
    ),
    "zones": (
        "",
        "SELECT * FROM (VALUES ('A', 'High-risk 1% annual chance', 1), ('V', 'Coastal high-risk with wave action', 1),"
        " ('X', 'Moderate-to-low risk', 0), ('D', 'Undetermined risk', 0), ('Unknown', 'Zone not mapped', 0))"
        " AS z(zone_category, zone_description, is_special_flood_hazard)",
    ),
    "dim_date": (
        "",
        f"SELECT -1 AS date_key, CAST(NULL AS DATE) AS full_date, CAST(NULL AS INT) AS year UNION ALL"
        f" SELECT {date_key('d')}, CAST(d AS DATE), CAST(year(d) AS INT)"
        f" FROM generate_series(DATE '1978-01-01', DATE '2030-12-31', INTERVAL 1 DAY) AS g(d)",
    ),
    "dim_location": (
        "claims policies states",
        "SELECT -1 AS location_key, 'ZZ' AS state_abbrev, 'Unknown' AS state_name, '00000' AS county_fips, 0 AS fema_region UNION ALL"
        " SELECT CAST(row_number() OVER (ORDER BY state_abbrev, county_fips) AS INT), state_abbrev,"
        " COALESCE(state_name, 'Unknown'), county_fips, COALESCE(fema_region, 0) FROM ("
        " SELECT state AS state_abbrev, COALESCE(countyCode, '00000') AS county_fips FROM claims WHERE state IS NOT NULL"
        " UNION SELECT propertyState, COALESCE(countyCode, '00000') FROM policies WHERE propertyState IS NOT NULL)"
        " LEFT JOIN states USING (state_abbrev)",
    ),
    "dim_flood_zone": (
        "claims policies zones",
        "SELECT -1 AS flood_zone_key, 'Unknown' AS flood_zone_code, 'Unknown' AS zone_category,"
        " 'Zone not mapped' AS zone_description, 0 AS is_special_flood_hazard UNION ALL"
        " SELECT CAST(row_number() OVER (ORDER BY flood_zone_code) AS INT), flood_zone_code, zone_category,"
        " COALESCE(zone_description, 'Zone not mapped'), COALESCE(is_special_flood_hazard, 0) FROM ("
        " SELECT floodZone AS flood_zone_code, zone_category FROM claims WHERE floodZone IS NOT NULL"
        " UNION SELECT floodZone, zone_category FROM policies WHERE floodZone IS NOT NULL)"
        " LEFT JOIN zones USING (zone_category)",
    ),
    "dim_building_type": (
        "claims policies",
        "SELECT -1 AS building_type_key, 'Unknown' AS construction_class, 'Unknown' AS number_of_floors,"
        " 'Unknown' AS year_built_band, 0 AS elevated_flag, 'Unknown' AS basement_type UNION ALL"
        " SELECT CAST(row_number() OVER (ORDER BY construction_class, number_of_floors, year_built_band, elevated_flag, basement_type) AS INT), *"
        f" FROM (SELECT {_building(chr(39) + 'N/A' + chr(39))} FROM claims UNION"
        f" SELECT {_building('COALESCE(constructionClass, ' + chr(39) + 'Unknown' + chr(39) + ')')} FROM policies)",
    ),
    "dim_occupancy": (
        "claims policies",
        "SELECT -1 AS occupancy_key, 'Unknown' AS occupancy_type, 0 AS residential_flag UNION ALL"
        " SELECT CAST(row_number() OVER (ORDER BY occupancy_type) AS INT), occupancy_type,"
        " CASE WHEN occupancy_type IN ('1', '2', '3', '11', '12', '15', '18') THEN 1 ELSE 0 END FROM ("
        " SELECT occupancyType AS occupancy_type FROM claims WHERE occupancyType IS NOT NULL"
        " UNION SELECT occupancyType FROM policies WHERE occupancyType IS NOT NULL)",
    ),
    "fact_claims": (
        "claims dim_date dim_location dim_flood_zone dim_building_type dim_occupancy",
        "SELECT COALESCE(dd.date_key, -1) AS date_key, COALESCE(l.location_key, -1) AS location_key,"
        " COALESCE(z.flood_zone_key, -1) AS flood_zone_key, COALESCE(bt.building_type_key, -1) AS building_type_key,"
        " COALESCE(o.occupancy_key, -1) AS occupancy_key, s.amountPaidOnBuildingClaim AS amount_paid_building,"
        " s.amountPaidOnContentsClaim AS amount_paid_contents, s.amountPaidTotal AS amount_paid_total,"
        " s.totalBuildingInsuranceCoverage AS total_building_coverage, s.totalContentsInsuranceCoverage AS total_contents_coverage,"
        " s.causeOfDamage AS cause_of_damage, s.yearOfLoss AS year_of_loss"
        f" FROM (SELECT *, {_building(chr(39) + 'N/A' + chr(39))} FROM claims) s"
        f" LEFT JOIN dim_date dd ON dd.date_key = {date_key('s.dateOfLoss')}"
        " LEFT JOIN dim_location l ON l.state_abbrev = s.state AND l.county_fips = COALESCE(s.countyCode, '00000')"
        " LEFT JOIN dim_flood_zone z ON z.flood_zone_code = s.floodZone"
        f" LEFT JOIN dim_building_type bt ON {_BUILDING_MATCH}"
        " LEFT JOIN dim_occupancy o ON o.occupancy_type = s.occupancyType",
    ),
    "fact_policies": (
        "policies dim_date dim_location dim_flood_zone dim_building_type dim_occupancy",
        "SELECT COALESCE(d1.date_key, -1) AS effective_date_key, COALESCE(d2.date_key, -1) AS termination_date_key,"
        " COALESCE(l.location_key, -1) AS location_key, COALESCE(z.flood_zone_key, -1) AS flood_zone_key,"
        " COALESCE(bt.building_type_key, -1) AS building_type_key, COALESCE(o.occupancy_key, -1) AS occupancy_key,"
        " s.totalPremium AS total_premium, s.deductibleAmount AS deductible_amount, s.buildingCoverage AS building_coverage,"
        " s.contentsCoverage AS contents_coverage, s.exposure, s.crsClassificationCode AS crs_class, 1 AS policy_count"
        f" FROM (SELECT *, {_building('COALESCE(constructionClass, ' + chr(39) + 'Unknown' + chr(39) + ')')} FROM policies) s"
        f" LEFT JOIN dim_date d1 ON d1.date_key = {date_key('s.policyEffectiveDate')}"
        f" LEFT JOIN dim_date d2 ON d2.date_key = {date_key('s.policyTerminationDate')}"
        " LEFT JOIN dim_location l ON l.state_abbrev = s.propertyState AND l.county_fips = COALESCE(s.countyCode, '00000')"
        " LEFT JOIN dim_flood_zone z ON z.flood_zone_code = s.floodZone"
        f" LEFT JOIN dim_building_type bt ON {_BUILDING_MATCH}"
        " LEFT JOIN dim_occupancy o ON o.occupancy_type = s.occupancyType",
    ),
    "claims_star": (
        "fact_claims",
        "SELECT * FROM fact_claims JOIN dim_date USING (date_key) JOIN dim_location USING (location_key)"
        " JOIN dim_flood_zone USING (flood_zone_key) JOIN dim_building_type USING (building_type_key)"
        " JOIN dim_occupancy USING (occupancy_key)",
    ),
    "policies_star": (
        "fact_policies",
        "SELECT * FROM fact_policies JOIN dim_date ON effective_date_key = date_key JOIN dim_location USING (location_key)"
        " JOIN dim_flood_zone USING (flood_zone_key) JOIN dim_building_type USING (building_type_key)"
        " JOIN dim_occupancy USING (occupancy_key)",
    ),
}


def with_ctes(names: str, sql: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for needed in CTES[name][0].split():
                visit(needed)
            ordered.append(name)

    for name in names.split():
        visit(name)
    head = ", ".join(f"{n} AS ({CTES[n][1]})" for n in ordered)
    return f"WITH {head} {sql}" if head else sql
