"""Data-quality checks (Q-C01 to Q-C19), on the built layers and on damaged copies of them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from floodledger.plans import quality, views
from harness.catalog.star import LOSS_RATIO_LOCATION, LOSS_RATIO_STATE
from harness.catalog import star  # noqa: F401  (its SQL is taken below)
from harness.registry import ORACLES, query
from harness.sql import percent2


def rows(suite: str, entity: str, source: str, *checks: tuple) -> str:
    """The check rows in SQL: (name, observed, severity or None for information[, detail])."""
    parts = []
    for name, observed, severity, *detail in checks:
        limit = "CAST(NULL AS BIGINT)" if severity is None else "CAST(0 AS BIGINT)"
        state = "'INFO'" if severity is None else f"CASE WHEN o <= 0 THEN 'PASS' ELSE '{severity}' END"
        parts.append(
            f"SELECT '{suite}' AS suite, '{name}' AS check_name, '{entity}' AS entity, {state} AS status, CAST(o AS BIGINT) AS observed,"
            f" {limit} AS threshold, d AS detail FROM (SELECT {observed} AS o, {detail[0] if detail else chr(39) * 2} AS d FROM {source})"
        )
    return " UNION ALL ".join(parts)


def n_where(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def _layers_sql(entity: str) -> str:
    b, s, g = (f"(SELECT count(*) FROM {t})" for t in (f"raw_{entity}", entity, f"fact_{entity}"))
    one = "(SELECT 1)"
    return rows(
        "row_counts", entity, one,
        ("bronze_rows", b, None), ("silver_rows", s, None), ("gold_rows", g, None),
        ("bronze_to_silver_delta", f"{b} - {s}", None), ("silver_to_gold_delta", f"{s} - {g}", None),
        ("gold_within_silver", f"greatest({g} - {s}, 0)", "FAIL"),
    )


@query("qc01_layer_counts_claims", "raw_claims claims fact_claims", _layers_sql("claims"))
def qc01(ws):
    return quality.layer_counts("row_counts", "claims", ws.bronze("claims"), ws.claims, ws.star.fact_claims)


@query("qc01_layer_counts_policies", "raw_policies policies fact_policies", _layers_sql("policies"))
def qc01_policies(ws):
    return quality.layer_counts("row_counts", "policies", ws.bronze("policies"), ws.policies, ws.star.fact_policies)


@query(
    "qc01_fan_out_found",
    "raw_claims claims fact_claims",
    "SELECT CASE WHEN x > 0 THEN 'FAIL' ELSE 'PASS' END AS status, x AS observed FROM"
    " (SELECT (SELECT count(*) FROM fact_claims WHERE flood_zone_key = -1) AS x)",
)
def qc01_fan_out(ws):
    """Facts with an unknown zone are doubled, as a second Unknown member would do."""
    fact = ws.star.fact_claims
    doubled = fact.unionByName(fact.where("flood_zone_key = -1"))
    result = quality.layer_counts("row_counts", "claims", ws.bronze("claims"), ws.claims, doubled)
    return result.where("check_name = 'gold_within_silver'").select("status", "observed")


@query(
    "qc02_dim_counts",
    "dim_date dim_location dim_flood_zone dim_building_type dim_occupancy claims",
    " UNION ALL ".join(
        rows("row_counts", d, d, ("dim_rows", "count(*)", None))
        for d in ("dim_date", "dim_location", "dim_flood_zone", "dim_building_type", "dim_occupancy")
    ),
)
def qc02(ws):
    return quality.dim_counts(ws.star)


@query(
    "qc03_critical_nulls_claims",
    "claims",
    rows("silver", "claims", "claims", *((f"null_{c}", n_where(f"{c} IS NULL"), "FAIL") for c in quality.CRITICAL["claims"])),
)
def qc03(ws):
    return quality.critical_nulls(ws.claims, "claims", quality.CRITICAL["claims"])


@query(
    "qc03_critical_nulls_found",
    "claims",
    rows("silver", "claims", "claims", ("null_state", n_where("floodZone IS NULL"), "FAIL"), ("null_yearOfLoss", n_where("accident_year = 1997"), "FAIL")),
)
def qc03_found(ws):
    """A damaged copy: no state where the zone is missing, no year of loss for 1997."""
    damaged = ws.claims.withColumns(
        {
            "state": F.when(F.col("floodZone").isNotNull(), F.col("state")),
            "yearOfLoss": F.when(F.col("accident_year") != 1997, F.col("yearOfLoss")),
        }
    )
    return quality.critical_nulls(damaged, "claims", ["state", "yearOfLoss"])


@query(
    "qc04_critical_nulls_policies",
    "policies",
    rows("silver", "policies", "policies", *((f"null_{c}", n_where(f"{c} IS NULL"), "FAIL") for c in quality.CRITICAL["policies"])),
)
def qc04(ws):
    return quality.critical_nulls(ws.policies, "policies", quality.CRITICAL["policies"])


@query(
    "qc05_negative_amounts",
    "claims",
    rows(
        "silver", "claims", "claims",
        *((f"negative_{c}", n_where(f"{c} < 0"), None) for c in ("amountPaidOnBuildingClaim", "amountPaidOnContentsClaim", "amountPaidTotal")),
    ),
)
def qc05(ws):
    return quality.negative_amounts(ws.claims)


@query(
    "qc06_exposure_range",
    "policies",
    "SELECT 'exposure_outside_0_1' AS check_name, CASE WHEN count(*) FILTER (WHERE exposure < 0 OR exposure > 1) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,"
    " count(*) FILTER (WHERE exposure < 0 OR exposure > 1) AS observed, CAST(min(exposure) AS VARCHAR) AS lowest, CAST(max(exposure) AS VARCHAR) AS highest FROM policies",
)
def qc06(ws):
    detail = F.col("detail")
    return quality.exposure_range(ws.policies).select(
        "check_name", "status", "observed",
        F.regexp_extract(detail, "min=([^ ]*)", 1).alias("lowest"), F.regexp_extract(detail, "max=([^ ]*)", 1).alias("highest"),
    )


def _distribution(table: str) -> str:
    return (
        f"SELECT zone_category, is_special_flood_hazard AS hazard, n, {percent2('n', 'total')} AS pct FROM (SELECT zone_category, is_special_flood_hazard,"
        f" count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM {table} GROUP BY 1, 2)"
    )


def _plain(df):
    return df.withColumnRenamed("is_special_flood_hazard", "hazard")


@query("qc07_zone_distribution_claims", "claims", _distribution("claims"))
def qc07(ws):
    return _plain(quality.zone_distribution(ws.claims))


@query("qc07_zone_distribution_policies", "policies", _distribution("policies"))
def qc07_policies(ws):
    return _plain(quality.zone_distribution(ws.policies))


_DIM_KEYS = {
    "dim_date": "date_key", "dim_location": "location_key", "dim_flood_zone": "flood_zone_key",
    "dim_building_type": "building_type_key", "dim_occupancy": "occupancy_key",
}


@query(
    "qc08_qc09_dim_keys",
    "dim_date dim_location dim_flood_zone dim_building_type dim_occupancy",
    " UNION ALL ".join(
        rows("dimensions", d, d, ("null_key", n_where(f"{k} IS NULL"), "FAIL"), ("duplicate_key", f"count(*) - count(DISTINCT {k})", "FAIL"))
        for d, k in _DIM_KEYS.items()
    ),
)
def qc08(ws):
    return quality.dim_keys(ws.star)


@query(
    "qc09_duplicates_found",
    "dim_building_type",
    "SELECT check_name, status, observed FROM (" + rows(
        "dimensions", "dim_building_type", "dim_building_type",
        ("null_key", n_where("year_built_band = 'Pre-1970'"), "FAIL"), ("duplicate_key", n_where("elevated_flag = 1 AND year_built_band <> 'Pre-1970'"), "FAIL"),
    ) + ")",
)
def qc09_found(ws):
    """A damaged dimension: some keys missing, the keys of elevated buildings twice."""
    good = ws.star.dim_building_type
    key = F.when(F.col("year_built_band") != "Pre-1970", F.col("building_type_key"))
    damaged = good.withColumn("building_type_key", key)
    damaged = damaged.unionByName(damaged.where("elevated_flag = 1 AND building_type_key IS NOT NULL"))
    found = quality.dim_keys(replace(ws.star, dim_building_type=damaged))
    return found.where("entity = 'dim_building_type'").select("check_name", "status", "observed")


def _orphans_sql(entity: str, keys: dict[str, str], removed: str = "FALSE") -> str:
    checks = []
    for key, dim in keys.items():
        dim_key = _DIM_KEYS[dim]
        condition = f"{key} IS NULL OR NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{dim_key} = f.{key} AND NOT ({removed if dim == 'dim_date' else 'FALSE'}))"
        checks.append((f"orphan_{key}", f"(SELECT count(*) FROM fact_{entity} f WHERE {condition})", "FAIL"))
    return rows("referential_integrity", entity, "(SELECT 1)", *checks)


_SHARED = {"location_key": "dim_location", "flood_zone_key": "dim_flood_zone", "building_type_key": "dim_building_type", "occupancy_key": "dim_occupancy"}
_CLAIM_EDGES = {"date_key": "dim_date"} | _SHARED
_POLICY_EDGES = {"effective_date_key": "dim_date", "termination_date_key": "dim_date"} | _SHARED


@query("qc10_orphans_claims", "fact_claims", _orphans_sql("claims", _CLAIM_EDGES))
def qc10(ws):
    return quality.fact_orphans(ws.star, "claims")


@query("qc11_orphans_policies", "fact_policies", _orphans_sql("policies", _POLICY_EDGES))
def qc11(ws):
    return quality.fact_orphans(ws.star, "policies")


@query("qc11_orphans_found", "fact_policies", _orphans_sql("policies", _POLICY_EDGES, "d.year IS NOT DISTINCT FROM 1998"))
def qc11_found(ws):
    """The calendar lacks a year."""
    gap = ws.star.dim_date.where("year IS NULL OR year <> 1998")
    return quality.fact_orphans(replace(ws.star, dim_date=gap), "policies")


def _unknown_sql(entity: str, keys: dict[str, str]) -> str:
    return rows("referential_integrity", entity, f"fact_{entity}", *((f"unknown_{key}", n_where(f"{key} = -1"), "WARNING") for key in keys))


@query("qc10_unknown_members_claims", "fact_claims", _unknown_sql("claims", _CLAIM_EDGES))
def qc10_unknown(ws):
    return quality.unknown_members(ws.star, "claims")


@query("qc11_unknown_members_policies", "fact_policies", _unknown_sql("policies", _POLICY_EDGES))
def qc11_unknown(ws):
    return quality.unknown_members(ws.star, "policies")


_PREMIUM_RULES = rows(
    "business_rules", "policies", "fact_policies",
    ("premium_not_negative", n_where("total_premium < 0"), "WARNING"), ("exposure_in_range", n_where("exposure < 0 OR exposure > 1"), "FAIL"),
)


@query("qc12_qc14_policy_rules", "fact_policies", _PREMIUM_RULES)
def qc12(ws):
    return quality.policy_rules(ws.star)


@query(
    "qc12_qc14_found",
    "fact_policies",
    rows(
        "business_rules", "policies", "(SELECT total_premium - 100000 AS total_premium, exposure * 2 AS exposure FROM fact_policies)",
        ("premium_not_negative", n_where("total_premium < 0"), "FAIL"), ("exposure_in_range", n_where("exposure < 0 OR exposure > 1"), "FAIL"),
    ),
)
def qc12_found(ws):
    """Lowered premiums and doubled exposures, judged strictly."""
    damaged = ws.star.fact_policies.withColumns(
        {"total_premium": F.col("total_premium") - 100000, "exposure": F.col("exposure") * 2}
    )
    return quality.policy_rules(replace(ws.star, fact_policies=damaged), strict=True)


def _claim_rules_sql(severity: str) -> str:
    checks = [(f"paid_{p}_not_negative", n_where(f"amount_paid_{p} < 0"), severity) for p in ("total", "building", "contents")]
    checks += [
        (f"paid_within_{p}_coverage", n_where(f"amount_paid_{p} > total_{p}_coverage AND total_{p}_coverage > 0"), "WARNING")
        for p in ("building", "contents")
    ]
    return rows("business_rules", "claims", "fact_claims", *checks)


@query("qc13_qc15_claim_rules", "fact_claims", _claim_rules_sql("WARNING"))
def qc13(ws):
    return quality.claim_rules(ws.star)


@query("qc13_qc15_claim_rules_strict", "fact_claims", _claim_rules_sql("FAIL"))
def qc13_strict(ws):
    """Seeded negative amounts fail under strict rules."""
    return quality.claim_rules(ws.star, strict=True)


_SPAN = "CAST(min(full_date) AS VARCHAR) || ' to ' || CAST(max(full_date) AS VARCHAR)"


@query(
    "qc16_loss_date_range",
    "claims_star",
    rows("business_rules", "claims", "claims_star", ("loss_date_in_range", n_where("year NOT BETWEEN 1978 AND 2026"), "FAIL", _SPAN)),
)
def qc16(ws):
    return quality.loss_date_range(ws.star)


@query(
    "qc16_loss_dates_found",
    "claims_star",
    rows("business_rules", "claims", "claims_star", ("loss_date_in_range", n_where("year NOT BETWEEN 1996 AND 1999"), "FAIL", _SPAN)),
)
def qc16_found(ws):
    return quality.loss_date_range(ws.star, (1996, 1999))


@query(
    "qc17_extreme_loss_ratios",
    "claims_star policies_star",
    f"SELECT * FROM ({LOSS_RATIO_STATE}) WHERE loss_ratio > 0.022",
)
def qc17(ws):
    """The offenders, with a limit that some place-years exceed."""
    return quality.extreme_loss_ratios(ws.star, 0.022)


@query("qc18_zone_distribution_gold_claims", "claims_star", _distribution("(SELECT zone_category, is_special_flood_hazard FROM claims_star)"))
def qc18(ws):
    return _plain(quality.zone_distribution(ws.star.fact_claims.join(ws.star.dim_flood_zone, "flood_zone_key")))


@query("qc18_zone_distribution_gold_policies", "policies_star", _distribution("(SELECT zone_category, is_special_flood_hazard FROM policies_star)"))
def qc18_policies(ws):
    return _plain(quality.zone_distribution(ws.star.fact_policies.join(ws.star.dim_flood_zone, "flood_zone_key")))


@query(
    "qc19_top_rows_of_a_view",
    "fact_claims",
    "SELECT year_of_loss, count(*) AS claim_count, CAST(sum(amount_paid_total) AS DOUBLE) AS total_paid FROM fact_claims"
    " WHERE year_of_loss IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 5",
)
def qc19(ws):
    return views.top_of_view(ws.star, "vw_claims_development").select("year_of_loss", "claim_count", "total_paid")


#: View, query with its comparison SQL, measure to show.
SHOWN = [
    ("vw_loss_ratio_by_state", "v01_loss_ratio_by_location", "total_claims_paid"),
    ("vw_claims_frequency_severity", "v02_frequency_severity", "total_paid"),
    ("vw_large_loss_concentration", "v03_large_loss_concentration", "large_loss_total"),
    ("vw_severity_by_flood_zone", "v04_severity_by_zone", "avg_severity"),
    ("vw_premium_adequacy", "v05_premium_adequacy", "total_claims"),
    ("vw_claims_development", "v06_claims_development", "total_paid"),
    ("vw_portfolio_summary", "v07_portfolio_summary", "total_premium"),
]
AMOUNTS = {"large_loss_total", "avg_severity", "total_claims"}


def _leading(name: str, of: str, measure: str) -> str:
    order = views.TOP_ORDER[name]
    by = ", ".join(f"{c[1:]} DESC NULLS LAST" if c.startswith("-") else f"{c} ASC NULLS FIRST" for c in order)
    item = " || '/' || ".join(f"COALESCE(CAST({c.lstrip('-')} AS VARCHAR), 'none')" for c in order if c.lstrip("-") not in AMOUNTS)
    return (
        f"SELECT '{name}' AS view, CAST(row_number() OVER (ORDER BY {by}) AS INT) AS place, {item} AS item,"
        f" round(CAST({measure} AS DOUBLE), 4) AS measure FROM ({ORACLES[of]}) QUALIFY place <= 5"
    )


@query(
    "qc19_all_views_answer",
    "",
    " UNION ALL ".join(_leading(*shown) for shown in SHOWN),
)
def qc19_all(ws):
    """The five leading rows of every view: what they are of, and a measure."""
    parts = []
    for name, _, measure in SHOWN:
        order = [c.lstrip("-") for c in views.TOP_ORDER[name]]
        signs = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in views.TOP_ORDER[name]]
        item = F.concat_ws("/", *(F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in order if c not in AMOUNTS))
        place = F.row_number().over(Window.orderBy(*signs))  # over five rows
        parts.append(
            views.top_of_view(ws.star, name).select(
                F.lit(name).alias("view"), place.alias("place"), item.alias("item"), F.round(F.col(measure).cast("double"), 4).alias("measure")
            )
        )
    return quality.union(parts)


@query(
    "q21_year_mismatch",
    "claims",
    rows("silver", "claims", "claims", ("year_of_loss_differs", n_where("yearOfLoss IS DISTINCT FROM accident_year"), None)),
)
def q21(ws):
    return quality.year_mismatch(ws.claims)


def _zone_rows(suite: str, entity: str, source: str) -> str:
    """The distribution as check rows; the percentage is compared in the queries above."""
    return (
        f"SELECT '{suite}' AS suite, 'zone_' || zone_category AS check_name, '{entity}' AS entity, 'INFO' AS status, n AS observed,"
        f" CAST(NULL AS BIGINT) AS threshold FROM ({_distribution(source)})"
    )


def _no_detail(check_rows: str) -> str:
    return f"SELECT suite, check_name, entity, status, observed, threshold FROM ({check_rows})"


def _two_layers_sql(entity: str) -> str:
    b, s = f"(SELECT count(*) FROM raw_{entity})", f"(SELECT count(*) FROM {entity})"
    return rows(
        "silver", entity, "(SELECT 1)", ("bronze_rows", b, None), ("silver_rows", s, None), ("bronze_to_silver_delta", f"{b} - {s}", None)
    )


_EXPOSURE = rows("silver", "policies", "policies", ("exposure_outside_0_1", n_where("exposure < 0 OR exposure > 1"), "FAIL"))
_NEGATIVE = rows(
    "silver", "claims", "claims",
    *((f"negative_{c}", n_where(f"{c} < 0"), None) for c in ("amountPaidOnBuildingClaim", "amountPaidOnContentsClaim", "amountPaidTotal")),
)
_NULLS = [
    rows("silver", e, e, *((f"null_{c}", n_where(f"{c} IS NULL"), "FAIL") for c in quality.CRITICAL[e]))
    for e in ("claims", "policies")
]
_MISMATCH = rows("silver", "claims", "claims", ("year_of_loss_differs", n_where("yearOfLoss IS DISTINCT FROM accident_year"), None))


@query(
    "qc_silver_suite",
    "raw_claims raw_policies claims policies",
    " UNION ALL ".join(
        [
            *(_no_detail(part) for part in (_two_layers_sql("claims"), _two_layers_sql("policies"), *_NULLS, _NEGATIVE, _EXPOSURE, _MISMATCH)),
            _zone_rows("silver", "claims", "claims"),
            _zone_rows("silver", "policies", "policies"),
        ]
    ),
)
def silver_suite(ws):
    return quality.silver_suite({e: ws.bronze(e) for e in ("claims", "policies")}, ws.silver).drop("detail")


_DIM_ROWS = [rows("row_counts", d, d, ("dim_rows", "count(*)", None)) for d in _DIM_KEYS]
_DIM_CHECKS = [
    rows("dimensions", d, d, ("null_key", n_where(f"{k} IS NULL"), "FAIL"), ("duplicate_key", f"count(*) - count(DISTINCT {k})", "FAIL"))
    for d, k in _DIM_KEYS.items()
]
_GOLD = [
    _layers_sql("claims"), _layers_sql("policies"), *_DIM_ROWS, *_DIM_CHECKS,
    _orphans_sql("claims", _CLAIM_EDGES), _orphans_sql("policies", _POLICY_EDGES),
    _unknown_sql("claims", _CLAIM_EDGES), _unknown_sql("policies", _POLICY_EDGES), _PREMIUM_RULES, _claim_rules_sql("WARNING"),
    rows("business_rules", "claims", "claims_star", ("loss_date_in_range", n_where("year NOT BETWEEN 1978 AND 2026"), "FAIL")),
    rows("business_rules", "portfolio", f"({LOSS_RATIO_LOCATION})", ("loss_ratio_sane", n_where("loss_ratio > 10"), "WARNING")),
]


@query(
    "qc_gold_suite",
    "raw_claims raw_policies claims_star policies_star",
    " UNION ALL ".join(
        [
            *(_no_detail(part) for part in _GOLD),
            _zone_rows("business_rules", "claims", "(SELECT zone_category, is_special_flood_hazard FROM claims_star)"),
            _zone_rows("business_rules", "policies", "(SELECT zone_category, is_special_flood_hazard FROM policies_star)"),
        ]
    ),
)
def gold_suite(ws):
    layers = {e: ws.bronze(e) for e in ("claims", "policies")}
    return quality.gold_suite(layers, ws.silver, ws.star).drop("detail")
