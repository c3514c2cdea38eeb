"""Data-quality checks. Every check is a row of one long result table.

All checks on a table share one aggregation over it; the rows are unfolded from its single result
row. A count above its threshold gives FAIL or WARNING, informational rows give INFO.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodledger.operators.lookup import is_orphan, probe_keys
from floodledger.operators.shares import share_of_total
from floodledger.plans.layers import Silver, Star
from floodledger.plans.views import loss_ratio
from floodledger.schemas import CHECK, LOSS_YEARS, UNKNOWN_KEY, conform


@dataclass(frozen=True)
class Check:
    """A named count: ``observed`` is an aggregate, ``severity`` the status above the threshold."""

    name: str
    observed: Column
    severity: str = "FAIL"
    threshold: int | None = 0
    detail: Column | None = None
    suite: str | None = None


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def run_checks(df: DataFrame, suite: str, entity: str, checks: Sequence[Check]) -> DataFrame:
    """The rows of several checks on one table, from one aggregation."""
    totals = df.agg(
        *(c.observed.cast("bigint").alias(f"o{i}") for i, c in enumerate(checks)),
        *(c.detail.alias(f"d{i}") for i, c in enumerate(checks) if c.detail is not None),
    )
    rows = ", ".join(
        f"'{c.suite or suite}', '{c.name}', o{i}, CAST({'NULL' if c.threshold is None else c.threshold} AS BIGINT), '{c.severity}',"
        f" {'d' + str(i) if c.detail is not None else repr('')}"
        for i, c in enumerate(checks)
    )
    long = totals.selectExpr(
        f"stack({len(checks)}, {rows}) AS (suite, check_name, observed, threshold, severity, detail)"
    )
    status = (
        "CASE WHEN threshold IS NULL THEN 'INFO' WHEN observed <= threshold THEN 'PASS' ELSE severity END"
    )
    return conform(
        long.selectExpr("*", f"'{entity}' AS entity", f"{status} AS status"), CHECK
    )


def union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ row counts


def layer_counts(suite: str, entity: str, bronze: DataFrame, silver: DataFrame, gold: DataFrame | None = None) -> DataFrame:
    """Rows per layer, rows lost between layers, and a failure if gold has more rows than silver."""
    sides = {"bronze": bronze, "silver": silver} | ({} if gold is None else {"gold": gold})
    counted = union(
        [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(layer).alias("layer"), "n") for layer, df in sides.items()]
    )

    def n(layer: str) -> Column:
        return F.sum(F.when(F.col("layer") == layer, F.col("n")).otherwise(0))

    checks = [Check(f"{layer}_rows", n(layer), threshold=None) for layer in sides]
    checks.append(Check("bronze_to_silver_delta", n("bronze") - n("silver"), threshold=None))
    if gold is not None:
        checks.append(Check("silver_to_gold_delta", n("silver") - n("gold"), threshold=None))
        fan_out = F.greatest(n("gold") - n("silver"), F.lit(0))
        checks.append(Check("gold_within_silver", fan_out))
    return run_checks(counted, suite, entity, checks)


def dim_counts(star: Star) -> DataFrame:
    rows = Check("dim_rows", F.count(F.lit(1)), threshold=None)
    return union([run_checks(df, "row_counts", name, [rows]) for name, df in _dims(star).items()])


def _dims(star: Star) -> dict[str, DataFrame]:
    return {name: df for name, df in vars(star).items() if name.startswith("dim_")}


def _dim_key(name: str) -> str:
    return name.removeprefix("dim_") + "_key"


# ---------------------------------------------------------------------- silver


def null_checks(columns: Sequence[str]) -> list[Check]:
    return [Check(f"null_{c}", count_where(F.col(c).isNull())) for c in columns]


def critical_nulls(df: DataFrame, entity: str, columns: Sequence[str]) -> DataFrame:
    return run_checks(df, "silver", entity, null_checks(columns))


CRITICAL = {
    "claims": ["dateOfLoss", "state", "amountPaidTotal", "yearOfLoss", "accident_year"],
    "policies": ["propertyState", "policyEffectiveDate", "totalPremium", "buildingCoverage"],
}


def negative_checks() -> list[Check]:
    """Counts only: negative amounts are adjustments and reversals."""
    paid = ["amountPaidOnBuildingClaim", "amountPaidOnContentsClaim", "amountPaidTotal"]
    return [Check(f"negative_{c}", count_where(F.col(c) < 0), threshold=None) for c in paid]


def exposure_check() -> Check:
    term = F.col("exposure")
    summary = F.format_string(
        "min=%s max=%s avg=%s",
        F.min(term).cast("string"), F.max(term).cast("string"), F.avg(term).cast("decimal(8,6)").cast("string"),
    )
    return Check("exposure_outside_0_1", count_where((term < 0) | (term > 1)), detail=summary)


def mismatch_check() -> Check:
    """Claims whose stated year of loss is not the year of their loss date."""
    differs = ~F.col("yearOfLoss").eqNullSafe(F.col("accident_year"))
    return Check("year_of_loss_differs", count_where(differs), threshold=None)


def negative_amounts(claims: DataFrame) -> DataFrame:
    return run_checks(claims, "silver", "claims", negative_checks())


def exposure_range(policies: DataFrame) -> DataFrame:
    return run_checks(policies, "silver", "policies", [exposure_check()])


def year_mismatch(claims: DataFrame) -> DataFrame:
    return run_checks(claims, "silver", "claims", [mismatch_check()])


def zone_distribution(df: DataFrame) -> DataFrame:
    """Rows and percentage per zone category, largest first."""
    by = ["zone_category", "is_special_flood_hazard"]
    return share_of_total(df, by).orderBy(F.desc("n"), *by)


def zone_distribution_rows(df: DataFrame, suite: str, entity: str) -> DataFrame:
    shares = zone_distribution(df)
    long = shares.select(
        F.lit(suite).alias("suite"),
        F.concat(F.lit("zone_"), F.col("zone_category")).alias("check_name"),
        F.lit(entity).alias("entity"),
        F.lit("INFO").alias("status"),
        F.col("n").alias("observed"),
        F.lit(None).cast("bigint").alias("threshold"),
        F.format_string("pct=%s hazard=%s", F.col("pct").cast("string"), F.col("is_special_flood_hazard").cast("string")).alias("detail"),
    )
    return conform(long, CHECK)


# ------------------------------------------------------------------------ gold


def dim_keys(star: Star) -> DataFrame:
    """Missing and repeated keys of every dimension."""
    parts = []
    for name, df in _dims(star).items():
        key = F.col(_dim_key(name))
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        checks = [
            Check("null_key", F.coalesce(F.sum(F.when(key.isNull(), F.col("n"))), F.lit(0))),
            Check("duplicate_key", count_where(key.isNotNull() & (F.col("n") > 1))),
        ]
        parts.append(run_checks(per_key, "dimensions", name, checks))
    return union(parts)


def edges(star: Star, entity: str) -> list[tuple[str, DataFrame, str]]:
    """The key columns of a fact with the dimension each must resolve in."""
    dates = {"claims": ["date_key"], "policies": ["effective_date_key", "termination_date_key"]}
    shared = ["location", "flood_zone", "building_type", "occupancy"]
    return [(key, star.dim_date, "date_key") for key in dates[entity]] + [
        (f"{d}_key", getattr(star, f"dim_{d}"), f"{d}_key") for d in shared
    ]


def orphan_checks(star: Star, entity: str) -> list[Check]:
    return [
        Check(f"orphan_{key}", F.count_if(is_orphan(key)), suite="referential_integrity")
        for key, _, _ in edges(star, entity)
    ]


def unknown_checks(star: Star, entity: str) -> list[Check]:
    """Fact rows that resolved to the Unknown member, per key: no orphans, but worth a look."""
    return [
        Check(f"unknown_{key}", count_where(F.col(key) == UNKNOWN_KEY), "WARNING", suite="referential_integrity")
        for key, _, _ in edges(star, entity)
    ]


def policy_checks(strict: bool) -> list[Check]:
    """Premium sign and exposure range. Negative premiums are refunds: a failure only if strict."""
    term = F.col("exposure")
    return [
        Check("premium_not_negative", count_where(F.col("total_premium") < 0), _severity(strict)),
        Check("exposure_in_range", count_where((term < 0) | (term > 1))),
    ]


def claim_checks(strict: bool) -> list[Check]:
    """Signs of paid amounts, and paid above coverage, which supplements can explain."""
    checks = [
        Check(f"paid_{part}_not_negative", count_where(F.col(f"amount_paid_{part}") < 0), _severity(strict))
        for part in ("total", "building", "contents")
    ]
    for part in ("building", "contents"):
        paid, cover = F.col(f"amount_paid_{part}"), F.col(f"total_{part}_coverage")
        checks.append(Check(f"paid_within_{part}_coverage", count_where((paid > cover) & (cover > 0)), "WARNING"))
    return checks


def loss_date_check(years: tuple[int, int] = LOSS_YEARS) -> Check:
    """Loss dates outside the expected years; the detail shows first and last date.

    A date that the calendar does not have resolves to its Unknown member, whose year is NULL; silver
    has no row without a date, so such a row is outside the range.
    """
    span = F.concat_ws(" to ", F.min("full_date").cast("string"), F.max("full_date").cast("string"))
    return Check("loss_date_in_range", count_where(F.col("year").isNull() | ~F.col("year").between(*years)), detail=span)


def _severity(strict: bool) -> str:
    return "FAIL" if strict else "WARNING"


def fact_orphans(star: Star, entity: str) -> DataFrame:
    """Fact rows without a dimension row, per key."""
    probed = probe_keys(getattr(star, f"fact_{entity}"), edges(star, entity))
    return run_checks(probed, "referential_integrity", entity, orphan_checks(star, entity))


def unknown_members(star: Star, entity: str) -> DataFrame:
    """Fact rows of the Unknown member, per key, from the fact alone."""
    return run_checks(getattr(star, f"fact_{entity}"), "referential_integrity", entity, unknown_checks(star, entity))


def policy_rules(star: Star, strict: bool = False) -> DataFrame:
    return run_checks(star.fact_policies, "business_rules", "policies", policy_checks(strict))


def claim_rules(star: Star, strict: bool = False) -> DataFrame:
    return run_checks(star.fact_claims, "business_rules", "claims", claim_checks(strict))


def loss_date_range(star: Star, years: tuple[int, int] = LOSS_YEARS) -> DataFrame:
    dated = star.fact_claims.join(star.dim_date, "date_key")
    return run_checks(dated, "business_rules", "claims", [loss_date_check(years)])


def fact_checks(star: Star, entity: str, strict: bool = False) -> DataFrame:
    """Orphans, Unknown members, rules and loss dates of a fact together, from one pass over it."""
    carry = {"date_key": ["full_date", "year"]} if entity == "claims" else {}
    rules = [*claim_checks(strict), loss_date_check()] if entity == "claims" else policy_checks(strict)
    probed = probe_keys(getattr(star, f"fact_{entity}"), edges(star, entity), carry)
    keys = [*orphan_checks(star, entity), *unknown_checks(star, entity)]
    return run_checks(probed, "business_rules", entity, [*keys, *rules])


def extreme_loss_ratios(star: Star, limit: float = 10.0, grain: str = "state") -> DataFrame:
    """Places and years with a loss ratio above the limit, highest first."""
    ratios = loss_ratio(star, grain).where(F.col("loss_ratio") > limit)
    return ratios.orderBy(F.desc("loss_ratio"), "state_name", "year")


def loss_ratio_rule(star: Star, limit: float = 10.0) -> DataFrame:
    """The view is checked at its own grain, state and county."""
    check = Check("loss_ratio_sane", count_where(F.col("loss_ratio") > limit), "WARNING")
    return run_checks(loss_ratio(star), "business_rules", "portfolio", [check])


# ---------------------------------------------------------------------- suites


def silver_suite(bronze: dict[str, DataFrame], silver: Silver) -> DataFrame:
    claims, policies = silver.claims_cleaned, silver.policies_cleaned
    return union(
        [
            layer_counts("silver", "claims", bronze["claims"], claims),
            layer_counts("silver", "policies", bronze["policies"], policies),
            run_checks(
                claims, "silver", "claims",
                [*null_checks(CRITICAL["claims"]), *negative_checks(), mismatch_check()],
            ),
            run_checks(
                policies, "silver", "policies", [*null_checks(CRITICAL["policies"]), exposure_check()]
            ),
            zone_distribution_rows(claims, "silver", "claims"),
            zone_distribution_rows(policies, "silver", "policies"),
        ]
    )


def gold_suite(bronze: dict[str, DataFrame], silver: Silver, star: Star, strict: bool = False) -> DataFrame:
    zones = star.dim_flood_zone
    return union(
        [
            layer_counts("row_counts", "claims", bronze["claims"], silver.claims_cleaned, star.fact_claims),
            layer_counts("row_counts", "policies", bronze["policies"], silver.policies_cleaned, star.fact_policies),
            dim_counts(star),
            dim_keys(star),
            fact_checks(star, "claims", strict),
            fact_checks(star, "policies", strict),
            loss_ratio_rule(star),
            zone_distribution_rows(star.fact_claims.join(zones, "flood_zone_key"), "business_rules", "claims"),
            zone_distribution_rows(star.fact_policies.join(zones, "flood_zone_key"), "business_rules", "policies"),
        ]
    )


class ChecksFailed(RuntimeError):
    """At least one check has the status FAIL."""


def raise_on_failure(results: DataFrame) -> None:
    failed = results.where("status = 'FAIL'").orderBy("suite", "entity", "check_name").limit(50).collect()
    if failed:
        raise ChecksFailed(", ".join(f"{r.suite}/{r.entity}/{r.check_name}={r.observed}" for r in failed))
