"""The analytics views over the star schema.

Every view aggregates each fact to its grain first and joins dimensions or the other fact after
that, so only aggregates move between tasks. Sums stay decimal, quotients are doubles.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from floodledger.functions import derive
from floodledger.operators.drill import drill_across
from floodledger.operators.order_stats import exact_percentiles
from floodledger.plans.layers import Star


def _or_zero(name: str):
    return F.coalesce(F.col(name), F.lit(0))


def _rows(fact: DataFrame):
    """The number of fact rows, also of a fact that stands for sums of rows."""
    return F.sum("row_count") if "row_count" in fact.columns else F.count(F.lit(1))


def _year(star: Star, key: str = "date_key") -> tuple[DataFrame, str]:
    return star.dim_date.select(F.col("date_key").alias(key), "year"), key


def _total(fact: DataFrame, edges: Sequence[tuple[DataFrame, str]], by: Sequence[str], **measures):
    """Join the fact to its dimensions on their keys, then aggregate.

    The dimensions are small written tables, so the joins run inside the scan stage, partial sums
    are taken there too, and one shuffle moves a row per task and group.
    """
    for dim, key in edges:
        fact = fact.join(dim, key)
    return fact.groupBy(*by).agg(*(measure.alias(name) for name, measure in measures.items()))


def loss_ratio(star: Star, grain: str = "location") -> DataFrame:
    """Claims paid against premium per year; above 1 more is paid than collected.

    ``grain`` is ``location`` (state and county) or ``state``.
    """
    grains = {"location": ["state_name", "state_abbrev", "county_fips"], "state": ["state_name"]}
    place = grains[grain]
    places = (star.dim_location.select("location_key", *place), "location_key")
    by = [*place, "year"]
    claims = _total(
        star.fact_claims, [_year(star), places], by, total_claims_paid=F.sum("amount_paid_total")
    )
    policies = _total(
        star.fact_policies, [_year(star, "effective_date_key"), places], by,
        total_premium=F.sum("total_premium"), total_exposure=F.sum("exposure"),
    )
    return drill_across(claims, policies, by).select(
        *by,
        _or_zero("total_claims_paid").alias("total_claims_paid"),
        _or_zero("total_premium").alias("total_premium"),
        _or_zero("total_exposure").alias("total_exposure"),
        derive.safe_ratio(_or_zero("total_claims_paid"), F.col("total_premium")).alias("loss_ratio"),
    )


def frequency_severity(star: Star) -> DataFrame:
    """Claim frequency (claims per exposure) and severity (paid per claim) by zone category and year."""
    zones = (star.dim_flood_zone.select("flood_zone_key", "zone_category"), "flood_zone_key")
    by = ["zone_category", "year"]
    claims = _total(
        star.fact_claims, [_year(star), zones], by,
        claim_count=_rows(star.fact_claims), total_paid=F.sum("amount_paid_total"),
    )
    exposure = _total(
        star.fact_policies, [_year(star, "effective_date_key"), zones], by,
        total_exposure=F.sum("exposure"),
    )
    return drill_across(claims, exposure, by).select(
        *by,
        _or_zero("claim_count").alias("claim_count"),
        _or_zero("total_paid").alias("total_paid"),
        _or_zero("total_exposure").alias("total_exposure"),
        derive.safe_ratio(_or_zero("claim_count"), F.col("total_exposure")).alias("frequency"),
        derive.safe_ratio(F.col("total_paid"), F.col("claim_count")).alias("avg_severity"),
    )


def large_loss_threshold(fact_claims: DataFrame, p: float = 0.95, histogram: DataFrame | None = None) -> DataFrame:
    """One row: the percentile of the positive claims, NULL without any."""
    paid = fact_claims.where("amount_paid_total > 0")
    return exact_percentiles(paid, "amount_paid_total", [p], histogram=histogram).agg(
        F.max("percentile").alias("p95_threshold")
    )


def large_loss_concentration(star: Star, p: float = 0.95) -> DataFrame:
    """Claims at or above the percentile per state: count, total and share of the paid total."""
    threshold = large_loss_threshold(star.fact_claims, p).scalar()
    paid = F.col("amount_paid_total")
    flag = derive.large_loss_flag(paid.cast("double"), threshold)
    return large_losses_by_state(
        star, star.fact_claims.withColumn("is_large_loss", flag), threshold,
        large_loss_count=F.sum("is_large_loss"),
        large_loss_total=F.sum(F.when(F.col("is_large_loss") == 1, paid).otherwise(0)),
        total_paid=F.sum(paid),
    )


def large_losses_by_state(star: Star, claims: DataFrame, threshold: Column, **sums: Column) -> DataFrame:
    """The sums per state, with the share of the large losses."""
    places = (star.dim_location.select("location_key", "state_name"), "location_key")
    per_state = _total(claims, [places], ["state_name"], **sums)
    share = derive.safe_ratio(F.col("large_loss_total"), F.col("total_paid")) * 100
    return per_state.withColumns({"pct_of_total_paid": share, "p95_threshold": threshold})


ZONE = ["zone_category", "zone_description"]


def _positive_by_zone(star: Star) -> DataFrame:
    zones = star.dim_flood_zone.select("flood_zone_key", *ZONE)
    return star.fact_claims.where("amount_paid_total > 0").join(zones, "flood_zone_key")


def median_severity(star: Star, histogram: DataFrame | None = None) -> DataFrame:
    """The median of the positive claims by zone."""
    # Zone categories are a fixed list of five, so the groups of the median are few.
    paid = _positive_by_zone(star).select("amount_paid_total", *ZONE)
    median = exact_percentiles(paid, "amount_paid_total", [0.5], ZONE, few_groups=True, histogram=histogram)
    return median.select(*ZONE, F.col("percentile").alias("median_severity"))


def severity_by_zone(star: Star, median: DataFrame | None = None) -> DataFrame:
    """Average and median severity and the building and contents shares, positive claims only."""
    by = ZONE
    totals = _total(
        _positive_by_zone(star), [], by,
        claim_count=_rows(star.fact_claims),
        total=F.sum("amount_paid_total"),
        building=F.sum("amount_paid_building"),
        contents=F.sum("amount_paid_contents"),
    )
    median = median_severity(star) if median is None else median
    claims, total = F.col("claim_count"), F.col("total")
    return totals.join(median, by, "left").select(
        *by,
        "claim_count",
        derive.safe_ratio(total, claims).alias("avg_severity"),
        "median_severity",
        derive.safe_ratio(F.col("building"), claims).alias("avg_building_paid"),
        derive.safe_ratio(F.col("contents"), claims).alias("avg_contents_paid"),
        derive.safe_ratio(F.col("building"), total).alias("building_share"),
        derive.safe_ratio(F.col("contents"), total).alias("contents_share"),
    )


def premium_adequacy(
    star: Star, keys: Sequence[str] = ("occupancy_type", "construction_class")
) -> DataFrame:
    """Average premium against pure premium (claims per exposure).

    Claims carry no construction class, so with both keys the two sides hardly ever meet; with
    ``keys=["occupancy_type"]`` they do.
    """
    keys = list(keys)
    edges = [
        (star.dim_occupancy.select("occupancy_key", "occupancy_type"), "occupancy_key"),
        (star.dim_building_type.select("building_type_key", "construction_class"), "building_type_key"),
    ]
    claims = _total(star.fact_claims, edges, keys, total_claims=F.sum("amount_paid_total"))
    policies = _total(
        star.fact_policies, edges, keys,
        total_exposure=F.sum("exposure"),
        premium=F.sum("total_premium"),
        policy_count=_rows(star.fact_policies),
    )
    joined = drill_across(claims, policies, keys).withColumns(
        {
            "pure_premium": derive.safe_ratio(_or_zero("total_claims"), F.col("total_exposure")),
            "avg_premium": derive.safe_ratio(F.col("premium"), F.col("policy_count")),
        }
    )
    return joined.select(
        *keys,
        _or_zero("total_claims").alias("total_claims"),
        _or_zero("total_exposure").alias("total_exposure"),
        _or_zero("policy_count").alias("policy_count"),
        "pure_premium",
        "avg_premium",
        derive.adequacy_flag(
            F.col("avg_premium"), F.col("pure_premium"), F.col("total_exposure")
        ).alias("adequacy_flag"),
    )


def claims_development(star: Star) -> DataFrame:
    """Ultimate paid amounts by the year of loss the source states."""
    year = F.col("year_of_loss")
    totals = _total(
        star.fact_claims.where(year.isNotNull()), [], ["year_of_loss"],
        claim_count=_rows(star.fact_claims),
        total_paid=F.sum("amount_paid_total"),
        total_building_paid=F.sum("amount_paid_building"),
        total_contents_paid=F.sum("amount_paid_contents"),
    )
    average = derive.safe_ratio(F.col("total_paid"), F.col("claim_count"))
    return totals.select(
        "year_of_loss",
        "claim_count",
        "total_paid",
        average.alias("avg_paid_per_claim"),
        "total_building_paid",
        "total_contents_paid",
    )


def portfolio_summary(star: Star) -> DataFrame:
    """One row per policy year with growth against the row before.

    Claim years without policies do not appear. Policies outside the calendar form a row with
    a NULL year that is kept out of the growth chain.
    """
    # policy_sk is unique by construction, so counting rows counts policies
    policies = _total(
        star.fact_policies, [_year(star, "effective_date_key")], ["year"],
        total_policies=_rows(star.fact_policies),
        total_exposure=F.sum("exposure"),
        total_premium=F.sum("total_premium"),
    )
    claims = _total(
        star.fact_claims, [_year(star)], ["year"],
        total_claims_paid=F.sum("amount_paid_total"), claim_count=_rows(star.fact_claims),
    )
    yearly = policies.join(claims, "year", "left").withColumns(
        {"total_claims_paid": _or_zero("total_claims_paid"), "claim_count": _or_zero("claim_count")}
    )
    # A few rows per century: the window over years is small at any input size.
    chain = Window.partitionBy(F.col("year").isNull()).orderBy("year")
    premium, paid = F.col("total_premium"), F.col("total_claims_paid")
    with_prior = yearly.withColumns(
        {
            "prior_year_premium": F.lag("total_premium").over(chain),
            "prior_year_claims": F.lag("total_claims_paid").over(chain),
        }
    )
    return with_prior.select(
        "year",
        "total_policies",
        "total_exposure",
        "total_premium",
        "total_claims_paid",
        "claim_count",
        derive.safe_ratio(paid, premium).alias("loss_ratio"),
        derive.safe_ratio(paid, F.col("claim_count")).alias("avg_severity"),
        "prior_year_premium",
        derive.growth_percent(premium, F.col("prior_year_premium")).alias("premium_growth_pct"),
        "prior_year_claims",
        derive.growth_percent(paid, F.col("prior_year_claims")).alias("claims_growth_pct"),
    )


def earned_premium(star: Star, place: str = "state_name") -> DataFrame:
    """Premium earned over the time in force, per place and effective year."""
    summed = "earned_premium" in star.fact_policies.columns
    earned = F.col("earned_premium") if summed else derive.earned_premium(F.col("total_premium"), F.col("exposure"))
    places = (star.dim_location.select("location_key", place), "location_key")
    return _total(
        star.fact_policies, [_year(star, "effective_date_key"), places], [place, "year"],
        earned_premium=F.sum(earned), written_premium=F.sum("total_premium"),
    )


def claims_by_state_year(star: Star, since: int = 2018) -> DataFrame:
    """Sanity report: claims and paid amounts by state and year, newest first."""
    years = star.dim_date.where(F.col("year") >= since).select("date_key", "year")
    places = (star.dim_location.select("location_key", "state_name"), "location_key")
    yearly = _total(
        star.fact_claims, [(years, "date_key"), places], ["state_name", "year"],
        claims=F.count(F.lit(1)), total_paid=F.sum("amount_paid_total"),
    )
    return yearly.orderBy(F.desc("year"), "state_name")


VIEWS: dict[str, Callable[[Star], DataFrame]] = {
    "vw_loss_ratio_by_state": loss_ratio,
    "vw_claims_frequency_severity": frequency_severity,
    "vw_large_loss_concentration": large_loss_concentration,
    "vw_severity_by_flood_zone": severity_by_zone,
    "vw_premium_adequacy": premium_adequacy,
    "vw_claims_development": claims_development,
    "vw_portfolio_summary": portfolio_summary,
}

# Order of the five leading rows shown for each view; the last columns only break ties.
TOP_ORDER = {
    "vw_loss_ratio_by_state": ["-year", "state_name", "county_fips"],
    "vw_claims_frequency_severity": ["-year", "zone_category"],
    "vw_large_loss_concentration": ["-large_loss_total", "state_name"],
    "vw_severity_by_flood_zone": ["-avg_severity", "zone_category"],
    "vw_premium_adequacy": ["-total_claims", "occupancy_type", "construction_class"],
    "vw_claims_development": ["-year_of_loss"],
    "vw_portfolio_summary": ["-year"],
}


def top_of_view(star: Star, name: str, n: int = 5) -> DataFrame:
    order = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in TOP_ORDER[name]]
    return VIEWS[name](star).orderBy(*order).limit(n)


def register_views(star: Star) -> list[str]:
    """Make the star tables and the views available to SQL as temporary views."""
    names = []
    for table, df in vars(star).items():
        df.createOrReplaceTempView(table)
        names.append(table)
    for view, build in VIEWS.items():
        build(star).createOrReplaceTempView(view)
        names.append(view)
    return names
