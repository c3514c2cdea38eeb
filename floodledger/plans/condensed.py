"""Sums of the facts at the grains of the views, kept by load and merged when read.

A full build writes the sums of all fact rows. A load that replaces fact rows adds what it changes: the
sums of the rows that came minus the sums of the rows that went; one that replaces all fact rows replaces
their sums too, as every earlier row went. Reading adds everything up, and groups without rows left are gone. The result takes the place of the facts in a star, so the views
read a row for each group and load instead of all facts.

Two grains are histograms of the paid amounts: percentiles are located in them, and only the fact rows in
the bucket where a percentile lies are read.
"""

from __future__ import annotations

from dataclasses import replace
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodledger.functions import derive
from floodledger.operators.order_stats import BUCKET, ROWS as COUNT, bucket_ends, leading, within
from floodledger.plans import views
from floodledger.plans.layers import Star
from floodledger.session import at_once
from floodledger.sources.sinks import overwrite

GRAIN, ROWS = "grain", "row_count"
#: The bucket of a positive paid amount; claims without one have none.
PAID_BUCKET = "paid_bucket"
#: Keys of every grain by fact; ``year_key`` is the date key of the first of January, or the Unknown one.
GRAINS = {
    "fact_claims": {
        "place": ["year_key", "location_key"],
        "zone": ["year_key", "flood_zone_key"],
        "building": ["occupancy_key", "building_type_key"],
        "loss_year": ["year_of_loss"],
        "paid_by_place": ["location_key", PAID_BUCKET],
        "paid_by_zone": ["flood_zone_key", PAID_BUCKET],
    },
    "fact_policies": {
        "place": ["year_key", "location_key"],
        "zone": ["year_key", "flood_zone_key"],
        "building": ["occupancy_key", "building_type_key"],
    },
}
DATE = {"fact_claims": "date_key", "fact_policies": "effective_date_key"}
MEASURES = {
    "fact_claims": ["amount_paid_total", "amount_paid_building", "amount_paid_contents"],
    "fact_policies": ["total_premium", "exposure", "earned_premium"],
}
#: The grain that holds what a view needs.
VIEW_GRAIN = {
    "vw_loss_ratio_by_state": "place",
    "vw_claims_frequency_severity": "zone",
    "vw_premium_adequacy": "building",
    "vw_claims_development": "loss_year",
    "vw_portfolio_summary": "place",
    "vw_earned_premium": "place",
}


def _filled(measure: str) -> str:
    return f"{measure}_filled"


def signed(fact: DataFrame, name: str, sign: int) -> DataFrame:
    """The keys and measures of fact rows, with the measures and counts of rows that go turned round."""
    date = F.col(DATE[name])
    rows = fact.withColumn("year_key", F.when(date > 0, F.floor(date / 10000).cast("int") * 10000 + 101).otherwise(date))
    if name == "fact_policies":
        rows = rows.withColumn("earned_premium", derive.earned_premium(F.col("total_premium"), F.col("exposure")))
    else:
        paid = F.col("amount_paid_total")
        rows = rows.withColumn(PAID_BUCKET, F.when(paid > 0, leading(paid)))
    keys = sorted({k for grain in GRAINS[name].values() for k in grain})
    return rows.select(
        *keys,
        F.lit(sign).cast("bigint").alias(ROWS),
        *((F.col(m) if sign > 0 else -F.col(m)).alias(m) for m in MEASURES[name]),
        *(F.when(F.col(m).isNotNull(), sign).otherwise(0).cast("bigint").alias(_filled(m)) for m in MEASURES[name]),
    )


#: Decimals of so many digits fit a number of 8 bytes; of no more than the other, Spark itself sums them up as such.
_DIGITS, _FEW_DIGITS = 18, 8
#: The two parts of such a number, whose sums do not overflow whatever the rows.
_LOW = 32


def _summed_as_numbers(rows: DataFrame, measures: list[str]) -> tuple[dict[str, Column], dict[str, Column]]:
    """What to sum up for each measure, and the measures' sums from these sums.

    A sum of decimals is a decimal of more than 18 digits, which is slow to add to; those that fit a number
    of 8 bytes are summed up as the upper and the lower half of their number, exactly.
    """
    parts, total = {}, {}
    for m in measures:
        kind = rows.schema[m].dataType
        # two digits more than the sum needs, as the tables written before have
        wanted = T.DecimalType(min(38, kind.precision + 12), kind.scale)
        if not _FEW_DIGITS < kind.precision <= _DIGITS:
            parts[m], total[m] = F.col(m), F.col(m).cast(wanted)
            continue
        number = (F.col(m) * 10**kind.scale).cast("bigint")
        high, low = f"{m}_high", f"{m}_low"
        parts[high], parts[low] = F.shiftright(number, _LOW), number.bitwiseAND(F.lit((1 << _LOW) - 1))
        whole = F.col(high).cast("decimal(19,0)") * F.lit(Decimal(1 << _LOW)) + F.col(low).cast("decimal(19,0)")
        total[m] = (whole * F.lit(Decimal(1).scaleb(-kind.scale))).cast(wanted)
    return parts, total


def sums(rows: DataFrame, name: str) -> DataFrame:
    """The sums of signed rows at every grain of a fact, in one pass; groups that nothing changes in are left out."""
    keys = sorted({k for grain in GRAINS[name].values() for k in grain})
    sets = list(GRAINS[name].items())
    numbers = [ROWS, *map(_filled, MEASURES[name])]
    parts, total = _summed_as_numbers(rows, MEASURES[name])
    # the grain as a key of its own, so that a NULL key of a group is not taken for a key that the grain lacks
    # (as a number, which every row is compared with for each key)
    each = F.explode(F.array(*(F.lit(i) for i in range(len(sets))))).alias(GRAIN)
    rows = rows.select(*keys, *numbers, *(c.alias(n) for n, c in parts.items()))
    wide = rows.select("*", each).select(
        GRAIN,
        *(F.when(F.col(GRAIN).isin([i for i, (_, ks) in enumerate(sets) if k in ks]), F.col(k)).alias(k) for k in keys),
        *numbers, *parts,
    )
    out = wide.groupBy(GRAIN, *keys).agg(*(F.sum(c).alias(c) for c in (*numbers, *parts)))
    names = F.get(F.array(*(F.lit(g) for g, _ in sets)), F.col(GRAIN)).alias(GRAIN)
    out = out.select(names, *keys, *numbers, *(total[m].alias(m) for m in MEASURES[name]))
    changed = F.lit(False)
    for c in (*numbers, *MEASURES[name]):
        changed = changed | (F.coalesce(F.col(c), F.lit(0)) != 0)
    return out.where(changed)


def folder(gold: str, name: str) -> str:
    return f"{gold}/condensed/{name}"


def write_all(star: Star, gold: str) -> None:
    """The sums of all fact rows of both facts, in the place of all earlier ones."""
    write = lambda name: write_whole(getattr(star, name), name, folder(gold, name))
    at_once(star.dim_date.sparkSession, {name: lambda n=name: write(n) for name in GRAINS})


def write_whole(fact: DataFrame, name: str, path: str) -> int:
    """The sums of all rows of a fact as one load at ``path``."""
    whole = sums(signed(fact, name, 1), name)
    return overwrite(whole.withColumn("load", F.lit("all")), path, ["load", GRAIN])


def read(spark: SparkSession, gold: str, name: str, grain: str) -> DataFrame:
    """The merged sums at one grain, as fact rows with a row count; the columns of other grains are NULL."""
    # the types of the sums, whatever the number of loads
    stored = spark.read.parquet(folder(gold, name)).where(F.col(GRAIN) == grain)
    keys = GRAINS[name][grain]
    total = stored.groupBy(*keys).agg(
        F.sum(ROWS).alias(ROWS),
        *(F.sum(m).cast(stored.schema[m].dataType).alias(m) for m in MEASURES[name]),
        *(F.sum(_filled(m)).alias(_filled(m)) for m in MEASURES[name]),
    ).where(F.col(ROWS) > 0)
    kept = {m: F.when(F.col(_filled(m)) > 0, F.col(m)) for m in MEASURES[name]}
    return total.withColumns(kept).drop(*map(_filled, MEASURES[name])).withColumnRenamed("year_key", DATE[name])


def condensed_star(star: Star, gold: str, grain: str) -> Star:
    """The star with the merged sums in the place of those facts that have the grain."""
    spark = star.dim_date.sparkSession
    return replace(star, **{name: read(spark, gold, name, grain) for name, grains in GRAINS.items() if grain in grains})


def _histogram(hist: DataFrame, *by: str) -> DataFrame:
    return hist.select(*by, F.col(PAID_BUCKET).alias(BUCKET), F.col(ROWS).alias(COUNT))


def large_loss_concentration(star: Star, gold: str, p: float = 0.95) -> DataFrame:
    """The view of that name from the histogram by place: whole buckets beyond the threshold are summed up.

    Of the facts, only the rows in the bucket of the threshold are read, twice: to find it and to tell
    the rows on its two sides.
    """
    hist = read(star.dim_date.sparkSession, gold, "fact_claims", "paid_by_place")
    positive = hist.where(F.col(PAID_BUCKET).isNotNull())
    threshold = views.large_loss_threshold(star.fact_claims, p, _histogram(positive)).first()[0]
    limit = F.lit(threshold).cast("double")
    paid, here = F.col("amount_paid_total"), leading(limit)
    beyond = F.coalesce(F.col(PAID_BUCKET) > here, F.lit(False))
    parts = hist.select(
        "location_key",
        F.when(beyond, F.col(ROWS)).otherwise(0).alias("large_rows"),
        F.when(beyond, paid).otherwise(0).alias("large"),
        paid.alias("paid"),
    )
    if threshold is not None:
        end = star.dim_date.sparkSession.range(1).select(bucket_ends(here)[1]).first()[0]
        facts = star.fact_claims.where(within(paid, star.fact_claims.schema["amount_paid_total"].dataType, threshold, end))
        edge = facts.where((paid.cast("double") >= limit) & (leading(paid) == here))
        parts = parts.unionByName(edge.select(
            "location_key", F.lit(1).cast("bigint").alias("large_rows"), paid.alias("large"), F.lit(None).cast(hist.schema["amount_paid_total"].dataType).alias("paid")))
    return views.large_losses_by_state(
        star, parts, limit, large_loss_count=F.sum("large_rows"), large_loss_total=F.sum("large"), total_paid=F.sum("paid"))


def severity_by_zone(star: Star, gold: str) -> DataFrame:
    """The view of that name: averages and shares from the sums, medians from the histogram and the rows around them."""
    spark = star.dim_date.sparkSession
    hist = read(spark, gold, "fact_claims", "paid_by_zone").where(F.col(PAID_BUCKET).isNotNull())
    named = hist.join(star.dim_flood_zone, "flood_zone_key")
    return views.severity_by_zone(
        replace(star, fact_claims=hist), views.median_severity(star, _histogram(named, *views.ZONE)))
