"""Exact percentiles of very large groups, from histograms that can be merged.

The built-in exact percentile keeps every distinct value of a group in one task. Here a value gets a
whole number that sorts like it (the bits of its double), and a histogram counts values by the
leading bits of that number: the counts of several loads add up to the histogram of all rows, and
a load that leaves is subtracted. The wanted ranks are located in the histogram; only the values in
their few buckets are then looked at, again by leading bits and last by value.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Low bits dropped in each step: first sign, exponent and eight bits behind it, which makes 256 buckets
# for every doubling of the value; the last step looks at the values.
STEPS = (44, 22, 0)
BUCKET, ROWS = "_bucket", "_n"


def order_bits(value: Column) -> Column:
    """A whole number that sorts like the value as a double: its IEEE 754 bits, negated for negative values.

    Both zeros give 0. Every division and product here is by a power of two and exact; the exponent
    from the logarithm can be off by one and is set right. NULL and NaN have no place: give none.
    """
    x = value.cast("double")
    size = F.abs(x)
    guess = F.floor(F.log2(size)) - 1
    scaled = size / F.pow(F.lit(2.0), guess.cast("double"))
    step = F.when(scaled >= 4, 2).when(scaled >= 2, 1).when(scaled < 1, -1).otherwise(0)
    fraction = scaled / F.pow(F.lit(2.0), step.cast("double")) - 1
    normal = (guess + step + 1023) * F.lit(2**52) + (fraction * 2.0**52).try_cast("bigint")
    bits = (
        F.when(size < 2.0**-1022, (size * 2.0**537 * 2.0**537).try_cast("bigint"))
        .when(size == float("inf"), F.lit(0x7FF << 52))
        .otherwise(normal)
    )
    return F.when(x < 0, -bits).otherwise(bits)


def from_bits(bits: Column) -> Column:
    """The double of a number made by ``order_bits``."""
    size = F.abs(bits)
    exponent, low = F.shiftright(size, 52), size.bitwiseAND(F.lit(2**52 - 1)).cast("double")
    value = (
        F.when(exponent == 0, low * 2.0**-537 * 2.0**-537)
        .when(exponent >= 0x7FF, float("inf"))
        .otherwise((low / 2.0**52 + 1) * F.pow(F.lit(2.0), (exponent - 1023).cast("double")))
    )
    return F.when(bits < 0, -value).otherwise(value)


def leading(value: Column) -> Column:
    """The bucket of a value in a histogram."""
    return F.shiftright(order_bits(value), STEPS[0])


def bucket_ends(bucket: Column) -> tuple[Column, Column]:
    """The smallest value of a bucket, and the smallest one beyond it."""
    first = F.shiftleft(bucket, STEPS[0])
    return from_bits(first), from_bits(first + F.lit(1 << STEPS[0]))


def within(value: Column, kind, low: float, high: float) -> Column:
    """A filter for a decimal column that scans can use: at least all values from ``low`` to ``high`` pass."""
    most = Decimal(10) ** (kind.precision - kind.scale) - 1
    ends = [max(-most, min(most, Decimal(end).to_integral_value(rounding))) for end, rounding in ((low, "ROUND_FLOOR"), (high, "ROUND_CEILING"))]
    passed = F.lit(True)
    # an end at the limit of the type leaves that side open
    if ends[0] > -most:
        passed = passed & (value >= F.lit(ends[0]).cast(kind))
    if ends[1] < most:
        passed = passed & (value <= F.lit(ends[1]).cast(kind))
    return passed


def _with_start(buckets: DataFrame, group: Sequence[str], base: Column) -> DataFrame:
    """Add ``_before``, the number of the group's values below each bucket."""
    running = F.sum(ROWS).over(Window.partitionBy(*group).orderBy(BUCKET))
    return buckets.withColumn("_before", base + running - F.col(ROWS))


def _holds(rank: Column) -> Column:
    return (F.col("_before") <= rank) & (rank < F.col("_before") + F.col(ROWS))


def _wanted_buckets(histogram: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """The buckets of the two neighbouring ranks of every probability, and the number of values below them."""
    ranked = _with_start(histogram, ["_g"], F.lit(0)).withColumn(
        "_last", F.sum(ROWS).over(Window.partitionBy("_g")) - 1
    )
    wanted = []
    for i, p in enumerate(probabilities):
        position = F.lit(float(p)) * F.col("_last").cast("double")
        low, high = F.floor(position), F.ceil(position)
        target = F.struct(
            F.lit(i).alias("_i"),
            (position - low).alias("_part"),
            low.alias("_low"),
            high.alias("_high"),
            F.col("_before").alias("_start"),
        )
        wanted.append(F.when(_holds(low) | _holds(high), target))
    return ranked.select("_g", BUCKET, F.inline(F.array_compact(F.array(*wanted))))


def _ends(counts: DataFrame, chosen: DataFrame, small) -> DataFrame:
    """``_g``, ``_i``, ``_part`` and the values at the two ranks, from counted values and the wanted buckets.

    The chosen buckets follow each other without a gap, so one running count per probability covers
    both of them.
    """
    target_key = ["_g", "_i"]
    carried = ["_part", "_low", "_high"]
    for outer, inner in zip(STEPS, STEPS[1:]):
        inside = counts.withColumn("_parent", F.shiftright("_k", outer)).join(
            small(chosen.withColumnRenamed(BUCKET, "_parent")), ["_g", "_parent"]
        )
        if inner:
            buckets = inside.groupBy(
                *target_key, *carried, F.shiftright("_k", inner).alias(BUCKET)
            ).agg(F.sum(ROWS).alias(ROWS), F.min("_start").alias("_start"))
        else:
            buckets = inside.withColumn(BUCKET, F.col("_v"))
        base = F.min("_start").over(Window.partitionBy(*target_key))
        found = _holds(F.col("_low")) | _holds(F.col("_high"))
        chosen = (
            _with_start(buckets, target_key, base)
            .where(found)
            .select(*target_key, *carried, BUCKET, ROWS, "_before", F.col("_before").alias("_start"))
        )
        if inner:
            chosen = chosen.drop(ROWS, "_before")

    at = lambda rank: F.max(F.when(_holds(F.col(rank)), F.col(BUCKET)))
    return chosen.groupBy(*target_key).agg(
        F.max("_part").alias("_part"), at("_low").alias("_below"), at("_high").alias("_above")
    )


def _group(by: Sequence[str]) -> Column:
    """The group as one key, which is never NULL, so groups with NULL columns are joined like others."""
    return F.struct(*by) if by else F.struct(F.lit(1).alias("_all"))


def exact_percentiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    scale: int = 2,
    few_groups: bool = False,
    histogram: DataFrame | None = None,
) -> DataFrame:
    """Continuous percentiles (linear interpolation) per group: columns ``by``, ``p``, ``percentile``.

    ``value`` must be a number with at most ``scale`` decimals that fits 64 bits without its point. No
    task holds more than ``2**22`` rows of a group. ``few_groups`` says
    that the number of groups is bounded by construction, which allows the chosen buckets (two rows
    per group and probability) to be broadcast; without groups that is always so.

    A kept ``histogram`` of the rows with a value (columns ``by``, ``_bucket`` from ``leading``, ``_n``)
    spares the pass that counts them all: of ``df``, only rows in the range of the chosen buckets are
    read. ``value`` must be a decimal column then, and ``few_groups`` is taken for granted.
    """
    number = F.col(value)
    small = F.broadcast if few_groups or not by or histogram is not None else (lambda d: d)
    kept = df.where(number.isNotNull())
    if histogram is not None:
        # a row for each bucket of a group: at most 2**20, in practice 256 for each doubling
        merged = histogram.select(_group(by).alias("_g"), BUCKET, ROWS).groupBy("_g", BUCKET).agg(F.sum(ROWS).alias(ROWS))
        chosen = _wanted_buckets(merged.where(F.col(ROWS) > 0), probabilities)
        first, beyond = bucket_ends(F.col(BUCKET))
        low, high = chosen.agg(F.min(first), F.max(beyond)).first()
        kept = kept.where(F.lit(False) if low is None else within(number, df.schema[value].dataType, low, high))

    whole = (number.cast(f"decimal(38,{scale})") * 10**scale).cast("bigint")
    # Never NULL after the filter; saying so keeps the planner from adding further filters,
    # which would make the uses of the counts differ and be computed more than once.
    whole = F.coalesce(whole, F.lit(0).cast("bigint"))
    # the double next to the number itself, as in a kept histogram; one division rounds once up to 2**53
    double = F.when(F.abs("_v") <= 2**53, F.col("_v") / F.lit(float(10**scale))).otherwise(
        (F.col("_v").cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-scale))).cast("double")
    )
    counts = (
        kept.select(_group(by).alias("_g"), whole.alias("_v"))
        .withColumn("_k", F.coalesce(order_bits(double), F.lit(0).cast("bigint")))
        .groupBy("_g", "_v", "_k")
        .agg(F.count(F.lit(1)).alias(ROWS))
    )
    if histogram is None:
        found = counts.groupBy("_g", F.shiftright("_k", STEPS[0]).alias(BUCKET)).agg(F.sum(ROWS).alias(ROWS))
        chosen = _wanted_buckets(found, probabilities)
    between = F.col("_below") + F.col("_part") * (F.col("_above") - F.col("_below"))
    p_of = F.array(*(F.lit(float(p)) for p in probabilities))
    return _ends(counts, chosen, small).select(
        *(F.col("_g")[c].alias(c) for c in by),
        p_of[F.col("_i")].alias("p"),
        (between / F.lit(float(10**scale))).alias("percentile"),
    )


def middle_values(numbers: DataFrame, by: str, value: str, times: str | None = None) -> DataFrame:
    """The exact median of doubles of any size per group: ``by``, ``median``.

    Whole numbers are never formed, so neither scale nor span matters. NULL and NaN are no values. A
    row counts as often as its column ``times`` says, without it once.
    """
    n = F.sum(times) if times else F.count(F.lit(1))
    counts = (
        numbers.where(F.col(value).isNotNull() & ~F.isnan(value))
        .select(_group([by]).alias("_g"), F.coalesce(F.col(value), F.lit(0.0)).alias("_v"), *([times] if times else []))
        .groupBy("_g", "_v")
        .agg(F.coalesce(n, F.lit(0)).alias(ROWS))
        .withColumn("_k", F.coalesce(order_bits(F.col("_v")), F.lit(0).cast("bigint")))
    )
    found = counts.groupBy("_g", F.shiftright("_k", STEPS[0]).alias(BUCKET)).agg(F.sum(ROWS).alias(ROWS))
    ends = _ends(counts, _wanted_buckets(found, [0.5]), lambda d: d)
    # halves first: the difference of two large doubles could overflow
    median = F.col("_below") + F.when(F.col("_part") > 0, F.col("_above") / 2 - F.col("_below") / 2).otherwise(0.0)
    return ends.select(F.col("_g")[by].alias(by), median.alias("median"))
