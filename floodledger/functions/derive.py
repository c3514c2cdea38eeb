"""Derived business columns. Each rule is stated once and shared by dimensions, facts and views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from floodledger.functions.cleaning import whole
from floodledger.schemas import RESIDENTIAL_CODES, UNKNOWN, UNKNOWN_KEY

DAYS_PER_YEAR = 365.25


def flood_zone(rated: Column, current: Column) -> Column:
    """The rated zone, else the current one, as a trimmed upper-case code."""
    return F.upper(F.trim(F.coalesce(rated, current)))


def zone_category(zone: Column) -> Column:
    """V, A, X (also B and C), D, or Unknown, by the first letter; D only as a whole code."""
    letter = F.substring(zone, 1, 1)
    return (
        F.when(letter.isin("V", "A"), letter)
        .when(letter.isin("X", "B", "C"), "X")
        .when(zone == "D", "D")
        .otherwise(UNKNOWN)
    )


def special_hazard(zone: Column) -> Column:
    """1 for zones that start with V or A, else 0."""
    return F.when(F.substring(zone, 1, 1).isin("V", "A"), 1).otherwise(0)


def exposure(effective: Column, termination: Column) -> Column:
    """Policy term in years, held within 0 and 1; 0 where a date is missing."""
    years = F.datediff(termination, effective) / F.lit(DAYS_PER_YEAR)
    held = F.least(F.lit(1.0), F.greatest(F.lit(0.0), years))
    known = effective.isNotNull() & termination.isNotNull()
    return F.when(known, held).otherwise(0.0).cast("decimal(8,6)")


def year_built(construction_date: Column) -> Column:
    return F.substring(F.trim(construction_date), 1, 4)


def year_built_band(year_text: Column) -> Column:
    """Pre-1970, a decade from 1970 to 2019, 2020+, or Unknown."""
    year = whole(F.substring(year_text, 1, 4))
    decade = (F.floor(year / 10) * 10).cast("int")
    span = F.concat_ws("-", decade.cast("string"), (decade + 9).cast("string"))
    return (
        F.when(year < 1970, "Pre-1970")
        .when(year.between(1970, 2019), span)
        .when(year >= 2020, "2020+")
        .otherwise(UNKNOWN)
    )


def elevated_flag(indicator: Column) -> Column:
    return F.when(F.upper(indicator) == "TRUE", 1).otherwise(0)


def residential_flag(occupancy: Column) -> Column:
    return F.when(occupancy.isin(RESIDENTIAL_CODES), 1).otherwise(0)


def date_key(date: Column) -> Column:
    """YYYYMMDD as an integer, without a detour through text."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def fiscal_year(date: Column) -> Column:
    """The fiscal year starts in October of the year before."""
    return F.year(F.add_months(date, 3))


def fiscal_quarter(date: Column) -> Column:
    return F.quarter(F.add_months(date, 3))


def weekend_flag(date: Column) -> Column:
    return F.when(F.dayofweek(date).isin(1, 7), 1).otherwise(0)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """A double quotient, NULL where the denominator is zero or missing."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def growth_percent(current: Column, previous: Column) -> Column:
    """Change against the previous value in percent; NULL unless that one is positive."""
    return F.when(previous > 0, safe_ratio(current - previous, previous) * 100)


def adequacy_flag(avg_premium: Column, pure_premium: Column, total_exposure: Column) -> Column:
    return (
        F.when(avg_premium >= pure_premium, "Adequate")
        .when(avg_premium.isNull() | total_exposure.isNull(), "No Policy Data")
        .otherwise("Inadequate")
    )


def large_loss_flag(amount: Column, threshold: Column) -> Column:
    return F.when(amount >= threshold, 1).otherwise(0)


def earned_premium(premium: Column, term: Column) -> Column:
    """Premium weighted with the part of a year it was in force."""
    return premium * term


def known_key(key: Column) -> Column:
    return F.coalesce(key, F.lit(UNKNOWN_KEY))
