"""Row-level rules: casts, codes, derived columns."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from floodledger.functions import cleaning, derive
from floodledger.schemas import MISSING_TOKENS


def apply(spark, values, fn, ddl="v string"):
    """The function over a column of values, in their order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {ddl}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def pairs(spark, values, fn, ddl):
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], f"i int, {ddl}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("a"), F.col("b"))).collect()]


def test_missing_tokens(spark):
    kept = ["x", "Null", " ", "0", "none"]
    assert apply(spark, [*MISSING_TOKENS, None, *kept], cleaning.blank_to_null) == [None] * (len(MISSING_TOKENS) + 1) + kept


def test_normalise_missing_leaves_other_types(spark):
    df = spark.createDataFrame([("NaN", 1, "a")], "s string, n int, t string")
    assert cleaning.normalise_missing(df).first() == (None, 1, "a")


def test_dates(spark):
    texts = ["2017-08-25T00:00:00.000Z", "2017-08-25", " 2017-08-25 ", "2017-08-25 10:00", "2017", "not-a-date", "", None, "2017-02-30", "2017-08-2", "2017-08-25x"]
    day = date(2017, 8, 25)
    assert apply(spark, texts, cleaning.to_date) == [day] * 4 + [None] * 7


def test_money(spark):
    texts = ["45000.00", "1.005", "-201667.50", "$5", "abc", "", None, " 7 ", ".5", "1e3"]
    expected = ["45000.00", "1.01", "-201667.50", "0.00", "0.00", "0.00", "0.00", "7.00", "0.50", "1000.00"]
    assert apply(spark, texts, cleaning.to_money) == [Decimal(e) for e in expected]


def test_integers_and_codes(spark):
    assert apply(spark, ["2017", "2.0", "x", "", None, "-3", "99999999999"], cleaning.to_int) == [2017, 2, None, None, None, -3, None]
    assert apply(spark, ["1.0", " ae ", "11", "1.50", "A1.0", None], cleaning.code) == ["1", "AE", "11", "1.50", "A1.0", None]


def test_numbers(spark):
    assert apply(spark, ["1.5", "-2", "1e2", "x", "1.2.3", "."], cleaning.to_number) == [1.5, -2.0, 100.0, None, None, None]


ZONES = ["VE", "AE", " AE ", "ae", "AHB", "X", "B", "C", "D", "D1", None, "OTHER", "x500"]


def test_zone_category_and_hazard(spark):
    zone = lambda c: derive.flood_zone(c, F.lit(None).cast("string"))
    assert apply(spark, ZONES, lambda c: derive.zone_category(zone(c))) == [
        "V", "A", "A", "A", "A", "X", "X", "X", "D", "Unknown", "Unknown", "Unknown", "X",
    ]
    assert apply(spark, ZONES, lambda c: derive.special_hazard(zone(c))) == [1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0, 0]


def test_zone_fallback(spark):
    assert pairs(spark, [(None, "X"), ("AE", "X"), (None, None)], derive.flood_zone, "a string, b string") == ["X", "AE", None]


def test_exposure(spark):
    start = date(2023, 1, 1)
    terms = [365, 366, 400, 0, -10]
    rows = [(start, date.fromordinal(start.toordinal() + t)) for t in terms] + [(start, None), (None, start)]
    expected = ["0.999316", "1.000000", "1.000000", "0.000000", "0.000000", "0.000000", "0.000000"]
    assert pairs(spark, rows, derive.exposure, "a date, b date") == [Decimal(e) for e in expected]


def test_year_built_band(spark):
    years = ["1969", "1970", "1979", "1980", "2009", "2010", "2019", "2020", "abcd", None, "19"]
    assert apply(spark, years, derive.year_built_band) == [
        "Pre-1970", "1970-1979", "1970-1979", "1980-1989", "2000-2009", "2010-2019", "2010-2019", "2020+",
        "Unknown", "Unknown", "Pre-1970",
    ]


def test_flags(spark):
    assert apply(spark, ["True", "TRUE", "False", None], derive.elevated_flag) == [1, 1, 0, 0]
    assert apply(spark, ["1", "11", "18", "4", None], derive.residential_flag) == [1, 1, 1, 0, 0]
    weekend = [date(2023, 9, 29), date(2023, 9, 30), date(2023, 10, 1)]
    assert apply(spark, weekend, derive.weekend_flag, "v date") == [0, 1, 1]


def test_fiscal_calendar_and_date_key(spark):
    days = [date(2023, 9, 30), date(2023, 10, 1), date(2024, 1, 31)]
    assert apply(spark, days, derive.fiscal_year, "v date") == [2023, 2024, 2024]
    assert apply(spark, days, derive.fiscal_quarter, "v date") == [4, 1, 2]
    assert apply(spark, days, derive.date_key, "v date") == [20230930, 20231001, 20240131]


@pytest.mark.parametrize("n, d, expected", [(1, 4, 0.25), (1, 0, None), (None, 2, None), (1, None, None)])
def test_safe_ratio(spark, n, d, expected):
    assert pairs(spark, [(n, d)], derive.safe_ratio, "a int, b int") == [expected]


def test_growth(spark):
    assert pairs(spark, [(150, 100), (50, 0), (50, -10), (50, None)], derive.growth_percent, "a int, b int") == [50.0, None, None, None]


def test_adequacy(spark):
    df = spark.createDataFrame(
        [(0, 10.0, 5.0, 1.0), (1, 3.0, 5.0, 1.0), (2, None, None, None), (3, 10.0, None, 0.0)],
        "i int, a double, p double, e double",
    )
    flags = df.orderBy("i").select(derive.adequacy_flag(F.col("a"), F.col("p"), F.col("e"))).collect()
    assert [f[0] for f in flags] == ["Adequate", "Inadequate", "No Policy Data", "Inadequate"]
