import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from floodledger.operators.dedup import duplicate_keys, latest_per_key, surplus_per_key
from floodledger.operators.drill import drill_across
from floodledger.operators.order_stats import (
    BUCKET,
    ROWS,
    bucket_ends,
    exact_percentiles,
    from_bits,
    leading,
    middle_values,
    order_bits,
)
from floodledger.operators.shares import count_by_with_total, null_counts, value_counts
from floodledger.operators.topn import completeness, page, top_per_group


@pytest.mark.parametrize("seed, size, spread", [(1, 1, 10), (2, 2, 10), (3, 101, 5), (4, 5000, 1e9), (5, 3000, 0.5)])
def test_percentiles_match_brute_force(spark, seed, size, spread):
    values = np.round(np.random.default_rng(seed).normal(0, spread, size), 2)
    df = spark.createDataFrame([(float(v),) for v in values], "v double").withColumn("v", F.col("v").cast("decimal(18,2)"))
    ps = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = {r.p: r.percentile for r in exact_percentiles(df, "v", ps).collect()}
    for p in ps:
        assert got[p] == pytest.approx(np.quantile(values, p), abs=1e-6)


def test_percentiles_by_group_with_one_hot_value(spark):
    rows = [("hot", 5)] * 3000 + [("hot", 7)] * 10 + [("small", v) for v in (1, 2, 4)] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, v int")
    got = {(r.g, r.p): r.percentile for r in exact_percentiles(df, "v", [0.5, 0.999], ["g"], scale=0).collect()}
    assert got == {("hot", 0.5): 5.0, ("hot", 0.999): 7.0, ("small", 0.5): 2.0, ("small", 0.999): pytest.approx(3.996)}


def test_percentiles_count_values_once(spark):
    df = spark.range(1000).select(F.col("id").alias("v"))
    result = exact_percentiles(df, "v", [0.5], scale=0)
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") >= 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_percentile_of_nothing(spark):
    df = spark.createDataFrame([], "v decimal(18,2)")
    assert exact_percentiles(df, "v", [0.5]).count() == 0


def test_bits_are_those_of_the_double_and_sort_like_it(spark):
    rng = np.random.default_rng(7)
    values = np.concatenate([
        rng.integers(0, 2**63, 3000, dtype=np.uint64).view(np.float64),  # doubles of all exponents
        rng.normal(0, 1e6, 500), 2.0 ** np.arange(-1074, 1024), np.nextafter(2.0 ** np.arange(-1000, 1024), 0),
        np.nextafter(2.0 ** np.arange(-1000, 1023), np.inf), [0.0, -0.0, 5e-324, 1.7976931348623157e308, np.inf, 0.01, 0.07]])
    values = values[~np.isnan(values)]
    values = np.unique(np.concatenate([values, -values]))
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    first, beyond = bucket_ends(F.col("b"))
    got = df.select("v", order_bits(F.col("v")).alias("k"), leading(F.col("v")).alias("b")).select(
        "*", from_bits(F.col("k")).alias("back"), first.alias("first"), beyond.alias("beyond")).toPandas()
    size = np.abs(got.v.to_numpy()).view(np.int64)
    assert (got.k.to_numpy() == np.where(got.v < 0, -size, size)).all()
    assert (got.back == got.v).all()
    inside = got[np.isfinite(got.v)]
    assert ((inside["first"] <= inside.v) & (inside.v < inside.beyond)).all()


def test_percentiles_from_a_kept_histogram(spark):
    """Loads that came and went add up to the histogram; groups with NULL, negative values, buckets that lost their rows."""
    rng = np.random.default_rng(11)
    groups = ["a", None, "b"]
    rows = [(groups[int(g)], round(float(v), 2)) for g, v in zip(rng.integers(0, 3, 3000), rng.lognormal(6, 3, 3000) * rng.choice([-1, 1], 3000))]
    rows += [("a", None), ("gone", None)]
    gone = [("a", 1e9), ("gone", 5.0), (None, -7.77)] * 4
    frame = lambda data: spark.createDataFrame(data, "g string, v double").withColumn("v", F.col("v").cast("decimal(18,2)"))
    tally = lambda data, sign: frame(data).where("v IS NOT NULL").groupBy("g", leading(F.col("v")).alias(BUCKET)).agg((F.count("*") * sign).alias(ROWS))
    kept = tally(rows[:1000] + gone, 1).unionByName(tally(rows[1000:], 1)).unionByName(tally(gone, -1))
    ps = [0.0, 0.31, 0.5, 0.95, 1.0]
    of = lambda df: {(r.g, r.p): r.percentile for r in df.collect()}
    got = of(exact_percentiles(frame(rows), "v", ps, ["g"], histogram=kept))
    assert got == of(exact_percentiles(frame(rows), "v", ps, ["g"]))
    for g in groups:
        values = [v for h, v in rows if h == g and v is not None]
        assert [got[g, p] for p in ps] == pytest.approx([np.quantile(values, p) for p in ps], abs=1e-6)
    assert {g for g, _ in got} == set(groups)
    assert exact_percentiles(frame(rows), "v", [0.5], histogram=kept.drop("g").limit(0)).count() == 0
    whole = of(exact_percentiles(frame(rows).withColumn("g", F.lit("x")), "v", ps, histogram=kept).withColumn("g", F.lit("x")))
    assert whole["x", 0.95] == pytest.approx(np.quantile([v for _, v in rows if v is not None], 0.95), abs=1e-6)


def test_values_at_the_limit_of_their_type(spark):
    rows = spark.createDataFrame([("99999999999999.99",), ("-99999999999999.99",), ("0.01",)], "t string").select(F.col("t").cast("decimal(16,2)").alias("v"))
    kept = rows.groupBy(leading(F.col("v")).alias(BUCKET)).agg(F.count("*").alias(ROWS))
    for p, want in ((0.0, -99999999999999.99), (0.5, 0.01), (1.0, 99999999999999.99)):
        assert exact_percentiles(rows, "v", [p], histogram=kept).first().percentile == pytest.approx(want, rel=1e-15)


@pytest.mark.parametrize("n", [3, 50, 100_000])
def test_top_per_group(spark, n):
    # one group holds nearly all rows, and its values repeat
    df = spark.range(5000).select(F.when(F.col("id") < 4900, "hot").otherwise("b").alias("g"), "id", (F.col("id") % 7).alias("v"))
    got = top_per_group(df, ["g"], [F.desc("v"), F.asc("id")], n)
    expected = {}
    for g, ids in (("hot", range(4900)), ("b", range(4900, 5000))):
        expected[g] = sorted(((-(i % 7), i) for i in ids))[:n]
    rows = {}
    for r in got.collect():
        rows.setdefault(r.g, []).append((-r.v, r.id))
    assert {g: sorted(x) for g, x in rows.items()} == expected


def test_ties_go_by_the_other_columns_whatever_the_layout(spark):
    rows = [("g", 1, i) for i in range(200)]
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "g string, v int, id int").repartition(parts, "id")
        assert sorted(r.id for r in top_per_group(df, ["g"], [F.desc("v")], 30).collect()) == list(range(30))


def test_completeness_flags_groups_that_differ(spark):
    found = spark.createDataFrame([("a",)] * 4 + [("b",)] * 3 + [(None,)], "g string")
    landed = spark.createDataFrame([("a",)] * 3 + [("b",)] * 3 + [(None,)], "g string")
    got = {r.g: (r.rows_found, r.rows_landed, r.truncated) for r in completeness(found, landed, ["g"]).collect()}
    assert got == {"a": (4, 3, 1), "b": (3, 3, 0), None: (1, 1, 0)}


@pytest.mark.parametrize("values, middle", [
    ([1e-5, 2e-5, 3e-5], 2e-5), ([1e30, -1e30, 5.0], 5.0), ([1e308, 1.5e308], 1.25e308), ([-3.0, -1.0], -2.0), ([7.0], 7.0),
    ([2.0] * 900 + [9.0] * 100, 2.0),
])
def test_medians_of_any_size(spark, values, middle):
    df = spark.createDataFrame([("a", v) for v in values] + [("b", None), ("c", 4.0)], "g string, v double")
    got = {r.g: r.median for r in middle_values(df, "g", "v").collect()}
    assert got == {"a": pytest.approx(middle, rel=1e-15), "c": 4.0}


def test_pages(spark):
    df = spark.range(100).select(F.col("id").alias("k"))
    assert [r.k for r in page(df, "k", 3, skip=10).collect()] == [10, 11, 12]
    assert [r.k for r in page(df, "k", 3, after=97).collect()] == [98, 99]
    deep = spark.range(20_000).select((F.col("id") * 7 % 20_000).alias("k"))
    assert [r.k for r in page(deep, "k", 3, skip=19_990).collect()] == [19_990, 19_991, 19_992]
    assert [r.k for r in page(df, "k", 5, skip=98).collect()] == [98, 99]
    assert page(df, "k", 5, skip=100).count() == 0
    ties = spark.createDataFrame([(1, i) for i in range(50)], "k int, id int").repartition(5)
    assert [r.id for r in page(ties, "k", 4, skip=10).collect()] == [10, 11, 12, 13]


def test_drill_across_meets_null_keys(spark):
    left = spark.createDataFrame([("a", 1, 10), (None, 1, 20), ("c", 3, 5)], "k string, y int, paid int")
    right = spark.createDataFrame([("a", 1, 100), (None, 1, 200), ("b", 2, 7)], "k string, y int, premium int")
    got = {(r.k, r.y): (r.paid, r.premium) for r in drill_across(left, right, ["k", "y"]).collect()}
    assert got == {("a", 1): (10, 100), (None, 1): (20, 200), ("b", 2): (None, 7), ("c", 3): (5, None)}


def test_duplicates_and_surplus(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert {r.k: r.n for r in duplicate_keys(df, ["k"]).collect()} == {1: 2, None: 2}
    assert tuple(surplus_per_key(df, ["k"]).first()) == (5, 3, 2)
    assert tuple(surplus_per_key(df.limit(0), ["k"]).first()) == (0, 0, 0)


def test_counts(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "y")], "s string, v string")
    totals = {(r.s, r.is_total): r.rows_loaded for r in count_by_with_total(df, "s").collect()}
    assert totals == {("a", 0): 2, ("b", 0): 1, (None, 1): 3}
    assert {(r.column, r.value): r["rank"] for r in value_counts(df, ["s", "v"], 1).collect()} == {("s", "a"): 1, ("v", "x"): 1}
    nulls = {r.column: (r.null_count, round(r.null_pct, 1)) for r in null_counts(df).collect()}
    assert nulls == {"s": (0, 0.0), "v": (1, 33.3)}


def test_texts_beside_the_key_are_sorted_as_one(spark):
    """The packed text orders rows as its columns did, whatever they hold, and gives them back."""
    odd = [None, "", "\0", "\1", "\2", "\0\0", "\1\1", "\1\2", "\0\1", "a", "a\0", "a\1", "a\0b", "ab", "\1\1\2", "\2\1", "é", "b|c"]
    rows = [(f"k{i % 7}", i % 2, a, b, c) for i, (a, b, c) in enumerate((a, b, c) for a in odd for b in odd for c in ("x", None, ""))]
    df = spark.createDataFrame(rows, "k string, t int, a string, b string, c string")
    rank = lambda v: (v is not None, (v or "").encode())
    expected = {}
    for row in sorted(rows, key=lambda r: (r[0], -r[1], *map(rank, r[2:]))):
        expected.setdefault(row[0], row)
    kept = latest_per_key(df, ["k"], ["t"])
    assert {r.k: tuple(r) for r in kept.collect()} == expected
    shuffled = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [row_number() windowspecdefinition(k#" in shuffled and "_rest#" in shuffled.split("Window [")[1].split("\n")[0]


def test_texts_are_only_escaped_where_something_is_to_be(spark):
    """Replacing what is not there costs more than all else of packing."""
    from floodledger.operators.dedup import pack, unpacked

    df = spark.createDataFrame([("a", None), ("a\u0000b\u0001", "\u0001\u0001"), ("", "\u0002")], "a string, b string")
    packed = df.select("a", "b", F.split(pack(["a", "b"]), "\u0000").alias("p"))
    back = packed.select("a", "b", *(unpacked(F.col("p")[i]).alias(f"{c}_back") for i, c in enumerate("ab"))).collect()
    assert [(r.a, r.b) for r in back] == [(r.a_back, r.b_back) for r in back] and len(back) == 3
    for made in (pack(["a"]), unpacked(F.col("a"))):
        plan = df.select(made)._jdf.queryExecution().analyzed().toString().lower()
        assert plan.index("contains(") < plan.index("replace(")
