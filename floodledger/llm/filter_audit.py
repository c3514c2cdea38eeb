"""What five text filters take from each other, in every order of applying them.

Every document is reduced to the set of filters that it fails. Per part, the documents that each of
the 32 coalitions of filters would remove are counted; every step of every order is a difference of
two of these counts. The Shapley shares of the filters are the solution of the weighted least
squares fit of an additive game to the 32 counts, whose shares must sum to what all filters remove.
Its normal equations are solved in rationals, so the shares are exact.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import permutations
from math import comb, factorial, lcm

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodledger.llm.store import cut

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
SPACES = r"[\x20\x09-\x0D]+"


def failures(text: Column) -> Column:
    """Bits 0 to 3: the filters A to D that a text fails."""
    words = F.array_remove(F.split(text, SPACES), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [n < 50, 100 * distinct < 65 * n, 100 * capitals > 5 * F.length(text), text.rlike(r"[#$%&*|]")]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails[1:], 1)), F.when(fails[0], 1).otherwise(0))


def solve(rows: list[list[Fraction]]) -> list[list[Fraction]]:
    """Reduces a system with several right-hand sides; returns these sides."""
    n = len(rows)
    for i in range(n):
        top = next(r for r in range(i, n) if rows[r][i])
        rows[i], rows[top] = rows[top], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(n):
            if r != i and rows[r][i]:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i])]
    return [row[n:] for row in rows]


def shapley_weights(n: int) -> tuple[list[list[int]], int]:
    """Whole numbers w and d: the sum of w[i][S] * v(S) over all coalitions S, divided by d, is filter i's share.

    Unknown are the n shares and a multiplier for their sum. A coalition of s filters has the kernel
    weight (n - 1) / (C(n, s) s (n - s)); the empty and the full one are met exactly.
    """
    full = (1 << n) - 1
    weight = {s: Fraction(n - 1, comb(n, s) * s * (n - s)) for s in range(1, n)}
    inner = [(c, weight[c.bit_count()]) for c in range(1, full)]
    has = lambda c, i: c >> i & 1
    system = []
    for i in range(n):
        left = [sum((w for c, w in inner if has(c, i) and has(c, j)), Fraction(0)) for j in range(n)] + [Fraction(1)]
        right = [Fraction(0)] * (full + 1)
        for c, w in inner:
            if has(c, i):
                right[c] = w
        system.append(left + right)
    system.append([Fraction(1)] * n + [Fraction(0)] + [Fraction(int(c == full)) for c in range(full + 1)])
    shares = solve(system)[:n]
    d = lcm(*(x.denominator for row in shares for x in row))
    return [[int(x * d) for x in row] for row in shares], d


def failing(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each document: ``part, fails`` (five bits), ``good, toxic``, and ``n`` documents of these."""
    text = F.coalesce("text", F.lit(""))
    one = docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), failures(text).alias("fails"), F.unhex(F.sha2(text, 256)).alias("same"))
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    marked = one.join(marks, "doc_id", "left").fillna(0, ["good", "toxic"])
    key = ["part", "fails", "good", "toxic"]
    # without E every copy counts; the first of each text is joined on its own id, so copies make no hot key
    rows = cut(marked, "fails")
    first = rows.groupBy("same").agg(F.min("doc_id").alias("doc_id"))
    passing = rows.where("doc_id IS NULL").select(*key).unionByName(rows.join(first, ["same", "doc_id"]).select(*key))
    late = 1 << FILTERS.index("E")
    every = rows.groupBy(*key).agg(F.count("*").alias("n"))
    kept = passing.groupBy(*key).agg(F.count("*").alias("n"))
    moved = kept.unionByName(kept.withColumn("n", -F.col("n")).withColumn("fails", F.col("fails") + late))
    return every.withColumn("fails", F.col("fails") + late).unionByName(moved).groupBy(*key).agg(F.sum("n").alias("n"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step`` and the counts of each: all orders of the five filters, all parts.

    ``removed`` at a step, ``kept`` after it, ``redundant`` (fail the filter, gone before),
    ``unique_fails`` (fail it alone), ``good_lost`` and ``toxic_lost`` (removed there, so labelled) and
    ``shapley`` (removed by the filter over all orders, summed). A null text is empty, a null source
    the part ``''``. A document with several labels counts as good or toxic if one of them says so.
    Rows without doc_id are no copies of others and have no label; repeated rows count each, and rows
    of one doc_id are no copies of each other. An empty table gives no rows.
    """
    counts = failing(docs, labels)
    removed = lambda c, n: F.sum(F.when(F.col("fails").bitwiseAND(F.lit(c)) != 0, n).otherwise(0))
    of = {"gone": F.col("n"), "good": F.col("n") * F.col("good"), "toxic": F.col("n") * F.col("toxic")}
    games = counts.groupBy("part").agg(
        F.sum("n").alias("total"), *(F.array(*(removed(c, n) for c in range(ALL + 1))).alias(name) for name, n in of.items()))
    weights, d = shapley_weights(len(FILTERS))
    orders = factorial(len(FILTERS))
    terms = lambda row: " + ".join(f"gone[{c}] * {w * orders}" for c, w in enumerate(row) if w)
    games = games.withColumn("shares", F.array(*(F.expr(f"({terms(row)}) div {d}") for row in weights)))
    steps = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            steps.append(("".join(FILTERS[i] for i in order), step, f, before, after))
            before = after
    table = ", ".join(f"struct('{o}' AS filter_order, {s} AS step, {f} AS f, {b} AS before, {a} AS after)" for o, s, f, b, a in steps)
    rows = games.withColumn("at", F.explode(F.expr(f"array({table})")))
    take = lambda name, c: F.element_at(name, F.col(f"at.{c}") + 1)
    gain = lambda name: take(name, "after") - take(name, "before")
    fails = F.element_at("gone", F.expr("cast(shiftleft(1, at.f) + 1 AS int)"))
    others = F.element_at("gone", F.expr(f"cast({ALL} - shiftleft(1, at.f) + 1 AS int)"))
    return rows.select(
        "part", "at.filter_order", "at.step",
        (F.col("total") - take("gone", "after")).alias("kept"), gain("gone").alias("removed"),
        (fails - gain("gone")).alias("redundant"), (F.element_at("gone", ALL + 1) - others).alias("unique_fails"),
        gain("good").alias("good_lost"), gain("toxic").alias("toxic_lost"), take("shares", "f").alias("shapley"))
