"""Mixing sources to target weights by Pfair scheduling, with DataFrame operations only.

Block ``j`` of a source of weight ``w`` (of ``D`` in all) is released at slot ``floor(j * D / w)``
and due at ``ceil((j + 1) * D / w)``; in every slot the released block with the earliest deadline
goes. So at every point of the sequence each source has had its share but for less than a block.
The schedule repeats after ``D`` slots, so one period is worked out per phase, and a phase ends
when a source has no more blocks: the others go on with their weights. Only the numbers of rows of
the sources are gathered, every row finds its slot by its number within its source.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from floodledger.llm.store import cut, partitions

#: Hash buckets that a source is dealt into to number its rows: no task sees a whole source.
BUCKETS_HEX = 3
BLOCK_ROWS = 8
#: Rows that stand together where the order of a mixture has to outlast files.
STRETCH_ROWS = 1024
#: A default weight is a whole number of so many parts.
PARTS = 1000


def period(weights: dict[str, int]) -> list[str]:
    """The source of each slot of one period, earliest deadline first among released blocks."""
    total = sum(weights.values())
    waiting = [(0, s, 0) for s in sorted(weights)]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    out = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * total // weights[s]), s, j))
        _, s, j = heapq.heappop(ready)
        out.append(s)
        heapq.heappush(waiting, ((j + 1) * total // weights[s], s, j + 1))
    return out


def phases(weights: dict[str, int], blocks: dict[str, int]) -> dict[str, list[dict]]:
    """For each source its stretches of blocks, with the slots they take."""
    left = {s: n for s, n in blocks.items() if n}
    used = dict.fromkeys(left, 0)
    out: dict[str, list[dict]] = {s: [] for s in left}
    base = 0
    while left:
        active = {s: weights[s] for s in left}
        total = sum(active.values())
        slots: dict[str, list[int]] = {s: [] for s in active}
        for t, s in enumerate(period(active)):
            slots[s].append(t)
        # the first slot for which a source has no block left ends the phase
        end = min(n // active[s] * total + slots[s][n % active[s]] for s, n in left.items())
        for s in list(left):
            full, rest = divmod(end, total)
            n = full * active[s] + sum(t < rest for t in slots[s])
            if n:
                out[s].append({"first": used[s], "last": used[s] + n, "weight": active[s], "total": total, "base": base, "slots": slots[s]})
            used[s] += n
            left[s] -= n
            if not left[s]:
                del left[s]
        base += end
    return out


def tempered(counts: dict[str, int], power: float = 0.5, parts: int = PARTS) -> dict[str, int]:
    """Weights between proportional (1) and equal (0), as whole parts of ``parts``, at least one."""
    total = sum(n**power for n in counts.values()) or 1
    return {s: max(1, round(parts * n**power / total)) for s, n in counts.items()}


SLOTS = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("phases", T.ArrayType(T.StructType([
        *[T.StructField(c, T.LongType()) for c in ("first", "last", "weight", "total", "base")],
        T.StructField("slots", T.ArrayType(T.LongType()))]))),
])


def mix_sources(docs: DataFrame, weights: dict[str | None, int] | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows of ``docs`` with ``position`` (from 0, without gaps), ``slot``, ``release``, ``deadline``.

    ``weights`` are whole numbers by source, ``None`` for rows without source; a source that is not
    named weighs 1, as does one with a weight below 1. Without weights they are the square roots of
    the sources' sizes. Within a source the order is by hash of doc_id, then doc_id and a hash of
    text; rows equal in these are in any order. Every row goes once: a source that ends leaves its
    slots to the others. The columns of ``docs`` stay, but for those named as the four new ones.
    The number of sources is that of the mixture's settings and is taken to fit the driver.
    """
    spark = docs.sparkSession
    new = ("position", "slot", "release", "deadline")
    columns = [c for c in docs.columns if c.lower() not in new]
    text = F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))) if "text" in docs.columns else F.lit("")
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), key.alias("key"), order.alias("h"),
                        F.substring(order, 1, BUCKETS_HEX).alias("bucket"), F.col("doc_id").alias("d"), text.alias("t"))
    counts = cut(keyed.groupBy("key", "bucket").agg(F.count("*").alias("n")), "counts")
    before = W.partitionBy("key").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("key", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    sizes = {r[0]: r[1] for r in counts.groupBy("key").agg(F.sum("n")).collect()}
    if weights is None:
        share = tempered(sizes)
    else:
        named = {"null" if s is None else f"={s}": int(w) for s, w in weights.items()}
        share = {s: max(1, named.get(s, 1)) for s in sizes}
    plan = phases(share, {s: -(-n // block_rows) for s, n in sizes.items()})
    rows = [(s, [tuple(p[c] for c in ("first", "last", "weight", "total", "base", "slots")) for p in stretches]) for s, stretches in plan.items()]
    slots = F.broadcast(spark.createDataFrame(rows, SLOTS))
    ranked = keyed.join(starts, ["key", "bucket"]).withColumn(
        "r", F.col("start") + F.row_number().over(W.partitionBy("key", "bucket").orderBy("h", "d", "t")) - 1)
    block = F.expr(f"r div {block_rows}")
    placed = ranked.join(slots, "key").withColumn("block", block)
    placed = placed.withColumn("p", F.expr("filter(phases, x -> block >= x.first AND block < x.last)[0]"))
    placed = placed.withColumn("q", F.expr("block - p.first"))
    placed = placed.withColumn("slot", F.expr("p.base + (q div p.weight) * p.total + p.slots[cast(q % p.weight as int)]"))
    # a source's last block can be short: later rows move up
    short = []
    for s, n in sizes.items():
        if n % block_rows:
            p, j = plan[s][-1], -(-n // block_rows) - 1 - plan[s][-1]["first"]
            short.append((p["base"] + j // p["weight"] * p["total"] + p["slots"][j % p["weight"]], block_rows - n % block_rows))
    missing = " + ".join(["0", *(f"IF(slot > {t}, {m}, 0)" for t, m in sorted(short))])
    return placed.select(
        *[F.col("row").getField(c).alias(c) for c in columns],
        F.expr(f"slot * {block_rows} + r % {block_rows} - ({missing})").alias("position"),
        "slot",
        F.expr("p.base + (q * p.total) div p.weight").alias("release"),
        F.expr("p.base + ((q + 1) * p.total + p.weight - 1) div p.weight").alias("deadline"),
    )


def in_mixed_order(docs: DataFrame, weights: dict[str | None, int] | None = None) -> DataFrame:
    """The rows of ``docs``, sorted by their place in the mixture."""
    mixed = mix_sources(docs, weights)
    return mixed.orderBy("position").select(*docs.columns)


def in_stretches(docs: DataFrame, weights: dict[str | None, int] | None = None) -> DataFrame:
    """The rows of ``docs`` with ``stretch``: the place in the mixture in steps of ``STRETCH_ROWS``.

    Files do not keep the order of rows, so the places are worked out anew; they depend on the rows
    and the weights only. A stretch is in one partition, partitions follow each other and are sorted.
    """
    n = max(1, -(-docs.count() // STRETCH_ROWS))
    wide = min(n, partitions(docs))
    placed = mix_sources(docs, weights).withColumn("stretch", F.expr(f"position div {STRETCH_ROWS}"))
    dealt = placed.repartitionById(wide, F.expr(f"cast(stretch * {wide} div {n} as int)"))
    return dealt.sortWithinPartitions("position").select(*[c for c in docs.columns if c != "stretch"], "stretch")
