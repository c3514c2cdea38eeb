"""Approximate nearest neighbours with balanced posting lists.

A bounded sample is split, balanced, into clusters; their centroids are the only part in memory,
tied into a graph of near centroids. Every vector goes to the list of its nearest centroid, and
boundary vectors to several: all whose distance is within a ratio of the nearest, unless a centroid
already chosen is closer to the new one than the vector is. A query walks the graph from near
centroid to near centroid and reads all lists within a ratio of its best distance, however many
these are. The ratio is fitted: with it rows of the sample, held out of the clustering or not, find
``RECALL`` of their neighbours. Neighbouring lists share bins of a bounded size, long lists are
dealt over several; a query goes once to every bin that holds one of its lists and is compared with
the members of its lists there. So queries multiply by bins, not by lists, and copies of one vector
are no hot list.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from floodledger.llm.store import cut, partitions

#: Vectors that the clusters are fitted on, the first by hash of vec_id.
SAMPLE = 20_000
#: Vectors for each centroid, and the most centroids (4 MB at 256 dimensions).
LIST = 100
MOST = 4096
#: Squared distances up to this times the nearest: lists that a vector is put in, and the most of them.
REPLICA_RATIO, REPLICAS = 1.25, 4
#: Lists that a query reads in any case.
LEAST_LISTS = 8
#: Sample rows held out to fit the ratio of a query's lists, as many that are not, and the share of their neighbours to reach.
HELD_OUT, RECALL = 400, 0.98
#: Near centroids that each one is tied to, and the best centroids seen that a walk always goes on from.
DEGREE, BREADTH = 16, 32
#: Numbers in the vectors of a bin, which one task searches at a time: least and most (32 MB).
LEAST_VALUES, MOST_VALUES = 1 << 18, 1 << 22
#: Queries that are measured together.
TOGETHER = 64


def balanced(x: np.ndarray, k: int, rng) -> np.ndarray:
    """Centroids of ``k`` clusters of about equal size: halves of halves along the main axis."""
    done, todo = [], [(x, k)]
    while todo:
        part, n = todo.pop()
        if n <= 1 or len(part) <= 1:
            done.append(part.mean(axis=0))
            continue
        a, b = part[rng.choice(len(part), 2, replace=False)]
        for _ in range(6):
            side = part @ (a - b)
            cut_at = int(len(part) * (n // 2) / n)
            order = np.argsort(-side, kind="stable")
            a, b = part[order[:cut_at]].mean(axis=0) if cut_at else a, part[order[cut_at:]].mean(axis=0)
        todo += [(part[order[:cut_at]], n // 2), (part[order[cut_at:]], n - n // 2)] if cut_at else [(part, 1)]
    out = np.array(done)
    for _ in range(3):  # settle the borders
        near = nearest(x, out, 1)[0][:, 0]
        count = np.bincount(near, minlength=len(out))
        total = np.zeros_like(out)
        np.add.at(total, near, x)
        out = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], out)
    return out


def nearest(x: np.ndarray, centroids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and squared distances of the ``k`` nearest centroids of every row, nearest first."""
    k = min(k, len(centroids))
    norm = (centroids**2).sum(axis=1)
    ids, dist = [], []
    for lo in range(0, len(x), 1024):
        part = x[lo : lo + 1024]
        d = np.maximum((part**2).sum(axis=1)[:, None] - 2 * part @ centroids.T + norm, 0)
        i = np.argpartition(d, k - 1, axis=1)[:, :k]
        v = np.take_along_axis(d, i, axis=1)
        order = np.lexsort((i, v), axis=1)
        ids.append(np.take_along_axis(i, order, axis=1))
        dist.append(np.take_along_axis(v, order, axis=1))
    if not ids:
        return np.zeros((0, k), np.int64), np.zeros((0, k))
    return np.concatenate(ids), np.concatenate(dist)


def replicas(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and the lists they are put in: the nearest, and others about as near that lie in other directions."""
    ids, dist = nearest(x, centroids, 2 * REPLICAS)
    keep = np.zeros(ids.shape, bool)
    keep[:, 0] = True
    for j in range(1, ids.shape[1]):
        close = (dist[:, j] <= REPLICA_RATIO * dist[:, 0]) & (keep.sum(axis=1) < REPLICAS)
        for i in range(j):
            between = ((centroids[ids[:, i]] - centroids[ids[:, j]]) ** 2).sum(axis=1)
            close &= ~(keep[:, i] & (between < dist[:, j] * 0.5))
        keep[:, j] = close
    row, at = np.nonzero(keep)
    return row, ids[row, at]


class Graph:
    """Centroids tied to their near ones, both ways, and walked best first by many queries at a time."""

    def __init__(self, centroids: np.ndarray):
        n = len(centroids)
        self.centroids, self.norm = centroids, (centroids**2).sum(axis=1)
        near, _ = nearest(centroids, centroids, DEGREE + 1)
        a, b = np.repeat(np.arange(n), near.shape[1]), near.ravel()
        ties = np.unique(np.concatenate([a * n + b, b * n + a]))
        source, self.target = np.divmod(ties, n)
        self.start = np.searchsorted(source, np.arange(n + 1))
        # a walk starts at some spread centroids and at one in every part of the graph
        part, before = np.arange(n), None
        while before is None or (part != before).any():
            before = part.copy()
            np.minimum.at(part, source, before[self.target])
        self.entries = np.unique(np.concatenate([part, np.arange(0, n, max(1, n // 16))]))

    def distances(self, x: np.ndarray, row: np.ndarray, node: np.ndarray) -> np.ndarray:
        out, step = np.empty(len(row)), max(1, MOST_VALUES // x.shape[1])
        for lo in range(0, len(row), step):
            q, c = x[row[lo : lo + step]], node[lo : lo + step]
            out[lo : lo + step] = (q * q).sum(axis=1) + self.norm[c] - 2 * np.einsum("ij,ij->i", q, self.centroids[c])
        return np.maximum(out, 0)

    def search(self, x: np.ndarray, ratio: float, least: int = LEAST_LISTS) -> tuple[np.ndarray, np.ndarray]:
        """Rows and the centroids found no farther than ``ratio`` times the row's best, or among its ``least`` nearest; by row.

        A walk goes on from every centroid seen that is within the ratio or among the ``BREADTH`` best.
        """
        n, breadth = len(self.centroids), max(BREADTH, least)
        seen = np.zeros((len(x), n), bool)
        best = np.full((len(x), breadth), np.inf)
        row, node = np.repeat(np.arange(len(x)), len(self.entries)), np.tile(self.entries, len(x))
        rows, nodes, dists = [], [], []
        wait = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        while len(row):
            seen[row, node] = True
            d = self.distances(x, row, node)
            for out, new in zip((rows, nodes, dists), (row, node, d)):
                out.append(new)
            order = np.lexsort((d, row))
            rank = np.arange(len(row)) - np.searchsorted(row[order], row[order])
            top = order[rank < breadth]
            more = np.full((len(x), breadth), np.inf)
            more[row[top], rank[rank < breadth]] = d[top]
            best = np.sort(np.concatenate([best, more], axis=1), axis=1)[:, :breadth]
            bound = np.maximum(ratio * best[:, 0], best[:, -1])
            row, node, d = (np.concatenate([old, new]) for old, new in zip(wait, (row, node, d)))
            on = d <= bound[row]
            wait = (row[~on], node[~on], d[~on])
            row, node = row[on], node[on]
            count = self.start[node + 1] - self.start[node]
            at = np.arange(count.sum()) + np.repeat(self.start[node] - (np.cumsum(count) - count), count)
            row, node = np.divmod(np.unique(np.repeat(row, count) * n + self.target[at]), n)
            fresh = ~seen[row, node]
            row, node = row[fresh], node[fresh]
        row, node, d = (np.concatenate(c) for c in (rows, nodes, dists))
        few = best[:, min(least, n) - 1]
        keep = d <= np.maximum(ratio * best[:, 0], few)[row] + 1e-12
        row, node = row[keep], node[keep]
        order = np.lexsort((node, row))
        return row[order], node[order]


def needed_ratios(asked: np.ndarray, x: np.ndarray, centroids: np.ndarray, k: int, own: np.ndarray | None = None) -> np.ndarray:
    """The ratio of squared distances that ``asked`` need for each of their ``k`` nearest of ``x``.

    ``own`` numbers the rows of ``x`` that ``asked`` are, which are then no neighbours of themselves. In a
    sample neighbours lie farther away than in the whole table, so the ratios err to the wide side.
    """
    row, lists = replicas(x, centroids)
    starts = np.searchsorted(row, np.arange(len(x) + 1))
    norm, needed = (centroids**2).sum(axis=1), []
    for lo in range(0, len(asked), TOGETHER):
        part = asked[lo : lo + TOGETHER]
        sims = part @ x.T
        if own is not None:
            sims[np.arange(len(part)), own[lo : lo + TOGETHER]] = -2.0
        near = np.argpartition(-sims, min(k, len(x)) - 1, axis=1)[:, :k]
        d = np.maximum((part**2).sum(axis=1)[:, None] - 2 * part @ centroids.T + norm, 0)
        few = np.sort(d, axis=1)[:, [0, min(LEAST_LISTS, len(centroids)) - 1]]
        for away, (best, free), found in zip(d, few, near):
            for i in found:
                least = away[lists[starts[i] : starts[i + 1]]].min()
                needed.append(1.0 if least <= free else least / max(best, 1e-12))
    return np.array(needed)


def fitted_ratio(apart: np.ndarray, among: np.ndarray, share: float) -> float:
    """The least ratio that suffices for ``RECALL`` of all, if ``share`` of the queries are as ``among``, the others as ``apart``."""
    values = np.concatenate([apart, among, [1.0]])
    weights = np.concatenate([np.full(len(apart), (1 - share) / max(len(apart), 1)), np.full(len(among), share / max(len(among), 1)), [0.0]])
    order = np.argsort(values, kind="stable")
    reached = np.cumsum(weights[order])
    return float(values[order][min(np.searchsorted(reached, RECALL * reached[-1] - 1e-9), len(order) - 1)])


def bins(sizes: dict[int, int], per: int) -> dict[int, tuple[int, int]]:
    """First bin and number of bins of every list: following lists fill a bin of ``per`` members, a longer list has bins of its own."""
    out, at, room = {}, -1, 0
    for i in sorted(sizes):
        if sizes[i] > per:
            shares = -(-sizes[i] // per)
            out[i] = (at + 1, shares)
            at, room = at + shares, 0
            continue
        if sizes[i] > room:
            at, room = at + 1, per
        out[i] = (at, 1)
        room -= sizes[i]
    return out


def matrix(column, n: int) -> np.ndarray:
    """A batch's vectors as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that the largest component is near one and squares stay in the range of doubles."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    size = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(size == 0, 1, size)


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is of one length with the first's, not zero, without null, NaN and infinity."""
    v = F.col(vector)
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.where(v.isNotNull() & (F.size(v) > 0) & ok)


def neighbours(rows: DataFrame, queries: str, k: int = 5, vector: str = "embedding", query_ratio: float | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found by cosine for each row of the condition ``queries``.

    Rows without vec_id and vectors that are null, empty, zero or hold null or non-finite components
    take no part, as do vectors of another length than most of the sample. A query's own row (its
    vec_id) is no candidate. Ties go to the smaller vec_id; of rows with one vec_id the best counts.
    Fewer candidates than ``k`` give fewer rows. ``score`` is computed in doubles. ``query_ratio`` is
    that of the squared distances of the lists a query reads; without it, it is fitted.
    """
    spark = rows.sparkSession
    rows = usable(rows.where("vec_id IS NOT NULL"), vector).select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    drawn = rows.select("vec_id").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).distinct()
    sample = rows.join(F.broadcast(cut(drawn, "sample")), "vec_id").orderBy("vec_id").collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not sample:
        return spark.createDataFrame([], schema)
    sizes = [len(r["v"]) for r in sample]
    dim = max(set(sizes), key=lambda d: (sizes.count(d), -d))
    rows = rows.where(F.size("v") == dim)
    n = rows.count()
    x = unit(np.array([r["v"] for r in sample if len(r["v"]) == dim]))
    rng = np.random.default_rng(7)
    apart = rng.permutation(len(x)) < min(HELD_OUT, len(x) // 4)
    fit = x[~apart]
    centroids = balanced(fit, max(1, min(MOST, n // LIST, len(fit) // 4)), rng)
    ratio = query_ratio
    if ratio is None:
        # a row that helped to place its centroid lies nearer to it than others do: queries are of both sorts
        some = rng.permutation(len(fit))[:HELD_OUT]
        ratio = fitted_ratio(needed_ratios(x[apart], fit, centroids, k), needed_ratios(fit[some], fit, centroids, k, some), len(fit) / max(n, len(fit)))
    sent = spark.sparkContext.broadcast(centroids)

    def assign(batches):
        own = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            row, lists = replicas(unit(matrix(batch.column("v"), batch.num_rows)), own)
            yield pa.RecordBatch.from_arrays([pa.array(lists.astype(np.int32)), *[batch.column(c).take(pa.array(row)) for c in ("vec_id", "v")]], names=["list", "vec_id", "v"])

    posted = cut(rows.mapInArrow(assign, "list int, vec_id long, v array<double>"), "postings")
    sizes = {r[0]: r[1] for r in posted.groupBy("list").count().collect()}  # a row for each list, MOST at most
    per = max(1, min(MOST_VALUES // dim, max(LEAST_VALUES // dim, sum(sizes.values()) // (2 * partitions(rows)))))
    place = bins(sizes, per)
    held = spark.sparkContext.broadcast(place)

    def probe(batches):
        graph, places = Graph(sent.value), held.value
        step = max(1, MOST_VALUES // dim)
        for batch in batches:
            for lo in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(lo, TOGETHER)
                row, lists = graph.search(unit(matrix(part.column("v"), part.num_rows)), ratio)
                asked: dict[tuple[int, int], list[int]] = {}
                for r, i in zip(row.tolist(), lists.tolist()):
                    first, shares = places.get(i, (0, 0))
                    for b in range(first, first + shares):
                        asked.setdefault((r, b), []).append(i)
                calls = list(asked.items())
                for a in range(0, len(calls), step):
                    some = calls[a : a + step]
                    took = pa.array([r for (r, _), _ in some])
                    columns = [pa.array([b for (_, b), _ in some], pa.int32()), pa.array([i for _, i in some], pa.list_(pa.int32()))]
                    yield pa.RecordBatch.from_arrays([*columns, *[part.column(c).take(took) for c in ("vec_id", "v")]], names=["bin", "lists", "vec_id", "v"])

    shares = F.broadcast(cut(spark.createDataFrame([(i, *b) for i, b in place.items()], "list int, first int, shares int"), "shares"))
    members = posted.join(shares, "list").select(F.expr("first + pmod(xxhash64(vec_id), shares)").cast("int").alias("bin"), F.lit(False).alias("asks"), F.array("list").alias("lists"), "vec_id", "v")
    calls = rows.where(queries).mapInArrow(probe, "bin int, lists array<int>, vec_id long, v array<double>").select("bin", F.lit(True).alias("asks"), "lists", "vec_id", "v")
    work = members.unionByName(calls).repartition(partitions(rows), "bin").sortWithinPartitions("bin", "asks", "vec_id")
    found = work.mapInArrow(search_rows(k), "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def distinct(ids: np.ndarray, lists: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Each vector of an id once in every list, and the most rows that one id has."""
    mixed = (np.ascontiguousarray(x).view(np.uint64) * (2 * np.arange(x.shape[1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))).sum(axis=1)
    order = np.lexsort((mixed, ids, lists))
    ids, lists, x, mixed = ids[order], lists[order], x[order], mixed[order]
    same = (ids[1:] == ids[:-1]) & (lists[1:] == lists[:-1]) & (mixed[1:] == mixed[:-1]) & (x[1:] == x[:-1]).all(axis=1)
    new = np.concatenate([[True], ~same])
    ids, lists, x = ids[new], lists[new], x[new]
    return ids, lists, x, int(np.unique(ids, return_counts=True)[1].max())


def cosine(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    x, q = scaled(x), scaled(q[None, :])[0]
    return (x * q).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum()))


def search_rows(k: int):
    """The best of one bin for every query that reads it."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def best_of(ids, x, most, name, q, s):
        """The best rows by their rounded scores ``s``, which are overwritten at the query's own rows."""
        wide = k * most
        s[ids == name] = -2.0
        # rounding must not decide ties: everything near the k-th is measured again
        least = np.partition(s, len(s) - wide)[len(s) - wide] if len(s) > wide else -1.5
        pick = np.flatnonzero((s >= least - 1e-9) & (s > -1.5))
        exact = cosine(x[pick], q) if len(pick) else np.zeros(0)
        best = np.lexsort((ids[pick], -exact))
        if most > 1:
            best = best[np.sort(np.unique(ids[pick][best], return_index=True)[1])]
        best = best[:k]
        return np.full(len(best), name), ids[pick][best], exact[best]

    def answer(ids, lists, x, near, most, names, wanted, queries):
        out = []
        ends = np.searchsorted(lists, lists, "right")
        first = np.flatnonzero(np.concatenate([[True], lists[1:] != lists[:-1]]))
        held = dict(zip(lists[first].tolist(), zip(first.tolist(), ends[first].tolist())))
        for lo in range(0, len(names), TOGETHER):
            q = queries[lo : lo + TOGETHER]
            spans = [[held[i] for i in w if i in held] for w in wanted[lo : lo + TOGETHER]]
            read = sum(b - a for s in spans for a, b in s)
            u = unit(q)
            # where most of the bin is read anyway, one product for all of these queries is the quickest
            sims = u @ near.T if 4 * read > len(ids) * len(q) else None
            for j, (name, span) in enumerate(zip(names[lo : lo + TOGETHER], spans)):
                if sims is not None:
                    out.append(best_of(ids, x, most, name, q[j], sims[j]))
                elif span:
                    at = np.concatenate([np.arange(a, b) for a, b in span])
                    out.append(best_of(ids[at], x[at], most, name, q[j], near[at] @ u[j]))
        if not out:
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=schema)

    def run(batches):
        now, members, held = None, [], None
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("bin", "asks")], axis=1)
            if not len(key):
                continue
            bounds = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
            for lo, hi in zip(bounds, np.append(bounds[1:], len(key))):
                part = batch.slice(lo, hi - lo)
                if key[lo, 0] != now:
                    now, members, held = key[lo, 0], [], None
                names = part.column("vec_id").to_numpy()
                block = matrix(part.column("v"), hi - lo)
                if not key[lo, 1]:
                    members.append((names, part.column("lists").flatten().to_numpy(), block))
                elif members:
                    if held is None:
                        ids, lists, x, most = distinct(*(np.concatenate(c) for c in zip(*members)))
                        held, members = (ids, lists, x, unit(x), most), [()]
                    if (result := answer(*held, names, part.column("lists").to_pylist(), block)) is not None:
                        yield result

    return run
