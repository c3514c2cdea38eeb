"""Near-duplicate components by an exact n-gram Jaccard join with PartEnum signatures.

A document is its set of distinct word shingles. Sets are dealt into size bands so that linked
sets are in one band or in neighbours; for a pair of bands the Jaccard bound becomes a bound ``k``
on the symmetric difference. The domain of shingles is cut into ``n1`` parts of three subparts, and
each set gives one signature for every part and every two of its subparts. Two sets that differ in
at most ``k`` shingles have more than ``n1 - k // 2 - 1`` parts with at most one difference, and in
each of these two subparts agree: they share a signature.

Signatures of nothing, and hot ones (more than ``HOT`` different sets), are useless to search by.
They are not lost: a set keeps its guarantee as long as it has fewer of them than spare parts. The
other sets, few, are signed again shingle by shingle, and those whose shingles are hot too, that
is families of very many near copies, are tied to the smallest set with that shingle.

Candidate pairs pass a sketch (shingle counts per bucket, whose difference never exceeds the real
one), the rest falls into small families, and a family is verified exactly, in blocks of sets, so
that each set is shipped once per block pair and no pair of rows is ever emitted for a copy.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from floodledger.llm.arrays import (
    U64, by_key, mix, runs, shingle_sets, slices, text_buffer,
)
from floodledger.llm.components import components
from floodledger.llm.store import cut, partitions, sent

#: A signature of more different sets than this is replaced by finer ones.
HOT = 24
#: Signatures of a task that are sorted and merged before they are shuffled.
CHUNK = 1_500_000
#: Sets of a family that one task compares with as many others.
BLOCK = 192
#: Of the sketch: shingles per bucket, about.
PER_BUCKET = 8
COLUMNS = 4096
KEY = U64((1 << 40) - 1)


class Bands:
    """Size bands of a Jaccard bound in percent; tag ``j`` holds pairs whose smaller set is in band j-1."""

    def __init__(self, percent: int):
        self.percent = percent
        self.last: list[int] = []

    def _grow(self, size: int) -> None:
        while not self.last or self.last[-1] < size:
            low = (self.last[-1] if self.last else 0) + 1
            self.last.append(low * 100 // self.percent)

    def band(self, sizes: np.ndarray) -> np.ndarray:
        self._grow(int(sizes.max()) if len(sizes) else 1)
        return np.searchsorted(np.array(self.last), sizes)

    def differences(self, tag: int) -> int:
        """The most that two linked sets of tag ``tag`` can differ."""
        if tag == 0:
            return -1
        while len(self.last) < tag:
            self._grow(self.last[-1] + 1 if self.last else 1)
        small = self.last[tag - 1]
        return (small + small * 100 // self.percent) * (100 - self.percent) // (100 + self.percent)


def parts(k: int) -> int:
    return k // 2 + 2 + k // 16


def node_of(values: np.ndarray) -> int:
    """A name for a set: equal sets only have equal names (of 64 bits)."""
    total = np.add.reduce(mix(values + U64(0x1234567)), dtype=U64)
    return int(mix(np.array([total], U64) + U64(len(values))).view(np.int64)[0])


def sketch_of(values: np.ndarray) -> np.ndarray:
    bits = max(0, round(math.log2(max(1, len(values)) / PER_BUCKET)))
    if bits == 0:
        return np.array([len(values)], np.uint32)
    return np.bincount((values >> U64(64 - bits)).astype(np.int64), minlength=1 << bits).astype(np.uint32)


def least_difference(a: np.ndarray, b: np.ndarray) -> int:
    """A lower bound of the symmetric difference of two sketched sets."""
    while len(a) > len(b):
        a = a.reshape(-1, 2).sum(axis=1)
    while len(b) > len(a):
        b = b.reshape(-1, 2).sum(axis=1)
    return int(np.abs(a.astype(np.int64) - b.astype(np.int64)).sum())


def pack(x: np.ndarray) -> bytes:
    return (x.astype(np.uint16).tobytes() + b"\2") if not len(x) or x.max() < 65536 else (x.tobytes() + b"\4")


def unpack(b: bytes) -> np.ndarray:
    return np.frombuffer(b[:-1], np.uint16 if b[-1] == 2 else np.uint32)


def class_rows(width: int, percent: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("sketch", pa.binary()), ("bad_0", pa.int64()), ("bad_1", pa.int64())])

    def run(batches):
        bands = Bands(percent)
        for batch in batches:
            ids = batch.column("doc_id")
            for lo, hi, data, offsets in slices(*text_buffer(batch.column("text"))):
                values, bounds = shingle_sets(data, offsets, width)
                sets = [values[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
                bad = np.zeros((len(sets), 2), np.int64)
                for i, (s, band) in enumerate(zip(sets, bands.band(np.diff(bounds)))):
                    for tag in (int(band), int(band) + 1):
                        if len(s) and (k := bands.differences(tag)) > 0:
                            bad[i, tag & 1] = empty_parts(s, parts(k))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(np.diff(bounds)), pa.array([node_of(s) for s in sets], pa.int64()),
                     pa.array([pack(sketch_of(s)) for s in sets], pa.binary()), pa.array(bad[:, 0].copy()), pa.array(bad[:, 1].copy())], schema=schema)

    return run, "doc_id long, n long, node long, sketch binary, bad_0 long, bad_1 long"


def empty_parts(values: np.ndarray, n1: int) -> int:
    """Parts of which two subparts are empty, so that a signature of theirs says nothing."""
    full = np.zeros(3 * n1, np.int8)
    full[(((values >> U64(32)) * U64(3 * n1)) >> U64(32)).astype(np.int64)] = 1
    return int((full.reshape(-1, 3).sum(axis=1) < 2).sum())


def part_signatures(values: np.ndarray, tag: int, n1: int) -> np.ndarray:
    """One signature for each part and each two of its three subparts, but for empty ones."""
    cell = ((values >> U64(32)) * U64(3 * n1)) >> U64(32)
    sums = np.zeros(3 * n1, U64)
    first, _ = runs(cell)
    sums[cell[first].astype(np.int64)] = np.add.reduceat(mix(values), first)
    a, b, c = sums.reshape(-1, 3).T
    place = np.arange(n1, dtype=U64) * U64(8) + (U64(tag) << U64(40))
    out = [mix(mix(x * U64(3) + place + U64(i)) + y) for i, (x, y) in enumerate(((a, b), (a, c), (b, c)))]
    full = [(x != 0) | (y != 0) for x, y in ((a, b), (a, c), (b, c))]
    return np.concatenate([s[f] for s, f in zip(out, full)])


def signature_rows(width: int, percent: int, buckets: int, fine: bool):
    """Signatures by bucket. ``fine``: shingle by shingle, for the tag parities in the column ``mask``."""
    schema = pa.schema([("bucket", pa.int32())] + [(c, pa.binary()) for c in ("low", "high", "index", "nodes", "hot", "lead", "hits")])

    def emit(sigs: np.ndarray, index: np.ndarray, nodes: np.ndarray):
        order = np.argsort(sigs)
        sigs, index = sigs[order], index[order]
        starts, ends = runs(sigs)
        many = (ends - starts) > HOT
        hits = np.zeros((0, 4), np.int64)
        keep = np.ones(len(sigs), bool)
        hot_sigs, leads = np.zeros(0, U64), np.zeros(0, np.int64)
        if many.any():
            # hot within this task already: one mark for the signature, the sets' hits aside
            found = []
            for lo, hi in zip(starts[many], ends[many]):
                members = np.unique(nodes[index[lo:hi]])
                if len(members) <= HOT:
                    continue
                keep[lo:hi] = False
                found.append((sigs[lo], members[0], members))
            if found:
                hot_sigs = np.array([f[0] for f in found], U64)
                leads = np.array([f[1] for f in found], np.int64)
                hits = hit_table(np.concatenate([f[2] for f in found]),
                                 np.concatenate([np.full(len(f[2]), f[1]) for f in found]),
                                 np.concatenate([np.full(len(f[2]), int(f[0] & U64(1))) for f in found]))
        sigs, index = sigs[keep], index[keep]
        bucket_of = lambda s: (((s >> U64(32)) * U64(buckets)) >> U64(32)).astype(np.int64)
        bucket, hot_bucket = bucket_of(sigs), bucket_of(hot_sigs)
        rows = []
        share = np.array_split(hits, buckets) if len(hits) else None
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        for b in range(buckets):
            s, i = sigs[cuts[b] : cuts[b + 1]], index[cuts[b] : cuts[b + 1]]
            mine = hot_bucket == b
            part = share[b] if share is not None else hits
            if not len(s) and not mine.any() and not len(part):
                continue
            used, small = np.unique(i, return_inverse=True)
            key = s & KEY
            rows.append((b, (key & U64(0xFFFFFFFF)).astype(np.uint32).tobytes(), (key >> U64(32)).astype(np.uint8).tobytes(),
                         small.astype(np.uint16).tobytes(), nodes[used].tobytes(), (hot_sigs[mine] & KEY).tobytes(),
                         leads[mine].tobytes(), part.tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema) if rows else None

    def run(batches):
        bands = Bands(percent)
        held, owners, nodes, total = [], [], [], 0
        for batch in batches:
            masks = batch.column("mask").to_pylist() if fine else [3] * batch.num_rows
            for row, _, data, offsets in slices(*text_buffer(batch.column("text"))):
                values, bounds = shingle_sets(data, offsets, width)
                band = bands.band(np.diff(bounds)) if len(bounds) > 1 else []
                for at, (lo, hi, i) in enumerate(zip(bounds[:-1], bounds[1:], band)):
                    if hi == lo:
                        continue
                    s, mine, node = values[lo:hi], [], node_of(values[lo:hi])
                    for tag in (int(i), int(i) + 1):
                        k = bands.differences(tag)
                        if k <= 0 or not masks[row + at] >> (tag & 1) & 1:  # k of 0: only equal sets link
                            continue
                        sig = mix(s + U64(tag) * U64(0xABCDEF123457)) if fine else part_signatures(s, tag, parts(k))
                        mine.append(sig & ~U64(1) | U64(tag & 1))
                    if mine:
                        sig = np.unique(np.concatenate(mine))
                        held.append(sig)
                        owners.append(np.full(len(sig), len(nodes), np.uint32))
                        nodes.append(node)
                        total += len(sig)
                    if total >= CHUNK or len(nodes) == 65535:
                        if (out := emit(np.concatenate(held), np.concatenate(owners), np.array(nodes, np.int64))) is not None:
                            yield out
                        held, owners, nodes, total = [], [], [], 0
        if held and (out := emit(np.concatenate(held), np.concatenate(owners), np.array(nodes, np.int64))) is not None:
            yield out

    return run, "bucket int, low binary, high binary, index binary, nodes binary, hot binary, lead binary, hits binary"


def hit_table(node: np.ndarray, lead: np.ndarray, parity: np.ndarray) -> np.ndarray:
    """Rows of node, lead, parity and how often they occur."""
    order = np.lexsort((parity, lead, node))
    table = np.stack([node, lead, parity], axis=1)[order]
    if not len(table):
        return np.zeros((0, 4), np.int64)
    first = np.flatnonzero(np.concatenate([[True], (table[1:] != table[:-1]).any(axis=1)]))
    return np.column_stack([table[first], np.diff(np.append(first, len(table)))])


FOUND = "kind int, a long, b long, parity int, hits long"


def match_rows(batches):
    """Of every bucket: pairs of sets that share a signature, and the hits of hot ones."""
    schema = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("parity", pa.int32()), ("hits", pa.int64())])
    for _, table in by_key(batches, "bucket"):
        keys, nodes, hot, lead, hits = [], [], [], [], []
        for row in table.to_pylist():
            names = np.frombuffer(row["nodes"], np.int64)
            keys.append(np.frombuffer(row["low"], np.uint32).astype(U64) | np.frombuffer(row["high"], np.uint8).astype(U64) << U64(32))
            nodes.append(names[np.frombuffer(row["index"], np.uint16)])
            hot.append(np.frombuffer(row["hot"], U64))
            lead.append(np.frombuffer(row["lead"], np.int64))
            hits.append(np.frombuffer(row["hits"], np.int64).reshape(-1, 4))
        key, node = np.concatenate(keys), np.concatenate(nodes)
        hot, lead = np.concatenate(hot), np.concatenate(lead)
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        if len(key):
            fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])
            key, node = key[fresh], node[fresh]
        starts, ends = runs(key)
        size = ends - starts
        marked = np.isin(key[starts], hot) if len(hot) else np.zeros(len(starts), bool)
        is_hot = marked | (size > HOT)
        group = np.repeat(np.arange(len(starts)), size)
        # pairs of the plain groups
        plain = np.repeat(~is_hot & (size > 1), size)
        g, v = group[plain], node[plain]
        pairs = []
        for d in range(1, HOT):
            same = g[d:] == g[:-d]
            if not same.any():
                break
            pairs.append(np.stack([v[:-d][same], v[d:][same]], axis=1))
        if pairs:
            pairs = np.concatenate(pairs)
            pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
            pairs = pairs[np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(axis=1)])]
            zero = np.zeros(len(pairs), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(zero.astype(np.int32)), pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1])), pa.array(zero.astype(np.int32)), pa.array(zero)], schema=schema)
        # hot groups: hits of their sets; all leads of a signature are tied together
        chosen = np.repeat(is_hot, size)
        found = [np.concatenate(hits)] if hits else []
        if chosen.any():
            low = np.repeat(node[starts], size)[chosen]
            found.append(hit_table(node[chosen], low, (key[chosen] & U64(1)).astype(np.int64)))
        if len(hot):
            seen = np.concatenate([hot, key[starts][marked]])
            head = np.concatenate([lead, node[starts][marked]])
            order = np.lexsort((head, seen))
            seen, head = seen[order], head[order]
            s, e = runs(seen)
            found.append(np.column_stack([head, np.repeat(head[s], e - s), np.zeros((len(head), 2), np.int64)]))
        if found and len(table := np.concatenate(found)):
            # kind 1: hits; kind 2: only ties two leads
            kind = np.where(table[:, 3] > 0, 1, 2).astype(np.int32)
            col = [np.ascontiguousarray(table[:, i]) for i in range(4)]
            yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(col[0]), pa.array(col[1]), pa.array(col[2].astype(np.int32)), pa.array(col[3])], schema=schema)


def _matches(docs: DataFrame, width: int, percent: int, fine: bool) -> DataFrame:
    n = partitions(docs)
    run, schema = signature_rows(width, percent, n, fine)
    signed = docs.mapInArrow(run, schema)
    return cut(signed.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(match_rows, FOUND), "matches")


def deficient_rows(percent: int, fine: bool):
    """Sets that have no more useful signatures than the bound needs, and for which tag parities."""

    def run(batches):
        bands = Bands(percent)
        for batch in batches:
            n = batch.column("n").to_numpy(zero_copy_only=False)
            masks = np.zeros(len(n), np.int32)
            for i, (size, band) in enumerate(zip(n, bands.band(n) if len(n) else [])):
                for tag in (int(band), int(band) + 1):
                    k = bands.differences(tag)
                    lost = batch.column(f"hits_{tag & 1}")[i].as_py()
                    if k > 0 and (size - lost <= k if fine else parts(k) - lost - batch.column(f"bad_{tag & 1}")[i].as_py() <= k // 2):
                        masks[i] |= 1 << (tag & 1)
            keep = masks > 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(keep)) for c in ("doc_id", "node")] + [pa.array(masks[keep])], names=["doc_id", "node", "mask"])

    return run, "doc_id long, node long, mask int"


def _deficient(found: DataFrame, reps: DataFrame, percent: int, fine: bool) -> DataFrame:
    hits = found.where("kind = 1").groupBy(F.col("a").alias("node")).agg(
        *[F.sum(F.when(F.col("parity") == p, F.col("hits")).otherwise(0)).alias(f"hits_{p}") for p in (0, 1)]
    )
    seen = reps.select("node", "doc_id", "n", "bad_0", "bad_1").join(hits, "node", "inner" if fine else "left")
    seen = seen.select("doc_id", "node", "n", "bad_0", "bad_1", *[F.coalesce(f"hits_{p}", F.lit(0)).alias(f"hits_{p}") for p in (0, 1)])
    run, schema = deficient_rows(percent, fine)
    return cut(seen.mapInArrow(run, schema), "deficient")


def close_rows(percent: int):
    """Pairs whose sizes and sketches allow a link."""

    def run(batches):
        for batch in batches:
            n, m = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b"))
            keep = (np.minimum(n, m) * 100 >= np.maximum(n, m) * percent)
            first, second = batch.column("sketch_a"), batch.column("sketch_b")
            for i in np.flatnonzero(keep):
                least = least_difference(unpack(first[i].as_py()), unpack(second[i].as_py()))
                keep[i] = least * (100 + percent) <= (n[i] + m[i]) * (100 - percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def set_rows(width: int):
    schema = pa.schema([("node", pa.int64()), ("values", pa.binary())])

    def run(batches):
        for batch in batches:
            for _, _, data, offsets in slices(*text_buffer(batch.column("text"))):
                values, bounds = shingle_sets(data, offsets, width)
                sets = [values[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], schema=schema)

    return run


def intersections(sets: list[np.ndarray], left: int) -> np.ndarray:
    """Sizes of the intersections of the first ``left`` sets with all, by shared features only."""
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    starts, ends = runs(values)
    shared = (ends - starts) > 1
    feature = np.repeat(np.cumsum(shared) - 1, ends - starts)
    keep = np.repeat(shared, ends - starts)
    feature, owner = feature[keep], owner[keep]
    total = np.zeros((left, len(sets)), np.int64)
    bounds = np.searchsorted(feature, np.arange(0, (feature[-1] if len(feature) else 0) + COLUMNS + 1, COLUMNS))
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        if hi > lo:
            dense = np.zeros((len(sets), COLUMNS), np.float32)
            dense[owner[lo:hi], feature[lo:hi] % COLUMNS] = 1
            total += (dense[:left] @ dense.T).astype(np.int64)
    return total


def link_rows(percent: int):
    """Links of each unit as a forest: every set of a tree points to its smallest."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches):
        for _, table in by_key(batches, "unit"):
            names = table.column("node").to_numpy()
            left = table.column("left").to_numpy(zero_copy_only=False)
            right = table.column("right").to_numpy(zero_copy_only=False)
            order = np.argsort(~left, kind="stable")
            blobs = table.column("values")
            sets = [np.frombuffer(blobs[int(i)].as_py(), U64) for i in order]
            names, right = names[order], right[order]
            count = int(left.sum())
            size = np.array([len(s) for s in sets])
            both = intersections(sets, count)
            linked = 100 * both >= percent * (size[:count, None] + size[None, :] - both)
            linked &= right[None, :] & (names[:count, None] != names[None, :])
            root = np.arange(len(sets))

            def find(x):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for i, j in zip(*np.nonzero(linked)):
                a, b = find(i), find(j)
                if a != b:
                    root[max(a, b)] = min(a, b)
            top = np.array([find(i) for i in range(len(sets))])
            least = np.full(len(sets), np.iinfo(np.int64).max)
            np.minimum.at(least, top, names)
            moved = least[top] != names
            if moved.any():
                yield pa.RecordBatch.from_arrays([pa.array(names[moved]), pa.array(least[top][moved])], schema=schema)

    return run


def _units(members: DataFrame, percent: int) -> DataFrame:
    """``(unit, node, left, right)``: whole families, or pairs of blocks of a large one whose sizes can link."""
    total = members.groupBy("family").agg(F.count("*").alias("total"))
    sized = members.join(total, "family")
    small = sized.where(F.col("total") <= BLOCK).select(
        F.xxhash64("family").alias("unit"), "node", F.lit(True).alias("left"), F.lit(True).alias("right"))
    large = sized.where(F.col("total") > BLOCK)
    place = large.select("family", "node", "n", F.row_number().over(W.partitionBy("family").orderBy("n", "node")).alias("r"))
    place = cut(place.select("family", "node", "n", F.floor((F.col("r") - 1) / BLOCK).alias("block")), "blocks")
    ranges = place.groupBy("family", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    a, b = ranges.alias("a"), ranges.alias("b")
    pairs = a.join(b, (F.col("a.family") == F.col("b.family")) & (F.col("a.block") <= F.col("b.block"))
                   & (F.col("b.low") * percent <= F.col("a.high") * 100))
    pairs = pairs.select(F.col("a.family").alias("family"), F.col("a.block").alias("i"), F.col("b.block").alias("j"))
    sides = pairs.select("family", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    blocks = sides.join(place, ["family", "block"]).select(
        F.xxhash64("family", "i", "j").alias("unit"), "node", (F.col("block") == F.col("i")).alias("left"), (F.col("block") == F.col("j")).alias("right"))
    return small.unionByName(blocks)


def similar_documents(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id`` for every row of ``docs(doc_id, text, ...)``.

    Two documents link when ``100 * |intersection| >= percent * |union|`` of their sets of distinct
    shingles of ``width`` words; ``component_id`` is the smallest doc_id reachable by links, and
    ``class_id`` the smallest doc_id with an equal set. Words are runs of non-space bytes, A-Z in
    lower case; a text of fewer words is one shingle. Null and empty texts and texts of spaces have
    the empty set and link with nothing. Rows without doc_id are left out, as nothing can name
    them; rows that share a doc_id each give a row. Other columns are ignored.
    """
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    run, schema = class_rows(width, percent)
    classes = cut(docs.mapInArrow(run, schema), "classes")
    # equal sets are one node from here on, named by its smallest document
    named = classes.where("n > 0").groupBy("node", "n").agg(F.min("doc_id").alias("doc_id"), F.min("bad_0").alias("bad_0"), F.min("bad_1").alias("bad_1"))
    reps = cut(named, "reps")
    found = _matches(docs.select("text"), width, percent, False)
    pairs = found.where("kind = 0").select("a", "b")
    lost = _deficient(found, reps, percent, False)
    ties = None
    if lost.head(1):
        again = docs.join(sent(lost.select("doc_id", "mask")), "doc_id").select("text", "mask")
        fine = _matches(again, width, percent, True)
        pairs = pairs.union(fine.where("kind = 0").select("a", "b"))
        crowd = _deficient(fine, reps, percent, True).select("node").distinct()
        hits = fine.where("kind = 1 AND a <> b").select("a", "b").distinct()
        ties = hits.join(crowd.withColumnRenamed("node", "a"), "a", "left_semi").union(fine.where("kind = 2 AND a <> b").select("a", "b"))
    pairs = cut(pairs.distinct(), "pairs")
    ends = cut(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "ends")
    drawn = classes.join(ends, "node", "left_semi").groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    drawn = cut(drawn, "sketches")
    sides = pairs
    for c in ("a", "b"):
        sides = sides.join(drawn.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}")), c)
    close = sides.mapInArrow(close_rows(percent), "a long, b long")
    edges = close if ties is None else close.union(ties)
    family = components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    family = family.select("node", F.col("root").alias("family")).union(family.select(F.col("root").alias("node"), F.col("root").alias("family")).distinct())
    members = cut(family.join(reps.select("node", "n", "doc_id"), "node"), "members")
    units = cut(_units(members, percent), "units")
    texts = docs.join(sent(members.select("doc_id")), "doc_id", "left_semi").select("text")
    sets = texts.mapInArrow(set_rows(width), "node long, values binary").dropDuplicates(["node"])
    work = units.join(sets, "node").repartition(partitions(docs), "unit").sortWithinPartitions("unit")
    links = components(work.mapInArrow(link_rows(percent), "u long, v long"))
    known = links.select("node", "root").union(links.select(F.col("root").alias("node"), "root").distinct())
    known = cut(known.join(reps.select("node", "doc_id"), "node"), "known")
    top = known.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    top = known.join(top, "root").select("node", "component_id")
    out = classes.where("n > 0").select("doc_id", "n", "node").join(reps.select("node", F.col("doc_id").alias("class_id")), "node").join(top, "node", "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "class_id").alias("component_id"), "class_id")
    empty = classes.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"))
    return out.union(empty)

