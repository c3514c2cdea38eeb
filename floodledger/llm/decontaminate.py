"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Both sides are sets of hashed shingles, and both are partitioned by size. An item of ``m`` shingles
keeps a bottom sketch, its ``m - ceil(t * m) + 1`` smallest hashes: whoever holds a share ``t`` of the
item misses too few of its shingles to avoid the whole sketch, however long the document is, so
short items in long documents need no Jaccard detour. Items of similar size share a partition. A
partition's bound is the largest hash in its sketches, and a document is probed with its own MinHash
sketch at that bound: those of its hashes that do not exceed it, about the share ``1 - t`` of them
where items are not tiny. A document with fewer shingles than the smallest item of a partition needs
is not probed there at all. Neither step loses a match. Every hit is then verified by counting the
item's shingles in the whole document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodledger.llm.arrays import U64, grams, shingle_sets, slices, text_buffer, words
from floodledger.llm.store import cut, shared, taken

#: Items that are sent to the executors at once (their texts, whole); more items take more passes.
ITEM_BYTES = 8 << 20
#: Largest sizes of the partitions grow by this factor.
GROWTH = 1.25


def partition_limit(size: int) -> int:
    """The largest size of the partition that sets of ``size`` are in."""
    limit = 1
    while limit < size:
        limit = max(limit + 1, int(limit * GROWTH))
    return limit


def needed(size: int, threshold: float) -> int:
    """The fewest shingles of an item of ``size`` that make a match."""
    return max(1, math.ceil(threshold * size - 1e-9))


def sketch_length(size: int, threshold: float) -> int:
    return size - needed(size, threshold) + 1


@dataclass
class Partition:
    """Items of similar size: their sketches' hashes in order, and the item of each."""

    keys: np.ndarray
    owner: np.ndarray
    fewest: int  # shingles that a document must have to match any of the items

    @property
    def bound(self) -> np.uint64:
        return self.keys[-1]


class Index:
    """Sketches and whole sets of items, by the number of words of their shingles and by size."""

    def __init__(self, ids: list, texts: list[str], width: int, threshold: float):
        raw = [t.encode() for t in texts]
        offsets = np.cumsum([0] + [len(r) for r in raw], dtype=np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        _, rows, _, _ = words(data, offsets)
        count = np.bincount(rows, minlength=len(ids))
        values, bounds = shingle_sets(data, offsets, width)
        self.ids, self.threshold, self.width = ids, threshold, width
        self.sets = [values[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        members: dict[int, dict[int, list[int]]] = {}
        for i, c in enumerate(count):
            if c:
                members.setdefault(min(int(c), width), {}).setdefault(partition_limit(len(self.sets[i])), []).append(i)
        self.by_width = {k: self._partitions(by_size.values()) for k, by_size in sorted(members.items())}

    def _partitions(self, parts) -> list[Partition]:
        """One partition for each group of items, those with the largest bound first."""
        out = []
        for here in parts:
            sketches = [self.sets[i][: sketch_length(len(self.sets[i]), self.threshold)] for i in here]
            keys, owner = np.concatenate(sketches), np.repeat(here, [len(s) for s in sketches])
            order = np.argsort(keys, kind="stable")
            fewest = min(needed(len(self.sets[i]), self.threshold) for i in here)
            out.append(Partition(keys[order], owner[order], fewest))
        return sorted(out, key=lambda p: p.bound, reverse=True)

    def sketches(self, k: int, values: np.ndarray, holder: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The documents' own sketches: hashes up to the largest bound of the partitions that a document is large enough for."""
        parts = sorted(self.by_width[k], key=lambda p: p.fewest)
        bounds = np.maximum.accumulate(np.array([U64(0)] + [p.bound for p in parts], U64))
        bound = bounds[np.searchsorted([p.fewest for p in parts], sizes, side="right")]
        within = values <= np.repeat(bound, sizes)
        return values[within], holder[within]

    def candidates(self, k: int, values: np.ndarray, holder: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Distinct pairs of row and item that share a hash of the item's sketch, in order of rows."""
        found = [np.zeros((0, 2), np.int64)]
        values, holder = self.sketches(k, values, holder, sizes)
        near = np.zeros(1 << 20, bool)
        for part in self.by_width[k]:
            near[(part.keys >> U64(44)).astype(np.int64)] = True
        maybe = near[(values >> U64(44)).astype(np.int64)]
        values, holder = values[maybe], holder[maybe]
        for part in self.by_width[k]:
            within = values <= part.bound  # bounds fall, so the sketches of the documents only shrink
            values, holder = values[within], holder[within]
            big = sizes[holder] >= part.fewest
            probes, rows = values[big], holder[big]
            lo, hi = np.searchsorted(part.keys, probes), np.searchsorted(part.keys, probes, side="right")
            size = hi - lo
            at = np.repeat(lo, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            found.append(np.stack([np.repeat(rows, size), part.owner[at]], axis=1))
        return np.unique(np.concatenate(found), axis=0)

    def search(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Row, item and shared shingles of every verified pair."""
        hashes, rows, _, _ = words(data, offsets)
        for k in self.by_width:
            values, holder = grams(hashes, rows, k)
            # repeated shingles make a document look larger than it is, which only probes more
            sizes = np.bincount(holder, minlength=len(offsets) - 1)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            row, held = -1, None
            for r, i in self.candidates(k, values, holder, sizes):
                if r != row:
                    row, held = r, np.unique(values[starts[r] : starts[r + 1]])
                wanted = self.sets[i]
                place = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
                common = int((held[place] == wanted).sum())
                if common >= self.threshold * len(wanted) - 1e-9:
                    yield int(r), int(i), common


def _blocks(items: DataFrame) -> Iterator[list]:
    """Items in blocks of a bounded number of bytes, by ranges of their numbers."""
    sized = cut(items.select("item_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes")), "items")
    whole = sized.agg(F.sum("bytes")).first()[0] or 0
    n = -(-int(whole) // ITEM_BYTES) or 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for i in range(n):
        yield (sized if n == 1 else sized.where(part == i)).select("item_id", "text").collect()


def _indexes(docs: DataFrame, items: DataFrame, threshold: float, width: int):
    for block in _blocks(items.where("item_id IS NOT NULL")):
        index = Index([r[0] for r in block], [r[1] or "" for r in block], width, threshold)
        yield shared(docs.sparkSession, index)


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = 0.8, width: int = 5) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_shared, containment`` of every pair at or above the threshold.

    ``containment`` is the share of the item's distinct shingles of ``width`` words that the whole
    document has; an item of fewer words is one shingle of its length, which a document can hold
    anywhere. Items without words match nothing; rows without doc_id are left out. Repeated items
    and repeated documents each match, rows that are equal in all columns are given once. Items
    are sent in blocks of at most ``ITEM_BYTES`` (one longer item makes a longer block).
    """
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_shingles", pa.int64()), ("n_shared", pa.int64()), ("containment", pa.float64())])
    out = None
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    for sent in _indexes(docs, items, threshold, width):

        def run(batches, sent=sent):
            index = taken(sent)
            for batch in batches:
                ids, found = batch.column("doc_id"), []
                for lo, _, data, offsets in slices(*text_buffer(batch.column("text"))):
                    found += [(ids[lo + r].as_py(), index.ids[i], len(index.sets[i]), shared, shared / len(index.sets[i]))
                              for r, i, shared in index.search(data, offsets)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*found), schema)], schema=schema)

        part = docs.mapInArrow(run, "doc_id long, item_id long, n_shingles long, n_shared long, containment double")
        out = part if out is None else out.union(part)
    return out.distinct()


def without_items(docs: DataFrame, items: DataFrame, threshold: float = 0.8, width: int = 5) -> DataFrame:
    """The rows of ``docs`` that hold no item to the threshold; one pass, nothing is shuffled."""
    for sent in _indexes(docs, items, threshold, width):

        def run(batches, sent=sent):
            index = taken(sent)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for lo, _, data, offsets in slices(*text_buffer(batch.column("text"))):
                    keep[[lo + r for r, _, _ in index.search(data, offsets)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
