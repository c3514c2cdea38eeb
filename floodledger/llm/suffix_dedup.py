"""Repeated byte strings, by sorted runs of sampled suffixes that are merged by common prefixes.

A byte goes if a string of ``LENGTH`` bytes over it also starts in a document of smaller doc_id.
All strings of ``LENGTH`` bytes are covered, but only one suffix for a stretch of neighbouring
strings is sorted: each string picks, by smallest hash, one of its inner strings of ``GRAM`` bytes,
its anchor; equal strings pick equal anchors. So the suffixes at the anchors, with the few bytes
before them, hold all strings, and equal strings meet under a common prefix of ``GRAM`` bytes.

1. Texts equal as a whole are settled by their hash; only the first of them goes on.
2. Anchors that only one document has are found by their hashes and dropped.
3. Each task sorts its suffixes and keeps, of equal stretches, that of the smallest doc_id, as a
   front-coded run: common prefix with the one before, and the rest. A task merges the runs of a
   bucket of anchors with a loser tree that compares beyond the known common prefix only; the
   prefixes that come out bound the groups in which strings are compared.
4. The covered spans go back to their documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodledger.llm.arrays import BASE, U64, by_key, mix, runs, slices, text_buffer
from floodledger.llm.store import cut, partitions, sent

LENGTH = 50
GRAM = 24
#: Anchors of a task that are merged before they are shuffled.
CHUNK = 1_500_000
#: Suffixes that a task sorts into one run.
RUN = 60_000
#: Buckets for each shuffle partition: a task holds one bucket at a time.
BUCKETS = 4
KEY = U64((1 << 40) - 1)
NONE = np.zeros(0, np.int64)


def prime_from(n: int) -> int:
    while n < 2 or any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def stretches(data: np.ndarray, offsets: np.ndarray):
    """Of every stretch of strings with one anchor: row, first and last start, anchor, anchor's hash."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return NONE, NONE, NONE, NONE, np.zeros(0, U64)
    m = U64(0x9E3779B97F4A7C15)
    g = data.astype(U64) + U64(1)
    grown, power, size = {1: g}, m, 1
    while size < 16:
        g = g[: len(g) - size] * power + g[size:]
        power, size = U64(int(power) ** 2 % 2**64), size * 2
        grown[size] = g
    eight = U64(pow(int(m), 8, 2**64))
    tail = grown[8][16:]
    whole = mix(grown[16][: len(tail)] * eight + tail)
    wide = LENGTH - GRAM + 1
    low = (whole >> U64(32) << U64(32)) | np.arange(len(whole), dtype=U64)
    step = 1
    while step * 2 <= wide:
        low = np.minimum(low[: len(low) - step], low[step:])
        step *= 2
    rest = wide - step
    low = np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
    anchor = (low[:n] & U64(0xFFFFFFFF)).astype(np.int64)
    row = np.searchsorted(offsets, np.arange(n), side="right") - 1 if len(offsets) < 3 else np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    starts = np.flatnonzero(np.arange(n) + LENGTH <= offsets[row + 1])
    if not len(starts):
        return NONE, NONE, NONE, NONE, np.zeros(0, U64)
    a, r = anchor[starts], row[starts]
    change = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (r[1:] != r[:-1])]))
    last = np.append(change[1:], len(starts)) - 1
    # the least of many hashes lies near zero; mixed once more, anchors spread over all buckets
    return r[change], starts[change], starts[last], a[change], mix(whole[a[change]] + BASE)


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    return (((hashes >> U64(32)) * U64(n)) >> U64(32)).astype(np.int64)


def listed(docs: np.ndarray, items: np.ndarray, parts: int) -> list[tuple[int, bytes, bytes]]:
    """Items of documents, by the part that a document's text is in."""
    part = docs % parts
    order = np.argsort(part, kind="stable")
    docs, items, part = docs[order], items[order], part[order]
    return [(int(part[a]), docs[a:b].tobytes(), items[a:b].tobytes()) for a, b in zip(*runs(part))]


def anchor_rows(buckets: int, parts: int):
    """Anchors by bucket, one document for each in a task's chunk, marked if the chunk has more."""
    schema = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])

    def emit(hashes: np.ndarray, docs: np.ndarray):
        order = np.lexsort((docs, hashes))
        hashes, docs = hashes[order], docs[order]
        starts, ends = runs(hashes)
        many = docs[starts] != docs[ends - 1]
        rows = []
        inside = np.repeat(many, ends - starts)
        if inside.any():
            for i, (part, d, h) in enumerate(listed(docs[inside], hashes[inside] & KEY, parts)):
                rows.append((i % buckets, part, d, h, b""))
        first, doc = hashes[starts], docs[starts]
        cuts = np.searchsorted(bucket_of(first, buckets), np.arange(buckets + 1))
        for b in range(buckets):
            s = slice(cuts[b], cuts[b + 1])
            if cuts[b + 1] > cuts[b]:
                rows.append((b, -1, packed_key(first[s]), doc[s].tobytes(), np.packbits(many[s]).tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    def run(batches):
        held, owners, total = [], [], 0
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for lo, _, data, offsets in slices(*text_buffer(batch.column("text"))):
                row, _, _, _, hashes = stretches(data, offsets)
                held.append(hashes)
                owners.append(ids[lo + row])
                total += len(hashes)
                if total >= CHUNK:
                    yield emit(np.concatenate(held), np.concatenate(owners))
                    held, owners, total = [], [], 0
        if total:
            yield emit(np.concatenate(held), np.concatenate(owners))

    return run, "bucket int, part int, a binary, b binary, c binary"


def packed_key(hashes: np.ndarray) -> bytes:
    key = hashes & KEY
    return (key & U64(0xFFFFFFFF)).astype(np.uint32).tobytes() + (key >> U64(32)).astype(np.uint8).tobytes()


def unpacked_key(raw: bytes) -> np.ndarray:
    n = len(raw) // 5
    return np.frombuffer(raw, np.uint32, n).astype(U64) | np.frombuffer(raw, np.uint8, n, 4 * n).astype(U64) << U64(32)


LISTS = pa.schema([("part", pa.int32()), ("docs", pa.binary()), ("items", pa.binary())])


def lists_batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), LISTS)], schema=LISTS)


def repeated_rows(parts: int):
    """The anchors that more documents than one have, by document."""

    def run(batches):
        for _, table in by_key(batches, "bucket"):
            keys, docs, marks = [], [], []
            for row in table.to_pylist():
                if row["part"] >= 0:
                    yield lists_batch([(row["part"], row["a"], row["b"])])
                else:
                    keys.append(unpacked_key(row["a"]))
                    docs.append(np.frombuffer(row["b"], np.int64))
                    marks.append(np.unpackbits(np.frombuffer(row["c"], np.uint8), count=len(docs[-1])).astype(bool))
            if not keys:
                continue
            key, doc, mark = np.concatenate(keys), np.concatenate(docs), np.concatenate(marks)
            order = np.lexsort((doc, key))
            key, doc, mark = key[order], doc[order], mark[order]
            starts, ends = runs(key)
            many = doc[starts] != doc[ends - 1]
            many |= np.add.reduceat(mark, starts) > 0
            keep = np.repeat(many, ends - starts) & ~mark  # marked ones are on their way already
            if keep.any() and (rows := listed(doc[keep], key[keep], parts)):
                yield lists_batch(rows)

    return run


def with_lists(texts: DataFrame, lists: DataFrame, parts: int, fn, schema: str) -> DataFrame:
    """``fn(items by doc_id, batches of texts)`` for every part: texts and lists of one part meet."""
    rows = lists.select("part", F.lit(0).alias("kind"), "docs", "items", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    body = texts.select(F.expr(f"cast(pmod(doc_id, {parts}) AS int)").alias("part"), F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("docs"), F.lit(None).cast("binary").alias("items"), "doc_id", "text")

    def run(batches):
        for _, groups in parted(batches):
            yield from fn(groups)

    return rows.union(body).repartition(parts, "part").sortWithinPartitions("part", "kind").mapInArrow(run, schema)


def parted(batches):
    """``(part, iterator of batches)`` of a sorted partition; each part is read to its end first."""
    state = {"next": None}
    source = iter(batches)

    def pull():
        while state["next"] is None:
            batch = next(source, None)
            if batch is None:
                return False
            if batch.num_rows:
                state["next"] = batch
        return True

    while pull():
        part = state["next"].column("part")[0].as_py()

        def group(part=part):
            while pull():
                batch = state["next"]
                same = np.asarray(batch.column("part").to_numpy(zero_copy_only=False)) == part
                n = int(same.sum())
                if n == 0:
                    return
                state["next"] = batch.slice(n) if n < batch.num_rows else None
                yield batch.slice(0, n)
                if n < batch.num_rows:
                    return

        it = group()
        yield part, it
        for _ in it:
            pass


def read_part(groups) -> Iterator:
    """First the sorted items of the part by document, then batches of texts."""
    docs, items, ready = [], [], False
    for batch in groups:
        kind = batch.column("kind").to_numpy(zero_copy_only=False)
        n = int((kind == 0).sum())
        for d, i in zip(batch.column("docs").slice(0, n), batch.column("items").slice(0, n)):
            docs.append(np.frombuffer(d.as_py(), np.int64))
            items.append(np.frombuffer(i.as_py(), U64))
        if n < batch.num_rows:
            if not ready:
                doc = np.concatenate(docs) if docs else NONE
                item = np.concatenate(items) if items else np.zeros(0, U64)
                order = np.lexsort((item, doc))
                yield doc[order], item[order]
                ready = True
            yield batch.slice(n)


def record_rows(buckets: int, parts: int):
    """Front-coded runs of the suffixes at repeated anchors; spans that a task can settle itself."""
    schema = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("n", pa.int32()),
                        ("lcp", pa.binary()), ("size", pa.binary()), ("rest", pa.binary()), ("before", pa.binary())])
    wide = 2 * LENGTH - GRAM

    def emit(before, nb, body, nk, bucket, doc, first, last):
        """before, body: fixed width bytes up to and from the anchor, and their lengths."""
        order = np.lexsort((first, doc))
        full = np.concatenate([body, before, nk[:, None].astype(np.uint8), nb[:, None].astype(np.uint8)], axis=1)
        full, bucket, doc, first, last = full[order], bucket[order], doc[order], first[order], last[order]
        view = np.ascontiguousarray(full).view(np.dtype((np.void, full.shape[1]))).ravel()
        rank = np.argsort(view, kind="stable")  # equal stretches stay sorted by doc_id
        full, bucket, doc, first, last = full[rank], bucket[rank], doc[rank], first[rank], last[rank]
        same = np.zeros(len(full), bool)
        same[1:] = (full[1:] == full[:-1]).all(axis=1)
        group = np.cumsum(~same) - 1
        least = doc[~same][group]
        settled = doc != least
        rows = []
        if settled.any():
            span = first[settled].astype(U64) << U64(32) | (last[settled] + LENGTH).astype(U64)
            rows += [(i % buckets, p, d, s, 0, b"", b"", b"", b"") for i, (p, d, s) in enumerate(listed(doc[settled], span, parts))]
        keep = ~settled  # a document's own repeats each ask for their spans
        full, bucket, doc, first = full[keep], bucket[keep], doc[keep], first[keep]
        nk, nb = full[:, -2].astype(np.int64), full[:, -1].astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        for lo, hi in zip(*runs(bucket[order])):
            pick = order[lo:hi]
            body, k = full[pick, :wide], nk[pick]
            lcp = np.zeros(len(pick), np.int64)
            if len(pick) > 1:
                diff = body[1:] != body[:-1]
                lcp[1:] = np.where(diff.any(axis=1), diff.argmax(axis=1), wide)
                lcp[1:] = np.minimum(lcp[1:], np.minimum(k[1:], k[:-1]))
            column = np.arange(wide)
            rest = body[(column >= lcp[:, None]) & (column < k[:, None])]
            left = full[pick, wide:-2]
            held = left[np.arange(left.shape[1]) < nb[pick][:, None]]
            rows.append((int(bucket[pick[0]]), -1, doc[pick].tobytes(), first[pick].astype(np.uint32).tobytes(), len(pick), lcp.astype(np.uint8).tobytes(),
                         k.astype(np.uint8).tobytes() + nb[pick].astype(np.uint8).tobytes(), rest.tobytes(), held.tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    def fn(groups):
        source = read_part(groups)
        lists = next(source, None)
        if lists is None:
            return
        docs, items = lists
        held, total = [], 0
        for batch in source:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi, data, offsets in slices(*text_buffer(batch.column("text"))):
                row, p1, p2, a, hashes = stretches(data, offsets)
                if not len(row):
                    continue
                owner = ids[lo + row]
                wanted = known(docs, items, owner, hashes & KEY)
                row, p1, p2, a, hashes, owner = (x[wanted] for x in (row, p1, p2, a, hashes, owner))
                if not len(row):
                    continue
                padded = np.concatenate([data, np.zeros(wide, np.uint8)])
                nk, nb = p2 + LENGTH - a, a - p1
                body = padded[a[:, None] + np.arange(wide)]
                body[np.arange(wide) >= nk[:, None]] = 0
                head = padded[p1[:, None] + np.arange(LENGTH - GRAM)]
                head[np.arange(LENGTH - GRAM) >= nb[:, None]] = 0
                held.append((head, nb, body, nk, bucket_of(hashes, buckets), owner, p1 - offsets[row], p2 - offsets[row]))
                total += len(row)
                if total >= RUN:
                    yield flush(held)
                    held, total = [], 0
        if held:
            yield flush(held)

    def flush(held):
        return emit(*(np.concatenate(x) for x in zip(*held)))

    return fn, "bucket int, part int, a binary, b binary, n int, lcp binary, size binary, rest binary, before binary"


def known(docs: np.ndarray, items: np.ndarray, owner: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which pairs of document and item are listed."""
    out = np.zeros(len(owner), bool)
    for lo, hi in zip(*runs(owner)):
        a, b = np.searchsorted(docs, owner[lo]), np.searchsorted(docs, owner[lo], side="right")
        out[lo:hi] = np.isin(key[lo:hi], items[a:b])
    return out


class Run:
    """A front-coded run, read from its start: the present suffix and its prefix in common with the one before."""

    def __init__(self, row: dict):
        self.n, self.at, self.text, self.off, self.back = row["n"], -1, b"", 0, 0
        self.lcps, self.rest, self.before = row["lcp"], row["rest"], row["before"]
        self.sizes, self.backs = row["size"][: self.n], row["size"][self.n :]
        self.docs = np.frombuffer(row["a"], np.int64).tolist()
        self.firsts = np.frombuffer(row["b"], np.uint32).tolist()
        self.lcp, self.left = 0, b""

    def step(self) -> bool:
        self.at += 1
        if self.at >= self.n:
            return False
        self.lcp = self.lcps[self.at]
        more = self.sizes[self.at] - self.lcp
        self.text = self.text[: self.lcp] + self.rest[self.off : self.off + more]
        self.off += more
        size = self.backs[self.at]
        self.left = self.before[self.back : self.back + size]
        self.back += size
        return True


def common(a: bytes, b: bytes, known_prefix: int) -> int:
    n = min(len(a), len(b))
    i = known_prefix
    while i < n and a[i : i + 8] == b[i : i + 8]:
        i += 8
    i = min(i, n)
    while i < n and a[i] == b[i]:
        i += 1
    return i


def merged(sources: list[Run]) -> Iterator[tuple[int, Run]]:
    """The suffixes of all runs in order, each with its prefix in common with the one before.

    A tree of losers: every inner node keeps the loser of its match and the loser's common prefix
    with the winner that passed. Of two suffixes with different prefixes in common with the last
    winner the longer one is smaller; with equal ones the comparison starts behind that prefix.
    """
    live = [s for s in sources if s.step()]
    if not live:
        return
    size = 1
    while size < len(live):
        size *= 2
    lcp = [0] * len(live)

    def match(a: int, b: int) -> tuple[int, int]:
        if a < 0 or b < 0:
            return max(a, b), min(a, b)
        if lcp[a] != lcp[b]:
            return (a, b) if lcp[a] > lcp[b] else (b, a)
        x, y = live[a].text, live[b].text
        n = common(x, y, lcp[a])
        if x[n : n + 1] <= y[n : n + 1]:
            lcp[b] = n
            return a, b
        lcp[a] = n
        return b, a

    losers = [-1] * size

    def build(node: int) -> int:
        if node >= size:
            return node - size if node - size < len(live) else -1
        winner, losers[node] = match(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1)
    while winner >= 0:
        source = live[winner]
        yield lcp[winner], source
        path = (winner + size) >> 1
        if source.step():
            lcp[winner] = source.lcp
            now = winner
        else:
            now = -1
        while path:
            now, losers[path] = match(now, losers[path])
            path >>= 1
        winner = now


def covered(group: list[tuple[bytes, bytes, int, int]]) -> Iterator[tuple[int, int, int]]:
    """``(doc, from, to)`` of the strings of a group that also start in a smaller doc_id."""
    whole: dict[tuple[bytes, bytes], int] = {}
    for left, text, doc, _ in group:
        if whole.get((left, text), doc) >= doc:
            whole[left, text] = doc
    if len(whole) == 1:
        least = next(iter(whole.values()))
        for left, text, doc, first in group:
            if doc > least:
                yield doc, first, first + len(left) + len(text)
        return
    strings: dict[bytes, int] = {}
    for (left, text), doc in whole.items():
        line = left + text
        for i in range(len(line) - LENGTH + 1):
            s = line[i : i + LENGTH]
            if strings.get(s, doc) >= doc:
                strings[s] = doc
    for left, text, doc, first in group:
        line, begin = left + text, -1
        for i in range(len(line) - LENGTH + 2):
            hit = i <= len(line) - LENGTH and strings[line[i : i + LENGTH]] < doc
            if hit and begin < 0:
                begin = i
            elif not hit and begin >= 0:
                yield doc, first + begin, first + i - 1 + LENGTH
                begin = -1


def span_rows(parts: int):
    def run(batches):
        for _, table in by_key(batches, "bucket"):
            sources = []
            for row in table.to_pylist():
                if row["part"] >= 0:
                    yield lists_batch([(row["part"], row["a"], row["b"])])
                else:
                    sources.append(Run(row))
            out: list[tuple[int, int, int]] = []
            group: list[tuple[bytes, bytes, int, int]] = []
            for lcp, s in merged(sources):
                if lcp < GRAM:
                    if len(group) > 1:
                        out += covered(group)
                    group = []
                group.append((s.left, s.text, s.docs[s.at], s.firsts[s.at]))
            if len(group) > 1:
                out += covered(group)
            if out:
                doc, a, b = (np.array(x, np.int64) for x in zip(*out))
                yield lists_batch(listed(doc, a.astype(U64) << U64(32) | b.astype(U64), parts))

    return run


def cut_rows(groups):
    """The rest of every text without its covered spans."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])
    source = read_part(groups)
    lists = next(source, None)
    if lists is None:
        return
    docs, items = lists
    for batch in source:
        rows = []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            raw = (text.as_py() or "").encode()
            a, b = np.searchsorted(docs, doc), np.searchsorted(docs, doc, side="right")
            rest, n, at, removed = [], 0, 0, 0
            end = -1
            for span in items[a:b].tolist():
                lo, hi = span >> 32, min(span & 0xFFFFFFFF, len(raw))
                if lo > end:
                    rest.append(raw[max(end, 0) : lo])
                    n += 1
                    end = hi
                    removed += hi - lo
                elif hi > end:
                    removed += hi - end
                    end = hi
            rest.append(raw[max(end, 0) :])
            kept = b"".join(rest)
            rows.append((doc, len(raw), removed, n, hashlib.sha256(kept).hexdigest(), kept))
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)


def without_repeats(docs: DataFrame, keep_bytes: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and ``kept`` (bytes) of every row with a doc_id.

    A null text is empty. A text under ``LENGTH`` bytes stays whole. Equal texts of one doc_id are
    the same document given again; different texts of one doc_id are judged as one document's: its
    own strings never remove its bytes, and each span found in one of the texts would be looked for
    at the same place of the other, so doc_ids should be unique. ``kept`` may end within a character.
    """
    n = partitions(docs)
    parts, buckets = prime_from(n), BUCKETS * n
    docs = docs.where("doc_id IS NOT NULL").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    named = cut(docs.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha"), F.octet_length("text").cast("long").alias("n_bytes")), "texts")
    least = named.groupBy("sha").agg(F.min("doc_id").alias("least"))
    named = cut(named.join(least, "sha").withColumn("copy", F.col("doc_id") > F.col("least")), "copies")
    gone = cut(named.where(f"copy OR n_bytes < {LENGTH}").select("doc_id").distinct(), "gone")
    first = docs.join(sent(gone), "doc_id", "left_anti")

    run, schema = anchor_rows(buckets, parts)
    lists = "part int, docs binary, items binary"
    repeated = first.mapInArrow(run, schema).repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(repeated_rows(parts), lists)
    repeated = cut(repeated, "anchors")
    fn, schema = record_rows(buckets, parts)
    records = with_lists(named_in(first, repeated), repeated, parts, fn, schema)
    spans = cut(records.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(span_rows(parts), lists), "spans")
    columns = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    owners = named_ids(spans)
    changed = with_lists(first.join(sent(owners), "doc_id", "left_semi"), spans, parts, cut_rows, columns)
    if not keep_bytes:
        changed = changed.drop("kept")
    rest = named.join(sent(owners), "doc_id", "left_anti")
    whole = F.expr(f"copy AND n_bytes >= {LENGTH}")
    rest = rest.select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(0).alias("n_removed"), F.when(whole, F.lit(1)).otherwise(0).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("sha")).alias("kept_sha256"))
    if keep_bytes:
        texts = docs.join(sent(owners), "doc_id", "left_anti").select("doc_id", F.col("text").cast("binary").alias("kept"))
        rest = rest.join(texts.dropDuplicates(["doc_id"]), "doc_id").withColumn("kept", F.when(F.col("n_removed") > 0, F.lit(b"")).otherwise(F.col("kept")))
    return changed.unionByName(rest)


def named_ids(lists: DataFrame) -> DataFrame:
    """The doc_ids of packed lists."""

    def run(batches):
        for batch in batches:
            for raw in batch.column("docs"):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.frombuffer(raw.as_py(), np.int64)))], names=["doc_id"])

    return cut(lists.select("docs").mapInArrow(run, "doc_id long").distinct(), "owners")


def named_in(docs: DataFrame, lists: DataFrame) -> DataFrame:
    return docs.join(sent(named_ids(lists)), "doc_id", "left_semi")
