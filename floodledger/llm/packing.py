"""Token ids in packed rows of a fixed length: best-fit-decreasing with a segment tree.

Each task tokenizes its documents and packs them within windows of a bounded number of tokens. A
document of more tokens than a row holds is split; its full rows need no packing, its last piece is
packed like a short document. Nothing is shuffled and nothing is cut off.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Tokens that a task packs together: bounds its memory.
WINDOW = 4_000_000
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"


class Capacities:
    """Open rows by free room; a segment tree finds the smallest room that is large enough."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.tree = [False] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = self.leaves + room
        while at and not self.tree[at]:
            self.tree[at] = True
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Removes and gives (room, row) of the best fit."""
        at = self.leaves + least
        if not self.tree[at]:
            while at > 1 and (at & 1 or not self.tree[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.tree[2 * at] else 2 * at + 1
        room = at - self.leaves
        row = self.rows[room].pop()
        if not self.rows[room]:
            self.tree[at] = False
            at >>= 1
            while at and not (self.tree[2 * at] or self.tree[2 * at + 1]):
                self.tree[at] = False
                at >>= 1
        return room, row


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Rows of piece numbers: longest pieces first, each into the fullest row that has room."""
    rows: list[list[int]] = []
    open_rows = Capacities(capacity)
    for piece in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[piece])
        found = open_rows.take(need)
        if found is None:
            room, row = capacity, len(rows)
            rows.append([])
        else:
            room, row = found
        rows[row].append(piece)
        if room > need:
            open_rows.add(room - need, row)
    return rows


def encoder(vocabulary: bytes, pattern: str):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


#: From this many white-space characters in a row on, the run is taken out before the tokenizer's pattern meets it.
RUN = 100_000
#: White space as the tokenizer's pattern means it.
BLANK = "[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"


def encoded(enc, text: str) -> list[int]:
    """The ids of a text.

    The pattern tries a run of white space from its end backwards and overflows the stack on very
    long ones. It makes one piece of a run up to its last character, or of the whole run at the end of the
    text, whatever stands around it: such a piece is encoded without the pattern.
    """
    if len(text) < RUN:
        return enc.encode_ordinary(text)
    ids, at = [], 0
    for run in re.finditer(f"{BLANK}{{{RUN},}}", text):
        cut = run.end() if run.end() == len(text) else run.end() - 1
        ids += enc.encode_ordinary(text[at : run.start()])
        ids += enc._encode_single_piece(text[run.start() : cut].encode())
        at = cut
    return ids + enc.encode_ordinary(text[at:])


SCHEMA = "pack_id long, ids binary, n_tokens int, cu_seqlens array<int>, position_resets array<int>, doc_ids array<long>, doc_offsets array<long>"
ARROW = pa.schema([
    ("pack_id", pa.int64()), ("ids", pa.binary()), ("n_tokens", pa.int32()), ("cu_seqlens", pa.list_(pa.int32())),
    ("position_resets", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())), ("doc_offsets", pa.list_(pa.int64())),
])
ROWS_OUT = 512


def pack_window(docs: list[tuple[int | None, np.ndarray]], length: int, pad: int, first: int, in_order: bool = False) -> Iterator[pa.RecordBatch]:
    """``in_order``: rows go by the first of ``docs`` that they hold, not by length."""
    whole, short, places = [], [], []
    for n, (doc, ids) in enumerate(docs):
        full = len(ids) // length * length
        whole += [(n, doc, o, ids[o : o + length]) for o in range(0, full, length)]
        if full < len(ids):
            short.append((doc, full, ids[full:]))
            places.append(n)
    rows, firsts = [[p[1:]] for p in whole], [p[0] for p in whole]
    if short:
        found = best_fit_decreasing(np.array([len(p[2]) for p in short]), length)
        rows += [[short[i] for i in (sorted(row) if in_order else row)] for row in found]
        firsts += [min(places[i] for i in row) for row in found]
    if in_order:
        rows = [rows[i] for i in np.argsort(firsts, kind="stable")]
    for lo in range(0, len(rows), ROWS_OUT):
        part = rows[lo : lo + ROWS_OUT]
        matrix = np.full((len(part), length), pad, part[0][0][2].dtype)
        ends = []
        for line, row in zip(matrix, part):
            cu = np.cumsum([0] + [len(p[2]) for p in row])
            for (_, _, ids), a, b in zip(row, cu[:-1], cu[1:]):
                line[a:b] = ids
            ends.append(cu.tolist())
        yield pa.RecordBatch.from_arrays([
            pa.array(range(first + lo, first + lo + len(part)), pa.int64()),
            pa.array([line.tobytes() for line in matrix], pa.binary()),
            pa.array([cu[-1] for cu in ends], pa.int32()),
            pa.array(ends, pa.list_(pa.int32())),
            pa.array([cu[:-1] for cu in ends], pa.list_(pa.int32())),
            pa.array([[p[0] for p in row] for row in part], pa.list_(pa.int64())),
            pa.array([[p[1] for p in row] for row in part], pa.list_(pa.int64())),
        ], schema=ARROW)


def packed(docs: DataFrame, length: int = 2048, vocabulary: str = VOCABULARY, pattern: str | None = None, end: int = 50256, pad: int = 50256, stretch: str | None = None) -> DataFrame:
    """One row for each packed row of ``length`` ids.

    ``ids`` are little-endian unsigned numbers of two bytes (four if the vocabulary needs it),
    padded with ``pad`` behind ``n_tokens``. ``cu_seqlens`` are the cumulative segment lengths from
    0 to ``n_tokens``; ``position_resets`` the places where positions start again at 0;
    ``doc_ids`` names the document of each segment and ``doc_offsets`` where the segment starts
    among the document's ids, so all pieces of a document together give it back. Every document
    ends with ``end``; a null or empty text is that id alone. A null doc_id stays null; repeated
    rows are packed again. ``pack_id`` holds the number of the task's partition and a counter.
    ``stretch`` names a column of whole numbers by whose values the rows of every task stand together,
    in the order that is to be kept: then no packed row has documents of two values, and ``pack_id``
    holds the value and a counter that goes by each packed row's first document.
    The vocabulary is read on the driver and sent (some MB whatever the data).
    """
    from public_tokenizers import PATTERN as default

    pattern = pattern or default
    with open(vocabulary, "rb") as f:
        raw = f.read()
    sent = docs.sparkSession.sparkContext.broadcast((raw, pattern))

    # another pattern may split runs in other ways
    encode = encoded if pattern == default else lambda enc, text: enc.encode_ordinary(text)

    def run(batches):
        enc = encoder(*sent.value)
        kind = np.dtype("<u2") if max(enc.n_vocab, end + 1, pad + 1) <= 1 << 16 else np.dtype("<u4")
        base = TaskContext.get().partitionId() << 32
        held, tokens, rows, now = [], 0, 0, None

        def flush():
            nonlocal held, tokens, rows
            for batch in pack_window(held, length, pad, base + rows, stretch is not None):
                rows += batch.num_rows
                yield batch
            held, tokens = [], 0

        for batch in batches:
            values = batch.column(stretch).to_pylist() if stretch else [None] * batch.num_rows
            for doc, text, value in zip(batch.column("doc_id"), batch.column("text"), values):
                if value != now:
                    if held:
                        yield from flush()
                    now, base, rows = value, value << 32, 0
                ids = np.array(encode(enc, text.as_py() or "") + [end], kind)
                held.append((doc.as_py(), ids))
                tokens += len(ids)
                if tokens >= WINDOW:
                    yield from flush()
        if held:
            yield from flush()

    return docs.select("doc_id", "text", *([stretch] if stretch else [])).mapInArrow(run, SCHEMA)
