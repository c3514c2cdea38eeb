"""Texts rearranged for fill-in-the-middle training, and put back.

Cuts are chosen in units (lines or characters) and made in bytes. Between the two a text keeps a
sparse index: the places of its characters of more than one byte and the bytes that they take
beyond one. A cut is found among these by binary search; what lies between them is arithmetic,
and a text of ASCII alone has no index at all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodledger.llm.arrays import slices, text_buffer

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "7"
#: Of a hundred documents: those rearranged, and of these those with the suffix first.
RATE, SUFFIX_FIRST = 100, 50
NEWLINE = 10


class Exceptions:
    """The characters of more than one byte: their bytes' places, and the excess before each and in all."""

    def __init__(self, data: np.ndarray):
        # one byte of each such character leads, the others follow it
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        extra = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate([[0], np.cumsum(extra)])
        self.chars = self.at - self.excess[:-1]

    def to_chars(self, cuts):
        """Characters before each byte place that is a character's start."""
        return cuts - self.excess[np.searchsorted(self.at, cuts)]

    def to_bytes(self, cuts):
        """Byte place of each character number."""
        return cuts + self.excess[np.searchsorted(self.chars, cuts)]


def line_ends(data: np.ndarray) -> np.ndarray:
    """Byte places where lines end; a last line without line end ends with the text."""
    ends = np.flatnonzero(data == NEWLINE) + 1
    return np.append(ends, len(data)) if len(data) and (not len(ends) or ends[-1] < len(data)) else ends


def cut_points(data: np.ndarray, h1: int, h2: int, unit: str) -> tuple[int, tuple[int, int], tuple[int, int]]:
    """Number of units, the two cuts in bytes and in characters."""
    index = Exceptions(data)
    if unit == "lines":
        ends = line_ends(data)
        n = len(ends)
        units = np.sort([h1 % (n + 1), h2 % (n + 1)])
        places = np.concatenate([[0], ends])[units]
        chars = index.to_chars(places)
    else:
        n = int(len(data) - index.excess[-1])
        chars = np.sort([h1 % (n + 1), h2 % (n + 1)])
        places = index.to_bytes(chars)
    return n, tuple(places.tolist()), tuple(chars.tolist())


SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.large_string())])


def rearranged(data: np.ndarray, h: tuple[int, int, int, int], unit: str, rate: int, suffix_first: int):
    """Unit count, form, characters of prefix and middle, output bytes of one text."""
    text = data.tobytes()
    n, (a, b), (p, m) = cut_points(data, h[0], h[1], unit)
    mark, suffix, middle = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    if not text or mark in text or suffix in text or middle in text or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < suffix_first:
        return n, "spm", p, m - p, b"".join((suffix, text[b:], mark, text[:a], middle, text[a:b]))
    return n, "psm", p, m - p, b"".join((mark, text[:a], suffix, text[b:], middle, text[a:b]))


def fill_in_middle(docs: DataFrame, unit: str = "lines", rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: str = SEED) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row with a doc_id.

    ``n`` counts the text's units (``lines`` with their line ends, or ``chars``). Two cuts between units,
    the order of the parts and whether the text is rearranged follow from a hash of ``seed`` and
    doc_id alone, so a task that runs again gives the same rows. ``form`` is psm, spm or plain;
    plain are empty and null texts, those that hold one of the three marks, and those that ``rate`` leaves out.
    Character counts are null then. Repeated rows are rearranged each, alike if their ids are.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    group = lambda i: F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")
    rows = docs.where("doc_id IS NOT NULL").select("doc_id", "text", *(group(i).alias(f"h{i + 1}") for i in range(4)))

    def run(batches):
        for batch in batches:
            h = np.stack([batch.column(f"h{i + 1}").to_numpy(zero_copy_only=False) for i in range(4)], axis=1) if batch.num_rows else None
            for lo, hi, data, offsets in slices(*text_buffer(batch.column("text"))):
                out = [
                    rearranged(data[offsets[i] : offsets[i + 1]], tuple(h[lo + i].tolist()), unit, rate, suffix_first) for i in range(hi - lo)]
                n, form, p, m, texts = zip(*out)
                ends = np.cumsum([0] + [len(t) for t in texts])
                joined = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(b"".join(texts)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(p, pa.int64()), pa.array(m, pa.int64()), joined], schema=ARROW)

    return rows.mapInArrow(run, SCHEMA)


def restored(rearranged_docs: DataFrame) -> DataFrame:
    """The rows with a column ``restored``: the text that ``output`` and ``form`` give back.

    Of rearranged texts none holds a mark, and no mark can overlap another, so the first one of each kind is
    where the parts meet.
    """
    def parts(first: str, second: str, third: str):
        body = F.substring("output", len(first) + 1, 1 << 30)
        one = F.substring_index(body, second, 1)
        rest = F.substring(body, F.length(one) + F.lit(len(second) + 1), F.lit(1 << 30))
        two = F.substring_index(rest, third, 1)
        return one, two, F.substring(rest, F.length(two) + F.lit(len(third) + 1), F.lit(1 << 30))

    prefix, suffix, middle = parts(PREFIX, SUFFIX, MIDDLE)
    suffix2, prefix2, middle2 = parts(SUFFIX, PREFIX, MIDDLE)
    back = F.when(F.col("form") == "psm", F.concat(prefix, middle, suffix)).when(F.col("form") == "spm", F.concat(prefix2, middle2, suffix2))
    return rearranged_docs.withColumn("restored", F.coalesce(back, "output"))
