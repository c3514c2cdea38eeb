"""Language identification by words first, with back-off to shorter and shorter character n-grams.

A known word scores by its log frequency in each language. An unseen word is spelled out: at every
place the longest known n-gram (five letters down to one) gives its log frequency, and their mean
takes the place of the word's. Frequencies come from a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodledger.llm.arrays import BASE, U64, mix, powers, slices, text_buffer
from floodledger.llm.quality import held_out
from floodledger.llm.store import cut, shared, taken

#: Labelled documents of each language that the frequencies are taken from.
SAMPLE = 400
LONGEST = 5
#: Words that occur less often in the sample are treated as unseen.
LEAST = 2
LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True


def letter_words(data: np.ndarray, offsets: np.ndarray):
    """Start, end and row of every run of letters (every byte beyond ASCII counts as one)."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    solid = LETTERS[data]
    start, stop = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1] | edge[1:n]
    stop[:-1] &= ~solid[1:] | edge[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each non-empty byte range."""
    if not len(starts):
        return np.zeros(0, U64)
    size = ends - starts
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    value = (data[np.repeat(starts, size) + place].astype(U64) + U64(1)) * powers(int(size.max()))[place]
    return mix(np.add.reduceat(value, first) + size.astype(U64) * BASE)


def lowered(column) -> tuple[np.ndarray, np.ndarray]:
    import pyarrow.compute as pc

    return text_buffer(pc.utf8_lower(column))


def gram_places(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int):
    """Start, end and word number of all n-grams of ``width`` letters, words padded by their ends."""
    head = (data & 0xC0) != 0x80  # first bytes of letters
    order = np.concatenate([[0], np.cumsum(head)])
    place = np.append(np.flatnonzero(head), len(data))
    a, b = order[starts], order[ends]
    count = np.maximum(b - a - width + 1, 0)
    word = np.repeat(np.arange(len(starts)), count)
    at = a[word] + np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count)
    return place[at], np.minimum(place[np.minimum(at + width, len(place) - 1)], ends[word]), word


class Table:
    """Log frequencies per language of hashed keys; unknown keys are at the last line."""

    def __init__(self, counts: dict[str, Counter], langs: list[str], least: int):
        keys = sorted({k for c in counts.values() for k, n in c.items() if n >= least})
        self.keys = np.array(keys, U64)
        raw = np.array([[counts[g][k] for g in langs] for k in keys], np.float64).reshape(len(keys), len(langs))
        size = raw.sum(axis=0, keepdims=True) + 1
        self.logs = np.log((raw + 0.1) / (size + 0.1 * (len(keys) + 1))).astype(np.float32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Line of each hash, -1 if unknown."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, -1)


class Model:
    def __init__(self, texts: list[tuple[str, str]]):
        self.langs = sorted({g for g, _ in texts})
        word = {g: Counter() for g in self.langs}
        gram = [{g: Counter() for g in self.langs} for _ in range(LONGEST)]
        for g in self.langs:
            raw = [t.lower().encode() for lang, t in texts if lang == g]
            for t in raw:
                data = np.frombuffer(t, np.uint8)
                starts, ends, _ = letter_words(data, np.array([0, len(data)]))
                word[g].update(hashed(data, starts, ends).tolist())
                for n in range(1, LONGEST + 1):
                    a, b, _ = gram_places(data, starts, ends, n)
                    gram[n - 1][g].update(hashed(data, a, b).tolist())
        self.words = Table(word, self.langs, LEAST)
        self.grams = [Table(c, self.langs, LEAST) for c in gram]

    def spelled(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Scores of unseen words: the mean over their letters of the longest known n-gram from there."""
        total = np.zeros((len(starts), len(self.langs)))
        count = np.zeros(len(starts))
        done = np.zeros(len(data) + 1, bool)
        for n in range(LONGEST, 0, -1):
            a, b, word = gram_places(data, starts, ends, n)
            todo = ~done[a]
            a, b, word = a[todo], b[todo], word[todo]
            line = self.grams[n - 1].find(hashed(data, a, b))
            hit = line >= 0
            done[a[hit]] = True
            for i in range(len(self.langs)):
                total[:, i] += np.bincount(word[hit], self.grams[n - 1].logs[line[hit], i], minlength=len(starts))
            count += np.bincount(word[hit], minlength=len(starts))
        return total / np.maximum(count, 1)[:, None]

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score and number of letter runs of each row."""
        n = len(offsets) - 1
        starts, ends, rows = letter_words(data, offsets)
        if not len(starts):
            return np.zeros(n, np.int64), np.zeros(n), np.zeros(n, np.int64)
        hashes = hashed(data, starts, ends)
        _, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        line = self.words.find(hashes[first])
        score = np.zeros((len(first), len(self.langs)))
        score[line >= 0] = self.words.logs[line[line >= 0]]
        new = line < 0
        if new.any():
            score[new] = self.spelled(data, starts[first[new]], ends[first[new]])
        score -= score.max(axis=1, keepdims=True)
        total = np.stack([np.bincount(rows, score[back, i], minlength=n) for i in range(len(self.langs))], axis=1)
        count = np.bincount(rows, minlength=n)
        # the scores of a text's words are not independent: a power of the product tells more
        p = np.exp((total - total.max(axis=1, keepdims=True)) / np.sqrt(np.maximum(count, 1))[:, None])
        p /= p.sum(axis=1, keepdims=True)
        best = total.argmax(axis=1)
        return best, p[np.arange(n), best], count


def fit(docs: DataFrame) -> Model:
    """Counts ``SAMPLE`` whole documents of each language, the first by hash of doc_id."""
    from pyspark.sql import Window as W

    known = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").where(~held_out())
    ids = known.select("doc_id", "lang", F.row_number().over(W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")).alias("r"))
    ids = cut(ids.where(F.col("r") <= SAMPLE).select("doc_id", "lang").distinct(), "sample")
    rows = known.select("doc_id", "lang", "text").join(F.broadcast(ids), ["doc_id", "lang"]).collect()
    return Model(sorted((r["lang"], r["text"]) for r in rows))


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row with a doc_id.

    ``lang_pred`` is ``und``, with score 0, for a null text, a text without letters, or where no
    row has a language to learn from; ties go to the language that sorts first. ``score`` is the
    chosen language's share of the evidence. Rows are learned from if they have a language and are
    not held out. Repeated rows are identified each.
    """
    sent = shared(docs.sparkSession, fit(docs))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches):
        model = taken(sent)
        for batch in batches:
            texts = batch.column("text")
            for lo, hi, data, offsets in slices(*lowered(texts)):
                if model.langs:
                    best, score, count = model.predict(data, offsets)
                    names = [model.langs[i] for i in best]
                else:
                    score, count, names = np.zeros(hi - lo), np.zeros(hi - lo), ["und"] * (hi - lo)
                plain = np.zeros(hi - lo, np.int64)
                if len(data):
                    owner = np.repeat(np.arange(hi - lo), np.diff(offsets))
                    plain = np.bincount(owner[LETTERS[data] & (data < 128)], minlength=hi - lo)
                for i in np.flatnonzero(plain == 0):
                    if not count[i] or not any(map(str.isalpha, texts[lo + int(i)].as_py() or "")):
                        names[i], score[i] = "und", 0.0
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), batch.column("held_out").slice(lo, hi - lo), pa.array(names, pa.string()), pa.array(score.astype(np.float64))], schema=schema)

    rows = docs.where("doc_id IS NOT NULL").select("doc_id", "text", held_out().alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
