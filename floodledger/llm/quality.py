"""Quality classifier on supervised subword embeddings.

A text is the average of learned vectors: of its words, of its pairs of neighbouring words and of
its runs of three and four bytes, all hashed into one table. A softmax over the average gives the
classes. Vectors and softmax are trained by stochastic gradient descent in numpy, on a bounded
sample of labelled documents. As the average is linear, scoring needs one number per table entry:
the product of its vector with the difference of the two class vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodledger.llm.arrays import U64, mix, slices, text_buffer, words
from floodledger.llm.store import cut

#: Labelled documents of each class that the model is fitted on.
SAMPLE = 900
BITS = 17
DIMENSIONS = 12
EPOCHS = 12
RATE = 0.6
SEED = 17
THRESHOLD = 0.7
#: Table entries of the word pair "same word again", of "word of two before" and of the end of text.
AGAIN, BEFORE, END = 0, 1, 2


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table entries of all features of all rows, and the rows' offsets among them."""
    n = len(offsets) - 1
    hashes, rows, _, _ = words(data, offsets, lower=False)
    shift = U64(64 - BITS)
    word = (mix(hashes) >> shift).astype(np.int32)
    pair = (mix(hashes[1:] * U64(3) + hashes[:-1]) >> shift).astype(np.int32)
    pair[hashes[1:] == hashes[:-1]] = AGAIN
    inside = rows[1:] == rows[:-1]
    back = (hashes[2:] == hashes[:-2]) & (rows[2:] == rows[:-2])
    parts = [(word, rows), (pair[inside], rows[1:][inside]), (np.full(int(back.sum()), BEFORE, np.int32), rows[2:][back])]
    owner = np.repeat(np.arange(n, dtype=np.int32), np.diff(offsets))
    wide = data.astype(np.uint32)
    for width in (3, 4):
        m = len(data) - width + 1
        if m > 0:
            code = wide[:m].copy()
            for j in range(1, width):
                code |= wide[j : j + m] << np.uint32(8 * j)
            same = owner[:m] == owner[width - 1 :]
            code = (code + np.uint32(width * 0x1F3D5B79)) * np.uint32(0x9E3779B1)
            code ^= code >> np.uint32(15)
            code *= np.uint32(0x85EBCA77)
            parts.append(((code >> np.uint32(32 - BITS)).astype(np.int32)[same], owner[:m][same]))
    parts.append((np.full(n, END, np.int32), np.arange(n)))
    size = np.zeros(n, np.int64)
    for _, o in parts:
        size += np.bincount(o, minlength=n)
    out = np.zeros(n + 1, np.int64)
    np.cumsum(size, out=out[1:])
    entries = np.empty(out[-1], np.int32)
    at = out[:-1].copy()
    for e, o in parts:
        count = np.bincount(o, minlength=n)
        first = np.cumsum(count) - count
        entries[np.arange(len(e)) + np.repeat(at - first, count)] = e
        at += count
    return entries, out


def train(texts: list[str], labels: list[int]) -> tuple[np.ndarray, float]:
    """The number of each table entry and the constant of the log odds of label 1."""
    target = np.array(labels)
    share = target.mean() if len(target) else 1.0
    if len(set(labels)) < 2:
        return np.zeros(1 << BITS, np.float32), 40.0 if share >= 0.5 else -40.0
    rng = np.random.default_rng(SEED)
    rows = []
    for text in texts:
        raw = np.frombuffer(text.encode(), np.uint8)
        entries, _ = features(raw, np.array([0, len(raw)]))
        rows.append(np.unique(entries, return_counts=True))
    table = rng.uniform(-1, 1, (1 << BITS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    top, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    weight = len(target) / (2 * np.bincount(target, minlength=2))
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(len(rows)):
            entries, count = rows[i]
            count = count.astype(np.float32) / count.sum()
            mean = count @ table[entries]
            z = mean @ top + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[target[i]] -= 1
            p *= weight[target[i]]
            back = top @ p
            top -= rate * np.outer(mean, p)
            bias -= rate * p * 0.1
            # a rare entry moves as far as a common one would in its place: vectors see the whole step
            table[entries] -= rate * np.outer(count * len(entries) ** 0.5, back)
    return table @ (top[:, 1] - top[:, 0]), float(bias[1] - bias[0])


def held_out(doc_id: str = "doc_id"):
    return F.expr(f"crc32(cast({doc_id} AS string)) % 4 = 2")


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Trains on at most ``SAMPLE`` whole documents of each class, the first by hash of doc_id."""
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").where(~held_out())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    order = F.xxhash64("doc_id")
    chosen = None
    for q in (0, 1):
        part = known.where(F.col("quality") == q).orderBy(order, "doc_id").limit(SAMPLE)
        chosen = part if chosen is None else chosen.union(part)
    chosen = cut(chosen, "sample")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return train([r["text"] or "" for r in rows], [r["quality"] for r in rows])


def score_rows(sent):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])

    def run(batches):
        table, constant = sent.value
        for batch in batches:
            for lo, hi, data, offsets in slices(*text_buffer(batch.column("text"))):
                entries, bounds = features(data, offsets)
                total = np.add.reduceat(table[entries].astype(np.float64), bounds[:-1])
                z = np.clip(total / np.diff(bounds) + constant, -40, 40)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), batch.column("held_out").slice(lo, hi - lo), pa.array(1 / (1 + np.exp(-z)))], schema=schema)

    return run


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, scored_docs: DataFrame | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row with a doc_id.

    ``score`` is the probability of label 1, ``predicted`` whether it reaches ``threshold``. A null
    or empty text has the feature "end of text" only and is scored like any other. Labels are read
    from rows that are not held out; a document with two labels counts with the lower, other
    values than 0 and 1 are no labels. With labels of one class only, the score is near 1 or 0
    accordingly, and near 1 without labels. Repeated rows are scored each.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    rows = docs if scored_docs is None else scored_docs
    rows = rows.where("doc_id IS NOT NULL").select("doc_id", "text", held_out().alias("held_out"))
    out = rows.mapInArrow(score_rows(sent), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, in one pass over them."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches):
        table, constant = sent.value
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for lo, hi, data, offsets in slices(*text_buffer(batch.column("text"))):
                entries, bounds = features(data, offsets)
                total = np.add.reduceat(table[entries].astype(np.float64), bounds[:-1])
                z = np.clip(total / np.diff(bounds) + constant, -40, 40)
                keep[lo:hi] = 1 / (1 + np.exp(-z)) >= threshold
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
