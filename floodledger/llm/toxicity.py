"""Toxicity by gradient-boosted trees over a few dense features of a text.

The features: densities of the words and of the word stems of a lexicon, plain and after undoing
digits and signs in place of letters, second-person words and how often a listed word stands near
one, capitals, punctuation, obfuscated words. The lexicon is learned: words and stems that are far
more usual in the toxic documents of a bounded labelled sample. Each document of the sample gets its
features from a lexicon learned without it, and its raw score from trees grown without it; an
isotonic fit turns raw scores into probabilities at the share of toxic documents that the labels have.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodledger.llm.arrays import slices, text_buffer, words
from floodledger.llm.language import hashed, letter_words, lowered
from floodledger.llm.quality import held_out
from floodledger.llm.store import cut

#: Labelled documents that the model is fitted on, of either class.
SAMPLE = {1: 1200, 0: 3000}
FOLDS = 3
THRESHOLD = 0.3
#: Letters of the stems, which are beginnings of longer words.
STEMS = range(4, 9)
#: An entry of the lexicon is in at least so many and such a share of the toxic documents, so many
#: times as dense in them, and so many standard deviations more frequent than in the others.
SUPPORT, SHARE, TIMES, DEVIATIONS = 3, 0.004, 4.0, 4.0
#: From this ratio of densities on an entry is a strong one.
STRONG = 20.0
#: A listed word is near a second-person word within this many words.
NEAR = 5
#: Second-person words of the languages of the corpus.
SECOND_PERSON = (
    "you your yours yourself yourselves u ur du dich dir dein deine deinen deiner euch euer eure ihr "
    "tu te toi ton ta tes vous votre vos usted ustedes ti tus vosotros vosotras vuestra vuestro").split()
#: Signs that stand for letters.
FOLDED = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "+": "t"}
TREES, DEPTH, RATE, BINS, LEAF, RIDGE = 100, 3, 0.15, 32, 4, 1.0
FEATURES = (
    "words", "listed", "listed_strong", "listed_weight", "listed_most", "listed_count", "stems", "stems_strong", "stems_weight", "stems_most",
    "stems_count", "either", "either_strong", "either_weight", "either_most", "either_count", "hidden", "second_person", "near_second_person", "capitals", "capital_words", "exclamations", "questions", "other_signs",
    "digits", "obfuscated")

FOLD = np.zeros(256, np.uint8)
FOLD[97:123] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)
for sign, letter in FOLDED.items():
    FOLD[ord(sign)] = ord(letter)
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
INSIDE = np.zeros(256, bool)  # signs and digits that hide letters; not hyphen and apostrophe
INSIDE[[ord(c) for c in "0123456789@$!+*#._%&|"]] = True


def encoded(texts: list[str]) -> np.ndarray:
    raw = [w.encode() for w in texts]
    ends = np.cumsum([len(r) for r in raw])
    return hashed(np.frombuffer(b"".join(raw), np.uint8), ends - [len(r) for r in raw], ends)


YOU = np.sort(encoded(SECOND_PERSON))


def stem_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Hashes of the beginnings of each word, by length, and the words that are longer than that."""
    lead = np.concatenate([[0], np.cumsum((low & 0xC0) != 0x80)])
    place = np.append(np.flatnonzero((low & 0xC0) != 0x80), len(low))
    letters = lead[ends] - lead[starts]
    for width in STEMS:
        longer = np.flatnonzero(letters > width)
        yield width, hashed(low, starts[longer], place[lead[starts[longer]] + width]), longer


def found(keys: np.ndarray, weights: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The weight of each hash, 0 for those not in the sorted keys."""
    if not len(keys):
        return np.zeros(len(hashes))
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    return np.where(keys[at] == hashes, weights[at], 0.0)


class Parsed:
    """What one slice of texts holds whatever the lexicon: words, their distinct forms and stems, rates."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, low: np.ndarray, low_offsets: np.ndarray):
        self.n = n = len(offsets) - 1
        starts, ends, self.rows = letter_words(low, low_offsets)
        hashes = hashed(low, starts, ends)
        self.words, first, self.form = np.unique(hashes, return_index=True, return_inverse=True)
        self.stems = list(stem_hashes(low, starts[first], ends[first])) if len(first) else []
        self.count = np.bincount(self.rows, minlength=n)
        self.you = np.isin(self.words, YOU)[self.form] if len(first) else np.zeros(0, bool)
        self.hidden, self.hidden_rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.rates = self.signs(data, offsets)

    def signs(self, data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
        n = self.n
        size = np.maximum(np.diff(offsets), 1)
        total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
        count = lambda text: total(np.isin(data, np.frombuffer(text, np.uint8)))
        letters = np.maximum(total(ALNUM[data] & ~((data >= 48) & (data < 58))), 1)
        rates = {"capitals": total(UPPER[data]) / letters, "exclamations": count(b"!") / size, "questions": count(b"?") / size,
                 "other_signs": count(b"#$%&*|@~^_+=<>") / size, "digits": count(b"0123456789") / size}
        _, rows, starts, ends = words(data, offsets, lower=False)
        if not len(starts):
            return rates | {"capital_words": np.zeros(n), "obfuscated": np.zeros(n)}
        before = lambda mask: np.concatenate([[0], np.cumsum(mask)])
        upper, small = before(UPPER[data]), before(ALNUM[data] & ~UPPER[data])
        loud = (upper[ends] - upper[starts] >= 2) & (small[ends] == small[starts])
        # a word without the signs around it; one with signs or digits between its letters hides something
        solid = np.flatnonzero(ALNUM[data])
        a = np.append(solid, len(data))[np.searchsorted(solid, starts)]
        b = np.concatenate([[-1], solid])[np.searchsorted(solid, ends)] + 1
        letter, odd = before(ALNUM[data] & ~((data >= 48) & (data < 58))), before(INSIDE[data])
        hiding = np.flatnonzero(b > a + 2)
        hiding = hiding[(letter[b[hiding]] - letter[a[hiding]] >= 2) & (odd[b[hiding]] > odd[a[hiding]])]
        if len(hiding):
            length = b[hiding] - a[hiding]
            begin = np.cumsum(length) - length
            at = np.repeat(a[hiding] - begin, length) + np.arange(int(length.sum()))
            raw = data[at]
            plain = FOLD[np.where(UPPER[raw], raw + 32, raw)]
            owner = np.repeat(np.arange(len(hiding)), length)[plain > 0]
            plain = plain[plain > 0]
            bounds = np.searchsorted(owner, np.arange(len(hiding) + 1))
            self.hidden, self.hidden_rows = hashed(plain, bounds[:-1], bounds[1:]), rows[hiding]
        each = np.maximum(np.bincount(rows, minlength=n), 1)
        return rates | {"capital_words": np.bincount(rows[loud], minlength=n) / each, "obfuscated": np.bincount(rows[hiding], minlength=n) / each}

    def features(self, lexicon: dict[str, np.ndarray]) -> np.ndarray:
        n, size = self.n, np.maximum(self.count, 1)
        word = found(lexicon["words"], lexicon["word_weights"], self.words)
        stem = np.zeros(len(self.words))
        for _, hashes, longer in self.stems:
            stem[longer] = np.maximum(stem[longer], found(lexicon["stems"], lexicon["stem_weights"], hashes))
        out = {"words": np.log1p(self.count)} | self.rates
        either = np.maximum(word, stem)
        for name, weight in (("listed", word), ("stems", stem), ("either", either)):
            w = weight[self.form] if len(self.form) else np.zeros(0)
            hit = w > 0
            most = np.zeros(n)
            np.maximum.at(most, self.rows[hit], w[hit])
            number = np.bincount(self.rows[hit], minlength=n)
            out |= {name: number / size, f"{name}_strong": np.bincount(self.rows[w >= np.log(STRONG)], minlength=n) / size,
                    f"{name}_weight": np.bincount(self.rows, w, minlength=n) / size, f"{name}_most": most, f"{name}_count": np.log1p(number)}
        hidden = found(lexicon["words"], lexicon["word_weights"], self.hidden) > 0
        out["hidden"] = np.bincount(self.hidden_rows[hidden], minlength=n) / size
        out["second_person"] = np.bincount(self.rows[self.you], minlength=n) / size
        listed = np.flatnonzero(either[self.form] > 0) if len(self.form) else np.zeros(0, np.int64)
        near = np.zeros(len(listed), bool)
        you = np.flatnonzero(self.you)
        if len(you) and len(listed):
            at = np.searchsorted(you, listed)
            for other in (you[np.minimum(at, len(you) - 1)], you[np.maximum(at - 1, 0)]):
                near |= (np.abs(other - listed) <= NEAR) & (self.rows[other] == self.rows[listed])
        out["near_second_person"] = np.bincount(self.rows[listed[near]], minlength=n) / size
        return np.stack([out[name] for name in FEATURES], axis=1).astype(np.float64)


def parsed(texts: pa.Array):
    """A ``Parsed`` for each slice of a text column, with its first row."""
    low_data, low_offsets = lowered(texts)
    for lo, hi, data, offsets in slices(*text_buffer(texts)):
        part = low_data[low_offsets[lo] : low_offsets[hi]]
        yield lo, Parsed(data, offsets, part, low_offsets[lo : hi + 1] - low_offsets[lo])


def lexicon_of(docs: list[Parsed], toxic: np.ndarray) -> dict[str, np.ndarray]:
    """Words and stems with the log ratio of their mean densities in toxic and other documents."""
    kinds: dict[str, list] = {"words": [], "stems": []}
    for i, d in enumerate(docs):
        if not len(d.words):
            continue
        per = np.bincount(d.form, minlength=len(d.words)) / len(d.form)
        kinds["words"].append((d.words, per, np.full(len(per), i)))
        for _, hashes, longer in d.stems:
            kinds["stems"].append((hashes, per[longer], np.full(len(hashes), i)))
    n = np.maximum(np.bincount(toxic, minlength=2), 1)
    out = {}
    for kind, parts in kinds.items():
        keys, weights = np.zeros(0, np.uint64), np.zeros(0)
        if parts:
            hashes, dense, owner = (np.concatenate(p) for p in zip(*parts))
            keys, number = np.unique(hashes, return_inverse=True)
            sums, docs_with = [], []
            for c in (0, 1):
                mine = toxic[owner] == c
                sums.append((np.bincount(number[mine], dense[mine], minlength=len(keys)) + 1e-4) / n[c])
                pairs = np.unique(number[mine] * len(docs) + owner[mine]) // len(docs)
                docs_with.append(np.bincount(pairs, minlength=len(keys)))
            ratio = sums[1] / sums[0]
            expected = n[1] * (docs_with[0] + 0.5) / (n[0] + 1)
            good = (docs_with[1] >= max(SUPPORT, SHARE * n[1])) & (ratio >= TIMES) & (docs_with[1] - expected >= DEVIATIONS * np.sqrt(expected))
            keys, weights = keys[good], np.log(ratio[good])
        out[kind], out[kind[:-1] + "_weights"] = keys, weights
    return out


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Boosted trees of equal depth on the logistic loss, as arrays: split feature and bound of every node, leaf values."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    width = BINS + 1
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    feature, bound, value = np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf), np.zeros((TREES, leaves))
    share = np.clip(np.average(y, weights=weight), 1e-6, 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    z = np.full(len(y), base)
    columns = np.arange(x.shape[1]) * width
    for t in range(TREES):
        p = 1 / (1 + np.exp(-z))
        g, h = weight * (y - p), weight * p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            nodes = 2**level
            cell = (node[:, None] * x.shape[1] * width + columns + binned).ravel()
            shape = (nodes, x.shape[1], width)
            total = lambda v: np.bincount(cell, np.repeat(v, x.shape[1]), minlength=np.prod(shape)).reshape(shape).cumsum(axis=2)
            gs, hs, ns = total(g), total(h), total(np.ones(len(y)))
            score = lambda a, b: a**2 / (b + RIDGE)
            gain = score(gs, hs) + score(gs[:, :, -1:] - gs, hs[:, :, -1:] - hs) - score(gs[:, :, -1:], hs[:, :, -1:])
            gain[(ns < LEAF) | (ns[:, :, -1:] - ns < LEAF)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            f, b = best // width, best % width
            split = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-9
            at = slice(nodes - 1, 2 * nodes - 1)
            feature[t, at] = f
            bound[t, at] = [edges[i][j] if s and j < len(edges[i]) else np.inf for i, j, s in zip(f, b, split)]
            node = 2 * node + (x[np.arange(len(y)), f[node]] > bound[t, at][node])
        value[t] = RATE * np.bincount(node, g, minlength=leaves) / (np.bincount(node, h, minlength=leaves) + RIDGE)
        z += value[t][node]
    return {"feature": feature, "bound": bound, "value": value, "base": np.array(base)}


def raw_scores(x: np.ndarray, trees: dict[str, np.ndarray]) -> np.ndarray:
    each, rows = np.arange(len(trees["value"])), np.arange(len(x))[:, None]
    node = np.zeros((len(x), len(each)), np.int64)
    for level in range(DEPTH):
        at = node + 2**level - 1
        node = 2 * node + (x[rows, trees["feature"][each, at]] > trees["bound"][each, at])
    return trees["base"] + trees["value"][each, node].sum(axis=1)


def isotonic(raw: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Raw scores and rising probabilities to interpolate between: neighbours that fall are pooled."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []
    for r, t, w in zip(raw[order], y[order], weight[order]):
        blocks.append([w * t, w, w * r])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    ones, total, place = np.array(blocks).T
    return place / total, ones / total


def train(texts: list[str], toxic: list[int], totals: dict[int, int]) -> dict[str, np.ndarray] | float:
    """The model as plain arrays; with one class only, its probability."""
    y = np.array(toxic, np.int64)
    if len(set(toxic)) < 2:
        return float(len(y) > 0 and y[0])
    docs = [p for text in texts for _, p in parsed(pa.array([text], pa.large_string()))]
    weight = np.array([totals[c] for c in (0, 1)])[y] / np.bincount(y, minlength=2)[y]
    weight = weight / weight.mean()
    fold = np.empty(len(y), np.int64)  # dealt within each class
    for c in (0, 1):
        fold[y == c] = np.arange(int((y == c).sum())) % FOLDS
    x, raw = np.zeros((len(y), len(FEATURES))), np.zeros(len(y))
    for k in range(FOLDS):
        others = np.flatnonzero(fold != k)
        lexicon = lexicon_of([docs[i] for i in others], y[others])
        for i in np.flatnonzero(fold == k):
            x[i] = docs[i].features(lexicon)[0]
    for k in range(FOLDS):
        others, mine = fold != k, fold == k
        raw[mine] = raw_scores(x[mine], grow(x[others], y[others], weight[others]))
    place, probability = isotonic(raw, y, weight)
    return lexicon_of(docs, y) | grow(x, y, weight) | {"place": place, "probability": probability}


def probabilities(doc: Parsed, model: dict[str, np.ndarray]) -> np.ndarray:
    raw = raw_scores(doc.features(model), model)
    fitted = np.interp(raw, model["place"], model["probability"])
    # a hundredth of the plain logistic value keeps the order where the fit is flat
    return 0.99 * fitted + 0.01 / (1 + np.exp(-raw))


def fit(docs: DataFrame, labels: DataFrame):
    """Trains on at most ``SAMPLE`` whole documents of each class, the first by hash of doc_id."""
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(~held_out())
    known = cut(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labels")
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = F.xxhash64("doc_id")
    parts = [known.where(F.col("toxic") == c).orderBy(order, "doc_id").limit(n) for c, n in SAMPLE.items()]
    chosen = cut(parts[0].union(parts[1]), "sample")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    # of several texts under one doc_id the first in order is taken
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    # copies count once: they would otherwise support each other's words
    once = {(r["text"], r["toxic"]): None for r in rows}
    return train([t for t, _ in once], [c for _, c in once], totals)


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row with a doc_id.

    ``score`` is the probability of label 1, ``predicted`` whether it reaches ``threshold``. Null, empty and
    wordless texts are scored like any other, by features that are all zero. Labels are read from rows that
    are not held out; a document with two labels counts as toxic if one says so, other values than 0
    and 1 are no labels. With labels of one class only every score is 1 or 0 accordingly, and 0
    without labels. Repeated rows are scored each.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])

    def run(batches):
        model = sent.value
        for batch in batches:
            score = np.full(batch.num_rows, model if isinstance(model, float) else 0.0)
            if isinstance(model, dict):
                for lo, doc in parsed(batch.column("text")):
                    score[lo : lo + doc.n] = probabilities(doc, model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score)], schema=schema)

    rows = docs.where("doc_id IS NOT NULL").select("doc_id", "text", held_out().alias("held_out"))
    out = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
