"""Personal data: a semi-Markov conditional random field beside plain patterns.

Patterns give the base spans. The field reads islands of words with digits, an at sign or a spelt-out
one; its segments are runs of up to ``LONGEST`` words, scored as a whole (shape, number of digits,
check digit, prefix, separators, the cue before) and by the types of neighbouring segments. A dynamic
program bounded by ``LONGEST`` picks boundaries and types together. It is trained by stochastic
gradient ascent on the likelihood, on a bounded sample: on its base spans, on these rewritten in ways
that the patterns do not know (no plus, other separators, words for signs), and on numbers of like
shapes that are something else. Segments beyond the base spans are added from a bound on their odds
that keeps the added spans of held-out documents right.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodledger.llm.store import cut, shared, taken

# Kinds in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match starts at the start of its first digits and ends with its last, so looking back changes nothing
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: Documents with digits or an at sign that the field is trained on, the first by hash of doc_id.
SAMPLE = 400
#: Islands that it is trained on at most, drawn from all of the sample, and words of each.
EXAMPLES, PIECE = 4000, 12
#: One in so many documents of the sample is held out to fit the bound, for this precision of what is added.
HOLD, PRECISION = 4, 0.99
#: Ways in which a base span is rewritten.
FORMS = 4
EPOCHS = 8
RATE = 0.25
#: Words of a segment at most.
LONGEST = 6
#: Words that are segmented at a time; a longer island is read in pieces that overlap by a segment.
ISLAND = 48
#: Least log odds against "nothing here" from which a segment is added, whatever the held-out documents say.
SURE = 2.0
#: Frequent words of the sample, which seldom are a mail user's name.
COMMON = 2000
OTHER = 0
WORD = re.compile(r"[^\s,;:<>\"'|=\[\]{}!?*#$&]+")
SIGN = re.compile(r"[0-9@]|(?<= )(?:\(at\)|at)(?= [A-Za-z0-9-]+(?:\.[A-Za-z]{2,}| \(?dot\)? [A-Za-z]{2,}))")
BEFORE = re.compile(r"([^\W\d_]+)[^\w+(]*$")
CUES = {
    1: ("email", "mail", "contact", "write"),
    3: ("card", "visa", "mastercard", "credit"),
    4: ("call", "phone", "tel", "telephone", "mobile", "fax", "dial", "whatsapp"),
}
NO_CUES = ("order", "invoice", "item", "version", "page", "id", "isbn", "ref", "part", "look", "arrive", "number", "no", "serial", "ticket", "on", "from", "since", "dated")
KNOWN = frozenset(w for ws in CUES.values() for w in ws) | frozenset(NO_CUES)
DOTTED = re.compile(r"[A-Za-z0-9-]+(?:(?:\.[A-Za-z0-9-]*[A-Za-z0-9])+|(?: \(?dot\)? [A-Za-z0-9-]+)(?: \(?dot\)? [A-Za-z0-9-]+)?)")
DIGITS = re.compile(r"[0-9]+")
LETTERS = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of the base spans, by kind and start; ends are exclusive."""
    spans = [(0, a, b) for a, b in emails(text)]
    if SIGN.search(text) is None:
        return spans
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            spans.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                spans.append((3, m.start(), m.end()))
    return spans


def islands(text: str):
    """Neighbouring words with signs, as lists of ``(start, end)`` of words."""
    words: list[tuple[int, int]] = []
    at = 0
    while True:
        m = SIGN.search(text, at)
        if m is None:
            break
        start = m.start()
        low = words[-1][1] if words else 0
        while start > low and WORD.match(text[start - 1]):
            start -= 1
        w = WORD.match(text, start)
        end = w.end() if w else m.end()
        opened = "(" in text[start:end]
        while end > m.end() and (text[end - 1] == "." or text[end - 1] == ")" and not opened):
            end -= 1
        lead = []
        if not m[0][0].isdigit() and m[0] != "@":  # a spelt-out sign: its name, and the words up to the domain's end
            name = start - 1
            while name > low and WORD.match(text[name - 1]):
                name -= 1
            if name < start - 1:
                lead.append((name, start - 1))
            lead.append((start, end))
            rest = DOTTED.match(text, end + 1)
            parts = [(x.start(), x.end()) for x in re.finditer(r"\S+", rest[0])] if rest else []
            lead += [(end + 1 + x, end + 1 + y) for x, y in parts[:-1]]
            if parts:
                start, end = end + 1 + parts[-1][0], end + 1 + parts[-1][1]
            else:
                start, end = lead.pop()
        first = lead[0][0] if lead else start
        if words and (text[words[-1][1] : first].strip(" ") or first - words[-1][1] > 2):
            yield words
            words = []
        words += lead
        words.append((start, end))
        at = end
    if words:
        yield words


def features(text: str, start: int, end: int, common: frozenset[str] = frozenset()) -> list[str]:
    """Of a whole segment, and of the word before it."""
    s = text[start:end]
    m = BEFORE.search(text[max(0, start - 24) : start])
    cue = m[1].lower() if m and m[1].lower() in KNOWN else ""
    spelt = [w for w in s.split(" ") if w in ("at", "(at)", "dot", "(dot)")] if " " in s else []
    if spelt:
        name = s.split(" ", 1)[0].lower()
        cue += "+plain" if name in common or name in KNOWN else "+name"
    digits = DIGITS.findall(s)
    joined = "".join(digits)
    shape = LETTERS.sub("a", DIGITS.sub("9", s))
    parts = s.split(".")
    return [
        f"shape={shape if len(shape) < 40 else 'long'}",
        f"digits={min(len(joined), 20)}",
        f"groups={min(len(digits), 8)}",
        f"check={13 <= len(joined) <= 19 and luhn(joined)}",
        f"phone={s[0] == '+' and 9 <= len(joined) <= 15}",
        f"octets={len(parts) == 4 and all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts)}",
        f"at={s.count('@')}",
        f"tail={'a' if s[-1].isalpha() else '9' if s[-1].isdigit() else s[-1]}",
        f"head={'a' if s[0].isalpha() else '9' if s[0].isdigit() else s[0]}",
        f"dots={min(s.count('.'), 4)}",
        f"signs={'mixed' if '@' in s and ' ' in s else 'plain'}",
        f"letters={'some' if LETTERS.search(s) else 'none'}",
        f"cue={cue}",
        f"cued={shape if len(shape) < 40 else 'long'} {cue}",
        f"spelt={' '.join(spelt)}",
        f"abroad={s[:2] == '00' and 9 <= len(joined) <= 15} {cue}",
    ]


class Field:
    """Weights of segment features by type, and of types by the type before."""

    def __init__(self):
        self.weights: dict[str, np.ndarray] = {}
        self.moves = np.zeros((len(KINDS) + 1, len(KINDS) + 1))
        self.scores: dict[tuple, np.ndarray] = {}
        self.common: frozenset[str] = frozenset()
        self.sure = SURE

    def segments(self, text: str, words: list[tuple[int, int]]):
        """Features of every segment ``(i, j)`` of words ``i`` to ``j - 1``."""
        return {(i, j): features(text, words[i][0], words[j - 1][1], self.common)
                for i in range(len(words)) for j in range(i + 1, min(len(words), i + LONGEST) + 1)}

    def score(self, found: list[str], width: int) -> np.ndarray:
        key = (*found, width == 1)
        out = self.scores.get(key)
        if out is None:
            out = np.zeros(len(KINDS) + 1)
            for f in found:
                w = self.weights.get(f)
                if w is not None:
                    out += w
            if width > 1:
                out[OTHER] = -1e9  # words outside of entities are single segments
            if len(self.scores) < 100_000:
                self.scores[key] = out
        return out

    def best(self, text: str, words: list[tuple[int, int]]) -> list[tuple[int, int, int, float]]:
        """The best segmentation: ``(type, i, j, log odds of the segment against single others)``."""
        n = len(words)
        scores = {k: self.score(f, k[1] - k[0]) for k, f in self.segments(text, words).items()}
        top, back = [np.zeros(len(KINDS) + 1)], [None]
        for j in range(1, n + 1):
            value, source = np.full(len(KINDS) + 1, -1e18), [None] * (len(KINDS) + 1)
            for i in range(max(0, j - LONGEST), j):
                step = top[i][:, None] + self.moves if i else np.tile(self.moves[OTHER], (len(KINDS) + 1, 1))
                before = step.argmax(axis=0)
                total = step.max(axis=0) + scores[i, j]
                for t in np.flatnonzero(total > value):
                    value[t], source[t] = total[t], (i, before[t])
            top.append(value)
            back.append(source)
        out, j, t = [], n, int(top[n].argmax())
        while j > 0:
            i, before = back[j][t]
            if t != OTHER:
                plain = sum(scores[k, k + 1][OTHER] for k in range(i, j))
                out.append((t - 1, i, j, float(scores[i, j][t] - plain)))
            j, t = i, int(before)
        return out[::-1]

    def learn(self, examples: list[tuple[str, list, dict]]) -> None:
        """Gradient steps on the log likelihood of the marked segmentations."""
        rng = np.random.default_rng(5)
        prepared = [(len(words), self.segments(text, words), gold) for text, words, gold in examples]
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS)
            for e in rng.permutation(len(prepared)):
                n, found, gold = prepared[e]
                self.scores.clear()
                scores = {k: self.score(f, k[1] - k[0]) for k, f in found.items()}
                expected, moves = self.expectations(n, scores)
                before = OTHER
                for (i, j), t in sorted(gold.items()):
                    expected[i, j][t] -= 1
                    moves[before, t] -= 1
                    before = t
                for k, p in expected.items():
                    if np.abs(p).max() > 1e-4:
                        for f in found[k]:
                            self.weights.setdefault(f, np.zeros(len(KINDS) + 1))
                            self.weights[f] -= rate * p
                self.moves -= rate * moves
        self.scores.clear()

    def expectations(self, n: int, scores: dict) -> tuple[dict, np.ndarray]:
        size = len(KINDS) + 1
        ahead = [np.full(size, -1e18) for _ in range(n + 1)]
        for j in range(1, n + 1):
            terms = []
            for i in range(max(0, j - LONGEST), j):
                start = self.moves[OTHER] if i == 0 else np.logaddexp.reduce(ahead[i][:, None] + self.moves, axis=0)
                terms.append(start + scores[i, j])
            ahead[j] = np.logaddexp.reduce(terms, axis=0)
        after = [np.zeros(size) for _ in range(n + 1)]
        for i in range(n - 1, 0, -1):
            terms = [np.logaddexp.reduce(self.moves + (scores[i, j] + after[j])[None, :], axis=1) for j in range(i + 1, min(n, i + LONGEST) + 1)]
            after[i] = np.logaddexp.reduce(terms, axis=0)
        whole = np.logaddexp.reduce(ahead[n])
        expected, moves = {}, np.zeros((size, size))
        for (i, j), s in scores.items():
            end = s + after[j]
            if i == 0:
                p = np.exp(np.minimum(self.moves[OTHER] + end - whole, 0))
                moves[OTHER] += p
            else:
                joint = np.exp(np.minimum(ahead[i][:, None] + self.moves + end[None, :] - whole, 0))
                moves += joint
                p = joint.sum(axis=0)
            expected[i, j] = p
        return expected, moves


def marked(text: str, words: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> dict | None:
    """The segmentation that base spans give an island, if they begin and end with its words."""
    starts, ends = {a: i for i, (a, _) in enumerate(words)}, {b: i + 1 for i, (_, b) in enumerate(words)}
    gold, taken = {}, np.zeros(len(words), bool)
    for kind, a, b in spans:
        if b <= words[0][0] or a >= words[-1][1]:
            continue
        i, j = starts.get(a), ends.get(b)
        if i is None or j is None or j - i > LONGEST or j <= i or taken[i:j].any():
            return None
        gold[i, j] = kind + 1
        taken[i:j] = True
    for i in np.flatnonzero(~taken).tolist():
        gold[i, i + 1] = OTHER
    return gold


def rewritten(kind: int, span: str, form: int) -> str | None:
    """A base span as people also write it, in one of ``FORMS`` ways out of the patterns' reach."""
    digits = "".join(DIGITS.findall(span))
    if kind == 0:
        name, domain = span.rsplit("@", 1)
        if form % 2 and (plain := LETTERS.search(name)):
            name = plain[0]
        if form > 1:
            domain = ".".join(domain.rsplit(".", 2)[-2:])
        spelt = domain.replace(".", " dot ") if domain.count(".") == 1 else domain
        return name + (f" at {domain}", f" (at) {domain}", f" at {spelt}", f" (at) {spelt.replace(' dot ', ' (dot) ')}")[form]
    if kind == 2:
        groups = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return (".".join(groups), "/".join(groups), ". ".join(groups), "_".join(groups))[form] if len(groups) <= LONGEST else None
    if kind == 3 and len(digits) >= 10:
        a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
        return (f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{digits[:-10]} {a} {b}{c}" if len(digits) > 10 else f"0{a} {b}{c}")[form]
    return None


def look_alike(kind: int, span: str, rng) -> str:
    """Text of the same shape that is no personal data."""
    if kind == 0:
        return span.split(" ", 1)[1]  # a domain without a name; the cue before it is a plain word
    out = "".join(str(rng.integers(0, 10)) if c.isdigit() else c for c in span)
    if kind == 2 and luhn("".join(DIGITS.findall(out))):
        out = out[:-1] + str((int(out[-1]) + 1) % 10)
    return out


def pieces(text: str, spans: list[tuple[int, int, int]]):
    """Marked islands of a text, long ones in pieces that end with a span or a word outside of all."""
    for words in islands(text):
        at = 0
        while at < len(words):
            for n in range(PIECE, 0, -1):
                part = words[at : at + n]
                if (gold := marked(text, part, spans)) is not None:
                    yield text, part, gold
                    break
            at += n


def drawn(text: str, spans: list[tuple[int, int, int]], rng):
    """Islands of a document as it is, and of its base spans rewritten and replaced by look-alikes."""
    yield from pieces(text, spans)
    for kind, a, b in spans:
        ahead = text[max(0, a - 24) : a]
        for form, real in product(range(FORMS), (True, False)):
            other = rewritten(kind, text[a:b], form)
            if other is None:
                continue
            cues = CUES[kind + 1] if real else NO_CUES
            start = f"{ahead} {cues[int(rng.integers(0, len(cues)))]} " if not real or rng.random() < 0.7 else ahead
            body = other if real else look_alike(kind, other, rng)
            made = start + body + text[b : b + 12]
            gold = [s for s in base_spans(made) if s[2] <= len(start) or s[1] >= len(start) + len(body)]
            for example in pieces(made, gold + [(kind, len(start), len(start) + len(body))] if real else gold):
                if example[1][-1][1] > len(start):
                    yield example
        year, month, day = (int(rng.integers(*r)) for r in ((1950, 2050), (1, 13), (1, 29)))
        cue = ("on", "from", "since", "dated", "", "phone", "card")[int(rng.integers(0, 7))]
        for date in (f"{year}-{month:02}-{day:02}", f"{day:02}.{month:02}.{year}", f"{day}-{month}-{year} {day:02}:{month:02}"):
            made = f"{ahead} {cue} {date}{text[b : b + 12]}"
            yield from pieces(made, base_spans(made))


def fit(docs: DataFrame) -> Field:
    """Trains on islands of at most ``SAMPLE`` whole documents; one in ``HOLD`` of them fits the bound.

    Of several texts under one doc_id the least counts.
    """
    signed = docs.where("doc_id IS NOT NULL AND text RLIKE '[0-9@]'")
    ids = cut(signed.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).distinct(), "sample")
    rows = signed.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).collect()
    return trained([r["text"] for r in sorted(rows, key=lambda r: r["doc_id"])])


def trained(texts: list[str]) -> Field:
    rng = np.random.default_rng(9)
    field = Field()
    counts = Counter(w.lower() for t in texts for w in set(LETTERS.findall(t)))
    field.common = frozenset(w for w, n in counts.most_common(COMMON) if n > 1)
    fitted, held = [], []
    for i, text in enumerate(texts):
        (held if i % HOLD == HOLD - 1 else fitted).extend(drawn(text, base_spans(text), rng))
    field.learn([fitted[i] for i in rng.permutation(len(fitted))[:EXAMPLES]])
    odds, right = [], []
    for text, words, gold in (held[i] for i in rng.permutation(len(held))[:EXAMPLES]):
        base = base_spans(text)
        for kind, i, j, sure in field.best(text, words):
            a, b = words[i][0], words[j - 1][1]
            if not any(x < b and a < y for _, x, y in base):
                odds.append(sure)
                right.append(gold.get((i, j)) == kind + 1)
    # the least bound above which the added spans are right often enough
    order = np.argsort(-np.array(odds), kind="stable")
    good = np.cumsum(np.array(right, float)[order]) >= PRECISION * np.arange(1, len(order) + 1)
    field.sure = max(SURE, odds[order[np.flatnonzero(good)[-1]]]) if good.any() else float("inf")
    return field


def all_spans(field: Field, text: str) -> tuple[list, list]:
    """Base spans, and with them the segments the field is sure of and that touch none."""
    base = base_spans(text)
    added = []
    taken_up = sorted((a, b) for _, a, b in base)
    starts, ends = [a for a, _ in taken_up], list(accumulate((b for _, b in taken_up), max))
    for words in islands(text):
        at = 0
        while at < len(words):
            part = words[at : at + ISLAND + LONGEST]
            end = len(part) if at + len(part) == len(words) else ISLAND
            step = end
            for kind, i, j, odds in field.best(text, part):
                if i >= end:
                    break
                step = max(step, j)
                a, b = part[i][0], part[j - 1][1]
                before = bisect_left(starts, b)
                if odds >= field.sure and not (before and ends[before - 1] > a):
                    added.append((kind, a, b))
            at += step
    return base, sorted(base + added)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of every row with a doc_id.

    The numbers and the digest are those of the base spans; ``spans`` holds the added ones too.
    Offsets count code points. A null or empty text has no spans: zeros, the digest of nothing, and
    an empty string. Repeated rows each give a row.
    """
    sent = shared(docs.sparkSession, fit(docs))
    schema = pa.schema([("doc_id", pa.int64())] + [(f"n_{k}", pa.int64()) for k in KINDS] + [("base_sha256", pa.string()), ("spans", pa.string())])

    def run(batches):
        field = taken(sent)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                base, spans = all_spans(field, text.as_py() or "")
                count = Counter(k for k, _, _ in base)
                rows.append((doc, *(count[k] for k in range(len(KINDS))), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    ddl = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    return docs.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(run, ddl)
