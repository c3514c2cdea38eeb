"""The text operators against brute force, and on awkward tables."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from floodledger.llm import decontaminate, language, main_text, mixing, ngram_join, packing, personal, quality, suffix_dedup, vectors
from floodledger.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows, extra=True):
    """Documents, with more columns whose names the operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.when(F.col("doc_id") % 3 == 0, "a").when(F.col("doc_id") % 3 == 1, "b"), "n_chars": F.length("text").cast("long")})
    if extra:
        names = ("part", "kind", "bucket", "node", "items", "key", "row", "position", "slot", "score", "held_out", "docs", "unit", "n", "values", "list")
        df = df.withColumns({c: F.lit(c) for c in names})
    return df


LONG = " ".join(f"w{i * 7919 % 30011}" for i in range(30000))
AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "a b c d e f g"), (6, "a b c d e f g"), (6, "a b c d e f g"), (None, "x y z"),
    (7, LONG), (8, "Éé ü 中文"), (9, "A B C D E F G"), (10, "word"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return frame(spark, AWKWARD).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, []).persist()


# ------------------------------------------------------------------ n-gram join


def shingles(text):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in WORD.findall(text or "")]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(sets):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, len(s), low[find(i)]) for i, (d, s) in enumerate(sets))


def test_similar_documents_match_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"v{i}" for i in range(500)]
    line = [rng.choice(vocab) for _ in range(12)]
    rows = []
    for i in range(150):  # a line that many documents share
        rows.append((len(rows), " ".join(line + [rng.choice(vocab) for _ in range(rng.randint(0, 60))])))
    for size in (6, 9, 14, 30, 120):  # a chain of near copies, more than a plain signature group takes
        base = [rng.choice(vocab) for _ in range(size)]
        for _ in range(45):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, size // 25))):
                copy[rng.randrange(size)] = rng.choice(vocab)
            rows.append((len(rows), " ".join(copy)))
            if rng.random() < 0.3:
                base = copy
    rows += [(len(rows) + i, t) for i, (_, t) in enumerate(rows[::40])]
    got = ngram_join.similar_documents(frame(spark, rows))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute_components(rows)


def test_similar_documents_large_family(spark, monkeypatch):
    """More sets than a block holds, of different sizes."""
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    rng = random.Random(9)
    base = [f"z{rng.randrange(900)}" for _ in range(90)]
    rows = []
    for i in range(70):
        copy = list(base) + [f"q{j}" for j in range(i // 4)]
        copy[rng.randrange(90)] = "other"
        rows.append((i, " ".join(copy)))
    got = ngram_join.similar_documents(frame(spark, rows))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute_components(rows)


def test_similar_documents_awkward(spark, awkward, empty):
    rows = [(d, t) for d, t in AWKWARD if d is not None]
    got = ngram_join.similar_documents(awkward)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute_components(rows)
    assert ngram_join.similar_documents(empty).count() == 0


def test_signatures_meet_the_bound():
    """Sets at the bound of their sizes share a part signature unless they have too many empty ones."""
    rng = np.random.default_rng(2)
    bands = ngram_join.Bands(80)
    for size in (20, 100, 900):
        for _ in range(20):
            both = int(np.ceil(size * 16 / 18))
            pool = rng.integers(0, 2**63, 2 * size).astype(np.uint64) * np.uint64(2)
            a, b = np.sort(pool[:size]), np.sort(np.concatenate([pool[:both], pool[size : 2 * size - both]]))
            tag = int(bands.band(np.array([size]))[0]) + 1
            k = bands.differences(tag)
            assert 2 * (size - both) <= k
            n1 = ngram_join.parts(k)
            shared = np.intersect1d(ngram_join.part_signatures(a, tag, n1), ngram_join.part_signatures(b, tag, n1))
            assert len(shared) or min(ngram_join.empty_parts(x, n1) for x in (a, b)) >= n1 - k // 2


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (5, 5), (200, 100)] + [(300, 301 + i) for i in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100, 200: 100, **{301 + i: 300 for i in range(40)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# ------------------------------------------------------------------ personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for i, kind in enumerate(personal.KINDS):
        for m in re.finditer(PLAIN[kind], text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and personal.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((i, m.start(), m.end()))
    return out


def test_base_spans_match_plain_patterns():
    rng = random.Random(1)
    texts = ["a@b.c@d.e", "1.2.3.4.5.6.7.8", "+1 23 456 7890+1(234)5678901", "4111 1111-1111 1111", "é 007.0.0.0001 1.2.3.400", "4111111111111111 " * 3]
    texts += ["".join(rng.choice("a1.@+- (4") for _ in range(rng.randint(1, 60))) for _ in range(5000)]
    for t in texts:
        assert personal.base_spans(t) == plain_spans(t)
    for hard in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "@" * 100_000, "+1(" * 100_000):  # no quadratic time
        personal.base_spans(hard)


def test_field_learns_spans_and_adds_to_the_base(spark, empty):
    rng = random.Random(4)
    rows = []
    for i in range(120):
        card = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        card = next(card + c for c in "0123456789" if personal.luhn(card + c))
        rows.append((i, f"mail x{i}.y@mail{i % 9}.example.com or +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} from 10.0.{i}.7, pay {card}; page {i} of {i + 3}"))
    docs = frame(spark, rows + AWKWARD)
    field = personal.fit(docs)
    hit = 0
    for _, text in rows:
        base, spans = personal.all_spans(field, text)
        assert set(base) <= set(spans) and base == plain_spans(text)
        alone = {(k, w[i][0], w[j - 1][1]) for w in personal.islands(text) for k, i, j, _ in field.best(text, w)}
        hit += len(set(base) & alone)
    assert hit >= 0.95 * 4 * len(rows)
    got = {r.doc_id: r for r in personal.personal_data(docs).collect() if r.doc_id not in (1, 2, 3, 6)}
    digest = hashlib.sha256(",".join(f"{personal.KINDS[k]}:{a}:{b}" for k, a, b in plain_spans(rows[50][1])).encode()).hexdigest()
    assert (got[50].n_email, got[50].n_ip, got[50].n_card, got[50].n_phone, got[50].base_sha256) == (1, 1, 1, 1, digest)
    blank = personal.personal_data(frame(spark, AWKWARD)).where("doc_id IN (1, 2)").collect()
    assert {(r.n_email, r.base_sha256, r.spans) for r in blank} == {(0, hashlib.sha256(b"").hexdigest(), "")}
    assert personal.personal_data(empty).count() == 0


def labelled(n):
    rng = random.Random(8)
    out = []
    for i in range(n):
        card = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        card = next(card + c for c in "0123456789" if personal.luhn(card + c))
        name = "".join(rng.choice("abcdefghij") for _ in range(6))
        out.append(f"the page of {name}.{i}@mail.example.com, or call +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} from 10.0.{i % 250}.7; pay {card} on page {i} of {i + 3}")
    return out


def test_field_adds_rewritten_spans_and_leaves_look_alikes():
    texts = labelled(160)
    field = personal.trained(texts[:120])
    found = right = wanted = 0
    for text in texts[120:]:
        for kind, a, b in personal.base_spans(text):
            for form in range(personal.FORMS):
                if (other := personal.rewritten(kind, text[a:b], form)) is None:
                    continue
                cue = personal.CUES[kind + 1][form % 4]
                made = f"so {cue} {other} then"
                base, spans = personal.all_spans(field, made)
                added = [s for s in spans if s not in base]
                wanted += not base
                found += len(added)
                right += added == [(kind, 4 + len(cue), 4 + len(cue) + len(other))]
    assert right >= 0.8 * wanted and right >= 0.95 * found
    for clean in ("on 2024-01-15 we met", "see page 12 of 345", "order 20240115 came", "look at example.com", "version 10.2.3 of it"):
        assert personal.all_spans(field, clean) == ([], [])


def test_long_words_and_islands_are_read_whole():
    field = personal.trained(labelled(60))
    name = "n" * 500
    assert [text[a:b] for text in (f"x {name}@mail.example.com y",) for a, b in next(personal.islands(text))] == [f"{name}@mail.example.com"]
    rows = " ".join(str(i) for i in range(500))
    made = f"{rows} call (555) 123-4567"
    assert sum(len(w) for w in personal.islands(made)) == 502
    field.sure = min(field.sure, 2.0)
    alone = {made[a:b] for _, a, b in personal.all_spans(field, "call (555) 123-4567")[1] for made in ["call (555) 123-4567"]}
    assert alone == {"(555) 123-4567"} and any(made[a:b] == "(555) 123-4567" for _, a, b in personal.all_spans(field, made)[1])
    for hard in ("1" + ")" * 300_000, "1 " * 50_000, "a at " * 50_000, "x at y.com " * 10_000):  # no quadratic time
        list(personal.islands(hard))


def segmentations(n):
    """All segmentations of ``n`` words with types; words outside of entities stand alone."""
    if n == 0:
        yield []
    for width in range(1, min(n, personal.LONGEST) + 1):
        for rest in segmentations(n - width):
            for t in range(len(personal.KINDS) + 1):
                if t or width == 1:
                    yield [*rest, (n - width, n, t)]


def test_dynamic_program_and_gradient_against_all_segmentations():
    rng = np.random.default_rng(6)
    text = "12 a@b 3.4 77 9"
    words = [(m.start(), m.end()) for m in re.finditer("[^ ]+", text)]
    field = personal.Field()
    found = field.segments(text, words)
    for f in {f for fs in found.values() for f in fs}:
        field.weights[f] = rng.normal(size=5)
    field.moves = rng.normal(size=(5, 5))
    scores = {k: field.score(f, k[1] - k[0]) for k, f in found.items()}

    def value(path):
        return sum(scores[i, j][t] + field.moves[before, t] for (i, j, t), before in zip(path, [0] + [t for _, _, t in path]))

    every = list(segmentations(len(words)))
    values = np.array([value(p) for p in every])
    best = every[int(values.argmax())]
    assert [(t, i, j) for t, i, j, _ in field.best(text, words)] == [(t - 1, i, j) for i, j, t in best if t]
    share = np.exp(values - np.logaddexp.reduce(values))
    expected, moves = field.expectations(len(words), scores)
    for (i, j), p in expected.items():
        for t in range(5):
            assert abs(p[t] - sum(w for w, path in zip(share, every) if (i, j, t) in path)) < 1e-9
    seen = np.zeros((5, 5))
    for w, path in zip(share, every):
        for before, (_, _, t) in zip([0] + [t for _, _, t in path], path):
            seen[before, t] += w
    assert np.abs(moves - seen).max() < 1e-9


# ------------------------------------------------------------------ quality and language


def test_quality_on_held_out_rows(spark, awkward, empty):
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(400):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(5, 80)))
        good = i % 3 > 0
        rows.append((i, text if good else " ".join(w.upper() + "!!" for w in text.split())))
        labels.append((i, int(good)))
    lab = spark.createDataFrame(labels + [(None, 1), (5, None), (6, 7)], "doc_id long, quality int").withColumn("score", F.lit(1))
    got = quality.scored(frame(spark, rows + [(900, None), (901, "")]), lab).collect()
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert len(held) > 50
    assert sum(r.predicted == int(r.doc_id % 3 > 0) for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got) and len(got) == 402
    kept = quality.accepted(frame(spark, rows), lab)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.predicted and r.doc_id < 900}
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.predicted for r in quality.scored(awkward, none).collect()} == {1}
    assert quality.scored(empty, lab).count() == 0


def test_language_on_held_out_rows(spark, empty):
    rng = random.Random(8)
    letters = {"en": "the and of", "de": "der die und ß", "fr": "le les é è"}
    parts = {g: ["".join(rng.choice(s.replace(" ", "")) for _ in range(3)) for _ in range(12)] for g, s in letters.items()}
    rows = []
    for i in range(300):
        g = list(letters)[i % 3]
        rows.append((i, " ".join("".join(rng.choice(parts[g]) for _ in range(rng.randint(1, 4))) for _ in range(20)), g))
    rows += [(901, None, "en"), (902, "123 ... !", "en"), (903, "", None), (904, "中文", None), (905, "ÀÉ" * 50_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(0))
    got = {r.doc_id: r for r in language.identified(docs).collect()}
    held = [r for r in got.values() if r.held_out and r.doc_id < 900]
    assert sum(r.lang_pred == list(letters)[r.doc_id % 3] for r in held) >= 0.97 * len(held)
    assert [got[i].lang_pred for i in (901, 902, 903)] == ["und"] * 3
    assert got[904].lang_pred in letters and got[905].lang_pred in letters
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language.identified(empty).count() == 0


# ------------------------------------------------------------------ decontamination


def test_contained_items_match_brute_force(spark, awkward, empty):
    rng = random.Random(5)
    vocab = [f"t{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 40)))) for i in range(60)] + [(60, None), (61, ""), (None, "t1"), (3, "t5 t6")]
    docs = []
    for i in range(150):
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 300))]
        if i % 2:
            item = (items[i % 60][1] or "").upper().split()
            if rng.random() < 0.5 and len(item) > 10:
                item[rng.randrange(len(item))] = "x"
            at = rng.randint(0, len(words))
            words[at:at] = item
        docs.append((i, " ".join(words)))
    got = {(r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in decontaminate.contained_items(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = set()
    for item, t in items:
        words = WORD.findall((t or "").lower())
        k = min(5, len(words))
        grams = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if k else set()
        for d, text in docs:
            w = WORD.findall(text.lower())
            held = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
            if item is not None and grams and len(grams & held) >= 0.8 * len(grams):
                want.add((d, item, len(grams), len(grams & held)))
    assert got == want and len({k for _, _, k, _ in got}) > 5
    one = spark.createDataFrame([(1, "C D e")], "item_id long, text string")
    assert {r.doc_id for r in decontaminate.contained_items(awkward, one).collect()} == {5, 6, 9}
    left = decontaminate.without_items(awkward, one)
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(d) for d, _ in AWKWARD if d not in (5, 6, 9)) and left.columns == awkward.columns
    assert decontaminate.contained_items(empty, one).count() == 0
    assert decontaminate.without_items(awkward, one.limit(0)).count() == len(AWKWARD)


# ------------------------------------------------------------------ vectors


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    x = centres[rng.integers(0, 12, 3000)] + 0.4 * rng.normal(size=(3000, 16))
    x[500:1500] = x[500]  # a third are copies of one vector
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [(5000, None), (5050, [0.0] * 16), (5100, [float("nan")] * 16), (5150, [1.0, None] * 8), (5200, [float("inf")] * 16), (5250, []), (None, [1.0] * 16), (5300, [1.0, 2.0])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumns({"list": F.lit(1), "score": F.lit(2.0)})
    got = {}
    for r in vectors.neighbours(table, "vec_id % 50 = 0", 5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(range(0, 3000, 50))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        sims = vectors.cosine(x, x[q])
        assert all(abs(s - sims[v]) < 1e-12 for _, v, s in found) and all(v != q for _, v, _ in found)
        sims = unit @ unit[q]
        sims[q] = -9
        best = np.lexsort((np.arange(3000), -np.round(sims, 11)))[:5]
        hit += len(set(best.tolist()) & {v for _, v, _ in found})
        if 500 <= q < 1500:
            assert [v for _, v, _ in found] == [i for i in range(500, 507) if i != q][:5]
    assert hit >= 0.9 * 5 * len(got)
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")
    assert vectors.neighbours(few, "vec_id = 0", 5).count() == 2
    assert vectors.neighbours(few.limit(0), "vec_id = 0", 5).count() == 0


@pytest.mark.parametrize("each", [20, 4])  # 500 and 2,500 lists
def test_neighbours_in_many_lists_without_clusters(spark, monkeypatch, each):
    monkeypatch.setattr(vectors, "LIST", each)
    x = np.random.default_rng(5).normal(size=(10_000, 64))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = vectors.neighbours(table, "vec_id % 100 = 0", 5).collect()
    sims = (u := x / np.linalg.norm(x, axis=1, keepdims=True))[::100] @ u.T
    sims[np.arange(100), np.arange(100) * 100] = -9
    best = {(q * 100, int(v)) for q, row in enumerate(sims) for v in np.argsort(-row)[:5]}
    assert len(got) == 500 and len(best & {(r.query_id, r.vec_id) for r in got}) >= 0.95 * 500


def test_graph_finds_the_near_centroids_and_reads_few_lists_of_clustered_rows():
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(1000, 32))
    x = vectors.unit(centres[rng.integers(0, 1000, 12_000)] + 0.3 * rng.normal(size=(12_000, 32)))
    asked, rest = x[:300], x[300:]
    centroids = vectors.balanced(rest, 1000, rng)
    graph = vectors.Graph(centroids)
    ids, dist = vectors.nearest(asked, centroids, 8)
    row, node = graph.search(asked, 1.0)
    found = set(zip(row.tolist(), node.tolist()))
    assert np.mean([(i, int(c)) in found for i, own in enumerate(ids) for c in own]) >= 0.99
    ratio = vectors.fitted_ratio(vectors.needed_ratios(asked[:150], rest, centroids, 5), np.array([9.0]), 0.0)
    assert vectors.fitted_ratio(np.array([2.0]), np.array([3.0]), 0.01) == 2 and vectors.fitted_ratio(np.array([2.0]), np.array([3.0]), 0.1) == 3
    row, node = graph.search(asked[150:], ratio)
    at, lists = vectors.replicas(rest, centroids)
    sizes = np.bincount(lists, minlength=len(centroids))
    assert sizes[node].sum() <= 0.2 * len(asked[150:]) * sizes.sum()
    reads, held = set(zip(row.tolist(), node.tolist())), {}
    for a, c in zip(at.tolist(), lists.tolist()):
        held.setdefault(a, []).append(c)
    near = np.argsort(-(asked[150:] @ rest.T), axis=1)[:, :5]
    assert np.mean([any((q, c) in reads for c in held[int(v)]) for q, own in enumerate(near) for v in own]) >= 0.95


def test_graph_of_equal_and_of_few_centroids():
    same = np.vstack([np.ones((40, 4)), -np.ones((40, 4))]) / 2
    row, node = vectors.Graph(same).search(np.array([[0.5] * 4, [-0.5] * 4]), 1.5)
    assert {(0, i) for i in range(40)} | {(1, i) for i in range(40, 80)} <= set(zip(row.tolist(), node.tolist()))
    row, node = vectors.Graph(same[:1]).search(same[:3], 1.5)
    assert row.tolist() == [0, 1, 2] and node.tolist() == [0, 0, 0]


def test_neighbours_of_tiny_and_huge_vectors(spark):
    x = np.random.default_rng(2).normal(size=(40, 8))
    far = [1e-200 if i % 3 == 0 else 1e200 if i % 3 == 1 else 1.0 for i in range(40)]
    table = spark.createDataFrame([(i, (v * f).tolist()) for i, (v, f) in enumerate(zip(x, far))], "vec_id long, embedding array<double>")
    names = {"bin": F.lit(1), "asks": F.lit(True), "v": F.lit("x"), "lists": F.lit(0)}
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in vectors.neighbours(table.withColumns(names), "vec_id < 5", 3).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q in range(5):
        sims = u @ u[q]
        sims[q] = -9
        for rank, v in enumerate(np.argsort(-sims)[:3], 1):
            assert got[q, rank][0] == v and abs(got[q, rank][1] - sims[v]) < 1e-12


def test_bins_hold_lists_whole_or_alone():
    sizes = {0: 3, 1: 4, 2: 4, 4: 25, 5: 1, 6: 9}
    assert vectors.bins(sizes, 10) == {0: (0, 1), 1: (0, 1), 2: (1, 1), 4: (2, 3), 5: (5, 1), 6: (5, 1)}


# ------------------------------------------------------------------ suffix runs


def brute_repeats(rows):
    least = {}
    raw = [(d, (t or "").encode()) for d, t in rows]
    for d, b in raw:
        for i in range(len(b) - 49):
            s = b[i : i + 50]
            least[s] = min(least.get(s, d), d)
    out = []
    for d, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 49):
            if least[b[i : i + 50]] < d:
                gone[i : i + 50] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_match_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RUN", 200)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 500)
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdeé ") for _ in range(rng.randint(30, 200))) for _ in range(12)]
    rows = []
    for i in range(90):
        parts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 80))) for _ in range(rng.randint(0, 5))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            cut = rng.randint(0, len(p) // 3)
            parts.insert(rng.randint(0, len(parts)), p[cut:])
        rows.append((rng.randint(-5, 5) * 1000 + i, "".join(parts)))
    rows += [(9000, "ab" * 300), (9001, "ab" * 200), (9002, "a" * 120), (9003, "a" * 49), (9004, "a" * 50), (9005, rows[3][1]), (9006, rows[3][1])]
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in suffix_dedup.without_repeats(frame(spark, rows)).collect())
    assert got == brute_repeats(rows)


def test_repeats_awkward(spark, awkward, empty):
    got = suffix_dedup.without_repeats(awkward, keep_bytes=False)
    rows = sorted(tuple(r) for r in got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert rows == [r[:5] for r in brute_repeats([(d, t) for d, t in AWKWARD if d is not None])]
    assert suffix_dedup.without_repeats(empty).count() == 0


def test_loser_tree_merges_front_coded_runs():
    rng = random.Random(6)
    texts = sorted("".join(rng.choice("ab") for _ in range(rng.randint(1, 12))).encode() for _ in range(200))
    sources, dealt = [], [sorted(rng.sample(texts, rng.randint(0, 60))) for _ in range(7)]
    for run in dealt:
        lcps = [0] + [suffix_dedup.common(a, b, 0) for a, b in zip(run, run[1:])] if run else []
        sources.append(suffix_dedup.Run({
            "n": len(run), "lcp": bytes(lcps), "rest": b"".join(t[k:] for t, k in zip(run, lcps)), "before": b"",
            "size": bytes(map(len, run)) + bytes(len(run)), "a": np.arange(len(run)).tobytes(), "b": np.zeros(len(run), np.uint32).tobytes()}))
    got = [(lcp, s.text) for lcp, s in suffix_dedup.merged(sources)]
    assert [t for _, t in got] == sorted(t for run in dealt for t in run)
    assert all(lcp == suffix_dedup.common(a, b, 0) for (_, a), (lcp, b) in zip(got, got[1:]))


# ------------------------------------------------------------------ main text

LINE = "A sentence with some words, and a clause that goes on. " * 6


def test_main_text():
    page = (f"<!doctype html><head><title>T</title><script>var a='</p>';</script></head><header><h1>Site</h1></header><nav><a>Home</a></nav>"
            f"<main><article><header><h1>Head</h1></header><p>Short &amp; <b>bold</b>\n word.<table><tr><td>a<td>b</table>"
            f"<div class=comments><p>{LINE}</div><aside>{LINE}</aside><p>end &#233;&nbsp;x</article></main><div>{LINE}</div><footer>&copy;</footer>")
    assert main_text.main_text(page) == "Head\nShort & bold word.\na\nb\nend é x"
    plain = f"<body><div id=nav><a>x</a></div><div id=content><p>{LINE}<p>{LINE}</div><div class='sidebar'>{LINE}</div><div>Short</div><form>{LINE}</form>"
    assert main_text.main_text(plain) == f"{LINE.strip()}\n{LINE.strip()}"
    for odd in ("", "<", "<nav>a b c</nav>", "<!-- " + LINE, "<script>" + LINE, "<p", "</p></p>", "<div " * 50):
        assert main_text.main_text(odd) in ("", "<")
    assert len(main_text.main_text("<article><p>" + "x. " * 200_000)) == 3 * 200_000 - 1
    main_text.main_text("<div>" * 3000 + LINE)


@pytest.mark.parametrize("lines", [["短い段落です。", "次の段落、です。"], ["这是短段落。", "第二段，也短。"], ["He left.", "She stayed."]])
def test_short_paragraphs_without_article(lines):
    assert main_text.main_text("<body><nav><a>x</a></nav><div>" + "".join(f"<p>{x}</p>" for x in lines) + "</div><footer>y</footer>") == "\n".join(lines)


def test_extracted_awkward(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "u", f"<article>{LINE}</article>"), (1, "u", None)], "page_id long, url string, html string").withColumn("text", F.lit("other"))
    assert sorted(((r.page_id, r.url, r.n_chars) for r in main_text.extracted(pages).collect()), key=str) == sorted([(1, "u", 0), (2, None, 0), (None, "u", len(LINE) - 1), (1, "u", 0)], key=str)
    assert main_text.extracted(pages.limit(0)).count() == 0


# ------------------------------------------------------------------ mixing


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 1}, {"a": 5, "b": 3, "c": 2, "d": 1}, {"a": 97, "b": 2, "c": 1}, {c: i + 1 for i, c in enumerate("abcdefghijklmnop")}])
def test_period_deviates_by_less_than_a_block(weights):
    total = sum(weights.values())
    got = dict.fromkeys(weights, 0)
    for t, s in enumerate(mixing.period(weights), 1):
        got[s] += 1
        assert all(abs(got[x] - w * t / total) < 1 for x, w in weights.items())
    assert got == weights


def test_mixture_against_simulation(spark, empty):
    rows = [(i, f"t{i}") for i in range(700)]
    docs = frame(spark, rows).withColumn("source", F.expr("CASE WHEN doc_id < 450 THEN 'hot' WHEN doc_id < 600 THEN 'b' WHEN doc_id < 690 THEN 'c' END"))
    weights = {"hot": 2, "b": 3, "c": 1, None: 2}
    got = mixing.mix_sources(docs, weights, block_rows=4)
    assert got.columns == [c for c in docs.columns if c not in ("position", "slot")] + ["position", "slot", "release", "deadline"]
    got = sorted(got.select("position", "slot", "release", "deadline", "doc_id", "source").collect())
    assert [r.position for r in got] == list(range(700)) and len({r.doc_id for r in got}) == 700
    assert all(r.release <= r.slot < r.deadline for r in got)
    order = list(dict.fromkeys((r.slot, r.source) for r in got))
    assert [s for s, _ in order] == list(range(len(order)))
    # slot by slot: among sources with blocks left, each has its share but for less than a block
    left = {"hot": 113, "b": 38, "c": 23, None: 3}
    done, active, since = dict.fromkeys(left, 0), dict(weights), 0
    for t, s in order:
        left[s] -= 1
        done[s] += 1
        n, total = t + 1 - since, sum(active.values())
        assert all(abs(done[x] - w * n / total) < 1 for x, w in active.items())
        ended = [x for x in active if not left[x]]
        # a phase ends with the first slot that an ended source would have taken
        nxt = order[t + 1][1] if t + 1 < len(order) else None
        if ended and t + 1 < len(order) and simulate(active, n) in ended:
            for x in ended:
                active.pop(x, None)
            done, since = dict.fromkeys(left, 0), t + 1
            assert nxt in active
    assert not any(left.values())
    assert mixing.mix_sources(empty).count() == 0
    assert mixing.in_mixed_order(docs).columns == docs.columns


def simulate(active, slot):
    named = {"null" if s is None else f"={s}": w for s, w in active.items()}
    s = mixing.period(named)[slot % sum(named.values())]
    return None if s == "null" else s[1:]


# ------------------------------------------------------------------ packing


def test_best_fit_decreasing_is_exact():
    rng = np.random.default_rng(4)
    for capacity in (1, 7, 64, 100):
        lengths = rng.integers(1, capacity + 1, 300)
        rows = packing.best_fit_decreasing(lengths, capacity)
        assert sorted(i for r in rows for i in r) == list(range(300))
        assert all(lengths[r].sum() <= capacity for r in rows)
        rooms = []  # the same by looking at every row
        for n in sorted(lengths.tolist(), reverse=True):
            fit = [r for r in rooms if r >= n]
            if fit:
                rooms.remove(min(fit))
                rooms.append(min(fit) - n)
            else:
                rooms.append(capacity - n)
        assert len(rooms) == len(rows) and sorted(rooms) == sorted(capacity - lengths[r].sum() for r in rows)


def test_packed_rows_give_the_texts_back(spark, awkward, empty, monkeypatch):
    monkeypatch.setattr(packing, "WINDOW", 5000)
    got = packing.packed(awkward, 128).collect()
    from public_tokenizers import PATTERN

    with open(packing.VOCABULARY, "rb") as f:
        enc = packing.encoder(f.read(), PATTERN)
    pieces = {}
    for r in got:
        ids = np.frombuffer(r.ids, "<u2")
        assert len(ids) == 128 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and r.position_resets == r.cu_seqlens[:-1]
        assert (ids[r.n_tokens :] == 50256).all()
        for doc, at, a, b in zip(r.doc_ids, r.doc_offsets, r.cu_seqlens, r.cu_seqlens[1:]):
            pieces.setdefault((doc, at), []).append(ids[a:b].tolist())
    assert len({r.pack_id for r in got}) == len(got)
    for doc, text in AWKWARD:
        if doc == 6:
            continue
        ids = [t for (d, _), p in sorted(((k, v) for k, v in pieces.items() if k[0] == doc), key=lambda x: x[0][1]) for t in p[0]]
        assert ids[-1] == 50256 and enc.decode(ids[:-1]) == (text or "")
    assert len(pieces[6, 0]) == 2
    assert packing.packed(empty, 128).count() == 0


BODY = "".join(f"<p>{LINE}</p>" for _ in range(4))


def test_body_beside_a_teaser_article():
    page = f"<body><nav><a>Home</a></nav><div class=story>{BODY}</div><article><h3>Teaser</h3><p>Read this now</p></article><footer>c</footer>"
    assert main_text.main_text(page) == "\n".join([LINE.strip()] * 4)


@pytest.mark.parametrize("wrapper", ['<div class="page has-sidebar">', '<div class="post-side share">', '<div id=side><section class="widget">'])
def test_names_of_wrappers_only_weigh(wrapper):
    assert main_text.main_text(f"<body>{wrapper}<nav><a>x</a></nav><div>{BODY}</div>").startswith(LINE.strip())
    assert main_text.main_text(f"<body><nav><a>x</a></nav>{wrapper}{BODY}</div><footer>x</footer>").count(LINE.strip()) == 4


@pytest.mark.parametrize("tag", ['<p title="a"">', "<p title='it's'>", "<p a=b\"c>", '<p "x">', "<p title = 'a>b' >", "<p =x>", "<p a= >"])
def test_tags_end_where_they_end(tag):
    assert main_text.main_text(f"{tag}One sentence, here.</p><p>Two sentences, there.</p>") == "One sentence, here.\nTwo sentences, there."


@pytest.mark.parametrize("page", ["<div>x" * 20_000, "<b>" * 20_000 + "</i>" * 20_000 + "x", "<p>" + "<span>" * 20_000 + "<hr>" * 20_000 + "<li>x" * 20_000, "<p " + 'a b="c' * 50_000, "<a " * 50_000])
def test_time_grows_with_the_page_alone(page):
    import time

    start = time.process_time()
    main_text.main_text(page)
    assert time.process_time() - start < 3


def test_the_ratios_decide(monkeypatch):
    """Plain boxes without telling names: short ones go by their ratio, and stay if it is taken out."""
    boxes = "".join(f"<div class=c{c}><span>{w}</span></div>" for c, w in zip("xyz", ("Log in", "Weather", "Top 10")))
    page = f"<body>{boxes}<div class=t>{BODY}</div><div class=e><i>More</i></div>"
    assert main_text.main_text(page) == "\n".join([LINE.strip()] * 4)
    monkeypatch.setattr(main_text, "ratios", lambda paths, found: dict.fromkeys(range(len(paths.parent)), 1.0))
    assert "Log in" in main_text.main_text(page)


def test_weighed_pieces_do_not_break_a_line():
    assert main_text.main_text(f"<article>{BODY}<p>{LINE}<button>Copy</button> and the rest.</p></article>").endswith(f"{LINE}and the rest.")
    assert main_text.main_text(f"<article>{BODY}<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> hold.</p></article>").endswith("Let x=1 hold.")


def test_sums_of_regions_match_brute_force():
    rng = random.Random(6)
    for _ in range(30):
        page = "".join(rng.choice(["<div>", "</div>", "<p>", "<section id=a>", "</section>", "words, words. ", "x ", "<aside>", "</aside>", "<article>"]) for _ in range(80))
        paths, found = main_text.page_pieces(page)
        own = [[0.0, 0.0, 0.0] for _ in paths.parent]
        for path, _, text in found:
            own[path][0] += len(text.strip())
            own[path][1] += 1
        above = [[i] for i in range(len(paths.parent))]
        for i in range(1, len(paths.parent)):
            above[i] = [i, *above[paths.parent[i]]]
        for i in range(len(paths.parent)):
            if own[i][1] and i and (paths.article[i] or not paths.top[i]):
                value = None
                for j in reversed(above[i]):
                    if paths.top[j] and not (paths.article[j] or paths.main[j]):
                        value = None
                        continue
                    below = [k for k in range(len(paths.parent)) if j in above[k]]
                    n = sum(own[k][1] for k in below)
                    ratio = sum(own[k][0] for k in below) / n
                    value = ratio if value is None or paths.top[j] else main_text.OWN * ratio + (1 - main_text.OWN) * value
                want = main_text.OWN * own[i][0] / own[i][1] + (1 - main_text.OWN) * value
                assert main_text.smoothed(paths, own)[0][i] == pytest.approx(want)


def test_long_runs_are_encoded_as_short_ones(monkeypatch):
    from public_tokenizers import PATTERN

    with open(packing.VOCABULARY, "rb") as f:
        enc = packing.encoder(f.read(), PATTERN)
    rng = random.Random(9)
    with monkeypatch.context() as m:
        m.setattr(packing, "RUN", 5)
        for _ in range(3000):
            text = "".join(rng.choice([" ", "\n", "\t", "  ", " \n", "a", "é", "'s", "!", "1", "　", "\x1c", "\x85", "中"]) * rng.randint(1, 9) for _ in range(rng.randint(0, 9)))
            assert packing.encoded(enc, text) == enc.encode_ordinary(text)
    for c, n in ((" ", 10**7), ("\n", 10**6), (" \n", 10**6), ("a", 10**6), ("!", 10**6), ("中", 10**6)):
        text = f"x{c * n}y{c * n}"
        assert enc.decode(packing.encoded(enc, text)) == text


def test_long_white_space_is_packed(spark):
    rows = [(1, " " * 1_000_000), (2, "\n" * 1_000_000 + "x"), (3, "plain")]
    out = packing.packed(frame(spark, rows, extra=False), 2048).agg(F.sum("n_tokens")).first()[0]
    assert out == 1_000_001 + 1_000_002 + 2


def test_anchors_spread_over_the_buckets():
    rng = np.random.default_rng(3)
    text = rng.choice(np.frombuffer(b"abcdefghij klmnop", np.uint8), 2_000_000)
    hashes = suffix_dedup.stretches(text, np.array([0, len(text)]))[4]
    for n in (16, 200):
        sizes = np.bincount(suffix_dedup.bucket_of(hashes, n), minlength=n)
        assert sizes.max() < 2 * sizes.mean()


def test_workers_need_no_copy_of_the_package(tmp_path):
    import os
    import subprocess
    import sys
    import textwrap

    from floodledger import __file__ as package

    code = textwrap.dedent("""
        import sys
        from pyspark.sql import SparkSession
        sys.path.insert(0, sys.argv[1])
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
            .config("spark.checkpoint.dir", sys.argv[2]).config("spark.sql.warehouse.dir", sys.argv[2]).getOrCreate())
        from floodledger.llm import decontaminate, filter_audit, fill_middle, language, main_text, packing, personal, quality, toxicity
        docs = spark.createDataFrame([(i, f"word {i} mail a{i}@b.org and more words here today", "en", "s", 9) for i in range(30)], "doc_id long, text string, lang string, source string, n_chars long")
        labels = spark.createDataFrame([(i, i % 2, i % 3 // 2) for i in range(30)], "doc_id long, quality int, toxic int")
        items = spark.createDataFrame([(1, "and more words here today")], "item_id long, text string")
        pages = spark.createDataFrame([(1, "u", "<p>x")], "page_id long, url string, html string")
        for df in (personal.personal_data(docs), language.identified(docs), decontaminate.contained_items(docs, items), quality.scored(docs, labels),
                   toxicity.scored(docs, labels), fill_middle.fill_in_middle(docs), packing.packed(docs), main_text.extracted(pages)):
            print(df.count())
        def probe(batches):
            try:
                import floodledger
                found = True
            except ImportError:
                found = False
            import pyarrow as pa
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([found])], names=["found"])
        assert [r.found for r in spark.range(1).coalesce(1).mapInArrow(probe, "found boolean").collect()] == [False]
    """)
    (tmp_path / "job.py").write_text(code)
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    root = os.path.dirname(os.path.dirname(package))
    done = subprocess.run([sys.executable, str(tmp_path / "job.py"), root, str(tmp_path / "shared")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]


def test_containment_search_prunes_both_sides_without_losing_a_match():
    """Documents of all sizes that hold just enough of an item, or just too little, each found or left as counted by hand."""
    rng = np.random.default_rng(3)
    items, docs = [], []
    for i, size in enumerate([1, 2, 3, 5, 6, 9, 14, 20, 33, 60, 140]):
        own = [f"i{i}w{j}" for j in range(size + 4)]
        items.append(" ".join(own))
        for lead in (0, 3, 400):
            for held in (size, decontaminate.needed(size, 0.8), decontaminate.needed(size, 0.8) - 1):
                at = int(rng.integers(0, size - held + 1))
                other = [f"o{v}" for v in rng.integers(0, 50, lead)]
                docs.append(" ".join(other + own[at : at + held + 4 if held else 0] + other))
    index = decontaminate.Index(list(range(len(items))), items, 5, 0.8)
    shingle = lambda text: {tuple(text.split()[j : j + 5]) for j in range(len(text.split()) - 4)}
    want = set()
    for r, text in enumerate(docs):
        for i, item in enumerate(items):
            common = len(shingle(item) & shingle(text))
            if 100 * common >= 80 * len(shingle(item)):
                want.add((r, i, common))
    raw = [d.encode() for d in docs]
    offsets = np.cumsum([0] + [len(b) for b in raw], dtype=np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    assert set(index.search(data, offsets)) == want and len(want) > 60
    # larger items have sketches of small hashes only, and small documents are not probed for them
    parts = index.by_width[5]
    assert len(parts) > 6 and all(a.bound >= b.bound for a, b in zip(parts, parts[1:]))
    largest = max(parts, key=lambda p: p.fewest)
    assert largest.fewest == 112 and largest.bound < np.uint64(2**63)
