"""Filter audit, toxicity and fill-in-the-middle against brute force, and on awkward tables."""

import hashlib
import itertools
import random
import re
from fractions import Fraction
from math import factorial

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from floodledger.llm import fill_middle, filter_audit, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i * 7919 % 30011}" for i in range(30000))
AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "a b c d e f g"), (6, "a b c d e f g"), (6, "a b c d e f g"), (None, "x y z"), (None, None),
    (7, LONG), (8, "Éé ü 中文"), (9, "A B C D E F G"), (10, "word"), (11, "no <S> here\n"), (12, "\n\n\n"), (13, "ab\ncd"), (14, "€\n𝄞é\r\nz\n"), (15, "x" * 300_000 + "\n" + "ß" * 1000),
]


def frame(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.when(F.col("doc_id") % 3 == 0, "a").when(F.col("doc_id") % 3 == 1, "b"), "n_chars": F.length("text").cast("long")})
    if extra:
        names = ("part", "fails", "good", "toxic", "same", "n", "at", "gone", "shares", "form", "output", "h1", "restored", "score", "held_out", "quality")
        df = df.withColumns({c: F.lit(c) for c in names})
    return df


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, []).persist()


# ------------------------------------------------------------------ filter audit


def brute_audit(rows, labels):
    """rows: (doc_id, text, source)"""
    good = {d for d, q, t in labels if q == 1} - {None}
    toxic = {d for d, q, t in labels if t == 1} - {None}
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(least.get(t or "", d), d)
    docs = []
    for d, t, s in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = {
            "A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": d is not None and d > least[t]}
        docs.append((d, s or "", fails))
    out = {}
    for part in {s for _, s, _ in docs}:
        mine = [(d, f) for d, s, f in docs if s == part]
        shares = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [(d, f) for d, f in left if f[x]]
                left = [(d, f) for d, f in left if not f[x]]
                shares[x] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f[x] for _, f in mine) - len(gone), sum(f[x] and sum(f.values()) == 1 for _, f in mine),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shares[order[step - 1]])
    return out


def test_audit_matches_replay_of_all_orders(spark, empty):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["aa", "Bb", "CC", "d#", "ee", f"x{rng.random()}"]) for _ in range(rng.choice([10, 49, 50, 70]))) for _ in range(40)]
    rows = AWKWARD + [(100 + i, rng.choice(texts)) for i in range(150)]
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d, _ in rows if d and rng.random() < 0.6] + [(None, 1, 1), (4, 0, 1), (4, 1, 0)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit(1))
    got = filter_audit.audit(frame(spark, rows), lab).collect()
    source = lambda d: None if d is None or d % 3 == 2 else "ab"[d % 3]
    assert {(r.part, r.filter_order, r.step): list(r)[3:] for r in got} == brute_audit([(d, t, source(d)) for d, t in rows], labels)
    assert len(got) == 3 * 600
    assert filter_audit.audit(empty, lab).count() == 0
    none = filter_audit.audit(frame(spark, AWKWARD), lab.limit(0)).agg(F.sum("good_lost"), F.count("*")).first()
    assert tuple(none) == (0, 1800)


@pytest.mark.parametrize("n", [2, 3, 5])
def test_least_squares_shares_are_mean_marginal_gains(n):
    rng = random.Random(n)
    game = [0] + [rng.randint(0, 10**12) for _ in range(2**n - 1)]
    weights, d = filter_audit.shapley_weights(n)
    for i in range(n):
        total = 0
        for order in itertools.permutations(range(n)):
            before = sum(1 << j for j in order[: order.index(i)])
            total += game[before | 1 << i] - game[before]
        assert Fraction(sum(w * v for w, v in zip(weights[i], game)), d) == Fraction(total, factorial(n))


def test_copies_make_no_hot_join_key(spark):
    rows = frame(spark, [(i, "the same text") for i in range(300)] + [(i, f"t {i}") for i in range(300, 330)])
    got = filter_audit.audit(rows, spark.createDataFrame([], "doc_id long, quality int, toxic int")).where("filter_order = 'EABCD' AND step = 1")
    assert got.agg(F.sum("removed"), F.sum("kept")).first()[:] == (299, 31)


# ------------------------------------------------------------------ fill in the middle


def brute_middle(doc_id, text, rate=100):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    h = hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()
    h = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("rate", [100, 40])
def test_middles_match_brute_force_and_go_back(spark, empty, rate):
    rng = random.Random(2)
    rows = AWKWARD + [(100 + i, "".join(rng.choice("ab<PSM>é€𝄞\n\r ") for _ in range(rng.randint(0, 60)))) for i in range(300)]
    out = fill_middle.restored(fill_middle.fill_in_middle(frame(spark, rows), rate=rate)).collect()
    want = sorted((d, t or "", *brute_middle(d, t, rate)) for d, t in rows if d is not None)
    key = lambda r: (r[0], r[1])
    got = sorted(((r.doc_id, r.restored, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out), key=key)
    assert got == sorted(want, key=key)
    assert {"plain", "psm", "spm"} == {r.form for r in out}
    assert fill_middle.fill_in_middle(empty).count() == 0


def test_character_cuts_go_back(spark):
    rows = [(i, "é€𝄞a" * i + "z") for i in range(60)]
    out = fill_middle.restored(fill_middle.fill_in_middle(frame(spark, rows), unit="chars")).collect()
    assert {(r.doc_id, r.restored, r.n) for r in out} == {(d, t, len(t)) for d, t in rows}
    assert all(r.prefix_chars + r.middle_chars <= r.n for r in out)


def test_sparse_index_holds_only_wide_characters():
    text = "plain " * 1000 + "é" + "x" * 500 + "𝄞€"
    index = fill_middle.Exceptions(np.frombuffer(text.encode(), np.uint8))
    assert len(index.at) == 3 and len(fill_middle.Exceptions(np.frombuffer(b"ascii" * 99, np.uint8)).at) == 0
    chars = np.arange(len(text) + 1)
    places = np.array([len(text[:i].encode()) for i in chars])
    assert (index.to_bytes(chars) == places).all() and (index.to_chars(places) == chars).all()


# ------------------------------------------------------------------ toxicity


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    part = ["".join(rng.choice("bcdfg") + rng.choice("aeiou") for _ in range(rng.randint(1, 2))) for _ in range(30)]
    word = lambda: "".join(rng.choice(part) for _ in range(rng.randint(1, 2)))
    rows, labels = [], []
    for i in range(n):
        w = [word() for _ in range(rng.randint(20, 150))]
        bad = i % 6 == 0
        if bad:
            for _ in range(max(2, len(w) // 25)):
                insult = rng.choice(["grumbo", "snarfel", "plonk", "véxar" + rng.choice(part)])
                w[rng.randrange(len(w))] = insult.upper() if rng.random() < 0.2 else insult
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, empty):
    rows, labels = corpus()
    more = [(9000, None), (9001, ""), (9002, " .. \n"), (9003, "plonk " * 50_000), (9004, rows[1][1] + " you gr" + "umb0 snarf3l pl0nk gr@mbo"), (None, "plonk"), (5, rows[5][1])]
    lab = spark.createDataFrame(labels + [(None, 1), (7, None), (8, 5)], "doc_id long, toxic int").withColumn("score", F.lit(1))
    got = toxicity.scored(frame(spark, rows + more), lab).collect()
    assert len(got) == len(rows) + len(more) - 1 and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 9000]
    toxic = [r for r in held if r.doc_id % 6 == 0]
    clean = [r for r in held if r.doc_id % 6]
    assert len(toxic) > 20 and sum(r.predicted for r in toxic) >= 0.95 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    at = {r.doc_id: r for r in got}
    assert not any(at[i].predicted for i in (9000, 9001, 9002)) and at[9003].predicted
    assert toxicity.scored(empty, lab).count() == 0
    # labels of held-out rows change nothing
    wrong = lab.withColumn("toxic", F.when(F.expr("crc32(cast(doc_id AS string)) % 4 = 2"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.scored(frame(spark, rows), wrong).collect()}
    assert all(again[d] == at[d].score for d, _ in rows)


def test_toxicity_with_one_class_or_none(spark):
    rows = frame(spark, AWKWARD)
    one = spark.createDataFrame([(4, 1), (5, 1), (9, 1), (10, 1)], "doc_id long, toxic int")
    assert {(r.score, r.predicted) for r in toxicity.scored(rows, one).collect()} == {(1.0, 1)}
    assert {(r.score, r.predicted) for r in toxicity.scored(rows, one.limit(0)).collect()} == {(0.0, 0)}


def test_features():
    lexicon = {"words": np.sort(toxicity.encoded(["bad", "stupid"])), "word_weights": np.array([4.0, 4.0]), "stems": np.sort(toxicity.encoded(["grum"])), "stem_weights": np.array([2.0])}
    texts = ["You are BAD, bad!", "st0p1d $tup1d stup!d here", "nothing here", "", "grumpel grum éa", "bad " + "x " * 9 + "you"]
    (_, doc), = toxicity.parsed(pa.array(texts))
    x = {name: col for name, col in zip(toxicity.FEATURES, doc.features(lexicon).T)}
    assert x["listed"].tolist() == [0.5, 0, 0, 0, 0, 1 / 11]
    assert x["near_second_person"].tolist() == [0.5, 0, 0, 0, 0, 0]
    assert x["stems"].tolist() == [0, 0, 0, 0, 1 / 3, 0]  # only words longer than the stem
    assert x["hidden"][1] > 0 and x["obfuscated"].tolist() == [0, 3 / 4, 0, 0, 0, 0]
    assert x["capital_words"].tolist() == [1 / 4, 0, 0, 0, 0, 0]
    assert x["exclamations"][0] == 1 / len(texts[0])


def test_isotonic_pools_neighbours():
    place, p = toxicity.isotonic(np.array([1.0, 2, 3, 4]), np.array([0, 1, 0, 1]), np.ones(4))
    assert place.tolist() == [1, 2.5, 4] and p.tolist() == [0, 0.5, 1]


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (2000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(np.int64)
    trees = toxicity.grow(x[:1500], y[:1500], np.ones(1500))
    raw = toxicity.raw_scores(x[1500:], trees)
    assert ((raw > 0) == y[1500:]).mean() > 0.95
