"""Language ID and the quality classifier against plain counterparts, step by step."""

import math
import unicodedata
from collections import Counter

import numpy as np
import pytest
import regex
from linkflow.llm import langid, quality
from linkflow.llm.common import train_split
from pyspark.sql import functions as F

from tests.llm.data import ROWS, SENTENCES, docs, held, words


# ------------------------------------------------------------------ language ID
def slot(gram):
    return (gram * 2654435761 % (1 << 32)) >> 20


def grams(text):
    """Hashed counts of byte pairs and triples of a text's lower-cased words."""
    low = (text or "").lower()
    if not any(map(str.isalpha, low)):
        return None
    raw = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in low.encode("utf-8", "ignore"))
    raw = b" " + b" ".join(raw.split()) + b" "
    if len(raw) < 3:
        return None
    out = Counter(slot((raw[i] << 8) | raw[i + 1]) for i in range(len(raw) - 1))
    out.update(slot((1 << 24) | (raw[i] << 16) | (raw[i + 1] << 8) | raw[i + 2]) for i in range(len(raw) - 2))
    return out


def unit(counts, idf):
    v = {d: (1 + math.log(n)) * idf[d] for d, n in counts.items()}
    size = math.sqrt(sum(x * x for x in v.values()))
    return {d: x / size for d, x in v.items()}


def corpus():
    rows = [r for r in ROWS if r[0] != 9]
    for k, (lang, s) in enumerate(SENTENCES.items()):
        w = s.split()
        rows += [(100 * (k + 1) + i, " ".join(w[i % 5:] + w[:i % 7] + [f"wort{i}"]), lang, "a") for i in range(25)]
    return rows


def test_language_id_equals_brute_force(spark):
    rows = corpus()
    split = train_split(F.col("doc_id"), 4, 2)
    model = langid.train_model(docs(spark, rows), ~split)
    train = [(r[2], c) for r in rows if r[2] and not held(r[0], 4, 2) and (c := grams(r[1]))]
    have = Counter(d for _, c in train for d in c)
    idf = [math.log((1 + len(train)) / (1 + have[d])) + 1 for d in range(langid.DIMS)]
    assert model.idf == pytest.approx(idf, rel=1e-5)
    assert set(model.labels) == {r[2] for r in rows if r[2] and not held(r[0], 4, 2) and grams(r[1])}
    # every centroid is the mean direction of the training documents nearest to it in their language
    got = {(r.doc_id, r.lang_pred, round(r.score, 4)) for r in langid.identify(docs(spark, rows), split).collect()}
    want = set()
    for i, t, *_ in rows:
        c = grams(t)
        near = [sum(x * float(m[d]) for d, x in unit(c, idf).items()) for m in model.centroids] if c else []
        best = max(range(len(near)), key=lambda j: (near[j], -j)) if near else None
        want.add((i, "und", 0.0) if best is None else (i, model.labels[best], round(min(max(near[best], 0), 1), 4)))
    assert {x[:2] for x in got} == {x[:2] for x in want}
    score = {x[:2]: x[2] for x in want}
    assert all(abs(s - score[i, lang]) < 2e-3 for i, lang, s in got)


def test_equal_cosines_go_to_the_first_language(spark):
    text = "the same words for all"
    v = langid.vectors([langid.counts(text)], np.ones(langid.DIMS, np.float32))
    model = langid.Model(["aa", "bb", "cc"], np.concatenate([v * 0.5, v, v]), np.ones(langid.DIMS, np.float32), 0.0)
    frame = spark.createDataFrame([(text,), (text,)], "t string")
    assert {r.p.lang for r in frame.select(langid.predict(F.col("t"), model).alias("p")).collect()} == {"bb"}


# ------------------------------------------------------------------ quality classifier
def kind(ch):
    cat = unicodedata.category(ch)
    if cat in ("Ll", "Lu", "Nd"):
        return {"Ll": 0, "Lu": 1, "Nd": 3}[cat]
    if cat in ("Lt", "Lm", "Lo") or cat[0] == "M":
        return 2
    return 4 if ch in " \t\n\x0b\x0c\r" else 5 if ch in ".,;:!?'\"()-" else 6 if ch in "#*$%&|<>" else 7


def plain_votes(text):
    text = text or ""
    w, c = words(text), Counter(map(kind, text))
    n, letters, solid = len(w), c[0] + c[1] + c[2], len(text) - c[4]
    bare = sum(not regex.search(r"[\p{L}\p{N}]", x) for x in w)
    again = sum(a == b for a, b in zip(w, w[1:], strict=False))
    lines = text.strip(" \t\n\x0b\x0c\r").split("\n")
    full = [x for x in text.split("\n") if words(x)]
    dup = len(full) - len(set(full))

    def vote(good, bad):
        return quality.BAD if bad else quality.GOOD if good else quality.ABSTAIN

    return (vote(c[1] < 0.2 * letters, c[1] > 0.5 * letters),
            vote(c[6] < 0.005 * len(text), c[6] > 0.04 * len(text)),
            vote(n >= 30 and len(set(w)) > 0.3 * n, n >= 30 and len(set(w)) < 0.2 * n),
            vote(3 * n <= solid <= 9 * n, solid < 2 * n or solid > 14 * n),
            vote(bare < 0.02 * n, bare > 0.15 * n),
            vote(0.01 * n <= c[5] <= 0.5 * n, n >= 50 and (c[5] == 0 or c[5] > n)),
            vote(False, len(lines) >= 3 and dup > 0.3 * len(lines)),
            vote(letters > 0.9 * solid, letters < 0.75 * solid),
            vote(n >= 10 and again < 0.03 * n, n >= 10 and again > 0.08 * n))


def plain_posteriors(all_votes, rounds=100):
    """Expectation-maximisation document by document."""
    up, down = quality.GOOD, quality.BAD
    post = [(v.count(up) + 0.5) / (v.count(up) + v.count(down) + 1) for v in all_votes]
    for _ in range(rounds):
        rates = []
        for k in range(len(all_votes[0])):
            of = {}
            for y in (0, 1):
                weight = {s: 0.1 + sum(p if y else 1 - p for v, p in zip(all_votes, post, strict=True) if v[k] == s)
                          for s in (up, down)}
                of[y] = {s: x / (weight[up] + weight[down]) for s, x in weight.items()} | {quality.ABSTAIN: 1.0}
            rates.append(of)
        good = min(max(sum(post) / len(post), 1e-6), 1 - 1e-6)
        odds = [math.log(1 - good) - math.log(good) + sum(math.log(r[0][s]) - math.log(r[1][s]) for r, s in
                                                          zip(rates, v, strict=True)) for v in all_votes]
        post = [1 / (1 + math.exp(min(max(x, -700), 700))) for x in odds]
    return post


def junk_and_prose():
    rows = [r for r in ROWS if r[0] != 9]
    for i in range(30):
        rows += [(200 + i, " ".join(SENTENCES["en"].split()[i % 9:]) + " More of it, number " + "x" * (i % 5) + ".", "en", "a"),
                 (300 + i, "## $$ BUY BUY NOW " * (i % 6 + 2), "en", "a"), (400 + i, "l1\nl1\nl1\nl1\n" * (i % 3 + 1), "en", "a")]
    return rows


def test_votes_and_posteriors_equal_brute_force(spark):
    rows = junk_and_prose()
    frame = docs(spark, rows)
    got = frame.select("doc_id", quality.votes(F.coalesce("text", F.lit(""))).alias("v")).collect()
    want = [(r[0], plain_votes(r[1])) for r in rows]
    assert Counter((r.doc_id, tuple(r.v)) for r in got) == Counter(want)
    post = plain_posteriors([v for _, v in want])
    weak = sorted((str(r.doc_id), round(r.weak_good, 6)) for r in quality.classify(frame, with_votes=True).collect())
    for (a, x), (b, y) in zip(weak, sorted((str(i), round(p, 6)) for (i, _), p in zip(want, post, strict=True)), strict=True):
        assert a == b and x == pytest.approx(y, abs=1e-4)


def test_scores_follow_the_posteriors(spark):
    """The scorer, which sees hashed bytes alone, comes to the label model's side of 0.5."""
    got = quality.classify(docs(spark, [r for r in junk_and_prose() if r[0] and r[0] >= 200]), with_votes=True).collect()
    agree = sum((r.weak_good >= 0.5) == r.kept for r in got)
    assert agree >= 0.95 * len(got) and {r.kept for r in got} == {True, False}
    assert all(r.kept == (r.score >= 0.5) for r in got)


@pytest.mark.parametrize("text", ["", "ab", "the the cat", "é日 x x x", "z" * 5000])
def test_features_are_scaled_log_counts(text):
    raw = text.encode()
    w = raw.split()
    counts = Counter()
    padded = b" " + raw + b" "
    for i in range(len(padded) - 2):
        counts[slot((padded[i] << 16) | (padded[i + 1] << 8) | padded[i + 2])] += 1
    v = np.zeros(quality.DIMS + 1)
    for d, n in counts.items():
        v[d] = math.log1p(n)
    v[-1] = 4 * math.log1p(sum(a == b for a, b in zip(w, w[1:], strict=False)))
    assert quality.features(raw) == pytest.approx(v / (np.linalg.norm(v) + 4), abs=1e-5)
