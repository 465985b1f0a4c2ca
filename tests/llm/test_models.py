"""Language ID, LM scoring and the quality classifier."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkflow.llm import langid, lm, quality
from linkflow.llm.common import train_split
from tests.llm.data import ROWS, SENTENCES, docs, held, lowered, words


def corpus(n=240, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = ("en", "fr", "de")[i % 3]
        w = SENTENCES[lang].split()
        rows.append((1000 + i, " ".join(rng.choice(w) for _ in range(rng.randint(8, 60))), lang, "a"))
    return rows


def test_train_split(spark):
    ids = [None, *range(50), -3]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id bigint")
    assert [r[0] for r in df.select(train_split(F.col("doc_id"), 7, 2)).collect()] == [held(i, 7, 2) for i in ids]


# ---------------------------------------------------------------- language ID
def test_language_id(spark):
    rows = [*corpus(), *ROWS, (30, "これは別の言葉で書かれた長い文章で、どの言語の中心からも遠いものです。" * 3, None, "a")]
    got = langid.identify(docs(spark, rows), train_split(F.col("doc_id"), 4, 2)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    tested = [(by[r[0]].lang_pred, r[2]) for r in corpus() if held(r[0], 4, 2)]
    assert len(tested) > 20 and sum(a == b for a, b in tested) >= 0.95 * len(tested)
    assert all(0 <= r.score <= 1 and r.held_out == held(r.doc_id, 4, 2) for r in got)
    for i in (4, 5, 6, 7):  # null, empty, blank, no letter
        assert (by[i].lang_pred, by[i].score, by[i].rejected) == ("und", 0.0, True)
    assert by[30].rejected and not any(by[r[0]].rejected for r in corpus())
    assert {r.lang_pred for r in got} <= {"en", "fr", "de", "und"}


def test_language_id_does_not_read_held_out_labels(spark):
    """Prediction uses the text alone, learning only rows that are not held out."""
    rows = corpus()
    changed = [(i, t, "xx" if held(i, 4, 2) else lang, "zz") for i, t, lang, _ in rows]
    run = lambda r: sorted((x.doc_id, x.lang_pred, round(x.score, 5)) for x in langid.identify(
        docs(spark, r), train_split(F.col("doc_id"), 4, 2)).collect())
    assert run(rows) == run(changed)


def test_language_id_without_labels(spark):
    got = langid.identify(docs(spark, [(1, "some text", None, "a"), (2, None, None, "a")]), F.lit(False)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2
    assert langid.identify(docs(spark, []), F.lit(False)).count() == 0


def test_ngram_counts_do_not_depend_on_parts():
    text = "abcd éè " * 200_000
    whole = langid.counts(text)
    raw = b" " + " ".join(text.split()).encode() + b" "
    a = np.frombuffer(raw, np.uint8).astype(np.uint32)
    pair = (a[:-1] << 8) | a[1:]
    triple = (pair[:-1] << 8) | a[2:] | (1 << 24)
    want = sum(np.bincount((g.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(20), minlength=langid.DIMS)
               for g in (pair, triple))
    assert (whole == want).all()


# ---------------------------------------------------------------- LM scoring
@pytest.mark.parametrize("head", [5, 1 << 18])
def test_lm_base_score(spark, head):
    rows = [*ROWS, *corpus(60)]
    got = lm.score(docs(spark, rows), train_split(F.col("doc_id"), 7, 2), head_words=head).collect()
    tokens = [words(lowered(r[1])) + ["\n"] for r in rows]
    c = Counter(t for r, ts in zip(rows, tokens, strict=True) if not held(r[0], 7, 2) for t in ts)
    n, v = sum(c.values()), len(c)
    want = sorted([(r[0], held(r[0], 7, 2), len(ts), sum(c[t] > 0 for t in ts), n,
                    round(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts), 5))
                   for r, ts in zip(rows, tokens, strict=True)], key=str)
    assert sorted([(g.doc_id, g.held_out, g.n_tokens, g.n_known, g.train_tokens, round(g.base_score, 5))
                   for g in got], key=str) == want
    assert all(g.score < 0 for g in got)


def test_lm_words_are_counted_in_the_tasks(spark):
    """Only the distinct words of a batch become rows, not every word of every text."""
    rows = [*ROWS, *corpus(30), (90, "and and, \u2003 And\x0band ", "en", "a")]
    counts = lm.word_counts(docs(spark, rows))
    assert "Generate" not in counts._jdf.queryExecution().executedPlan().toString()
    c = Counter(w for r in rows for w in words(lowered(r[1])))
    assert sorted(r.n for r in counts.collect()) == sorted(c.values())


def test_lm_edges(spark):
    assert lm.score(docs(spark, []), F.lit(False)).count() == 0
    got = lm.score(docs(spark, [(1, "all held out", "en", "a")]), F.lit(True)).first()
    assert (got.n_known, got.train_tokens, got.base_score) == (0, 0, 0.0)


def _model(seed=0):
    rng = np.random.default_rng(seed)
    pairs = rng.integers(0, 3, (lm.CLASSES + 1, lm.CLASSES)) * (rng.random((lm.CLASSES + 1, lm.CLASSES)) < 0.05)
    return lm.classes_of(np.arange(lm.IDS) % lm.CLASSES, np.log(np.full(lm.IDS, lm.CLASSES / lm.IDS)), pairs)


def test_lm_probabilities_sum_to_one_and_windows_cover_all():
    import pyarrow as pa
    model, rng = _model(), np.random.default_rng(1)
    w = lm.initial(model.embed)
    w["out"] *= 20
    bounds = np.array([0, 70, 71, 170])
    classes = rng.integers(0, lm.CLASSES, 170)
    start, text = lm.windows(bounds)
    inputs, there, targets, scored = lm.batch(classes, bounds, start, text)
    assert scored.sum() == 170  # each id in one window
    a, _, z, _ = lm.forward(w, model.mass, inputs, there)
    total = np.zeros(z.shape)
    for c in range(lm.CLASSES):
        total += np.exp(lm.log_probabilities(a, z, model, inputs, np.full_like(targets, c)))
    assert np.abs(total - 1).max() < 1e-3
    # batches of texts score as texts alone, and padding does not leak
    ids = [rng.integers(0, 40_000, n).astype("<u2").tobytes() for n in (1, 33, 200, 5)]
    together = lm.log10_probabilities(pa.array(ids, pa.binary()), model, w)
    alone = [lm.log10_probabilities(pa.array([i], pa.binary()), model, w)[0] for i in ids]
    assert together == pytest.approx(alone, rel=1e-5)


def test_lm_is_causal():
    """An id's probability does not change with the ids after it."""
    model, rng = _model(), np.random.default_rng(2)
    w = lm.initial(model.embed)
    w["out"] *= 20
    classes, bounds = rng.integers(0, lm.CLASSES, 60), np.array([0, 60])
    start, text = lm.windows(bounds)

    def each(c):
        inputs, there, targets, _ = lm.batch(c, bounds, start, text)
        a, _, z, _ = lm.forward(w, model.mass, inputs, there)
        return lm.log_probabilities(a, z, model, inputs, targets).ravel()[:60]

    changed = classes.copy()
    changed[40:] = (changed[40:] + 5) % lm.CLASSES
    assert each(classes)[:40] == pytest.approx(each(changed)[:40], rel=1e-5)


def test_lm_gradient():
    model, rng = _model(), np.random.default_rng(3)
    import dataclasses
    model = dataclasses.replace(model, mass=model.mass.astype(float), after=model.after.astype(float))
    w = {n: a.astype(np.float64) for n, a in lm.initial(model.embed).items()}
    bounds = np.array([0, 50, 90])
    b = lm.batch(rng.integers(0, lm.CLASSES, 90), bounds, *lm.windows(bounds))
    g = lm.gradient(w, model, *b)

    def loss(w):
        a, _, z, _ = lm.forward(w, model.mass, b[0], b[1])
        return -(lm.log_probabilities(a, z, model, b[0], b[2]) * b[3]).sum() / b[3].sum()

    for name in w:
        at = (int(b[0][1, 20]), 3) if name == "embed" else (3, 5)
        up, down = ({k: v.copy() for k, v in w.items()} for _ in range(2))
        up[name][at] += 1e-5
        down[name][at] -= 1e-5
        assert (loss(up) - loss(down)) / 2e-5 == pytest.approx(g[name][at], rel=1e-3, abs=1e-8)


def test_lm_steps_equal_plain_ones():
    """Adam in place on one vector, and the sums by input, against plain counterparts."""
    model, rng = _model(), np.random.default_rng(4)
    w = lm.initial(model.embed)
    before = lm.to_vector(w)
    bounds = np.array([0, 300, 301, 500])
    start, text = lm.windows(bounds)
    classes = rng.integers(0, 40, 500)  # inputs repeat
    parts = [lm.batch(classes, bounds, start[i:i + 4], text[i:i + 4]) for i in range(0, len(start), 4)]
    got = lm.improve(w, model, parts)
    assert np.array_equal(lm.to_vector(w), before)
    now, m, s = before.astype(float), 0.0, 0.0
    for t, b in enumerate(parts, 1):
        g = lm.to_vector(lm.gradient(lm.to_weights(now), model, *b)).astype(float)
        m, s = m + 0.1 * (g - m), s + 0.01 * (g * g - s)
        now -= 0.01 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
    # (a gradient of next to nothing is a step of any size)
    assert np.mean(np.abs(lm.to_vector(got) - now) > 1e-3) < 1e-3


def test_lm_attention_is_bounded():
    """Very large attention scores, of which none is found to subtract, stay finite."""
    model, rng = _model(), np.random.default_rng(5)
    w = lm.initial(model.embed)
    w["query"] *= 1e4
    w["key"] *= 1e4
    bounds = np.array([0, 90, 91])
    start, text = lm.windows(bounds)
    inputs, there, targets, scored = lm.batch(rng.integers(0, lm.CLASSES, 91), bounds, start, text)
    with np.errstate(over="raise", invalid="raise", divide="raise"):
        a, _, z, kept = lm.forward(w, model.mass, inputs, there)
    assert np.isfinite(a).all() and (z > 0).all()
    att, total = kept[4], kept[5]
    assert np.allclose((att / total).sum(axis=2), 1, atol=1e-4) and att.max() <= np.exp(np.float32(60)) * 1.001


def test_lm_learns_from_every_window(spark):
    """Also the only window of a short text."""
    model = _model()
    start = lm.initial(model.embed)
    for n in range(3):
        ids = bytearray(np.arange(n, n + 20).astype("<u2").tobytes())
        got = lm.train_network(spark.createDataFrame([(ids,)], "ids binary"), model)
        assert not np.array_equal(got["out"], start["out"])


# ---------------------------------------------------------------- quality classifier
def test_estimation_recovers_accuracies():
    rng = np.random.default_rng(4)
    truth = rng.random(20_000) < 0.8
    accuracy = np.array([0.95, 0.9, 0.8, 0.7])
    right = rng.random((20_000, 4)) < accuracy
    v = np.where(right == truth[:, None], quality.GOOD, quality.BAD)
    v[rng.random(v.shape) < 0.2] = quality.ABSTAIN
    patterns, n = np.unique(v, axis=0, return_counts=True)
    model = quality.estimate(patterns, n.astype(float))
    assert model.good == pytest.approx(0.8, abs=0.02)
    assert model.rates[:, 1, quality.GOOD] == pytest.approx(accuracy, abs=0.03)
    assert ((model.posterior(v) >= 0.5) == truth).mean() > 0.93


def test_classifier_separates_junk(spark):
    rng = random.Random(6)
    good = corpus(200)
    junk = [(i, " ".join("".join(rng.choices("ABCDEF#$%|*", k=6)) for _ in range(60)), "en", "a") for i in range(60)]
    got = {r.doc_id: r for r in quality.classify(docs(spark, [*good, *junk])).collect()}
    assert sum(got[r[0]].kept for r in good) >= 0.97 * len(good)
    assert sum(got[r[0]].kept for r in junk) <= 0.03 * len(junk)


def test_classifier_edges(spark):
    got = quality.classify(docs(spark))
    assert got.columns == ["doc_id", "score", "kept"]
    assert quality.classify(docs(spark), with_votes=True).columns == ["doc_id", "weak_good", "score", "kept"]
    rows = got.collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert quality.classify(docs(spark, [])).count() == 0
