"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document.
Expectation-maximisation finds how often each labeller gives each vote to good
and to bad documents, without knowing which documents are good: only the
number of documents with each combination of votes matters, a table whose size
does not depend on the input, counted over all documents.  The posterior of a
combination then labels its documents, and a linear scorer over hashed byte
triples learns from these soft labels.

The scorer is a classifier fitted on a bounded sample: at most ``per_side``
documents that the label model finds good and as many that it finds bad, drawn
by hash and weighted to stand for all.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkflow.llm.common import GAPS, let, words
from linkflow.llm.rules import class_counts, n_dup_lines

DIMS = 1 << 12
BAD, ABSTAIN, GOOD = 0, 1, 2


def votes(text: Column) -> Column:
    """Array of the labellers' votes on a non-null text (see ``LABELLERS``)."""

    def vote(good: Column, bad: Column) -> Column:
        return F.when(bad, F.lit(BAD)).when(good, F.lit(GOOD)).otherwise(F.lit(ABSTAIN))

    def measured(f: Column) -> Column:
        chars, c, n, distinct, bare, dup, lines = (f[x] for x in (
            "chars", "c", "n", "distinct", "bare", "dup", "lines"))
        letters = c[0] + c[1] + c[2]
        solid = chars - c[4]
        return F.array(
            vote(c[1] < 0.2 * letters, c[1] > 0.5 * letters),
            vote(c[6] < 0.005 * chars, c[6] > 0.04 * chars),
            vote((n >= 30) & (distinct > 0.3 * n), (n >= 30) & (distinct < 0.2 * n)),
            vote((solid >= 3 * n) & (solid <= 9 * n), (solid < 2 * n) | (solid > 14 * n)),
            vote(bare < 0.02 * n, bare > 0.15 * n),
            vote((c[5] >= 0.01 * n) & (c[5] <= 0.5 * n), (n >= 50) & ((c[5] == 0) | (c[5] > n))),
            vote(F.lit(False), (lines >= 3) & (dup > 0.3 * lines)),
            vote(letters > 0.9 * solid, letters < 0.75 * solid),
            vote((n >= 10) & (f["again"] < 0.03 * n), (n >= 10) & (f["again"] > 0.08 * n)))

    facts = let(words(text), lambda w: F.struct(
        F.length(text).alias("chars"), class_counts(text).alias("c"), F.size(w).alias("n"),
        F.size(F.array_distinct(w)).alias("distinct"),
        F.size(F.filter(w, lambda x: ~x.rlike(r"[\p{L}\p{N}]"))).alias("bare"),
        F.size(F.filter(w, lambda x, i: F.coalesce(F.get(w, i - 1) == x, F.lit(False)))).alias("again"),
        n_dup_lines(text).alias("dup"), F.size(F.split(F.btrim(text, F.lit(GAPS)), "\n", -1)).alias("lines")))
    return let(facts, measured)


#: What the votes judge, in order.
LABELLERS = ("upper case", "symbols", "vocabulary", "word length", "words without a letter or digit",
             "punctuation", "repeated lines", "letters", "words that repeat the one before")


@dataclass(frozen=True)
class LabelModel:
    """Share of good documents, and P(vote | class, not abstained) as labeller x class x vote.

    An abstention says nothing: its rate is 1 for both classes.
    """

    good: float
    rates: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """P(good) of each row of votes."""
        at = np.arange(patterns.shape[1])
        logs = [np.log(self.rates[at, y, patterns]).sum(axis=1) + np.log(p)
                for y, p in ((0, 1 - self.good), (1, self.good))]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def estimate(patterns: np.ndarray, n: np.ndarray, rounds: int = 100) -> LabelModel:
    """Expectation-maximisation over vote combinations seen ``n`` times.

    Starts from the share of good among a combination's votes, so that "good"
    is what most labellers call so; combinations without a vote start even.
    """
    k = patterns.shape[1]
    up, down = (patterns == GOOD).sum(axis=1), (patterns == BAD).sum(axis=1)
    post = (up + 0.5) / (up + down + 1)
    model = LabelModel(0.5, np.ones((k, 2, 3)))
    for _ in range(rounds):
        rates = np.ones((k, 2, 3))
        for y, weight in ((0, n * (1 - post)), (1, n * post)):
            bad, good = (weight @ (patterns == v) + 0.1 for v in (BAD, GOOD))
            rates[:, y, BAD], rates[:, y, GOOD] = bad / (bad + good), good / (bad + good)
        good = float(np.clip((n * post).sum() / n.sum(), 1e-6, 1 - 1e-6))
        model = LabelModel(good, rates)
        post = model.posterior(patterns)
    return model


def features(raw: bytes) -> np.ndarray:
    """Scaled log counts of hashed byte triples, over the whole text.

    Long texts have about length one; short ones, which say less, are shorter.
    The last dimension counts words that repeat the one before, with more weight.
    """
    out = np.zeros(DIMS + 1, np.float32)
    w = raw.split()
    out[-1] = sum(map(operator.eq, w, w[1:]))
    raw = b" " + raw + b" "
    for start in range(0, len(raw) - 2, 1 << 20):
        a = np.frombuffer(raw, np.uint8, min(len(raw) - start, (1 << 20) + 2), start).astype(np.uint32)
        if len(a) < 3:
            break
        gram = (a[:-2] << np.uint32(16)) | (a[1:-1] << np.uint32(8)) | a[2:]
        out[:-1] += np.bincount((gram * np.uint32(2654435761)) >> np.uint32(20), minlength=DIMS)
    np.log1p(out, out=out)
    out[-1] *= 4
    return out / (float(np.linalg.norm(out)) + 4)


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Weights and bias of a logistic scorer of soft labels, by gradient descent with momentum."""
    w, step = np.zeros(x.shape[1] + 1, np.float32), np.zeros(x.shape[1] + 1, np.float32)
    y, weight = y.astype(np.float32), (weight / weight.sum()).astype(np.float32)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -50, 50)))
        d = weight * (p - y)
        g = np.append(x.T @ d + np.float32(1e-5) * w[:-1], d.sum())
        step = np.float32(0.9) * step - np.float32(8) * g
        w = w + step
    return w


def classify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_side: int = 2048,
             with_votes: bool = False) -> DataFrame:
    """(id, score, kept) of every row.

    ``score``: the scorer's P(good); ``kept``: the score is 0.5 or more.
    ``with_votes`` adds ``weak_good``, the label model's posterior, for which
    the labellers vote on all documents once more.

    Null and empty texts are like texts of white space: votes and features of
    the empty string.  Null or repeated ids and repeated rows give a row each.
    If the label model finds only good or only bad documents, the scorer learns
    from that side alone.  Very long texts are read whole.
    An empty table gives no rows.  Other columns are not
    read, so their names cannot clash.
    """
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    judged = rows.withColumn("votes", votes(F.col("text")))
    counted = judged.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()
    if not counted:
        weak = [F.lit(0.0).alias("weak_good")] if with_votes else []
        return rows.select(F.col("id").alias(id_col), *weak, F.lit(0.0).alias("score"), F.lit(False).alias("kept"))
    counted.sort(key=lambda r: r["votes"])
    patterns, n = np.array([r["votes"] for r in counted]), np.array([r["n"] for r in counted], float)
    posterior = estimate(patterns, n).posterior(patterns)

    # a combination as one number, so that its posterior is a look-up
    code = lambda v: F.aggregate(v, F.lit(0), lambda a, x: a * 3 + x)
    numbers = patterns @ 3 ** np.arange(patterns.shape[1])[::-1]
    of = F.create_map(*[F.lit(x) for k, p in zip(numbers.tolist(), posterior.tolist(), strict=True) for x in (k, p)])
    weak_good = let(code(F.col("votes")), lambda k: F.element_at(of, k))

    @F.arrow_udf("binary")
    def hashed(texts: pa.Array) -> pa.Array:
        return pa.array([features((t.as_py() or "").encode()).tobytes() for t in texts], pa.binary())

    # a bounded sample of either side, cut by hash before it is ranked
    sides = np.array([n[posterior < 0.5].sum(), n[posterior >= 0.5].sum()])
    good = F.col("weak_good") >= 0.5
    share = [min(1 << 30, int((2 * per_side << 30) / max(1, s)) + 1) for s in sides.tolist()]
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30))
    order = Window.partitionBy("good").orderBy("draw", "id")
    drawn = rows.withColumn("draw", draw).filter(F.col("draw") < max(share))  # before the labellers vote
    voted = drawn.withColumn("votes", votes(F.col("text")))
    sample = voted.withColumn("weak_good", weak_good).withColumn("good", good) \
        .filter(F.col("draw") < F.when(F.col("good"), share[1]).otherwise(share[0])) \
        .withColumn("r", F.row_number().over(order)).filter(F.col("r") <= per_side) \
        .select("good", "weak_good", "draw", hashed("text").alias("x"), F.lit(0).alias("all"))

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["good", "draw"])
        x = np.stack([np.frombuffer(b, np.float32) for b in group["x"]])
        taken = group["good"].map(group["good"].value_counts()).to_numpy()
        weight = sides[group["good"].to_numpy().astype(int)] / taken
        return pd.DataFrame({"w": [fit(x, group["weak_good"].to_numpy(), weight).tobytes()]})

    w = np.frombuffer(bytes(sample.groupBy("all").applyInPandas(learn, "w binary").first()["w"]), np.float32)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        out = [float(features((t.as_py() or "").encode()) @ w[:-1] + w[-1]) for t in texts]
        return pa.array(1 / (1 + np.exp(-np.clip(np.array(out, float), -50, 50))), pa.float64())

    weak = [weak_good.alias("weak_good")] if with_votes else []
    out = (judged if with_votes else rows).select(F.col("id").alias(id_col), *weak, score("text").alias("score"))
    return out.withColumn("kept", F.col("score") >= 0.5)
