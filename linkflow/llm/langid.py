"""Language ID by nearest centroid over hashed TF-IDF n-grams.

A text is lower-cased, everything but letters becomes one space, and its UTF-8
byte pairs and triples are counted in ``DIMS`` hashed dimensions.  Its vector
has (1 + log count) * idf, scaled to length one.  Each language has several
centroids, found by clustering its documents, and a text gets the language of
the centroid with the largest cosine.  A text too far from every centroid is
rejected; as short texts of a language are far from its centroids too, the
limit rises with the number of different n-grams.

Learning covers all training documents: their document frequencies give the
idf, and every one of them moves its nearest centroid of its language.  Only
where the clusters start is taken from a bounded sample (``sample_per_lang``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIMS = 1 << 12
_BATCH = 256

# Every ASCII byte but a-z becomes a space; longer sequences stay.
_LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


@dataclass(frozen=True)
class Model:
    """Unit centroids (one row each) with their labels, and the idf."""

    labels: list[str]
    centroids: np.ndarray
    idf: np.ndarray
    min_score: float

    def least(self, n_grams: np.ndarray) -> np.ndarray:
        """The cosine that texts with so many different n-grams need."""
        return self.min_score * (0.15 + 0.85 * (1 - np.exp(-n_grams / 100)))


def counts(text: str) -> np.ndarray | None:
    """Hashed n-gram counts of a text; None if it has no letter."""
    lowered = text.lower()
    raw = b" " + b" ".join(lowered.encode("utf-8", "ignore").translate(_LETTERS).split()) + b" "
    if len(raw) < 3 or not any(map(str.isalpha, lowered)):
        return None
    out = np.zeros(DIMS, np.int64)
    # in parts, so that a very long text needs no more memory than its bytes
    for start in range(0, len(raw) - 2, 1 << 20):
        a = np.frombuffer(raw, np.uint8, min(len(raw) - start, (1 << 20) + 2), start).astype(np.uint32)
        pair = (a[:-1] << np.uint32(8)) | a[1:]
        triple = (pair[:-1] << np.uint32(8)) | a[2:]
        if start + (1 << 20) + 2 < len(raw):
            pair = pair[:-1]
        for gram in (pair, triple | np.uint32(1 << 24)):
            out += np.bincount((gram * np.uint32(2654435761)) >> np.uint32(20), minlength=DIMS)
    return out


def vectors(rows: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors of count rows."""
    if not rows:
        return np.zeros((0, DIMS), np.float32)
    c = np.stack(rows).astype(np.float32)
    v = np.where(c > 0, 1 + np.log(np.maximum(c, 1)), 0) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def cluster(v: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Unit centroids of at most ``k`` spherical clusters of unit rows.

    Starts with the row nearest to the mean, then rows drawn (seeded) by their
    distance from those chosen.  Clusters of less than a fiftieth of the
    rows are outliers (wrong labels, junk) and go.
    """
    rng = np.random.default_rng(42)
    chosen = [int(np.argmax(v @ v.mean(axis=0)))]
    while len(chosen) < min(k, len(v)):
        far = np.maximum(1 - (v @ v[chosen].T).max(axis=1), 0).astype(np.float64)
        if far.max() < 1e-6:  # the rest are copies
            break
        chosen.append(int(rng.choice(len(v), p=far / far.sum())))
    centroids = v[chosen]
    for _ in range(rounds):
        own = np.argmax(v @ centroids.T, axis=1)
        sums = np.stack([v[own == j].sum(axis=0) if (own == j).any() else c for j, c in enumerate(centroids)])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    sizes = np.bincount(np.argmax(v @ centroids.T, axis=1), minlength=len(centroids))
    return centroids[sizes >= max(1, len(v) / 50)]


def _document_frequencies(texts: Column, train: DataFrame) -> tuple[np.ndarray, int]:
    """Training documents with each dimension, and their number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIMS + 1, np.int64), 0
        for b in batches:
            for t in b.column(0):
                c = counts(t.as_py() or "")
                if c is not None:
                    df[:-1] += c > 0
                    n += 1
        df[-1] = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at], pa.int64())], ["dim", "n"])

    rows = train.select(texts.alias("t")).mapInArrow(count, "dim int, n bigint") \
        .groupBy("dim").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(DIMS + 1, np.int64)
    for r in rows:
        out[r["dim"]] = r["n"]
    return out[:-1], int(out[-1])


def _first_centroids(train: DataFrame, sizes: dict[str, int], idf: np.ndarray, per_lang: int,
                     k: int) -> tuple[list[str], np.ndarray]:
    """Clusters of a sample of each language, drawn by the hash of id and text."""
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)).alias("draw")
    share = F.create_map(*[x for lang, n in sorted(sizes.items())
                           for x in (F.lit(lang), F.lit(min(1 << 30, (2 * per_lang << 30) // n + 1)))])
    order = Window.partitionBy("lang").orderBy("draw", "id")
    sample = train.select("id", "lang", "text", draw) \
        .filter(F.col("draw") < F.element_at(share, F.col("lang"))) \
        .withColumn("r", F.row_number().over(order)).filter(F.col("r") <= per_lang)

    def start(group: pd.DataFrame) -> pd.DataFrame:
        rows = [c for c in map(counts, group.sort_values("r")["text"]) if c is not None]
        found = cluster(vectors(rows, idf), k) if rows else np.zeros((0, DIMS), np.float32)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "c": [x.astype(np.float32).tobytes() for x in found]})

    got = sample.groupBy("lang").applyInPandas(start, "lang string, c binary").collect()
    got = sorted((r["lang"], bytes(r["c"])) for r in got)
    return [g[0] for g in got], np.array([np.frombuffer(g[1], np.float32) for g in got]).reshape(-1, DIMS)


def _moved_centroids(train: DataFrame, labels: list[str], centroids: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Centroids of all training documents, each counted with the nearest of its language."""
    of_lang = {lang: np.array([i for i, x in enumerate(labels) if x == lang]) for lang in set(labels)}

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(centroids.shape, np.float64)
        for b in batches:
            for start in range(0, b.num_rows, _BATCH):
                part = b.slice(start, _BATCH)
                rows = [(lang.as_py(), counts(t.as_py() or "")) for lang, t in
                        zip(part.column(0), part.column(1), strict=True)]
                rows = [(lang, c) for lang, c in rows if c is not None and lang in of_lang]
                v = vectors([c for _, c in rows], idf)
                near = v @ centroids.T
                for i, (lang, _) in enumerate(rows):
                    own = of_lang[lang]
                    sums[own[np.argmax(near[i, own])]] += v[i]
        for j, row in enumerate(sums):
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), j), pa.int32()), pa.array(at, pa.int32()), pa.array(row[at], pa.float64())],
                ["j", "dim", "s"])

    rows = train.select("lang", "text").mapInArrow(gather, "j int, dim int, s double") \
        .groupBy("j", "dim").agg(F.sum("s").alias("s")).toPandas()
    sums = np.zeros(centroids.shape)
    sums[rows["j"].to_numpy(), rows["dim"].to_numpy()] = rows["s"].to_numpy()
    lengths = np.linalg.norm(sums, axis=1, keepdims=True)
    return np.where(lengths > 0, sums / np.maximum(lengths, 1e-12), centroids).astype(np.float32)


def train_model(df: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang", per_lang: int = 4, sample_per_lang: int = 256,
                min_score: float = 0.15) -> Model:
    """Learns from the rows of ``df`` where ``learn`` holds and the language is known.

    What reaches the driver is bounded by ``DIMS``, the languages and
    ``per_lang``.  Without training rows the model has no language.
    """
    train = df.filter(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()) \
        .select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    sizes = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    have, n = _document_frequencies(F.col("text"), train)
    idf = (np.log((1 + n) / (1 + have)) + 1).astype(np.float32)
    if not sizes:
        return Model([], np.zeros((0, DIMS), np.float32), idf, min_score)
    labels, centroids = _first_centroids(train, sizes, idf, sample_per_lang, per_lang)
    return Model(labels, _moved_centroids(train, labels, centroids, idf), idf, min_score)


def predict(text: Column, model: Model) -> Column:
    """Struct (lang, score, rejected) of each text.

    ``score``: the largest cosine, 0 to 1.  A null text, one without a letter
    and any text under a model without a language are ``und`` with score 0 and
    rejected; others are rejected below the cosine that their length needs.
    """

    @F.arrow_udf("struct<lang:string,score:double,rejected:boolean>")
    def nearest(texts: pa.Array) -> pa.Array:
        langs, scores, known = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        for start in range(0, len(texts), _BATCH):
            at, rows = [], []
            for i in range(start, min(start + _BATCH, len(texts))):
                c = counts(texts[i].as_py() or "")
                if c is not None:
                    at.append(i)
                    rows.append(c)
            if rows and model.labels:
                near = vectors(rows, model.idf) @ model.centroids.T
                best = np.argmax(near, axis=1)
                scores[at] = np.clip(near[np.arange(len(at)), best], 0, 1)
                known[at] = scores[at] >= model.least(np.array([(c > 0).sum() for c in rows]))
                for i, j in zip(at, best.tolist(), strict=True):
                    langs[i] = model.labels[j]
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
             pa.array(~known, pa.bool_())], ["lang", "score", "rejected"])

    # evaluated once, not again for each field or filter
    return nearest.asNondeterministic()(text)


def identify(df: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score, rejected) of every row.

    Learns from the rows that are not held out, and predicts all from their
    text alone.

    Null or repeated ids and repeated rows give a row each (and are learned
    from each); a null language is not learned from.  Equal cosines go to the
    language first in code point order.  Very long texts are read whole.
    An empty table gives no rows.  Other
    columns are not read.
    """
    model = train_model(df, ~held_out, id_col, text_col, lang_col)
    out = df.select(F.col(id_col), held_out.alias("held_out"), predict(F.col(text_col), model).alias("p__"))
    return out.select(id_col, "held_out", F.col("p__.lang").alias("lang_pred"), "p__.score", "p__.rejected")
