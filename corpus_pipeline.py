"""Corpus pipeline: raw documents to packed training sequences.

``STAGES`` are applied in order; each takes what the one before it kept, as
Parquet, and all but the last return the columns of the documents:

1. ``language_id``: documents without a recognised language go.
2. ``near_duplicates``: one document of each near-duplicate group stays.
3. ``secrets``: secrets in the texts are replaced by a mask.
4. ``source_mix``: each document appears as often as the mix of sources takes
   it: not at all, once or twice.
5. ``packing``: the documents' tokens are packed into sequences.

Null ids, null texts, repeated rows and further columns (whatever their names)
pass through the stages as their operators state; very long texts are read whole
by every stage, only packing cuts them; an empty table gives empty
results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkflow.llm.common import fresh, saved, train_split
from linkflow.llm.langid import predict, train_model
from linkflow.llm.mixing import repeated
from linkflow.llm.packing import pack
from linkflow.llm.queries import configured
from linkflow.llm.secret_scan import redact
from linkflow.llm.simhash import keep_one


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that language ID does not reject.

    Null texts, texts without a letter and texts far from every language go.
    Learns as the query does, from the rows that are not held out.
    """
    configured(spark)
    model = train_model(docs, ~train_split(F.col("doc_id"), 4, 2))
    found = fresh(docs, "language__")
    return docs.withColumn(found, predict(F.col("text"), model)) \
        .filter(~F.col(found).getField("rejected")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links: the one with the smallest id."""
    configured(spark)
    return keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and ``n_chars`` brought up to date."""
    configured(spark)
    masked = redact(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    configured(spark)
    return repeated(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the sequences."""
    configured(spark)
    return pack(docs)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secrets),
    ("source mix", source_mix),
    ("packing", packing),
]

#: The stages learn a model, hash shingles and tokenize, which SQL cannot
#: express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table; each result is written and reread."""
    docs = configured(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "pipeline-" + name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
