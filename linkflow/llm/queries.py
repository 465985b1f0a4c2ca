"""Registered queries of this subpackage: ``fn(spark, sf_dir) -> DataFrame``.

Each applies one operator, with production parameters, to its whole table.
``SQL`` has the DuckDB twin of each query whose rows SQL can express; the
others are held against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkflow.llm import lm, topk
from linkflow.llm.align import alignment
from linkflow.llm.common import documents, ship_package, train_split
from linkflow.llm.langid import identify
from linkflow.llm.line_dedup import dedup_lines
from linkflow.llm.mixing import mix
from linkflow.llm.packing import pack
from linkflow.llm.periodic import periodic_runs, planted_order
from linkflow.llm.quality import classify
from linkflow.llm.rules import quality_rules
from linkflow.llm.secret_scan import scan
from linkflow.llm.simhash import near_duplicates
from linkflow.llm.token_counts import token_counts
from linkflow.session import prepare_session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


#: Rows of long texts go to Python in batches of so many bytes.
ARROW_BYTES = "8m"


def configured(spark: SparkSession) -> SparkSession:
    """The session with the settings that the operators rely on."""
    prepare_session(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    ship_package(spark)
    return spark


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(configured(spark), sf_dir)
        if sql:
            SQL[name] = sql
        return fn
    return register


@query("op1_quality_classifier")
def quality_classifier(spark, sf_dir):
    return classify(documents(spark, sf_dir, "doc_id", "text"))


@query("op5_best_fit_packing")
def best_fit_packing(spark, sf_dir):
    return pack(documents(spark, sf_dir, "doc_id", "text"))


@query("op7_source_mixing")
def source_mixing(spark, sf_dir):
    return mix(documents(spark, sf_dir, "doc_id", "text", "source"))


@query("op8_token_counts")
def count_tokens(spark, sf_dir):
    return token_counts(documents(spark, sf_dir, "doc_id", "text"))


@query("op9_simhash_near_dedup")
def simhash_near_dedup(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir, "doc_id", "text"))


@query("op10_quality_rules")
def judge_quality(spark, sf_dir):
    return quality_rules(documents(spark, sf_dir, "doc_id", "text", "lang"))


@query("op6_secret_scans")
def scan_secrets(spark, sf_dir):
    return scan(documents(spark, sf_dir, "doc_id", "text"))


@query("op3_exact_topk_search", sql=topk.ORACLE)
def exact_topk_search(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0)


@query("op4_language_id")
def language_id(spark, sf_dir):
    return identify(documents(spark, sf_dir, "doc_id", "text", "lang"), train_split(F.col("doc_id"), 4, 2))


@query("op2_lm_scoring")
def lm_scoring(spark, sf_dir):
    return lm.score(documents(spark, sf_dir, "doc_id", "text"), train_split(F.col("doc_id"), 7, 2))


@query("op11_line_dedup")
def line_dedup(spark, sf_dir):
    return dedup_lines(documents(spark, sf_dir, "doc_id", "text"))


@query("op12_cross_tokenizer_alignment")
def cross_tokenizer_alignment(spark, sf_dir):
    return alignment(documents(spark, sf_dir, "doc_id", "text"))[0]


@query("op13_periodic_runs")
def periodic_word_runs(spark, sf_dir):
    return periodic_runs(documents(spark, sf_dir, "doc_id", "text"), orders=planted_order)
