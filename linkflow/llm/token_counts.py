"""Token counts: batch encoding in an Arrow function that returns lengths only.

Batches are balanced by bytes of text, and long texts are cut at boundaries
that no token crosses (see ``subwords``), so memory stays bounded and the
counts equal those of one library call per whole text.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkflow.llm.subwords import encoder

VOCAB = "word_bpe_49k.json"


def n_tokens(text: Column, vocab: str = VOCAB) -> Column:
    """Number of ids of each text; null counts as empty."""

    @F.arrow_udf("bigint")
    def lengths(texts: pa.Array) -> pa.Array:
        return pa.array(encoder(vocab).counts(texts), pa.int64())

    return lengths(text)


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocab: str = VOCAB, limit: int = 2048) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row.

    Special strings inside a text count as the library's default has it.
    Null and empty texts give 0 and 0.  Ids are passed through: null or
    repeated ids and repeated rows give a row each.  Very long texts are counted whole.
    An empty table gives no
    rows.  Other columns are not read, so their names cannot clash.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = df.select(F.col(id_col), F.octet_length(text).cast("bigint").alias("n_bytes"),
                        n_tokens(text, vocab).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
