"""A corpus run over ``documents``: toxic texts go, near copies go, repeated benchmark passages go, secrets
are masked, and what is left is encoded into pieces.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it below the shared folder and
rereads it as the next stage's documents. All stages but the last return the columns of documents. A row
with a null id is never dropped as a copy or a repetition; a null text is scored and encoded as empty.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from holdfast.llm import decontaminate, near_text, secrets, sentencepieces, toxicity  # noqa: E402
from holdfast.llm.common import stage  # noqa: E402
from holdfast.llm.queries import table, vocabulary  # noqa: E402


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the toxicity model rejects."""
    model = toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that of the least id, of each class of near copies."""
    return near_text.drop_near_copies(docs)


def keep_unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that repeat a benchmark item."""
    return decontaminate.drop_repeating(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in texts, and bring the stated length up to date."""
    masked = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    length = F.coalesce(F.length("text"), F.col("n_chars"))
    return masked.withColumn("n_chars", length.cast(dict(docs.dtypes)["n_chars"]))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add the piece ids of each text."""
    return sentencepieces.encode_documents(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", keep_civil),
    ("near_copies", keep_distinct),
    ("benchmark_overlap", keep_unseen),
    ("secrets", mask_secrets),
    ("sentencepiece", encode),
]

#: The fitted model, the minimum hashes and the piece vocabulary have no SQL form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), f"corpus-{name}")
    return docs
