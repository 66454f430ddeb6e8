"""A corpus pipeline over `documents`: each stage works on all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import jaccard, mixing, pieces, quality, secrets
from skyledger.llm.common import scratch, stored, table

MODEL = "piece_bpe_32k.model"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    return quality.keep_good(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    scratch(spark)
    return jaccard.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in place and n_chars follows; all documents stay."""
    return secrets.mask_secrets(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to the target weights takes them: not at all, once or twice."""
    scratch(spark)
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, with the checks of the encoder on every row."""
    out = pieces.encode(docs, public_tokenizers.path(MODEL), verify=F.lit(True))
    n = F.size("ids").cast("bigint").alias("n_tokens")
    return out.select("doc_id", "lang", "source", n, "ids", "round_trip", "parity")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]
#: Forming components, balanced sampling and encoding cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, "stage")
    return docs
