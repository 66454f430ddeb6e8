"""Token counts behind a digest cache.

A count is stored under the digests of the content and of the tokenizer (model file and library
version). Only contents that the cache lacks are encoded, each once however many rows hold it, and
appended. The cache is a Parquet folder; a lost executor repeats its part of the append, which Spark
commits as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import lru_cache
from importlib.metadata import version

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import ROWS, map_batches, stored

CACHE = "tokenizer string, content binary, n_tokens bigint"


@lru_cache(maxsize=4)
def encoder(path: str) -> Callable[[list[str]], list]:
    """Encode texts with the library of the file: sentencepiece for .model, tokenizers for .json."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: model.encode(texts, num_threads=1)
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [e.ids for e in model.encode_batch(texts, add_special_tokens=False)]


def tokenizer_digest(path: str) -> str:
    """Digest of the model file and of the version of the library that reads it."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + f"{library} {version(library)}".encode()).hexdigest()


def content(text: str):
    """The text as it is counted: null is empty, nothing else is changed."""
    return F.coalesce(F.col(text), F.lit(""))


def read_cache(df: DataFrame, cache: str, tokenizer: str) -> DataFrame:
    """The stored counts of one tokenizer, one row per content; none if there is no cache yet."""
    spark = df.sparkSession
    try:
        rows = spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], CACHE)
    rows = rows.where(F.col("tokenizer") == tokenizer)
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def fill_cache(df: DataFrame, cache: str, path: str, text: str = "text") -> str:
    """Encode the contents of `df` that `cache` lacks and append them; returns the tokenizer's digest.

    The same content in several rows is sent on once per task and encoded once. The path of the model
    has to exist on every executor.
    """
    tokenizer = tokenizer_digest(path)
    texts = df.select(content(text).alias("text")).withColumn("content", F.unhex(F.sha2("text", 256)))
    misses = texts.dropDuplicates(["content"]).join(read_cache(df, cache, tokenizer), "content", "left_anti")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = encoder(path)(batch.column("text").to_pylist())
        n = pa.array([len(x) for x in ids], pa.int64())
        names = pa.array([tokenizer] * len(n), pa.string())
        return pa.RecordBatch.from_arrays([names, batch.column("content"), n], ["tokenizer", "content", "n_tokens"])

    map_batches(misses.select("text", "content"), count, CACHE, ROWS).write.mode("append").partitionBy("tokenizer").parquet(cache)
    return tokenizer


def token_counts(df: DataFrame, cache: str, path: str, text: str = "text", limit: int = 4096) -> DataFrame:
    """Replace `text` by n_bytes, n_tokens and over_limit (n_tokens > limit).

    Null counts as empty; empty has no tokens. Every row, also a repeated one, has its result; other
    columns stay, but for those with the names of the results.
    """
    made = ["n_bytes", "n_tokens", "over_limit"]
    tokenizer = fill_cache(df, cache, path, text)
    counts = stored(read_cache(df, cache, tokenizer), "token_counts")
    counts = counts.select(F.col("content").alias("_t_content"), F.col("n_tokens").alias("_t_n"))
    keys = df.withColumn("_t_content", F.unhex(F.sha2(content(text), 256)))
    keys = keys.withColumn("_t_bytes", F.octet_length(content(text)).cast("bigint")).drop(text, *made)
    joined = keys.join(counts, "_t_content")
    return joined.withColumnsRenamed({"_t_bytes": "n_bytes", "_t_n": "n_tokens"}).withColumn(
        "over_limit", F.col("n_tokens") > limit
    ).drop("_t_content")
