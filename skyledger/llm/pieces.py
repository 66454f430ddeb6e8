"""SentencePiece models run by the tokenizers library.

The model file is read field by field: pieces with scores and types, and the normaliser's settings.
From these a tokenizer is rebuilt: dummy prefix and metaspace marker, unigram scores or, for a BPE
model, merges ranked by the score of the piece that they make, and byte fallback. Models that carry a
character map are refused, since their normaliser is not the identity.

Merges of one score, which SentencePiece takes from the left, have an order here. Equal ids are
therefore verified: rows that the caller names are encoded by both libraries and compared.
"""

from __future__ import annotations

import os
import struct
from dataclasses import dataclass
from functools import cached_property, lru_cache
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from skyledger.llm.common import ROWS, map_batches

NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
UNIGRAM, BPE = 1, 2
MARK = "▁"


def fields(data: bytes):
    """Number and value of each field of a protobuf message: int, or bytes for the other kinds."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, data[at : at + size]
        at += size


@dataclass(frozen=True)
class Pieces:
    """A model file: `types` and `scores` by piece id, and what the encoder has to follow."""

    names: tuple[str, ...]
    scores: tuple[float, ...]
    types: tuple[int, ...]
    kind: int
    byte_fallback: bool
    dummy_prefix: bool
    squeeze: bool

    @classmethod
    def read(cls, path: str) -> Pieces:
        with open(path, "rb") as f:
            top = list(fields(f.read()))
        pieces = [dict(fields(v)) for k, v in top if k == 1]
        trainer, normal = (dict(fields(next((v for k, v in top if k == n), b""))) for n in (2, 3))
        if normal.get(2):
            raise ValueError("the model has a character map; only the identity normaliser is rebuilt")
        return cls(
            tuple(p[1].decode() for p in pieces),
            tuple(struct.unpack("<f", p[2])[0] if 2 in p else 0.0 for p in pieces),
            tuple(p.get(3, NORMAL) for p in pieces),
            trainer.get(3, UNIGRAM),
            bool(trainer.get(35, 0)),
            bool(normal.get(3, 1)),
            bool(normal.get(4, 1)),
        )

    @cached_property
    def ranked(self) -> dict[str, float]:
        return {n: s for n, s, t in zip(self.names, self.scores, self.types) if t == NORMAL}

    @cached_property
    def splits(self) -> dict[str, list[tuple[str, str]]]:
        """The ways in which two pieces make each piece."""
        own = self.ranked
        return {p: w for p in own if (w := [(p[:i], p[i:]) for i in range(1, len(p)) if p[:i] in own and p[i:] in own])}

    @cached_property
    def table(self) -> list[bytes]:
        """The bytes each id stands for."""
        special = {UNKNOWN: lambda n: " ⁇ ".encode(), CONTROL: lambda n: b"", BYTE: lambda n: bytes([int(n[3:5], 16)])}
        other = lambda n: n.replace(MARK, " ").encode()
        return [special.get(t, other)(n) for n, t in zip(self.names, self.types)]

    def normal(self, text: str) -> str:
        """The text as the merges see it: spaces as marks, and one before it if the model has a dummy prefix."""
        text = text.replace(" ", MARK)
        return MARK + text if text and self.dummy_prefix else text

    def decode(self, ids: list[int]) -> str:
        """The text of the ids; bytes that are no UTF-8 become replacement characters."""
        found = itemgetter(*ids)(self.table) if len(ids) > 1 else [self.table[i] for i in ids]
        text = b"".join(found).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text[:1] == " " else text


@lru_cache(maxsize=4)
def load(path: str) -> Pieces:
    return Pieces.read(path)


@lru_cache(maxsize=4)
def build(path: str, threads: int = 1):
    """The tokenizer of a model file for normal texts; its batches are encoded by so many threads.

    It has no normaliser, as the library's keeps the place of each character, which costs a fifth of the encoding.
    """
    os.environ["RAYON_NUM_THREADS"], os.environ["TOKENIZERS_PARALLELISM"] = str(threads), "true"
    from tokenizers import Tokenizer, models

    own = load(path)
    if own.squeeze:
        raise ValueError("the model removes extra white space; only the identity normaliser is rebuilt")
    unknown = own.names[own.types.index(UNKNOWN)]
    ids = {n: i for i, n in enumerate(own.names)}
    if own.kind == UNIGRAM:
        model = models.Unigram(list(zip(own.names, own.scores)), ids[unknown], own.byte_fallback)
    elif own.kind == BPE:
        ways = [(-own.ranked[p], ids[p], a, b) for p, splits in own.splits.items() for a, b in splits]
        merges = [(a, b) for _, _, a, b in sorted(ways)]
        model = models.BPE(vocab=ids, merges=merges, unk_token=unknown, fuse_unk=True, byte_fallback=own.byte_fallback)
    else:
        raise ValueError(f"no rebuilding for models of kind {own.kind}")
    return Tokenizer(model)


@lru_cache(maxsize=4)
def own_library(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def encode_texts(path: str, texts: list[str], threads: int = 1) -> list[list[int]]:
    """Ids of each text, without begin and end."""
    own = load(path)
    return [e.ids for e in build(path, threads).encode_batch_fast([own.normal(t) for t in texts], add_special_tokens=False)]


def encode(df: DataFrame, path: str, text: str = "text", verify: Column | None = None, threads: int | None = None) -> DataFrame:
    """Replace `text` by ids (array of int), round_trip and parity.

    Null and empty texts have no ids. round_trip says whether decoding gives the text again (a literal
    metaspace mark or a lone surrogate does not come back). parity says whether SentencePiece gives the
    same ids, in rows for which `verify` is true, and is null in others; where it does not, the ids are
    SentencePiece's. Batches are encoded by `threads`, by default as many as a task has cores. Every row has
    its own result, also repeated ones; other columns stay, but for those with the names of the results.
    """
    threads = threads or int(df.sparkSession.sparkContext.getConf().get("spark.task.cpus", "1"))
    made = [
        StructField("ids", ArrayType(IntegerType())),
        StructField("round_trip", BooleanType()),
        StructField("parity", BooleanType()),
    ]
    kept = [f for f in df.schema.fields if f.name != text and f.name not in {m.name for m in made}]
    named = df.select(
        *(F.col(f"`{f.name}`") for f in kept),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_p_text"),
        F.coalesce(F.lit(False) if verify is None else verify, F.lit(False)).alias("_p_verify"),
    )
    names = [f.name for f in kept]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, own = batch.column("_p_text").to_pylist(), load(path)
        ids = encode_texts(path, texts, threads)
        parity: list[bool | None] = [None] * len(texts)
        asked = [i for i, v in enumerate(batch.column("_p_verify").to_pylist()) if v]
        for i, want in zip(asked, own_library(path).encode([texts[i] for i in asked], num_threads=threads)):
            parity[i] = ids[i] == want
            ids[i] = want
        back = [own.decode(x) == t for x, t in zip(ids, texts)]
        columns = [pa.array(ids, pa.list_(pa.int32())), pa.array(back, pa.bool_()), pa.array(parity, pa.bool_())]
        return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + columns, names + [m.name for m in made])

    return map_batches(named, run, StructType(kept + made), ROWS)


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Replace the column `ids` by `text`; null and empty ids give an empty text. Other columns stay."""
    kept = [f for f in df.schema.fields if f.name not in (ids, "text")]
    names = [f.name for f in kept]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [load(path).decode(x or []) for x in batch.column(ids).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(texts, pa.string())], [*names, "text"])

    rows = df.select(*(F.col(f"`{n}`") for n in names), F.col(f"`{ids}`"))
    return map_batches(rows, run, StructType(kept + [StructField("text", StringType())]), ROWS)
