"""Token counts and pieces against the libraries themselves."""

import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

from skyledger.llm import pieces, queries, tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "a", "a", "word " * 20_000, "<s> </s> <unk>", "\x00\t\r\n", "漢字 😀 ñ", "   many   spaces ", "----- aaaa"]
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n_tokens", T.StringType())]
)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "own") for i, t in enumerate(TEXTS)] + [(None, "a", None)], SCHEMA)


def test_model_file_read_like_the_library():
    model = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as f:
        model.ParseFromString(f.read())
    own = pieces.load(PATH)
    assert list(own.names) == [p.piece for p in model.pieces]
    assert list(own.scores) == [p.score for p in model.pieces]
    assert list(own.types) == [p.type for p in model.pieces]
    assert (own.kind, own.byte_fallback) == (model.trainer_spec.model_type, model.trainer_spec.byte_fallback)
    assert own.dummy_prefix and not own.squeeze


def test_parity_and_decoding_on_random_text(library):
    rng = random.Random(3)
    parts = list("aaben- =.01\n  ▁é漢😀#<s>") + ["----", "ing", " the", "    ", "anan", "\x00"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(80))) for _ in range(3000)] + [t or "" for t in TEXTS]
    ids = pieces.encode_texts(PATH, texts)
    assert ids == library.encode(texts)
    assert [pieces.load(PATH).decode(x) for x in ids] == library.decode(ids)


def test_texts_are_made_normal_outside_the_tokenizer(library):
    """The library's normaliser keeps the place of each character, which costs more than the replacing."""
    own, tokenizer = pieces.load(PATH), pieces.build(PATH)
    assert tokenizer.normalizer is None and own.normal("") == "" and own.normal(" a  b") == "▁▁a▁▁b"
    for t in ["", " ", "a", " a  b ", "▁a\n b", "\x00 é"]:
        assert tokenizer.encode(own.normal(t), add_special_tokens=False).ids == library.encode(t)


def test_encode_decode_frames(spark, docs, library):
    out = pieces.encode(docs, PATH, verify=F.lit(True))
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == len(TEXTS) + 1
    for i, t in enumerate(TEXTS):
        assert rows[i].ids == library.encode(t or "") and rows[i].round_trip and rows[i].parity and rows[i].n_tokens == "own"
    back = {r.doc_id: r.text for r in pieces.decode(out, PATH).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(TEXTS))
    assert pieces.encode(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_counts_come_from_the_cache(spark, docs, library, tmp_path):
    cache = str(tmp_path / "cache")
    rows = tokens.token_counts(docs, cache, PATH, limit=100).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        text = "a" if r.doc_id is None else TEXTS[r.doc_id] or ""
        n = len(library.encode(text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 100)
    stored = spark.read.parquet(cache)
    assert stored.count() == len({t or "" for t in TEXTS})
    more = docs.union(spark.createDataFrame([(99, "new text", None)], SCHEMA))
    assert tokens.token_counts(more, cache, PATH).count() == len(TEXTS) + 2
    assert spark.read.parquet(cache).count() == len({t or "" for t in TEXTS}) + 1
    # A stored count is believed, which shows that nothing is encoded twice; another tokenizer has its own.
    assert tokens.token_counts(docs, cache, public_tokenizers.path("byte_bpe_50k.json")).where("n_tokens > 0").count() == len(TEXTS) - 1
    assert spark.read.parquet(cache).select("tokenizer").distinct().count() == 2


def test_empty_table(spark, tmp_path):
    assert tokens.token_counts(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"), PATH).count() == 0


def test_queries(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    counts = {r.doc_id: r.n_tokens for r in queries.QUERIES["op2_token_counts"](spark, folder).collect()}
    rows = queries.QUERIES["op9_sentencepiece"](spark, folder).collect()
    assert counts == {k: len(library.encode(t)) for k, t in texts.items()}
    assert {r.doc_id: r.ids for r in rows} == {k: library.encode(t) for k, t in texts.items()}
    assert all(r.round_trip and r.parity is True for r in rows)


def test_where_the_library_differs_its_ids_are_taken(spark, docs, library, monkeypatch):
    """Threads change nothing; rows that are not verified have no parity; a wrong encoder is found and mended."""
    some = docs.where("doc_id IS NOT NULL")
    for threads in (None, 4):
        rows = pieces.encode(some, PATH, verify=F.col("doc_id") % 2 == 0, threads=threads).collect()
        assert {r.doc_id: r.ids for r in rows} == {i: library.encode(t or "") for i, t in enumerate(TEXTS)}
        assert all(r.parity is (True if r.doc_id % 2 == 0 else None) for r in rows)
    broken = some.withColumn("text", F.lit("wrong here"))
    monkeypatch.setattr(pieces, "encode_texts", lambda path, texts, threads=1: [[5] for _ in texts])
    rows = pieces.encode(broken, PATH, verify=F.col("doc_id") > 0).collect()
    assert all((r.ids, r.parity) == ((library.encode("wrong here"), False) if r.doc_id else ([5], None)) for r in rows)
