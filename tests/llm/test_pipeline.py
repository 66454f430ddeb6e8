"""The pipeline against its stages done one by one in plain Python where that is possible."""

import public_tokenizers
import sentencepiece
from test_jaccard import joined
from test_quality_rules import measures

import corpus_pipeline
from skyledger.llm import quality, secrets

FOLDER = "/root/testdata/sf0.001"
STOP = set(quality.STOP_WORDS.split())


def good(text):
    m, words = measures(text), (text or "").split()
    lines = [x for x in (text or "").split("\n") if x.strip()]
    n, k = m["n_words"], max(1, len(lines))
    return (
        not m["base_failed"] and 2 * n <= m["word_chars"] <= 12 * n and 10 * m["n_symbols"] <= n and 50 * sum(w in STOP for w in words) >= n
        and 2 * m["n_dup_lines"] <= len(lines) and 10 * sum(x.lstrip(" ")[:1] in "-*•" for x in lines) <= 9 * k
    )


def test_stages_in_order():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == [
        "quality rules", "n-gram Jaccard join", "secret scans", "mixing sources to target weights", "SentencePiece encoding and decoding"
    ]


def test_each_stage_and_the_whole(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    scan = secrets.scanner()
    want = {i: t for i, t in texts.items() if good(t)}
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept.append(docs.collect())
        if i < 4:
            assert docs.columns == columns
    assert {r.doc_id: r.text for r in kept[0]} == want
    want = {i: want[i] for i, _, c in joined(sorted(want.items())) if c == i}
    assert {r.doc_id: r.text for r in kept[1]} == want
    want = {i: secrets.mask(t, scan(t)) for i, t in want.items()}
    assert {r.doc_id: r.text for r in kept[2]} == want and all(r.n_chars == len(r.text) for r in kept[2])
    taken = sum(len(r.text.split()) for r in kept[3])
    total = sum(len(t.split()) for t in want.values())
    assert abs(taken - 1.5 * total) < 0.05 * total and {r.doc_id: r.text for r in kept[3]}.items() <= want.items()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.MODEL))
    assert sorted((r.doc_id, r.ids) for r in kept[4]) == sorted((r.doc_id, library.encode(r.text)) for r in kept[3])
    assert sorted(corpus_pipeline.run(spark, FOLDER).collect()) == sorted(kept[4])


def test_every_row_is_checked_by_the_encoder(spark):
    docs = spark.createDataFrame([(i, "en", "s", f"some words {i}") for i in (1, 49, 50, 51)], "doc_id long, lang string, source string, text string")
    assert [r.parity for r in corpus_pipeline.encode_pieces(spark, docs, FOLDER).collect()] == [True] * 4
