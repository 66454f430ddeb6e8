"""Quality scores: held-out accuracy, the fit against plain minimisation, and awkward rows."""

import random
import zlib

import numpy as np
import pytest

from skyledger.llm import queries, ranking

TINY = "/root/testdata/sf0.01"
DOCS, LABELS = "doc_id bigint, text string", "doc_id bigint, quality int"


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def good(rng):
    return " ".join(rng.choice(["alpha", "beta,", "Gamma", "delta.", "of", "the", "some"]) + rng.choice("xyz") for _ in range(90))


def bad(rng):
    word = rng.choice(["buy", "NOW"])
    return " ".join(word + rng.choice(["!!", "$$"]) for _ in range(60))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    return [(i, good(rng) if i % 3 else bad(rng), int(i % 3 > 0)) for i in range(300)]


def scored(spark, docs, labels, **options):
    docs, labels = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    return ranking.score_quality(docs.repartition(3), labels, **options).collect()


def test_held_out_accuracy_of_the_given_tables(spark):
    got = queries.QUERIES["op11_quality_ranking"](spark, TINY)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert got.count() == spark.read.parquet(f"{TINY}/documents.parquet").count()
    tested = got.join(spark.read.parquet(f"{TINY}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(tested) > 50 and {r.quality for r in tested} == {0, 1}
    assert sum(r.predicted == r.quality for r in tested) / len(tested) >= 0.97
    ups, downs = ([r.score for r in tested if r.quality == k] for k in (1, 0))
    assert np.mean([[u > d for d in downs] for u in ups]) >= 0.99


def test_scores_ids_and_reruns(spark, corpus):
    docs = [r[:2] for r in corpus] + [(1000, None), (1001, ""), (None, corpus[1][1]), corpus[2][:2]]
    labels = [(i, q) for i, _, q in corpus]
    rows = scored(spark, docs, labels)
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, scored(spark, docs[::-1], labels)), key=repr)
    assert len(rows) == len(docs)
    by_id = {r.doc_id: r for r in rows}
    assert all(r.held_out == is_held_out(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.7) for r in rows)
    assert all(by_id[i].predicted == q for i, _, q in corpus)
    assert by_id[1000].score == by_id[1001].score and by_id[None].score == by_id[1].score


def test_held_out_labels_do_not_matter(spark, corpus):
    docs, labels = [r[:2] for r in corpus], [(i, q) for i, _, q in corpus]
    turned = [(i, 1 - q if is_held_out(i) else q) for i, q in labels]
    noise = [(None, 1), (5, None), (7, 9), (10**9, 0)] + labels[:20]
    want = sorted(map(tuple, scored(spark, docs, labels)))
    assert turned != labels and sorted(map(tuple, scored(spark, docs, turned + noise))) == want


def test_threshold_splits_all_labelled_rows(spark, corpus):
    """A sample far smaller than the labels: the cut still has as many rows below as labels of 0."""
    learned = [r for r in corpus if not is_held_out(r[0])]
    examples = spark.createDataFrame(learned, "doc_id bigint, text string, label int")
    examples = ranking.features(examples).cache()
    model = ranking.train(examples, sample=10)
    below = examples.where(model.strength() < model.cut).count()
    assert below == sum(1 for r in learned if r[2] == 0)


def test_without_labels_or_rows(spark, corpus):
    docs = [r[:2] for r in corpus[:5]]
    for labels in ([], [(1, 1), (2, 1)], [(1, 0), (1, 1), (2, 1)]):
        assert {round(r.score, 12) for r in scored(spark, docs, labels)} == {0.7}
    assert scored(spark, [], [(1, 1)]) == []
    frame = spark.createDataFrame([(1, "a", 2, "x")], "doc_id bigint, text string, label int, features string")
    assert ranking.score_quality(frame, spark.createDataFrame([], LABELS)).count() == 1


def test_fit_is_the_minimum_of_the_pair_loss(monkeypatch):
    """The slope of the mean loss over all pairs and the ridge vanishes, with as many partners as rows."""
    rng = np.random.default_rng(1)
    up, down = rng.normal(0.4, 1, (40, 3)), rng.normal(0, 1, (40, 3))
    monkeypatch.setattr(ranking, "NAMES", ["a", "b", "c"])
    monkeypatch.setattr(ranking, "PAIRS", 40)
    model = ranking.fit_pairs(up, down)
    spread = np.concatenate([up, down]).std(0)
    w = np.array(model.weights) * spread
    apart = (up[:, None, :] - down[None, :, :]).reshape(-1, 3) / spread
    slope = ranking.RIDGE * w - (apart / (1 + np.exp(apart @ w))[:, None]).mean(0)
    assert np.abs(slope).max() < 1e-6


def test_long_texts():
    """A million words; the share of repeats does not depend on the length."""
    long, short = (dict(zip(ranking.NAMES, ranking.measure("word " * n)[0])) for n in (1_000_000, 10_000))
    assert long["again_1"] > 0.99 and abs(long["blank"] - short["blank"]) < 0.01
