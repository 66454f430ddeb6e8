"""Quality scores learned from preference pairs, after Bradley and Terry.

A text of label 1 is preferred to one of label 0 with the probability sigmoid(w (x - x')), x and x' being
their features. The weights minimise the logistic loss on these differences and a small ridge. What makes
a text good or bad is then its strength w x; a text is predicted to be good if its strength is above the
quantile at which the labelled texts part into as many bad and good ones as the labels say. Scores are
strengths on the logistic scale, moved so that this quantile is at THRESHOLD.

Features are shares and ratios of the bytes and words of a whole text. They are computed once for each
document; the strength of all documents, the fit's scaling and the quantile are Spark expressions over
them. Only the weights are fitted on a bounded sample: of each class the SAMPLE documents whose ids have
the smallest hashes, each in PAIRS pairs.
"""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import map_text, stored

#: Documents of each class that weights are fitted on, and pairs that each of them is in.
SAMPLE, PAIRS = 2048, 8
RIDGE, ROUNDS = 1e-3, 30
#: The score from which on a text is predicted to have label 1.
THRESHOLD = 0.7
#: Steps of a strength in the histogram that the quantile is read from, and the largest strength.
STEP, LIMIT = 1 / 64, 64.0
#: Pretended further bytes or words, so that shares in short texts are moderate.
PRIOR = 24

_KINDS = np.zeros(256, np.uint8)
for _kind, _bytes in enumerate(
    (
        b"abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)),
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        b"0123456789",
        b" \t\r\x0b\x0c",
        b"\n",
        b".,;:'\"()-",
        b"!?",
        b"|<>[]{}\\/_=+~^`@",
        b"#$%&*",
    ),
    1,
):
    _KINDS[list(_bytes)] = _kind
NAMES = (
    "control lower upper digit blank newline point shout bracket symbol "
    "word_length pack again_1 again_2 variety triples top_word odd_end dup_lines line_words length"
).split()


def measure(text: str) -> tuple[list[float]]:
    """The features of a text, in the order of NAMES: square roots of shares, and logarithms of ratios.

    A text without words has the values that no words at all give; nothing is cut.
    """
    share = lambda part, whole: part / (whole + PRIOR)
    data = text.encode()
    kinds = np.bincount(_KINDS[np.frombuffer(data, np.uint8)], minlength=10)
    words = data.split()
    n = len(words)
    counts = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    again_1 = sum(map(operator.eq, words[1:], words))
    again_2 = sum(map(operator.eq, words[2:], words))
    triples = len(set(zip(words, words[1:], words[2:])))
    odd = sum(1 for w in words if not (w[-1] >= 128 or chr(w[-1]).isalnum() or w[-1] in b".,;:?)'\""))
    shares = [share(k, len(data)) for k in kinds.tolist()]
    shares += [
        share(len(data), n) / 8,
        share(len(zlib.compress(data, 1)), len(data)),
        share(again_1, n),
        share(again_2, n),
        share(len(counts), n),
        share(max(0, n - 2 - triples), n),
        share(max(counts.values(), default=0), n),
        share(odd, n),
        share(len(lines) - len(set(lines)), len(lines)),
    ]
    return ([x**0.5 for x in shares] + [np.log1p(n / (len(lines) + 1)), np.log1p(n)],)


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace `text` by `features`, an array of doubles; null counts as empty."""
    return map_text(docs, text, lambda: measure, {"features": pa.list_(pa.float64())})


@dataclass(frozen=True)
class Model:
    """Strength of features x: sum of weights * (x - center), within LIMIT; `cut` is the quantile."""

    weights: tuple[float, ...]
    center: tuple[float, ...]
    cut: float = 0.0

    def strength(self, x: str = "features") -> Column:
        terms = [(F.get(F.col(x), F.lit(i)) - c) * w for i, (w, c) in enumerate(zip(self.weights, self.center))]
        return F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), sum(terms, F.lit(0.0))))

    def score(self, x: str = "features") -> Column:
        """Between 0 and 1; THRESHOLD where the strength is `cut`."""
        return 1 / (1 + F.exp(-(self.strength(x) - self.cut)) * ((1 - THRESHOLD) / THRESHOLD))


def fit_pairs(good: np.ndarray, bad: np.ndarray, ridge: float = RIDGE) -> Model:
    """Weights that minimise the mean logistic loss on good - bad over pairs, by Newton's method.

    Each row is paired with PAIRS rows of the other class, in turn. Features are scaled by their deviation
    within the sample. Without rows of both classes all weights are 0.
    """
    both = np.concatenate([good, bad])
    if not len(good) or not len(bad):
        return Model((0.0,) * len(NAMES), (0.0,) * len(NAMES))
    center, spread = both.mean(0), both.std(0)
    spread[spread < 1e-9] = 1.0
    n = max(len(good), len(bad))
    i = np.tile(np.arange(n), PAIRS)
    j = i + np.repeat(np.arange(PAIRS) * 7919, n)
    x = ((good[i % len(good)] - bad[j % len(bad)]) / spread).astype(float)
    w = np.zeros(x.shape[1])
    loss = lambda w: np.logaddexp(0, -x @ w).mean() + ridge / 2 * w @ w
    for _ in range(ROUNDS):
        miss = 1 / (1 + np.exp(np.clip(x @ w, -500, 500)))
        slope = ridge * w - x.T @ miss / len(x)
        bend = (x * (miss * (1 - miss))[:, None]).T @ x / len(x) + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        size = 1.0
        while loss(w - size * step) > loss(w) - size * (slope @ step) / 4 and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return Model(tuple((w / spread).tolist()), tuple(center.tolist()))


def cut_at(bins: list[tuple[int, int]], below: int) -> float:
    """The strength halfway between those of rank `below` and the next, of a histogram (bin, rows)."""
    total, low, high = 0, None, None
    for place, rows in sorted(bins):
        if total < below <= total + rows:
            low = place
        if total <= below < total + rows:
            high = place
        total += rows
    found = [x for x in (low, high) if x is not None]
    return sum(found) / len(found) * STEP if found else 0.0


def train(examples: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of rows (doc_id, features, label): weights of a sample, the cut of all rows.

    The driver gets 2 * `sample` rows of features and a histogram of 2 * LIMIT / STEP bins.
    """
    rows = []
    for label in (1, 0):
        mine = examples.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("features"))
        found = mine.limit(sample).select("features").collect()
        rows.append(np.array([r.features for r in found], float).reshape(len(found), len(NAMES)))
    model = fit_pairs(*rows)
    place = F.round(model.strength() / STEP).cast("bigint")
    bins = examples.groupBy(place.alias("bin"), "label").agg(F.count("*").alias("rows")).collect()
    bad = sum(r["rows"] for r in bins if r["label"] == 0)
    return Model(model.weights, model.center, cut_at([(r["bin"], r["rows"]) for r in bins], bad))


def held_out(doc_id: str = "doc_id", fold: int = 2, folds: int = 4) -> Column:
    """Whether the id as text has the remainder of the fold that labels are not learned from; null: not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def learnable(labels: DataFrame, label: str = "quality") -> DataFrame:
    """(doc_id, label) of the labels that are learned from, one row for each id.

    Labels other than 0 and 1, null ids, held-out ids, and ids that have both labels are left out.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out())
    by_id = known.groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("other"))
    return by_id.where("label = other").drop("other")


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of `docs`.

    Scores depend on the text alone: equal texts, null and empty ones as well, have equal scores. A null id
    is not held out. Where labels of one class are lacking, there are no pairs and every score is THRESHOLD.
    Repeated rows of `docs` are scored each, and each counts as an example. Other columns play no part.
    """
    every = stored(features(docs.select("doc_id", "text")), "features")
    examples = stored(every.join(learnable(labels, label), "doc_id"), "examples")
    model = train(examples, sample)
    score = model.score()
    predicted = (score >= THRESHOLD).cast("int").alias("predicted")
    return every.select("doc_id", held_out().alias("held_out"), score.alias("score"), predicted)
