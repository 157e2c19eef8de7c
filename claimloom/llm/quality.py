"""Quality scores by Bradley-Terry pairwise ranking.

``fit_ranking`` turns labelled documents into preference pairs (a document of
label 1 is preferred to one of label 0) and learns weights w by logistic loss
on feature differences: P(a before b) = sigmoid(w . (f(a) - f(b))). The ranking
score w . f is cut at a quantile of the labelled scores: the one that leaves as
many documents below it as have label 0. ``score_documents`` maps the ranking
score to (0, 1) so that this cut lies at ``cut``.

Features describe the whole text and nothing else. Null and empty texts have
the features of an empty text and are scored like any other. Labels that are
null or belong to no document are ignored; a document labelled twice counts
twice; without both labels the score is the constant ``cut`` for every row.
Rows of ``docs`` may repeat and may have null ids: each gives one row. Extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

MAX_LABELLED = 20_000  # labelled documents the ranking is fitted on, drawn by hash
PAIRS = 200_000
CUT = 0.3
FEATURES = (
    "length", "line_length", "word_length", "upper", "digit", "symbol", "bar", "exclaim",
    "distinct", "repeat", "symbol_words", "capital_words", "stops", "sentences", "short_words", "top_share",
)
_ROWS = 256
_UPPER = bytes(range(65, 91))
_DIGIT = bytes(range(48, 58))
_SYMBOL = b"#$%&*+<=>@[]\\^_`{}~"
_END = re.compile(r"[#$%&*!|]+(?:\s|$)")


def text_features(text: str | None) -> np.ndarray:
    """Shares and logarithms that describe a text, in the order of ``FEATURES``."""
    text = text or ""
    raw = text.encode()
    n = len(raw) + 1
    words = text.split()
    count = len(words) + 1

    def share(characters: bytes) -> float:
        return (len(raw) - len(raw.translate(None, characters))) / n

    table: dict[str, int] = {}
    for word in words:
        table[word] = table.get(word, 0) + 1
    return np.array([
        np.log1p(count),
        np.log1p(n / (text.count("\n") + 1)),
        np.log1p(n / count),
        share(_UPPER),
        share(_DIGIT),
        share(_SYMBOL),
        text.count("|") / count,
        text.count("!") / count,
        len(table) / count,
        sum(map(str.__eq__, words, words[1:])) / count,
        len(_END.findall(text)) / count,
        sum(w.isupper() and len(w) > 1 for w in table) / (len(table) + 1),
        (text.count(",") + text.count(".")) / count,
        (text.count(". ") + text.count(".\n")) / count,
        sum(len(w) <= 3 for w in words) / count,
        max(table.values(), default=0) / count,
    ])


@dataclass(frozen=True)
class Ranking:
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    threshold: float  # ranking score at the quantile
    spread: float  # of the labelled ranking scores

    def score(self, features: np.ndarray, cut: float) -> np.ndarray:
        """Probability-like scores; the threshold is mapped to ``cut``."""
        rank = ((features - np.array(self.mean)) / np.array(self.scale)) @ np.array(self.weights)
        z = 4 * (rank - self.threshold) / self.spread + np.log(cut / (1 - cut))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _features(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            piece = batch.slice(start, _ROWS)
            yield piece, np.stack([text_features(t) for t in piece.column(column).to_pylist()])


def labelled_features(
    docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, max_labelled: int
) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``max_labelled`` documents, the first by hash of their id."""
    spark = docs.sparkSession
    drawn = (
        labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull())
        .select(F.col(id).alias("_id"), F.col(label).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id", "_label")
        .limit(max_labelled)
    )
    ids = spark.createDataFrame(drawn.collect(), drawn.schema)  # bounded by max_labelled
    texts = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(ids), "_id")

    def measure(batches):
        for piece, features in _features(batches, 1):
            arrays = [piece.column(0), pa.array(features.tolist(), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["label", "features"])

    found = texts.select("_label", "_text").mapInArrow(measure, "label int, features array<double>").toArrow()
    features = np.array(found.column("features").to_pylist(), float).reshape(-1, len(FEATURES))
    return features, found.column("label").to_numpy().astype(int)


def fit_ranking(features: np.ndarray, labels: np.ndarray, pairs: int = PAIRS, penalty: float = 1e-3) -> Ranking | None:
    """Weights by Newton steps on the pairwise logistic loss; None without both labels."""
    good, bad = features[labels == 1], features[labels == 0]
    if not len(good) or not len(bad):
        return None
    order = np.lexsort(features.T)  # the fit must not depend on the order in which rows arrive
    good, bad = (features[order][labels[order] == v] for v in (1, 0))
    mean, scale = features.mean(0), features.std(0) + 1e-6
    draw = np.random.default_rng(0)
    x = (good[draw.integers(len(good), size=pairs)] - bad[draw.integers(len(bad), size=pairs)]) / scale
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - 1) / pairs + penalty * w
        hessian = (x.T * (p * (1 - p))) @ x / pairs + penalty * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    ranks = np.sort(((features - mean) / scale) @ w)
    threshold = (ranks[len(bad) - 1] + ranks[min(len(bad), len(ranks) - 1)]) / 2
    return Ranking(tuple(mean), tuple(scale), tuple(w), float(threshold), float(ranks.std() + 1e-9))


def score_documents(docs: DataFrame, ranking: Ranking | None, text: str, keep: dict[str, Column], cut: float = CUT) -> DataFrame:
    """(columns of ``keep``, score) per row of ``docs``."""

    def measure(batches):
        for piece, features in _features(batches, 0):
            scores = np.full(len(features), cut) if ranking is None else ranking.score(features, cut)
            columns = [*piece.columns[1:], pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=[*piece.schema.names[1:], "score"])

    rows = docs.select(F.col(text).alias("_text"), *[c.alias(name) for name, c in keep.items()])
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(measure, f"{fields}, score double")


def rank_quality(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    cut: float = CUT,
    max_labelled: int = MAX_LABELLED,
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """Fit on ``labels`` and score every row: (columns of ``keep``, score, predicted)."""
    features, known = labelled_features(docs, labels, id, text, label, max_labelled)
    scored = score_documents(docs, fit_ranking(features, known), text, keep or {id: F.col(id)}, cut)
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int"))
