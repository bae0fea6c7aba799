"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL-proximal.

Tokens are runs of letters and digits or runs of other marks, so ``the%%%`` is a word and a mark.
Features are single tokens, pairs of neighbours, and back-references: an n-gram whose last token
repeats its first counts once more with both tokens left out, whatever they are. All are hashed into
``BUCKETS`` places. A value is the square root of the feature's share of all features, so every text
has a vector of length one. The weights come from one pass after another of follow-the-regularised-
leader updates (McMahan et al., 2013) and a score is one sparse dot product.
"""

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.words import mixed, only, texts, word_hashes

BUCKETS = 1 << 18
BACK_REFERENCES = 4  # n-grams of 2 to so many tokens plus one
# The fit reads about so many labelled rows, drawn by a hash of the id.
MAX_ROWS = 6_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.05
THRESHOLD = 0.7
_TOKEN = re.compile(rb"[A-Za-z0-9\x80-\xff]+|[^\sA-Za-z0-9\x80-\xff]+")
_SEED = 29


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text, places in order. An empty text has none."""
    tokens = _TOKEN.findall(text)
    if not tokens:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    h = word_hashes(tokens)
    pairs = mixed(h[:-1] * np.uint64(3) + h[1:])
    backs = [
        np.full(np.count_nonzero(h[d:] == h[:-d]), d, np.uint64) for d in range(1, min(BACK_REFERENCES, len(h) - 1) + 1)
    ]
    places = (mixed(np.concatenate([h, pairs, *backs])) % np.uint64(BUCKETS)).astype(np.int32)
    found, times = np.unique(places, return_counts=True)
    return found, np.sqrt(times / len(places)).astype(np.float32)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], epochs: int = EPOCHS) -> Model:
    """Weights after ``epochs`` passes in a fixed shuffled order. The bias learns like a feature."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    rng = np.random.default_rng(_SEED)

    def weights(at) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at = np.append(rows[i][0], BUCKETS)
            x = np.append(rows[i][1], 0.5).astype(np.float64)
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - labels[i]) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    final = weights(slice(None))
    return Model(final[:BUCKETS].astype(np.float32), float(final[BUCKETS]) * 0.5)


def score(model: Model, text: bytes) -> float:
    places, values = features(text)
    total = float(model.weights[places] @ values) + model.bias if len(places) else model.bias
    return float(1 / (1 + np.exp(-np.clip(total, -35, 35))))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t) for t in texts(batch)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("label"),
                pa.array([p for p, _ in rows], pa.list_(pa.int32())), pa.array([v for _, v in rows], pa.list_(pa.float32())),
            ],
            names=["doc_id", "label", "places", "values"],
        )


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Learns from documents with a label (``doc_id``, ``label`` 0 or 1). At most about ``max_rows``
    labels are drawn and only their features reach the driver. An id labelled both ways is left out.
    Without labels every score is one half."""
    one = labels.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(
        F.min("label").alias("label"), F.max("label").alias("high")
    ).where("label = high").select("doc_id", "label")
    n = one.count()
    share = min(1.0, max_rows / max(n, 1))
    drawn = one.where(F.pmod(F.xxhash64("doc_id", F.lit(_SEED)), F.lit(1_000_000)) < share * 1_000_000)
    drawn = drawn.limit(2 * max_rows)  # never reached: what is drawn is max_rows on average
    # At most 2 * max_rows rows of two numbers are broadcast.
    rows = only(docs, "doc_id", "text").join(F.broadcast(drawn), "doc_id").mapInArrow(
        _featured, "doc_id bigint, label int, places array<int>, values array<float>"
    ).toArrow().sort_by("doc_id")
    if not rows.num_rows:
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    places, values = rows["places"].combine_chunks(), rows["values"].combine_chunks()
    pairs = [(places[i].values.to_numpy(), values[i].values.to_numpy()) for i in range(rows.num_rows)]
    return ftrl(pairs, rows["label"].to_pylist())


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row: how likely the text is of label 1. A null text counts as an
    empty one, whose score is that of the bias. Repeated rows and null ids come out as they went in."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([score(model, t) for t in texts(batch)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], names=["doc_id", "score"])

    return only(docs, "doc_id", "text").mapInArrow(scored, "doc_id bigint, score double")
