"""Language identification by string kernels.

The kernel of two texts counts the character n-grams, of all lengths of a spectrum blended together,
that are present in both, divided by the geometric mean of their own numbers of n-grams. N-grams are
hashed into ``BUCKETS`` places. A few texts of the training sample serve as Nyström landmarks; kernel
ridge regression on them, one class against the rest, gives a weight per landmark and class.

The score of a text is a product of three matrices: its presence row, the presence of n-grams in the
landmarks (each row divided by its norm), the weights. The last two are multiplied once, after the
fit; each batch of texts is then one sparse product.
"""

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.words import only, texts

# N-grams of 1 to so many characters.
SPECTRUM = 3
BUCKETS = 1 << 16
UNKNOWN = "und"
# The fit reads a bounded sample: about so many rows of each language, and of all languages together.
ROWS_PER_LANGUAGE = 400
MAX_ROWS = 4_000
LANDMARKS = 256
RIDGE = 1e-2
_MULTIPLIER = np.uint32(0x9E3779B1)
_SHIFT = np.uint32(32 - BUCKETS.bit_length() + 1)
_SEED = 17
_NOT_LETTERS = re.compile(r"[\W\d_]+")


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages
    bias: np.ndarray


def ngram_places(text: str) -> np.ndarray:
    """Places of the n-grams present in a text, in order. Letters are lower-cased; every run of
    characters other than letters counts as one space, so layout and numbers tell nothing."""
    points = np.frombuffer(_letters(text).encode("utf-32-le", "replace"), np.uint32) * _MULTIPLIER
    present = np.zeros(BUCKETS, bool)
    h = np.zeros(len(points) + 1, np.uint32)
    for n in range(1, min(SPECTRUM, len(points)) + 1):
        h = (h[:-1] ^ points[n - 1 :]) * _MULTIPLIER
        h ^= h >> np.uint32(15)
        present[h >> _SHIFT] = True
    return np.flatnonzero(present)


def _letters(text: str) -> str:
    return " " + _NOT_LETTERS.sub(" ", text.lower()).strip() + " "


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places = [ngram_places(t.decode()).astype(np.int32) for t in texts(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), pa.array(places, pa.list_(pa.int32()))], names=["lang", "places"]
        )


def _sample(labelled: DataFrame) -> DataFrame:
    """About ``ROWS_PER_LANGUAGE`` rows of each language, drawn by a hash of the id: counts first,
    then every language keeps the share that gives so many rows."""
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return labelled.limit(0)
    wanted = min(ROWS_PER_LANGUAGE, max(1, MAX_ROWS // len(counts)))
    shares = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, wanted / n))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(_SEED)), F.lit(1_000_000)) / 1_000_000
    return labelled.where(draw < shares[F.col("lang")])


def fit(docs: DataFrame) -> Model:
    """Learns from rows with a language and at least one letter. Only n-gram places of the bounded
    sample reach the driver. Without such rows the model knows no language."""
    labelled = only(docs, "doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    rows = _sample(labelled).mapInArrow(_presence, "lang string, places array<int>").toArrow()
    pairs = sorted(
        (lang, tuple(places)) for lang, places in zip(rows["lang"].to_pylist(), rows["places"].to_pylist()) if len(places) > 3
    )
    if not pairs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    labels = [lang for lang, _ in pairs]
    places = [np.array(p) for _, p in pairs]
    languages = sorted(set(labels))
    marks = _landmarks(labels, languages)
    kernel = _kernel(places, [places[i] for i in marks])  # rows x landmarks
    among = kernel[marks]
    target = np.where(np.array(labels)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    bias = np.zeros(len(languages)) if len(languages) > 1 else np.ones(1)
    # Every language weighs the same, however many rows it has.
    weight = np.array([1.0 / labels.count(lang) for lang in labels])
    weight *= len(labels) / weight.sum()
    weighted = kernel * weight[:, None]
    gram = kernel.T @ weighted + RIDGE * len(labels) / len(marks) * among + 1e-8 * np.eye(len(marks))
    alpha = np.linalg.solve(gram, weighted.T @ (target - bias))
    folded = np.zeros((BUCKETS, len(languages)), np.float64)
    for row, i in zip(alpha, marks):
        folded[places[i]] += row / np.sqrt(len(places[i]))
    return Model(languages, folded.astype(np.float32), bias)


def _landmarks(labels: list[str], languages: list[str]) -> list[int]:
    """Rows taken in turn from every language, spread evenly over each one's rows."""
    share = max(1, LANDMARKS // len(languages))
    marks: list[int] = []
    for lang in languages:
        own = [i for i, label in enumerate(labels) if label == lang]
        marks += [own[j * len(own) // min(share, len(own))] for j in range(min(share, len(own)))]
    return marks


def _kernel(rows: list[np.ndarray], marks: list[np.ndarray]) -> np.ndarray:
    dense = np.zeros((BUCKETS, len(marks)), np.float32)
    for j, m in enumerate(marks):
        dense[m, j] = 1 / np.sqrt(len(m))
    return np.array([dense[r].sum(axis=0, dtype=np.float64) / np.sqrt(len(r)) for r in rows])


def scores(model: Model, places: list[np.ndarray]) -> np.ndarray:
    """Decision values of texts given by their n-gram places (none empty): one product per batch."""
    sizes = np.array([len(p) for p in places])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    sums = np.add.reduceat(model.weights[np.concatenate(places)].astype(np.float64), starts, axis=0)
    return sums / np.sqrt(sizes)[:, None] + model.bias


def classify(model: Model, batch_texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    langs, certainty = [UNKNOWN] * len(batch_texts), np.zeros(len(batch_texts))
    known = [i for i, t in enumerate(batch_texts) if t is not None and model.languages and has_letter(t)]
    for at in range(0, len(known), 64):
        part = known[at : at + 64]
        values = scores(model, [ngram_places(batch_texts[i]) for i in part])
        best = values.argmax(axis=1)
        for i, b, v in zip(part, best, values):
            langs[i] = model.languages[b]
            certainty[i] = min(1.0, max(0.0, (v[b] + 1) / 2))
    return langs, certainty


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1, how clearly the text belongs to the class).

    One output row per row, repeated rows and null ids included. A text that is null or holds no
    letter is ``und`` with a score of 0, and so is every text when the model knows no language. Equal
    scores go to the language that sorts first.
    """

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, certainty = classify(model, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(certainty, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return only(docs, "doc_id", "text").mapInArrow(predicted, "doc_id bigint, lang_pred string, score double")


def recognised(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text is in some language, judged in place."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, _ = classify(model, batch.column("text").to_pylist())
            yield batch.filter(pa.array([lang != UNKNOWN for lang in langs], pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
