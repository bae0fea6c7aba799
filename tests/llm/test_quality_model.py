import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.llm import quality_model as q
from labelloom.llm.queries import fold, op4_quality_model


@pytest.fixture
def labels_of(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id bigint, label int")


def test_held_out_documents_are_told_apart(spark):
    got = op4_quality_model(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = got.join(truth, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in rows)
    assert len(rows) > 60 and right / len(rows) > 0.9
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    every = got.collect()
    assert len(every) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in every)


def test_held_out_labels_do_not_count(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", F.col("quality").cast("int").alias("label"))
    turned = labels.withColumn("label", F.when(fold(4) == 2, 1 - F.col("label")).otherwise(F.col("label")))
    one, two = (q.fit(documents.where(fold(4) != 2), x.where(fold(4) != 2)) for x in (labels, turned))
    assert np.array_equal(one.weights, two.weights) and one.bias == two.bias


def test_one_update_is_the_formula():
    place, x = np.array([5], np.int32), np.array([1.0], np.float32)
    model = q.ftrl([(place, x)], [1], epochs=1)
    g = -0.5  # sigmoid(0) - 1
    shrunk = abs(g) - q.L1
    assert model.weights[5] == pytest.approx(shrunk / ((q.BETA + abs(g)) / q.ALPHA + q.L2))
    assert np.count_nonzero(model.weights) == 1


def test_features_of_repeats_and_marks():
    assert len(q.features(b"")[0]) == 0
    places, values = q.features(b"the%%% the%%%")
    assert math.isclose(float(values @ values), 1, rel_tol=1e-5)
    again, _ = q.features(b"on%%% on%%%")
    assert set(places) & set(again)  # the mark and the back-references


def test_edges(docs_of, labels_of):
    docs = docs_of([(1, "good words here"), (2, "bad!! bad!!"), (3, None), (4, ""), (4, ""), (None, "x " * 100_000)])
    nothing = q.predict(docs, q.fit(docs, labels_of([])))
    assert sorted(r.score for r in nothing.collect()) == [0.5] * 6
    # Conflicting, null and foreign labels are no labels.
    model = q.fit(docs, labels_of([(1, 1), (2, 0), (2, 0), (3, 1), (3, 0), (None, 1), (4, None), (9, 1)]))
    scores = {r.doc_id: r.score for r in q.predict(docs, model).collect()}
    assert scores[1] > scores[2] and scores[3] == scores[4]
    assert q.predict(docs_of([]), model).count() == 0
