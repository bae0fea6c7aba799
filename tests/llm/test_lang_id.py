import numpy as np

from labelloom.llm import lang_id as g
from labelloom.llm.queries import op9_lang_id


def test_held_out_languages(spark):
    got = op9_lang_id(spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in got if r.held_out]
    assert len(got) == 1000 and len(held) > 150
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def kernel(a, b):
    a, b = set(g.ngram_places(a)), set(g.ngram_places(b))
    return len(a & b) / np.sqrt(len(a) * len(b))


def test_kernel_counts_shared_ngrams():
    grams = {x for n in (1, 2, 3) for i in range(len(" abab ")) if len(x := " abab "[i : i + n]) == n}
    assert len(g.ngram_places("Abab")) == len(grams)
    assert kernel("some words", "SOME 123 words!") == 1.0 and 0 < kernel("some words", "more swords") < 1


def test_folded_weights_are_kernel_ridge_regression_on_landmarks(docs_of, spark):
    rows = [(i, f"{'the of and' if i % 2 else 'der die und'} {i} {'w' * (i % 7)}") for i in range(60)]
    docs = docs_of(rows).selectExpr("doc_id", "text", "if(doc_id % 2 = 1, 'en', 'de') AS lang")
    model = g.fit(docs)
    texts = [t for _, t in sorted(((("de", "en")[i % 2], tuple(g.ngram_places(t))), t) for i, t in rows)]
    labels = ["de"] * 30 + ["en"] * 30
    gram = np.array([[kernel(a, b) for b in texts] for a in texts])
    # All rows are landmarks here, so the weights solve the ridge problem on the full kernel matrix.
    target = np.where(np.array(labels)[:, None] == np.array(model.languages), 1.0, -1.0)
    alpha = np.linalg.solve(gram.T @ gram + g.RIDGE * gram + 1e-8 * np.eye(60), gram.T @ target)
    got = g.scores(model, [g.ngram_places(t) for t in texts])
    assert np.allclose(got, gram @ alpha, atol=1e-3)


def test_edges(docs_of, spark):
    labelled = docs_of([(i, "the and of " * 3 if i % 2 else "der die das ") for i in range(40)])
    labelled = labelled.selectExpr("*", "if(doc_id % 2 = 1, 'en', 'de') AS lang")
    model = g.fit(labelled)
    docs = docs_of([(1, None), (2, ""), (3, "12 !? _ ²"), (4, "the"), (4, "the"), (None, "der die"), (6, "the and " * 100_000), (7, "日")])
    got = g.predict(docs, model).collect()
    pred = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert len(got) == 8 and pred[1] == pred[2] == pred[3] == ("und", 0.0)
    assert pred[4][0] == pred[6][0] == "en" and pred[None][0] == "de" and pred[7][0] in ("de", "en")
    assert sorted(str(r.doc_id) for r in g.recognised(docs, model).collect()) == ["4", "4", "6", "7", "None"]
    nothing = g.fit(labelled.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang"))
    assert {r.lang_pred for r in g.predict(docs, nothing).collect()} == {"und"}
    assert g.predict(docs_of([]), model).count() == 0 and g.recognised(docs, nothing).count() == 0
    one = g.fit(labelled.where("lang = 'en'"))
    assert {r.lang_pred for r in g.predict(docs, one).where("doc_id = 4").collect()} == {"en"}
