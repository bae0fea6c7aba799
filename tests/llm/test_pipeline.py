import brute

import corpus_pipeline as pipeline
from labelloom.llm import lang_id, pseudonyms
from labelloom.llm.words import WORD


def test_run_against_brute_force(spark, sf_dir, documents):
    packed = pipeline.run(spark, sf_dir).collect()
    rows = {r.doc_id: r.text for r in documents.collect() if lang_id.has_letter(r.text or "")}
    groups = brute.near_duplicates(list(rows.items()), width=pipeline.SHINGLE_WORDS)
    kept = [(i, t) for i, t in rows.items() if groups[i] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaked = {i for i, _ in brute.contained(kept, items)}
    expected = {i: len(t.encode().split()) for i, t in kept if i not in leaked}
    assert leaked and len(kept) < len(rows)
    lengths = {}
    for r in packed:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == expected


def test_stages_keep_the_columns_of_documents(spark, sf_dir, docs_of):
    docs = docs_of([(1, "the and of 10.0.0.1"), (1, "the and of 10.0.0.1"), (2, None), (3, ""), (None, "der die"), (4, "the and of 10.0.0.1")])
    docs = docs.selectExpr("*", "'en' AS lang", "'s' AS source", "0L AS n_chars", "1 AS bin_id", "true AS kept", "1 AS bands")
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == list(pipeline.COLUMNS), name
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "None"]
    one = docs.where("doc_id = 1").first()
    assert "10.0.0.1" not in one.text and one.n_chars == len(one.text)
    assert sorted(r.length for r in pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()) == [2, 4]
    assert pipeline.STAGES[-1][1](spark, docs.limit(0), sf_dir).count() == 0


def test_near_duplicates_are_judged_by_five_words(spark, sf_dir, docs_of):
    """Two edits far apart cost eight of 85 shingles of four words, but ten of 84 of five."""
    words = [f"w{i}" for i in range(88)]
    edited = [f"x{i}" if i in (30, 60) else w for i, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(edited))]
    assert brute.near_duplicates(rows, width=4) == {1: 1, 2: 1} and brute.near_duplicates(rows, width=5) == {1: 1, 2: 2}
    docs = docs_of(rows).selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "0L AS n_chars")
    assert sorted(r.doc_id for r in pipeline.near_duplicates(spark, docs, sf_dir).collect()) == [1, 2]


def test_near_duplicate_stage_against_brute_force(spark, sf_dir, documents):
    groups = brute.near_duplicates([(r.doc_id, r.text) for r in documents.collect()], width=pipeline.SHINGLE_WORDS)
    kept = [r.doc_id for r in pipeline.near_duplicates(spark, documents, sf_dir).select("doc_id").collect()]
    assert sorted(kept) == sorted(i for i, group in groups.items() if group == i)


def test_pseudonyms_replace_what_is_found(spark, sf_dir, documents):
    before = {r.doc_id: r for r in pseudonyms.report(documents, pipeline.KEY).collect()}
    after = pipeline.pseudonymised(spark, documents, sf_dir).collect()
    assert any(r.found for r in before.values())
    for r in after:
        was = before[r.doc_id]
        assert r.text == was.text and r.n_chars == len(r.text)
        assert all(old not in r.text for old, new in zip(was.found, was.new) if old != new)


def test_word_pattern_is_the_byte_split(spark):
    text = "a\x1cb\x85c d \t\n\x0b\x0c\re  f"
    import re

    assert [w.encode() for w in re.findall(WORD, text)] == text.encode().split()


def frame(docs_of, rows, lang="'en'"):
    return docs_of(rows).selectExpr("doc_id", "text", f"{lang} AS lang", "'s' AS source", "0L AS n_chars")


def test_texts_that_share_an_id_stay_both(spark, sf_dir, docs_of):
    rows = [(1, "alpha beta gamma"), (1, "quite another text here"), (1, "alpha beta gamma"), (2, None), (2, "real words"), (None, "real words")]
    kept = pipeline.near_duplicates(spark, frame(docs_of, rows), sf_dir).collect()
    assert sorted(map(str, [(r.doc_id, r.text) for r in kept])) == sorted(map(str, [*rows[:2], *rows[3:]]))


def test_language_without_labels_keeps_what_has_a_letter(spark, sf_dir, docs_of):
    rows = [(1, "words"), (2, "12 34"), (3, None), (4, ""), (5, "\u4e2d\u6587"), (6, "7 \u0660 \u00aa")]
    kept = pipeline.language(spark, frame(docs_of, rows, "CAST(NULL AS string)"), sf_dir).collect()
    assert sorted(r.doc_id for r in kept) == [i for i, t in rows if lang_id.has_letter(t or "")] == [1, 5, 6]


def test_large_ids_next_to_null_ones_through_all_stages(spark, sf_dir, docs_of):
    ids = [2**60 + 1, 2**60 + 3, -(2**60) - 1, None]
    docs = frame(docs_of, [(i, f"text number {n} of words " + "long " * n * 3000) for n, i in enumerate(ids)])
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    lengths = {}
    for r in docs.collect():
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == {i: 5 + n * 3000 for n, i in enumerate(ids)}
