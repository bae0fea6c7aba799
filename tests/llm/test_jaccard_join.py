import random

import brute
import pytest
from pyspark.sql import functions as F
from test_near_dups import versions

from labelloom.llm import jaccard_join as j


def expected(docs, width=5):
    found = brute.near_duplicates(docs, width=width)
    return {i: (len(brute.shingles(brute.lower_words(t), width)), found[i]) for i, t in docs}


def result(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


@pytest.mark.parametrize("seed", [4, 5])
def test_against_all_pairs(spark, docs_of, seed):
    rng = random.Random(seed)
    texts = [None, "", " \n", "a b c", "A b C", "one two three four five", "one two three four five six"]
    for length, copies, edits in [(120, 60, [1, 2, 3, 5, 8]), (40, 40, [0, 1, 2]), (900, 10, [3, 20, 60]), (9, 30, [0, 1]), (60, 50, [3, 4])]:
        texts += versions(rng, length, copies, edits)
    # A passage that a third of all documents hold, and copies of one text.
    passage = " ".join(f"common{i}" for i in range(30))
    texts += [f"{passage} " + " ".join(f"q{rng.random()}" for _ in range(rng.choice([5, 12, 200]))) for _ in range(90)]
    texts += [texts[20]] * 40
    rng.shuffle(texts)
    docs = [(i * 3 - 50, t) for i, t in enumerate(texts)]
    want = expected(docs)
    assert len({c for _, c in want.values()}) < len(docs) - 60
    assert result(j.join_components(docs_of(docs))) == want


def test_pairs_at_the_very_threshold(docs_of):
    """Sets of 9 and 10 shingles that share 8 or 9: 9 / 10 and 8 / 10 link, 8 / 11 does not."""
    def text(*words):
        return " ".join(words)

    base = [f"w{i}" for i in range(13)]
    docs = [(1, text(*base)), (2, text(*base, "x")), (3, text("y", "z", *base[:-1])), (4, text(*base[1:], "q", "r"))]
    assert result(j.join_components(docs_of(docs))) == expected(docs)


def test_multi_match_alone_finds_all(spark, docs_of, monkeypatch):
    """Without the central comparisons the adaptive prefixes propose every link."""
    monkeypatch.setattr(j, "CENTRAL_ROUNDS", 0)
    rng = random.Random(8)
    texts = [t for length, copies, edits in [(80, 40, [1, 2, 3]), (300, 25, [2, 9, 14])] for t in versions(rng, length, copies, edits)]
    docs = list(enumerate(texts))
    assert result(j.join_components(docs_of(docs))) == expected(docs)


def test_prefixes_adapt(spark):
    """Where the prefix holds a frequent shingle, asking for more matches spares candidates."""
    def rows(cls, others):
        return [(cls, 100, s, 20 + s, n) for s, n in enumerate(others)]

    frame = spark.createDataFrame(rows(1, [1] + [0] * 3) + rows(2, [5_000] + [1] * 10) + rows(3, [5_000] * 11), "cls bigint, n bigint, shingle bigint, place bigint, others bigint")
    chosen = {r.cls: r.l for r in j.adapted(frame.where("others > 0")).collect()}
    assert chosen[1] >= 1 and chosen[2] > 5 and 1 <= chosen[3] <= 11
    # A set whose first shingle that others hold lies behind the shortest prefix is out.
    late = frame.where("cls = 2").withColumn("place", F.col("place") + 5)
    assert j.adapted(late).count() == 0


def test_repeated_rows_and_ids(docs_of):
    a, b, c = "a b c d e f g", "p q r s t u v", "k l m n o"
    docs = [(5, a), (5, a), (3, a), (None, a), (7, a), (7, b), (9, b), (2, b), (8, None), (8, c), (1, c), (6, ""), (2**60 + 1, "z z"), (2**60 + 3, "z z")]
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in j.join_components(docs_of(docs)).collect())
    big = 2**60 + 1
    assert got == sorted([
        ("5", 3, 2), ("5", 3, 2), ("3", 3, 2), ("None", 3, None), ("7", 3, 2), ("7", 3, 2), ("9", 3, 2), ("2", 3, 2), ("8", 0, 1), ("8", 1, 1),
        ("1", 1, 1), ("6", 0, 6), (str(big), 1, big), (str(big + 2), 1, big),
    ])
    assert j.join_components(docs_of([])).count() == 0


def test_very_long_texts(docs_of):
    rng = random.Random(3)
    words = [f"w{rng.random()}" for _ in range(200_000)]
    edited = [w if i % 60 else "x" for i, w in enumerate(words)]
    other = [w if i % 15 else "x" for i, w in enumerate(words)]
    docs = [(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join(other)), (4, "short text of few words only")]
    got = result(j.join_components(docs_of(docs)))
    assert {i: c for i, (_, c) in got.items()} == {1: 1, 2: 1, 3: 3, 4: 4}
