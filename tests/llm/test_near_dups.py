import random

import brute
import numpy as np
import pytest

from labelloom.llm import near_dups as n
from labelloom.llm.components import components


def result(frame):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in frame.collect()}


def expected(docs):
    found = brute.near_duplicates(docs, width=4)
    return {i: (len(brute.shingles(brute.lower_words(t), 4)), found[i], found[i] == i) for i, t in docs}


def versions(rng, length, copies, edits):
    """Versions of one page, each with some words of its own; far and near ones among them."""
    page = [f"p{rng.random()}" for _ in range(length)]
    for _ in range(copies):
        own = list(page)
        for _ in range(rng.choice(edits)):
            own[rng.randrange(length)] = f"e{rng.random()}"
        yield " ".join(own)


def test_against_all_pairs(spark, docs_of):
    rng = random.Random(11)
    texts = [None, "", " \n", "a b c", "A b C", "one two three four", "one two three four five"]
    for length, copies, edits in [(120, 80, [1, 2, 3, 5, 8]), (40, 40, [0, 1, 2]), (1_000, 12, [3, 20, 60]), (9, 30, [0, 1])]:
        texts += versions(rng, length, copies, edits)
    texts += [texts[20]] * 40
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    want = expected(docs)
    assert len({c for _, c, _ in want.values()}) < len(docs) - 60
    assert result(n.near_duplicates(docs_of(docs))) == want


def test_repeated_rows_and_ids(docs_of):
    docs = [(5, "a b c d e f"), (5, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (7, None), (7, "x y z w v")]
    got = n.near_duplicates(docs_of(docs)).collect()
    rows = sorted((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in got)
    assert rows == [
        ("3", 3, 3, True), ("5", 3, 3, False), ("5", 3, 3, False), ("7", 0, 7, True), ("7", 2, 7, True), ("None", 3, None, True),
    ]
    assert n.near_duplicates(docs_of([])).count() == 0


def test_odd_sketch_estimates_similarity():
    rng = np.random.default_rng(5)
    common = rng.integers(0, 2**63, 900, dtype=np.uint64)
    for own in (0, 50, 112, 400):
        sides = [np.concatenate([common, rng.integers(0, 2**63, own, dtype=np.uint64)]) for _ in range(2)]
        similarity = 900 / (900 + 2 * own)
        a, b = (n.minima(s) for s in sides)
        assert abs(np.mean(a == b) - similarity) < 0.13
        sketches = n.odd_sketches(np.stack([a, b])).view(np.uint64)
        differing = int(np.bitwise_count(sketches[0] ^ sketches[1]).sum())
        estimate = 1 + np.log(max(1e-9, 1 - 2 * differing / n.SKETCH_BITS)) * n.SKETCH_BITS / (4 * n._SAMPLES)
        assert abs(estimate - similarity) < 0.15
        assert similarity < 0.79 or differing <= n.max_differing_bits()


@pytest.mark.parametrize("shape", ["path", "star", "mixed"])
def test_components(spark, shape):
    rng = random.Random(2)
    links = {
        "path": [(i + 1, i) for i in range(60)],
        "star": [(0, i) for i in range(1, 60)] + [(70, 71), (71, 70), (72, 72)],
        "mixed": [(rng.randrange(90), rng.randrange(90)) for _ in range(70)] + [(None, 3)],
    }[shape]
    parent = {x: x for link in links for x in link}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {x: root(x) for a, b in links if a is not None and a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
