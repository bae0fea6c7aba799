import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from labelloom.llm import merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, place int, tree string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(doc):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in doc))


def tree(digests, fan):
    """Top and, for each leaf, its steps."""
    nodes, steps = [(d, [i]) for i, d in enumerate(digests)], [[] for _ in digests]
    while len(nodes) > 1:
        above = []
        for run in (nodes[i : i + fan] for i in range(0, len(nodes), fan)):
            for j, (_, below) in enumerate(run):
                for leaf in below:
                    steps[leaf].append(("".join(d for d, _ in run[:j]), "".join(d for d, _ in run[j + 1 :])))
            above.append((h("".join(d for d, _ in run)), [leaf for _, below in run for leaf in below]))
        nodes = above
    return nodes[0][0], steps


def expected(docs, fan=3):
    """(leaf, subroot, root, steps) of every row, sorted."""
    groups = {}
    for doc in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, leaf_of(d))):
        groups.setdefault(doc[1], []).append(doc)
    tops = {g: tree([leaf_of(d) for d in rows], fan) for g, rows in groups.items()}
    order = sorted(tops, key=lambda g: (g is not None, (g or "").encode()))
    root, above = tree([tops[g][0] for g in order], fan)
    return sorted(
        (leaf_of(d), tops[g][0], root, tops[g][1][i] + above[order.index(g)]) for g, rows in groups.items() for i, d in enumerate(rows)
    )


def frame(spark, docs):
    return spark.createDataFrame([(i, s, la, n, t, "x", -1, None) for i, s, la, n, t in docs], SCHEMA)


def result(rows):
    return sorted((r.leaf, r.subroot, r.root, [tuple(s) for s in r.proof]) for r in rows.collect())


def docs_of(seed, n, sources):
    rng = random.Random(seed)
    return [
        (i, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, 0, 7]), rng.choice([None, "", "a\nb", "é\n" * rng.randrange(4)]))
        for i in rng.sample(range(-5 * n, 5 * n), n)
    ]


# One source of a third of all rows; the null source, an empty name and names in byte order.
SOURCES = ["hot"] * 3 + [None, "", "Z", "a", "é", "\U0001f600"]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28, 200])
def test_against_the_definition(spark, n):
    docs = docs_of(n, n, SOURCES)
    assert result(merkle.manifest(frame(spark, docs))) == expected(docs)


@pytest.mark.parametrize("height", [1, 2])
def test_blocks_do_not_show(spark, height):
    """Small blocks, so that many rounds pass digests up and proofs down."""
    docs = docs_of(height, 150, ["one"] * 9 + SOURCES)
    leaves = frame(spark, docs).select("doc_id", "source", merkle.digest(*map(F.col, ("doc_id", "source", "lang", "n_chars", "text"))).alias("leaf"))
    assert result(merkle.prove(leaves, "source", ["doc_id"], height=height)) == expected(docs)


def test_another_fan(spark):
    docs = docs_of(3, 60, SOURCES)
    leaves = frame(spark, docs).select("doc_id", "source", merkle.digest(*map(F.col, ("doc_id", "source", "lang", "n_chars", "text"))).alias("leaf"))
    assert result(merkle.prove(leaves, "source", ["doc_id"], fan=2, height=3)) == expected(docs, fan=2)


def test_repeated_rows_null_and_large_ids(spark):
    docs = [(None, "s", "en", 1, "a"), (None, "s", "en", 1, "b")] + [(2**60 + i, "s", None, None, "x" * 300_000) for i in (1, 3, -1)]
    docs += [(5, "s", "en", 1, "same")] * 30 + [(-(2**60) - 1, None, None, None, None)]
    rows = merkle.manifest(frame(spark, docs))
    assert result(rows) == expected(docs)
    assert {r.doc_id for r in rows.collect()} == {d[0] for d in docs}


def test_tampering_shows(spark):
    docs = docs_of(8, 90, SOURCES)
    given = frame(spark, docs)
    found = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace(given["text"], F.lit("\n"), F.lit("")))
    rows = merkle.manifest(given, found).withColumn("now", merkle.folded(F.coalesce("found_leaf", "leaf"), F.col("proof")))
    rows = rows.withColumn("digest", merkle.proof_digest(F.col("proof"))).collect()
    texts = {d[0]: d[4] for d in docs}
    for r in rows:
        changed = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in (texts[r.doc_id] or "")
        assert (r.now == r.root) != changed
        assert r.digest == h("".join(a + b for a, b in r.proof))
    assert len({r.now for r in rows}) > 2


def test_no_rows(spark):
    assert merkle.manifest(frame(spark, [])).count() == 0
