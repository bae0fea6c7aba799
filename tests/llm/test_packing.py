from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labelloom.llm import packing as k

LENGTHS = (8, 16, 32)


def cheapest(lengths, permitted):
    """Cost of the best of all packings."""
    best = float("inf")
    for places in product(range(len(lengths)), repeat=len(lengths)):
        used = [sum(n for n, p in zip(lengths, places) if p == b) for b in set(places)]
        if max(used) <= permitted[-1]:
            best = min(best, sum(k.cost(k.downsized(u, permitted)) for u in used))
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), min_size=1, max_size=5))
def test_small_packings_are_valid_and_near_the_optimum(lengths):
    lengths = sorted(lengths, reverse=True)
    bins = k.pack(lengths, LENGTHS)
    assert sorted(i for _, b in bins for i in b.items) == list(range(len(lengths)))
    for capacity, b in bins:
        assert sum(lengths[i] for i in b.items) == b.used and capacity == k.downsized(b.used, LENGTHS)
    assert sum(k.cost(c) for c, _ in bins) <= 1.5 * cheapest(lengths, LENGTHS)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_best_fit_takes_the_tightest_bin(lengths):
    lengths, rooms = sorted(lengths, reverse=True), []
    for length in lengths:
        fitting = [r for r in rooms if r >= length]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - length)
        else:
            rooms.append(32 - length)
    got = k.best_fit(lengths, lambda length, left: 32)
    assert sorted(32 - b.used for b in got) == sorted(rooms)


def check(rows, permitted):
    bins = {}
    for r in rows:
        if r.length:
            bins.setdefault(r.bin_id, []).append(r)
        else:
            assert r.bin_id is None and r.capacity is None
    for own in bins.values():
        own.sort(key=lambda r: r.offset)
        at = 0
        for r in own:
            assert r.offset == at
            at += r.length
        assert {r.capacity for r in own} == {k.downsized(at, permitted)}


def test_every_word_is_in_one_place(documents):
    rows = k.pack_documents(documents, shard=60).collect()
    check(rows, k.LENGTHS)
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
    for r in documents.collect():
        at = 0
        for start, length in sorted(pieces[r.doc_id]):
            assert start == at
            at += length
        assert at == len(r.text.encode().split())


def test_edges(docs_of):
    docs = docs_of([(1, None), (2, ""), (3, "a " * 8), (4, "a " * 32), (5, "a " * 71), (6, "b"), (6, "b"), (None, "c d"), (None, "e " * 32)])
    rows = k.pack_documents(docs, LENGTHS).collect()
    check(rows, LENGTHS)
    lengths = sorted((str(r.doc_id), r.piece, r.length) for r in rows)
    assert lengths == [
        ("1", 0, 0), ("2", 0, 0), ("3", 0, 8), ("4", 0, 32), ("5", 0, 32), ("5", 1, 32), ("5", 2, 7), ("6", 0, 1), ("6", 0, 1),
        ("None", 0, 2), ("None", 0, 32),
    ]
    assert k.pack_documents(docs_of([]), LENGTHS).count() == 0


def test_given_lengths_and_cheaper_bins(docs_of):
    docs = docs_of([(i, "x") for i in range(40)])
    rows = k.pack_documents(docs, (512, 1024), length=F.lit(300)).collect()
    check(rows, (512, 1024))
    assert len({r.bin_id for r in rows}) == 14  # three to a bin of 1024: cheaper than forty of 512
    assert {r.length for r in k.pack_documents(docs, length=F.lit(None).cast("int")).collect()} == {0}
    assert k.cost(1024) < 2 * k.cost(512) and pytest.approx(k.cost(512)) == 592


def test_large_ids_next_to_null_ones(docs_of):
    """Ids that a float cannot tell apart, in one shard with a null id."""
    ids = [2**60 + 1, 2**60 + 3, -(2**60) - 1, -(2**60) - 3, None, None]
    rows = k.pack_documents(docs_of([(i, "w " * (n + 1)) for n, i in enumerate(ids)]), LENGTHS).collect()
    assert sorted((str(r.doc_id), r.length) for r in rows) == sorted((str(i), n + 1) for n, i in enumerate(ids))


def test_equal_pieces_are_dealt_to_all_shards(spark):
    """Rows without an id that are all alike: a third and more of everything, in no shard more than in others."""
    docs = spark.range(30_000).selectExpr("if(id < 24000, NULL, id) AS doc_id", "'a b c' AS text")
    rows = k.pack_documents(docs, (32, 64), shard=5_000)
    shards = {}
    for r in rows.collect():
        shards[r.bin_id.split("-")[0]] = shards.get(r.bin_id.split("-")[0], 0) + 1
    sizes = sorted(shards.values())
    assert sum(sizes) == 30_000 and len(sizes) == 6 and sizes[-1] < 1.2 * sizes[0]


def test_bins_do_not_depend_on_the_partitioning(docs_of):
    docs = docs_of([(i % 50, "w " * (i * 7 % 90)) for i in range(400)] + [(None, "w " * 40)] * 5)
    one, two = (sorted(map(str, k.pack_documents(docs.repartition(n), LENGTHS, shard=40).collect())) for n in (1, 9))
    assert one == two
