import random

import brute
import pytest

from labelloom.llm import decontaminate as d

ITEMS = [(1, "the quick brown fox jumps over the lazy dog tonight"), (2, "Two Words"), (3, None), (4, " "), (5, "one two three four five six seven")]


@pytest.fixture
def items_of(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id bigint, text string")


def pairs(frame):
    return sorted((r.doc_id, r.item_id) for r in frame.collect())


def test_small_cases(docs_of, items_of):
    texts = [
        None, "", "two", "say TWO words here", "The quick\nbrown fox jumps over the lazy dog tonight", "quick brown fox",
        "one two three four five six eight seven", "x " * 50_000 + ITEMS[0][1], "two words",
    ]
    docs = list(enumerate(texts)) + [(3, texts[3])]
    got = pairs(d.contaminated(docs_of(docs), items_of(ITEMS)))
    assert got == [(3, 2), (3, 2), (4, 1), (7, 1)]
    assert set(got) == brute.contained(docs, ITEMS)


def test_random_long_and_short_documents_against_brute_force(docs_of, items_of):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 60)))) for i in range(60)]
    docs = []
    for i in range(120):
        ws = rng.choices(vocabulary, k=rng.choice([0, 5, 40, 300, 5_000]))
        for _ in range(rng.randint(0, 2)):
            planted = rng.choice(items)[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                planted[rng.randrange(len(planted))] = "edited"
            at = rng.randint(0, len(ws))
            ws[at:at] = planted
        docs.append((i, " ".join(ws)))
    expected = brute.contained(docs, items)
    assert len(expected) > 50
    assert set(pairs(d.contaminated(docs_of(docs), items_of(items)))) == expected
    # Many blocks give the same pairs as one, and `clean` leaves exactly the rest.
    assert set(pairs(d.contaminated(docs_of(docs), items_of(items), block_bytes=500))) == expected
    left = d.clean(docs_of(docs), items_of(items), block_bytes=2_000)
    assert sorted(r.doc_id for r in left.collect()) == sorted({i for i, _ in docs} - {a for a, _ in expected})
    assert left.columns == docs_of(docs).columns


def test_items_with_equal_texts_and_without_id(docs_of, items_of):
    items = items_of([(1, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (None, "k l m n o")])
    docs = docs_of([(7, "a b c d e f"), (8, "k l m n o"), (None, "a b c d e f")])
    got = d.contaminated(docs, items).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in got) == [("7", 1), ("7", 2), ("None", 1), ("None", 2)]
    assert d.clean(docs, items).count() == 0


def test_empty_tables(docs_of, items_of):
    assert d.contaminated(docs_of([]), items_of(ITEMS)).count() == 0
    assert d.contaminated(docs_of([(1, "a")]), items_of([])).count() == 0
    assert d.clean(docs_of([(1, "a")]), items_of([])).count() == 1
