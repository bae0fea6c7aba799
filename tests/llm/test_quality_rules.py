import brute
from hypothesis import given, settings
from hypothesis import strategies as st

from labelloom.llm import quality_rules as q

TEXTS = [
    None, "", " \n\t", "a b c d e", "a b c d e f g h i j k", "x " * 30, "one two three four five six " * 2,
    "He said no.\nHe said no.\n\nok", "### a b c d e f g h i j | k", "LOUD WORDS ONLY HERE AND NOW TO SEE THEM FAIL", "é ü \x1c " * 8, "w" * 200_000,
]


def test_every_measure_and_verdict(docs_of):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, "a b")]
    got = q.ledger(docs_of(rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in got) == sorted((i is None, i) for i, _ in rows)
    for r in got:
        text = "a b" if r.doc_id is None else TEXTS[r.doc_id] or ""
        ws = brute.words(text)
        lines = [x for x in text.encode().split(b"\n") if x.split()]
        assert r.n_words == len(ws)
        assert r.word_chars == sum(len(w.decode()) for w in ws)
        assert r.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
        assert (r.n_lines, r.n_dup_lines) == (len(lines), len(lines) - len(set(lines)))
        assert r.n_repeat_words == brute.repeated_words(ws)
        assert bool(r.failed & q.BITS["too_short"]) == (len(ws) < 10)
        assert bool(r.failed & q.BITS["repeated_windows"]) == (100 * r.n_repeat_words > 20 * len(ws))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=40))
def test_repeated_words(ws):
    assert q.repeated_words(ws) == brute.repeated_words(ws)


def test_policies_and_ablations_follow_from_the_bits(documents):
    rows = q.ledger(documents).cache()
    bits = [r.failed for r in rows.select("failed").collect()]
    for name, policy in q.POLICIES.items():
        kept = rows.where(q.passes(name)).count()
        assert kept == sum((b & policy.mask).bit_count() <= policy.allowed for b in bits)
        for r in q.ablations(rows, name).collect():
            bit = q.BITS[r.rule]
            assert r.failing == sum(b & bit != 0 for b in bits)
            assert r.only == sum(b & policy.mask == bit for b in bits)
            assert r.kept_without == sum((b & policy.mask & ~bit).bit_count() <= policy.allowed for b in bits)


def test_empty_table(docs_of):
    assert q.ledger(docs_of([])).count() == 0
    assert q.ablations(q.ledger(docs_of([])), "v1").count() == 0
