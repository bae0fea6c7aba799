import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer
from tokenizers.models import Unigram

from labelloom.llm import token_counts as t
from labelloom.llm.queries import TOKENIZER

SMALL = t.Vocabulary({"▁": -2.0, "a": -1.0, "b": -1.0, "ab": -2.0, "▁a": -3.0, "aba": -2.5, "ba": -2.0, "▁▁": -3.0}, True)


@pytest.fixture(scope="module")
def vocabulary():
    return t.load(TOKENIZER)


def plain(vocabulary, text):
    """The tokenizer's forward pass, from every beginning to every end, over the whole text."""
    text = t.SPACE + text.replace(" ", t.SPACE)
    lowest = min(vocabulary.scores.values()) - 10
    best = [(0.0, 0)] + [None] * len(text)
    for start in range(len(text)):
        for end in range(start + 1, len(text) + 1):
            if text[start:end] in vocabulary.scores:
                score = best[start][0] + vocabulary.scores[text[start:end]]
                if best[end] is None or score > best[end][0]:
                    best[end] = (score, best[start][1] + 1)
        if text[start] not in vocabulary.scores:
            score = best[start][0] + lowest
            if best[start + 1] is None or score > best[start + 1][0]:
                best[start + 1] = (score, best[start][1] + len(text[start].encode()))
    return best[-1]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab ▁cé\n", max_size=24))
def test_against_the_plain_pass(text):
    expected = plain(SMALL, text) if text else (0.0, 0)
    score, count = t.Counter(SMALL).count(text)
    assert count == expected[1] and score == pytest.approx(expected[0])


def test_against_the_tokenizer_on_whole_texts(vocabulary, documents):
    byte_pieces = [(f"<0x{b:02X}>", -1e12) for b in range(256)]
    model = Tokenizer(Unigram([("<unk>", 0.0), *byte_pieces, *vocabulary.scores.items()], unk_id=0, byte_fallback=True))
    rows = documents.select("text").collect()
    counter = t.Counter(vocabulary)
    for (text,) in rows:
        written = t.SPACE + text.replace(" ", t.SPACE)
        assert counter.count(text)[1] == (len(model.encode(written, add_special_tokens=False).ids) if text else 0)


def test_without_byte_fallback_a_run_of_unknowns_is_one_piece():
    counter = t.Counter(SMALL._replace(byte_fallback=False))
    assert counter.count("cccc")[1] == 2 and counter.count("c a")[1] == 3


def test_edges(docs_of, vocabulary, monkeypatch):
    texts = [None, "", " ", "a", "  two  spaces\n\n", "x" * 20_000, "日本語 😀"]
    rows = list(enumerate(texts)) + [(3, "a"), (None, "a")]
    got = t.token_counts(docs_of(rows), vocabulary).collect()
    counts = {r.doc_id: (r.n_tokens, r.score) for r in got}
    assert len(got) == len(rows) and counts[0] == counts[1] == (0, 0.0) and counts[None] == counts[3]
    assert t.token_counts(docs_of([]), vocabulary).count() == 0
    monkeypatch.setattr(t, "REMEMBERED", 2)
    small, full = t.Counter(SMALL), t.Counter(SMALL)
    assert [small.count("a b ab aba a b")] * 3 == [full.count("a b ab aba a b") for _ in range(3)]
