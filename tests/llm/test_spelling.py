import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from labelloom.llm import spelling

A, Z = ord("A"), ord("Z")


def runs(text):
    low = "".join(chr(ord(c) + 32) if A <= ord(c) <= Z else c for c in text or "")
    return re.findall("[A-Za-zÀ-ÿ]+", low)


def counted(docs, slip=97, min_length=5, min_count=3):
    counts = Counter()
    for doc_id, text in docs:
        for run in runs(text):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def expected(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda v: (-counts[v], v))
            if counts[best] >= 2 * counts[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (n, len(near[w]), form.get(w), counts.get(form.get(w)), root(w)) for w, n in counts.items()}


def result(rows):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows.collect()}


def varied(rng, n):
    """Words of few letters, so that many are near, with counts that double along chains of edits."""
    words = ["".join(rng.choice("aé÷") for _ in range(rng.randrange(4, 8))) for _ in range(n)]
    return [w for w in words for _ in range(rng.choice([1, 2, 3, 6, 13, 30]))]


@pytest.mark.parametrize("seed, cell, slip", [(1, 6_000, 97), (2, 10, 3), (3, 1, 97)])
def test_against_all_pairs(spark, docs_of, monkeypatch, seed, cell, slip):
    monkeypatch.setattr(spelling.near_pairs, "__defaults__", (spelling.GROUPS, cell))
    rng = random.Random(seed)
    words = varied(rng, 260)
    rng.shuffle(words)
    docs = [(i * 7 - 99, " ".join(words[i * 20 : i * 20 + 20])) for i in range(len(words) // 20)]
    want = expected(counted(docs, slip))
    got = result(spelling.variants(docs_of(docs), slip=slip))
    assert got == want and sum(v[2] is not None for v in want.values()) > 20
    assert any(v[4] != v[2] and v[2] for v in want.values())


def test_edges(docs_of):
    chain = ["aaaaa"] * 3 + ["aaaab"] * 6 + ["aaabb"] * 12 + ["aaaac"] * 12 + ["x" * 40_000] * 3 + ["x" * 39_999 + "y"] * 9
    text = "1".join(chain) + " AAAAA0AAAAA,ÀÀÀÀÀ·ààààà ΑΒΓΔΕ ab"
    docs = [(None, None), (1, ""), (2, "\n"), (2**60 + 1, text), (2**60 + 1, text), (None, "ŻŻŻŻŻ wörld Wörld WÖrld")]
    got = result(spelling.variants(docs_of(docs)))
    assert got == expected(counted(docs))
    # Of two neighbours with equal counts the smaller word is the form; a-grave in two cases is two letters, as only A-Z
    # are lower-cased.
    assert got["aaaab"][2:] == ("aaaac", 24, "aaaac") and got["x" * 40_000][2] == "x" * 39_999 + "y"
    assert spelling.variants(docs_of([])).count() == 0 and spelling.variants(docs_of([(1, "too few words")])).count() == 0


def test_slips_hit_the_code_point_of_the_hash(docs_of):
    """A document's run loses its letter wherever the run stands in it."""
    word = next(w for w in (f"señal{c}{d}" for c in "abcdefghij" for d in "klmnopqrst") if zlib.crc32(f"4:{w}".encode()) % 97 == 0)
    docs = [(4, f"{word} {word} x {word.upper().replace('Ñ', 'ñ')}"), (5, f"{word} " * 7)]
    got = result(spelling.variants(docs_of(docs)))
    assert got == expected(counted(docs)) and len(got) == 2


def test_every_cell_is_asked(spark):
    """All depths of the top find the same pairs, each once."""
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("abcd") for _ in range(rng.randrange(5, 8))) for _ in range(500)})
    frame = spark.createDataFrame([(w.encode("latin-1"), i + 1) for i, w in enumerate(words)], "word binary, n bigint")
    want = sorted((a, b) for i, a in enumerate(words) for b in words[i + 1 :] if one_edit(a, b))
    for groups, cell in [(1, 10_000), (4, 1), (8, 40), (8, 1)]:
        rows = spelling.near_pairs(frame, groups, cell).collect()
        assert sorted(tuple(sorted((r.a.decode("latin-1"), r.b.decode("latin-1")))) for r in rows) == want
        assert all(words[r.n_a - 1] == r.a.decode("latin-1") and words[r.n_b - 1] == r.b.decode("latin-1") for r in rows)


def test_deletions():
    def rows(*words):
        return np.array([list(w.encode()) for w in words], np.uint8)

    assert spelling._one_deleted(rows("abcd", "abcd", "aabc", "abcd"), rows("abc", "acd", "abc", "bda")).tolist() == [True, True, True, False]
