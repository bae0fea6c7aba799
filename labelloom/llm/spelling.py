"""Spelling variants: words one insertion, deletion or replacement apart, found in a trie of letter counts.

The alphabet is dealt into ``GROUPS`` letter groups. A word's frequency vector counts its letters by
group. Two words that differ by one edit differ in their vectors by a surplus of at most one letter in one
group and a deficit of at most one in another: a replaced letter makes both (none if the letters share
a group), a deleted one a deficit. Words are arranged in a trie, first by length, then by the counts of
one group after the other. From each word a depth-first search follows its own counts and may leave them
for one surplus and one deficit; the words of the leaves it reaches are verified letter by letter.

At scale the trie is cut in two. Its top, length and the counts of the first groups, names a cell. A
word lies in its own cell and asks in the few cells within the budget, with what is left of it; Spark brings
words and questions of a cell together. The top is as deep as it takes to make every cell small
(``CELL``), so cells stay small as the number of words grows, until all groups are used up. The rest of
the trie and the search in it are a few array operations for many questions at a time.

Each pair is asked for from one side only: the longer word, or, at equal length, the side whose first
difference is a surplus, or the smaller word where the top does not differ.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.words import only
from labelloom.operators.ranges import parts_of
from labelloom.shared import cut

# A run of letters, the least code points and occurrences of a word, the divisor that marks a slip.
RUN = "[A-Za-zÀ-ÿ]+"
MIN_LENGTH = 5
MIN_COUNT = 3
SLIP = 97
# Letter groups of the frequency vectors, and words of a cell beyond which the top gets another level.
GROUPS = 8
CELL = 6_000
_HELD = 200_000  # distinct words that a task counts before it hands them on
_PRODUCT = 1 << 15  # questions times words that are compared at once
_BATCH = 8_192
# What a row asks for in a cell: nothing (it is one of its words), words of its own length or one shorter, with
# what is left of the surplus and the deficit. Of questions of kind 1 only the smaller word counts.
_WORD, _KINDS = 0, {1: (0, 1, 1), 2: (0, 0, 1), 3: (0, 0, 0), 4: (1, 0, 1), 5: (1, 0, 0)}
_PAIRS = "a binary, n_a bigint, b binary, n_b bigint"
_COUNTED = pa.schema([("word", pa.binary()), ("n", pa.int64())])


def _counted(slip: int, min_length: int):
    runs = re.compile(RUN)

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], schema=_COUNTED)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py()
                if not text:
                    continue
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                # Over UTF-8, lower() changes A-Z alone.
                for run, n in Counter(runs.findall(text.encode().lower().decode())).items():
                    if len(run) < min_length:
                        continue
                    h = zlib.crc32(run.encode(), start)
                    if slip and h % slip == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < min_length:
                            continue
                    counts[run.encode("latin-1")] += n
                if len(counts) > _HELD:
                    yield batch_of(counts)
                    counts = Counter()
        if counts:
            yield batch_of(counts)

    return count


def word_counts(docs: DataFrame, slip: int = SLIP, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word`` (a byte per code point, ISO 8859-1) and ``n`` of all words of ``docs`` that are long and frequent
    enough. Each task counts before the shuffle. ``slip`` 0 leaves all runs as they are."""
    counted = only(docs, "doc_id", "text").mapInArrow(_counted(slip, min_length), "word binary, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def letter_groups(words: DataFrame, groups: int) -> np.ndarray:
    """Group of each of the 256 code points: letters are dealt, the most frequent first, to the group that has
    least so far, so that all groups tell words apart about equally well."""
    letters = F.explode(F.split(F.decode("word", "ISO-8859-1"), ""))
    held = words.select(letters.alias("letter")).where("letter <> ''").groupBy("letter").count().collect()  # 90 at most
    load, group = [0] * groups, np.zeros(256, np.int64)
    for row in sorted(held, key=lambda r: (-r["count"], r["letter"])):
        least = load.index(min(load))
        group[ord(row["letter"])] = least
        load[least] += row["count"]
    return group


def _count_of(group: np.ndarray, g: int) -> str:
    """SQL: how many letters of a group a word has."""
    letters = "".join(chr(c) for c in range(256) if group[c] == g and re.match(RUN, chr(c)))
    return f"regexp_count(letters, '[{letters}]')" if letters else "0"


def _cells(words: DataFrame, group: np.ndarray, groups: int, cell: int) -> tuple[DataFrame, int]:
    """``word, n, size, v`` with the counts ``v`` of the top's groups, and how many these are."""
    spelt = words.withColumn("letters", F.decode("word", "ISO-8859-1"))
    vectors = cut(spelt.select(
        "word", "n", F.length("letters").alias("size"), F.expr(f"array({', '.join(_count_of(group, g) for g in range(groups))})").alias("v")
    ))
    depth = 0
    while depth < groups:
        key = ["size", *[f"v[{g}]" for g in range(depth)]]
        largest = vectors.selectExpr(*[f"{k} AS k{i}" for i, k in enumerate(key)]).groupBy(
            *[f"k{i}" for i in range(len(key))]
        ).count().agg(F.max("count")).first()[0]
        if (largest or 0) <= cell:
            break
        depth += 1
    return vectors, depth


def _changes(depth: int) -> list[tuple[int, int, dict[int, int]]]:
    """Kind of row, change of length and of the top's counts, for every cell a word appears in."""
    same = [(1, 0, {})] + [(2, 0, {g: 1}) for g in range(depth)]
    both = [(3, 0, {g: 1, h: -1}) for g in range(depth) for h in range(g + 1, depth)]
    shorter = [(4, -1, {})] + [(5, -1, {g: -1}) for g in range(depth)]
    return [(_WORD, 0, {}), *same, *both, *shorter]


def _asked(vectors: DataFrame, depth: int) -> DataFrame:
    """``cell, kind, word, n``: every word in its cell and as a question in others."""
    rows = []
    for kind, longer, change in _changes(depth):
        counts = [f"v[{g}] + {change.get(g, 0)}" for g in range(depth)]
        possible = " AND ".join(["true", *[f"v[{g}] > 0" for g, by in change.items() if by < 0]])
        rows.append(f"if({possible}, named_struct('kind', {kind}, 'cell', xxhash64(size + {longer}, {depth}, {', '.join(counts) or '0'})), NULL)")
    spread = vectors.select("word", "n", F.explode(F.expr(f"array({', '.join(rows)})")).alias("row"))
    return spread.where("row IS NOT NULL").select("row.cell", "row.kind", "word", "n")


class _Trie:
    """The words of a cell, all of one length, ordered by their counts in the groups below the top."""

    def __init__(self, words: np.ndarray, n: np.ndarray, group: np.ndarray, levels: range):
        self._group, self._levels = group, levels
        counts = self._counts(words)
        order = np.lexsort(counts.T[::-1]) if len(levels) else np.arange(len(words))
        self.words, self.n, self._counted = words[order], n[order], counts[order]

    def _counts(self, words: np.ndarray) -> np.ndarray:
        groups = self._group[words]
        return np.stack([(groups == g).sum(axis=1) for g in self._levels], axis=1).astype(np.int16) if len(self._levels) else np.empty((len(words), 0), np.int16)

    def near(self, asked: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the questions and of the words that answer them."""
        shorter, surplus, deficit = _KINDS[kind]
        self._own, self._found = self._counts(asked), []
        self._search(0, len(self.words), 0, np.arange(len(asked)), surplus, deficit)
        if not any(len(q) for q, _ in self._found):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        q, w = (np.concatenate(side) for side in zip(*self._found))
        verify = _one_deleted if shorter else _one_replaced
        good = [verify(asked[q[at : at + _PRODUCT]], self.words[w[at : at + _PRODUCT]]) for at in range(0, len(q), _PRODUCT)]
        good = np.concatenate(good)
        q, w = q[good], w[good]
        if kind == 1:  # both sides ask
            a, b = asked[q], self.words[w]
            first = (a != b).argmax(axis=1)
            rows = np.arange(len(q))
            smaller = a[rows, first] < b[rows, first]
            q, w = q[smaller], w[smaller]
        return q, w

    def _search(self, low: int, high: int, level: int, asking: np.ndarray, surplus: int, deficit: int) -> None:
        """Depth first from the node of the words ``low`` to ``high``; the budgets are what is left."""
        if not len(asking):
            return
        if level == self._counted.shape[1] or (high - low) * len(asking) <= _PRODUCT:
            step = max(1, _PRODUCT // max(1, high - low))
            for at in range(0, len(asking), step):
                some = asking[at : at + step]
                more = self._counted[None, low:high, level:] - self._own[some][:, None, level:]
                fits = (np.maximum(more, 0).sum(axis=2) <= surplus) & (np.maximum(-more, 0).sum(axis=2) <= deficit)
                q, w = np.nonzero(fits)
                self._found.append((some[q], w + low))
            return
        column = self._counted[low:high, level]
        values, starts = np.unique(column, return_index=True)
        more = self._own[asking, level]
        for value, start, end in zip(values, starts, [*starts[1:], high - low]):
            part = low + int(start), low + int(end), level + 1
            self._search(*part, asking[more == value], surplus, deficit)
            if surplus:
                self._search(*part, asking[more == value - 1], 0, deficit)
            if deficit:
                self._search(*part, asking[more == value + 1], surplus, 0)


def _one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def _one_deleted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether ``a`` without one letter is ``b``: a common beginning and a common end cover all of ``b``."""
    beginning = np.logical_and.accumulate(a[:, :-1] == b, axis=1).sum(axis=1)
    end = np.logical_and.accumulate((a[:, 1:] == b)[:, ::-1], axis=1).sum(axis=1)
    return beginning + end >= b.shape[1]


def _letters(words: pa.Array) -> np.ndarray:
    """A row of code points for each word; all are of one length."""
    words = words.cast(pa.large_binary())
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    return np.frombuffer(words.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(len(words), -1)


def _spelt(letters: np.ndarray) -> pa.Array:
    rows, width = letters.shape
    flat = np.ascontiguousarray(letters)
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer((np.arange(rows + 1) * width).astype(np.int32)), pa.py_buffer(flat)])


def _matched(group: np.ndarray, depth: int, groups: int):
    levels = range(depth, groups)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, parts, trie = None, [], None
        for batch in batches:
            cells, kinds = batch.column("cell").to_numpy(), batch.column("kind").to_numpy()
            words, n = batch.column("word"), batch.column("n").to_numpy()
            changes = np.flatnonzero((cells[1:] != cells[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for start, end in zip([0, *changes], [*changes, len(cells)]):
                if start == end:
                    continue
                if kinds[start] == _WORD:
                    if cells[start] != here:
                        here, parts = cells[start], []
                    parts.append((_letters(words.slice(start, end - start)), n[start:end]))
                    trie = None
                    continue
                if cells[start] != here:
                    continue  # no word lies in this cell
                if trie is None:
                    trie = _Trie(*(np.concatenate(side) for side in zip(*parts)), group, levels)
                for at in range(start, end, _BATCH):
                    size = min(_BATCH, end - at)
                    asked = _letters(words.slice(at, size))
                    q, w = trie.near(asked, int(kinds[start]))
                    if len(q):
                        yield pa.RecordBatch.from_arrays(
                            [_spelt(asked[q]), pa.array(n[at : at + size][q]), _spelt(trie.words[w]), pa.array(trie.n[w])],
                            names=["a", "n_a", "b", "n_b"],
                        )

    return match


def near_pairs(words: DataFrame, groups: int = GROUPS, cell: int = CELL) -> DataFrame:
    """``a, n_a, b, n_b`` for every two of the ``words`` (``word, n``, each word once) that are one edit apart, each
    pair once."""
    group = letter_groups(words, groups)
    vectors, depth = _cells(words, group, groups, cell)
    asked = _asked(vectors, depth).repartition(parts_of(words), "cell").sortWithinPartitions("cell", "kind")
    return asked.mapInArrow(_matched(group, depth, groups), _PAIRS)


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: where the forms lead in the end. Counts double at least from a word to its form,
    so there is no circle, and each round doubles the steps taken."""
    now = cut(forms.selectExpr("word", "form AS root"))
    while True:
        further = now.selectExpr("word AS root", "root AS beyond")
        ahead = cut(now.join(further, "root", "left").selectExpr("word", "coalesce(beyond, root) AS root", "beyond IS NOT NULL AS moved"))
        now = ahead.select("word", "root")
        if ahead.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, slip: int = SLIP, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of ``docs`` with enough letters and occurrences.

    Words are the maximal runs of ``RUN`` in the whole texts, A-Z in lower case. ``n_near`` counts the words one
    edit away, ``form`` is the most frequent of them (the first in code-point order among equals) if it is at least
    twice as frequent as the word, else null; ``root`` is where forms lead in the end, the word itself without one.

    Every row of ``docs`` counts, repeated ones too. With ``slip``, a run of a document loses a letter where the CRC-32 of
    ``doc_id:run`` is divisible by it, which plants misspelt words; a null id counts as an empty text there. Null and
    empty texts have no words, very long ones are read whole. Further columns play no part.
    """
    words = cut(word_counts(docs, slip, min_length, min_count))
    pairs = cut(near_pairs(words))
    sides = pairs.unionByName(pairs.selectExpr("b AS a", "n_b AS n_a", "a AS b", "n_a AS n_b"))
    # The word of largest count first, the smallest among equals.
    found = cut(sides.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form"))).alias("best"),
        F.first("n_a").alias("n"),
    ).selectExpr(
        "word", "n_near", "if(-best.less >= 2 * n, best.form, NULL) AS form", "if(-best.less >= 2 * n, -best.less, NULL) AS form_n"
    ))
    roots = _roots(found.where("form IS NOT NULL").select("word", "form"))
    spelt = words.join(found, "word", "left").join(roots, "word", "left")

    def text(column: str) -> str:
        return f"decode({column}, 'ISO-8859-1')"

    return spelt.selectExpr(
        f"{text('word')} AS word", "n", "coalesce(n_near, 0L) AS n_near", f"{text('form')} AS form", "form_n",
        f"{text('coalesce(root, word)')} AS root",
    )
