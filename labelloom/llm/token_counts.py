"""Token counts of a unigram tokenizer without its tokens.

An Aho-Corasick automaton over the vocabulary enumerates, for every place in a text, the pieces that
end there; the best score of a cut of the text up to each place and the number of its pieces are carried
along, and nothing else. Ties go as in the tokenizer: pieces that begin earlier are looked at first and
a later one must score strictly higher; where no piece is a single character, that character is unknown,
at ten below the lowest score, and stands for its UTF-8 bytes (or, without byte fallback, a run of them
for one piece).

No piece of the usual vocabularies goes on past the end of a word, so a text falls apart into words
whose best cuts are independent; a bounded memory of words saves most of the work.
"""

import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from labelloom.llm.words import only

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
# Words a task remembers, and the longest one it does.
REMEMBERED, LONGEST = 400_000, 64
COUNTED = "doc_id bigint, n_tokens bigint, score double"
_COUNTED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("score", pa.float64())])


class Vocabulary(NamedTuple):
    scores: dict[str, float]  # of the pieces that texts can match
    byte_fallback: bool = True


def load(path: str) -> Vocabulary:
    """The pieces and scores of a SentencePiece model file, read as a unigram vocabulary."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    special = (model.is_control, model.is_unknown, model.is_unused, model.is_byte)
    ids = range(model.get_piece_size())
    matched = {model.id_to_piece(i): model.get_score(i) for i in ids if not any(is_special(i) for is_special in special)}
    return Vocabulary(matched, any(model.is_byte(i) for i in ids))


class Counter:
    def __init__(self, vocabulary: Vocabulary):
        scores, self._bytes = vocabulary
        self._single = {p for p in scores if len(p) == 1}
        self._unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        self._automaton = ahocorasick.Automaton()
        for piece, score in scores.items():
            self._automaton.add_word(piece, (len(piece), score))
        if scores:
            self._automaton.make_automaton()
        self._cut = self._cutter(scores)
        self._known: dict[str, tuple[float, int]] = {}

    def _cutter(self, scores: dict[str, float]) -> re.Pattern:
        """Where every vocabulary cuts: before a word, and around line breaks that no piece holds."""
        by_word = all(SPACE not in p.lstrip(SPACE) for p in scores) and (self._bytes or SPACE in self._single)
        if not by_word:
            return re.compile(r"(?s).+")
        if self._bytes and not any("\n" in p for p in scores):
            return re.compile(rf"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
        return re.compile(rf"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

    def best(self, text: str) -> tuple[float, int]:
        """Score and number of pieces of the best cut of a text taken as it is."""
        ending: list[list[tuple[int, float]]] = [[] for _ in text]
        if self._single or len(self._automaton):
            for end, match in self._automaton.iter(text):
                ending[end].append(match)  # the longest, so the earliest to begin, comes first
        scores, counts, in_unknown = [0.0], [0], [False]
        for end, (char, matches) in enumerate(zip(text, ending)):
            best, count, unknown = None, 0, False
            for length, score in matches:
                candidate = scores[end + 1 - length] + score
                if best is None or candidate > best:
                    best, count = candidate, counts[end + 1 - length] + 1
            if char not in self._single:
                candidate = scores[end] + self._unknown
                if best is None or candidate > best:
                    best, unknown = candidate, True
                    more = len(char.encode("utf-8", "replace")) if self._bytes else int(not in_unknown[end])
                    count = counts[end] + more
            scores.append(best)
            counts.append(count)
            in_unknown.append(unknown)
        return scores[-1], counts[-1]

    def count(self, text: str) -> tuple[float, int]:
        """Score and number of pieces of a text, which the tokenizer begins with a space."""
        if not text:
            return 0.0, 0
        total, n = 0.0, 0
        for word in self._cut.findall(SPACE + text.replace(" ", SPACE)):
            known = self._known.get(word)
            if known is None:
                known = self.best(word)
                if len(word) <= LONGEST:
                    if len(self._known) >= REMEMBERED:
                        self._known.clear()
                    self._known[word] = known
            total += known[0]
            n += known[1]
        return total, n


def token_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id, n_tokens, score`` of every row: the pieces of the best cut and its score.

    A null or empty text has no tokens and a score of 0. Repeated rows and null ids come out as they went
    in. The vocabulary goes with the tasks; no machine needs its file.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in batches:
            rows = [counter.count(text.as_py() or "") for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([n for _, n in rows], pa.int64()), pa.array([s for s, _ in rows], pa.float64())],
                schema=_COUNTED,
            )

    return only(docs, "doc_id", "text").mapInArrow(counted, COUNTED)
