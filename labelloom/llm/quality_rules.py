"""Quality rules as a ledger: measure once, note every failed rule as a bit, decide later.

``ledger`` reads each text once and stores measurements and the bit mask of failed rules. Policies
are versioned sets of rules; applying one is a bitwise test on the ledger, and ``ablations`` tells
from the counts of bit masks alone what each rule of a policy removes.
"""

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.words import only, texts

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_lower")
_MEASURED = pa.schema([("doc_id", pa.int64()), *[(m, pa.int64()) for m in MEASURES]])
_SPACES = b" \t\n\x0b\x0c\r"
_CONTINUATION = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
WINDOW = 5


class Rule(NamedTuple):
    name: str
    fails: str  # SQL over the measurements


# The place of a rule is its bit: rules are only ever added at the end.
RULES = (
    Rule("too_short", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("capitals", "100 * n_upper > 30 * (n_upper + n_lower)"),
    Rule("repeated_lines", "100 * n_dup_lines > 60 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
)
BITS = {rule.name: 1 << i for i, rule in enumerate(RULES)}


class Policy(NamedTuple):
    rules: tuple[str, ...]
    allowed: int = 0  # how many of its rules a kept document may fail

    @property
    def mask(self) -> int:
        return sum(BITS[r] for r in self.rules)


# Versions stay as they are once documents were decided by them.
POLICIES = {
    "base": Policy(("too_short", "repeated_windows")),
    "v1": Policy(("too_short", "repeated_windows", "symbols", "capitals")),
    "v2": Policy(("too_short", "repeated_windows", "symbols", "capitals", "repeated_lines", "word_length")),
}


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside runs of ``window`` words that occur twice or more, the first occurrence too."""
    runs = list(zip(*[words[i:] for i in range(window)]))
    counts = Counter(runs)
    if len(counts) == len(runs):
        return 0
    covered, end = 0, 0
    for start, run in enumerate(runs):
        if counts[run] > 1:
            covered += start + window - max(start, end)
            end = start + window
    return covered


def measures(text: bytes) -> tuple[int, ...]:
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    upper = len(text) - len(text.translate(None, _UPPER))
    return (
        len(words),
        len(text.translate(None, _SPACES + _CONTINUATION)),
        len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
        upper,
        len(text) - len(text.translate(None, _UPPER.lower())),
    )


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = zip(*map(measures, texts(batch)), strict=True) if batch.num_rows else [[] for _ in MEASURES]
        arrays = [pa.array(c, pa.int64()) for c in columns]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], schema=_MEASURED)


def ledger(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measurements and ``failed``, the bits of the rules a document fails.

    One row per row of ``docs``, repeated rows and null ids included. A null text counts as an empty
    one: it has no words and fails ``too_short``. Other columns of ``docs`` are not looked at.
    """
    schema = ", ".join(f"{m} bigint" for m in MEASURES)
    measured = only(docs, "doc_id", "text").mapInArrow(_measured, f"doc_id bigint, {schema}")
    bits = " + ".join(f"CASE WHEN {rule.fails} THEN {BITS[rule.name]} ELSE 0 END" for rule in RULES)
    return measured.selectExpr("*", f"CAST({bits} AS int) AS failed")


def passes(policy: str) -> str:
    """SQL over ``failed``: whether a document passes the policy of that version."""
    mask, allowed = POLICIES[policy].mask, POLICIES[policy].allowed
    return f"bit_count(failed & {mask}) <= {allowed}"


def ablations(rows: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: ``failing`` documents, those failing ``only`` this rule, and how many
    are ``kept_without`` it. All of it follows from the counts of the bit masks, at most one row per
    combination of rules, so the texts are not read again."""
    p = POLICIES[policy]
    masks = rows.groupBy(F.expr(f"failed & {p.mask}").alias("bits")).agg(F.count("*").alias("n"))
    rules = ", ".join(f"named_struct('rule', '{r}', 'bit', {BITS[r]})" for r in p.rules)
    spread = masks.selectExpr("bits", "n", f"inline(array({rules}))")
    return spread.groupBy("rule").agg(
        F.expr("coalesce(sum(n) FILTER (WHERE bits & bit != 0), 0)").alias("failing"),
        F.expr("coalesce(sum(n) FILTER (WHERE bits = bit), 0)").alias("only"),
        F.expr(f"coalesce(sum(n) FILTER (WHERE bit_count(bits & ~bit) <= {p.allowed}), 0)").alias("kept_without"),
    )
