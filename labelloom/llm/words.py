"""Words and their hashes, as all operators of this subpackage cut them.

A word is a run of characters other than space and U+0009 to U+000D. Over UTF-8 that is exactly what
``bytes.split()`` yields, and ``bytes.lower()`` lower-cases exactly A-Z.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

# Regular expression of a word, for Java, Python and DuckDB alike.
WORD = r"[^\x20\x09-\x0D]+"


def texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes]:
    """UTF-8 of every text; a null text counts as an empty one."""
    for value in batch.column(column).cast(pa.binary()):
        yield value.as_py() or b""


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit number over all others (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit hash per run of ``width`` words, in order, from the hashes of the words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total = mixed(total + hashes[i : i + n] + np.uint64(0x9E3779B97F4A7C15))
    return total


def shingle_set(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer words than ``width`` make one shingle of all of them."""
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(shingle_hashes(word_hashes(words), min(width, len(words))))


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone: further columns of a table may have any name, even ours."""
    return df.select(*[df[c] for c in columns])
