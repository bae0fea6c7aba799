"""Benchmark decontamination: containment search for short items inside documents of any length.

Documents are partitioned by the size of their shingle set, each power of two being one partition.
A partition has its own MinHash signature length, at least twice its largest set: the hash range is
cut into so many bins and the smallest hash of each bin is kept (one-permutation MinHash). An item
searches a partition with a signature of the same length, so its few shingles meet bins of a 20,000
word document that hold less than one shingle on average, and one equal bin makes a candidate. A
shared shingle is the minimum of its bin with probability 0.78 or more; ``MIN_HASHED`` shared ones
are all missed with a probability below 1e-9. Items with fewer shingles than that are looked up by
every shingle instead of by signature. Each candidate is then verified on its words: the share of
the item's distinct shingles that the document holds, exactly.
"""

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.words import only, shingle_hashes, texts, word_hashes

WIDTH = 5
# An item is found in a document that holds this percentage of its shingles.
THRESHOLD = 80
MIN_HASHED = 20
# Bytes of item texts that one pass over the documents searches for; more items make more passes.
BLOCK_BYTES = 32 << 20
PAIRS = "doc_id bigint, item_id bigint, shared_shingles bigint, item_shingles bigint, containment double"
_PAIRS = pa.schema([
    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("shared_shingles", pa.int64()),
    ("item_shingles", pa.int64()), ("containment", pa.float64()),
])


def shingles(words: list[bytes], width: int) -> set[tuple[bytes, ...]]:
    return set(zip(*[words[i:] for i in range(width)]))


def bins_of(size: int) -> int:
    """Signature length, as a power of two, of the partition that sets of this size belong to."""
    return int(size - 1).bit_length() + 1


def bin_minima(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Which of the sorted hashes are the smallest of their bin; the top bits name the bin."""
    bins = hashes >> np.uint64(64 - bits)
    first = np.ones(len(hashes), bool)
    first[1:] = bins[1:] != bins[:-1]
    return first


class Item(NamedTuple):
    ids: list[int]  # items with this same text
    width: int
    shingles: frozenset[tuple[bytes, ...]]


class Index:
    """The items of one block, by hash of their shingles."""

    def __init__(self, rows: list[tuple[bytes, list[int]]], width: int):
        self.items: list[Item] = []
        self._of_width: dict[int, list[int]] = {}
        hashes: dict[int, list[np.ndarray]] = {}
        for text, ids in rows:
            words = text.lower().split()
            if not words:
                continue
            w = min(width, len(words))
            self.items.append(Item(ids, w, frozenset(shingles(words, w))))
            hashes.setdefault(w, []).append(np.unique(shingle_hashes(word_hashes(words), w)))
            self._of_width.setdefault(w, []).append(len(self.items) - 1)
        self._posted = {w: self._postings(self._of_width[w], hashes[w]) for w in hashes}
        self._signed: dict[tuple[int, int], np.ndarray] = {}

    @staticmethod
    def _postings(items: list[int], hashes: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """Shingle hashes in order and, beside each, its item and whether that item is a small one."""
        every = np.concatenate(hashes)
        owner = np.repeat(items, [len(h) for h in hashes])
        small = np.repeat([len(h) < MIN_HASHED for h in hashes], [len(h) for h in hashes])
        order = np.argsort(every, kind="stable")
        return every[order], owner[order], small[order]

    def _signatures(self, width: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes and items of the signatures that search the partition of that signature length."""
        every, owner, small = self._posted[width]
        if (width, bits) not in self._signed:
            by_item = np.lexsort((every, owner))
            top = every[by_item] >> np.uint64(64 - bits)
            first = np.ones(len(top), bool)
            first[1:] = (top[1:] != top[:-1]) | (owner[by_item][1:] != owner[by_item][:-1])
            kept = np.empty(len(top), bool)
            kept[by_item] = first
            self._signed[width, bits] = kept
        return every, owner, self._signed[width, bits] & ~small

    @staticmethod
    def _met(hashes: np.ndarray, every: np.ndarray, owner: np.ndarray, asked: np.ndarray) -> np.ndarray:
        left = np.searchsorted(every, hashes, "left")
        hit = left < len(every)
        hit[hit] = every[left[hit]] == hashes[hit]
        if not hit.any():
            return owner[:0]
        left = left[hit]
        right = np.searchsorted(every, hashes[hit], "right")
        at = np.concatenate([np.arange(a, b) for a, b in zip(left, right)])
        return owner[at][asked[at]]

    def candidates(self, words: list[bytes]) -> list[int]:
        """Items whose signature meets the one of these words, each once."""
        hashed, found = word_hashes(words), []
        for width, (every, owner, small) in self._posted.items():
            if len(words) < width:
                continue
            own = np.unique(shingle_hashes(hashed, width))
            bits = bins_of(len(own))
            signature = own[bin_minima(own, bits)]
            found += self._met(signature, *self._signatures(width, bits)).tolist()
            if small.any():
                found += self._met(own, every, owner, small).tolist()
        return sorted(set(found))

    def contained(self, text: bytes, threshold: int) -> Iterator[tuple[Item, int]]:
        """Items that the text contains, each with its number of shared shingles."""
        words = text.lower().split()
        near = self.candidates(words) if words else []
        sets = {w: shingles(words, w) for w in {self.items[i].width for i in near}}
        for i in near:
            item = self.items[i]
            shared = len(item.shingles & sets[item.width])
            if 100 * shared >= threshold * len(item.shingles):
                yield item, shared


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[bytes, list[int]]]]:
    """Distinct item texts with the ids that bear them, in blocks of about ``block_bytes``."""
    items = only(benchmark, "item_id", "text").where("text IS NOT NULL")
    unique = items.groupBy("text").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    total = unique.agg(F.sum(F.octet_length("text") + 8 * F.size("ids"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    for block in range(blocks):
        rows = unique.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()
        yield [(r["text"].encode(), list(r["ids"])) for r in rows]


def _search(rows: list[tuple[bytes, list[int]]], width: int, threshold: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(rows, width)
        for batch in batches:
            pairs = [
                (doc_id.as_py(), item_id, shared, len(item.shingles), shared / len(item.shingles))
                for doc_id, text in zip(batch.column("doc_id"), texts(batch))
                for item, shared in index.contained(text, threshold)
                for item_id in item.ids
            ]
            columns = zip(*pairs) if pairs else [[] for _ in _PAIRS]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PAIRS.types)], schema=_PAIRS)

    return found


def _drop(rows: list[tuple[bytes, list[int]]], width: int, threshold: int):
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(rows, width)
        for batch in batches:
            clean = [next(index.contained(text, threshold), None) is None for text in texts(batch)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return kept


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    threshold: int = THRESHOLD,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """A row for every document and benchmark item of which it holds ``threshold`` percent of the
    shingles: ``doc_id, item_id, shared_shingles, item_shingles, containment``.

    Words are lower-cased (A-Z). An item of fewer than ``width`` words is one shingle of all of them.
    Items without a word (null or empty text) are never found; documents without one contain nothing.
    Items with equal texts are searched once and reported each, an item id listed twice with one text
    once; an item without an id is not reported. A repeated document row is reported once per row.

    The documents are read in place, without a shuffle. Item texts reach the tasks in blocks of about
    ``block_bytes`` (or one text): a larger benchmark takes more passes over the documents.
    """
    docs = only(docs, "doc_id", "text")
    parts = [docs.mapInArrow(_search(b, width, threshold), PAIRS) for b in _blocks(benchmark, block_bytes)]
    return reduce(DataFrame.unionByName, parts)


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    threshold: int = THRESHOLD,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` that contain no item, judged in place as in ``contaminated``; an item
    without an id counts here."""
    for rows in _blocks(benchmark, block_bytes):
        docs = docs.mapInArrow(_drop(rows, width, threshold), docs.schema)
    return docs
