"""Packing documents into training sequences of several permitted lengths.

Documents longer than the longest sequence are cut; every full piece fills a sequence of its own. The
rest is packed by variable-capacity best fit: pieces in falling order of length each go to the open
bin that they leave the least room in; where none has room, a bin of the size of least cost per word is
opened, going by the words that are still to come. All permitted lengths are optimised together: each is
also tried as the least size of new bins, every bin is finally downsized to the smallest length that
holds its contents, and the cheapest outcome stands.

Pieces are dealt by a hash into shards of about ``SHARD`` pieces, each packed by itself. Pieces that are equal in
all they show are numbered and dealt by their number too, so however many rows are alike, a shard stays
a shard. The price is at most a few half-empty bins per shard; no task ever holds more, and the outcome
does not depend on the machines.
"""

from bisect import bisect_left
from collections.abc import Callable, Iterable
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.words import WORD
from labelloom.shared import cut

LENGTHS = (512, 1024, 2048, 4096)
SHARD = 5_000
_COPIES = 1_000  # equal pieces that one task spells out at a time
PACKED = (
    "doc_id bigint, piece bigint, start bigint, length bigint, bin_id string, capacity bigint, offset bigint"
)
_PIECE = ["doc_id", "piece", "start", "length"]


def cost(capacity: int) -> float:
    """Work of a training step on a sequence: linear layers, attention over pairs, and a fixed part."""
    return 64 + capacity * (1 + capacity / 16_384)


class Bin(NamedTuple):
    items: list[int]  # places in the list of pieces
    used: int


class _Room:
    """Open bins by the room they have left, for the tightest fit at least as large as a piece."""

    def __init__(self):
        self._rooms: list[int] = []
        self._bins: dict[int, list[int]] = {}

    def take(self, length: int) -> tuple[int, int] | None:
        at = bisect_left(self._rooms, length)
        if at == len(self._rooms):
            return None
        room = self._rooms[at]
        bins = self._bins[room]
        chosen = bins.pop()
        if not bins:
            del self._bins[room]
            self._rooms.pop(at)
        return chosen, room

    def put(self, chosen: int, room: int) -> None:
        if not room:
            return
        if room not in self._bins:
            self._bins[room] = []
            self._rooms.insert(bisect_left(self._rooms, room), room)
        self._bins[room].append(chosen)


def best_fit(lengths: list[int], opened: Callable[[int, int], int]) -> list[Bin]:
    """Bins of the pieces, given in falling order; ``opened`` says how large a new bin for a piece is, from
    its length and the total of all pieces that have no bin yet."""
    bins: list[Bin] = []
    left_over = sum(lengths)
    room = _Room()
    for i, length in enumerate(lengths):
        found = room.take(length)
        if found is None:
            size = opened(length, left_over)
            bins.append(Bin([i], length))
            room.put(len(bins) - 1, size - length)
        else:
            chosen, left = found
            bins[chosen].items.append(i)
            bins[chosen] = Bin(bins[chosen].items, bins[chosen].used + length)
            room.put(chosen, left - length)
        left_over -= length
    return bins


def downsized(used: int, permitted: tuple[int, ...]) -> int:
    return permitted[bisect_left(permitted, used)]


def pack(lengths: list[int], permitted: tuple[int, ...] = LENGTHS) -> list[tuple[int, Bin]]:
    """The cheapest of the packings, as (capacity, bin). Every length is at least 1 and fits the longest."""
    permitted = tuple(sorted(permitted))

    def least_cost(length: int, left_over: int) -> int:
        return min((c for c in permitted if c >= length), key=lambda c: (cost(c) / min(c, left_over), -c))

    def at_least(size: int) -> Callable[[int, int], int]:
        return lambda length, _: max(size, downsized(length, permitted))

    outcomes = []
    for opened in (least_cost, *map(at_least, permitted)):
        packed = [(downsized(b.used, permitted), b) for b in best_fit(lengths, opened)]
        outcomes.append((sum(cost(capacity) for capacity, _ in packed), packed))
    return min(outcomes, key=lambda o: o[0])[1]


def _shard_packer(permitted: tuple[int, ...]):
    # Arrow keeps ids whole that a float could not hold, whether or not a null is among them.
    def packed(rows: pa.Table) -> pa.Table:
        keys = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("copy", "ascending")]
        rows = rows.take(pc.sort_indices(rows, sort_keys=keys))
        shard = rows["shard"][0].as_py()
        bin_ids, capacities, offsets = [None] * len(rows), [0] * len(rows), [0] * len(rows)
        lengths = rows["length"].to_pylist()
        for number, (capacity, b) in enumerate(pack(lengths, permitted)):
            at = 0
            for i in b.items:
                bin_ids[i], capacities[i], offsets[i] = f"{shard}-{number}", capacity, at
                at += lengths[i]
        of_bins = [pa.array(bin_ids, pa.string()), pa.array(capacities, pa.int64()), pa.array(offsets, pa.int64())]
        return pa.table([*rows.select(_PIECE).columns, *of_bins], names=[*_PIECE, "bin_id", "capacity", "offset"])

    return packed


def _numbered(cuts: DataFrame) -> DataFrame:
    """The pieces with ``copy``, which numbers equal ones. Equal rows are counted before anything moves and spelt out
    again ``_COPIES`` at a time, so no task ever holds all rows of a key."""
    counted = cuts.groupBy(*_PIECE).agg(F.count("*").alias("n"))
    parted = counted.withColumn("part", F.explode(F.expr(f"sequence(0L, (n - 1) div {_COPIES})"))).repartition(*_PIECE, "part")
    copies = f"sequence(part * {_COPIES}, least(n, (part + 1) * {_COPIES}) - 1)"
    return parted.select(*_PIECE, F.explode(F.expr(copies)).alias("copy"))


def pieces(lengths: DataFrame, longest: int) -> DataFrame:
    """``doc_id, piece, start, length`` of every document of ``doc_id, n``; one empty piece where n is 0."""
    last = F.expr(f"greatest((n - 1) div {longest}, 0L)")
    spread = lengths.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece"))
    return spread.selectExpr("doc_id", "piece", f"piece * {longest} AS start", f"least(n - piece * {longest}, {longest}) AS length")


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def pack_documents(docs: DataFrame, permitted: Iterable[int] = LENGTHS, shard: int = SHARD, length=None) -> DataFrame:
    """A row per piece of every row of ``docs``: ``doc_id, piece, start, length, bin_id, capacity, offset``.

    ``length`` is a column expression over ``docs``, by default the number of words of ``text``. Pieces of
    one bin lie behind each other from offset 0; ``capacity`` is the smallest permitted length that holds
    them. A document of length 0 (null or empty text too) is in no bin: bin and capacity are null. Repeated
    rows and null ids are packed like all others.
    """
    permitted = tuple(sorted(set(permitted)))
    longest = permitted[-1]
    n = word_count(docs["text"]) if length is None else F.greatest(F.coalesce(length, F.lit(0)), F.lit(0)).cast("bigint")
    cuts = cut(_numbered(pieces(docs.select(docs["doc_id"], n.alias("n")), longest)))
    loose = cuts.where(f"length > 0 AND length < {longest}")
    shards = max(1, -(-loose.count() // shard))
    dealt = loose.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "length", "copy"), F.lit(shards)))
    fit = dealt.groupBy("shard").applyInArrow(_shard_packer(permitted), PACKED)
    full = cuts.where(f"length = {longest}").selectExpr(
        "doc_id", "piece", "start", "length",
        "concat('full-', coalesce(string(doc_id), 'null'), '-', piece, '-', start, '-', copy) AS bin_id",
        f"{longest}L AS capacity", "0L AS offset",
    )
    empty = cuts.where("length = 0").selectExpr(
        "doc_id", "piece", "start", "length", "CAST(NULL AS string) AS bin_id", "CAST(NULL AS bigint) AS capacity",
        "CAST(NULL AS bigint) AS offset",
    )
    return fit.unionByName(full).unionByName(empty)
