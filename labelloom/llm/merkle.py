"""A Merkle manifest of a table: one digest for everything, and for each row the proof that it is in it.

Rows are the leaves of one tree per group; ``FAN`` neighbours make a parent, level by level, and the tops
of all groups are the leaves of a last tree, whose top is the root.

Digests travel by time-forward processing (Chiang et al., 1995): every node has a label, labels rise
from leaves to tops, and a node sends its digest ahead to its parent through a priority queue ordered by
label, which hands it over when the sweep arrives there. The queue has two parts. Within a block of
``FAN ** HEIGHT`` neighbours it is a heap; what goes to a parent beyond the block is written down,
sorted by label by Spark's shuffle, which goes to disk as needed, and read by the next round as
the leaves of its blocks. A reversed sweep then takes labels in falling order and sends to each child
its own step of the proof with all steps above it: proof suffixes arrive at the leaves. A task never
holds more than one block, whatever the size of a group, and rounds grow with the logarithm of the
largest group.
"""

import hashlib
import heapq
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.operators import ranges
from labelloom.shared import cut

FAN = 3
HEIGHT = 6
# One step of a proof: the digests before and behind the node in its run, each 64 characters.
PROOF = "array<struct<before: string, after: string>>"
_STEP = pa.struct([("before", pa.string()), ("after", pa.string())])
_TOPS = "tree binary, block bigint, n bigint, early string, top string"
_ROWS_A_BATCH = 4096
_LEAVES_A_FILE = 20_000
_PLACED = ["tree", "place", "digest", "subroot", "steps"]


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of bytes, a colon and the value (integers in decimal)."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*values: Column) -> Column:
    """Lower-case hex SHA-256 of the encoded values, one behind the other."""
    return F.sha2(F.encode(F.concat(*map(encoded, values)), "UTF-8"), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    def step(below, s):
        return F.sha2(F.encode(F.concat(s["before"], below, s["after"]), "UTF-8"), 256)

    return F.aggregate(proof, leaf, step)


def proof_digest(proof: Column) -> Column:
    siblings = F.transform(proof, lambda s: F.concat(s["before"], s["after"]))
    return F.sha2(F.encode(F.array_join(siblings, ""), "UTF-8"), 256)


def _joined(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


class _Block:
    """The nodes above a run of leaves, up to level ``height``."""

    def __init__(self, leaves: list[str], fan: int, height: int):
        self._n, self._fan, self._height = len(leaves), fan, height
        # Digests that a node has received, in order of its children.
        self.received: dict[tuple[int, int, int], list[str]] = {}
        # The digest of the lowest node above all leaves, and its level.
        self.early, self.level = leaves[0], 0
        self.top = leaves[0]
        queue: list[tuple[tuple[int, int, int], int, str]] = []
        for i, leaf in enumerate(leaves):
            self._send(queue, (i + 1, 0, i), leaf)
            while queue and queue[0][0][0] <= i + 1:
                label, digests = queue[0][0], []
                while queue and queue[0][0] == label:
                    digests.append(heapq.heappop(queue)[2])
                self.received[label] = digests
                self._send(queue, label, _joined(digests))

    def _label(self, level: int, place: int) -> tuple[int, int, int]:
        """Labels rise with the last leaf below a node, then with its level."""
        return min((place + 1) * self._fan**level, self._n), level, place

    def _send(self, queue: list, label: tuple[int, int, int], own: str) -> None:
        _, level, place = label
        if self._fan**level >= self._n and (level == 0 or self._fan ** (level - 1) < self._n):
            self.early, self.level = own, level
        if level == self._height:
            self.top = own
        else:
            heapq.heappush(queue, (self._label(level + 1, place // self._fan), place, own))

    def suffixes(self, above: tuple, whole: bool) -> list[tuple]:
        """The steps of every leaf, from its own level up, behind them those ``above`` the block. A
        ``whole`` tree ends at its lowest common node, a part of one at the height of the block."""
        level = self.level if whole else self._height
        found: list[tuple] = [()] * self._n
        top = self._label(level, 0)
        # The heap pops the smallest: negated labels fall.
        queue = [(tuple(-x for x in top), above)]
        while queue:
            negated, suffix = heapq.heappop(queue)
            label = tuple(-x for x in negated)
            _, level, place = label
            if level == 0:
                found[place] = suffix
                continue
            children = self.received[label]
            for j, _ in enumerate(children):
                step = ("".join(children[:j]), "".join(children[j + 1 :]))
                child = self._label(level - 1, place * self._fan + j)
                heapq.heappush(queue, (tuple(-x for x in child), (step, suffix)))
        return found


def _rows(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    for batch in batches:
        for part in (batch.slice(at, _ROWS_A_BATCH) for at in range(0, batch.num_rows, _ROWS_A_BATCH)):
            yield from zip(*[part.column(c).to_pylist() for c in columns])


def _climbed(fan: int, height: int):
    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for key, rows in groupby(_rows(batches, ["tree", "block", "digest"]), key=lambda r: r[:2]):
            leaves = [r[2] for r in rows]
            block = _Block(leaves, fan, height)
            out.append((*key, len(leaves), block.early, block.top))
            if len(out) == _ROWS_A_BATCH:
                yield _tops(out)
                out = []
        if out:
            yield _tops(out)

    return climb


def _tops(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["tree", "block", "n", "early", "top"]
    )


def _flat(suffix: tuple) -> list[tuple[str, str]]:
    steps = []
    while suffix:
        step, suffix = suffix
        steps.append(step)
    return steps


def _linked(steps: list[dict]) -> tuple:
    suffix: tuple = ()
    for step in reversed(steps):
        suffix = ((step["before"], step["after"]), suffix)
    return suffix


def _steps_array(proofs: list[list[tuple[str, str]]]) -> pa.Array:
    offsets, before, after = [0], [], []
    for steps in proofs:
        before += [s[0] for s in steps]
        after += [s[1] for s in steps]
        offsets.append(len(before))
    steps = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], fields=list(_STEP))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), steps)


def _descended(fan: int, height: int, carried: pa.Schema):
    """Each block begins with the message from its parent, which has no digest."""
    names = carried.names

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ["tree", "block", "digest", "whole", "subroot", "steps", "place", *names]
        for key, rows in groupby(_rows(batches, columns), key=lambda r: r[:2]):
            message, *nodes = rows
            block = _Block([r[2] for r in nodes], fan, height)
            proofs = [_flat(s) for s in block.suffixes(_linked(message[5]), message[3])]
            for at in range(0, len(nodes), _ROWS_A_BATCH):
                part = nodes[at : at + _ROWS_A_BATCH]
                arrays = [
                    pa.array([key[0]] * len(part), pa.binary()), pa.array([r[6] for r in part], pa.int64()),
                    pa.array([r[2] for r in part], pa.string()), pa.array([message[4]] * len(part), pa.string()),
                    _steps_array(proofs[at : at + _ROWS_A_BATCH]),
                ]
                arrays += [pa.array([r[7 + i] for r in part], t) for i, t in enumerate(carried.types)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*_PLACED, *names])

    return descend


def _by_block(nodes: DataFrame) -> DataFrame:
    parts = ranges.parts_of(nodes)
    return nodes.repartition(parts, "tree", "block").sortWithinPartitions("tree", "block", F.col("place").asc_nulls_first())


_ARROW: dict[str, Callable[[], pa.DataType]] = {"bigint": pa.int64, "string": pa.string}


def _forest(nodes: DataFrame, fan: int, height: int) -> tuple[DataFrame, list[DataFrame]]:
    """All trees over ``tree, place, digest``: their tops (``tree, digest``) and the blocks of every round."""
    size = fan**height
    rounds, finished = [], []
    while True:
        blocks = nodes.withColumn("block", F.expr(f"place div {size}"))
        rounds.append(blocks)
        tops = cut(
            _by_block(blocks.select("tree", "block", "place", "digest")).mapInArrow(_climbed(fan, height), _TOPS),
            files=nodes.count() // size // _LEAVES_A_FILE,
        )
        # A tree ends in the round in which it is one block.
        single = tops.groupBy("tree").agg(F.max("block").alias("last"), F.min(F.when(F.col("block") == 0, F.col("early"))).alias("early"))
        finished.append(single.where("last = 0").select("tree", F.col("early").alias("digest"), F.lit(len(rounds) - 1).alias("round")))
        rest = tops.join(single.where("last > 0").select("tree"), "tree", "left_semi")
        nodes = rest.select("tree", F.col("block").alias("place"), F.col("top").alias("digest"))
        if nodes.isEmpty():
            break
    done = finished[0]
    for more in finished[1:]:
        done = done.unionByName(more)
    return done, rounds


def _proofs(rounds: list[DataFrame], above: DataFrame, fan: int, height: int, carry: dict[str, str]) -> DataFrame:
    """``tree, place, digest, subroot, steps`` and the carried columns of every leaf of round 0, from the steps
    ``above`` the top of each tree (``tree, round, subroot, steps``)."""
    proofs = None
    for number in reversed(range(len(rounds))):
        kept = carry if number == 0 else {}
        # A message for every block: from the tree's top if it ends here, else from the node above.
        messages = above.where(f"round = {number}").selectExpr("tree", "0L AS block", "true AS whole", "subroot", "steps")
        if proofs is not None:
            messages = messages.unionByName(
                proofs.selectExpr("tree", "place AS block", "false AS whole", "subroot", "steps")
            )
        nodes = rounds[number].selectExpr(
            "tree", "block", "digest", "CAST(NULL AS boolean) AS whole", "CAST(NULL AS string) AS subroot",
            f"CAST(NULL AS {PROOF}) AS steps", "place", *[f"`{c}`" for c in kept],
        )
        told = messages.selectExpr(
            "tree", "block", "CAST(NULL AS string) AS digest", "whole", "subroot", "steps",
            "CAST(NULL AS bigint) AS place", *[f"CAST(NULL AS {t}) AS `{c}`" for c, t in kept.items()],
        )
        carried = pa.schema([(c, _ARROW[t]()) for c, t in kept.items()])
        schema = ", ".join([
            "tree binary", "place bigint", "digest string", "subroot string", f"steps {PROOF}",
            *[f"`{c}` {t}" for c, t in kept.items()],
        ])
        proofs = _by_block(told.unionByName(nodes)).mapInArrow(_descended(fan, height, carried), schema)
    return proofs


def prove(
    leaves: DataFrame, group: str, order: list[str], fan: int = FAN, height: int = HEIGHT,
    carry: dict[str, str] | None = None,
) -> DataFrame:
    """A proof for every row of ``leaves``: ``group`` (a string), the ``order`` columns, ``leaf`` (a digest in
    hex) and the columns to ``carry`` (name to type, ``bigint`` or ``string``).

    Returns ``group``, the carried columns, ``leaf``, ``place`` (in its group, from 0), ``subroot`` (of the group),
    ``root`` and ``proof``: a step for each level, with the digests before and behind the node in its run,
    both empty where a node is alone. Groups come in the order of their UTF-8 bytes, the null group first;
    within a group nulls of ``order`` come first. Rows that are equal in ``order`` are ordered by ``leaf``, equal rows
    are a leaf each. Without rows the result has none.
    """
    carry = {c: t for c, t in (carry or {}).items() if c not in (group, "leaf")}
    # Null groups are a tree too: a byte in front tells it from all others and puts it first.
    tree = F.expr(f"if(`{group}` IS NULL, X'00', concat(X'01', encode(`{group}`, 'UTF-8')))")
    columns = list(dict.fromkeys([*order, *carry, "leaf"]))
    # Written once: the leaves are read for the sample, the counts and the rows, but hashed only here.
    given = cut(leaves.select(tree.alias("tree"), *columns))
    placed = ranges.numbered(given, "tree", [*order, "leaf"])
    nodes = cut(placed.select("tree", "place", F.col("leaf").alias("digest"), *carry), files=given.count() // _LEAVES_A_FILE)
    tops, rounds = _forest(nodes, fan, height)
    tops = cut(tops, files=1)
    named = tops.selectExpr("X'' AS all", "tree AS of", "digest")
    over = cut(ranges.numbered(named, "all", ["of"]).selectExpr("all AS tree", "place", "digest", "base64(of) AS of"), files=1)
    roots, upper = _forest(over, fan, height)
    start = roots.selectExpr("tree", "round", "digest AS subroot", f"CAST(array() AS {PROOF}) AS steps")
    above = _proofs(upper, start, fan, height, {"of": "string"}).selectExpr(
        "unbase64(of) AS tree", "digest AS subroot", "subroot AS root", "steps"
    )
    above = cut(above.join(tops.select("tree", "round"), "tree"), files=1)
    root = above.select("root").first()
    proofs = _proofs(rounds, above, fan, height, carry)
    named_group = f"if(tree = X'00', NULL, decode(substr(tree, 2), 'UTF-8')) AS `{group}`"
    return proofs.selectExpr(
        named_group, *[f"`{c}`" for c in carry], "digest AS leaf", "place", "subroot",
        f"'{root['root'] if root else ''}' AS root", "steps AS proof",
    )


def leaf(docs: DataFrame, text: Column | None = None) -> Column:
    """The leaf of a row of ``documents``: its five fields, ``text`` perhaps in another wording."""
    return digest(docs["doc_id"], docs["source"], docs["lang"], docs["n_chars"], docs["text"] if text is None else text)


def manifest(docs: DataFrame, found: Column | None = None) -> DataFrame:
    """The manifest of ``documents``: ``doc_id, source, leaf, place, subroot, root, proof``, one row for each of its.

    A column ``found`` over ``docs`` is the text as it was found later: with it, ``found_leaf`` is the leaf
    of that text, or null where ``found`` is null; fold it with the proof to see whether the row is still the same.
    Null fields are encoded as ``-``, an empty text as ``0:``; rows without an id come first in their source; further
    columns play no part.
    """
    own = leaf(docs)
    later = F.lit(None).cast("string") if found is None else F.when(found.isNotNull(), leaf(docs, found))
    leaves = docs.select(docs["doc_id"], docs["source"], own.alias("leaf"), later.alias("found_leaf"))
    done = prove(leaves, "source", ["doc_id"], carry={"doc_id": "bigint", "found_leaf": "string"})
    return done if found is not None else done.drop("found_leaf")
