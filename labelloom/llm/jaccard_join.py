"""Exact similarity join of documents on word n-grams, by adaptive multi-match prefixes.

Let t be the threshold and put the shingles of all sets in one order. Two sets of n shingles that overlap
as t demands differ in at most n - ceil(t n) of either's. So of the first n - ceil(t n) + l of one and the
first m - ceil(t m) + l of the other at least l agree: with l = 1 the usual prefix filter, and the longer
the prefixes, the more must agree before a pair is worth a look (Wang, Li, Feng, 2012). Sets may even differ
in l: the smaller of two binds.

1. Rows with equal sets make a class; nothing below handles a class more than once. A class has a number.
2. A first sieve needs no statistics: in the order of hashes, a set whose prefix of l = 1 + n / 10 holds too few
   shingles that any other set's prefix holds is linked with nothing. It moves three tenths of the shingles.
3. The sets left are put in the order of rarity, counted exactly. Shingles of one set alone come first and match
   nothing; they only take up places.
4. Groups of near copies would make pairs without end. Each set is first compared with the most central
   holder of its prefix shingles; what these links join is a component and needs no further comparison.
5. Shingles that several components hold still propose pairs. For each set the estimated cost decides
   on l: the postings that a longer prefix reads against the candidates it spares. At least l common shingles bound
   the candidates by postings / l, and each costs a comparison of full sets. Pairs of different
   components that agree in as many prefix shingles as the smaller l says are compared.

Comparisons are exact, on all shingles of both sets, by 64-bit hashes; no pair at the threshold is missed.
"""

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.components import components
from labelloom.llm.words import mixed, only, shingle_set, texts
from labelloom.operators.ranges import parts_of
from labelloom.shared import cut, release

WIDTH = 5
# Link documents with 100 * intersection >= THRESHOLD * union.
THRESHOLD = 80
# Sets compared with one pivot in one task.
COMPARED = 256
CENTRAL_ROUNDS = 2
READ = 512
# Rows and bits a row of the bitmap of wanted ids.
_BITMAPS, _BITS = 2048, 32_768
_DOCS_PER_FILE = 5_000
_SLICE = 256  # documents of a batch that are worked on at once


def _needed(n: str) -> str:
    """SQL: the least overlap of a set of ``n`` with any set it is linked with."""
    return f"(({THRESHOLD} * {n} + 99) div 100)"


def needed(n: int) -> int:
    return -(-THRESHOLD * n // 100)


def matches(n: int) -> int:
    """How many agreeing shingles the first sieve asks for at a set of ``n``; it grows with ``n``."""
    return 1 + n // 10


def prefix_length(n: int, least: int) -> int:
    return n - needed(n) + least


def _fingerprint(hashes: np.ndarray) -> tuple[int, int]:
    again = mixed(hashes ^ np.uint64(0xA0761D6478BD642F))
    return int(hashes.sum(dtype=np.uint64).view(np.int64)), int(again.sum(dtype=np.uint64).view(np.int64))


def _sized(width: int, bits: int):
    kind = pa.int32() if bits <= 32 else pa.int64()
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("fp0", pa.int64()), ("fp1", pa.int64()), ("prefix", pa.list_(kind))])

    def short(hashes: np.ndarray) -> np.ndarray:
        cut_off = hashes >> np.uint64(64 - bits)
        return cut_off.astype(np.uint32).view(np.int32) if bits <= 32 else cut_off.view(np.int64)

    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, _SLICE) for at in range(0, batch.num_rows, _SLICE)):
                own = [shingle_set(text.lower().split(), width) for text in texts(part)]
                sizes, prints = [len(s) for s in own], [_fingerprint(s) for s in own]
                # The sets are sorted by hash.
                prefixes = [short(s[: prefix_length(n, matches(n))]) if n else [] for s, n in zip(own, sizes)]
                columns = [sizes, [p[0] for p in prints], [p[1] for p in prints], prefixes]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, schema.types[1:])]], schema=schema
                )

    return size


def _full_sets(width: int):
    """The set of every class, once in a task."""
    schema = pa.schema([("cls", pa.int64()), ("n", pa.int64()), ("signed", pa.list_(pa.int64()))])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for part in (batch.slice(at, _SLICE) for at in range(0, batch.num_rows, _SLICE)):
                names, sizes, chosen = [], [], []
                for cls, fp0, fp1, text in zip(*[part.column(c).to_pylist() for c in ("cls", "fp0", "fp1")], texts(part)):
                    if cls in seen:
                        continue
                    own = shingle_set(text.lower().split(), width)
                    if _fingerprint(own) != (fp0, fp1):
                        continue  # another text of the same id
                    seen.add(cls)
                    names.append(cls)
                    sizes.append(len(own))
                    chosen.append(own.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((names, sizes, chosen), schema.types)], schema=schema)

    return sets


def _texts_of(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The texts that stand for ``classes``; only few others move with them.

    A bitmap of fixed size marks the hashes of the ids that are wanted. It is broadcast, ``_BITMAPS`` rows of 4 KB whatever
    the input; texts that it rules out stay where they are.
    """
    named = classes.select(F.col("least").alias("doc_id"), "cls", "fp0", "fp1")

    def place(column: str) -> str:
        return f"pmod(xxhash64({column}), {_BITMAPS * _BITS}L)"

    marks = named.selectExpr(f"{place('doc_id')} AS place").groupBy(F.expr(f"int(place div {_BITS}) AS bucket")).agg(
        F.expr(f"bitmap_construct_agg(place % {_BITS}) AS bits")
    )
    wanted = f"bit_get(bigint(conv(hex(substring(bits, int(place % {_BITS} div 8) + 1, 1)), 16, 10)), int(place % 8)) = 1"
    likely = docs.withColumn("place", F.expr(place("doc_id"))).withColumn("bucket", F.expr(f"int(place div {_BITS})"))
    likely = likely.join(F.broadcast(marks), "bucket").where(wanted).select("doc_id", "text")
    return likely.join(named, "doc_id").select("cls", "fp0", "fp1", "text")


def _sifted(classes: DataFrame) -> DataFrame:
    """``cls`` of the sets whose prefixes hold enough shingles of others. A partner may be smaller, down to the threshold."""
    spread = classes.select("cls", "n", F.explode("prefix").alias("shingle"))
    shared = spread.groupBy("shingle").agg(F.count("*").alias("held")).where("held > 1").select("shingle")
    found = spread.join(shared, "shingle").groupBy("cls", "n").agg(F.count("*").alias("found"))
    return found.where(f"found >= 1 + {_needed('n')} div 10").select("cls")


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between a pivot, which comes first, and the members behind it."""
    links: list[tuple[int, int]] = []
    rows = (
        row for batch in batches for part in (batch.slice(at, _SLICE) for at in range(0, batch.num_rows, _SLICE))
        for row in zip(
            *[part.column(c).to_pylist() for c in ("pivot", "salt", "member")],
            # Sets are sorted as unsigned numbers.
            [s.values.to_numpy(zero_copy_only=False).view(np.uint64) for s in part.column("shingles")],
        )
    )
    for _, group in groupby(rows, key=lambda r: r[:2]):
        pivot = None
        for name, _, member, shingles in group:
            if member is None:
                pivot = shingles
                continue
            places = np.minimum(np.searchsorted(pivot, shingles), len(pivot) - 1)
            shared = int((pivot[places] == shingles).sum())
            if 100 * shared >= THRESHOLD * (len(pivot) + len(shingles) - shared):
                links.append((name, member))
        if len(links) > 4096:
            yield _links(links)
            links = []
    if links:
        yield _links(links)


def _links(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in zip(*links)], names=["a", "b"])


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``a, b`` among the distinct ``pairs`` (``pivot, member``), by the full sets.

    Members travel to their pivot, whose set goes out once for every ``COMPARED`` of them: a pivot with very many
    members is spread over as many tasks.
    """
    salts = pairs.groupBy("pivot").agg(F.expr(f"bigint(count(*) div {COMPARED} + 1) AS salts"))
    own = salts.join(sets, salts["pivot"] == sets["cls"]).select(
        "pivot", F.explode(F.expr("sequence(0L, salts - 1)")).alias("salt"), F.lit(None).cast("bigint").alias("member"),
        F.col("signed").alias("shingles"),
    )
    others = pairs.join(salts, "pivot").join(sets, F.col("member") == F.col("cls")).selectExpr(
        "pivot", "pmod(xxhash64(member), salts) AS salt", "member", "signed AS shingles"
    )
    met = own.unionByName(others).repartition(parts_of(sets), "pivot", "salt")
    met = met.sortWithinPartitions("pivot", "salt", F.col("member").asc_nulls_first())
    return met.mapInArrow(_compared, "a bigint, b bigint")


def _placed(sets: DataFrame) -> DataFrame:
    """``cls, n, shared, shingle, held, place`` of the shingles that several sets hold, in the order of rarity, from 1;
    ``shared`` is how many of them the set has, which no overlap exceeds."""
    spread = sets.select("cls", "n", F.explode("signed").alias("shingle"))
    held = spread.groupBy("shingle").agg(F.count("*").alias("held")).where("held > 1")
    ranked = spread.join(held, "shingle").selectExpr(
        "*", "row_number() OVER (PARTITION BY cls ORDER BY held, shingle) AS at", "count(*) OVER (PARTITION BY cls) AS shared"
    )
    longest = f"n - {_needed('n')} + 1 + n div 10"
    return ranked.selectExpr("cls", "n", "shared", "shingle", "held", "n - shared + at AS place").where(f"place <= {longest}")


def _central_pairs(placed: DataFrame, component_of: DataFrame) -> DataFrame:
    """``pivot, member``: each set with the two sets that are the most central holders of most of its prefix, of other
    components than its own. Central is who holds the shingles that most others hold."""
    first = placed.where(f"place <= n - {_needed('n')} + 1")
    central = placed.groupBy("cls").agg((F.sum("held") / F.max("n")).alias("central"))
    first = first.join(central, "cls").join(component_of, "cls")
    best = first.groupBy("shingle").agg(F.max(F.struct("central", "cls", "component", "n")).alias("best"))
    met = first.join(best, "shingle").where("best.component != component").where(
        f"100 * least(n, best.n) >= {THRESHOLD} * greatest(n, best.n)"
    )
    votes = met.groupBy("cls", F.col("best.cls").alias("pivot")).agg(F.count("*").alias("votes"))
    ranked = votes.selectExpr("*", "row_number() OVER (PARTITION BY cls ORDER BY votes DESC, pivot) AS at").where("at <= 2")
    return ranked.select("pivot", F.col("cls").alias("member")).distinct()


def adapted(placed: DataFrame) -> DataFrame:
    """``cls, l``: for each set the number of agreeing shingles that costs least, from ``cls, n, shingle, place, others``,
    ``others`` being how many sets of other components hold the shingle.

    With S postings in the prefix of l, reading them costs S, and comparing at most S / l candidates n / ``READ`` each: sets
    are compared as arrays, ``READ`` shingles in the time that one posting takes through the join.
    """
    base = f"(n - {_needed('n')})"
    costs = placed.selectExpr(
        "cls", "n", "place",
        "sum(others) OVER (PARTITION BY cls ORDER BY place ROWS UNBOUNDED PRECEDING) AS postings",
        # Up to the next shingle that others hold, a longer prefix reads no more.
        f"coalesce(lead(place) OVER (PARTITION BY cls ORDER BY place) - 1, {base} + 1 + n div 10) - {base} AS l",
    ).where("l >= 1")
    chosen = costs.groupBy("cls").agg(
        F.expr(f"min_by(l, struct(postings * (1 + n / ({READ} * l)), l)) AS l"), F.min(F.expr(f"place - {base}")).alias("first")
    )
    # Who shares nothing within the prefix of l = 1 is linked with nobody else.
    return chosen.where("first <= 1").drop("first")


def _multi_match_pairs(placed: DataFrame, component_of: DataFrame, files: int) -> DataFrame:
    """``pivot, member``: the pairs of different components that agree in as many prefix shingles as the smaller l says."""
    named = placed.join(component_of, "cls")
    by_component = named.groupBy("shingle", "component").agg(F.count("*").alias("own"))
    totals = by_component.groupBy("shingle").agg(F.sum("own").alias("all"), F.count("*").alias("components")).where("components > 1")
    crossing = by_component.join(totals, "shingle").selectExpr("shingle", "component", "all - own AS others")
    named = cut(named.join(crossing, ["shingle", "component"]), files)
    chosen = named.join(adapted(named), "cls").where(f"place <= n - {_needed('n')} + l").select(
        "shingle", "cls", "component", "n", "shared", "place", "l"
    )
    t = THRESHOLD
    # The smaller of two sets overlaps by more of its own: its prefix is shorter.
    other = chosen.where(f"place <= n - ({2 * t} * n + {99 + t}) div {100 + t} + l").select(
        "shingle", *[F.col(c).alias(f"{c}_b") for c in ("cls", "component", "n", "shared", "place", "l")]
    )
    # The first l common shingles are enough. Up to one of them there are no more than l, nor than either set shares with
    # others up to there, and behind it no more than either has left.
    most = "least(l, l_b, place - n + shared, place_b - n_b + shared_b) + least(n - place, n_b - place_b)"
    met = chosen.join(other, "shingle").where(
        f"component != component_b AND (n > n_b OR (n = n_b AND cls > cls_b)) AND 100 * n_b >= {t} * n"
        f" AND {100 + t} * ({most}) >= {t} * (n + n_b)"
    )
    agreeing = met.groupBy("cls", "cls_b", "l", "l_b").agg(F.count("*").alias("agree")).where("agree >= least(l, l_b)")
    return agreeing.selectExpr("cls AS pivot", "cls_b AS member")


def _component_of(sets: DataFrame, links: DataFrame | None, files: int) -> DataFrame:
    if links is None:
        return sets.selectExpr("cls", "cls AS component")
    found = components(links, files).withColumnRenamed("node", "cls")
    return cut(sets.select("cls").join(found, "cls", "left").selectExpr("cls", "coalesce(component, cls) AS component"), files)


def class_links(sets: DataFrame, files: int) -> DataFrame:
    """Links ``a, b`` that join all classes that any path of links joins; not all links within a component. ``files`` is
    how many files an intermediate result may have."""
    placed = cut(_placed(sets), files)
    release(sets.sparkSession)
    links, component_of = None, _component_of(sets, None, files)
    for _ in range(CENTRAL_ROUNDS):
        found = cut(confirmed(cut(_central_pairs(placed, component_of), files), sets), files)
        if found.isEmpty():
            break
        links = found if links is None else links.unionByName(found)
        component_of = _component_of(sets, links, files)
        release(sets.sparkSession)
    found = cut(confirmed(cut(_multi_match_pairs(placed, component_of, files), files), sets), files)
    return found if links is None else links.unionByName(found)


def _classes(docs: DataFrame, width: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Narrow rows (``doc_id, n, fp0, fp1``), the classes (``fp0, fp1, least, cls``), and the ``cls`` that the sieve leaves. The prefixes
    are not needed after that."""
    # Prefixes hold hashes cut to as many bits as tell that many shingles apart in most cases: a false match only lets
    # a set through to the exact steps. A document has about a prefix shingle for every 16 characters.
    characters = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = min(64, (characters // 16).bit_length() + 6)
    kind = "int" if bits <= 32 else "bigint"
    rows = cut(docs.mapInArrow(_sized(width, bits), f"doc_id bigint, n bigint, fp0 bigint, fp1 bigint, prefix array<{kind}>"))
    narrow = cut(rows.drop("prefix"))
    files = narrow.count() // _DOCS_PER_FILE
    # Equal sets have equal prefixes; copies meet in the task that made them before any moves.
    classes = cut(
        rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("fp0", "fp1").agg(
            F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("prefix").alias("prefix")
        ),
        files,
    ).withColumn("cls", F.monotonically_increasing_id())
    left = cut(_sifted(classes), files)
    return narrow, cut(classes.select("fp0", "fp1", "least", "cls")), left


def join_components(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Words are lower-cased (A-Z); a document's set holds its distinct shingles of ``width`` words, or the whole
    sequence as one when it has fewer. Documents link when 100 * intersection >= ``THRESHOLD`` * union of their sets;
    ``component_id`` is the smallest document id that links reach, its own included. A null or empty text has an empty set
    and is linked with nothing. Rows that share an id are one document: what any of them reaches is one component, each
    row with the size of its own set. Repeated rows come out as often as they went in. A row without an id links
    with nothing, its ``component_id`` is null. Further columns play no part.
    """
    docs = only(docs, "doc_id", "text")
    release(docs.sparkSession)
    rows, classes, left = _classes(docs, width)
    files = rows.count() // _DOCS_PER_FILE
    release(docs.sparkSession)
    linkable = rows.where("n > 0 AND doc_id IS NOT NULL")
    sets = cut(
        _texts_of(docs, classes.join(left, "cls")).mapInArrow(_full_sets(width), "cls bigint, n bigint, signed array<bigint>"), files
    )
    names = sets.select("cls")
    if names.count() > names.distinct().count():  # repeated rows, met in several tasks
        sets = cut(sets.dropDuplicates(["cls"]), files)
    release(docs.sparkSession)
    links = class_links(sets, files)
    of_rows = linkable.join(classes, ["fp0", "fp1"]).select("doc_id", "n", "cls")
    # An id with several texts joins their classes.
    twice = of_rows.groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("z")).where("a < z")
    same = of_rows.join(twice, "doc_id").select(F.col("cls").alias("a"), F.col("a").alias("b")).where("a != b").distinct()
    joined = components(links.unionByName(same), files).withColumnRenamed("node", "cls")
    grouped = classes.join(joined, "cls", "left").selectExpr("fp0", "fp1", "least", "coalesce(component, cls) AS component")
    ids = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = cut(grouped.join(ids, "component").select("fp0", "fp1", "component_id"), files)
    of_docs = linkable.join(named, ["fp0", "fp1"]).selectExpr("doc_id", "n AS n_shingles", "component_id")
    alone = rows.where("n = 0 OR doc_id IS NULL").selectExpr("doc_id", "n AS n_shingles")
    # An empty text may share its id with another.
    other = of_docs.join(alone.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min("component_id").alias("of_id")
    )
    alone = alone.join(other, "doc_id", "left").selectExpr("doc_id", "n_shingles", "coalesce(of_id, doc_id) AS component_id")
    return of_docs.unionByName(alone)
