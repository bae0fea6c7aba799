"""Near-duplicate documents: MinHash bands propose, odd sketches sift, full sets confirm.

1. ``signatures``: per document a fingerprint of its shingle set, ``BANDS`` x ``ROWS`` MinHash samples
   folded into band hashes, and an odd sketch: each sample toggles one of ``SKETCH_BITS`` bits, so the
   population count of the XOR of two sketches estimates in how many samples two sets differ, and is
   most precise where they are very similar (Mitzenmacher, Pagh, Pham, 2014).
2. Documents with equal sets collapse into a class, represented by its smallest id. Nothing below
   handles a class more than once, however many copies it has.
3. Classes that share a band hash are candidates. A bucket is first compared with two of its members
   only, the smallest and the largest; what these links join needs no further comparison.
4. Members of buckets that are still in several components are compared further, but not all with
   all: many versions of one page, each too far from the others, would make pairs without end. Two sets
   as similar as the threshold must share one of their rarest shingles (prefix filter with positions,
   Xiao et al., 2008), so an equi-join on those finds every pair that is left to test.
5. A candidate pair must pass the sketch and then the exact test on both full sets.
6. Components of the confirmed links name the groups.

Two sets at the threshold of 0.8 share no band with probability (1 - 0.8^5)^40 < 2e-7, and fail the
sketch, set at six standard deviations, with less. Shingles are compared by 64-bit hashes.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelloom.llm.components import components
from labelloom.llm.words import mixed, only, shingle_set, texts
from labelloom.shared import cut

WIDTH = 4
# Link documents with 100 * intersection >= THRESHOLD * union.
THRESHOLD = 80
BANDS, ROWS = 40, 5
SKETCH_BITS = 512
_WORDS = SKETCH_BITS // 64
_SAMPLES = BANDS * ROWS
# Odd multipliers permute the 64-bit numbers; each MinHash sample has its own.
_MULTIPLIERS = mixed(np.arange(1, _SAMPLES + 1, dtype=np.uint64)) | np.uint64(1)
_BAND_SALTS = mixed(np.arange(1_000_001, 1_000_001 + BANDS, dtype=np.uint64))
_SAMPLE_SALTS = mixed(np.arange(2_000_001, 2_000_001 + _SAMPLES, dtype=np.uint64))
# Intermediate results are kept in a file for so many documents.
DOCS_PER_FILE = 5_000
_CHUNK = 1 << 11  # shingles permuted at once; bounds the memory of a long document

SIGNED = "doc_id bigint, n_shingles bigint, fp array<bigint>, sketch array<bigint>, bands array<bigint>"
_SIGNED = pa.schema([
    ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("fp", pa.list_(pa.int64())),
    ("sketch", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64())),
])
_SETS = pa.schema([("doc_id", pa.int64()), ("shingles", pa.list_(pa.int64()))])


def max_differing_bits(samples: int = _SAMPLES, bits: int = SKETCH_BITS, threshold: int = THRESHOLD) -> int:
    """XOR population count that a pair at the threshold exceeds only beyond six standard deviations."""
    miss = 1 - threshold / 100
    differing = samples * miss + 6 * (samples * miss * (1 - miss)) ** 0.5
    share = (1 - (1 - 2 / bits) ** (2 * differing)) / 2
    return int(bits * share + 6 * (bits * share * (1 - share)) ** 0.5)


def minima(hashes: np.ndarray) -> np.ndarray:
    """The MinHash samples of a shingle set."""
    least = np.full(_SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _CHUNK):
        np.minimum(least, np.multiply.outer(_MULTIPLIERS, hashes[at : at + _CHUNK]).min(axis=1), out=least)
    return least


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps, one row of words per row of samples."""
    places = (mixed(samples ^ _SAMPLE_SALTS) % np.uint64(SKETCH_BITS)).astype(np.int64)
    rows = len(samples)
    counts = np.bincount((places + np.arange(rows)[:, None] * SKETCH_BITS).ravel(), minlength=rows * SKETCH_BITS)
    odd = np.packbits((counts & 1).astype(np.uint8).reshape(rows, SKETCH_BITS), axis=1, bitorder="little")
    return odd.view(np.int64).reshape(rows, _WORDS)


def band_hashes(samples: np.ndarray) -> np.ndarray:
    banded = samples.reshape(len(samples), BANDS, ROWS)
    total = np.broadcast_to(_BAND_SALTS, banded.shape[:2]).copy()
    for i in range(ROWS):
        total = mixed(total + banded[:, :, i])
    return total.view(np.int64)


def _lists(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(rows.ravel()))


def _fingerprint(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits of a set: sums of two independent hashes of its members."""
    again = mixed(hashes ^ np.uint64(0xD6E8FEB86659FD93))
    return int(hashes.sum(dtype=np.uint64).view(np.int64)), int(again.sum(dtype=np.uint64).view(np.int64))


def _signed(width: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                sizes, prints = [], []
                samples = np.empty((part.num_rows, _SAMPLES), np.uint64)
                for row, text in enumerate(texts(part)):
                    own = shingle_set(text.lower().split(), width)
                    sizes.append(len(own))
                    prints.append(_fingerprint(own))
                    samples[row] = minima(own)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(sizes, pa.int64()), _lists(np.array(prints, np.int64)),
                        _lists(odd_sketches(samples)), _lists(band_hashes(samples)),
                    ],
                    schema=_SIGNED,
                )

    return sign


def signatures(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_shingles, fp, sketch, bands`` of every row; an empty set has a size of 0."""
    return only(docs, "doc_id", "text").mapInArrow(_signed(width), SIGNED)


def _full_sets(width: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                own = [shingle_set(text.lower().split(), width).view(np.int64) for text in texts(part)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(own, _SETS.types[1])], schema=_SETS)

    return sets


def _similar(a: str, b: str) -> str:
    """SQL over two odd sketches: few enough bits differ."""
    differing = " + ".join(f"bit_count({a}[{i}] ^ {b}[{i}])" for i in range(_WORDS))
    return f"({differing}) <= {max_differing_bits()}"


def _confirmed(pairs: DataFrame, sketches: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``a, b`` among the pairs: by size, by sketch, then by the full sets."""

    def side(name: str, of: DataFrame) -> DataFrame:
        return of.select(*[F.col(c).alias(name if c == "rep" else f"{c}_{name}") for c in of.columns])

    sized = f"100 * least(n_a, n_b) >= {THRESHOLD} * greatest(n_a, n_b)"
    sifted = (
        pairs.join(side("a", sketches), "a").join(side("b", sketches), "b")
        .where(f"{sized} AND {_similar('sketch_a', 'sketch_b')}").select("a", "b")
    )
    both = sifted.join(side("a", sets), "a").join(side("b", sets), "b")
    shared = both.selectExpr(
        "a", "b", "size(shingles_a) + size(shingles_b) AS total",
        "size(array_intersect(shingles_a, shingles_b)) AS shared",
    )
    return shared.where(f"100 * shared >= {THRESHOLD} * (total - shared)").select("a", "b").distinct()


def _rare_shingle_pairs(open_members: DataFrame, sets: DataFrame, files: int) -> DataFrame:
    """Pairs ``a, b`` of different components that share a shingle among their rarest ones, from
    ``rep, component``. No pair of the threshold's similarity is missing.

    Shingles are ordered by how many sets hold them. Where two sets overlap as the threshold demands,
    the larger's first n - ceil(t n) + 1 shingles and the smaller's first n - ceil(2t / (1 + t) n) + 1
    have one in common, and behind the first common one there is room enough for the overlap. A
    shingle of one set alone can match nothing: those only count as places.
    """
    t = THRESHOLD
    spread = open_members.join(sets, "rep").selectExpr("rep", "component", "size(shingles) AS n", "explode(shingles) AS shingle")
    held = spread.groupBy("shingle").agg(F.count("*").alias("held")).where("held > 1")
    by_rarity = Window.partitionBy("rep").orderBy("held", "shingle")
    placed = (
        spread.join(held, "shingle")
        .withColumn("place", F.row_number().over(by_rarity))
        .withColumn("place", F.expr("n - count(*) OVER (PARTITION BY rep) + place"))
        .where(f"place <= n - ({t} * n + 99) div 100 + 1")
        .select("shingle", "rep", "component", "n", "place")
    )
    placed = cut(placed, files)
    fewer = placed.where(f"place <= n - ({2 * t} * n + {99 + t}) div {100 + t} + 1").select(
        "shingle", *[F.col(c).alias(f"{c}_b") for c in ("rep", "component", "n", "place")]
    )
    room = "1 + least(n - place, n_b - place_b)"
    met = placed.join(fewer, "shingle").where(
        f"component != component_b AND (n_b < n OR (n_b = n AND rep_b < rep)) AND 100 * n_b >= {t} * n"
        f" AND {100 + t} * ({room}) >= {t} * (n + n_b)"
    )
    return met.selectExpr("rep AS a", "rep_b AS b").distinct()


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Words are lower-cased (A-Z); a document's set holds its distinct shingles of ``width`` words, or
    the whole sequence as one when it has fewer words. ``component_id`` is the smallest document id
    that links reach, ``kept`` whether it is the document's own. A document without words has an empty set
    and is linked with nothing. Repeated rows come out as often as they went in. Rows that share an id but not
    their text are each placed by their own text, so one id may come out in several components, and two such
    texts join if the id is the smallest of both; ``jaccard_join`` makes one document of them. A row without an id
    links with nothing and is kept, ``component_id`` null.
    """
    signed = cut(signatures(docs, width))
    files = signed.count() // DOCS_PER_FILE
    linkable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL").selectExpr(
        "doc_id", "n_shingles AS n", "fp[0] AS fp0", "fp[1] AS fp1", "sketch", "bands"
    )
    classes = linkable.groupBy("fp0", "fp1").agg(F.min("doc_id").alias("rep"))
    # A document's own class is the one it represents, if any.
    firsts = linkable.withColumnRenamed("doc_id", "rep").join(classes, ["rep", "fp0", "fp1"])
    banded = firsts.select("rep", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("rep").alias("first"), F.max("rep").alias("last")).where("first < last")
    members = cut(banded.join(buckets, "band"), files)
    involved = members.select("rep").distinct()
    sketches = cut(firsts.join(involved, "rep", "left_semi").select("rep", "n", "sketch").distinct(), files)
    sets = cut(
        only(docs, "doc_id", "text").join(involved.withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi")
        .dropDuplicates(["doc_id", "text"])
        .mapInArrow(_full_sets(width), "doc_id bigint, shingles array<bigint>")
        .withColumnRenamed("doc_id", "rep"),
        files,
    )

    pivots = members.select("rep", F.explode(F.array("first", "last")).alias("pivot")).where("rep != pivot")
    near_pivots = pivots.select(F.greatest("rep", "pivot").alias("a"), F.least("rep", "pivot").alias("b")).distinct()
    joined = components(_confirmed(near_pivots, sketches, sets), files)

    placed = members.select("band", "rep").join(joined.withColumnRenamed("node", "rep"), "rep", "left").selectExpr(
        "band", "rep", "coalesce(component, rep) AS component"
    )
    open_buckets = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where(
        "low < high"
    )
    rest = placed.join(open_buckets.select("band"), "band", "left_semi").select("rep", "component").distinct()
    found = _confirmed(_rare_shingle_pairs(rest, sets, files), sketches, sets)
    joined = components(
        joined.selectExpr("node AS a", "component AS b").unionByName(found), files
    ).withColumnRenamed("node", "rep")

    placed_classes = classes.join(joined, "rep", "left").selectExpr(
        "fp0", "fp1", "coalesce(component, rep) AS component"
    )
    of_docs = (
        linkable.select("doc_id", "n", "fp0", "fp1").join(placed_classes, ["fp0", "fp1"])
        .selectExpr("doc_id", "n AS n_shingles", "component AS component_id")
    )
    alone = signed.where("n_shingles = 0 OR doc_id IS NULL").selectExpr("doc_id", "n_shingles", "doc_id AS component_id")
    return of_docs.unionByName(alone).selectExpr(
        "doc_id", "n_shingles", "component_id", "coalesce(doc_id = component_id, true) AS kept"
    )
