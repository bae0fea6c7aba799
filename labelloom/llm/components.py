"""Connected components of a graph of links by alternating star steps.

Each step hangs the neighbours of a node onto the smallest one it knows: the larger neighbours in the
large-star step, the others in the small-star step (Kiveris et al., 2014). The links end as stars
around the smallest node of every component, after a number of steps that grows with the logarithm
of the longest path. A step is one aggregate and one join; the smallest neighbour of a node with very
many links is found by an aggregate that combines before the shuffle.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.shared import cut


LINKS_PER_FILE = 1_000_000


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("of")).agg(F.least("of", F.min("b")).alias("least"))
    hung = both.join(least, both["a"] == least["of"]).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return hung.where("a > b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    # Links point from the larger node a to the smaller b.
    least = links.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("least"))
    hung = links.join(least, links["a"] == least["of"])
    others = hung.select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select(F.col("of").alias("a"), F.col("least").alias("b"))
    return others.unionAll(own).where("a > b").distinct()


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("sum(pmod(xxhash64(b, a), 1000003))")).first())


def components(links: DataFrame, files: int | None = None) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a, b``), the component being its smallest
    node. Loops, repeated links and either direction are fine; a link with a null end is none. ``files``
    is for the first checkpoint, before the links are counted."""
    links = cut(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        files=files,
    )
    before = _fingerprint(links)
    while before[0]:
        links = cut(_small_star(_large_star(links)), files=before[0] // LINKS_PER_FILE)
        now = _fingerprint(links)
        if now == before:
            break
        before = now
    leaves = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionAll(links.select(F.col("b"), F.col("b")).distinct())
