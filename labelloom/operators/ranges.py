"""Rows in order, dealt into slices of about equal length, whoever they belong to.

A window puts all rows of its key into one task, which a key with a third of all rows does not allow.
Here the rows are cut by their order alone: into as many slices as Spark shuffles into partitions, with
bounds that a sample of the rows gives. The slices follow each other in the order of the rows, so
whatever adds up along a key (a running count, the last entries before a row) is computed within each
slice and carried over from those before. Only the key in which a slice opens can have rows before it,
hence a carry never has more rows than there are slices: it is small enough to broadcast, by proof.

Everything is one plan. The sample is a scalar subquery, which Spark runs when the rows are needed; it
depends on the rows only, not on tasks or machines, so a repeated task finds the same slices.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sampled rows for each slice. Slices of n rows in the mean stay within about 2 n.
SAMPLED_PER_SLICE = 32


def parts_of(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def bounds(rows: DataFrame, order: list[str], parts: int) -> DataFrame:
    """One row with one array: the first keys of all slices but the first, in order, at most ``parts - 1``.

    The rows with the smallest hashes are the sample. Each task keeps no more of them than the sample
    needs, and their number depends on ``parts`` alone.
    """
    drawn = rows.select(F.struct(*order).alias("key")).orderBy(F.xxhash64(*[f"key.{c}" for c in order])).limit(
        parts * SAMPLED_PER_SLICE
    )
    keys = drawn.agg(F.sort_array(F.collect_set("key")).alias("keys"))
    picked = f"transform(sequence(1, {max(1, parts - 1)}), i -> get(keys, int(i * size(keys) div {parts})))"
    return keys.select(F.expr(f"array_distinct(filter({picked}, k -> k IS NOT NULL))").alias("bounds"))


def sliced(rows: DataFrame, order: list[str], parts: int | None = None) -> DataFrame:
    """``rows`` with ``slice``, the number of bounds not above the row's key ``order``, and two marks of its
    first column, the group: ``opens``, if the bound below the slice is of this group (only then may rows of
    the group lie in earlier slices), and ``goes_on``, if the bound above is (only then in later ones).

    The search goes by halves, in as many steps as ``parts`` has bits.
    """
    parts = parts or parts_of(rows)
    at = bounds(rows, order, parts).scalar()
    keys, group = ", ".join(f"`{c}`" for c in order), order[0]
    steps = ", ".join(str(1 << b) for b in reversed(range(max(1, (parts - 1).bit_length()))))
    # Spark takes no subquery within a lambda, but its optimizer moves one there: _bounds is named once, and a generator
    # keeps the columns below apart. So the array is read where it is, and rows do not carry it along.
    columns = [F.col(f"`{c}`") for c in rows.columns]
    rows = rows.select("*", F.explode(F.array(F.lit(0))).alias("_apart")).select(*columns, at.alias("_bounds"))
    search = f"aggregate(array({steps}), 0, (low, step) -> low + if(get(_bounds, low + step - 1) <= struct({keys}), step, 0))"
    found = rows.select(*columns, F.expr(search).alias("slice"))

    def bound_is_of_group(place) -> F.Column:
        return F.coalesce(F.get(at, place)[group].eqNullSafe(F.col(group)), F.lit(False))

    return found.select(
        "*", ((F.col("slice") > 0) & bound_is_of_group(F.col("slice") - 1)).alias("opens"),
        ((F.col("slice") < F.size(at)) & bound_is_of_group(F.col("slice"))).alias("goes_on"),
    )


def dealt(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """Slice i into partition i. A window over the group and ``slice`` needs no further shuffle."""
    return rows.repartitionById(parts or parts_of(rows), F.col("slice"))


def numbered(rows: DataFrame, group: str, order: list[str], parts: int | None = None) -> DataFrame:
    """``rows`` with ``place``, the number of the row within its ``group`` in ``order``, from 0. Rows move once,
    whatever the size of a group; of the earlier slices only a count moves. Equal rows get places in any order."""
    parts = parts or parts_of(rows)
    cut = sliced(rows, [group, *order], parts)
    held = cut.where("opens OR goes_on").groupBy(group, "slice").agg(F.count("*").alias("n"), F.bool_or("opens").alias("opens"))
    before = held.selectExpr(
        f"`{group}` AS _of", "slice AS _slice", "opens",
        f"sum(n) OVER (PARTITION BY `{group}` ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _before",
    ).where("opens").drop("opens")
    keys = ", ".join(f"`{c}`" for c in order)
    own = dealt(cut.drop("opens", "goes_on"), parts).selectExpr(
        "*", f"row_number() OVER (PARTITION BY `{group}`, slice ORDER BY {keys}) - 1 AS _own"
    )
    # At most one row for each slice.
    joined = own.join(F.broadcast(before), (F.col("slice") == F.col("_slice")) & F.col(group).eqNullSafe(F.col("_of")), "left")
    return joined.selectExpr(*[f"`{c}`" for c in rows.columns], "bigint(_own + coalesce(_before, 0)) AS place")
