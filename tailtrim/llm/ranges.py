"""Tables dealt into ranges of an id, so that tasks see their rows in order."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# More rows than this make a further range.
ROWS_PER_PART = 262_144
# Ranges for each shuffle partition, so that partitions come out even.
PARTS_PER_PARTITION = 4

LOWEST = -(2**63)


# Parts that the rows of an id are cut into if it fills a range of its own.
TIES = 256


def with_parts(docs: DataFrame, id_column: str = "doc_id", tie: Column | None = None) -> DataFrame:
    """Add ``order_id``, the id with null as the lowest, and ``part``, the number of its range.

    ``tie``, from 0 to ``TIES - 1``, cuts an id that fills whole ranges, such as null, into parts of
    its own, ordered by it; rows of one id have to be ordered by what ``tie`` is the beginning of.

    The bounds are quantiles of the ids, of which the driver gets one number per range; only the id
    column is read for them. Ranges hold about as many rows each, however the ids are spread.
    """
    spark = docs.sparkSession
    order_id = F.coalesce(F.col(id_column), F.lit(LOWEST))
    docs = docs.withColumn("order_id", order_id)
    rows = docs.agg(F.count("*")).first()[0]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(partitions * PARTS_PER_PARTITION, math.ceil(rows / ROWS_PER_PART))
    shares = [i / parts for i in range(1, parts)]
    accuracy = max(10_000, 20 * parts)
    quantiles = docs.agg(F.percentile_approx("order_id", shares, accuracy)).first()[0] or []
    bounds = sorted(set(quantiles))
    docs = docs.withColumn("part", _bounds_upto(F.col("order_id"), bounds))
    if tie is None:
        return docs
    # An id that is a bound more than once, or the lowest one, opens its range.
    full = sorted({b for b, times in Counter(quantiles).items() if times > 1} | set(bounds[:1]))
    opens = F.col("order_id").isin(full) if full else F.lit(False)
    inner = F.when(opens, tie.cast("int")).otherwise(TIES)
    return docs.withColumn("part", (F.col("part") * (TIES + 1) + inner).cast("int"))


def _bounds_upto(value: Column, bounds: list[int]) -> Column:
    """How many of some sorted bounds are at most ``value``, by binary search."""
    if not bounds:
        return F.lit(0)
    listed = F.lit(bounds).cast("array<bigint>")
    steps = F.lit([2**i for i in reversed(range(len(bounds).bit_length()))]).cast("array<int>")

    def search(low: Column, step: Column) -> Column:
        goal = low + step
        inside = goal <= len(bounds)
        reached = F.element_at(listed, F.least(goal, F.lit(len(bounds)))) <= value
        return F.when(inside & reached, goal).otherwise(low)

    return F.aggregate(steps, F.lit(0), search)
