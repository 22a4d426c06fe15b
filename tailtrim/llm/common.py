"""What the operators of this subpackage share: tables, saved steps, batches of text, prefix sums."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rows that Spark hands to Python at once; texts of a batch are further cut by SLICE_BYTES.
BATCH_ROWS = 2000
BATCH_BYTES = 32 * 1024 * 1024
SLICE_BYTES = 2 * 1024 * 1024

# The characters that part words, and the pattern of a word.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"

_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
    "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the rows and bytes of a batch that a Python worker holds."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return named.rstrip("/")


def saved(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a step to the shared folder and go on from the written table.

    This cuts the lineage: what is written survives lost executors, and is computed once.
    """
    path = f"{shared_folder(df.sparkSession)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def columns_or_null(df: DataFrame, needed: dict[str, str]) -> DataFrame:
    """The needed columns, cast; other columns are left out, missing ones are an error."""
    try:
        return df.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in needed.items()])
    except AnalysisException as error:
        raise ValueError(f"the table must have the columns {', '.join(needed)}") from error


def is_share(column: str, parts: int, remainder: int) -> Column:
    """True where crc32 of a column as text leaves this remainder; false for a null."""
    crc = F.crc32(F.col(column).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(parts)) == remainder, F.lit(False))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column of texts and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_slices(
    column: pa.Array, most: int = SLICE_BYTES
) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``most`` bytes of text: the rows, their bytes, their offsets.

    A row is never cut; one that is longer makes a slice of its own.
    """
    data, offsets = text_buffer(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), rows)
        start = offsets[first]
        yield slice(first, last), data[start : offsets[last]], offsets[first : last + 1] - start
        first = last


def running_totals(
    df: DataFrame, amounts: Sequence[str], group: Sequence[str], part: str, order: Sequence[Column],
    with_total: bool = False,
) -> DataFrame:
    """Add ``<amount>_before``: the sum over the rows before this one in its group.

    ``with_total`` adds ``<amount>_total``, the sum over the whole group.

    Rows of a group are ordered by ``part``, then by ``order``; group and part hold no nulls. One
    window runs over the rows of a part only, another over one line per part, so that a group of
    any size is spread over tasks.
    """
    keys = [*group, part]
    totals = df.groupBy(*keys).agg(*[F.sum(a).alias(f"_{a}_base") for a in amounts])
    over = Window.partitionBy(*(group or [F.lit(0)])).orderBy(part)
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select(
        *keys,
        *[F.coalesce(F.sum(f"_{a}_base").over(before), F.lit(0)).alias(f"_{a}_base") for a in amounts],
        *[F.sum(f"_{a}_base").over(whole).alias(f"{a}_total") for a in amounts if with_total],
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = df.withColumns(
        {f"_{a}_in": F.coalesce(F.sum(a).over(inside), F.lit(0)) for a in amounts}
    )
    sums = {f"{a}_before": F.col(f"_{a}_base") + F.col(f"_{a}_in") for a in amounts}
    own = [f"_{a}_{kind}" for a in amounts for kind in ("base", "in")]
    return ranked.join(totals, keys).withColumns(sums).drop(*own)


def drawn_texts(docs: DataFrame, most: int, seed: str) -> DataFrame:
    """At most ``most`` distinct texts of the column ``text``, as one column, those of lowest hash.

    Equal texts are drawn once, however many rows have them; texts of one hash, which are most
    likely equal, are drawn as one. The driver gets one hash.
    """
    drawn = docs.filter("text is not null").withColumn("_draw", F.xxhash64("text", F.lit(seed)))
    lowest = drawn.select("_draw").distinct().orderBy("_draw").limit(most)
    last = lowest.agg(F.max("_draw")).first()[0]
    chosen = drawn.filter(F.col("_draw") <= F.lit(last if last is not None else 0))
    return chosen.groupBy("_draw").agg(F.min("text").alias("text")).select("text")
