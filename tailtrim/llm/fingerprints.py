"""Document fingerprints by winnowing.

Every run of ``gram`` code points gets a rolling hash. Of every ``window`` consecutive hashes the
smallest is chosen, of equal ones the rightmost; a hash chosen by several windows counts once. Two
texts that share ``gram + window - 1`` code points in a row share a window, and so a fingerprint, and
the kept positions tell where. With the gram and window below these are 23 code points, a few words.
A text shorter than a gram is one gram, one with fewer grams than a window is one window; of two such
short texts a shared run may go unseen.

:func:`winnow` is the operator on one text; :func:`fingerprints` applies it to a table. The query also
fingerprints an edited text, half of it taken from the next document; rows are dealt into ranges of
ids for it, sorted in each, and the first row of the next range is sent along, so every text is
shuffled once and no task holds more than a batch and two documents.

Defined results: a null or empty text has no hashes and the empty fingerprint; two empty fingerprints
are alike (1), an empty and another one are not (0). Rows are ordered by descending id, null last,
then by a hash of the text; of equal rows it does not matter which is next. A single row is its own
next. An empty table gives no rows, further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tailtrim.llm.common import columns_or_null, saved, small_batches, table
from tailtrim.llm.ranges import with_parts
from tailtrim.llm.shingles import mixed

GRAM = 8
WINDOW = 16
HASH_BITS = 40
PIECE = 1 << 18

_BASE = 0xD6E8FEB86659FD93
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: int) -> np.ndarray:
    factors = np.full(PIECE + 4096, base, np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


_POWER, _INVERSE = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def _gram_hashes(points: np.ndarray, gram: int) -> np.ndarray:
    sums = np.zeros(len(points) + 1, np.uint64)
    values = mixed(points.astype(np.uint64) + _GOLDEN)
    np.cumsum(values * _POWER[: len(points)], out=sums[1:])
    count = len(points) - gram + 1
    return mixed((sums[gram:] - sums[:count]) * _INVERSE[:count]) >> np.uint64(64 - HASH_BITS)


def _window_minima(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions of the smallest hash of each window, the rightmost of equal ones, each once."""
    places = np.arange(len(hashes), dtype=np.uint64)
    last = np.uint64((1 << 24) - 1)
    lowest = (hashes << np.uint64(24)) | (last - places)
    # The minimum over a window is the minimum of two overlapping windows of half the size or more.
    width = 1
    while width < window:
        reach = min(width, window - width)
        lowest = np.minimum(lowest[:-reach], lowest[reach:])
        width += reach
    return np.unique(last - (lowest & last)).astype(np.int64)


def winnow(text: str | None, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The chosen hashes of a text and their positions in code points, in ascending order."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    gram = min(gram, len(points))
    grams = len(points) - gram + 1
    window = min(window, grams)
    hashes, places = [], []
    # A long text is cut into pieces that overlap by a window, so that no window is lost.
    for first in range(0, grams - window + 1, PIECE):
        last = min(first + PIECE + window - 1, grams)
        part = _gram_hashes(points[first : last + gram - 1], gram)
        chosen = _window_minima(part, window)
        hashes.append(part[chosen])
        places.append(chosen + first)
    at, once = np.unique(np.concatenate(places), return_index=True)
    return np.concatenate(hashes)[once], at


def as_text(hashes: np.ndarray) -> str:
    """The distinct hashes of a fingerprint as one string: five bytes each, ascending, in base 64."""
    wide = np.unique(hashes).astype(">u8").view(np.uint8).reshape(-1, 8)
    return base64.b64encode(wide[:, 8 - HASH_BITS // 8 :].tobytes()).decode()


def likeness(first: np.ndarray, second: np.ndarray) -> float:
    """Share of the distinct hashes of two fingerprints that both have."""
    first, second = np.unique(first), np.unique(second)
    if not len(first) and not len(second):
        return 1.0
    shared = len(np.intersect1d(first, second, assume_unique=True))
    return shared / (len(first) + len(second) - shared)


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``doc_id, hashes, positions`` of every row: the chosen hashes and where they are."""
    small_batches(docs.sparkSession)
    docs = columns_or_null(docs, {"doc_id": "bigint", "text": "string"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [winnow(text.as_py(), gram, window) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([h.astype(np.int64) for h, _ in found], pa.list_(pa.int64())),
                    pa.array([p for _, p in found], pa.list_(pa.int64())),
                ],
                ["doc_id", "hashes", "positions"],
            )

    return docs.mapInArrow(run, "doc_id bigint, hashes array<bigint>, positions array<bigint>")


def with_next(docs: DataFrame) -> DataFrame:
    """Rows in descending order of ids within each partition, with ``is_next`` rows between ranges.

    A row with ``is_next`` is a copy of the row that follows the range, for its last row to see.
    """
    parts = with_parts(docs)
    tops = parts.groupBy("part").agg(F.max("order_id").alias("top"))
    # One line per range: the range whose last row is followed by this one's first.
    descending = Window.partitionBy(F.lit(0)).orderBy(F.desc("part"))
    whole = descending.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("part").over(descending), F.last("part").over(whole))
    # As many lines as ranges, which is one for each ROWS_PER_PART rows.
    sent = saved(tops.select("top", before.alias("before")), "tops")
    both = parts.join(F.broadcast(sent), F.col("order_id") == F.col("top"), "left")
    copies = F.array(
        F.struct("part", F.lit(False).alias("is_next")),
        F.struct(F.col("before").alias("part"), F.lit(True).alias("is_next")),
    )
    placed = both.select(
        "doc_id", "text", "order_id", F.explode(F.filter(copies, lambda c: c["part"].isNotNull())).alias("at")
    ).select("doc_id", "text", "order_id", "at.part", "at.is_next")
    return placed.repartition("part").sortWithinPartitions(
        "part", "is_next", F.desc("order_id"), F.xxhash64("text")
    )


_RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def edited_fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Fingerprints of each document, of its edited text, and how alike they are."""
    small_batches(docs.sparkSession)
    rows = with_next(columns_or_null(docs, {"doc_id": "bigint", "text": "string"}))

    def line(own: tuple, following: tuple) -> tuple:
        doc_id, text, hashes = own
        half = len(text) // 2
        edited = text[: len(text) - half] + following[1][:half]
        edited_hashes = winnow(edited, gram, window)[0]
        return (
            doc_id,
            len(text),
            hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            as_text(hashes),
            as_text(edited_hashes),
            likeness(hashes, edited_hashes),
            likeness(hashes, following[2]),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, None
        names = ["doc_id", "text", "part", "is_next"]
        for batch in batches:
            lines = []
            for doc_id, text, at, is_next in zip(*[batch.column(n).to_pylist() for n in names]):
                if at != part:
                    part, held = at, None
                elif held is None:
                    continue
                text = text or ""
                current = (doc_id, text, winnow(text, gram, window)[0])
                if held is not None:
                    lines.append(line(held, current))
                # Only the first row after the range is needed; more may have the same id.
                held = None if is_next else current
            columns = list(zip(*lines)) if lines else [[]] * 7
            schema = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, schema)],
                [f.split()[0] for f in _RESULT.split(", ")],
            )

    return rows.mapInArrow(run, _RESULT)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))
