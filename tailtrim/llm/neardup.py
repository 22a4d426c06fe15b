"""Near-duplicate documents by SetSketch registers over word shingles.

Each document's set of shingles gets a SetSketch: for every shingle and register an exponential
variable, of which a register keeps the smallest, on a scale of exponentially spaced steps, cut off at
both ends. Shingles take their variables in ascending order and stop at the largest value a register
still holds, so a sketch costs about the set's size. Registers of two sets agree about as often as
their Jaccard similarity, and the sketch of a union is the register-wise maximum.

1. Sketch every text once; equal sets make a class, represented by the smallest id.
2. Bands of registers are bucket keys. Each member of a bucket is paired with the bucket's smallest
   id, never with all others.
3. A pair's similarity is estimated by joint likelihood from the registers where the first is larger,
   the second is larger, or both agree, with the known set sizes. Pairs clearly below the threshold
   go; the rest is confirmed on the full shingle sets of the two texts.
4. Links make components. Only a bucket whose members lie in more than one component can hide a
   further link; its members are compared, in blocks of a bounded number, across components only (those
   of the bucket's largest component with the others, never with each other), on sketches, and what passes is confirmed as in 3. So no link between different texts is lost but
   by the chance that no band of theirs agrees or that the estimate is far off, about one in a million
   and one in thirty thousand for a pair right at the threshold; a document has to lose all its links
   to leave its component.

Sizes of buckets are not capped; a large one is cut into blocks, and each pair of blocks is a piece of
work of its own. Nothing is collected to the driver.

Defined results: a null text, or one without words, has an empty set and is linked with nothing; a text
with fewer words than a shingle is one shingle. A null id is linked with nothing, is its own component
(null) and is kept. Rows with the same id count as one document. An empty table gives no rows. Further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tailtrim.llm.common import columns_or_null, saved, small_batches, table
from tailtrim.llm.components import components
from tailtrim.llm.shingles import mixed, sets_of_column

REGISTERS = 512
# Registers that go into bands; all of them go into estimates.
BAND_REGISTERS = 192
# Rate, base and limit of the registers as in the published description of SetSketch.
RATE = 20.0
BASE = 1.001
LIMIT = 65534
# Chance that a pair right at the threshold shares no band.
MISS = 1e-6
# Pairs are confirmed unless their estimate is so many standard deviations below the threshold.
DEVIATIONS = 4.0
# Members of a bucket that are compared with each other as one piece of work.
BLOCK = 512

_ODD = 0x9E3779B97F4A7C15
_GOLDEN = np.uint64(_ODD)


@dataclass(frozen=True)
class Settings:
    """Shingle length in words and the similarity, as a fraction, from which documents are linked."""

    words: int = 5
    above: int = 80
    of: int = 100
    registers: int = REGISTERS

    @property
    def threshold(self) -> float:
        return self.above / self.of

    @property
    def bands(self) -> tuple[int, int]:
        """Number of bands and registers in each: the longest bands that miss seldom enough.

        Not all registers take part, which keeps the number of keys per document down.
        """
        registers = min(BAND_REGISTERS, self.registers)
        for length in range(16, 0, -1):
            alike = self.threshold**length
            needed = 1 if alike >= 1 else math.ceil(math.log(MISS) / math.log1p(-alike))
            if needed * length <= registers:
                return needed, length
        return registers, 1

    @property
    def least_estimate(self) -> float:
        deviation = math.sqrt(self.threshold * (1 - self.threshold) / self.registers)
        return self.threshold - DEVIATIONS * deviation


def sketch(hashes: np.ndarray, rows: np.ndarray, count: int, registers: int) -> np.ndarray:
    """Registers of ``count`` sets, given their elements and the set each one is in.

    The registers an element visits are a walk over all of them from a hashed start in hashed odd
    steps; the spacing of its values makes each one exponential with the same rate. ``registers`` is a
    power of two.
    """
    lowest = np.full(count * registers, np.inf)
    walk = mixed(hashes + _GOLDEN)
    start = (walk & np.uint64(registers - 1)).astype(np.int64)
    step = ((walk >> np.uint64(20)) & np.uint64(registers - 1)).astype(np.int64) | 1
    value = np.zeros(len(hashes))
    bound = np.full(count, np.inf)
    for j in range(registers):
        drawn = mixed(hashes + np.uint64((j + 2) * _ODD % 2**64))
        uniform = ((drawn >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        value = value - np.log(uniform) / (RATE * (registers - j))
        alive = np.flatnonzero(value < bound[rows])
        if not len(alive):
            break
        if len(alive) < len(value):
            hashes, rows, start, step, value = (x[alive] for x in (hashes, rows, start, step, value))
        register = rows * registers + ((start + j * step) & (registers - 1))
        np.minimum.at(lowest, register, value)
        if j < 4 or j % 4 == 0:
            bound = lowest.reshape(count, registers).max(axis=1)
    with np.errstate(divide="ignore"):
        steps = np.floor(1.0 - np.log(lowest) / math.log(BASE))
    return np.clip(steps, 0, LIMIT + 1).astype(np.uint16).reshape(count, registers)


def band_keys(sketches: np.ndarray, settings: Settings) -> np.ndarray:
    """One key per band; the number of the band is its low byte."""
    bands, length = settings.bands
    values = sketches[:, : bands * length].reshape(len(sketches), bands, length).astype(np.uint64)
    keys = np.zeros((len(sketches), bands), np.uint64)
    for j in range(length):
        keys = mixed(keys * np.uint64(31) + values[:, :, j] + _GOLDEN)
    return ((keys & ~np.uint64(0xFF)) | np.arange(bands, dtype=np.uint64)).view(np.int64)


def likely_similarity(
    first: np.ndarray, second: np.ndarray, first_size: np.ndarray, second_size: np.ndarray
) -> np.ndarray:
    """Jaccard similarity of pairs of sketched sets of known sizes, by joint maximum likelihood."""
    larger = (first > second).sum(axis=1)[:, None]
    smaller = (first < second).sum(axis=1)[:, None]
    equal = first.shape[1] - larger - smaller
    u = (first_size / (first_size + second_size))[:, None]
    v = 1.0 - u
    # A grid of a hundred steps up to the largest similarity the sizes allow.
    grid = np.linspace(0.0, 1.0, 101)[None, :] * np.minimum(u / v, v / u)

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / math.log(BASE)

    is_larger, is_smaller = chance(u - v * grid), chance(v - u * grid)
    tiny = 1e-12
    likelihood = (
        larger * np.log(np.maximum(is_larger, tiny))
        + smaller * np.log(np.maximum(is_smaller, tiny))
        + equal * np.log(np.maximum(1 - is_larger - is_smaller, tiny))
    )
    return np.take_along_axis(grid, likelihood.argmax(axis=1)[:, None], axis=1)[:, 0]


def _sketched(docs: DataFrame, settings: Settings) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for rows, sets in sets_of_column(batch.column("text"), settings.words):
                sizes = np.array([len(s) for s in sets], np.int64)
                flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                owner = np.repeat(np.arange(len(sets)), sizes)
                sketches = sketch(flat, owner, len(sets), settings.registers)
                keys = band_keys(sketches, settings)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                width = settings.registers * 2
                starts = np.arange(len(sets) + 1, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids[rows],
                        pa.array(sizes),
                        pa.array(digests, pa.binary()),
                        pa.ListArray.from_arrays(starts * keys.shape[1], pa.array(keys.ravel())),
                        pa.Array.from_buffers(
                            pa.binary(),
                            len(sets),
                            [None, pa.py_buffer(starts * width), pa.py_buffer(sketches.tobytes())],
                        ),
                    ],
                    ["doc_id", "n_shingles", "digest", "bands", "sketch"],
                )

    schema = "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>, sketch binary"
    return docs.mapInArrow(run, schema)


def _registers(column: pa.Array, registers: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), registers)


def _confirmed(pairs: DataFrame, sketched: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """The pairs ``a, b`` that are linked: plausible by their sketches, then by their full sets.

    Pairs and ids grow with the corpus, so these joins always shuffle and merge, at any size.
    """

    def plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sizes = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
                alike = likely_similarity(
                    *[_registers(batch.column(c), settings.registers) for c in ("s_a", "s_b")], *sizes
                )
                keep = pa.array(alike >= settings.least_estimate)
                yield batch.select(["a", "b"]).filter(keep)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            texts = pa.concat_arrays([batch.column("t_a"), batch.column("t_b")])
            order = np.arange(len(texts)).reshape(2, -1).T.ravel()
            for rows, sets in sets_of_column(texts.take(pa.array(order)), settings.words):
                # Both texts of a pair stand side by side; a slice may end between them.
                for i, found in enumerate(sets, rows.start):
                    if i % 2 == 0:
                        first = found
                    else:
                        keep[i // 2] = _is_link(first, found, settings)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    prints = sketched.select("doc_id", "n_shingles", "sketch")
    sizes_fit = F.least("n_a", "n_b") * settings.of >= F.greatest("n_a", "n_b") * settings.above
    likely = (
        pairs.hint("merge").join(prints.toDF("a", "n_a", "s_a"), "a")
        .hint("merge").join(prints.toDF("b", "n_b", "s_b"), "b")
        .filter(sizes_fit)
        .mapInArrow(plausible, "a bigint, b bigint")
    )
    likely = saved(likely, "likely")
    # One shuffle of the texts, to those that take part; their pairs are then joined from these few.
    firsts, seconds = likely.select(F.col("a").alias("doc_id")), likely.select(F.col("b").alias("doc_id"))
    ids = firsts.distinct().unionAll(seconds.distinct()).distinct()
    texts = saved(docs.join(ids.hint("merge"), "doc_id", "left_semi").select("doc_id", "text"), "texts")
    both = likely.hint("merge").join(texts.toDF("a", "t_a"), "a").hint("merge").join(texts.toDF("b", "t_b"), "b")
    return saved(both.mapInArrow(exact, "a bigint, b bigint"), "links")


def _is_link(first: np.ndarray, second: np.ndarray, settings: Settings) -> bool:
    shared = len(np.intersect1d(first, second, assume_unique=True))
    union = len(first) + len(second) - shared
    return union > 0 and settings.of * shared >= settings.above * union


def _hidden_pairs(buckets: DataFrame, groups: DataFrame, sketched: DataFrame, settings: Settings) -> DataFrame:
    """Plausible pairs ``a, b`` of buckets whose members lie in several components."""
    member = buckets.join(groups.withColumnRenamed("component", "_c"), "id", "left").select(
        "key", "id", F.coalesce("_c", "id").alias("component")
    )
    parts = member.groupBy("key", "component").agg(F.count("*").alias("n"))
    mixed_keys = (
        parts.groupBy("key")
        .agg(F.sum("n").alias("size"), F.max(F.struct("n", "component")).alias("main"), F.count("*").alias("parts"))
        .filter((F.col("parts") > 1) & (F.col("size") > 2))
        .select(
            "key", F.col("main.component").alias("main"),
            F.ceil(F.col("main.n") / BLOCK).cast("int").alias("mains"),
            F.ceil((F.col("size") - F.col("main.n")) / BLOCK).cast("int").alias("others"),
        )
    )
    # Members of the bucket's largest component meet the others only, not each other: blocks below
    # ``mains`` are theirs, and a bucket of one large group and a few more costs its size, not its square.
    is_main = F.col("component") == F.col("main")
    hashed = F.xxhash64("id")
    block = F.when(is_main, F.pmod(hashed, F.col("mains"))).otherwise(F.col("mains") + F.pmod(hashed, F.col("others"))).cast("int")
    first = F.when(is_main, F.col("mains")).otherwise(F.lit(0))
    other = F.explode(F.sequence(first, F.col("mains") + F.col("others") - 1))
    placed = (
        member.join(mixed_keys, "key")
        .select("key", "id", "component", block.alias("block"), other.alias("other"))
        .select("key", "id", "component", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    )
    prints = sketched.select(F.col("doc_id").alias("id"), "n_shingles", "sketch")
    cells = placed.join(prints, "id").repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    bands, length = settings.bands
    least = settings.least_estimate

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches):
            ids, component, size, block = (
                cell.column(c).to_numpy() for c in ("id", "component", "n_shingles", "block")
            )
            registers = _registers(cell.column("sketch").combine_chunks(), settings.registers)
            band = int(cell.column("key")[0].as_py()) & 0xFF
            off_diagonal = cell.column("low")[0].as_py() != cell.column("high")[0].as_py()
            for i in range(len(ids)):
                rest = np.arange(i + 1, len(ids))
                fits = component[rest] != component[i]
                fits &= np.minimum(size[rest], size[i]) * settings.of >= np.maximum(size[rest], size[i]) * settings.above
                if off_diagonal:
                    fits &= block[rest] != block[i]
                rest = rest[fits]
                if not len(rest):
                    continue
                equal = registers[rest] == registers[i]
                rest, equal = (x[equal.mean(axis=1) >= least - 0.05] for x in (rest, equal))
                # A pair that meets in several buckets is reported by the first of them.
                first = equal[:, : bands * length].reshape(-1, bands, length).all(axis=2).argmax(axis=1)
                rest = rest[first == band]
                if not len(rest):
                    continue
                own = np.broadcast_to(registers[i], (len(rest), settings.registers))
                alike = likely_similarity(own, registers[rest], np.full(len(rest), size[i]), size[rest])
                rest = rest[alike >= least]
                pair = np.stack([np.full(len(rest), ids[i]), ids[rest]])
                yield pa.RecordBatch.from_arrays([pa.array(pair.min(axis=0)), pa.array(pair.max(axis=0))], ["a", "b"])

    return cells.mapInArrow(compare, "a bigint, b bigint")


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows with equal ``key, low, high`` in sorted batches."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("key", "low", "high")], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        edges = [0, *cuts.tolist(), len(keys)]
        for first, last in zip(edges[:-1], edges[1:]):
            if first == last:
                continue
            key = tuple(keys[first].tolist())
            if held and key != current:
                yield pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(first, last - first))
    if held:
        yield pa.Table.from_batches(held)


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = columns_or_null(docs, {"doc_id": "bigint", "text": "string"})
    sketched = saved(_sketched(docs, settings), "sketches")
    linkable = sketched.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = saved(linkable.groupBy("digest").agg(F.min("doc_id").alias("id")), "classes")
    representatives = sketched.join(classes.select("id"), sketched.doc_id == F.col("id"), "left_semi")
    # From here on one line per class: its smallest id stands for it.
    keyed = representatives.select(F.col("doc_id").alias("id"), F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("size")).filter("size > 1")
    buckets = saved(keyed.join(shared.select("key", "hub"), "key"), "buckets")
    pairs = buckets.filter("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    links = _confirmed(pairs, linkable, docs, settings)
    groups = components(links)
    hidden = saved(_hidden_pairs(buckets, groups, linkable, settings), "hidden")
    if not hidden.isEmpty():
        links = links.unionAll(_confirmed(hidden, linkable, docs, settings))
        groups = components(links)
    named = classes.join(groups, "id", "left").select(
        "digest", F.coalesce("component", "id").alias("_component")
    )
    return sketched.join(named, "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.coalesce("_component", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row of each group of near copies, with all columns, and all rows without an id.

    The row with the smallest id stays; of different texts with that id, the one of the smallest hash. A
    row goes only for a link: rows that share an id and nothing else all stay, but for equal rows, of
    which one does.
    """
    rows = docs.select(
        F.struct("*").alias("_row"), F.col("doc_id").cast("bigint").alias("_id"), F.col("text").cast("string").alias("_text")
    ).filter("_id IS NOT NULL")
    texts = rows.select("_id", F.xxhash64(F.coalesce("_text", F.lit("")), F.col("_text").isNull()).alias("_hash"))
    spread = texts.groupBy("_id").agg(F.min("_hash").alias("low"), F.max("_hash").alias("high"))
    repeated = saved(spread.filter("low <> high").select(F.col("_id").alias("_twice")), "repeated")
    if repeated.isEmpty():
        keyed = rows.withColumn("_key", F.col("_id"))
    else:
        # A row of such an id gets a key of its own, made of id and text.
        own = F.xxhash64("_id", "_text", F.col("_text").isNull())
        keyed = rows.join(repeated, F.col("_id") == F.col("_twice"), "left")
        keyed = saved(keyed.withColumn("_key", F.when(F.col("_twice").isNull(), F.col("_id")).otherwise(own)).drop("_twice"), "keyed")
    named = near_duplicates(keyed.select(F.col("_key").alias("doc_id"), F.col("_text").alias("text")), settings)
    if repeated.isEmpty():
        chosen = named.filter("kept")
    else:
        # Keys do not ascend like ids, so the first of a component is looked for by id.
        ids = keyed.select(F.col("_key").alias("doc_id"), "_id").distinct()
        first = F.min(F.struct("_id", "doc_id")).alias("first")
        chosen = named.join(ids.hint("merge"), "doc_id").groupBy("component_id").agg(first).select("first.doc_id")
    chosen = chosen.select(F.col("doc_id").alias("_kept")).distinct()
    # The keys are as many as the documents kept, so the join always shuffles.
    kept = keyed.join(chosen.hint("merge"), F.col("_key") == F.col("_kept"), "left_semi")
    order = Window.partitionBy("_key").orderBy("_id")
    one = kept.withColumn("_number", F.row_number().over(order)).filter("_number = 1").select("_row.*")
    return one.unionAll(docs.filter(F.col("doc_id").cast("bigint").isNull()))


OP3_SETTINGS = Settings(words=3, above=85, of=100)


def op3_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), OP3_SETTINGS)
