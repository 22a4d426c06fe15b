"""Benchmark decontamination: find test items in documents although up to some characters differ.

Texts and items are lower-cased and their white space is made one space. An item may differ by as many
edits (characters put in, left out or changed) as its error budget, a share of its length. It is cut
into one piece more than that: by the pigeonhole principle at least one piece then stands unchanged in
every such copy. All pieces are searched at once (Aho-Corasick), and around each hit the whole item is
compared by edit distance, a bit vector per character (Myers).

Items are read in blocks of bounded size, so any number of items can be searched; every document is
compared with every block. Documents are not shuffled.

Defined results: a null or empty text holds nothing; null and empty items, and equal ones beyond the
first, match nothing (an equal item is reported under the smallest id). An item too short for an edit
is found only unchanged. An empty table gives no rows, an empty benchmark finds nothing; further
columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailtrim.llm.common import columns_or_null, saved, small_batches, table

# Edits allowed for each character of an item.
ERROR_RATE = 0.05
# Items that are searched in one pass over the documents, in bytes of text.
BLOCK_BYTES = 8 * 1024 * 1024

_FOUND = "array<struct<item_id:bigint,distance:int,start:bigint,end:bigint>>"


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


class Item:
    """An item, its pieces, and the bit masks of its characters."""

    def __init__(self, item_id: int, text: str, error_rate: float) -> None:
        self.item_id, self.text = item_id, text
        self.budget = math.floor(len(text) * error_rate)
        count = self.budget + 1
        bounds = [len(text) * i // count for i in range(count + 1)]
        self.pieces = [(first, text[first:last]) for first, last in zip(bounds, bounds[1:])]
        self.masks: dict[str, int] = defaultdict(int)
        for i, letter in enumerate(text):
            self.masks[letter] |= 1 << i
        self.masks.default_factory = None

    def ends(self, window: str) -> list[tuple[int, int]]:
        """Where in a window a copy within the budget ends, and its distance."""
        size = len(self.text)
        every, last = (1 << size) - 1, 1 << (size - 1)
        plus, minus, distance = every, 0, size
        found = []
        for place, letter in enumerate(window):
            equal = self.masks.get(letter, 0)
            across = (((equal & plus) + plus) ^ plus) | equal
            down = equal | minus
            horizontal_plus = minus | (~(across | plus) & every)
            horizontal_minus = plus & across
            if horizontal_plus & last:
                distance += 1
            elif horizontal_minus & last:
                distance -= 1
            horizontal_plus = (horizontal_plus << 1) & every
            horizontal_minus = (horizontal_minus << 1) & every
            plus = horizontal_minus | (~(down | horizontal_plus) & every)
            minus = horizontal_plus & down
            if distance <= self.budget:
                found.append((distance, place + 1))
        return found


class Matcher:
    """All items of a block."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float) -> None:
        import ahocorasick

        self.items = [Item(item_id, text, error_rate) for item_id, text in items]
        owners: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, item in enumerate(self.items):
            for first, piece in item.pieces:
                owners[piece].append((i, first))
        self.automaton = ahocorasick.Automaton()
        for piece, where in owners.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def __call__(self, text: str) -> dict[int, tuple[int, int, int]]:
        """For each item in a normal text: the least distance, and the span of a copy that has it."""
        tried: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for end, (length, where) in self.automaton.iter(text):
            for i, offset in where:
                tried[i].append((end + 1 - length - offset, length))
        best = {}
        for i, begins in tried.items():
            item = self.items[i]
            exact = text.find(item.text)
            if exact >= 0:
                best[item.item_id] = (0, exact, exact + len(item.text))
                continue
            for low, high in _merged(sorted({b for b, _ in begins}), item.budget):
                low = max(low - item.budget, 0)
                window = text[low : high + len(item.text) + item.budget]
                for distance, place in item.ends(window):
                    end = low + place
                    found = (distance, max(end - len(item.text), 0), end)
                    if item.item_id not in best or found < best[item.item_id]:
                        best[item.item_id] = found
        return best


def _merged(begins: list[int], budget: int) -> list[tuple[int, int]]:
    """Places that are close together share a window."""
    runs = [[begins[0], begins[0]]]
    for begin in begins[1:]:
        if begin - runs[-1][1] <= 2 * budget + 1:
            runs[-1][1] = begin
        else:
            runs.append([begin, begin])
    return [(low, high) for low, high in runs]


def _normal_items(items: DataFrame) -> DataFrame:
    """``item_id, text`` of the different normal texts of the items, each with its smallest id."""
    items = columns_or_null(items, {"item_id": "bigint", "text": "string"}).filter("item_id IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [normal(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(texts, pa.string())], ["item_id", "text"])

    normals = items.mapInArrow(run, "item_id bigint, text string").filter("text <> ''")
    return normals.groupBy("text").agg(F.min("item_id").alias("item_id"))


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The different normal items, in blocks of about ``block_bytes``; the driver holds one block.

    Equal items are merged before blocks are cut, and the blocks are written once, one folder for each.
    """
    merged = saved(_normal_items(items), "items")
    total = merged.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / block_bytes))
    if blocks > 1:
        numbered = merged.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(blocks)).cast("int"))
        merged = saved(numbered.repartition("block"), "blocks", partition_by=["block"])
    for block in range(blocks):
        rows = merged.filter(F.col("block") == block) if blocks > 1 else merged
        yield sorted((row.item_id, row.text) for row in rows.collect())


def find_items(
    docs: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One line per row of ``docs``: ``row``, all its columns, and ``found``, sorted by item.

    Spans are in code points of the normal text; for a copy with edits the end is exact and the start
    is the end less the item's length. If items come in several blocks, the lines are written to the
    shared folder between them, so that a task holds one block.
    """
    small_batches(docs.sparkSession)
    columns_or_null(docs, {"doc_id": "bigint", "text": "string"})
    lines = docs.select(F.struct("*").alias("row"), F.array().cast(_FOUND).alias("found"))
    for number, block in enumerate(item_blocks(items, block_bytes)):
        if block:
            lines = _search(saved(lines, "searched") if number else lines, block, error_rate)
    return lines


def _search(lines: DataFrame, block: list[tuple[int, str]], error_rate: float) -> DataFrame:
    schema = lines.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(block, error_rate)
        names = ("item_id", "distance", "start", "end")
        for batch in batches:
            all_found = []
            for text, found in zip(batch.column("text"), batch.column("found").to_pylist()):
                new = [dict(zip(names, (i, *span))) for i, span in matcher(normal(text.as_py())).items()]
                all_found.append(sorted(found + new, key=lambda one: one["item_id"]))
            kinds = zip(names, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(all_found, pa.list_(pa.struct(list(kinds))))], ["row", "found"]
            )

    texts = F.col("row").getField("text").cast("string").alias("text")
    return lines.select("row", "found", texts).mapInArrow(run, schema)


def without_items(docs: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    return find_items(docs, items, error_rate).filter(F.size("found") == 0).select("row.*")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("row").getField("doc_id").cast("bigint").alias("doc_id"),
        (F.size("found") > 0).alias("contaminated"),
        F.transform("found", lambda one: one["item_id"]).alias("item_ids"),
        F.transform("found", lambda one: one["distance"]).alias("distances"),
        F.transform("found", lambda one: one["start"]).alias("starts"),
        F.transform("found", lambda one: one["end"]).alias("ends"),
    )
