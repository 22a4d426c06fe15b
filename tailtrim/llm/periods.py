"""Runs of words that repeat with a period, found on a grammar of the text.

A run is a longest stretch of words in which words ``q`` apart are equal, ``q`` its smallest period, with
at least ``LEAST_LENGTH`` words and ``LEAST_TIMES`` periods. Stretches of a text that may hold runs are
compressed by Re-Pair: the most frequent pair of neighbouring symbols becomes a symbol of its own, until no
pair occurs twice; what remains is joined in halves. Every word of such a stretch is then a leaf of a tree
whose inner nodes are few different symbols.

A run within a symbol either crosses the boundary between its two parts, or lies in one of them. So the
runs that cross the boundary are computed once for each symbol, at its first place: a run of four periods
holds two whole ones on one side of the boundary, so its period is that of a square that begins or ends
there. Squares are looked up by sums of hashes for all periods at once and confirmed word by word, and
extended as far as the symbol goes. What was found is moved to all places the symbol has in the
derivation, and intervals of one period that overlap by a period or more are merged: each run is whole at
the symbol that is just large enough for it.

Texts are cut before, at words that no run can hold. Any five neighbouring words of a run occur twice in
it, so a place where five words begin that occur there only once is in no run or ends it; what is left
between such places is cut again in the same way until nothing changes.

Documents are not shuffled and texts are looked at whole. Numpy works on batches of bounded bytes, and a
stretch costs about its length times the depth of its tree.

Defined results: a null text has no words and no run. Rows are kept as they are, repeated ones and null
ids too. An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailtrim.llm.common import SLICE_BYTES, WORD, columns_or_null, small_batches, table
from tailtrim.llm.shingles import mixed

LEAST_LENGTH = 6
LEAST_TIMES = 4
# Words of a window that occurs twice in every run: one word less than the shortest run.
WINDOW = LEAST_LENGTH - 1
# Places whose squares are looked up at once.
LOOKED_UP = 1 << 20

_STEPS = mixed(np.arange(1, WINDOW + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def least_length(period: int) -> int:
    return max(LEAST_LENGTH, LEAST_TIMES * period)


def stretches(ids: np.ndarray, rows: np.ndarray) -> list[tuple[int, int]]:
    """The intervals of words that may hold runs; ``rows`` says to which text a word belongs."""
    count = len(ids) - WINDOW + 1
    if count <= 0:
        return []
    windows = np.zeros(count, np.uint64)
    values = mixed(ids.astype(np.uint64) + np.uint64(1))
    for j in range(WINDOW):
        windows += values[j : j + count] * _STEPS[j]
    place = np.flatnonzero(rows[:count] == rows[WINDOW - 1 :])
    group = rows[place]
    while len(place):
        keys = mixed(windows[place] + mixed(group.astype(np.uint64) + np.uint64(7)))
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        repeated = np.zeros(len(place), bool)
        repeated[order[1:]] |= same
        repeated[order[:-1]] |= same
        before = len(place)
        place, group = place[repeated], group[repeated]
        if not len(place):
            return []
        starts = np.r_[True, (np.diff(place) > 1) | (np.diff(group) != 0)]
        group = np.cumsum(starts)
        # A run has as many windows as words beyond the window's, two at least.
        long = np.bincount(group)[group] > LEAST_LENGTH - WINDOW
        place, group = place[long], group[long]
        if len(place) == before:
            break
    firsts = np.flatnonzero(np.r_[True, np.diff(group) != 0]) if len(place) else np.zeros(0, int)
    lasts = np.r_[firsts[1:], len(place)] - 1 if len(place) else firsts
    return [(a, b + WINDOW) for a, b in zip(place[firsts].tolist(), place[lasts].tolist())]


class Grammar:
    """Rules ``symbol -> left, right`` of one stretch; symbols below ``words`` are its words."""

    def __init__(self, ids: list[int]) -> None:
        known: dict[int, int] = {}
        symbols = [known.setdefault(i, len(known)) for i in ids]
        self.words = len(known)
        self.rules: list[tuple[int, int]] = []
        rest = self._replace_pairs(symbols)
        self.root = self._halved(rest)
        self.lengths = [1] * self.words
        for left, right in self.rules:
            self.lengths.append(self.lengths[left] + self.lengths[right])

    def _add(self, left: int, right: int) -> int:
        self.rules.append((left, right))
        return self.words + len(self.rules) - 1

    def _replace_pairs(self, symbols: list[int]) -> list[int]:
        """Re-Pair: replace the most frequent pair until none occurs twice."""
        size = len(symbols)
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        places: dict[tuple[int, int], list[int]] = defaultdict(list)
        for i in range(size - 1):
            places[symbols[i], symbols[i + 1]].append(i)
        queue = [(-len(at), pair) for pair, at in places.items() if len(at) > 1]
        heapq.heapify(queue)
        while queue:
            count, pair = heapq.heappop(queue)
            at = places.get(pair)
            if at is None:
                continue
            left, right = pair
            # Places where the pair still stands, without overlaps such as the second one in "aaa".
            valid, end = [], -1
            for i in sorted(set(at)) if left == right else at:
                if symbols[i] == left and i >= end:
                    j = after[i]
                    if j < size and symbols[j] == right:
                        valid.append(i)
                        if left == right:
                            end = after[j]
            if len(valid) < -count:
                # Counted too high by now: back into the queue with what it is.
                if len(valid) > 1:
                    places[pair] = valid
                    heapq.heappush(queue, (-len(valid), pair))
                else:
                    del places[pair]
                continue
            del places[pair]
            new = self._add(left, right)
            touched = set()
            for i in valid:
                j = after[i]
                behind, ahead = before[i], after[j]
                symbols[i], symbols[j] = new, -1
                after[i] = ahead
                if ahead < size:
                    before[ahead] = i
                    made = (new, symbols[ahead])
                    places[made].append(i)
                    touched.add(made)
                if behind >= 0:
                    made = (symbols[behind], new)
                    places[made].append(behind)
                    touched.add(made)
            for made in touched:
                if len(places[made]) > 1:
                    heapq.heappush(queue, (-len(places[made]), made))
        rest, i = [], 0
        while i < size:
            rest.append(symbols[i])
            i = after[i]
        return rest

    def _halved(self, rest: list[int]) -> int:
        while len(rest) > 1:
            paired = [self._add(a, b) for a, b in zip(rest[::2], rest[1::2])]
            rest = paired + rest[len(paired) * 2 :]
        return rest[0]

    def places(self) -> list[np.ndarray]:
        """Where each symbol begins in the derivation, all of its places; the first one first."""
        found: list[list[np.ndarray]] = [[] for _ in self.lengths]
        found[self.root].append(np.zeros(1, np.int64))
        joined: list[np.ndarray] = [np.zeros(0, np.int64)] * len(self.lengths)
        # A symbol is made of older ones, so going back in age meets all uses before the symbol.
        for symbol in range(len(self.lengths) - 1, -1, -1):
            if not found[symbol] or self.lengths[symbol] < LEAST_LENGTH:
                continue
            own = joined[symbol] = np.concatenate(found[symbol])
            if symbol >= self.words:
                left, right = self.rules[symbol - self.words]
                found[left].append(own)
                found[right].append(own + self.lengths[left])
        return joined


def _squares(ids: np.ndarray, first: np.ndarray, middle: np.ndarray, last: np.ndarray) -> Iterator[tuple[int, int, bool]]:
    """``node, period, on the right`` of the squares that begin or end at the middle of a node.

    By sums of hashes: sums of powers tell apart all but a few unequal stretches, those are dropped when
    the words are compared.
    """
    power = np.full(len(ids) + 1, _BASE)
    power[0] = 1
    power = np.multiply.accumulate(power)
    sums = np.zeros(len(ids) + 1, np.uint64)
    np.cumsum(mixed(ids.astype(np.uint64) + np.uint64(1)) * power[:-1], out=sums[1:])
    sizes = np.concatenate([(last - middle) // 2, (middle - first) // 2])
    total = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        end = max(int(np.searchsorted(total, (total[begin - 1] if begin else 0) + LOOKED_UP, "right")), begin + 1)
        chosen = np.arange(begin, end)
        own = sizes[chosen]
        node = np.repeat(chosen, own)
        period = np.arange(len(node)) - np.repeat(np.cumsum(own) - own, own) + 1
        right = node < len(middle)
        node = node % len(middle)
        low = middle[node] - np.where(right, 0, 2 * period)
        mid, high = low + period, low + 2 * period
        equal = (sums[mid] - sums[low]) * power[period] == sums[high] - sums[mid]
        yield from zip(node[equal].tolist(), period[equal].tolist(), right[equal].tolist())
        begin = end


def _extended(ids: np.ndarray, low: int, high: int, period: int, first: int, last: int) -> tuple[int, int]:
    """How far the stretch from low to high goes on with its period, within a node."""
    size = 64
    while high < last:
        upto = min(high + size, last)
        differ = ids[high:upto] != ids[high - period : upto - period]
        at = int(differ.argmax())
        if differ[at]:
            high += at
            break
        high, size = upto, size * 4
    size = 64
    while low > first:
        downto = max(low - size, first)
        differ = (ids[downto:low] != ids[downto + period : low + period])[::-1]
        at = int(differ.argmax())
        if differ[at]:
            low -= at
            break
        low, size = downto, size * 4
    return low, high


def crossing_runs(ids: np.ndarray, grammar: Grammar, places: list[np.ndarray]) -> dict[int, set[tuple[int, int, int]]]:
    """For each symbol ``start, end, period`` of the runs across its boundary, from its own beginning."""
    symbols = [s for s in range(grammar.words, len(grammar.lengths)) if len(places[s])]
    if not symbols:
        return {}
    first = np.array([places[s][0] for s in symbols], np.int64)
    middle = first + np.array([grammar.lengths[grammar.rules[s - grammar.words][0]] for s in symbols])
    last = first + np.array([grammar.lengths[s] for s in symbols])
    found: dict[int, set[tuple[int, int, int]]] = defaultdict(set)
    at, done = None, []
    for node, period, right in _squares(ids, first, middle, last):
        if (node, right) != at:
            at, done = (node, right), []
        # Periods ascend: a square within a run whose period divides its own has a smaller one.
        if any(period % smaller == 0 and 2 * period <= reach for smaller, reach in done):
            continue
        mid, low_end, high_end = int(middle[node]), int(first[node]), int(last[node])
        low = mid if right else mid - 2 * period
        if not np.array_equal(ids[low : low + period], ids[low + period : low + 2 * period]):
            continue
        low, high = _extended(ids, low, low + 2 * period, period, low_end, high_end)
        done.append((period, high - mid if right else mid - low))
        if high - low >= least_length(period):
            found[symbols[node]].add((low - low_end, high - low_end, period))
    return found


def merged(intervals: set[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``start, end, period`` by start, then period: pieces of a run overlap by a period or more."""
    runs: list[list[int]] = []
    for period, start, end in sorted((p, a, b) for a, b, p in intervals):
        if runs and runs[-1][2] == period and start + period <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end, period])
    return sorted(((a, b, p) for a, b, p in runs), key=lambda run: (run[0], run[2]))


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """``start, end, period`` of the runs of one stretch."""
    grammar = Grammar(ids.tolist())
    places = grammar.places()
    intervals = set()
    for symbol, own in crossing_runs(ids, grammar, places).items():
        for at in places[symbol].tolist():
            intervals |= {(at + a, at + b, period) for a, b, period in own}
    return merged(intervals)


def runs_by_text(words: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each of some texts, given as lists of words."""
    numbers: dict[bytes, int] = {}
    counts = np.array([len(own) for own in words], np.int64)
    total = int(counts.sum())
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for own in words for w in own), np.int64, total)
    rows = np.repeat(np.arange(len(words)), counts)
    begins = np.cumsum(counts) - counts
    found: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for first, last in stretches(ids, rows):
        row = int(rows[first])
        base = first - int(begins[row])
        found[row] += [(base + a, base + b, period) for a, b, period in runs_of(ids[first:last])]
    return found


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words less those that a run holds after its first period."""
    kept, at = [], 0
    for start, end in sorted((start + period, end) for start, end, period in runs):
        if end > at:
            kept += words[at : max(start, at)]
            at = end
    return kept + words[at:]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``SLICE_BYTES`` of text; a longer row is one of its own."""
    sizes = np.array([0 if not t.is_valid else len(t.as_buffer()) for t in texts.cast(pa.large_binary())], np.int64)
    first, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > first and held + size > SLICE_BYTES:
            yield first, i
            first, held = i, 0
        held += size
    if len(sizes) > first:
        yield first, len(sizes)


_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def find_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row; runs by start, then period.

    ``collapsed`` is the text of the words that no run holds after its first period, joined by spaces.
    """
    small_batches(docs.sparkSession)
    docs = columns_or_null(docs, {"doc_id": "bigint", "text": "string"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
        for batch in batches:
            texts, doc_ids = batch.column("text"), batch.column("doc_id")
            for first, last in _slices(texts):
                # Fixed value: split() without arguments parts bytes at 20 and 09 to 0D, as words are.
                words = [(t.as_buffer().to_pybytes() if t.is_valid else b"").split() for t in texts[first:last]]
                runs = runs_by_text(words)
                listed = [[{"start": a, "length": b - a, "period": p} for a, b, p in own] for own in runs]
                texts_kept = [b" ".join(without_repeats(w, own)) for w, own in zip(words, runs)]
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids[first:last],
                        pa.array([len(w) for w in words], pa.int64()),
                        pa.array(listed, kind),
                        pa.array(texts_kept, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return docs.mapInArrow(run, f"doc_id bigint, n_words bigint, runs {_RUNS}, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Texts of ids whose CRC-32 ends in 0: from a word on, the text repeats with some period."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words, g = F.col("words"), F.floor(F.col("crc") / 10)
    n = F.size(words)
    chosen = docs.withColumn("crc", crc)
    planted = F.coalesce(F.col("crc") % 10 == 0, F.lit(False))
    chosen = chosen.withColumn("words", F.when(planted, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
    chosen = chosen.withColumn("a", F.when(n > 0, g % n).cast("int"))
    chosen = chosen.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    tail = F.transform(
        F.sequence(F.col("a"), n - 1),
        lambda i: F.element_at("words", F.col("a") + (i - F.col("a")) % F.col("p") + 1),
    )
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return chosen.select("doc_id", F.when(n > 0, text).otherwise(F.col("text")).alias("text"))


def op13_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = columns_or_null(table(spark, sf_dir, "documents"), {"doc_id": "bigint", "text": "string"})
    found = find_runs(with_planted_runs(docs))
    order = F.transform("runs", lambda r: F.struct(-r.length, r.start, r.period, r.length.alias("length")))
    best = F.array_min(order)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
