"""Language identification with averaged hashed subword embeddings.

A text's subwords are the runs of 2, 3 and 4 bytes of its lower-cased letters, with a space at word
ends; a run does not go beyond a word. Each is hashed to a row of an embedding table, the rows of a text
are averaged, and a linear softmax over the average gives a language. The model is trained in numpy by
stochastic gradient descent on a bounded sample of labelled rows, of which a fifth is set aside: on it,
a temperature makes scores honest, and the score is found below which an answer is rejected.

As averaging and the linear layer commute, prediction looks up one row of per-language scores for each
subword and averages those; a whole text costs a few table look-ups per byte.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and is rejected; so is
every text if nothing could be learned. Null labels are not learned from. ``rejected`` marks answers
less sure than the calibrated limit; ``lang_pred`` still names the best language. Text is the only
input of a prediction. An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailtrim.llm.common import columns_or_null, is_share, small_batches, table, text_slices

UNKNOWN = "und"
BUCKET_BITS = 15
DIMENSIONS = 16
# About so many rows are learned from for each language.
SAMPLE_PER_LANGUAGE = 1000
# A longer text is not learned from, so that the sample is bounded.
SAMPLE_BYTES = 100_000
# Steps of training, whatever the size of the sample.
STEPS = 400
BATCH = 48
RATE = 0.5
# Share of right answers wanted among those that are not rejected.
PRECISION = 0.995

_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)
_LETTERS[65:91] = np.arange(97, 123)


def subwords(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length, the bucket of every subword and the row it is in, in order of rows."""
    count = len(offsets) - 1
    # Every row is set between two spaces, so that its first and last word have ends.
    sizes = np.diff(offsets)
    padded = np.full(len(data) + 2 * count, 32, np.uint8)
    starts = offsets[:-1] + 2 * np.arange(count) + 1
    shift = np.repeat(starts - offsets[:-1], sizes)
    padded[np.arange(len(data)) + shift] = _LETTERS[data]
    rows = np.repeat(np.arange(count), sizes + 2)
    is_space = padded == 32
    codes = padded.astype(np.uint32)
    key = codes.copy()
    for length in (2, 3, 4):
        size = max(len(padded) - length + 1, 0)
        key = key[:size] | (codes[length - 1 : length - 1 + size] << np.uint32(8 * (length - 1)))
        # Spaces may stand at the ends only, and not at both.
        fits = ~(is_space[:size] & is_space[length - 1 : length - 1 + size])
        for inner in range(1, length - 1):
            fits &= ~is_space[inner : inner + size]
        chosen = np.flatnonzero(fits)
        hashed = (key[chosen] + np.uint32(length)) * np.uint32(0x9E3779B1)
        hashed ^= hashed >> np.uint32(15)
        hashed *= np.uint32(0x85EBCA77)
        yield (hashed >> np.uint32(32 - BUCKET_BITS)).astype(np.int64), rows[chosen]


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    # What each subword says for each language, and what is said before any.
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    least_score: float

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best language of each row, as a number, and its calibrated score."""
        count = len(offsets) - 1
        sums = np.zeros((count, len(self.languages)))
        seen = np.zeros(count)
        for buckets, rows in subwords(data, offsets):
            seen += np.bincount(rows, minlength=count)
            for k in range(len(self.languages)):
                sums[:, k] += np.bincount(rows, weights=self.scores[k][buckets], minlength=count)
        logits = sums / np.maximum(seen, 1)[:, None] + self.bias
        chances = _softmax(logits / self.temperature)
        best = chances.argmax(axis=1)
        return best, chances[np.arange(count), best]


def _softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def _sample(docs: DataFrame, per_language: int) -> list:
    """Subword counts of about ``per_language`` texts of each language, chosen by hash.

    Equal texts of a language are one line, however many rows have them.
    """
    usable = docs.filter(F.col("lang").isNotNull() & (F.octet_length("text") <= SAMPLE_BYTES) & F.col("text").rlike(r"\p{L}"))
    hashed = usable.withColumn("hash", F.xxhash64("text", F.lit("sample")))
    different = hashed.select("lang", "hash").distinct()
    counts = {r.lang: r.n for r in different.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, per_language / n)])
    draw = F.pmod("hash", F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = hashed.filter(draw < share[F.col("lang")])
    chosen = drawn.groupBy("lang", "hash").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch.column("text")):
                count = len(offsets) - 1
                found = list(subwords(data, offsets))
                buckets = np.concatenate([b for b, _ in found])
                owner = np.concatenate([r for _, r in found])
                pairs, times = np.unique(owner << BUCKET_BITS | buckets, return_counts=True)
                cuts = np.searchsorted(pairs >> BUCKET_BITS, np.arange(count + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("lang")[rows],
                        pa.ListArray.from_arrays(cuts, pa.array((pairs & ((1 << BUCKET_BITS) - 1)).astype(np.int32))),
                        pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int32))),
                    ],
                    ["lang", "buckets", "times"],
                )

    found = chosen.select("lang", "text").mapInArrow(run, "lang string, buckets array<int>, times array<int>")
    sampled = found.toArrow()
    lines = [
        (lang, np.array(b, np.int64), np.array(t, np.float64))
        for lang, b, t in zip(*[sampled.column(c).to_pylist() for c in ("lang", "buckets", "times")])
    ]
    # The order of arrival differs between runs; the order of training must not.
    return sorted((x for x in lines if len(x[1])), key=lambda x: (x[0], len(x[1]), x[1].tobytes(), x[2].tobytes()))


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel | None:
    """Learn from ``lang`` and ``text``; None if there is nothing to learn from.

    The driver holds the subword counts of about ``per_language`` different texts per language.
    """
    small_batches(docs.sparkSession)
    lines = _sample(columns_or_null(docs, {"lang": "string", "text": "string"}), per_language)
    if not lines:
        return None
    languages = sorted({lang for lang, _, _ in lines})
    number = {lang: i for i, lang in enumerate(languages)}
    labels = np.array([number[lang] for lang, _, _ in lines])
    weights = [t / t.sum() for _, _, t in lines]
    draw = np.random.default_rng(17)
    order = draw.permutation(len(lines))
    aside, learned = order[: len(order) // 5], order[len(order) // 5 :]
    table_rows = draw.normal(0, 0.1, (1 << BUCKET_BITS, DIMENSIONS))
    linear = np.zeros((DIMENSIONS, len(languages)))
    bias = np.zeros(len(languages))

    def averages(batch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        buckets = np.concatenate([lines[i][1] for i in batch])
        weight = np.concatenate([weights[i] for i in batch])
        sizes = np.array([len(lines[i][1]) for i in batch])
        starts = np.cumsum(sizes) - sizes
        return np.add.reduceat(table_rows[buckets] * weight[:, None], starts), buckets, weight, sizes

    shuffled = np.zeros(0, np.int64)
    for step in range(STEPS):
        if len(shuffled) < BATCH:
            shuffled = np.concatenate([shuffled, draw.permutation(learned)])
        batch, shuffled = shuffled[:BATCH], shuffled[BATCH:]
        hidden, buckets, weight, sizes = averages(batch)
        wrong = _softmax(hidden @ linear + bias)
        wrong[np.arange(len(batch)), labels[batch]] -= 1
        wrong /= len(batch)
        rate = RATE * (1 - step / STEPS)
        back = wrong @ linear.T
        # A row has a small share in the average of a long text, so rows take larger steps.
        change = np.repeat(back, sizes, axis=0) * weight[:, None]
        for k in range(DIMENSIONS):
            table_rows[:, k] -= rate * 100 * np.bincount(buckets, change[:, k], minlength=len(table_rows))
        linear -= rate * 10 * hidden.T @ wrong
        bias -= rate * wrong.sum(axis=0)
    if not len(aside):
        aside = learned
    logits = np.concatenate([averages(aside[i : i + 256])[0] for i in range(0, len(aside), 256)]) @ linear + bias
    temperature, least = _calibrate(logits, labels[aside])
    return LanguageModel(languages, np.ascontiguousarray((table_rows @ linear).T), bias, temperature, least)


def _calibrate(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """The temperature of least log loss, and the least score that keeps the precision."""
    tried = np.geomspace(0.05, 20, 61)
    rows = np.arange(len(labels))
    losses = [-np.log(np.maximum(_softmax(logits / t)[rows, labels], 1e-12)).mean() for t in tried]
    temperature = float(tried[int(np.argmin(losses))])
    chances = _softmax(logits / temperature)
    score, right = chances.max(axis=1), chances.argmax(axis=1) == labels
    order = np.argsort(-score, kind="stable")
    precise = np.cumsum(right[order]) / (rows + 1) >= PRECISION
    least = float(score[order][precise][-1]) if precise.any() else 1.0
    return temperature, min(least, 0.9)


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every whole text."""
    small_batches(docs.sparkSession)
    docs = columns_or_null(docs, {"doc_id": "bigint", "text": "string"})
    docs = docs.withColumn("has_letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch.column("text")):
                known = batch.column("has_letter")[rows].to_numpy(zero_copy_only=False) & (model is not None)
                names, score = np.full(len(known), UNKNOWN, object), np.zeros(len(known))
                if known.any():
                    best, sure = model.predict(data, offsets)
                    names[known] = np.array(model.languages, object)[best[known]]
                    score[known] = sure[known]
                limit = model.least_score if model else 1.0
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[rows], pa.array(names, pa.string()), pa.array(score), pa.array(~known | (score < limit))],
                    ["doc_id", "lang_pred", "score", "rejected"],
                )

    return docs.mapInArrow(run, "doc_id bigint, lang_pred string, score double, rejected boolean")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(~is_share("doc_id", 4, 2) & F.col("doc_id").isNotNull()))
    found = identify(docs, model)
    return found.select("doc_id", is_share("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "rejected")
