"""Secrets in texts: patterns, and Markov models of random strings against ordinary identifiers.

Patterns find what announces itself: an assignment to a name such as ``token``, an access key's prefix,
long hexadecimal numbers. Beyond them, every run of key characters is a candidate. One first-order
Markov model of characters for each kind of random string, and one of ordinary identifiers, give its
likelihoods; it is a secret if the best random model wins by ``LEAST_RATIO`` in log-likelihood.

The models are trained from labelled samples, ``value, label``: label ``ordinary``, or the name of a
kind of random string. :func:`labelled_samples` takes them from a corpus: what a pattern found is
labelled by its kind, every other run of at least ``LEAST_WORD`` key characters is ordinary, and so are
two neighbouring ones joined with a capital, and each in capitals. Corpora have few secrets and of few kinds, so random strings
over the usual alphabets, drawn with a fixed seed, are added (``GENERATED`` for each alphabet), and
numbers to the ordinary ones. Only counts of character pairs are kept, a table of fixed size for each
label, whatever the samples. Separators such as ``_`` say nothing, nor does what follows them.

Bounds: the samples of a corpus come from ``SAMPLE_TEXTS`` distinct texts of lowest hash, whole. Every
text is scanned whole. Offsets are code points, the end exclusive.

Defined results: a null or empty text has no spans. With no ordinary samples there is nothing to compare
with, and no candidate is a secret. Patterns never depend on the models. An empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailtrim.llm.common import columns_or_null, drawn_texts, small_batches, table, text_slices

# The patterns and the least length of what they find.
ASSIGN = rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = rb"AKIA[A-Z0-9]+"
NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
KINDS = ("assign", "access", "hex", "markov")

# Characters of keys, and the alphabets of random strings.
_DIGITS, _LOWER = b"0123456789", b"abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
SEPARATORS = b"+/_=-"
KEY_CHARACTERS = _DIGITS + _LOWER + _UPPER + SEPARATORS
ALPHABETS = {
    "random_hex": _DIGITS + b"abcdef",
    "random_base32": _UPPER + b"234567",
    "random_base36": _DIGITS + _LOWER,
    "random_base62": _DIGITS + _LOWER + _UPPER,
    "random_base64": _DIGITS + _LOWER + _UPPER + b"+/",
    "random_base64url": _DIGITS + _LOWER + _UPPER + b"-_",
}

SAMPLE_TEXTS = 5000
GENERATED = 2000
GENERATED_LENGTH = 32
LEAST_WORD = 4
LEAST_CANDIDATE = 16
# A random string has to be e^14, about a million times likelier.
LEAST_RATIO = 14.0
# A pair of characters counts as seen so often before training.
PRIOR = 0.1

ORDINARY = "ordinary"
NUMBERS = "number"
_START = len(KEY_CHARACTERS)
_FIRST_SEPARATOR = _START - len(SEPARATORS)
_SIDE = _START + 1
_CODE = np.full(256, 255, np.uint8)
_CODE[list(KEY_CHARACTERS)] = np.arange(_START)
_IS_KEY = _CODE < 255
_IS_HEX = np.zeros(256, bool)
_IS_HEX[list(_DIGITS + b"abcdef")] = True

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE)
_ACCESS = re.compile(ACCESS)
_SPANS = "array<struct<kind:string,start:bigint,end:bigint,ratio:double>>"


def _runs(data: np.ndarray, edges: np.ndarray, allowed: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest runs of allowed bytes that cross no edge between rows."""
    inside = allowed[data]
    before = np.empty(len(inside), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    before[edges[edges < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(inside), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[edges[(edges > 0)] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


def pattern_spans(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """``row, start, kind, end, value start`` of what the patterns find, in bytes of the slice."""
    found = []
    whole = data.tobytes()
    lowered = whole.lower()
    # The expressions run on the rows that hold one of the names at all.
    for finder, names, kind, least in (
        (_ASSIGN, NAMES, 0, LEAST_ASSIGN), (_ACCESS, (b"AKIA",), 1, LEAST_ACCESS),
    ):
        rows = set()
        for name in names:
            text = lowered if kind == 0 else whole
            at = text.find(name)
            while at >= 0:
                row = int(np.searchsorted(offsets, at, "right")) - 1
                rows.add(row)
                # On to the next row: this one is searched whole.
                at = text.find(name, int(offsets[row + 1]))
        for row in rows:
            for match in finder.finditer(whole, int(offsets[row]), int(offsets[row + 1])):
                value = match.start(2) if kind == 0 else match.start()
                if match.end() - value >= least:
                    found.append((row, match.start(), kind, match.end(), value))
    starts, ends = _runs(data, offsets, _IS_HEX, LEAST_HEX)
    rows = np.searchsorted(offsets, starts, "right") - 1
    found += [(row, a, 2, b, a) for row, a, b in zip(rows.tolist(), starts.tolist(), ends.tolist())]
    return sorted(found)


def _outside(starts: np.ndarray, ends: np.ndarray, found: list[tuple]) -> np.ndarray:
    """True for the intervals that overlap nothing found."""
    if not found:
        return np.ones(len(starts), bool)
    # Found spans may overlap each other: what counts is how far those before a place reach.
    begins = np.array([f[1] for f in found], np.int64)
    reach = np.maximum.accumulate(np.array([f[3] for f in found], np.int64))
    before = np.searchsorted(begins, ends, "left")
    return (before == 0) | (reach[np.maximum(before - 1, 0)] <= starts)


def _pair_counts(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Counts of the pairs of characters in some runs, the first character's after a start mark."""
    counts = np.zeros(_SIDE * _SIDE, np.int64)
    if len(starts):
        lengths = ends - starts
        first = np.cumsum(lengths) - lengths
        own = codes[np.arange(lengths.sum()) + np.repeat(starts - first, lengths)].astype(np.int64)
        before = np.empty(len(own), np.int64)
        before[1:] = own[:-1]
        before[first] = _START
        before[before >= _FIRST_SEPARATOR] = _START
        counts += np.bincount(before * _SIDE + own, minlength=len(counts))
    return counts.reshape(_SIDE, _SIDE)


class Models:
    """Log-likelihood ratios of a random string of each kind against an ordinary identifier."""

    def __init__(self, counts: dict[str, np.ndarray]) -> None:
        ordinary = _log_chances(counts.get(ORDINARY, np.zeros((_SIDE, _SIDE))))
        self.kinds = sorted(name for name in counts if name != ORDINARY)
        self.ratios = np.array([_log_chances(counts[name]) - ordinary for name in self.kinds])
        self.seen: dict[bytes, float] = {}

    def ratio(self, value: bytes) -> float:
        """How much likelier, as a logarithm, the best model of random strings makes this value."""
        known = self.seen.get(value)
        if known is None:
            codes = _CODE[np.frombuffer(value, np.uint8)]
            before = np.r_[np.uint8(_START), codes[:-1]]
            known = float(self.ratios[:, before, codes].sum(axis=1).max()) if self.kinds else -np.inf
            if len(self.seen) < 200_000:
                self.seen[value] = known
        return known


def _log_chances(counts: np.ndarray) -> np.ndarray:
    """Logarithms of the chances of a character after another one; 0 for separators and after them."""
    smooth = counts[:, :_FIRST_SEPARATOR] + PRIOR
    chances = np.zeros((_SIDE, _SIDE))
    chances[:, :_FIRST_SEPARATOR] = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    chances[_FIRST_SEPARATOR:_START] = 0
    return chances


def generated_counts(count: int = GENERATED, length: int = GENERATED_LENGTH) -> dict[str, np.ndarray]:
    """Pair counts of random strings over each alphabet, drawn with a fixed seed."""
    draw = np.random.default_rng(20)
    found = {}
    for name, alphabet in {**ALPHABETS, NUMBERS: _DIGITS}.items():
        codes = _CODE[np.frombuffer(alphabet, np.uint8)][draw.integers(len(alphabet), size=count * length)]
        ends = np.arange(1, count + 1) * length
        found[name] = _pair_counts(codes, ends - length, ends)
    return found


def labelled_samples(docs: DataFrame, most: int = SAMPLE_TEXTS) -> DataFrame:
    """``value, label`` of the runs of key characters in a bounded number of distinct texts."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in text_slices(batch.column("text")):
                found = pattern_spans(data, offsets)
                starts, ends = _runs(data, offsets, _IS_KEY, LEAST_WORD)
                clear = _outside(starts, ends, found)
                whole = data.tobytes()
                values = [whole[a:b] for a, b in zip(starts[clear].tolist(), ends[clear].tolist())]
                values += [a + b.capitalize() for a, b in zip(values, values[1:])] + [v.upper() for v in values]
                labels = [ORDINARY] * len(values) + [KINDS[f[2]] for f in found]
                values += [whole[f[4] : f[3]] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, pa.binary()).cast(pa.string()), pa.array(labels, pa.string())], ["value", "label"]
                )

    return drawn_texts(docs, most, "secrets").mapInArrow(run, "value string, label string")


def train(samples: DataFrame, generated: int = GENERATED) -> Models:
    """Models of labelled samples, ``value, label``; the driver gets a table of counts per label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = np.array(batch.column("label").to_pylist(), object)
            for label in sorted({x for x in labels if x is not None}):
                rows = pa.array(labels == label)
                for _, data, offsets in text_slices(batch.column("value").filter(rows)):
                    starts, ends = _runs(data, offsets, _IS_KEY, 1)
                    counts = _pair_counts(_CODE[data], starts, ends)
                    totals[label] = totals.get(label, 0) + counts
        for label, counts in totals.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * len(at)), pa.array(at.astype(np.int32)), pa.array(counts.ravel()[at])],
                ["label", "pair", "n"],
            )

    pairs = samples.select(F.col("value").cast("string"), F.col("label").cast("string"))
    pairs = pairs.mapInArrow(run, "label string, pair int, n bigint").groupBy("label", "pair").agg(F.sum("n").alias("n"))
    counts: dict[str, np.ndarray] = {}
    for row in pairs.collect():
        own = counts.setdefault(row.label, np.zeros((_SIDE, _SIDE), np.int64))
        own[divmod(row.pair, _SIDE)] += row.n
    if ORDINARY not in counts:
        return Models({})
    for name, made in generated_counts(generated).items() if generated else ():
        name = ORDINARY if name == NUMBERS else name
        counts[name] = counts.get(name, 0) + made
    return Models(counts)


def _characters(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte place of the slice, the code points before it."""
    places = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=places[1:])
    return places


def find_secrets(docs: DataFrame, models: Models) -> DataFrame:
    """``doc_id, spans`` of every row; a span is ``kind, start, end, ratio`` (null for a pattern's).

    Spans are ordered by start, then by kind as in ``KINDS``.
    """
    small_batches(docs.sparkSession)
    docs = columns_or_null(docs, {"doc_id": "bigint", "text": "string"})
    kinds, ratios = models.kinds, models.ratios

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Models({})
        own.kinds, own.ratios = kinds, ratios
        schema = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("ratio", pa.float64())])
        for batch in batches:
            for rows, data, offsets in text_slices(batch.column("text")):
                found = pattern_spans(data, offsets)
                starts, ends = _runs(data, offsets, _IS_KEY, LEAST_CANDIDATE)
                clear = _outside(starts, ends, found)
                whole = data.tobytes()
                spans: list[list[tuple]] = [[] for _ in range(len(offsets) - 1)]
                points = _characters(data, offsets)
                for row, start, kind, end, _ in found:
                    spans[row].append((start, kind, end, None))
                for start, end in zip(starts[clear].tolist(), ends[clear].tolist()):
                    ratio = own.ratio(whole[start:end])
                    if ratio >= LEAST_RATIO:
                        row = int(np.searchsorted(offsets, start, "right")) - 1
                        spans[row].append((start, len(KINDS) - 1, end, ratio))
                listed = []
                for row, items in enumerate(spans):
                    base = points[offsets[row]]
                    listed.append([
                        {"kind": KINDS[kind], "start": int(points[a] - base), "end": int(points[b] - base), "ratio": ratio}
                        for a, kind, b, ratio in sorted(items, key=lambda s: s[:2])
                    ])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[rows], pa.array(listed, pa.list_(schema))], ["doc_id", "spans"]
                )

    return docs.mapInArrow(run, f"doc_id bigint, spans {_SPANS}")


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_secrets(docs, train(labelled_samples(docs)))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s.kind != KINDS[-1])
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
