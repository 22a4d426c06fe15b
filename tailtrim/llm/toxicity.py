"""Toxicity: a linear-chain conditional random field tags toxic words, documents get a score and spans.

Labels are given for documents, so the words to learn from are labelled first. For each word of a
bounded sample of labelled documents it is counted in how many families of toxic and of clean documents
it occurs (a family is a document with its near copies, which would otherwise make all their words look
telling), and so are the beginnings of words, for languages that build words from stems. A word of a
toxic document that, as a whole or by its beginning, speaks clearly enough for toxicity is labelled
toxic, any other clean. A two-state chain with features of the word and its neighbours is then fitted to these
labels by gradient ascent on the conditional likelihood, in numpy.

Every whole text is tagged with it: forward and backward recursions give each word the chance that it
is toxic, in blocks of words whose transfer matrices are multiplied, so texts of any length are handled
by array operations. A document's score is a calibrated function of the expected number and share of toxic
words, counted from chances of ``FLOOR`` on, so that it does not grow with the length of a clean text. Runs
of words that are more likely toxic than not are its offending spans; without one it scores below 0.5.

Bounds: about ``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN`` labelled documents of up to ``SAMPLE_BYTES`` are
learned from, and the chain is fitted on at most ``STRETCHES`` stretches of each. Every text is scored whole.

Defined results: a null or empty text has no words and the score of a document without toxic words, and
so has every document if nothing could be learned (then half the share of toxic labels, or 0).
Documents with several labels count as toxic if one of them is. Only the text is an input of a score.
An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailtrim.llm.common import SLICE_BYTES, WORD, columns_or_null, is_share, small_batches, table
from tailtrim.llm.shingles import mixed

# About so many labelled documents of each kind are learned from, none longer than SAMPLE_BYTES.
SAMPLE_TOXIC = 1000
SAMPLE_CLEAN = 2000
SAMPLE_BYTES = 100_000
# A toxic word is this much more frequent (in log odds) in toxic families, and the likelihood ratio
# against chance is this much above what the best of all words of the sample reaches by chance.
LEAST_EVIDENCE = 1.5
ABOVE_CHANCE = 3.0
# Words on either side of a labelled one that the chain is fitted on, and stretches of words taken
# from one document of the sample: its first words, then those around its first toxic ones.
CONTEXT = 32
STRETCHES = 8
# Chances below this are those of any clean word and do not add up to toxicity in a long text.
FLOOR = 0.02
# A text without an offending span scores below 0.5, however its words add up.
UNFLAGGED = 0.49
# Letters of the beginnings of words that are learned besides whole words.
BEGINNINGS = (5, 6, 7)
STEPS = 150
BLOCK = 64
# Parts in which the hashes of the sample's words are counted.
HASH_PARTS = 16
# Texts of the sample that the driver tags at once to calibrate the score.
CALIBRATED_AT_ONCE = 50

# Features of a word: what it says for toxicity, in steps, and how it is written.
EVIDENCE_STEPS = 8
FORMS = 4
_WORD = re.compile(WORD)
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


@dataclass(frozen=True)
class ToxicityModel:
    # Evidence of the words and beginnings that have some, in steps from 1 to EVIDENCE_STEPS - 1.
    evidence: dict[str, int]
    # Weights of the features of the word itself, of the one before and of the one after.
    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    transitions: np.ndarray
    # Logistic function of the logarithms of the expected number of toxic words and of their share.
    calibration: np.ndarray


def plain(word: str) -> str:
    return _EDGES.sub("", word).lower()


def bare_words(text: str) -> set[str]:
    return {plain(w) for w in _WORD.findall(text)} - {""}


def units(bare: str) -> list[str]:
    """A word as a whole, marked at its end, and its beginnings."""
    return [bare + "$", *[bare[:size] for size in BEGINNINGS if len(bare) >= size]]


def features(word: str, evidence: dict[str, int]) -> tuple[int, int]:
    """Two features of a word: its evidence, and its form."""
    said = max(evidence.get(unit, 0) for unit in units(plain(word)))
    form = 0 if word.islower() else 1 if word.isupper() and len(word) > 1 else 2 if any(c.isdigit() for c in word) else 3
    return said, EVIDENCE_STEPS + form


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[list[tuple[str, int]], float]:
    """Texts and labels of about so many labelled documents of each kind, chosen by hash; the log odds
    of toxic documents among all labelled ones.
    """
    labels = columns_or_null(labels, {"doc_id": "bigint", "toxic": "int"}).filter("toxic IS NOT NULL AND doc_id IS NOT NULL")
    one_each = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r.toxic: r.n for r in one_each.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("toxic") > 0, F.lit(SAMPLE_TOXIC / max(counts.get(1, 0), 1))).otherwise(
        F.lit(SAMPLE_CLEAN / max(counts.get(0, 0), 1))
    )
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = one_each.filter(draw < share)
    # The sample has about SAMPLE_TOXIC + SAMPLE_CLEAN lines, whatever the input.
    texts = docs.filter(F.octet_length("text") <= SAMPLE_BYTES).join(F.broadcast(chosen), "doc_id")
    # An id that many rows share is one line of the sample, with the first of its texts.
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    rows = texts.select("text", (F.col("toxic") > 0).cast("int").alias("toxic")).collect()
    prior = float(np.log(max(counts.get(1, 0), 0.5) / max(counts.get(0, 0), 0.5)))
    return sorted((r.text, r.toxic) for r in rows), prior


def _families(word_sets: Iterable[np.ndarray]) -> list[int]:
    """A number for each document; near copies, which agree in several minimal hashes, share one."""
    family: list[int] = []
    known: dict[tuple[int, int], int] = {}
    for number, words in enumerate(word_sets):
        if not len(words):
            family.append(number)
            continue
        keys = [(k, int(mixed(words + np.uint64(k * 7919 + 1)).min())) for k in range(12)]
        votes = Counter(known[key] for key in keys if key in known)
        same = next((f for f, n in votes.most_common(1) if n >= 5), number)
        family.append(same)
        for key in keys:
            known.setdefault(key, same)
    return family


def _hashed(texts: set[str] | list[str]) -> np.ndarray:
    """One number for each text, the same in every process."""
    found = [int.from_bytes(blake2b(text.encode(), digest_size=8).digest(), "little") for text in texts]
    return np.array(found, np.uint64)


def _counted(families: Iterable[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The units of all families, sorted, and in how many families each is.

    A part of the hashes is counted at a time, so that no array of all units of all families is made.
    """
    once = [np.unique(np.concatenate(found)) for found in families]
    bounds = np.arange(1, HASH_PARTS, dtype=np.uint64) * np.uint64(2**64 // HASH_PARTS)
    cuts = [[0, *np.searchsorted(units, bounds).tolist(), len(units)] for units in once]
    counted = []
    for part in range(HASH_PARTS):
        here = [units[cut[part] : cut[part + 1]] for units, cut in zip(once, cuts)]
        counted.append(np.unique(np.concatenate([np.zeros(0, np.uint64), *here]), return_counts=True))
    found, counts = zip(*counted)
    return np.concatenate(found), np.concatenate(counts)


def _evidence(sample: list[tuple[str, int]]) -> tuple[dict[str, float], set[str]]:
    """Log odds, of toxic against clean families, of words and beginnings; the telling ones.

    Words are counted as hashes, which keeps this small; those that matter are then named again. The
    driver holds the words of one document at a time.
    """
    unit_sets: list[np.ndarray] = []

    def word_sets() -> Iterator[np.ndarray]:
        for text, _ in sample:
            words = bare_words(text)
            unit_sets.append(_hashed({unit for word in words for unit in units(word)}))
            yield _hashed(words)

    family = _families(word_sets())
    of_families: list[dict[int, list[np.ndarray]]] = [defaultdict(list), defaultdict(list)]
    for found, own, (_, toxic) in zip(unit_sets, family, sample):
        of_families[toxic][own].append(found)
    totals = [max(len(f), 1) for f in of_families]
    (clean_units, clean_counts), (found_units, toxic_counts) = [_counted(f.values()) for f in of_families]
    place = np.minimum(np.searchsorted(clean_units, found_units), max(len(clean_units) - 1, 0))
    clean = np.zeros(len(found_units), np.int64)
    if len(clean_units):
        clean = np.where(clean_units[place] == found_units, clean_counts[place], 0)
    share = totals[1] / sum(totals)
    enough = np.log(len(found_units) + len(clean_units) + 1) + ABOVE_CHANCE
    value = np.log((toxic_counts + 0.1) / totals[1]) - np.log((clean + 0.1) / totals[0])
    together = toxic_counts + clean
    ratio = toxic_counts * np.log(toxic_counts / (together * share))
    ratio += np.where(clean > 0, clean * np.log(np.maximum(clean, 1) / (together * (1 - share))), 0)
    use = (toxic_counts >= 2) & (value > 0)
    is_telling = use & (value >= LEAST_EVIDENCE) & (ratio >= enough)
    # Units that are neither telling nor rather frequent in toxic texts say next to nothing.
    use &= is_telling | (ratio >= ABOVE_CHANCE)
    by_hash = dict(zip(found_units[use].tolist(), zip(value[use].tolist(), is_telling[use].tolist())))
    odds, telling = {}, set()
    for text, toxic in sample:
        if toxic:
            named = list({unit for word in bare_words(text) for unit in units(word)})
            for unit, key in zip(named, _hashed(named).tolist()):
                if key in by_hash:
                    odds[unit], tells = by_hash[key]
                    if tells:
                        telling.add(unit)
    return odds, telling


def fit(docs: DataFrame, labels: DataFrame, stretches: int = STRETCHES) -> ToxicityModel | float:
    """A model, or, where no word is telling, the score of every document.

    The driver holds the sample only. The chain is fitted on at most ``stretches`` stretches of
    ``2 * CONTEXT`` words of each document of it.
    """
    small_batches(docs.sparkSession)
    docs = columns_or_null(docs, {"doc_id": "bigint", "text": "string"})
    sample, prior = _sample(docs, labels)
    toxic = sum(label for _, label in sample)
    base = toxic / max(len(sample), 1)
    if not toxic or toxic == len(sample):
        return base / 2
    odds, telling = _evidence(sample)
    if not telling:
        return base / 2
    # Steps of evidence; words that are not telling by themselves stay on the lower steps.
    evidence = {}
    for word, value in odds.items():
        step = 1 + int(min(value, 7.99) * (EVIDENCE_STEPS - 2) / 8)
        evidence[word] = max(step, 4) if word in telling else min(step, 3)
    windows, tags = _windows(sample, evidence, telling, stretches)
    own, before, after, transitions = _train_chain(windows, tags)
    model = ToxicityModel(evidence, own, before, after, transitions, np.zeros(3))
    weights = _calibrate(model, sample)
    # The sample holds toxic documents more often than the table does.
    weights[0] += prior - np.log(toxic / (len(sample) - toxic))
    return replace(model, calibration=weights)


def _windows(
    sample: list, evidence: dict[str, int], telling: set[str], stretches: int = STRETCHES
) -> tuple[np.ndarray, np.ndarray]:
    """Features and tags of stretches of words, ``[stretches, words, 2]``; tag -1 is no word.

    So many stretches of a document are taken at most.
    """
    width = 2 * CONTEXT
    rows, tags = [], []
    for text, label in sample:
        words = _WORD.findall(text)
        marks = [int(bool(label) and not telling.isdisjoint(units(plain(w)))) for w in words]
        # One stretch from the start, and one around each toxic word that is not yet in a stretch.
        starts = [0]
        for place, mark in enumerate(marks):
            if mark and place >= starts[-1] + width:
                starts.append(max(place - CONTEXT, 0))
        for start in starts[:stretches]:
            part = words[start : start + width]
            if part:
                pad = width - len(part)
                # As small arrays: lists of pairs would take the driver ten times as much.
                rows.append(np.array([features(w, evidence) for w in part] + [(0, EVIDENCE_STEPS)] * pad, np.int8))
                tags.append(np.array(marks[start : start + width] + [-1] * pad, np.int8))
    return np.array(rows, np.int64), np.array(tags, np.int64)


def _train_chain(windows: np.ndarray, tags: np.ndarray):
    """Weights of the chain by gradient ascent on the likelihood of the tags, with Adam."""
    kinds = EVIDENCE_STEPS + FORMS
    count, width, _ = windows.shape
    is_word = tags >= 0
    # What a word is like, as one number, and what the one before and the one after are like.
    none = EVIDENCE_STEPS * FORMS
    own = np.where(is_word, windows[:, :, 0] * FORMS + windows[:, :, 1] - EVIDENCE_STEPS, none)
    edge = np.full((count, 1), none)
    before, after = np.hstack([edge, own[:, :-1]]), np.hstack([own[:, 1:], edge])
    codes, which = np.unique((own * (none + 1) + before) * (none + 1) + after, return_inverse=True)
    which = which.reshape(count, width)
    distinct = np.zeros((len(codes), 3 * kinds))
    rows = np.arange(len(codes))
    for part, divisor in enumerate([(none + 1) ** 2, none + 1, 1]):
        like = codes // divisor % (none + 1)
        is_like = rows[like < none]
        distinct[is_like, part * kinds + like[is_like] // FORMS] = 1.0
        distinct[is_like, part * kinds + EVIDENCE_STEPS + like[is_like] % FORMS] = 1.0
    weights = np.zeros(3 * kinds)
    transitions = np.zeros((2, 2))
    both = is_word[:, 1:] & is_word[:, :-1]
    moments = [np.zeros(3 * kinds + 4), np.zeros(3 * kinds + 4)]
    seen_pairs = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            seen_pairs[a, b] = ((tags[:, :-1] == a) & (tags[:, 1:] == b) & both).sum()
    for step in range(1, STEPS + 1):
        score = (distinct @ weights)[which] * is_word
        marginal, pairs = _padded_marginals(score, transitions, is_word)
        miss = np.where(is_word, (tags == 1) - marginal, 0.0)
        by_shape = np.bincount(which.ravel(), miss.ravel(), minlength=len(distinct))
        gradient = np.concatenate([distinct.T @ by_shape, (seen_pairs - pairs).ravel()]) / is_word.sum()
        gradient -= 1e-5 * np.concatenate([weights, transitions.ravel()])
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.99 * moments[1] + 0.01 * gradient**2
        change = 0.2 * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        weights += change[: 3 * kinds]
        transitions += change[3 * kinds :].reshape(2, 2)
    return weights[:kinds], weights[kinds : 2 * kinds], weights[2 * kinds :], transitions


def _padded_marginals(score: np.ndarray, transitions: np.ndarray, is_word: np.ndarray):
    """Chance of state 1 for each word of equally long stretches, and expected pairs of states."""
    count, width = score.shape
    move = np.exp(transitions - transitions.max())
    raised = np.exp(np.clip(score, -30, 30))
    forward = np.zeros((width, count, 2))
    backward = np.ones((width, count, 2))
    local = np.stack([np.ones_like(raised), raised], axis=2)
    forward[0] = local[:, 0]
    for t in range(1, width):
        step = (forward[t - 1] @ move) * local[:, t]
        forward[t] = np.where(is_word[:, t, None], step / step.sum(axis=1, keepdims=True), forward[t - 1])
    for t in range(width - 2, -1, -1):
        step = (backward[t + 1] * local[:, t + 1]) @ move.T
        backward[t] = np.where(is_word[:, t + 1, None], step / step.sum(axis=1, keepdims=True), backward[t + 1])
    joint = forward * backward
    marginal = (joint[:, :, 1] / joint.sum(axis=2)).T
    pairs = np.zeros((2, 2))
    for t in range(1, width):
        both = forward[t - 1][:, :, None] * move[None] * (local[:, t] * backward[t])[:, None, :]
        both /= both.sum(axis=(1, 2), keepdims=True)
        pairs += both[is_word[:, t] & is_word[:, t - 1]].sum(axis=0)
    return marginal, pairs


def marginals(score: np.ndarray, sizes: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Chance of state 1 for each word of texts that stand one after the other.

    The words of a text are dealt into blocks. The transfer matrices of a block's words are multiplied
    for all blocks at once; the few products of a text then give the state at each block's ends, and
    from there both recursions run through all blocks at once.
    """
    if not len(score):
        return np.zeros(0)
    move = np.exp(transitions - transitions.max())
    blocks = -(-sizes // BLOCK)
    first_block = np.cumsum(blocks) - blocks
    place = np.arange(len(score)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    row = np.repeat(first_block, sizes) + place // BLOCK
    column = place % BLOCK
    raised = np.ones((blocks.sum(), BLOCK))
    raised[row, column] = np.exp(np.clip(score, -30, 30))
    is_word = np.zeros(raised.shape, bool)
    is_word[row, column] = True
    starts = np.zeros(len(raised), bool)
    starts[first_block[sizes > 0]] = True
    # Product of the matrices of a block, the first word of a text without its transition.
    product = np.broadcast_to(np.eye(2), (len(raised), 2, 2)).copy()
    for t in range(BLOCK):
        here = np.broadcast_to(move, (len(raised), 2, 2)).copy()
        if t == 0:
            here[starts] = np.eye(2)
        here[:, :, 1] *= raised[:, t, None]
        step = product @ here
        step /= step.sum(axis=(1, 2), keepdims=True)
        product = np.where(is_word[:, t, None, None], step, product)
    before, behind = np.ones((len(raised), 2)), np.ones((len(raised), 2))
    for i in np.flatnonzero(~starts):
        state = before[i - 1] @ product[i - 1]
        before[i] = state / state.sum()
    last = np.r_[starts[1:], True]
    for i in np.flatnonzero(~last)[::-1]:
        state = product[i + 1] @ behind[i + 1]
        behind[i] = state / state.sum()
    forward = np.zeros((BLOCK, len(raised), 2))
    state = before
    for t in range(BLOCK):
        moved = state @ move
        if t == 0:
            moved = np.where(starts[:, None], state, moved)
        moved[:, 1] *= raised[:, t]
        moved /= moved.sum(axis=1, keepdims=True)
        state = np.where(is_word[:, t, None], moved, state)
        forward[t] = state
    chance = np.zeros(raised.shape)
    state = behind
    for t in range(BLOCK - 1, -1, -1):
        joint = forward[t] * state
        chance[:, t] = joint[:, 1] / joint.sum(axis=1)
        moved = state.copy()
        moved[:, 1] *= raised[:, t]
        moved = moved @ move.T
        moved /= moved.sum(axis=1, keepdims=True)
        state = np.where(is_word[:, t, None], moved, state)
    return chance[row, column]


class Tagger:
    """Tags the words of batches of texts."""

    def __init__(self, model: ToxicityModel) -> None:
        self.model = model

    def chances(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The chance of every word, and the number of words of each text."""
        texts = texts.fill_null("")
        # The words of the pattern are what stands between these six characters.
        parts = pc.split_pattern(_only_blanks(texts), " ")
        sizes = pc.list_value_length(parts).to_numpy()
        words = pc.list_flatten(parts)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        is_word = pc.not_equal(words, "")
        owner = owner[is_word.to_numpy(zero_copy_only=False)]
        encoded = words.filter(is_word).dictionary_encode()
        model = self.model
        found = np.array([features(w, model.evidence) for w in encoded.dictionary.to_pylist()], np.int64).reshape(-1, 2)
        which = encoded.indices.to_numpy()
        own, before, after = (w[found].sum(axis=1) for w in (model.own, model.before, model.after))
        score = own[which]
        if len(which):
            same = owner[1:] == owner[:-1]
            score[1:] += np.where(same, before[which[:-1]], 0.0)
            score[:-1] += np.where(same, after[which[1:]], 0.0)
        counts = np.bincount(owner, minlength=len(texts))
        return marginals(score, counts, model.transitions), counts

    def scores(self, chances: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The score of each text; it stays below 0.5 where no word is toxic rather than not."""
        found = _logistic(_summary(_expected(chances, counts), counts) @ self.model.calibration)
        flagged = np.bincount(np.repeat(np.arange(len(counts)), counts), chances >= 0.5, minlength=len(counts)) > 0
        return np.where(flagged, found, np.minimum(found, UNFLAGGED))


def _expected(chances: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The toxic words to expect in each text, of words with more than a clean word's chance."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return np.bincount(owner, np.where(chances >= FLOOR, chances, 0.0), minlength=len(counts))


def _only_blanks(texts: pa.Array) -> pa.Array:
    for space in "\t\n\x0b\x0c\r":
        texts = pc.replace_substring(texts, space, " ")
    return texts


def _summary(expected: np.ndarray, counts: np.ndarray) -> np.ndarray:
    number = np.log(expected + 0.01)
    return np.stack([np.ones(len(counts)), number, number - np.log(counts + 20)], axis=1)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _calibrate(model: ToxicityModel, sample: list[tuple[str, int]]) -> np.ndarray:
    """Weights of the score by Newton's method on the log loss of the sample."""
    tagger = Tagger(model)
    parts = []
    for first in range(0, len(sample), CALIBRATED_AT_ONCE):
        chances, counts = tagger.chances(pa.array([text for text, _ in sample[first : first + CALIBRATED_AT_ONCE]]))
        parts.append(_summary(_expected(chances, counts), counts))
    inputs = np.concatenate(parts)
    labels = np.array([label for _, label in sample], float)
    weights = np.zeros(inputs.shape[1])
    for _ in range(30):
        p = _logistic(inputs @ weights)
        curvature = (inputs * (p * (1 - p))[:, None]).T @ inputs + 1e-2 * np.eye(len(weights))
        weights += np.linalg.solve(curvature, inputs.T @ (labels - p) - 1e-2 * weights)
    return weights


_SCORE = "score double, expected_words double, spans array<struct<start:int,end:int,chance:double>>"


def score(docs: DataFrame, model: ToxicityModel | float) -> DataFrame:
    """``row`` (all columns), ``score``, ``expected_words`` and ``spans`` of every row of ``docs``.

    Spans are in code points of the text.
    """
    from pyspark.sql import types as T

    small_batches(docs.sparkSession)
    columns_or_null(docs, {"text": "string"})
    lines = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([lines.schema["row"], *T.StructType.fromDDL(_SCORE).fields])
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("chance", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = None if isinstance(model, float) else Tagger(model)
        for whole in batches:
            for batch in _cut(whole):
                texts = batch.column("text")
                if tagger is None:
                    scores, expected = np.full(len(texts), float(model)), np.zeros(len(texts))
                    spans: list[list] = [[] for _ in range(len(texts))]
                else:
                    chances, counts = tagger.chances(texts)
                    scores = tagger.scores(chances, counts)
                    ends = np.cumsum(counts)
                    expected = _expected(chances, counts)
                    spans = [[] for _ in range(len(texts))]
                    hot = np.flatnonzero(chances >= 0.5)
                    for i in np.unique(np.searchsorted(ends, hot, "right")):
                        own = chances[ends[i] - counts[i] : ends[i]]
                        spans[i] = _spans(texts[int(i)].as_py(), own)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), pa.array(scores, pa.float64()), pa.array(expected.astype(float)), pa.array(spans, pa.list_(span))],
                    ["row", "score", "expected_words", "spans"],
                )

    return lines.mapInArrow(run, schema)


def _cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``SLICE_BYTES`` of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
    group = np.cumsum(sizes) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(sizes)]
    for first, last in zip(cuts[:-1], cuts[1:]):
        if last > first:
            yield batch.slice(first, last - first)


def _spans(text: str, chances: np.ndarray) -> list[dict]:
    """Runs of words that are toxic rather than not, with the largest chance in each."""
    spans: list[dict] = []
    last = -2
    for place, (match, chance) in enumerate(zip(_WORD.finditer(text), chances.tolist())):
        if chance >= 0.5:
            if place == last + 1:
                spans[-1]["end"] = match.end()
                spans[-1]["chance"] = max(spans[-1]["chance"], chance)
            else:
                spans.append({"start": match.start(), "end": match.end(), "chance": chance})
            last = place
    return spans


def not_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text is not found toxic."""
    return score(docs, fit(docs, labels)).filter(F.col("score") < 0.5).select("row.*")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.filter(~is_share("doc_id", 5, 0)))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select(F.col("row").getField("doc_id").alias("doc_id"), "score", "expected_words", "spans").select(
        "doc_id",
        is_share("doc_id", 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "expected_words",
        "spans",
    )
