"""Token ids of documents as compressed binary segments with a shared dictionary.

Texts are encoded with a public tokenizer, and an end id follows each. Ids are little-endian, two bytes
where the vocabulary allows it, else four. A zstandard dictionary is trained on the serialized ids of a
bounded sample, and each document is compressed on its own with it, so that one short document can be
read without its neighbours.

The file format: a table of segments, written by Spark as Parquet (so a lost executor's work is simply
done again and only whole results become visible) and ordered by ``part, segment``. A segment holds
``doc_ids``, ``n_tokens`` and ``offsets`` of its documents, the ``dictionary_hash`` and one binary
``payload``: magic bytes, version, width of an id, then one zstandard frame per document; ``offsets``
are those of the frames, with one more for the end. The dictionary stands beside the segments in a
table of its own. Documents are in ascending order of ids, null first, then by a hash of the text.

Pieces of text are encoded once per batch, and kept until there are ``CACHED_PIECES``: cutting before a space that is followed by a visible
character never changes the ids of byte-level tokenizers that split words with their leading space, so
the ids of a text are those of its pieces.

Defined results: a null or empty text has the end id alone. Equal rows are kept, in any order among
themselves. A tokenizer that does not split at spaces can be used with ``by_pieces=False``. An empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tailtrim.llm.common import columns_or_null, drawn_texts, shared_folder, small_batches, table, text_buffer, text_slices
from tailtrim.llm.ranges import with_parts

END_ID = 0
DICTIONARY_BYTES = 65536
# The dictionary learns from so many texts, and of a long one from so many ids.
SAMPLE_DOCS = 2000
SAMPLE_IDS = 4096
SEGMENT_BYTES = 4 * 1024 * 1024
CACHED_PIECES = 500_000
LEVEL = 3
MARKS = ".,;:!?"
_ENDS_IN_MARKS = r"[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}][.,;:!?]+$"

# The head of a payload.
MAGIC, VERSION = b"TTIDS", 1

_SEGMENTS = (
    "part int, segment int, first_token bigint, doc_ids array<bigint>, n_tokens array<bigint>, "
    "offsets array<bigint>, dictionary_hash string, payload binary"
)


def public_tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """Ids of known pieces, one after the other in one array."""

    def __init__(self, id_type: np.dtype) -> None:
        # Numbers of words that stand after a space, and of texts as they are.
        self.words: dict[str, int] = {}
        self.texts: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, id_type)
        self.used = 0
        self.starts = np.zeros(1 << 12, np.int64)
        self.lengths = np.zeros(1 << 12, np.int64)

    def __len__(self) -> int:
        return len(self.words) + len(self.texts)

    def add(self, numbers: dict[str, int], pieces: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Further pieces, none of them known, with their ids in a row."""
        first = len(self)
        numbers |= zip(pieces, range(first, first + len(pieces)))
        self.ids = _grown(self.ids, self.used + len(ids))
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts, self.lengths = (_grown(x, first + len(pieces)) for x in (self.starts, self.lengths))
        self.starts[first : first + len(pieces)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first : first + len(pieces)] = lengths
        self.used += len(ids)

    def gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some pieces in a row, and how many each piece has."""
        lengths = self.lengths[numbers]
        total = int(lengths.sum())
        begins = np.cumsum(lengths) - lengths
        return self.ids[np.arange(total) + np.repeat(self.starts[numbers] - begins, lengths)], lengths


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    larger = np.zeros(max(size, 2 * len(array)), array.dtype)
    larger[: len(array)] = array
    return larger


class Encoder:
    """Ids of the texts of a batch.

    All texts of a batch are split at spaces together and every different piece is looked up once. The
    pieces not yet known are encoded as one text, which is then cut where a token begins with a space.
    """

    def __init__(self, path: str, by_pieces: bool = True) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.id_type = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.by_pieces = by_pieces
        self.pieces = Pieces(self.id_type)
        # Fixed value: byte-level vocabularies write a space as this letter.
        self.after_space = np.zeros(size, bool)
        self.after_space[[i for token, i in self.tokenizer.get_vocab().items() if token.startswith("\u0120")]] = True

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.id_type) for e in found]

    def _learn_texts(self, texts: list[str]) -> None:
        """Encode texts as they stand, each on its own."""
        fresh = [t for t in dict.fromkeys(texts) if t not in self.pieces.texts]
        self._add_each(self.pieces.texts, fresh, fresh)

    def _add_each(self, numbers: dict[str, int], pieces: list[str], texts: list[str]) -> None:
        found = self._encode(texts)
        lengths = np.array([len(own) for own in found], np.int64)
        self.pieces.add(numbers, pieces, np.concatenate([np.zeros(0, self.id_type), *found]), lengths)

    def _learn_words(self, words: list[str]) -> None:
        """Encode words that stand after a space, all in one text."""
        if not words:
            return
        (ids,) = self._encode([" " + " ".join(words)])
        begins = np.flatnonzero(self.after_space[ids])
        if len(begins) == len(words) and begins[0] == 0:
            self.pieces.add(self.pieces.words, words, ids, np.diff(np.r_[begins, len(ids)]))
        else:
            # Not a vocabulary that marks spaces so.
            self._add_each(self.pieces.words, words, [" " + w for w in words])

    def _learn(self, words: pa.Array) -> np.ndarray:
        """Numbers of unknown words, encoded now; of one that ends in marks, the word before them is."""
        ends = pc.match_substring_regex(words, _ENDS_IN_MARKS)
        encoded = pc.if_else(ends, pc.utf8_rtrim(words, MARKS), words).dictionary_encode()
        bases, which = _strings(encoded.dictionary), encoded.indices.to_numpy()
        numbers = np.fromiter(map(self.pieces.words.get, bases, repeat(-1)), np.int64, len(bases))
        fresh = np.flatnonzero(numbers < 0)
        first = len(self.pieces)
        self._learn_words([bases[i] for i in fresh.tolist()])
        numbers[fresh] = np.arange(first, first + len(fresh))
        found = numbers[which]
        ended = np.flatnonzero(ends.to_numpy(zero_copy_only=False))
        if len(ended):
            # Marks after a letter always begin a token of their own.
            pieces = _strings(words.take(pa.array(ended)))
            marks = [w[len(bases[i]) :] for w, i in zip(pieces, which[ended].tolist())]
            self._learn_texts(marks)
            pairs = np.stack([found[ended], [self.pieces.texts[mark] for mark in marks]], axis=1)
            ids, lengths = self.pieces.gathered(pairs.ravel())
            first = len(self.pieces)
            self.pieces.add(self.pieces.words, pieces, ids, lengths.reshape(-1, 2).sum(axis=1))
            found[ended] = np.arange(first, first + len(ended))
        return found

    def _numbers(self, words: pa.Array, used: np.ndarray) -> np.ndarray:
        """The number of each of some different words where it is used after a space, else -1."""
        found = np.fromiter(map(self.pieces.words.get, _strings(words), repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(used & (found < 0))
        if len(unknown):
            found[unknown] = self._learn(words.take(pa.array(unknown)))
        return found

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some texts in a row, each with its end id, and how many each text has."""
        texts = texts.fill_null("")
        if not self.by_pieces:
            found = self._encode(texts.to_pylist())
            end = np.array([END_ID], self.id_type)
            ended = [part for own in found for part in (own, end)]
            return np.concatenate([np.zeros(0, self.id_type), *ended]), np.array([len(own) + 1 for own in found], np.int64)
        if len(self.pieces) > CACHED_PIECES:
            self.pieces = Pieces(self.id_type)
        parts = pc.split_pattern(texts, " ")
        counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        encoded = pc.list_flatten(parts).dictionary_encode()
        words, which = encoded.dictionary, encoded.indices.to_numpy()
        firsts = np.cumsum(counts) - counts
        is_first = np.zeros(len(which), bool)
        is_first[firsts] = True
        # A piece is a word, or words of which all but the first cannot be told from what is before them.
        begins = _opens(words)[which] | is_first
        at = np.flatnonzero(begins)
        size = np.diff(np.r_[at, len(which)])
        plain = (size == 1) & ~is_first[at]
        used = np.zeros(len(words), bool)
        used[which[at[plain]]] = True
        found = np.empty(len(at), np.int64)
        found[plain] = self._numbers(words, used)[which[at[plain]]]
        joined = []
        for place, length, first in zip(at[~plain].tolist(), size[~plain].tolist(), is_first[at[~plain]].tolist()):
            own = " ".join(words.take(pa.array(which[place : place + length])).to_pylist())
            joined.append(own if first else f" {own}")
        self._learn_texts(joined)
        found[~plain] = [self.pieces.texts[text] for text in joined]
        # The end id of a text is put in after its last piece.
        ids, lengths = self.pieces.gathered(found)
        owner = np.searchsorted(firsts, at, "right") - 1
        per_text = np.bincount(owner, lengths, minlength=len(texts)).astype(np.int64)
        with_end = np.empty(len(ids) + len(texts), self.id_type)
        is_end = np.zeros(len(with_end), bool)
        is_end[np.cumsum(per_text + 1) - 1] = True
        with_end[is_end], with_end[~is_end] = END_ID, ids
        return with_end, per_text + 1


def _strings(column: pa.Array) -> list[str]:
    """A list of the strings; this way is several times faster than one scalar after the other."""
    return column.to_numpy(zero_copy_only=False).tolist()


def _opens(words: pa.Array) -> np.ndarray:
    """Whether a word after a space surely begins a token: by a visible character of the first tables."""
    data, offsets = text_buffer(words)
    lead, second = (np.zeros(len(words), np.uint8) for _ in range(2))
    size = np.diff(offsets)
    lead[size > 0] = data[offsets[:-1][size > 0]]
    second[size > 1] = data[offsets[:-1][size > 1] + 1]
    # UTF-8 of ! to ~ and of U+00C0 to U+024F.
    return ((lead >= 0x21) & (lead <= 0x7E)) | ((lead >= 0xC3) & (lead <= 0xC8)) | ((lead == 0xC9) & (second <= 0x8F))


@lru_cache(maxsize=2)
def encoder_of(path: str, by_pieces: bool) -> Encoder:
    """One encoder per worker process, whatever the number of its tasks."""
    return Encoder(path, by_pieces)


def _of_texts(ids: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
    """The ids of each text."""
    ends = np.cumsum(counts)
    for first, last in zip((ends - counts).tolist(), ends.tolist()):
        yield ids[first:last]


def _encoded(encoder: Encoder, batch: pa.RecordBatch) -> Iterator[tuple[int | None, np.ndarray, int]]:
    """``doc_id``, ids and ``part`` of the rows of a batch, encoded a slice at a time."""
    for rows, *_ in text_slices(batch.column("text")):
        doc_ids, parts = (batch.column(name)[rows].to_pylist() for name in ("doc_id", "part"))
        yield from zip(doc_ids, _of_texts(*encoder(batch.column("text")[rows])), parts)


def train_dictionary(docs: DataFrame, path: str, by_pieces: bool = True) -> bytes:
    """A dictionary for the ids of some different texts, chosen by hash; empty if there are too few.

    The driver gets at most ``SAMPLE_DOCS * SAMPLE_IDS`` ids, however often a text is repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, by_pieces)
        for batch in batches:
            for rows, *_ in text_slices(batch.column("text")):
                found = [own[:SAMPLE_IDS].tobytes() for own in _of_texts(*encoder(batch.column("text")[rows]))]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["ids"])

    drawn = drawn_texts(docs, SAMPLE_DOCS, "dictionary")
    sample = [bytes(r.ids) for r in drawn.mapInArrow(run, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sorted(sample), level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        # Too little to learn from: documents are compressed without a dictionary.
        return b""


def _hash(dictionary: bytes) -> str:
    return hashlib.sha256(dictionary).hexdigest()


def write_tokens(docs: DataFrame, folder: str, path: str, by_pieces: bool = True) -> None:
    """Encode all texts and write segments and dictionary below ``folder``."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = columns_or_null(docs, {"doc_id": "bigint", "text": "string"})
    dictionary = train_dictionary(docs, path, by_pieces)
    one = spark.range(1).select(
        F.lit(_hash(dictionary)).alias("dictionary_hash"), F.lit(bytearray(dictionary)).alias("dictionary")
    )
    one.write.parquet(f"{folder}/dictionary")

    def segment(part: int, number: int, first: int, ids: list, counts: list, frames: list, width: int) -> pa.RecordBatch:
        head = MAGIC + bytes([VERSION, width])
        offsets = np.cumsum([len(head), *map(len, frames)])
        longs = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                pa.array([number], pa.int32()),
                pa.array([first], pa.int64()),
                pa.array([ids], longs),
                pa.array([counts], longs),
                pa.array([offsets.tolist()], longs),
                pa.array([_hash(dictionary)]),
                pa.array([head + b"".join(frames)], pa.binary()),
            ],
            [f.split()[0] for f in _SEGMENTS.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, by_pieces)
        width = encoder.id_type.itemsize
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        part, number, first, held = None, 0, 0, ([], [], [])
        size = 0
        for batch in batches:
            for doc_id, own, at in _encoded(encoder, batch):
                if held[0] and (at != part or size >= SEGMENT_BYTES):
                    yield segment(part, number, first, *held, width)
                    number, first, size, held = number + 1, first + sum(held[1]), 0, ([], [], [])
                if at != part:
                    part, number, first = at, 0, 0
                frame = compressor.compress(own.tobytes())
                for values, value in zip(held, (doc_id, len(own), frame)):
                    values.append(value)
                size += len(frame)
        if held[0]:
            yield segment(part, number, first, *held, width)

    # An id that fills whole ranges, such as null, is dealt on by the hash its rows are ordered by.
    docs = docs.withColumn("tie", F.xxhash64("text"))
    parts = with_parts(docs, tie=F.shiftright("tie", 56) + 128)
    ordered = parts.repartition("part").sortWithinPartitions("part", "order_id", "tie")
    ordered.select("doc_id", "text", "part").mapInArrow(run, _SEGMENTS).write.parquet(f"{folder}/segments")


def _dictionary(spark: SparkSession, folder: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    return row.dictionary_hash, bytes(row.dictionary)


def documents_of(payload: bytes, offsets: list[int], dictionary: bytes, which=None) -> Iterator[np.ndarray]:
    """Ids of some documents of a segment (all by default), each from its own frame."""
    if payload[: len(MAGIC)] != MAGIC or payload[len(MAGIC)] != VERSION:
        raise ValueError("this is not a payload of token ids")
    id_type = np.dtype(f"<u{payload[len(MAGIC) + 1]}")
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    reader = zstandard.ZstdDecompressor(dict_data=shared)
    for i in range(len(offsets) - 1) if which is None else which:
        yield np.frombuffer(reader.decompress(payload[offsets[i] : offsets[i + 1]]), id_type)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document, read from the files."""
    name, dictionary = _dictionary(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, starts, ids in _read(batches, name, dictionary):
            arrays = [pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array([len(i) for i in ids], pa.int64())]
            arrays.append(pa.array([i.astype(np.int64) for i in ids], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids"])

    return _located(spark, folder).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids array<bigint>")


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read from the files."""
    name, dictionary = _dictionary(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, starts, ids in _read(batches, name, dictionary):
            arrays = [pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array([len(i) for i in ids], pa.int64())]
            arrays.append(pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in ids], pa.int64()))
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _located(spark, folder).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _read(batches: Iterator[pa.RecordBatch], name: str, dictionary: bytes):
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
            if row["dictionary_hash"] != name:
                raise ValueError("a segment was written with another dictionary")
            ids = list(documents_of(row["payload"], row["offsets"], dictionary))
            counts = np.array([len(x) for x in ids], np.int64)
            if counts.tolist() != row["n_tokens"]:
                raise ValueError("a segment does not hold what its index says")
            yield row["doc_ids"], row["start"] + np.cumsum(counts) - counts, ids


def _located(spark: SparkSession, folder: str) -> DataFrame:
    """Segments with ``start``, the ids of all segments before; one line per range decides it."""
    segments = spark.read.schema(_SEGMENTS).parquet(f"{folder}/segments")
    tokens = F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda total, n: total + n)
    totals = segments.groupBy("part").agg(F.sum(tokens).alias("tokens"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    # As many lines as ranges, which is one for each ROWS_PER_PART rows.
    located = segments.join(F.broadcast(bases), "part")
    return located.select(
        (F.col("base") + F.col("first_token")).alias("start"),
        "doc_ids", "n_tokens", "offsets", "dictionary_hash", "payload",
    )


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/tokens"
    write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizer())
    return token_digests(spark, folder)
