"""Chat formatting: records of different layouts become canonical turns, then one marked text.

A record is JSON. The paths of its fields (``messages[].role``, ``instruction`` and so on, with array
places left out) are sorted and hashed; this fingerprint of its schema selects a declarative mapping,
which says where roles and texts are. Fields a mapping does not know are ignored, so the fingerprint
is taken over the known paths; a record without a mapping has no turns and says so in ``layout``.

The template writes each turn as ``<|role|>`` on a line, the text, and ``<|end|>`` on a line. Inside roles
and texts every backslash is doubled, and a backslash is put after the ``<`` of a control string; so no
text can close its turn or open another one, and reading back removes what was put in. The mask of the
loss lists the spans of the assistant's texts, in code points of the formatted text.

A table of turns may hold rows of several layouts, too: rows that are a turn each, in columns of different
names, and rows that are a whole exchange, in flat or nested columns. The paths of a row are those of its
columns that are not null; a row without a text or a role is still a turn, so these paths may be missing.
Their fingerprint, computed in Spark, selects the mapping of the row, which makes the row its turns.

Turns are dealt out by conversation, sorted and formatted as a stream of pieces of whole turns,
so a task holds a batch and a piece however long a conversation is; the sort spills to disk. A piece holds
turns of one layout. Digests are
folded over the same stream, which makes a conversation one task's work, though not its memory's.

Defined results: a null or empty text is an empty turn, a null role is ``user``; turns of one number are
ordered by role and text; a record that is null or not JSON has no turns. Roles of other names for the
three parties are made canonical. A conversation with a null id is kept as one of its own. A row whose
paths no mapping has, such as one with texts in two layouts, has no turns; its conversation is still
there. Empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tailtrim.llm.common import columns_or_null, small_batches, table

# Code points of formatted text after which a piece ends with its turn.
PIECE_CHARS = 1 << 20

# Names of the three parties in common layouts.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns: in a list, or in single fields in this order."""

    name: str
    turns: str | None = None
    role: str | None = None
    text: str | None = None
    number: str | None = None
    # Role and field; fields of one role that follow each other are one turn.
    fields: tuple[tuple[str, str], ...] = ()

    @property
    def paths(self) -> list[str]:
        if self.turns is None:
            return [path for _, path in self.fields]
        return [f"{self.turns}[].{path}" for path in (self.role, self.text, self.number) if path]


MAPPINGS = (
    Mapping("rows", turns="turns", role="role", text="text", number="turn"),
    Mapping("messages", turns="messages", role="role", text="content"),
    Mapping("conversations", turns="conversations", role="from", text="value"),
    Mapping("prompt_response", fields=(("user", "prompt"), ("assistant", "response"))),
    Mapping("prompt_completion", fields=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("system_prompt_response", fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Mapping("instruction", fields=(("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction_input", fields=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("question_answer", fields=(("user", "question"), ("assistant", "answer"))),
    Mapping("nested_data", fields=(("user", "data.prompt"), ("assistant", "data.response"))),
)

# Layouts of the rows of a table, beside those above that keep an exchange in single fields.
ROW_MAPPINGS = (
    Mapping("rows", role="role", text="text", number="turn"),
    Mapping("rows_content", role="role", text="content", number="turn"),
    Mapping("rows_value", role="from", text="value", number="turn"),
    Mapping("rows_message", role="message.role", text="message.content", number="turn"),
    *[mapping for mapping in MAPPINGS if mapping.fields],
)

_KNOWN = {path for mapping in MAPPINGS for path in mapping.paths}


def paths(record: object, prefix: str = "") -> set[str]:
    """The paths of the leaves of a nested record; the places of a list are one."""
    if isinstance(record, dict):
        below = (paths(value, f"{prefix}.{key}" if prefix else key) for key, value in record.items())
        return set().union(*below)
    if isinstance(record, list):
        return set().union(*(paths(value, f"{prefix}[]") for value in record))
    return {prefix}


def fingerprint(found: set[str], known: set[str] = _KNOWN) -> str:
    """Hash of the field paths that any mapping knows."""
    return hashlib.sha256("\n".join(sorted(found & known)).encode()).hexdigest()[:16]


BY_FINGERPRINT = {fingerprint(set(mapping.paths)): mapping for mapping in MAPPINGS}


def _row_paths(mapping: Mapping) -> set[str]:
    return {path for path in (mapping.role, mapping.text, mapping.number, *[p for _, p in mapping.fields]) if path}


_KNOWN_IN_ROWS = {"turn"}.union(*(_row_paths(mapping) for mapping in ROW_MAPPINGS))


def _by_row_fingerprint() -> dict[str, int]:
    """Places in ``ROW_MAPPINGS`` by fingerprint; the first mapping that a set of paths fits has it."""
    found: dict[str, int] = {}
    for place, mapping in enumerate(ROW_MAPPINGS):
        every = sorted(_row_paths(mapping))
        # Of an exchange only the number may be missing or there; of a turn, each of its fields.
        sets = [set(every), {*every, "turn"}]
        if not mapping.fields:
            sets += [set(chosen) for size in range(len(every)) for chosen in combinations(every, size)]
        for own in sets:
            found.setdefault(fingerprint(own, _KNOWN_IN_ROWS), place)
    return found


BY_ROW_FINGERPRINT = _by_row_fingerprint()


def _leaves(schema: T.StructType, prefix: str = "") -> dict[str, Column]:
    """The leaves of nested columns by their paths."""
    found = {}
    for field in schema.fields:
        path = f"{prefix}.{field.name}" if prefix else field.name
        if isinstance(field.dataType, T.StructType):
            found |= _leaves(field.dataType, path)
        else:
            found[path] = F.col(".".join(f"`{part}`" for part in path.split(".")))
    return found


def turns_of_rows(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, place, role, text, layout, fingerprint`` of the turns of a table of any row layouts.

    ``layout`` is the place of the row's mapping in ``ROW_MAPPINGS``, null for a row without turns. Turns
    of a conversation are ordered by ``turn, exchange, place, role, text``.
    """
    leaves = _leaves(rows.schema)
    if "conv_id" not in leaves:
        raise ValueError("the table must have the column conv_id")
    own = {path: column.cast("string") for path, column in leaves.items() if path in _KNOWN_IN_ROWS}
    paths = F.concat_ws("\n", *[F.when(own[path].isNotNull(), F.lit(path)) for path in sorted(own)])
    places = F.create_map(*[F.lit(x) for pair in BY_ROW_FINGERPRINT.items() for x in pair])
    none = F.lit(None).cast("string")

    def listed(mapping: Mapping) -> Column:
        fields = mapping.fields or ((None, mapping.text),)
        turns: list[tuple[Column, Column]] = []
        last = None
        for role, path in fields:
            text = F.coalesce(own.get(path, none), F.lit(""))
            if role is not None and role == last:
                # Fields of one role that follow each other are one turn.
                turns[-1] = (turns[-1][0], F.concat(turns[-1][1], F.when(text == "", "").otherwise(F.concat(F.lit("\n\n"), text))))
            else:
                turns.append((F.lit(role) if role else F.coalesce(own.get(mapping.role, none), F.lit("")), text))
            last = role
        return F.array(*[F.struct(role.alias("role"), text.alias("text")) for role, text in turns])

    number = own.get("turn", none).cast("bigint")
    # Internal names may be those of columns, so each step selects what it needs.
    marked = rows.select(
        leaves["conv_id"].cast("bigint").alias("_conv_id"), F.substring(F.sha2(paths.cast("binary"), 256), 1, 16).alias("_fingerprint"), "*"
    )
    laid = marked.select(
        "_conv_id", "_fingerprint", number.alias("_turn"),
        *[column.alias(f"_p{i}") for i, column in enumerate(own.values())],
        places[F.col("_fingerprint")].alias("layout"),
    )
    own.update({path: F.col(f"_p{i}") for i, path in enumerate(list(own))})
    turns = F.lit(None).cast("array<struct<role:string,text:string>>")
    exchange = F.lit("")
    for place, mapping in enumerate(ROW_MAPPINGS):
        if _row_paths(mapping) & set(own) or place == 0:
            turns = F.when(F.col("layout") == place, listed(mapping)).otherwise(turns)
            if mapping.fields:
                key = F.concat_ws("\n", *[own.get(path, none) for _, path in mapping.fields])
                exchange = F.when(F.col("layout") == place, key).otherwise(exchange)
    told = laid.select(
        F.col("_conv_id").alias("conv_id"), F.col("_turn").alias("turn"), exchange.alias("exchange"),
        F.posexplode_outer(turns).alias("place", "one"), "layout", F.col("_fingerprint").alias("fingerprint"),
    )
    return told.select("conv_id", "turn", "exchange", "place", "one.role", "one.text", "layout", "fingerprint")


def _at(record: dict, path: str):
    for key in path.split("."):
        record = record.get(key) if isinstance(record, dict) else None
    return record


def _as_text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def canonical(record: object) -> tuple[str | None, list[tuple[str, str]]]:
    """The name of a record's layout and its turns of role and text."""
    mapping = BY_FINGERPRINT.get(fingerprint(paths(record))) if isinstance(record, dict) else None
    if mapping is None:
        return None, []
    if mapping.turns is not None:
        listed = [t for t in record[mapping.turns] if isinstance(t, dict)]
        if mapping.number:
            listed = sorted(
                listed,
                key=lambda t: (t.get(mapping.number) is not None, t.get(mapping.number) or 0,
                               _as_text(t.get(mapping.role)), _as_text(t.get(mapping.text))),
            )
        found = [(_as_text(t.get(mapping.role)) or "user", _as_text(t.get(mapping.text))) for t in listed]
        return mapping.name, [(ROLES.get(role, role), text) for role, text in found]
    turns: list[tuple[str, str]] = []
    for role, path in mapping.fields:
        text = _as_text(_at(record, path))
        if turns and turns[-1][0] == role:
            turns[-1] = (role, f"{turns[-1][1]}\n\n{text}" if text else turns[-1][1])
        else:
            turns.append((role, text))
    return mapping.name, turns


_CONTROL = re.compile(r"\\|<(?=\|)")
_ESCAPED = re.compile(r"\\\\|<\\")
_TURN = re.compile(r"<\|([^\n]*)\|>\n(.*?)\n<\|end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    """Double backslashes, and part the two characters that begin a control string."""
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else "<\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" if m[0] == "\\\\" else "<", text)


def _escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def _unescape_role(role: str) -> str:
    return re.sub(r"\\\\|<\\|\\n", lambda m: {"\\\\": "\\", "<\\": "<", "\\n": "\n"}[m[0]], role)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text of some turns, and the spans of the assistant's texts in it."""
    parts: list[str] = []
    spans, size = [], 0
    for role, text in turns:
        head, body = f"<|{_escape_role(role)}|>\n", escape(text)
        if role == "assistant":
            spans.append((size + len(head), size + len(head) + len(body)))
        parts += [head, body, "\n<|end|>\n"]
        size += sum(map(len, parts[-3:]))
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    turns, place = [], 0
    while place < len(formatted):
        match = _TURN.match(formatted, place)
        if match is None:
            raise ValueError(f"no turn begins at {place}")
        turns.append((_unescape_role(match[1]), unescape(match[2])))
        place = match.end()
    return turns


_FORMATTED = (
    "id bigint, layout string, fingerprint string, n_turns int, formatted string, "
    "mask array<struct<start:bigint,end:bigint>>"
)


def format_records(records: DataFrame) -> DataFrame:
    """Format a table of ``id`` and ``record``, JSON of any known layout.

    Returns ``id, layout, fingerprint, n_turns, formatted, mask``.
    """
    small_batches(records.sparkSession)
    records = columns_or_null(records, {"id": "bigint", "record": "string"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = []
            for text in batch.column("record").to_pylist():
                try:
                    record = json.loads(text) if text is not None else None
                except ValueError:
                    record = None
                layout, turns = canonical(record)
                formatted, spans = format_turns(turns)
                mask = [{"start": a, "end": b} for a, b in spans]
                lines.append((layout, fingerprint(paths(record)), len(turns), formatted, mask))
            columns = list(zip(*lines)) if lines else [[]] * 5
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            kinds = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.list_(span)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[pa.array(list(c), k) for c, k in zip(columns, kinds)]],
                ["id", "layout", "fingerprint", "n_turns", "formatted", "mask"],
            )

    return records.mapInArrow(run, _FORMATTED)


_PIECES = (
    "id bigint, layout string, fingerprint string, piece bigint, start bigint, n_turns int, formatted string, "
    "mask array<struct<start:bigint,end:bigint>>"
)


def format_rows(rows: DataFrame, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Format a table of turns in pieces: ``conv_id``, and columns of any of the layouts of rows.

    Returns ``id, layout, fingerprint, piece, start, n_turns, formatted, mask``: the pieces of a conversation
    put together by ``piece`` are its text. ``start`` and ``mask`` count code points of the whole text.
    The pieces of a conversation follow each other in one partition.
    """
    small_batches(rows.sparkSession)
    order = ["conv_id", "turn", "exchange", "place", "role", "text"]
    ordered = turns_of_rows(rows).repartition("conv_id").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: list[tuple] = []
        parts: list[str] = []
        spans: list[dict] = []
        own, piece, start, size, is_open = None, -1, 0, 0, False
        layout, schema = None, None

        def close() -> None:
            name = ROW_MAPPINGS[layout].name if layout is not None else None
            lines.append((own, name, schema, piece, start, len(parts), "".join(parts), list(spans)))
            parts.clear()
            spans.clear()

        def batch_of_lines() -> pa.RecordBatch:
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.list_(span)]
            columns = [pa.array(list(c), k) for c, k in zip(zip(*lines), kinds)]
            lines.clear()
            return pa.RecordBatch.from_arrays(
                columns, ["id", "layout", "fingerprint", "piece", "start", "n_turns", "formatted", "mask"]
            )

        for batch in batches:
            names = ("conv_id", "role", "text", "layout", "fingerprint")
            for conv_id, role, text, place, print_ in zip(*[batch.column(name).to_pylist() for name in names]):
                if piece < 0 or conv_id != own:
                    if is_open:
                        close()
                    own, piece, start, size, is_open = conv_id, 0, 0, 0, True
                    layout, schema = place, print_
                elif not is_open or (parts and place is not None and place != layout):
                    if is_open:
                        close()
                    piece, start, is_open = piece + 1, size, True
                    layout, schema = place, print_
                if place is None:
                    continue
                layout, schema = (place, print_) if not parts else (layout, schema)
                role = role or "user"
                formatted, found = format_turns([(ROLES.get(role, role), text)])
                parts.append(formatted)
                spans += [{"start": size + a, "end": size + b} for a, b in found]
                size += len(formatted)
                if size - start >= piece_chars:
                    close()
                    is_open = False
            if lines:
                yield batch_of_lines()
        if is_open:
            close()
        if lines:
            yield batch_of_lines()

    return ordered.mapInArrow(run, _PIECES)


_DIGEST = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint, layout string"
)


def digests(formatted: DataFrame) -> DataFrame:
    """What formatted texts and masks say when they are read back.

    Takes what :func:`format_rows` or :func:`format_records` returns; pieces are in order, from 0 on.
    """
    if "piece" not in formatted.columns:
        formatted = formatted.withColumns({"piece": F.lit(0), "start": F.lit(0)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "layout", "piece", "start", "formatted", "mask"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
        lines: list[tuple] = []
        current, whole, learned = None, None, None

        def close() -> None:
            conv_id, layout, turns, loss_chars, chars = current
            lines.append((conv_id, turns, whole.hexdigest(), loss_chars, learned.hexdigest(), chars, layout))

        def batch_of_lines() -> pa.RecordBatch:
            columns = [pa.array(list(c), k) for c, k in zip(zip(*lines), kinds)]
            lines.clear()
            return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _DIGEST.split(", ")])

        for batch in batches:
            for conv_id, layout, piece, start, text, mask in zip(*[batch.column(n).to_pylist() for n in names]):
                if piece == 0:
                    if current is not None:
                        close()
                    current, whole, learned = [conv_id, layout, 0, 0, 0], hashlib.sha256(), hashlib.sha256()
                turns = read_turns(text)
                for role, body in turns:
                    whole.update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                for span in mask:
                    body = unescape(text[span["start"] - start : span["end"] - start])
                    learned.update(body.encode("utf-8", "surrogatepass"))
                    current[3] += len(body)
                current[2] += len(turns)
                current[4] += len(text)
            if lines:
                yield batch_of_lines()
        if current is not None:
            close()
            yield batch_of_lines()

    return formatted.select("id", "layout", "piece", "start", "formatted", "mask").mapInArrow(run, _DIGEST)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = F.lit("\\### Assistant: </turn> ok")
    added = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), text.alias("text"),
    )
    return digests(format_rows(rows.unionByName(added)))
