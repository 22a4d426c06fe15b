"""What purges changed in a table since it was delivered.

A purge never changes or deletes a file. It writes surviving rows to a new folder, then writes one
small Parquet file to ``<publish folder>/purge_log/<run>``. That file says, for each purged table, which
files no longer belong to it (``without``), which folder of an earlier purge has lost its last file
(``gone``), and which folder joined it, with its schema (``with``). That one file is the commit: readers
see the old state of every table before it and the new state of every table after it. Rows that are
later appended to the delivered table are part of it as usual.
"""

from __future__ import annotations

import json
from collections import Counter, defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = (
    "run string, target string, delivered string, change string, base string, path string, schema string"
)

FILE_PATH = "_metadata.file_path"

_WIDER = {
    (narrow, wide)
    for order in (("byte", "short", "integer", "long"), ("float", "double"))
    for i, narrow in enumerate(order)
    for wide in order[i + 1 :]
}


@dataclass(frozen=True)
class Scan:
    """Rows of a table that lie in one place: as delivered, or in the folder of a purge."""

    base: str
    rows: DataFrame


@dataclass
class Changes:
    """Files that left a place, as ``_metadata.file_path`` names them, and folders that joined."""

    without: dict[str, list[str]] = field(default_factory=lambda: defaultdict(list))
    joined: dict[str, T.StructType] = field(default_factory=dict)
    gone: set[str] = field(default_factory=set)
    locations: set[str] = field(default_factory=set)

    def apply(self, spark: SparkSession, location: str, delivered: DataFrame, from_folder: bool) -> list[Scan]:
        """The scans that make up the table now, given the delivered one.

        Files are told apart by their full path, so a purged table has to be read from where it was
        purged: by another name of the same place, the files that left it would not be recognised.
        Columns that only rewritten files are known to have are columns of the table.
        """
        if self.locations - {location}:
            raise ValueError(f"{location} was purged as {', '.join(sorted(self.locations))}")
        schema = delivered.schema
        for known in self.joined.values():
            schema = merged_schema(schema, known)
        if from_folder and schema != delivered.schema:
            delivered = spark.read.schema(schema).parquet(location)
        scans = [Scan(location, delivered)]
        scans += [
            Scan(folder, spark.read.schema(schema).parquet(folder))
            for folder in self.joined
            if folder not in self.gone
        ]
        return [
            Scan(scan.base, scan.rows.filter(~in_files(self.without[scan.base])))
            if self.without.get(scan.base)
            else scan
            for scan in scans
        ]


def merged_schema(first: T.StructType, second: T.StructType) -> T.StructType:
    """All columns of both, each with the wider type; an error for types that do not go together."""
    fields = {f.name.lower(): f for f in first.fields}
    for other in second.fields:
        own = fields.get(other.name.lower())
        kinds = own and (own.dataType.typeName(), other.dataType.typeName())
        if own is None or kinds in _WIDER:
            fields[other.name.lower()] = T.StructField(own.name if own else other.name, other.dataType, True)
        elif own.dataType != other.dataType and kinds[::-1] not in _WIDER:
            raise TypeError(f"column {other.name!r} is {kinds[0]} in some files and {kinds[1]} in others")
    return T.StructType(list(fields.values()))


def log_folder(folder: str) -> str:
    return f"{folder.rstrip('/')}/purge_log"


def data_folder(folder: str, run: str, table: str) -> str:
    return f"{folder.rstrip('/')}/purge_data/{run}/{table}"


def in_files(paths: Iterable[str]) -> Column:
    """True for the rows of some files. Spark drops the other files when it plans the scan.

    Built as one SQL expression: a call into the JVM per path takes seconds for some thousand paths.
    """
    escaped = (path.replace("\\", "\\\\").replace("'", "\\'") for path in paths)
    listed = ", ".join(f"'{path}'" for path in escaped)
    return F.expr(f"{FILE_PATH} IN ({listed})")


def published_runs(spark: SparkSession, folder: str) -> frozenset[str]:
    """The runs in the log, by a listing of its files; nothing is read."""
    try:
        files = spark.read.schema(LOG_SCHEMA).parquet(f"{log_folder(folder)}/*").inputFiles()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return frozenset()
        raise
    return frozenset(file.split("/")[-2] for file in files)


def read_changes(
    spark: SparkSession, folder: str, tables: Sequence[str]
) -> dict[str, Changes]:
    """The changes of each table that was purged. They come to the driver, where Spark plans reads.

    Their number grows with the files that purges touched, not with the table.
    """
    try:
        log = spark.read.schema(LOG_SCHEMA).parquet(f"{log_folder(folder)}/*")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    names = {table.lower(): table for table in tables}
    changes = defaultdict(Changes)
    for entry in log.filter(F.lower("target").isin(*names)).collect():
        table = changes[names[entry.target.lower()]]
        table.locations.add(entry.delivered)
        if entry.change == "with":
            table.joined[entry.path] = T.StructType.fromJson(json.loads(entry.schema))
        elif entry.change == "gone":
            table.gone.add(entry.base)
        else:
            table.without[entry.base].append(entry.path)
    for name, table in changes.items():
        for paths in table.without.values():
            path, times = Counter(paths).most_common(1)[0]
            if times > 1:
                raise RuntimeError(
                    f"two purges of {name!r} replaced {path} at the same time; "
                    f"take the folder of one of them out of {log_folder(folder)}"
                )
    return dict(changes)


def write_changes(changes: DataFrame, folder: str, run: str) -> None:
    """Commit changes: they become visible together, as one file in a folder of their own."""
    one_file = changes.coalesce(1).write.option("maxRecordsPerFile", 0)
    one_file.parquet(f"{log_folder(folder)}/{run}")
