"""Remove the rows at or above a campaign's cutoffs from every table of a purge group.

Files without such a row stay in the table as they are. Files with one leave the table, and their
surviving rows are written to new files, without a shuffle and with all columns that any of these
files has; a file whose rows all go is not read again. So a purge of the tail of a table that grew in id order rewrites the
few files around the cutoff, whatever the size of the table.
"""

from __future__ import annotations

import math
import uuid
from collections import defaultdict
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tailtrim.functions.literals import literal_rows
from tailtrim.functions.predicates import at_or_above
from tailtrim.operators.removal import doomed, survivors
from tailtrim.operators.sessions import Cutoffs
from tailtrim.plans.groups import PurgeEntry, PurgeGroup
from tailtrim.sources.campaign import Campaign
from tailtrim.sources.published import (
    FILE_PATH,
    LOG_SCHEMA,
    Changes,
    Scan,
    data_folder,
    in_files,
    published_runs,
    read_changes,
    write_changes,
)

REPORT_SCHEMA = "target string, key string, cutoff double, removed bigint, kept bigint"

# Rows of a rewritten file, so that scattered purges do not leave many small files behind.
ROWS_PER_FILE = 10_000_000

# Tables of a group that are counted and rewritten at the same time.
CONCURRENT_REWRITES = 4


@dataclass(frozen=True)
class _Target:
    """One table to purge: its scans, and the key column under the name it has in them."""

    entry: PurgeEntry
    cutoff: float
    location: str
    stored_key: str
    scans: list[Scan]
    in_catalog: bool = False

    @property
    def table(self) -> str:
        return self.entry.table

    def doomed(self, scan: DataFrame) -> DataFrame:
        return doomed(scan, self.stored_key, self.cutoff)

    def line(self, rows: int, removed: int) -> tuple:
        """This table's line of the report."""
        return (self.table, self.entry.key, self.cutoff, removed, rows - removed)


def purge(
    spark: SparkSession,
    campaign: Campaign,
    group: PurgeGroup,
    cutoffs: Cutoffs,
    atomic: bool | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Purge a group and report ``target, key, cutoff, removed, kept`` per table.

    ``atomic`` overrides the group's own rule: all tables are published together, or each one as
    soon as it is done, in the order of the group. A dry run only reports.
    """
    for entry in group.active:
        cutoffs.of(entry.key)
    if not dry_run and campaign.publish_folder is None:
        raise ValueError("give the catalog campaign a folder to publish to, or ask for a dry run")
    if dry_run:
        return literal_rows(
            spark, _count_only(_targets(spark, campaign, group.active, cutoffs)), REPORT_SCHEMA
        )
    together = group.atomic if atomic is None else atomic
    return literal_rows(spark, _purge(spark, campaign, group.active, cutoffs, together), REPORT_SCHEMA)


def _purge(
    spark: SparkSession, campaign: Campaign, entries: Sequence[PurgeEntry], cutoffs: Cutoffs, together: bool
) -> list[tuple]:
    """Purge some tables, published in one step or one after the other; their lines of the report.

    The log is read once, before the first table. Tables are prepared at the same time, which writes
    new files that nobody reads yet, and committed in order: the first failure ends the commits.
    """
    folder = campaign.publish_folder
    known = published_runs(spark, folder)
    changes = campaign.changes(spark, [entry.table for entry in entries])

    def prepare(entry: PurgeEntry, run: str) -> _Prepared:
        targets = _targets(spark, campaign, [entry], cutoffs, changes)
        counts = _counts(targets)
        touched = [target for target in targets if counts[target.table].touched]
        schemas = {}
        if touched:
            schemas = _rewrite(spark, folder, run, touched, counts)
            _check_written(spark, folder, run, schemas, counts)
        return _Prepared(run, targets, touched, counts, schemas)

    run = uuid.uuid4().hex
    pool = ThreadPoolExecutor(CONCURRENT_REWRITES)
    try:
        work = inheritable_thread_target(spark)(prepare)
        started = [pool.submit(work, entry, run if together else uuid.uuid4().hex) for entry in entries]
        ready = (future.result() for future in started)
        batches = [_joined(list(ready))] if together else ready
        report = []
        for batch in batches:
            if batch.touched:
                _check_unchanged(spark, folder, batch.touched, batch.counts, known)
                _publish(spark, folder, batch.run, batch.touched, batch.counts, batch.schemas)
                known |= {batch.run}
            report += batch.report()
        return report
    finally:
        pool.shutdown(cancel_futures=True)


def _targets(
    spark: SparkSession,
    campaign: Campaign,
    entries: Sequence[PurgeEntry],
    cutoffs: Cutoffs,
    changes: Mapping[str, Changes] | None = None,
) -> list[_Target]:
    scans = campaign.scans(spark, [entry.table for entry in entries], changes)
    return [
        _Target(
            entry,
            float(cutoffs.of(entry.key)),
            campaign.location(entry.table),
            campaign.stored_column(entry.table, entry.key),
            scans[entry.table],
            campaign.database is not None,
        )
        for entry in entries
    ]


@dataclass(frozen=True)
class _File:
    """A file with doomed rows: how many rows it holds, and how many of them go."""

    path: str
    rows: int
    removed: int


@dataclass
class _Counts:
    """Rows of a table, rows that go, and the files of each of its places that hold such rows."""

    rows: int = 0
    removed: int = 0
    touched: dict[str, list[_File]] = field(default_factory=dict)
    rows_of: dict[str, int] = field(default_factory=dict)

    @property
    def kept_of_touched(self) -> int:
        return sum(file.rows - file.removed for files in self.touched.values() for file in files)


@dataclass(frozen=True)
class _Prepared:
    """Tables whose surviving rows are written under a run, ready to be published."""

    run: str
    targets: list[_Target]
    touched: list[_Target]
    counts: dict[str, _Counts]
    schemas: dict[str, T.StructType]

    def report(self) -> list[tuple]:
        return [t.line(self.counts[t.table].rows, self.counts[t.table].removed) for t in self.targets]


def _joined(parts: Sequence[_Prepared]) -> _Prepared:
    """Several tables of one run as one."""
    return _Prepared(
        parts[0].run,
        [target for part in parts for target in part.targets],
        [target for part in parts for target in part.touched],
        {table: counts for part in parts for table, counts in part.counts.items()},
        {table: schema for part in parts for table, schema in part.schemas.items()},
    )


def _count_only(targets: Sequence[_Target]) -> list[tuple]:
    """The report of a purge that does not take place: one aggregate per scan, no file is named."""
    parts = [
        scan.rows.agg(
            F.count("*").alias("rows"),
            F.count_if(at_or_above(scan.rows, target.stored_key, target.cutoff)).alias("removed"),
        ).select(F.lit(number).alias("target"), "rows", "removed")
        for number, target in enumerate(targets)
        for scan in target.scans
    ]
    rows, removed = [0] * len(targets), [0] * len(targets)
    for line in reduce(DataFrame.unionAll, parts).collect():
        rows[line.target] += line.rows
        removed[line.target] += line.removed
    return [target.line(*found) for target, *found in zip(targets, rows, removed)]


def _rows_per_file(targets: Sequence[_Target]) -> DataFrame:
    """``target, scan, path, removed`` of every file with doomed rows.

    Only the key column is read, of the row groups that reach the cutoff, and only doomed rows are
    counted by file; what is shuffled is a line per file and task.
    """
    parts = [
        target.doomed(scan.rows).select(
            F.lit(target.table).alias("target"), F.lit(number).alias("scan"), F.col(FILE_PATH).alias("path")
        )
        for target in targets
        for number, scan in enumerate(target.scans)
    ]
    return reduce(DataFrame.unionAll, parts).groupBy("target", "scan", "path").agg(F.count("*").alias("removed"))


def _whole_counts(targets: Sequence[_Target]) -> DataFrame:
    """``target, scan, path, removed`` with the rows of each scan in place of removed, and no path.

    They are counted from the footers.
    """
    parts = [
        scan.rows.agg(F.count("*").alias("removed")).select(
            F.lit(target.table).alias("target"), F.lit(number).alias("scan"),
            F.lit(None).cast("string").alias("path"), "removed",
        )
        for target in targets
        for number, scan in enumerate(target.scans)
    ]
    return reduce(DataFrame.unionAll, parts)


def _counts(targets: Sequence[_Target]) -> dict[str, _Counts]:
    """Counts of each table. Names of files with doomed rows come to the driver, which plans the read
    of each anyway; the rows of those files alone are counted by file, from their footers.
    """
    counts: dict[str, _Counts] = defaultdict(_Counts)
    scans = {target.table: target.scans for target in targets}
    removed: dict[tuple[str, str], dict[str, int]] = defaultdict(dict)
    for line in _whole_counts(targets).unionAll(_rows_per_file(targets)).collect():
        table, base = counts[line.target], scans[line.target][line.scan].base
        if line.path is None:
            table.rows += line.removed
            table.rows_of[base] = line.removed
        else:
            table.removed += line.removed
            removed[line.target, base][line.path] = line.removed
    if removed:
        rows = {(table, scan.base): scan.rows for table, own in scans.items() for scan in own}
        by_file = [
            rows[place].filter(in_files(files)).groupBy(F.col(FILE_PATH).alias("path")).count()
            for place, files in removed.items()
        ]
        sizes = {line.path: line["count"] for line in reduce(DataFrame.unionAll, by_file).collect()}
        for (table, base), files in removed.items():
            counts[table].touched[base] = [_File(path, sizes[path], gone) for path, gone in files.items()]
    return counts


def _partial(files: Sequence) -> list[str]:
    """The files of which some rows stay."""
    return [file.path for file in files if file.rows > file.removed]


def _touched_rows(spark: SparkSession, target: _Target, scan: Scan, paths: list[str]) -> DataFrame:
    """Rows of some files of a table, with every column that any of them has.

    Their footers alone are merged; types that cannot be merged are an error. A catalog says itself
    which columns a table has.
    """
    if target.in_catalog and scan.base == target.location:
        return scan.rows.filter(in_files(paths))
    reader = spark.read.option("mergeSchema", "true")
    if _partition_columns(scan.base, paths):
        reader = reader.option("basePath", scan.base)
    return reader.parquet(*[unquote(path) for path in paths])


def _partition_columns(base: str, paths: Sequence[str]) -> list[str]:
    """Names of the partition folders between a place and its files, as ``name=value`` gives them."""
    inner = unquote(paths[0]).rpartition(base.rstrip("/").rpartition("/")[2])[2]
    return [unquote(part.partition("=")[0]) for part in inner.split("/")[:-1] if "=" in part]


def _rewrite(
    spark: SparkSession,
    folder: str,
    run: str,
    targets: Sequence[_Target],
    counts: dict[str, _Counts],
) -> dict[str, T.StructType]:
    """Write the surviving rows of the touched files of each table to a new folder.

    Returns the schema written, for the tables of whose touched files some rows stay.
    """

    def write(target: _Target) -> tuple[str, T.StructType] | None:
        count = counts[target.table]
        parts = [
            _touched_rows(spark, target, scan, paths)
            for scan in target.scans
            if (paths := _partial(count.touched.get(scan.base, [])))
        ]
        if not parts:
            return None
        rows = parts[0]
        for more in parts[1:]:
            rows = rows.unionByName(more, allowMissingColumns=True)
        lost = {c.lower() for scan in target.scans for c in scan.rows.columns} - {c.lower() for c in rows.columns}
        kept = survivors(rows, target.stored_key, target.cutoff)
        # Columns of the table that none of these files has are null in them, and stay null.
        kept = kept.withColumns(
            {f.name: F.lit(None).cast(f.dataType) for f in target.scans[0].rows.schema if f.name.lower() in lost}
        )
        tasks = math.ceil(count.kept_of_touched / ROWS_PER_FILE)
        kept = kept.coalesce(max(tasks, spark.sparkContext.defaultParallelism))
        writer = kept.write
        base, files = next(iter(count.touched.items()))
        if columns := _partition_columns(base, [file.path for file in files]):
            writer = writer.partitionBy(*columns)
        writer.parquet(data_folder(folder, run, target.table))
        return target.table, kept.schema

    return dict(found for target in targets if (found := write(target)))


def _check_written(
    spark: SparkSession,
    folder: str,
    run: str,
    schemas: dict[str, T.StructType],
    counts: dict[str, _Counts],
) -> None:
    """The new files must hold the rows of the old ones less the doomed ones, and all their columns;
    else nothing is published.
    """
    if not schemas:
        return
    new = {table: spark.read.parquet(data_folder(folder, run, table)) for table in schemas}
    lines = [
        rows.agg(F.lit(table).alias("table"), F.count("*").alias("n")) for table, rows in new.items()
    ]
    found = {line.table: line.n for line in reduce(DataFrame.unionAll, lines).collect()}
    for table, schema in schemas.items():
        written, expected = found[table], counts[table].kept_of_touched
        if written != expected:
            raise RuntimeError(f"{table}: wrote {written} of {expected} rows to keep")
        missing = {c.lower() for c in schema.names} - {c.lower() for c in new[table].columns}
        if written and missing:
            raise RuntimeError(f"{table}: columns {', '.join(sorted(missing))} were not written")


def _check_unchanged(
    spark: SparkSession,
    folder: str,
    targets: Sequence[_Target],
    counts: dict[str, _Counts],
    known: frozenset[str],
) -> None:
    """Refuse to publish if another purge has replaced one of the touched files meanwhile.

    The log is only listed, and read if it holds runs beside the known ones.
    """
    if published_runs(spark, folder) <= known:
        return
    changes = read_changes(spark, folder, [target.table for target in targets])
    for target in targets:
        now = changes.get(target.table)
        for base, files in counts[target.table].touched.items():
            replaced = set(now.without.get(base, ())) if now else set()
            if (now and base in now.gone) or any(file.path in replaced for file in files):
                raise RuntimeError(f"another purge replaced files of {target.table!r} at the same time")


def _publish(
    spark: SparkSession,
    folder: str,
    run: str,
    targets: Sequence[_Target],
    counts: dict[str, _Counts],
    schemas: dict[str, T.StructType],
) -> None:
    """Commit the purge of all tables at once.

    A folder of an earlier purge that lost its last file takes one line, whatever its files; files of
    the delivered place are named, since it may get new ones.
    """
    lines = []
    for target in targets:
        count, of = counts[target.table], (run, target.table, target.location)
        for base, files in count.touched.items():
            if base != target.location and sum(file.rows for file in files) == count.rows_of[base]:
                lines.append((*of, "gone", base, None, None))
            else:
                lines += [(*of, "without", base, file.path, None) for file in files]
        if target.table in schemas:
            joined = data_folder(folder, run, target.table)
            lines.append((*of, "with", joined, joined, schemas[target.table].json()))
    write_changes(spark.createDataFrame(lines, LOG_SCHEMA), folder, run)
