"""A measurement campaign: one folder of Parquet tables, or one catalog database."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tailtrim.functions.predicates import key_type
from tailtrim.sources import published


@dataclass(frozen=True)
class StoredTable:
    """A table kept under another name, or with other column names, than the ones used here."""

    name: str
    # name used here -> name in the files
    columns: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Campaign:
    """The tables of one campaign.

    Give ``root`` for a folder that holds ``<table><suffix>`` Parquet tables, or ``database`` for a
    catalog database. Purges publish below ``publish_to``; a folder campaign publishes to its own
    folder by default, a catalog campaign without it can be looked up and dry-run only.

    Tables that were filled again with more columns hold files of different width. Spark takes the
    columns of one file; ``merge_schema`` takes those of all, at the price of a job that reads every
    footer when a table is loaded. A catalog declares the columns itself.
    """

    root: str | None = None
    database: str | None = None
    publish_to: str | None = None
    suffix: str = ".parquet"
    stored: Mapping[str, StoredTable] = field(default_factory=dict)
    merge_schema: bool = False

    def __post_init__(self) -> None:
        if (self.root is None) == (self.database is None):
            raise ValueError("a campaign is either a folder (root) or a catalog database")

    @property
    def publish_folder(self) -> str | None:
        return self.publish_to or self.root

    def stored_table(self, table: str) -> StoredTable:
        return self.stored.get(table, StoredTable(table))

    def stored_column(self, table: str, column: str) -> str:
        return self.stored_table(table).columns.get(column, column)

    def location(self, table: str) -> str:
        """The catalog name or the folder of a table as it was delivered."""
        name = self.stored_table(table).name
        if self.database is not None:
            return f"{self.database}.{name}".lower()
        return f"{self.root.rstrip('/')}/{name}{self.suffix}"

    def changes(self, spark: SparkSession, tables: Sequence[str]) -> dict[str, published.Changes]:
        """What purges changed in some tables; the purge log is read once for all."""
        if self.publish_folder is None:
            return {}
        return published.read_changes(spark, self.publish_folder, tables)

    def scans(
        self,
        spark: SparkSession,
        tables: Sequence[str],
        changes: Mapping[str, published.Changes] | None = None,
    ) -> dict[str, list[published.Scan]]:
        """The scans whose rows make up each table now, or after the given changes."""
        if changes is None:
            changes = self.changes(spark, tables)
        locations = {table: self.location(table) for table in tables}
        files = spark.read.option("mergeSchema", self.merge_schema)
        read = files.parquet if self.database is None else spark.table
        delivered = {location: read(location) for location in dict.fromkeys(locations.values())}
        unchanged = published.Changes()
        return {
            table: changes.get(table, unchanged).apply(
                spark, location, delivered[location], self.database is None
            )
            for table, location in locations.items()
        }


def load(
    spark: SparkSession, campaign: Campaign, table: str, keys: Sequence[str] = ()
) -> DataFrame:
    """One table of a campaign, without the rows purges removed; ``keys`` must be numeric columns."""
    return load_all(spark, campaign, [table], keys)[table]


def load_all(
    spark: SparkSession, campaign: Campaign, tables: Sequence[str], keys: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """Several tables of a campaign as of one moment, see :func:`load`."""
    loaded = {}
    for table, scans in campaign.scans(spark, tables).items():
        rows = reduce(DataFrame.unionByName, [scan.rows for scan in scans])
        names = {kept: used for used, kept in campaign.stored_table(table).columns.items()}
        rows = rows.withColumnsRenamed(names)
        for key in keys:
            key_type(rows, key)
        loaded[table] = rows
    return loaded


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return named.rstrip("/")
