"""Which sessions and files belong to the collections whose name matches a pattern."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailtrim.functions.predicates import name_like

# The file list is broadcast only when its measured size stays below this.
BROADCAST_BYTES = 64 * 1024 * 1024
# What a row costs in the broadcast hash table beyond the text of its name.
ROW_OVERHEAD_BYTES = 64
# A file id with more rows than this on one side of a shuffled join is split into several shares.
ROWS_PER_SHARE = 4_000_000


@dataclass(frozen=True)
class Cutoffs:
    """The lowest ids to remove in one campaign; some purge groups need no file cutoff."""

    session: float
    file: float | None = None

    def of(self, key: str) -> float:
        cutoff = {"sessionid": self.session, "fileid": self.file}[key]
        if cutoff is None:
            raise ValueError(f"no cutoff given for {key!r}")
        return cutoff


def match_collections(filelist: DataFrame, pattern: str, ignore_case: bool = False) -> DataFrame:
    """The files whose collection name is ``LIKE`` the pattern."""
    return filelist.filter(name_like("collectionname", pattern, ignore_case))


def join_sessions(
    filelist: DataFrame,
    sessions: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_share: int = ROWS_PER_SHARE,
) -> DataFrame:
    """``fileid, sessionid, collectionname`` of every pair of file and session with equal file id.

    Repeated rows on either side multiply, a missing file id matches nothing. The size of the file
    list is measured when the join is built, with one aggregate over it; ``broadcast_bytes=0`` leaves
    that out and always shuffles.
    """
    return _join(filelist, sessions, broadcast_bytes, rows_per_share).select(
        "fileid", "sessionid", "collectionname"
    )


def lookup(
    filelist: DataFrame,
    sessions: DataFrame,
    pattern: str,
    with_files: bool = True,
    ignore_case: bool = False,
    ordered: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_share: int = ROWS_PER_SHARE,
) -> DataFrame:
    """Sessions of the matching collections in ascending order, with or without their file ids.

    The order continues over the file id, the name and the input split the session came from, so
    that many rows of one session, even exact copies, spread over several sort tasks. Without an
    order the sort is left out, as for :func:`cutoffs_from_lookup`. Building it runs the aggregate of
    :func:`join_sessions` over the file list; with ``broadcast_bytes=0`` it is left out too.
    """
    matched = match_collections(filelist, pattern, ignore_case)
    found = _join(matched, sessions, broadcast_bytes, rows_per_share)
    if ordered:
        # A global sort samples its input before it shuffles it. Sampling the output of this
        # exchange keeps the sessions from being read and joined twice.
        exchanged = found.repartition("sessionid", "fileid", "_split")
        found = exchanged.orderBy(
            *[F.asc_nulls_first(c) for c in ("sessionid", "fileid", "collectionname", "_split")]
        )
    columns = ["fileid", "sessionid", "collectionname"]
    return found.select(columns if with_files else columns[1:])


def lowest_ids(found: DataFrame) -> DataFrame:
    """One row with the lowest id of each kind in a lookup; missing ids do not count.

    The two minima are independent: the first row of a lookup holds the lowest session, but not
    always the lowest file.
    """
    lowest = [F.min("sessionid").alias("min_session")]
    if "fileid" in found.columns:
        lowest.append(F.min("fileid").alias("min_file"))
    return found.agg(*lowest)


def cutoffs_from_lookup(found: DataFrame) -> Cutoffs:
    """The lowest ids of a lookup as cutoffs; an error if it found nothing."""
    lowest = lowest_ids(found).first().asDict()
    if lowest["min_session"] is None:
        raise ValueError("the lookup found no session, so there is no cutoff")
    return Cutoffs(lowest["min_session"], lowest.get("min_file"))


def _join(
    filelist: DataFrame, sessions: DataFrame, broadcast_bytes: int, rows_per_share: int
) -> DataFrame:
    files = filelist.select("fileid", "collectionname").filter(F.col("fileid").isNotNull())
    rows = (
        sessions.select("sessionid", "fileid")
        .filter(F.col("fileid").isNotNull())
        .withColumn("_split", F.spark_partition_id())
    )
    if broadcast_bytes > 0 and _measured_bytes(files) <= broadcast_bytes:
        # The sessions are then read once, where they are, and never shuffled for the join.
        return F.broadcast(files).join(rows, "fileid")
    files = files.withColumn("_split", F.spark_partition_id())
    hot = _shares(files, "_file_shares", rows_per_share).join(
        _shares(rows, "_session_shares", rows_per_share), "fileid", "full"
    )
    # A side has fewer hot ids than (its rows / rows_per_share). At the default this stays small at any
    # size; at a smaller setting Spark decides by size how to join it.
    if rows_per_share >= ROWS_PER_SHARE:
        hot = F.broadcast(hot)
    files = _split_hot(files, hot, "collectionname", "_file", "_session").drop("_split")
    rows = _split_hot(rows, hot, "sessionid", "_session", "_file")
    return files.join(rows, ["fileid", "_file_share", "_session_share"])


def _measured_bytes(files: DataFrame) -> int:
    name_bytes = F.coalesce(F.octet_length("collectionname"), F.lit(0))
    return files.agg(F.sum(name_bytes + ROW_OVERHEAD_BYTES)).first()[0] or 0


def _shares(side: DataFrame, name: str, rows_per_share: int) -> DataFrame:
    """The file ids with more than ``rows_per_share`` rows, and how many shares they need."""
    shares = F.ceil(F.count("*") / rows_per_share).cast("int")
    return side.groupBy("fileid").agg(shares.alias(name)).filter(F.col(name) > 1)


def _split_hot(
    side: DataFrame, hot: DataFrame, spread_by: str, own: str, other: str
) -> DataFrame:
    """Give each row of a hot file id one of its own side's shares, and a copy for each share of
    the other side, so that every pair still meets exactly once.

    The input split takes part in the choice, so exact copies are spread too, and a task that is run
    again makes the same choice.
    """
    own_shares = F.coalesce(f"{own}_shares", F.lit(1))
    other_shares = F.coalesce(f"{other}_shares", F.lit(1))
    return (
        side.join(hot, "fileid", "left")
        .withColumn(f"{own}_share", F.pmod(F.xxhash64(spread_by, "_split"), own_shares).cast("int"))
        .withColumn(f"{other}_share", F.explode(F.sequence(F.lit(0), other_shares - 1)))
        .drop("_file_shares", "_session_shares")
    )
