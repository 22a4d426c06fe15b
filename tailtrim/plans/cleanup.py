"""The whole clean-up: look a collection up, take its lowest ids as cutoffs, purge."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tailtrim.functions.predicates import key_type
from tailtrim.operators.sessions import (
    BROADCAST_BYTES,
    ROWS_PER_SHARE,
    Cutoffs,
    cutoffs_from_lookup,
    lookup,
)
from tailtrim.plans.groups import PurgeGroup
from tailtrim.plans.purging import purge
from tailtrim.sources.campaign import Campaign, load_all


@dataclass(frozen=True)
class RecordedRun:
    """One use of the workflow: the campaign, what was looked up, and the cutoffs chosen by hand."""

    campaign: str
    pattern: str
    groups: tuple[str, ...]
    cutoffs: Cutoffs


# Campaigns, patterns and cutoffs of the recorded runs. They are examples; cutoffs
# belong to one campaign and there are no defaults.
RECORDED_RUNS = (
    RecordedRun("FY1617_Voice_Rest_4G_H2_7", "%calatayud%", ("voice", "scanner"), Cutoffs(38735, 291)),
    RecordedRun("FY1617_Data_Rest_4G_H2_5", "%calatayud%", ("data",), Cutoffs(3808, 137)),
    RecordedRun("FY1617_Data_AVE_Rest_H1", "%bcn-fig-r3%", ("data_small",), Cutoffs(5836)),
)


def find_sessions(
    spark: SparkSession,
    campaign: Campaign,
    pattern: str,
    with_files: bool = True,
    ignore_case: bool = False,
    ordered: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_share: int = ROWS_PER_SHARE,
) -> DataFrame:
    """The lookup on a campaign's own file list and sessions."""
    tables = load_all(spark, campaign, ["filelist", "sessions"], keys=["fileid"])
    key_type(tables["sessions"], "sessionid")
    return lookup(
        tables["filelist"],
        tables["sessions"],
        pattern,
        with_files,
        ignore_case,
        ordered,
        broadcast_bytes,
        rows_per_share,
    )


def clean_up(
    spark: SparkSession,
    campaign: Campaign,
    pattern: str,
    groups: Sequence[PurgeGroup],
    cutoffs: Cutoffs | None = None,
    ignore_case: bool = False,
    dry_run: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Purge groups of a campaign from the first session and file of a collection on.

    The lowest ids are fixed before anything is removed. Cutoffs given by hand win over them. As in
    the explicit purge, everything at or above a cutoff goes, whatever collection it belongs to.
    """
    if cutoffs is None:
        cutoffs = cutoffs_from_lookup(
            find_sessions(
                spark,
                campaign,
                pattern,
                ignore_case=ignore_case,
                ordered=False,
                broadcast_bytes=broadcast_bytes,
            )
        )
    reports = [purge(spark, campaign, group, cutoffs, dry_run=dry_run) for group in groups]
    return reduce(DataFrame.unionAll, reports)
