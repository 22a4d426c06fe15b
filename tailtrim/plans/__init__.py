"""Purge groups, the purge of a group, and the clean-up of a campaign from lookup to purge."""

from tailtrim.plans.cleanup import RECORDED_RUNS, RecordedRun, clean_up
from tailtrim.plans.groups import DATA, DATA_SMALL, GROUPS, SCANNER, VOICE, PurgeEntry, PurgeGroup
from tailtrim.plans.purging import purge

__all__ = [
    "DATA",
    "DATA_SMALL",
    "GROUPS",
    "RECORDED_RUNS",
    "SCANNER",
    "VOICE",
    "PurgeEntry",
    "PurgeGroup",
    "RecordedRun",
    "clean_up",
    "purge",
]
