"""Clean-up of measurement-campaign tables on Spark: look up a collection, purge what came after."""

from tailtrim.operators import (
    Cutoffs,
    cutoffs_from_lookup,
    doomed,
    join_sessions,
    lookup,
    match_collections,
    survivors,
)
from tailtrim.plans import GROUPS, PurgeEntry, PurgeGroup, clean_up, purge
from tailtrim.sources import Campaign, StoredTable, load

__all__ = [
    "GROUPS",
    "Campaign",
    "Cutoffs",
    "PurgeEntry",
    "PurgeGroup",
    "StoredTable",
    "clean_up",
    "cutoffs_from_lookup",
    "doomed",
    "join_sessions",
    "load",
    "lookup",
    "match_collections",
    "purge",
    "survivors",
]
