"""Lookup of a collection's sessions and files, and removal of rows at or above a cutoff."""

from tailtrim.operators.sessions import (
    Cutoffs,
    cutoffs_from_lookup,
    join_sessions,
    lookup,
    lowest_ids,
    match_collections,
)
from tailtrim.operators.removal import doomed, survivors

__all__ = [
    "Cutoffs",
    "cutoffs_from_lookup",
    "doomed",
    "join_sessions",
    "lookup",
    "lowest_ids",
    "match_collections",
    "survivors",
]
