"""The purge groups as data."""

import pytest

from tailtrim.plans import DATA, DATA_SMALL, GROUPS, RECORDED_RUNS, SCANNER, VOICE, PurgeEntry, PurgeGroup


def test_active_entries():
    active = [entry for group in GROUPS.values() for entry in group.active]
    assert len(active) == 23
    assert len({entry.table for entry in active}) == 15
    assert [entry.table for entry in active if entry.key == "fileid"] == ["lcc_timelink_position"] * 2
    assert {entry.key for entry in active} == {"sessionid", "fileid"}
    assert [len(group.active) for group in (VOICE, SCANNER, DATA, DATA_SMALL)] == [5, 4, 9, 5]


def test_which_groups_are_atomic():
    assert {name for name, group in GROUPS.items() if group.atomic} == {"voice", "data"}


def test_optional_entries_are_off_until_asked_for():
    assert len(SCANNER.with_optional().active) == 10
    assert len(DATA_SMALL.with_optional().active) == 7
    assert VOICE.with_optional() == VOICE
    off = [entry for group in GROUPS.values() for entry in group.entries if not entry.active]
    assert len(off) == 8
    assert sum(entry.key == "fileid" for entry in off) == 6


def test_a_group_lists_a_table_once():
    with pytest.raises(ValueError, match="twice"):
        PurgeGroup("g", True, (PurgeEntry("a", "sessionid"), PurgeEntry("A", "fileid")))


def test_recorded_runs_name_known_groups_and_enough_cutoffs():
    assert [name for run in RECORDED_RUNS for name in run.groups] == list(GROUPS)
    for run in RECORDED_RUNS:
        for name in run.groups:
            for entry in GROUPS[name].active:
                assert run.cutoffs.of(entry.key) > 0
