"""The purge groups: which derived tables are cleaned together, in which order and by which id."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class PurgeEntry:
    table: str
    key: str
    active: bool = True


@dataclass(frozen=True)
class PurgeGroup:
    """An ordered list of tables. An atomic group takes effect as a whole or not at all."""

    name: str
    atomic: bool
    entries: tuple[PurgeEntry, ...]

    def __post_init__(self) -> None:
        tables = [entry.table.lower() for entry in self.entries]
        if len(set(tables)) < len(tables):
            raise ValueError(f"purge group {self.name!r} lists a table twice")

    @property
    def active(self) -> tuple[PurgeEntry, ...]:
        return tuple(entry for entry in self.entries if entry.active)

    def with_optional(self) -> PurgeGroup:
        """The same group with the entries that are off by default switched on."""
        entries = tuple(replace(entry, active=True) for entry in self.entries)
        return replace(self, entries=entries)


def _group(name: str, atomic: bool, active: list, optional: list = ()) -> PurgeGroup:
    entries = [PurgeEntry(table, key) for table, key in active]
    entries += [PurgeEntry(table, key, active=False) for table, key in optional]
    return PurgeGroup(name, atomic, tuple(entries))


# Table names, keys and order of the four groups.

VOICE = _group(
    "voice",
    atomic=True,
    active=[
        ("lcc_position", "sessionid"),
        ("lcc_timelink_position", "fileid"),
        ("lcc_Serving_Cell_Table", "sessionid"),
        ("lcc_markers_time", "sessionid"),
        ("lcc_Calls_Detailed", "sessionid"),
    ],
)

SCANNER = _group(
    "scanner",
    atomic=False,
    active=[
        ("lcc_scannerWcdma", "sessionid"),
        ("lcc_Scanner_LTE_Detailed", "sessionid"),
        ("lcc_Scanner_UMTS_Detailed", "sessionid"),
        ("lcc_Scanner_GSM_Detailed", "sessionid"),
    ],
    optional=[
        ("lcc_GSMScanner_allFreqs_allBCCH_50x50_probCobIndoor_ord", "fileid"),
        ("lcc_GSMScanner_allFreqs_allBCCH_50x50_probCobIndoor", "fileid"),
        ("lcc_UMTSScanner_allFreqs_allSC_50x50_probCobIndoor_ord", "fileid"),
        ("lcc_UMTSScanner_allFreqs_allSC_50x50_probCobIndoor", "fileid"),
        ("lcc_LTEScanner_allFreqs_allPCIS_50x50_probCobIndoor", "fileid"),
        ("lcc_LTEScanner_allFreqs_allPCIS_50x50_probCobIndoor_ord", "fileid"),
    ],
)

DATA = _group(
    "data",
    atomic=True,
    active=[
        ("lcc_position", "sessionid"),
        ("lcc_timelink_position", "fileid"),
        ("lcc_Serving_Cell_Table", "sessionid"),
        ("Lcc_Data_HTTPBrowser", "sessionid"),
        ("Lcc_Data_HTTPTransfer_DL", "sessionid"),
        ("Lcc_Data_HTTPTransfer_UL", "sessionid"),
        ("Lcc_Data_Latencias", "sessionid"),
        ("lcc_data_Youtube", "sessionid"),
        ("lcc_Physical_Info_Table", "sessionid"),
    ],
)

DATA_SMALL = _group(
    "data_small",
    atomic=False,
    active=[
        ("Lcc_Data_HTTPBrowser", "sessionid"),
        ("Lcc_Data_HTTPTransfer_DL", "sessionid"),
        ("Lcc_Data_HTTPTransfer_UL", "sessionid"),
        ("Lcc_Data_Latencias", "sessionid"),
        ("lcc_data_Youtube", "sessionid"),
    ],
    optional=[
        ("lcc_Serving_Cell_Table", "sessionid"),
        ("lcc_Physical_Info_Table", "sessionid"),
    ],
)

GROUPS = {group.name: group for group in (VOICE, SCANNER, DATA, DATA_SMALL)}
