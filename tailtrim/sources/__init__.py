"""Where campaign tables are read from and where purged versions of them are published."""

from tailtrim.sources.campaign import Campaign, StoredTable, load, shared_folder

__all__ = ["Campaign", "StoredTable", "load", "shared_folder"]
