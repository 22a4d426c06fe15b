"""Queries of the clean-up library on the driver tables, with the SQL each one must agree with.

The driver tables stand in for campaign tables: customers are the file list, orders the sessions,
and lineitem, orders and events the derived tables, see ``FIXTURES.md``.
"""

from __future__ import annotations

import importlib
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailtrim.operators import (
    Cutoffs,
    doomed,
    join_sessions,
    lowest_ids,
    match_collections,
    survivors,
)
from tailtrim.plans import DATA, DATA_SMALL, SCANNER, VOICE, PurgeEntry, PurgeGroup, clean_up, purge
from tailtrim.plans.cleanup import find_sessions
from tailtrim.sources import Campaign, StoredTable, load, shared_folder
from tailtrim.sources.campaign import load_all

FULL_READS = ("full_read", "full_read_umts", "full_read_lte")

PATTERN = "%0014%"
ONE_CUSTOMER = "%000000149%"
CUTOFFS = Cutoffs(session=700, file=70)

# The driver table and key column behind each table of the purge groups.
STAND_INS = {
    "lcc_position": ("lineitem", "sessionid", "l_orderkey"),
    "lcc_timelink_position": ("orders", "fileid", "o_custkey"),
    "lcc_Serving_Cell_Table": ("orders", "sessionid", "o_orderkey"),
    "lcc_markers_time": ("events", "sessionid", "event_id"),
    "lcc_Calls_Detailed": ("lineitem", "sessionid", "l_orderkey"),
    "lcc_scannerWcdma": ("lineitem", "sessionid", "l_orderkey"),
    "lcc_Scanner_LTE_Detailed": ("orders", "sessionid", "o_orderkey"),
    "lcc_Scanner_UMTS_Detailed": ("lineitem", "sessionid", "l_orderkey"),
    "lcc_Scanner_GSM_Detailed": ("events", "sessionid", "event_id"),
    "lcc_GSMScanner_allFreqs_allBCCH_50x50_probCobIndoor_ord": ("orders", "fileid", "o_custkey"),
    "lcc_GSMScanner_allFreqs_allBCCH_50x50_probCobIndoor": ("orders", "fileid", "o_custkey"),
    "lcc_UMTSScanner_allFreqs_allSC_50x50_probCobIndoor_ord": ("orders", "fileid", "o_custkey"),
    "lcc_UMTSScanner_allFreqs_allSC_50x50_probCobIndoor": ("orders", "fileid", "o_custkey"),
    "lcc_LTEScanner_allFreqs_allPCIS_50x50_probCobIndoor": ("orders", "fileid", "o_custkey"),
    "lcc_LTEScanner_allFreqs_allPCIS_50x50_probCobIndoor_ord": ("orders", "fileid", "o_custkey"),
    "Lcc_Data_HTTPBrowser": ("lineitem", "sessionid", "l_orderkey"),
    "Lcc_Data_HTTPTransfer_DL": ("orders", "sessionid", "o_orderkey"),
    "Lcc_Data_HTTPTransfer_UL": ("events", "sessionid", "event_id"),
    "Lcc_Data_Latencias": ("lineitem", "sessionid", "l_orderkey"),
    "lcc_data_Youtube": ("orders", "sessionid", "o_orderkey"),
    "lcc_Physical_Info_Table": ("events", "sessionid", "event_id"),
}

# Tables that are only read, whole.
LAST_FILES = {
    "lcc_GSMScanner_allFreqs_allBCCH_50x50_probCobIndoor_LastFileid": ("customer", {}),
    "lcc_UMTSScanner_allFreqs_allSC_50x50_probCobIndoor_LastFileid": ("orders", {"fileid": "o_custkey"}),
    "lcc_LTEScanner_allFreqs_allPCIS_50x50_probCobIndoor_LastFileid": ("events", {"fileid": "user_id"}),
}

# A text column of a driver table, to be taken for a key by mistake.
NOT_A_KEY = {"lineitem": "l_returnflag", "orders": "o_orderstatus"}
# Orders of this status come without their priority in the delivery of two widths.
NARROW_STATUS = "F"


def stand_in_campaign(sf_dir: str, publish_to: str | None = None) -> Campaign:
    """The driver tables as one campaign."""
    stored = {
        table: StoredTable(name, {key: column}) for table, (name, key, column) in STAND_INS.items()
    }
    for table, (name, columns) in LAST_FILES.items():
        stored[table] = StoredTable(name, columns)
    stored["filelist"] = StoredTable("customer", {"fileid": "c_custkey", "collectionname": "c_name"})
    stored["sessions"] = StoredTable("orders", {"sessionid": "o_orderkey", "fileid": "o_custkey"})
    return Campaign(root=sf_dir, publish_to=publish_to, stored=stored)


def new_campaign(spark: SparkSession, sf_dir: str) -> Campaign:
    """The stand-in campaign, publishing to a new folder below the one the cluster shares."""
    return stand_in_campaign(sf_dir, f"{shared_folder(spark)}/tailtrim-{uuid.uuid4().hex}")


def optional(name: str):
    """A module that may have been left out of this copy of the library, or None."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as error:
        if error.name is not None and f"{name}.".startswith(f"{error.name}."):
            return None
        raise


llm_queries = optional("tailtrim.llm.queries")
corpus_pipeline = optional("corpus_pipeline") if llm_queries else None


def entry(spark: SparkSession) -> DataFrame:
    return lookup_sessions_files(spark, "/root/testdata/sf0.001")


def filter_collection_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    filelist = load(spark, stand_in_campaign(sf_dir), "filelist", keys=["fileid"])
    return match_collections(filelist, PATTERN).select("fileid", "collectionname")


def join_filelist_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = load_all(spark, stand_in_campaign(sf_dir), ["filelist", "sessions"], keys=["fileid"])
    return join_sessions(tables["filelist"], tables["sessions"])


def lookup_sessions_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_sessions(spark, stand_in_campaign(sf_dir), PATTERN)


def lookup_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_sessions(spark, stand_in_campaign(sf_dir), PATTERN, with_files=False)


def full_read(table: str) -> Callable[[SparkSession, str], DataFrame]:
    def whole_table(spark: SparkSession, sf_dir: str) -> DataFrame:
        return load(spark, stand_in_campaign(sf_dir), table)

    return whole_table


def doomed_by_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doomed(load(spark, Campaign(root=sf_dir), "lineitem"), "l_orderkey", CUTOFFS.session)


def doomed_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doomed(load(spark, Campaign(root=sf_dir), "orders"), "o_custkey", CUTOFFS.file)


def purge_by_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors(load(spark, Campaign(root=sf_dir), "lineitem"), "l_orderkey", CUTOFFS.session)


def purge_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors(load(spark, Campaign(root=sf_dir), "orders"), "o_custkey", CUTOFFS.file)


def cutoff_from_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lowest_ids(find_sessions(spark, stand_in_campaign(sf_dir), PATTERN, ordered=False))


def join_filelist_sessions_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join without broadcast, with so few rows to a share that most file ids are split."""
    tables = load_all(spark, stand_in_campaign(sf_dir), ["filelist", "sessions"], keys=["fileid"])
    return join_sessions(tables["filelist"], tables["sessions"], broadcast_bytes=0, rows_per_share=4)


def lookup_sessions_files_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_sessions(
        spark, stand_in_campaign(sf_dir), PATTERN, broadcast_bytes=0, rows_per_share=4
    )


def lookup_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ordered lookup with a pattern that every name matches, here in the other case."""
    return find_sessions(spark, stand_in_campaign(sf_dir), "%CUSTOMER%", ignore_case=True)


def filter_ignoring_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    filelist = load(spark, stand_in_campaign(sf_dir), "filelist", keys=["fileid"])
    found = match_collections(filelist, "%CUSTOMER%0014%", ignore_case=True)
    return found.select("fileid", "collectionname")


def compared(spark: SparkSession, sf_dir: str, campaign: Campaign, group: PurgeGroup) -> DataFrame:
    """Counts of each table of a group before and after a purge, and what its keys add up to."""
    tables = [entry.table for entry in group.active]
    before = load_all(spark, stand_in_campaign(sf_dir), tables)
    after = load_all(spark, campaign, tables)
    counted = [
        rows.select(
            F.lit(table).alias("target"),
            F.lit(b).alias("before"),
            F.lit(a).alias("kept"),
            (F.col(STAND_INS[table][1]) * a).cast("bigint").alias("key_sum"),
        )
        for table in tables
        for rows, b, a in ((before[table], 1, 0), (after[table], 0, 1))
    ]
    return (
        reduce(DataFrame.unionAll, counted)
        .groupBy("target")
        .agg(*[F.sum(c).alias(c) for c in ("before", "kept", "key_sum")])
        .select("target", (F.col("before") - F.col("kept")).alias("removed"), "kept", "key_sum")
    )


def cleanup_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Look one customer up, purge the voice group from there on, compare all its tables."""
    campaign = new_campaign(spark, sf_dir)
    clean_up(spark, campaign, ONE_CUSTOMER, [VOICE])
    return compared(spark, sf_dir, campaign, VOICE)


def cleanup_given_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean-up with cutoffs chosen by hand, which win over what the lookup finds."""
    campaign = new_campaign(spark, sf_dir)
    clean_up(spark, campaign, ONE_CUSTOMER, [VOICE], cutoffs=CUTOFFS)
    return compared(spark, sf_dir, campaign, VOICE)


def purge_report_voice_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a purge that takes place."""
    return purge(spark, new_campaign(spark, sf_dir), VOICE, CUTOFFS)


def purge_group(group: PurgeGroup) -> Callable[[SparkSession, str], DataFrame]:
    def published_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Publish the purged group, then count each published table against the delivered one."""
        campaign = new_campaign(spark, sf_dir)
        purge(spark, campaign, group, CUTOFFS)
        return compared(spark, sf_dir, campaign, group).drop("key_sum")

    return published_counts


def purge_report(group: PurgeGroup) -> Callable[[SparkSession, str], DataFrame]:
    def dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return purge(spark, stand_in_campaign(sf_dir), group, CUTOFFS, dry_run=True)

    return dry_run


def published_table(table: str, group: PurgeGroup) -> Callable[[SparkSession, str], DataFrame]:
    def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Publish the purged group, then read one of its tables back whole."""
        campaign = new_campaign(spark, sf_dir)
        purge(spark, campaign, group, CUTOFFS)
        _, key, column = STAND_INS[table]
        return load(spark, campaign, table).withColumnRenamed(key, column)

    return rows


def catalog_campaign(spark: SparkSession, sf_dir: str) -> Campaign:
    """The stand-in campaign as a new database of the catalog, whose tables are the driver's files."""
    folder = f"{shared_folder(spark)}/tailtrim-{uuid.uuid4().hex}"
    database = f"campaign_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/database'")
    for name in ("customer", "orders", "lineitem", "events"):
        spark.sql(f"CREATE TABLE {database}.{name} USING parquet LOCATION '{sf_dir.rstrip('/')}/{name}.parquet'")
    return Campaign(database=database, publish_to=folder, stored=stand_in_campaign(sf_dir).stored)


def lookup_sessions_files_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_sessions(spark, catalog_campaign(spark, sf_dir), PATTERN)


def purge_group_voice_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    campaign = catalog_campaign(spark, sf_dir)
    purge(spark, campaign, VOICE, CUTOFFS)
    return compared(spark, sf_dir, campaign, VOICE)


def purge_two_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders delivered in two files of different width, purged, and read back with all columns."""
    folder = f"{shared_folder(spark)}/tailtrim-{uuid.uuid4().hex}"
    orders = load(spark, Campaign(root=sf_dir), "orders")
    is_narrow = F.col("o_orderstatus") == NARROW_STATUS
    for rows in (orders.filter(is_narrow).drop("o_orderpriority"), orders.filter(~is_narrow)):
        rows.write.mode("append").parquet(f"{folder}/lcc_timelink_position.parquet")
    stored = {"lcc_timelink_position": StoredTable("lcc_timelink_position", {"fileid": "o_custkey"})}
    campaign = Campaign(root=folder, stored=stored, merge_schema=True)
    group = PurgeGroup("refilled", True, (PurgeEntry("lcc_timelink_position", "fileid"),))
    purge(spark, campaign, group, CUTOFFS)
    return load(spark, campaign, "lcc_timelink_position").withColumnRenamed("fileid", "o_custkey")


def failed_purge(group: PurgeGroup, table: str) -> Callable[[SparkSession, str], DataFrame]:
    def counts_afterwards(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Purge a group of which one table fails, then count every table of it."""
        campaign = new_campaign(spark, sf_dir)
        name, key, _ = STAND_INS[table]
        broken = StoredTable(name, {key: NOT_A_KEY[name]})
        try:
            purge(spark, replace(campaign, stored={**campaign.stored, table: broken}), group, CUTOFFS)
        except TypeError:
            return compared(spark, sf_dir, campaign, group)
        raise AssertionError(f"the purge of {table} should have failed")

    return counts_afterwards


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = clean_up_queries()
    if llm_queries:
        registered |= llm_queries.QUERIES
    if corpus_pipeline:
        registered["pipeline"] = corpus_pipeline.run
    return registered


def clean_up_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "filter_collection_contains": filter_collection_contains,
        "join_filelist_sessions": join_filelist_sessions,
        "lookup_sessions_files": lookup_sessions_files,
        "lookup_sessions": lookup_sessions,
        "join_filelist_sessions_shuffled": join_filelist_sessions_shuffled,
        "lookup_sessions_files_shuffled": lookup_sessions_files_shuffled,
        "lookup_wide": lookup_wide,
        "filter_ignoring_case": filter_ignoring_case,
        **{name: full_read(table) for name, table in zip(FULL_READS, LAST_FILES)},
        "doomed_by_session": doomed_by_session,
        "doomed_by_file": doomed_by_file,
        "purge_by_session": purge_by_session,
        "purge_by_file": purge_by_file,
        "cutoff_from_lookup": cutoff_from_lookup,
        "cleanup_end_to_end": cleanup_end_to_end,
        "cleanup_given_cutoffs": cleanup_given_cutoffs,
        "purge_report_voice_published": purge_report_voice_published,
        "purge_group_voice": purge_group(VOICE),
        "purge_group_scanner": purge_group(SCANNER),
        "purge_group_data": purge_group(DATA),
        "purge_group_data_small": purge_group(DATA_SMALL),
        "purge_group_scanner_optional": purge_group(SCANNER.with_optional()),
        "purge_group_data_small_optional": purge_group(DATA_SMALL.with_optional()),
        "purge_report_data": purge_report(DATA),
        "published_atomic_by_session": published_table("lcc_position", VOICE),
        "published_atomic_by_file": published_table("lcc_timelink_position", VOICE),
        "published_stepwise_by_session": published_table("lcc_Scanner_GSM_Detailed", SCANNER),
        "lookup_sessions_files_catalog": lookup_sessions_files_catalog,
        "purge_group_voice_catalog": purge_group_voice_catalog,
        "purge_two_widths": purge_two_widths,
        "failed_atomic_group": failed_purge(VOICE, "lcc_Calls_Detailed"),
        "failed_stepwise_group": failed_purge(SCANNER, "lcc_Scanner_UMTS_Detailed"),
    }


def _counts_sql(
    group: PurgeGroup,
    with_cutoff: bool = False,
    with_sum: bool = False,
    cutoffs: dict[str, str] | None = None,
    purged: int | None = None,
) -> str:
    """Counts of each table of a group, of which the first ``purged`` ones are, or all."""
    lines = []
    for number, item in enumerate(group.active):
        name, key, column = STAND_INS[item.table]
        cutoff = cutoffs[key] if cutoffs else CUTOFFS.of(key)
        if purged is not None and number >= purged:
            cutoff = "CAST('Infinity' AS DOUBLE)"
        kept = f"NOT coalesce({column} >= {cutoff}, false)"
        what = f"'{item.table}' AS target, "
        if with_cutoff:
            what += f"'{key}' AS key, CAST({cutoff} AS DOUBLE) AS cutoff, "
        lines.append(
            f"SELECT {what}"
            f"count(*) FILTER (WHERE {column} >= {cutoff}) AS removed, "
            f"count(*) FILTER (WHERE {kept}) AS kept"
            + (f", CAST(coalesce(sum({column}) FILTER (WHERE {kept}), 0) AS BIGINT) AS key_sum" if with_sum else "")
            + f" FROM {name}"
        )
    return "\nUNION ALL ".join(lines)


def oracle_sql() -> dict[str, str]:
    sql = clean_up_sql()
    if llm_queries:
        sql |= llm_queries.ORACLE_SQL
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql


def clean_up_sql() -> dict[str, str]:
    matched = f"""
        FROM customer f, orders s WHERE f.c_name LIKE '{PATTERN}' AND f.c_custkey = s.o_custkey"""
    one_customer = f"""
        FROM customer f, orders s
        WHERE f.c_name LIKE '{ONE_CUSTOMER}' AND f.c_custkey = s.o_custkey"""
    kept_sessions = """
        SELECT * FROM lineitem WHERE NOT coalesce(l_orderkey >= CAST(700 AS DOUBLE), false)"""
    kept_files = "SELECT * FROM orders WHERE NOT coalesce(o_custkey >= CAST(70 AS DOUBLE), false)"
    return {
        "filter_collection_contains": f"""
            SELECT c_custkey AS fileid, c_name AS collectionname
            FROM customer WHERE c_name LIKE '{PATTERN}'""",
        "join_filelist_sessions": """
            SELECT f.c_custkey AS fileid, s.o_orderkey AS sessionid, f.c_name AS collectionname
            FROM customer f, orders s WHERE f.c_custkey = s.o_custkey""",
        "lookup_sessions_files": f"""
            SELECT f.c_custkey AS fileid, s.o_orderkey AS sessionid, f.c_name AS collectionname
            {matched} ORDER BY sessionid ASC NULLS FIRST, fileid ASC NULLS FIRST""",
        "lookup_sessions": f"""
            SELECT s.o_orderkey AS sessionid, f.c_name AS collectionname
            {matched} ORDER BY sessionid ASC NULLS FIRST""",
        "join_filelist_sessions_shuffled": """
            SELECT f.c_custkey AS fileid, s.o_orderkey AS sessionid, f.c_name AS collectionname
            FROM customer f, orders s WHERE f.c_custkey = s.o_custkey""",
        "lookup_sessions_files_shuffled": f"""
            SELECT f.c_custkey AS fileid, s.o_orderkey AS sessionid, f.c_name AS collectionname
            {matched} ORDER BY sessionid ASC NULLS FIRST, fileid ASC NULLS FIRST""",
        "lookup_wide": """
            SELECT f.c_custkey AS fileid, s.o_orderkey AS sessionid, f.c_name AS collectionname
            FROM customer f, orders s WHERE f.c_name ILIKE '%CUSTOMER%' AND f.c_custkey = s.o_custkey
            ORDER BY sessionid ASC NULLS FIRST, fileid ASC NULLS FIRST""",
        "filter_ignoring_case": """
            SELECT c_custkey AS fileid, c_name AS collectionname
            FROM customer WHERE c_name ILIKE '%CUSTOMER%0014%'""",
        "full_read": "SELECT * FROM customer",
        "full_read_umts": "SELECT * RENAME (o_custkey AS fileid) FROM orders",
        "full_read_lte": "SELECT * RENAME (user_id AS fileid) FROM events",
        "doomed_by_session": "SELECT * FROM lineitem WHERE l_orderkey >= CAST(700 AS DOUBLE)",
        "doomed_by_file": "SELECT * FROM orders WHERE o_custkey >= CAST(70 AS DOUBLE)",
        "purge_by_session": kept_sessions,
        "purge_by_file": kept_files,
        "cutoff_from_lookup": f"""
            SELECT min(s.o_orderkey) AS min_session, min(f.c_custkey) AS min_file {matched}""",
        "cleanup_end_to_end": _counts_sql(
            VOICE,
            with_sum=True,
            cutoffs={
                "sessionid": f"(SELECT min(s.o_orderkey) {one_customer})",
                "fileid": f"(SELECT min(f.c_custkey) {one_customer})",
            },
        ),
        "cleanup_given_cutoffs": _counts_sql(VOICE, with_sum=True),
        "purge_report_voice_published": _counts_sql(VOICE, with_cutoff=True),
        "purge_group_voice": _counts_sql(VOICE),
        "purge_group_scanner": _counts_sql(SCANNER),
        "purge_group_data": _counts_sql(DATA),
        "purge_group_data_small": _counts_sql(DATA_SMALL),
        "purge_group_scanner_optional": _counts_sql(SCANNER.with_optional()),
        "purge_group_data_small_optional": _counts_sql(DATA_SMALL.with_optional()),
        "purge_report_data": _counts_sql(DATA, with_cutoff=True),
        "published_atomic_by_session": kept_sessions,
        "published_atomic_by_file": kept_files,
        "published_stepwise_by_session": """
            SELECT * FROM events WHERE NOT coalesce(event_id >= CAST(700 AS DOUBLE), false)""",
        "lookup_sessions_files_catalog": f"""
            SELECT f.c_custkey AS fileid, s.o_orderkey AS sessionid, f.c_name AS collectionname
            {matched} ORDER BY sessionid ASC NULLS FIRST, fileid ASC NULLS FIRST""",
        "purge_group_voice_catalog": _counts_sql(VOICE, with_sum=True),
        "purge_two_widths": f"""
            SELECT * REPLACE (CASE WHEN o_orderstatus <> '{NARROW_STATUS}' THEN o_orderpriority END AS o_orderpriority)
            FROM ({kept_files})""",
        # Nothing is purged, or what comes before the table that fails.
        "failed_atomic_group": _counts_sql(VOICE, with_sum=True, purged=0),
        "failed_stepwise_group": _counts_sql(SCANNER, with_sum=True, purged=2),
    }
