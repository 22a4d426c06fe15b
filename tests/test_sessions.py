"""The lookup: name match, join, order, cutoffs."""

from collections import Counter

import pytest
from plans import explained
from pyspark.sql import functions as F

from tailtrim.operators import (
    Cutoffs,
    cutoffs_from_lookup,
    join_sessions,
    lookup,
    lowest_ids,
    match_collections,
)
from tailtrim.sources import Campaign, StoredTable, load

SMALL = "/root/testdata/sf0.001"


def files(spark, rows):
    return spark.createDataFrame(rows, "fileid bigint, collectionname string")


def sessions(spark, rows):
    return spark.createDataFrame(rows, "sessionid bigint, fileid bigint")


def rows(df):
    return [tuple(row) for row in df.collect()]


def test_name_match_and_case(spark):
    df = files(spark, [(1, "CALATAYUD"), (2, "x calatayud y"), (3, None), (4, "other")])
    assert rows(match_collections(df, "%calatayud%").select("fileid")) == [(2,)]
    assert rows(match_collections(df, "%calatayud%", ignore_case=True).select("fileid")) == [(1,), (2,)]


def test_wildcards_and_backslash(spark):
    df = files(spark, [(1, "a_b"), (2, "axb"), (3, "a\\b"), (4, "ab")])
    assert rows(match_collections(df, "a_b").select("fileid")) == [(1,), (2,), (3,)]
    assert rows(match_collections(df, "a\\b").select("fileid")) == [(3,)]
    assert rows(match_collections(df, "%\\%").select("fileid")) == [(3,)]


def test_order_is_by_session_then_file(spark):
    found = lookup(files(spark, [(1, "a"), (2, "a")]), sessions(spark, [(10, 1), (9, 2)]), "%a%")
    assert found.columns == ["fileid", "sessionid", "collectionname"]
    assert rows(found) == [(2, 9, "a"), (1, 10, "a")]


def test_missing_sessions_come_first(spark):
    found = lookup(files(spark, [(1, "a")]), sessions(spark, [(3, 1), (None, 1)]), "%")
    assert [row[1] for row in rows(found)] == [None, 3]


def test_lookup_without_files(spark):
    found = lookup(files(spark, [(1, "a")]), sessions(spark, [(3, 1), (2, 1)]), "%", with_files=False)
    assert found.columns == ["sessionid", "collectionname"]
    assert rows(found) == [(2, "a"), (3, "a")]


def test_repeated_files_multiply_and_missing_ids_do_not_join(spark):
    filelist = files(spark, [(1, "a"), (1, "a"), (None, "a")])
    found = lookup(filelist, sessions(spark, [(9, 1), (8, None)]), "%a%")
    assert rows(found) == [(1, 9, "a"), (1, 9, "a")]


def test_minima_are_independent(spark):
    found = lookup(files(spark, [(1, "a"), (7, "a")]), sessions(spark, [(5, 7), (6, 1)]), "%a%")
    assert rows(found)[0] == (7, 5, "a")
    assert cutoffs_from_lookup(found) == Cutoffs(session=5, file=1)
    assert cutoffs_from_lookup(found.drop("fileid")) == Cutoffs(session=5, file=None)


def test_empty_lookup_gives_no_cutoff(spark):
    found = lookup(files(spark, [(1, "a")]), sessions(spark, [(5, 1)]), "%nothing%")
    with pytest.raises(ValueError, match="no session"):
        cutoffs_from_lookup(found)


def test_cutoff_of_a_key_must_be_given():
    assert Cutoffs(5, 7).of("fileid") == 7
    with pytest.raises(ValueError, match="fileid"):
        Cutoffs(5).of("fileid")


def brute_force(filelist, session_rows):
    return Counter(
        (f, s, name) for f, name in filelist for s, g in session_rows if f is not None and f == g
    )


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_hot_ids_on_both_sides_join_exactly(spark, broadcast_bytes):
    """A third of all rows on one id of each side, exact copies among them."""
    filelist = [(i, f"c{i}") for i in range(20)] + [(3, "hot")] * 9 + [(None, "none")]
    session_rows = [(i, i % 25) for i in range(60)] + [(i, 5) for i in range(100, 120)]
    session_rows += [(7, 3)] * 25 + [(1, None)]
    left = files(spark, filelist).repartition(3)
    right = sessions(spark, session_rows).repartition(4)
    found = join_sessions(left, right, broadcast_bytes=broadcast_bytes, rows_per_share=4)
    assert Counter(rows(found)) == brute_force(filelist, session_rows)


def test_hot_id_is_spread_over_shuffle_partitions(spark):
    filelist = files(spark, [(i, f"c{i}") for i in range(50)])
    hot = spark.range(30_000).selectExpr(
        "id AS sessionid", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 50 END AS fileid"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:

        def largest(rows_per_share):
            found = join_sessions(filelist, hot, broadcast_bytes=0, rows_per_share=rows_per_share)
            sizes = found.filter("fileid = 7").groupBy(F.spark_partition_id()).count()
            return max(row["count"] for row in sizes.collect())

        assert largest(10**9) > 10_000
        assert largest(500) < 4_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def stored(spark):
    campaign = Campaign(
        root=SMALL,
        stored={
            "filelist": StoredTable("customer", {"fileid": "c_custkey", "collectionname": "c_name"}),
            "sessions": StoredTable("orders", {"sessionid": "o_orderkey", "fileid": "o_custkey"}),
        },
    )
    return load(spark, campaign, "filelist"), load(spark, campaign, "sessions")


def test_small_file_list_is_broadcast_and_sessions_stay_in_place(spark):
    filelist, session_table = stored(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = explained(lookup(filelist, session_table, "%0014%"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan
    # The one hash exchange is after the join, for the sort to sample from.
    assert plan.count("hashpartitioning") == 1
    assert "hashpartitioning(sessionid" in plan and "rangepartitioning(sessionid" in plan
    assert "StringContains(c_name,0014)" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "PushedFilters: [IsNotNull(o_custkey)]" in plan


def test_larger_file_list_is_shuffled(spark):
    filelist, session_table = stored(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = explained(join_sessions(filelist, session_table, broadcast_bytes=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(fileid" in plan
    assert "SortMergeJoin" in plan


def test_cutoffs_need_no_sort(spark):
    filelist, session_table = stored(spark)
    found = lookup(filelist, session_table, "%0014%", ordered=False)
    plan = explained(lowest_ids(found))
    assert "partitioning(" not in plan and "Sort" not in plan
    assert cutoffs_from_lookup(found) == cutoffs_from_lookup(lookup(filelist, session_table, "%0014%"))


def test_ordered_lookup_reads_the_sessions_once(spark):
    filelist, session_table = stored(spark)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    counted = session_table.mapInPandas(count, session_table.schema)
    assert lookup(filelist, counted, "%0014%").count() > 0
    lookup(filelist, counted, "%0014%").collect()
    # Counting needs no order, so each of the two reads every session once.
    assert seen.value == 2 * session_table.count()


def test_copies_of_one_session_spread_over_sort_tasks(spark):
    """Exact copies from several input splits end in several ranges of the ordered result."""
    copies = spark.range(0, 4000, 1, 8).selectExpr("1L AS sessionid", "1L AS fileid")
    found = lookup(files(spark, [(1, "a")]), copies, "%")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = found.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(row["count"] for row in sizes) == 4000
    assert max(row["count"] for row in sizes) <= 2000
