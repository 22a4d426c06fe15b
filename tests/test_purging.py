"""Purging groups: what is published, when, and which files are read and written for it."""

import os
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import pytest
from plans import explained, files_read
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tailtrim.functions import literal_rows
from tailtrim.operators import Cutoffs
from tailtrim.plans import PurgeEntry, PurgeGroup, clean_up, purge
from tailtrim.plans import purging
from tailtrim.sources import Campaign, load

SESSION = "sessionid"


def group(*tables, atomic=True):
    entries = [PurgeEntry(*t) if isinstance(t, tuple) else PurgeEntry(t, SESSION) for t in tables]
    return PurgeGroup("g", atomic, tuple(entries))


def write(spark, root, table, keys, files=1, mode="error"):
    """A table of the given session keys, in order, as so many files of ascending ids."""
    if isinstance(keys, range) or not keys:
        ids = spark.range(min(keys, default=0), max(keys, default=-1) + 1, 1, 1).toDF(SESSION)
    else:
        ids = literal_rows(spark, [(k,) for k in keys], "sessionid bigint")
    rows = ids.withColumn("note", F.expr("concat('row ', sessionid)"))
    if files > 1:
        rows = rows.repartitionByRange(files, SESSION).sortWithinPartitions(SESSION)
    else:
        rows = rows.coalesce(1)
    rows.write.mode(mode).parquet(f"{root}/{table}.parquet")


def keys(spark, campaign, table):
    return Counter(row[0] for row in load(spark, campaign, table).select(SESSION).collect())


def log_files(root):
    folder = f"{root}/purge_log"
    return os.listdir(folder) if os.path.isdir(folder) else []


def files_of(root):
    return {
        os.path.join(folder, f): os.path.getmtime(os.path.join(folder, f))
        for folder, _, names in os.walk(root)
        for f in names
        if f.endswith(".parquet")
    }


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


@pytest.fixture
def campaign(root):
    return Campaign(root=root)


def test_report_and_published_rows(spark, root, campaign):
    write(spark, root, "a", [1, 5, 5, 9, None])
    write(spark, root, "b", [2, 3])
    report = purge(spark, campaign, group("a", "b"), Cutoffs(5))
    assert report.columns == ["target", "key", "cutoff", "removed", "kept"]
    assert [tuple(r) for r in report.collect()] == [("a", SESSION, 5.0, 3, 2), ("b", SESSION, 5.0, 0, 2)]
    assert keys(spark, campaign, "a") == Counter([1, None])
    assert keys(spark, campaign, "b") == Counter([2, 3])


def test_each_table_uses_its_own_key(spark, root, campaign):
    for table in ("by_session", "by_file"):
        spark.createDataFrame(
            [(1, 90), (8, 20)], "sessionid bigint, fileid bigint"
        ).write.parquet(f"{root}/{table}.parquet")
    purge(spark, campaign, group("by_session", ("by_file", "fileid")), Cutoffs(5, 50))
    assert keys(spark, campaign, "by_session") == Counter([1])
    assert keys(spark, campaign, "by_file") == Counter([8])


def test_missing_file_cutoff_stops_before_anything(spark, root, campaign):
    write(spark, root, "a", [1, 9])
    with pytest.raises(ValueError, match="fileid"):
        purge(spark, campaign, group("a", ("b", "fileid"), atomic=False), Cutoffs(5))
    assert keys(spark, campaign, "a") == Counter([1, 9])


def test_dry_run_writes_nothing(spark, root, campaign):
    write(spark, root, "a", [1, 5, None])
    before = files_of(root)
    report = purge(spark, campaign, group("a"), Cutoffs(5), dry_run=True)
    assert [tuple(r) for r in report.collect()] == [("a", SESSION, 5.0, 1, 2)]
    assert files_of(root) == before


@pytest.mark.parametrize("atomic,purged", [(True, []), (False, ["a"])])
def test_unreadable_table(spark, root, campaign, atomic, purged):
    write(spark, root, "a", [1, 9])
    write(spark, root, "c", [1, 9])
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        purge(spark, campaign, group("a", "missing", "c", atomic=atomic), Cutoffs(5))
    for table in ("a", "c"):
        assert keys(spark, campaign, table) == Counter([1] if table in purged else [1, 9])


@pytest.mark.parametrize("atomic,purged", [(True, []), (False, ["a"])])
def test_failure_while_rewriting(spark, root, campaign, monkeypatch, atomic, purged):
    """A table that fails after others were already written."""
    for table in "abc":
        write(spark, root, table, [1, 9])
    rewrite = purging._rewrite

    def failing(spark, folder, run, targets, counts):
        written = rewrite(spark, folder, run, targets, counts)
        if "b" in [target.table for target in targets]:
            raise RuntimeError("disk lost")
        return written

    monkeypatch.setattr(purging, "_rewrite", failing)
    with pytest.raises(RuntimeError, match="disk lost"):
        purge(spark, campaign, group("a", "b", "c", atomic=atomic), Cutoffs(5))
    for table in "abc":
        assert keys(spark, campaign, table) == Counter([1] if table in purged else [1, 9])


def test_rows_lost_in_writing_are_noticed(spark, root, campaign, monkeypatch):
    write(spark, root, "a", [1, 2, 9])
    monkeypatch.setattr(purging, "survivors", lambda rows, key, cutoff: rows.filter(f"{key} < 2"))
    with pytest.raises(RuntimeError, match="wrote 1 of 2 rows"):
        purge(spark, campaign, group("a"), Cutoffs(5))
    assert keys(spark, campaign, "a") == Counter([1, 2, 9])


def test_atomic_group_is_one_commit_and_the_other_kind_one_per_table(spark, root):
    for name in ("whole", "stepwise"):
        for table in "ab":
            write(spark, f"{root}/{name}", table, [1, 9])
    purge(spark, Campaign(root=f"{root}/whole"), group("a", "b"), Cutoffs(5))
    purge(spark, Campaign(root=f"{root}/stepwise"), group("a", "b", atomic=False), Cutoffs(5))
    assert len(log_files(f"{root}/whole")) == 1
    assert len(log_files(f"{root}/stepwise")) == 2


def test_the_caller_can_choose_the_other_kind(spark, root, campaign):
    write(spark, root, "a", [1, 9])
    write(spark, root, "b", [1, 9])
    purge(spark, campaign, group("a", "b", atomic=False), Cutoffs(5), atomic=True)
    assert len(log_files(root)) == 1


def test_only_files_around_the_cutoff_are_rewritten(spark, root, campaign):
    write(spark, root, "a", range(1000), files=10)
    before = files_of(root)
    purge(spark, campaign, group("a"), Cutoffs(750))
    after = files_of(root)
    assert before.items() <= after.items()
    written = [f for f in after if "/purge_data/" in f]
    assert sum(spark.read.parquet(f).count() for f in written) < 200
    assert keys(spark, campaign, "a") == Counter(range(750))
    live = set().union(*(files_read(scan.rows) for scan in campaign.scans(spark, ["a"])["a"]))
    assert len([f for f in live if "/a.parquet/" in f]) in (7, 8)
    assert len(live) <= 9


def test_files_that_left_the_table_are_not_opened(spark, root, campaign):
    write(spark, root, "a", range(1000), files=10)
    purge(spark, campaign, group("a"), Cutoffs(300))
    gone = {r.path for r in spark.read.parquet(f"{root}/purge_log/*").filter("change = 'without'").collect()}
    assert len(gone) >= 7
    # With every one of them made unreadable, the table can still be read.
    for path in gone:
        with open(path.removeprefix("file:"), "wb") as file:
            file.write(b"not parquet")
        crc = os.path.join(os.path.dirname(path.removeprefix("file:")), f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    rows = load(spark, campaign, "a").agg(F.count("*"), F.sum(SESSION), F.max("note")).first()
    assert rows[0] == 300 and rows[1] == sum(range(300))


def test_counting_reads_the_key_column_only(spark, root, campaign):
    write(spark, root, "a", range(100), files=4)
    target = purging._Target(
        PurgeEntry("a", SESSION), 50.0, campaign.location("a"), SESSION, campaign.scans(spark, ["a"])["a"]
    )
    plan = explained(purging._rows_per_file([target]))
    assert "ReadSchema: struct<sessionid:bigint>" in plan
    assert "GreaterThanOrEqual(sessionid,50)" in plan
    assert "note" not in plan
    assert plan.count("Exchange\n") == 1


def test_files_that_lose_every_row_are_not_rewritten(spark, root, campaign, monkeypatch):
    write(spark, root, "a", range(1000), files=10)
    read = []
    touched_rows = purging._touched_rows

    def noted(spark, target, scan, paths):
        read.extend(paths)
        return touched_rows(spark, target, scan, paths)

    monkeypatch.setattr(purging, "_touched_rows", noted)
    purge(spark, campaign, group("a"), Cutoffs(350))
    assert len(read) == 1
    assert keys(spark, campaign, "a") == Counter(range(350))


def wide_and_narrow(spark, root, wide_first, kind="bigint"):
    """Two appended files, one with a further column; Spark takes the schema of the first by name."""
    for number, wide in enumerate([wide_first, not wide_first]):
        rows = spark.range(10 * number, 10 * number + 10, 1, 1).toDF(SESSION)
        rows = rows.withColumn("a", F.col(SESSION).cast(kind if wide else "bigint"))
        if wide:
            rows = rows.withColumn("b", F.col(SESSION) * 2)
        rows.write.parquet(f"{root}/one{number}")
        (name,) = [f for f in os.listdir(f"{root}/one{number}") if f.endswith(".parquet")]
        os.makedirs(f"{root}/a.parquet", exist_ok=True)
        with open(f"{root}/one{number}/{name}", "rb") as file, open(f"{root}/a.parquet/{number}.parquet", "wb") as to:
            to.write(file.read())


@pytest.mark.parametrize("wide_first", [True, False])
def test_no_column_is_lost(spark, root, campaign, wide_first):
    wide_and_narrow(spark, root, wide_first)
    wide = range(0, 10) if wide_first else range(10, 20)
    for cutoff in (15, 5, 3):
        purge(spark, campaign, group("a"), Cutoffs(cutoff))
        left = {r[SESSION]: r.asDict().get("b") for r in load(spark, campaign, "a").collect()}
        if "b" in load(spark, campaign, "a").columns:
            assert left == {k: 2 * k if k in wide else None for k in range(cutoff)}
        else:
            assert set(left) == set(range(cutoff)) and not set(left) & set(wide)


def test_types_that_cannot_be_merged_are_refused(spark, root, campaign):
    wide_and_narrow(spark, root, True, kind="string")
    with pytest.raises(Exception, match="(?i)merge"):
        purge(spark, campaign, group("a"), Cutoffs(5), atomic=True) and purge(spark, campaign, group("a"), Cutoffs(15))
        purging._touched_rows(
            spark, purging._targets(spark, campaign, group("a").active, Cutoffs(5))[0],
            purging.Scan(f"{root}/a.parquet", None), [f"{root}/a.parquet/0.parquet", f"{root}/a.parquet/1.parquet"],
        )


def test_purges_of_different_tables_at_the_same_time(spark, root, campaign):
    for table in "abcd":
        write(spark, root, table, range(20), files=2)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda t: purge(spark, campaign, group(t), Cutoffs(7)), "abcd"))
    for table in "abcd":
        assert keys(spark, campaign, table) == Counter(range(7))


def test_a_replaced_folder_takes_one_line(spark, root, campaign):
    write(spark, root, "a", range(100), files=1)
    purge(spark, campaign, group("a"), Cutoffs(60))
    purge(spark, campaign, group("a"), Cutoffs(30))
    changes = [r.change for r in spark.read.parquet(f"{root}/purge_log/*").collect()]
    assert Counter(changes) == Counter({"without": 1, "with": 2, "gone": 1})
    assert len(campaign.scans(spark, ["a"])["a"]) == 2
    assert keys(spark, campaign, "a") == Counter(range(30))


def test_repeated_and_lower_purges(spark, root, campaign):
    write(spark, root, "a", list(range(100)) + [None], files=4)
    purge(spark, campaign, group("a"), Cutoffs(60))
    again = purge(spark, campaign, group("a"), Cutoffs(60)).first()
    assert (again.removed, again.kept) == (0, 61)
    assert len(log_files(root)) == 1
    assert keys(spark, campaign, "a") == Counter([*range(60), None])
    purge(spark, campaign, group("a"), Cutoffs(33.5))
    assert keys(spark, campaign, "a") == Counter([*range(34), None])
    purge(spark, campaign, group("a"), Cutoffs(30))
    assert keys(spark, campaign, "a") == Counter([*range(30), None])


def test_everything_removed_keeps_the_columns(spark, root, campaign):
    write(spark, root, "a", range(10), files=2)
    report = purge(spark, campaign, group("a"), Cutoffs(0)).first()
    assert (report.removed, report.kept) == (10, 0)
    left = load(spark, campaign, "a")
    assert left.columns == [SESSION, "note"] and left.count() == 0
    assert purge(spark, campaign, group("a"), Cutoffs(0)).first().removed == 0


def test_empty_table(spark, root, campaign):
    write(spark, root, "a", [])
    report = purge(spark, campaign, group("a"), Cutoffs(0)).first()
    assert (report.removed, report.kept) == (0, 0)
    assert load(spark, campaign, "a").count() == 0


def test_rows_appended_after_a_purge_belong_to_the_table(spark, root, campaign):
    write(spark, root, "a", range(10))
    purge(spark, campaign, group("a"), Cutoffs(5))
    write(spark, root, "a", range(5, 8), mode="append")
    assert keys(spark, campaign, "a") == Counter(range(8))
    purge(spark, campaign, group("a"), Cutoffs(7))
    assert keys(spark, campaign, "a") == Counter(range(7))


def test_a_reader_that_began_before_a_purge_is_not_disturbed(spark, root, campaign):
    write(spark, root, "a", range(10))
    earlier = load(spark, campaign, "a")
    purge(spark, campaign, group("a"), Cutoffs(5))
    assert earlier.count() == 10
    assert load(spark, campaign, "a").count() == 5


def test_partitioned_table(spark, root, campaign):
    rows = spark.range(100).toDF(SESSION).withColumn("day", F.expr("concat('d', sessionid % 3)"))
    rows.write.partitionBy("day").parquet(f"{root}/a.parquet")
    expected = Counter((r[0], r[1]) for r in rows.filter("sessionid < 40").collect())
    purge(spark, campaign, group("a"), Cutoffs(40))
    assert Counter((r[0], r[1]) for r in load(spark, campaign, "a").collect()) == expected
    purge(spark, campaign, group("a"), Cutoffs(39))
    assert load(spark, campaign, "a").count() == 39
    for scan in campaign.scans(spark, ["a"])["a"]:
        assert "day" in explained(scan.rows.filter("day = 'd1'")).split("PartitionFilters")[1].split("\n")[0]


@pytest.mark.parametrize("folder", ["a b", "50%25 o'clock", "é=1", "x+y"])
def test_unusual_folder_names(spark, root, folder):
    campaign = Campaign(root=f"{root}/{folder}")
    write(spark, f"{root}/{folder}", "a", range(20), files=2)
    purge(spark, campaign, group("a"), Cutoffs(5))
    purge(spark, campaign, group("a"), Cutoffs(3))
    assert keys(spark, campaign, "a") == Counter(range(3))


def test_publishing_elsewhere_leaves_the_delivered_folder_alone(spark, root):
    write(spark, f"{root}/delivered", "a", range(10))
    before = files_of(f"{root}/delivered")
    campaign = Campaign(root=f"{root}/delivered", publish_to=f"{root}/published")
    purge(spark, campaign, group("a"), Cutoffs(5))
    assert keys(spark, campaign, "a") == Counter(range(5))
    assert files_of(f"{root}/delivered") == before
    assert keys(spark, Campaign(root=f"{root}/delivered"), "a") == Counter(range(10))


def test_a_purged_table_is_not_read_by_another_path(spark, root, campaign):
    write(spark, root, "a", range(10))
    purge(spark, campaign, group("a"), Cutoffs(5))
    assert load(spark, Campaign(root=f"{root}/"), "a").count() == 5
    with pytest.raises(ValueError, match="was purged as"):
        load(spark, Campaign(root=f"file:{root}", publish_to=root), "a")


def test_two_purges_at_the_same_time_are_noticed(spark, root, campaign, monkeypatch):
    write(spark, root, "a", range(10))
    publish = purging._publish

    def publish_twice(*args):
        monkeypatch.setattr(purging, "_publish", publish)
        purge(spark, campaign, group("a"), Cutoffs(5))
        publish(*args)

    monkeypatch.setattr(purging, "_publish", publish_twice)
    with pytest.raises(RuntimeError, match="same time"):
        purge(spark, campaign, group("a"), Cutoffs(7))
        load(spark, campaign, "a")


def lookup_tables(spark, root):
    spark.createDataFrame([(1, "A x"), (2, "B y")], "fileid bigint, collectionname string").write.parquet(
        f"{root}/filelist.parquet"
    )
    spark.createDataFrame([(10, 1), (11, 2), (12, 1)], "sessionid bigint, fileid bigint").write.parquet(
        f"{root}/sessions.parquet"
    )


def test_clean_up_removes_other_collections_above_the_cutoff_too(spark, root, campaign):
    lookup_tables(spark, root)
    write(spark, root, "a", [9, 10, 11])
    report = clean_up(spark, campaign, "%A%", [group("a")])
    assert [tuple(r) for r in report.collect()] == [("a", SESSION, 10.0, 2, 1)]
    assert keys(spark, campaign, "a") == Counter([9])


def test_clean_up_with_given_cutoffs_and_without_a_match(spark, root, campaign):
    lookup_tables(spark, root)
    write(spark, root, "a", [9, 10, 11])
    with pytest.raises(ValueError, match="no session"):
        clean_up(spark, campaign, "%nothing%", [group("a")])
    assert keys(spark, campaign, "a") == Counter([9, 10, 11])
    clean_up(spark, campaign, "%nothing%", [group("a")], cutoffs=Cutoffs(11))
    assert keys(spark, campaign, "a") == Counter([9, 10])


def test_clean_up_of_several_groups(spark, root, campaign):
    lookup_tables(spark, root)
    write(spark, root, "a", [9, 11])
    write(spark, root, "b", [10, 12])
    dry = clean_up(spark, campaign, "%B%", [group("a"), group("b", atomic=False)], dry_run=True)
    wet = clean_up(spark, campaign, "%B%", [group("a"), group("b", atomic=False)])
    assert dry.collect() == wet.collect()
    assert keys(spark, campaign, "a") == Counter([9]) and keys(spark, campaign, "b") == Counter([10])


def test_a_dry_run_names_no_file(spark, root, campaign, monkeypatch):
    write(spark, root, "a", range(100), files=4)
    purge(spark, campaign, group("a"), Cutoffs(80))
    plans = []
    kind = type(spark.range(1))
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda df: plans.append(explained(df)) or collect(df))
    (line,) = purging._count_only(purging._targets(spark, campaign, group("a").active, Cutoffs(50)))
    assert line == ("a", SESSION, 50.0, 30, 50)
    assert "ReadSchema: struct<sessionid:bigint>" in plans[-1]
    assert "hashpartitioning" not in plans[-1] and "note" not in plans[-1]


@pytest.mark.parametrize("atomic", [True, False])
def test_the_log_is_read_once_for_a_group(spark, root, campaign, monkeypatch, atomic):
    for table in "abc":
        write(spark, root, table, range(20), files=2)
    reads = []
    read_changes = purging.read_changes

    def noted(*args):
        reads.append(args)
        return read_changes(*args)

    monkeypatch.setattr(purging, "read_changes", noted)
    monkeypatch.setattr("tailtrim.sources.published.read_changes", noted)
    purge(spark, campaign, group("a", "b", "c", atomic=atomic), Cutoffs(5))
    assert len(reads) == 1
    for table in "abc":
        assert keys(spark, campaign, table) == Counter(range(5))


def test_a_purge_of_another_table_meanwhile_is_no_conflict(spark, root, campaign, monkeypatch):
    for table in "ab":
        write(spark, root, table, range(10))
    rewrite = purging._rewrite

    def meanwhile(*args):
        monkeypatch.setattr(purging, "_rewrite", rewrite)
        purge(spark, campaign, group("b"), Cutoffs(3))
        return rewrite(*args)

    monkeypatch.setattr(purging, "_rewrite", meanwhile)
    purge(spark, campaign, group("a"), Cutoffs(5))
    assert keys(spark, campaign, "a") == Counter(range(5))
    assert keys(spark, campaign, "b") == Counter(range(3))


def test_a_purge_of_the_same_file_meanwhile_is_refused(spark, root, campaign, monkeypatch):
    write(spark, root, "a", range(10))
    rewrite = purging._rewrite

    def meanwhile(*args):
        monkeypatch.setattr(purging, "_rewrite", rewrite)
        purge(spark, campaign, group("a"), Cutoffs(3))
        return rewrite(*args)

    monkeypatch.setattr(purging, "_rewrite", meanwhile)
    with pytest.raises(RuntimeError, match="another purge"):
        purge(spark, campaign, group("a"), Cutoffs(5))
    assert keys(spark, campaign, "a") == Counter(range(3))


@pytest.mark.parametrize("wide_first", [True, False])
def test_all_columns_of_files_of_different_width(spark, root, wide_first):
    wide_and_narrow(spark, root, wide_first)
    campaign = Campaign(root=root, merge_schema=True)
    wide = range(0, 10) if wide_first else range(10, 20)
    for cutoff in (20, 15, 3):
        purge(spark, campaign, group("a"), Cutoffs(cutoff))
        left = {r[SESSION]: r.b for r in load(spark, campaign, "a").collect()}
        assert left == {k: 2 * k if k in wide else None for k in range(cutoff)}
