"""Reading campaign tables from folders and from the catalog."""

import pytest

from tailtrim.operators import Cutoffs
from tailtrim.plans import PurgeEntry, PurgeGroup, purge
from tailtrim.sources import Campaign, StoredTable, load, shared_folder

SMALL = "/root/testdata/sf0.001"


def test_columns_are_renamed_and_the_rest_kept(spark):
    campaign = Campaign(root=SMALL, stored={"sessions": StoredTable("orders", {"sessionid": "o_orderkey"})})
    loaded = load(spark, campaign, "sessions", keys=["sessionid"])
    assert loaded.columns[0] == "sessionid"
    assert set(loaded.columns[1:]) == set(spark.read.parquet(f"{SMALL}/orders.parquet").columns[1:])


def test_every_driver_table_loads(spark):
    for table in ("customer", "orders", "lineitem", "events"):
        assert load(spark, Campaign(root=SMALL + "/"), table).count() > 0


def test_text_key_is_refused_with_its_name(spark, tmp_path):
    spark.createDataFrame([("abc",)], "fileid string").write.parquet(f"{tmp_path}/filelist.parquet")
    with pytest.raises(TypeError, match="'fileid'"):
        load(spark, Campaign(root=str(tmp_path)), "filelist", keys=["fileid"])


def test_campaigns_are_separate(spark, tmp_path):
    for name, rows in (("one", 3), ("two", 5)):
        spark.range(rows).toDF("sessionid").write.parquet(f"{tmp_path}/{name}/t.parquet")
    one, two = (Campaign(root=f"{tmp_path}/{name}") for name in ("one", "two"))
    purge(spark, one, PurgeGroup("g", True, (PurgeEntry("t", "sessionid"),)), Cutoffs(1))
    assert load(spark, one, "t").count() == 1
    assert load(spark, two, "t").count() == 5


def test_a_campaign_is_a_folder_or_a_database():
    with pytest.raises(ValueError, match="either"):
        Campaign()
    with pytest.raises(ValueError, match="either"):
        Campaign(root="x", database="y")


@pytest.fixture
def database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE campaign_db LOCATION '{tmp_path}/db'")
    spark.range(10).toDF("sessionid").repartitionByRange(2, "sessionid").write.saveAsTable(
        "campaign_db.lcc_Position"
    )
    yield "campaign_db"
    spark.sql("DROP DATABASE campaign_db CASCADE")


def test_catalog_campaign(spark, database, tmp_path):
    group = PurgeGroup("g", True, (PurgeEntry("LCC_position", "sessionid"),))
    looking = Campaign(database=database)
    assert load(spark, looking, "lcc_position").count() == 10
    report = purge(spark, looking, group, Cutoffs(3), dry_run=True)
    assert [tuple(r) for r in report.collect()] == [("LCC_position", "sessionid", 3.0, 7, 3)]
    with pytest.raises(ValueError, match="dry run"):
        purge(spark, looking, group, Cutoffs(3))
    purging = Campaign(database=database, publish_to=f"{tmp_path}/published")
    purge(spark, purging, group, Cutoffs(3))
    # Names of catalog tables and of published ones are the same in any case.
    assert sorted(r[0] for r in load(spark, purging, "lcc_POSITION").collect()) == [0, 1, 2]
    assert load(spark, looking, "lcc_position").count() == 10


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named.rstrip("/")


class _Session:
    def __init__(self, settings):
        self.conf = self
        self.settings = settings

    def get(self, name, default=None):
        return self.settings.get(name, default)


def test_a_cluster_never_falls_back_to_a_folder_of_the_machine():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session({"spark.master": "yarn"}))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session({"spark.master": "local[2]"}))
    assert shared_folder(_Session({"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"
