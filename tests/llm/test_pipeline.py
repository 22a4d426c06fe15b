"""The stages on a small table, and on edge cases."""

import corpus_pipeline
import pytest

from tailtrim.llm import queries
from tailtrim.llm.neardup import near_duplicates

SMALL = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").cache()
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SMALL).cache()
        counts.append(result.count())
        if name == "near_duplicates":
            assert result.count() == near_duplicates(docs).filter("kept").count()
        if name != "sharding":
            assert result.columns == docs.columns
            docs = result
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] > 0 and counts[4] == counts[5]
    sizes = [r["count"] for r in result.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_on_edge_cases(spark, docs, no_docs, name, stage):
    assert stage(spark, no_docs, SMALL).count() == 0
    found = stage(spark, docs, SMALL)
    assert set(docs.columns) <= set(found.columns)
    ids = {r.doc_id for r in found.select("doc_id").collect()}
    if name == "near_duplicates":
        assert ids == {1, *range(4, 12), None}
        assert found.filter("doc_id = 11").count() == 1
    elif name != "mixing":
        assert ids == {r.doc_id for r in docs.select("doc_id").collect()}


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = [" ".join(f"{letter}{i}" for i in range(60)) for letter in "abcdef"]


def test_rows_that_share_an_id_only_stay(spark):
    rows = [
        (1, WORDS[0]), (1, WORDS[1]), (2, WORDS[2]), (2, WORDS[2]), (3, WORDS[1].replace("b3 ", "", 1)),
        (4, None), (4, ""), (4, WORDS[3]), (0, WORDS[3] + " more"), (None, WORDS[0]), (5, WORDS[4]),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    left = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()]
    expected = [
        (1, WORDS[0]), (1, WORDS[1]), (2, WORDS[2]), (4, None), (4, ""), (0, WORDS[3] + " more"), (None, WORDS[0]),
        (5, WORDS[4]),
    ]
    assert sorted(left, key=str) == sorted(expected, key=str)


def test_columns_with_the_names_of_results(spark):
    names = ["arc", "part", "one", "size", "home", "Shard", "slot", "text_crc32", "low", "base", "_row"]
    docs = spark.createDataFrame(
        [(i, f"text {i}", "en", "s", 1, *[f"{n}{i}" for n in names]) for i in range(50)],
        SCHEMA + "".join(f", {n} string" for n in names),
    )
    found = corpus_pipeline.sharding(spark, docs, SMALL)
    # What is named like a result comes back under another name.
    clashing = {"size", "home", "Shard", "slot", "text_crc32"}
    for row in found.collect():
        assert all(row[f"document_{n}" if n in clashing else n] == f"{n}{row.doc_id}" for n in names)
    assert found.select(found["shard"], "slot").distinct().count() == 50
