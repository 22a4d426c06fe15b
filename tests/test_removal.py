"""Which rows a cutoff removes, and that the filter reaches the Parquet scan."""

import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from plans import explained
from pyspark.sql import functions as F

from tailtrim.operators import doomed, survivors

LINEITEM = "/root/testdata/sf0.001/lineitem.parquet"


def keyed(spark, keys, kind="bigint"):
    return spark.createDataFrame([(k,) for k in keys], f"sessionid {kind}")


def kept(df, cutoff):
    return [row[0] for row in survivors(df, "sessionid", cutoff).collect()]


def gone(df, cutoff):
    return [row[0] for row in doomed(df, "sessionid", cutoff).collect()]


def test_missing_keys_survive(spark):
    df = keyed(spark, [1, 5, None])
    assert kept(df, 5) == [1, None]
    assert gone(df, 5) == [5]


def test_fractional_cutoff_equals_the_next_whole_one(spark):
    df = keyed(spark, [4, 5, 6])
    assert kept(df, 4.5) == kept(df, 5) == [4]
    assert gone(df, 4.5) == gone(df, 5) == [5, 6]


@pytest.mark.parametrize("cutoff", [math.nan, math.inf, -math.inf])
def test_cutoff_must_be_finite(spark, cutoff):
    with pytest.raises(ValueError, match="finite"):
        survivors(keyed(spark, [1]), "sessionid", cutoff)


def test_large_cutoffs_compare_as_doubles(spark):
    df = keyed(spark, [2**53, 2**53 - 2])
    assert gone(df, float(2**53 + 1)) == [2**53]
    assert kept(df, float(2**53 + 1)) == [2**53 - 2]


@pytest.mark.parametrize("kind", ["smallint", "int", "bigint", "double", "decimal(12,2)"])
def test_every_numeric_key_type(spark, kind):
    from decimal import Decimal

    keys = [1, 4, 5, 70, None]
    if kind == "double":
        keys = [float(k) if k is not None else None for k in keys]
    if kind.startswith("decimal"):
        keys = [Decimal(k) if k is not None else None for k in keys]
    df = keyed(spark, keys, kind)
    assert gone(df, 4.5) == keys[2:4]
    assert kept(df, 4.5) == keys[:2] + [None]


def test_cutoff_beyond_the_range_of_a_small_key(spark):
    df = keyed(spark, [1, 32767], "smallint")
    assert kept(df, 1e6) == [1, 32767]
    assert kept(df, -1e6) == []


def test_key_must_be_a_number(spark):
    with pytest.raises(TypeError, match="'sessionid'"):
        survivors(keyed(spark, ["abc"], "string"), "sessionid", 1)


def test_key_must_exist(spark):
    with pytest.raises(ValueError, match="'fileid'"):
        doomed(keyed(spark, [1]), "fileid", 1)


def test_key_name_ignores_case(spark):
    assert survivors(keyed(spark, [1, 9]), "SessionID", 5).count() == 1


edge_keys = st.one_of(
    st.none(),
    st.integers(-100, 100),
    st.sampled_from([2**53 - 1, 2**53, 2**53 + 1, -(2**53) - 1, 2**63 - 1, -(2**63)]),
)
edge_cutoffs = st.one_of(
    st.floats(-120, 120, allow_nan=False), st.sampled_from([2.0**53, -(2.0**53), 2.0**62, 1e300])
)


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(keys=st.lists(edge_keys, min_size=1, max_size=8), cutoffs=st.tuples(edge_cutoffs, edge_cutoffs))
def test_invariants(spark, keys, cutoffs):
    df = keyed(spark, keys)
    low, high = sorted(cutoffs)
    left, removed = kept(df, low), gone(df, low)
    assert Counter(left) + Counter(removed) == Counter(keys)
    # Python compares exactly; the cutoffs are doubles, so a key takes part as the nearest double.
    assert Counter(removed) == Counter(k for k in keys if k is not None and float(k) >= low)
    assert kept(survivors(df, "sessionid", low), low) == left
    assert not Counter(left) - Counter(kept(df, high))


def test_whole_cutoff_reaches_the_scan_without_a_shuffle(spark):
    lineitem = spark.read.parquet(LINEITEM)
    plan = explained(survivors(lineitem, "l_orderkey", 700.5))
    assert "PushedFilters: [Or(LessThan(l_orderkey,701),IsNull(l_orderkey))]" in plan
    assert "Exchange" not in plan
    plan = explained(doomed(lineitem, "l_orderkey", 700.0))
    assert "PushedFilters: [IsNotNull(l_orderkey), GreaterThanOrEqual(l_orderkey,700)]" in plan


def test_int_key_reaches_the_scan_too(spark):
    plan = explained(survivors(spark.read.parquet(LINEITEM), "l_linenumber", 3.0))
    assert "Or(LessThan(l_linenumber,3),IsNull(l_linenumber))" in plan


def test_only_the_columns_asked_for_are_read(spark):
    plan = explained(survivors(spark.read.parquet(LINEITEM), "l_orderkey", 7).select("l_tax"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_tax:double>" in plan


@pytest.mark.parametrize("kind", ["decimal(15,0)", "decimal(12,2)"])
def test_decimal_keys_are_pushed_and_exact(spark, tmp_path, kind):
    path = str(tmp_path / "t")
    spark.range(0, 2000).select((F.col("id") / 8).cast(kind).alias("k")).write.parquet(path)
    table = spark.read.parquet(path)
    for cutoff in (10.0, 10.1, 10.12, 10.125, 10.13, 0.1 + 0.2, -3.0, 1e9):
        expected = table.filter(F.col("k").cast("double") >= F.lit(cutoff)).count()
        assert doomed(table, "k", cutoff).count() == expected
        assert survivors(table, "k", cutoff).count() == 2000 - expected
    assert "GreaterThanOrEqual(k," in explained(doomed(table, "k", 10.1))
    assert "LessThan(k," in explained(survivors(table, "k", 10.1))
