"""Random sequences of purges and appends against a plain model of a table."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tailtrim.functions import literal_rows
from tailtrim.operators import Cutoffs
from tailtrim.plans import PurgeEntry, PurgeGroup, purge
from tailtrim.sources import Campaign, load

GROUP = PurgeGroup("g", True, (PurgeEntry("a", "sessionid"), PurgeEntry("b", "fileid")))


def random_rows(rng, size):
    """Ids with repeats, a third of them on one value, and some missing."""
    hot = rng.randrange(60)

    def one():
        return None if rng.random() < 0.1 else hot if rng.random() < 0.33 else rng.randrange(60)

    return [(one(), one(), rng.randrange(3)) for _ in range(size)]


def append(spark, root, table, rows, files):
    df = literal_rows(spark, rows, "sessionid bigint, fileid bigint, n bigint")
    df.repartition(files, F.col("n")).write.mode("append").parquet(f"{root}/{table}.parquet")


@pytest.mark.parametrize("seed", range(3))
def test_any_sequence_matches_the_model(spark, tmp_path, seed):
    rng = random.Random(seed)
    root = str(tmp_path)
    campaign = Campaign(root=root, publish_to=rng.choice([None, f"{root}/elsewhere"]))
    model = {}
    for table in "ab":
        model[table] = random_rows(rng, 60)
        append(spark, root, table, model[table], files=3)
    for _ in range(4):
        if rng.random() < 0.4:
            table = rng.choice("ab")
            new = random_rows(rng, 15)
            append(spark, root, table, new, files=2)
            model[table] += new
        cutoffs = Cutoffs(rng.uniform(10, 70), rng.uniform(10, 70))
        report = purge(spark, campaign, GROUP, cutoffs, atomic=rng.random() < 0.5).collect()
        for entry, place, line in zip(GROUP.active, (0, 1), report):
            cutoff = cutoffs.of(entry.key)
            before = model[entry.table]
            kept = [row for row in before if row[place] is None or row[place] < cutoff]
            assert (line.removed, line.kept) == (len(before) - len(kept), len(kept))
            model[entry.table] = kept
            found = load(spark, campaign, entry.table).collect()
            assert Counter(map(tuple, found)) == Counter(kept)
