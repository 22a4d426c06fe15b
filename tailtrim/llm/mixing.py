"""Mix sources to target weights by weighted fair queueing.

Every document of a source, in shuffled order, gets a virtual finish time: the words of its source
up to and with it, divided by the source's target. A source may be passed through several times; a
later pass starts where the one before ended. All copies of all documents are put in order of their
finish time, and the mix is what comes before the budget, the words of the whole table, is used up.
As finish times of all sources run from 0 to 1 over their targets, the mix takes from each source
what is due to it, and any prefix of the order is mixed in the same proportions.

Nothing but ids, sizes and keys is shuffled. Prefix sums run in two steps (``running_totals``): over
the rows of a small part, and over one line per part, so that a hot source is spread over tasks. The
order is cut into ranges of virtual time; only the one range in which the budget ends is sorted.

Defined results: a null or empty text, or one of spaces only, has size 0 and is never taken. A null
source is a source of its own, the last. A null id is shuffled by its own key, the text breaks ties
of repeated ids; of repeated rows it does not matter which is first. An empty table gives no rows.
Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tailtrim.llm.common import WORD, columns_or_null, running_totals, saved, table

SEED = "mix"
MAX_REPEATS = 3
# The weights of the sources, repeating in order of their names.
WEIGHTS = (1, 2, 3)
# Digits of the shuffle key that part a source, and ranges of virtual time below 1.
PART_DIGITS = 3
RANGES = 4096


def source_targets(sized: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``src, source, source_size, target`` with one line per source.

    Sources share the words of all by their weights. One whose share is above ``max_repeats`` times
    its size gets just that, and the rest is shared anew: in ascending order of cap by weight, the
    sources that are cut come first, so one pass over this order finds where cutting ends.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    all_rows = Window.partitionBy(F.lit(0))
    number = F.row_number().over(all_rows.orderBy(F.asc_nulls_last("source"))) - 1
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    sources = sources.select(
        "source", "source_size", number.alias("src"), (F.col("source_size") * max_repeats).alias("cap")
    ).withColumn("weight", F.element_at(weights, F.col("src") % len(WEIGHTS) + 1))
    by_cap = all_rows.orderBy(F.col("cap") / F.col("weight"), "src")
    earlier = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(earlier), F.lit(0))
    weight_left = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    levels = sources.select(
        "*", rest.cast("double").alias("rest"), weight_left.cast("double").alias("weight_left")
    ).withColumn("share", F.col("rest") * F.col("weight") / F.col("weight_left"))
    cut = F.col("share") > F.col("cap")
    # The first source that is not cut sets what a unit of weight is worth to all that follow.
    first = levels.select("*", cut.alias("cut")).withColumn(
        "level", F.first(F.when(~cut, F.struct("rest", "weight_left")), ignorenulls=True).over(
            by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        ),
    )
    shared = F.col("level.rest") * F.col("weight") / F.col("level.weight_left")
    target = F.when(F.col("cut"), F.col("cap").cast("double")).otherwise(shared)
    return first.select("src", "source", "source_size", target.alias("target"))


def mix(docs: DataFrame, seed: str = SEED, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``doc_id, size, source, source_size, target, taken`` of every row of ``docs``.

    Reruns agree: the shuffle is a hash of seed and id.
    """
    return _taken(docs, seed, max_repeats).drop("tie")


def mixed_rows(docs: DataFrame, seed: str = SEED, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The rows the mix takes, with all columns, each as often as it is taken.

    Equal rows are taken as often as that of them which is taken most.
    """
    taken = _taken(docs, seed, max_repeats).filter("taken > 0")
    ids = F.coalesce("doc_id", F.lit(-(2**63)))
    times = taken.groupBy(ids.alias("_id"), F.col("tie").alias("_tie")).agg(
        F.max(F.expr("taken div size")).cast("int").alias("_times")
    )
    rows = docs.select(
        F.struct("*").alias("_row"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("_id"),
        F.xxhash64(F.col("text").cast("string")).alias("_tie"),
    )
    # As many lines as documents taken, so the join always shuffles.
    joined = rows.join(times.hint("merge"), ["_id", "_tie"])
    return joined.select("_row", F.explode(F.sequence(F.lit(1), "_times"))).select("_row.*")


def _taken(docs: DataFrame, seed: str, max_repeats: int) -> DataFrame:
    needed = columns_or_null(docs, {"doc_id": "bigint", "source": "string", "text": "string"})
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    sized = saved(
        needed.select(
            "doc_id",
            "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
            key.alias("key"),
            F.xxhash64("text").alias("tie"),
        ),
        "sizes",
    )
    targets = saved(source_targets(sized, max_repeats), "targets")
    rows = sized.join(
        targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))
    ).drop("_source")
    rows = rows.withColumn("part", F.substring("key", 1, PART_DIGITS))
    queued = saved(
        running_totals(rows, ["size"], ["src"], "part", [F.col("key"), F.col("tie")]), "queue"
    )
    copies = queued.filter(F.col("size") > 0).select(
        "src", "key", "size", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("pass"),
        "size_before", "source_size", "target",
    ).select("src", "key", "size", _finish(F.col("pass")).alias("finish"))
    last = _last_copy(copies, queued.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("budget")))
    taken = sum(
        (_not_after(F.col("last"), _finish(F.lit(n))).cast("bigint") for n in range(max_repeats)),
        F.lit(0).cast("bigint"),
    )
    return queued.crossJoin(F.broadcast(last)).select(
        "doc_id", "size", "source", "source_size", "target",
        F.when(F.col("size") > 0, F.coalesce(taken, F.lit(0)) * F.col("size")).otherwise(F.lit(0))
        .cast("bigint").alias("taken"), "tie",
    )


def _finish(number: Column) -> Column:
    """Virtual finish time of a document's copy in a pass over its source."""
    words = number * F.col("source_size") + F.col("size_before") + F.col("size")
    return words.cast("double") / F.col("target")


def _not_after(last: Column, finish: Column) -> Column:
    """Whether a copy stands at or before the last one taken, in the order of the mix."""
    return F.struct(finish.alias("finish"), "src", "key") <= last


def _last_copy(copies: DataFrame, budget: DataFrame) -> DataFrame:
    """One row with the place, in the global order, of the last copy that fits the budget.

    Lines per range of virtual time tell in which range the budget ends; its copies are sorted.
    """
    ranged = copies.withColumn("range", F.floor(F.col("finish") * RANGES))
    upto = Window.partitionBy(F.lit(0)).orderBy("range")
    ends = ranged.groupBy("range").agg(F.sum("size").alias("words"))
    ends = ends.withColumn("until", F.sum("words").over(upto)).crossJoin(F.broadcast(budget))
    # The last range that begins within the budget; everything before it is taken whole.
    begins = F.col("until") - F.col("words")
    ending = ends.filter(begins < F.col("budget")).agg(
        F.max_by(F.struct("range", begins.alias("begins"), "budget"), "range").alias("at")
    ).select("at.*")
    inside = ranged.join(F.broadcast(ending), "range")
    order = Window.partitionBy("range").orderBy("finish", "src", "key")
    sums = inside.withColumn("until", F.col("begins") + F.sum("size").over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    place = F.struct("finish", "src", "key")
    within = sums.filter(F.col("until") <= F.col("budget")).agg(F.max(place).alias("last"))
    earlier = F.struct(
        (F.col("range") / F.lit(RANGES).cast("double")).alias("finish"), F.lit(-1).alias("src"), F.lit("").alias("key")
    )
    # If not even the range's first copy fits, the mix ends just before the range.
    return within.join(ending.select(earlier.alias("before")), F.lit(True), "left").select(
        F.coalesce("last", "before").alias("last")
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP5_SQL = f"""
    WITH sized AS (
        SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
               md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key
        FROM documents),
    named AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS src
        FROM sized GROUP BY source),
    weighed AS (SELECT *, 3 * source_size AS cap, src % 3 + 1 AS weight FROM named),
    levels AS (
        SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER earlier, 0) AS DOUBLE) AS rest,
               CAST(sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS DOUBLE) AS weight_left
        FROM weighed
        WINDOW earlier AS (ORDER BY cap / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    cut AS (SELECT *, rest * weight / weight_left > cap AS is_cut FROM levels),
    level AS (SELECT rest, weight_left FROM cut WHERE NOT is_cut ORDER BY cap / weight, src LIMIT 1),
    targets AS (
        SELECT src, source, source_size,
               CASE WHEN is_cut THEN CAST(cap AS DOUBLE)
                    ELSE (SELECT rest FROM level) * weight / (SELECT weight_left FROM level) END AS target
        FROM cut),
    queued AS (
        SELECT s.doc_id, s.size, s.key, t.src, t.source_size, t.target,
               sum(s.size) OVER (PARTITION BY t.src ORDER BY s.key
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
        FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
    copies AS (
        SELECT *, CAST(pass * source_size + upto AS DOUBLE) / target AS finish
        FROM queued, (SELECT unnest([0, 1, 2]) AS pass) WHERE size > 0),
    ordered AS (
        SELECT *, sum(size) OVER (ORDER BY finish, src, key
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used
        FROM copies),
    taken AS (
        SELECT doc_id, sum(size) AS taken FROM ordered
        WHERE used <= (SELECT sum(size) FROM sized) GROUP BY doc_id)
    SELECT q.doc_id, q.size, q.source_size, q.target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
    FROM queued q LEFT JOIN taken t USING (doc_id)"""
