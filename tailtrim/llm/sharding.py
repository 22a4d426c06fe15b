"""Shard documents by a consistent-hash ring with virtual nodes and bounded loads.

Each shard has many virtual nodes on a ring, each document a place on it, the hash of its text, so
that equal texts lie together. A document belongs to the first node clockwise from its place. Every
shard has room for its even share of the rows, and shares differ by one row at most. What does not
fit a full shard continues clockwise to the first node of a shard with room, so that the counts are
even by construction and only the overflow moves.

The ring has a fixed number of places and nodes, so the filling runs on one line per node (an arc of
the ring) and not on documents: each round sends what an arc has left to the first open shard
clockwise, and each shard accepts up to its room, arcs in ring order. A round closes a shard or ends
the filling, so there are at most as many rounds as shards. A document then follows from its rank in
its arc; ranks are counted in parts, so a text with a third of all rows is spread over tasks.

Law: ``rows``. Defined results: a null text has no bytes and the place of an empty one; a null id is
ranked as the text 'null'; of equal rows any may come first; an empty table gives no rows; further
columns are ignored by the query and kept by :func:`shard`'s ``keep``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tailtrim.llm.common import columns_or_null, running_totals, saved, table

SHARDS = 40
NODES = 128
# Places on the ring: the first four hexadecimal digits of a hash.
PLACES = 65536
ROW_BYTES = 16
# Rounds of filling that make one job.
ROUNDS_AT_ONCE = 8

_TEXT_KEY = "md5(coalesce(text, ''))"


def _digits(key: Column, first: int, count: int) -> Column:
    return F.conv(F.substring(key, first, count), 16, 10).cast("int")


def ring(spark: SparkSession, shards: int = SHARDS, nodes: int = NODES) -> DataFrame:
    """``arc, shard, node_place``: the virtual nodes in ring order, ``shards * nodes`` lines."""
    node = spark.range(0, shards * nodes, 1, 1).select(
        (F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).alias("n")
    )
    key = F.md5(F.concat_ws(":", F.lit("node"), "shard", "n"))
    order = Window.partitionBy(F.lit(0)).orderBy("node_place", "shard", "n")
    return node.withColumn("node_place", _digits(key, 1, 4)).select(
        (F.row_number().over(order) - 1).alias("arc"), "shard", "node_place"
    )


def arcs_of_places(spark: SparkSession, nodes: DataFrame, count: int) -> DataFrame:
    """``place, arc``: for each of the ring's places, the first node clockwise; fixed in size."""
    here = nodes.groupBy(F.col("node_place").alias("place")).agg(F.count("*").alias("here"))
    places = spark.range(0, PLACES, 1, 1).select(F.col("id").cast("int").alias("place"))
    order = Window.partitionBy(F.lit(0)).orderBy("place")
    before = F.coalesce(
        F.sum(F.coalesce("here", F.lit(0))).over(order.rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    return places.join(here, "place", "left").select("place", (before % count).cast("int").alias("arc"))


def _fill(state: DataFrame, number: int) -> DataFrame:
    """One round; a line per arc: what it has ``left``, and the ``room`` of its own shard."""
    whole = Window.partitionBy(F.lit(0)).orderBy("arc")
    # The same frame as from here to the end of the ring, but grown row by row.
    backward = Window.partitionBy(F.lit(0)).orderBy(F.desc("arc"))
    onward = backward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    around = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    is_open = F.when(F.col("room") > 0, F.struct("shard", "room"))
    goal = F.coalesce(
        F.last(is_open, ignorenulls=True).over(onward), F.first(is_open, ignorenulls=True).over(around)
    )
    queue = Window.partitionBy("goal.shard").orderBy("is_moved", "arc")
    ahead = F.coalesce(F.sum("left").over(queue.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    accepted = F.greatest(F.lit(0), F.least(F.col("left"), F.col("goal.room") - ahead))
    end = F.col("done") + F.col("accepted")
    span = F.struct(F.lit(number).alias("round"), F.col("done").alias("low"), end.alias("high"), "goal.shard")
    # What each shard took, as a map of one entry per shard.
    by_goal = F.sum("accepted").over(Window.partitionBy("goal.shard"))
    took = F.map_from_entries(F.collect_set(
        F.when(F.col("goal").isNotNull(), F.struct("goal.shard", "by_goal"))).over(around))
    return (
        state.withColumn("goal", goal)
        .withColumn("is_moved", (F.col("shard") != F.col("goal.shard")).cast("int"))
        .withColumn("accepted", F.coalesce(accepted, F.lit(0)))
        .withColumn("by_goal", by_goal)
        .withColumn("took", took)
        .select(
            "arc", "shard",
            (F.col("room") - F.coalesce(F.element_at("took", F.col("shard")), F.lit(0))).alias("room"),
            (F.col("left") - F.col("accepted")).alias("left"),
            end.alias("done"),
            F.when(F.col("accepted") > 0, F.concat("spans", F.array(span))).otherwise(F.col("spans")).alias("spans"),
        )
    )


def fill_ring(counts: DataFrame, nodes: DataFrame, shards: int) -> DataFrame:
    """``arc, low, high, shard, base``: which ranks of an arc go to which shard, from which slot on.

    ``counts`` has ``arc, n``. The rows are divided evenly; the first shards take one row more where
    they do not divide.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    room = F.floor(F.col("total") / shards) + (F.col("shard") < F.col("total") % shards).cast("bigint")
    none = F.array().cast("array<struct<round:int,low:bigint,high:bigint,shard:int>>")
    state = nodes.join(counts, "arc", "left").crossJoin(F.broadcast(total)).select(
        "arc", "shard", room.alias("room"), F.coalesce("n", F.lit(0)).alias("left"),
        F.lit(0).cast("bigint").alias("done"), none.alias("spans"),
    )
    for first in range(0, shards, ROUNDS_AT_ONCE):
        # The ring is fixed in size: its windows run in one task without an exchange.
        state = state.coalesce(1)
        for number in range(first, min(first + ROUNDS_AT_ONCE, shards)):
            state = _fill(state, number)
        state = saved(state, "filled")
        if state.filter(F.col("left") > 0).isEmpty():
            break
    order = Window.partitionBy("shard").orderBy("round", "arc")
    base = F.sum(F.col("high") - F.col("low")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = state.coalesce(1).select("arc", F.inline("spans"))
    return spans.select("arc", "low", "high", "shard", F.coalesce(base, F.lit(0)).alias("base"))


def shard(
    docs: DataFrame, shards: int = SHARDS, nodes: int = NODES, keep: Sequence[str] = ()
) -> DataFrame:
    """``doc_id, size, text_crc32, home, shard, slot`` of every row, and its columns in ``keep``.

    ``home`` is the shard of the ring without bounds; ``slot`` counts the rows of a shard from 0. Columns
    in ``keep`` come back under their own names; one that is named like a result comes back as
    ``document_<name>``.
    """
    spark = docs.sparkSession
    kept = [name for name in keep if name != "doc_id"]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = F.struct(F.lit(0).cast("tinyint").alias("_"), *[F.col(f"`{name}`").alias(f"_{i}") for i, name in enumerate(kept)])
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text).alias("_text_key"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias("_id_key"),
        *([own.alias("_row")] if kept else []),
    ).withColumns({
        "place": _digits(F.col("_text_key"), 1, 4),
        "part": F.substring("_id_key", 1, 2),
        "one": F.lit(1).cast("bigint"),
    })
    around = saved(ring(spark, shards, nodes), "ring")
    places = arcs_of_places(spark, around, shards * nodes)
    # The places of the ring are a parameter, so this table is the same size for any input.
    placed = saved(rows.join(F.broadcast(places), "place").drop("place"), "placed")
    spans = fill_ring(placed.groupBy("arc").agg(F.count("*").alias("n")), around, shards)
    ranked = running_totals(
        placed, ["one"], ["arc"], "part", [F.col("_text_key"), F.col("_id_key")]
    )
    # At most shards * shards * nodes lines, whatever the input.
    inside = (F.col("one_before") >= F.col("low")) & (F.col("one_before") < F.col("high"))
    sharded = ranked.join(F.broadcast(spans), "arc").filter(inside)
    homes = around.select("arc", F.col("shard").alias("home"))
    results = {
        "doc_id": F.col("doc_id"), "size": F.col("size"), "text_crc32": F.col("text_crc32"),
        "home": F.col("home"), "shard": F.col("shard"),
        "slot": F.col("base") + F.col("one_before") - F.col("low"),
    }
    taken = {*results, *[name.lower() for name in kept if name.lower() not in results]}
    names = []
    for name in kept:
        own = name
        while name.lower() in results and own.lower() in taken:
            own = f"document_{own}"
        taken.add(own.lower())
        names.append(own)
    return sharded.join(F.broadcast(homes), "arc").select(
        *[value.alias(name) for name, value in results.items()],
        *[F.col(f"_row._{i}").alias(name) for i, name in enumerate(names)],
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shard(columns_or_null(table(spark, sf_dir, "documents"), {"doc_id": "bigint", "text": "string"}))
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _round_sql(number: int) -> str:
    """The lines of one round, as the round before left them."""
    return f"""
    goal{number} AS MATERIALIZED (
        SELECT s.*, coalesce(first_value(CASE WHEN room > 0 THEN {{'s': shard, 'r': room}} END IGNORE NULLS) OVER (
                   ORDER BY arc ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
               first_value(CASE WHEN room > 0 THEN {{'s': shard, 'r': room}} END IGNORE NULLS) OVER (
                   ORDER BY arc ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS goal
        FROM state{number} s),
    filled{number} AS MATERIALIZED (
        SELECT *, coalesce(greatest(0, least(rest, goal.r - coalesce(sum(rest) OVER (
                   PARTITION BY goal.s ORDER BY shard <> goal.s, arc
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))), 0) AS accepted
        FROM goal{number}),
    state{number + 1} AS MATERIALIZED (
        SELECT arc, shard, room - coalesce(taken, 0) AS room, rest - accepted AS rest, done + accepted AS done
        FROM filled{number} LEFT JOIN (
            SELECT goal.s AS shard, sum(accepted) AS taken FROM filled{number} GROUP BY ALL) USING (shard))"""


# CRC-32 is not a function of the oracle: it is folded over the bytes with its table.
OP6_SQL = f"""
    WITH bits AS (SELECT b, 0 AS k, CAST(b AS UBIGINT) AS c FROM range(256) t(b)),
    RECURSIVE_TABLE AS (
        SELECT list(list_reduce(list_prepend(c, CAST(range(8) AS UBIGINT[])),
                    lambda x, y: xor(x // 2, 3988292384 * (x % 2))) ORDER BY b) AS crc
        FROM bits),
    rows AS (
        SELECT doc_id, coalesce(text, '') AS body, {_TEXT_KEY} AS text_key,
               md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS id_key FROM documents),
    nodes AS (
        SELECT CAST(i % {SHARDS} AS INT) AS shard, i // {SHARDS} AS n FROM range({SHARDS * NODES}) t(i)),
    around AS MATERIALIZED (
        SELECT shard, place, row_number() OVER (ORDER BY place, shard, n) - 1 AS arc
        FROM (SELECT *, CAST('0x' || md5('node:' || shard || ':' || n)[1:4] AS INT) AS place FROM nodes)),
    placed AS MATERIALIZED (
        SELECT r.*, coalesce(
                   (SELECT min(arc) FROM around a WHERE a.place >= CAST('0x' || r.text_key[1:4] AS INT)), 0) AS arc
        FROM rows r),
    ranked AS MATERIALIZED (
        SELECT *, row_number() OVER (PARTITION BY arc ORDER BY id_key[1:2], text_key, id_key) - 1 AS rank
        FROM placed),
    state0 AS MATERIALIZED (
        SELECT a.arc, a.shard, t.n // {SHARDS} + CAST(a.shard < t.n % {SHARDS} AS INT) AS room,
               coalesce(c.n, 0) AS rest, 0 AS done
        FROM around a LEFT JOIN (SELECT arc, count(*) AS n FROM placed GROUP BY arc) c USING (arc),
             (SELECT count(*) AS n FROM placed) t),
    {", ".join(_round_sql(number) for number in range(SHARDS))},
    spans AS MATERIALIZED (
        SELECT *, coalesce(sum(high - low) OVER (PARTITION BY shard ORDER BY round, arc
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base
        FROM ({" UNION ALL ".join(
            f"SELECT {n} AS round, arc, done AS low, done + accepted AS high, goal.s AS shard "
            f"FROM filled{n} WHERE accepted > 0" for n in range(SHARDS))}))
    SELECT doc_id, CAST(strlen(body) + {ROW_BYTES} AS BIGINT) AS size,
           CAST(xor(list_reduce(list_prepend(4294967295::UBIGINT,
                   list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda h: CAST('0x' || h AS UBIGINT))),
                   lambda c, b: xor(crc[CAST(xor(c, b) & 255 AS BIGINT) + 1], c // 256)), 4294967295::UBIGINT) AS BIGINT) AS text_crc32,
           'rows' AS law, s.shard, CAST(base + rank - low AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard
    FROM ranked r JOIN spans s ON r.arc = s.arc AND r.rank >= s.low AND r.rank < s.high, RECURSIVE_TABLE"""
