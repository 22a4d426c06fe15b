"""Drop recurring lines by a tree of line templates.

Lines are parsed at fixed depth: by their number of tokens, then by their leading tokens. Tokens with a
digit are variable and become ``<*>`` before. The different lines of a leaf are taken in order, those of
most documents first, then by text: a line that agrees with an earlier hub of its leaf in enough places
has the template of the first such hub, and where they differ the template is variable; any other line
is a hub itself. A template that occurs in several documents is boilerplate: its lines are dropped from
all of them. Everything is built of DataFrame functions.

Two lines that differ in at most d places are equal in one of d + 1 runs of the places behind the
leading ones. So lines only meet in the buckets of their runs, and buckets of one line are dropped at
once. All leaves are worked on at the same time. In each round the lines of a bucket are compared with
its heads, the first few lines of it without a hub. A line that is a head in all its buckets and unlike
all heads ahead of it is a hub, for no line before it can be alike. A line that is alike to a hub will
not be one; it only goes on in buckets where a line ahead of that hub may still become one. A bucket has
two heads at first and two more for every hub that it had (``MOST_HEADS`` at a time), so that there are far
fewer rounds than hubs in a bucket. Heads that wait for another bucket are compared once more. Lines
are known by their rank in the order, so a round moves numbers, and the lines of pairs to compare.

Each text is tokenised once. What is shuffled is hashes of lines, the lines, once, to find those of the
leaves that hold several different ones, and the texts, once, to drop lines from them. Counts are made of distinct pairs,
pre-aggregated, so a line with a third of all rows is no hot group.

Defined results: a null or empty text has no lines and stays empty; blank lines are never dropped and
do not count. Rows with equal id and text are one document, so repeating a row drops nothing. An empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tailtrim.llm.common import WORD, columns_or_null, saved, table

# Leading tokens that lead to a leaf, share of equal tokens within a template, documents it occurs in.
DEPTH = 3
SIMILAR = 0.8
LEAST_DOCS = 2
# Open lines of a bucket that its lines are compared with in the first round, and at most in any; only
# the number of rounds depends on them.
FIRST_HEADS = 2
MOST_HEADS = 1000
VARIABLE = "<*>"
# Tokens with a digit, told at their first character; possessive, so nothing is tried twice.
_WITH_DIGIT = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
_BLANKS = r"[\x20\x09\x0B-\x0D]+"
_UNEVEN = r"[0-9\x09\x0B-\x0D]|\x20\x20"

_DOC = ("doc_id", "tie")
_LINE = ("leaf", "body")


def _lines(docs: DataFrame, depth: int) -> DataFrame:
    """One row for each line that is not blank: its tokens joined by spaces, hashes of leaf and line."""
    split = docs.select(*_DOC, F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
    # Most lines are as they should be: the replacing expressions run on the others only.
    masked = F.regexp_replace(F.regexp_replace("line", _WITH_DIGIT, VARIABLE), _BLANKS, " ")
    line = F.when(F.col("line").rlike(_UNEVEN), masked).otherwise(F.col("line"))
    lines = split.withColumn("line", F.trim(line)).filter("line <> ''")
    tokens = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    leaf = F.xxhash64(tokens, F.substring_index("line", " ", depth))
    return lines.withColumn("leaf", leaf).withColumn("body", F.xxhash64("line"))


def _buckets(texts: DataFrame, depth: int, similar: float) -> DataFrame:
    """``bucket, rank`` of the runs that a line shares with another one of its leaf."""
    size = F.size("tokens")
    rest = F.greatest(size - depth, F.lit(0))
    # As many runs as places in which alike lines may differ, and one; of no line more than places.
    runs = F.least(rest, size - F.ceil(F.lit(similar) * size - F.lit(1e-6)) + 1).cast("int")

    def piece(run: Column) -> Column:
        first, last = (F.floor(r * rest / runs).cast("int") for r in (run, run + 1))
        return F.xxhash64("leaf", run, F.array_join(F.slice("tokens", depth + first + 1, last - first), " "))

    cut = texts.select("rank", "leaf", F.split("line", " ").alias("tokens")).filter(rest > 0)
    cut = cut.select("rank", F.explode(F.transform(F.sequence(F.lit(0), runs - 1), piece)).alias("bucket"))
    shared = cut.groupBy("bucket").agg(F.count("*").alias("lines")).filter("lines > 1").select("bucket")
    return cut.join(shared, "bucket", "left_semi").select("bucket", "rank")


def _templates(texts: DataFrame, depth: int, similar: float) -> DataFrame:
    """``rank, hub`` of the lines that are alike to a hub: the rank of the first such one."""
    tokens = [F.split(name, " ") for name in ("line", "head_line")]
    equal = F.size(F.filter(F.zip_with(*tokens, lambda a, b: a == b), lambda same: same))
    is_alike = equal >= F.lit(similar) * F.size(tokens[0])
    lines = texts.select("rank", "line")
    head_lines = lines.toDF("head", "head_line")
    is_open = F.col("best").isNull()
    turn = F.row_number().over(Window.partitionBy("bucket").orderBy("rank"))
    found, most = [], FIRST_HEADS
    # ``best`` is the first hub that a line is alike to so far; a line without one is open. ``passed``
    # counts the hubs that a bucket had: the more, the more of its open lines are heads at a time.
    entries = _buckets(texts, depth, similar).select(
        "bucket", "rank", F.lit(None).cast("bigint").alias("best"), F.lit(0).cast("bigint").alias("passed")
    )
    entries = saved(entries, "entries")
    while not entries.filter(is_open).isEmpty():
        first = entries.filter(is_open).withColumn("turn", turn).filter(F.col("turn") <= most)
        first = first.filter(F.col("turn") <= FIRST_HEADS + 2 * F.col("passed"))
        heads = first.groupBy("bucket").agg(F.collect_list("rank").alias("heads"))
        ahead = F.filter("heads", lambda head: head < F.least("rank", "best"))
        met = entries.join(heads, "bucket").select(
            "rank", is_open.alias("is_open"), F.array_contains("heads", F.col("rank")).alias("is_head"), ahead.alias("ahead")
        )
        met = saved(met, "met")
        pairs = met.select("rank", F.explode("ahead").alias("head")).distinct()
        alike = saved(
            pairs.join(lines, "rank").join(head_lines, "head").filter(is_alike).select("rank", "head"), "alike"
        )
        # A hub is an open line that all open lines ahead of it, in all its buckets, are unlike.
        ready = met.filter("is_open").groupBy("rank").agg(F.min("is_head").alias("ready")).filter("ready")
        hubs = saved(ready.select(F.col("rank").alias("head")).join(
            alike.select(F.col("rank").alias("head")), "head", "left_anti"), "hubs")
        named = saved(alike.join(hubs, "head", "left_semi").groupBy("rank").agg(F.min("head").alias("hub")), "named")
        found.append(named)
        news = named.unionAll(hubs.select(F.col("head").alias("rank"), F.lit(-1).cast("bigint").alias("hub")))
        left = entries.join(news, "rank", "left").select(
            "bucket", "rank", F.least("best", "hub").alias("best"), "passed"
        )
        # A line goes on in a bucket that has an open line ahead of its best hub; an open line in any.
        state = left.groupBy("bucket").agg(
            F.min(F.when(is_open, F.col("rank"))).alias("first"), F.count_if(F.col("best") == -1).alias("new")
        )
        going = left.join(state.filter("first IS NOT NULL"), "bucket").filter("best IS NULL OR first < best")
        entries = saved(going.select("bucket", "rank", "best", (F.col("passed") + F.col("new")).alias("passed")), "entries")
        most = min(3 * most, MOST_HEADS)
    none = texts.limit(0).select("rank", F.col("rank").alias("hub"))
    return reduce(DataFrame.unionAll, found, none).groupBy("rank").agg(F.min("hub").alias("hub"))


def recurring_lines(
    docs: DataFrame, depth: int = DEPTH, similar: float = SIMILAR, least_docs: int = LEAST_DOCS
) -> DataFrame:
    """``doc_id, tie, place`` of the lines whose template recurs; ``docs`` has ``doc_id, tie, text``."""
    lines = saved(_lines(docs, depth), "lines")
    placed = lines.select(*_DOC, "place", *_LINE)
    of_docs = placed.select(*_DOC, *_LINE).distinct()
    bodies = saved(of_docs.groupBy(*_LINE).agg(F.count("*").alias("docs")), "bodies")
    # A leaf with several lines may hold a template of several documents; else a line's own count tells.
    several = bodies.groupBy("leaf").agg(F.count("*").alias("bodies")).filter("bodies > 1").select("leaf")
    some = saved(bodies.join(several, "leaf", "left_semi"), "some")
    texts = lines.select(*_LINE, "line").join(some.select(*_LINE).hint("merge"), [*_LINE], "left_semi")
    texts = texts.groupBy(*_LINE).agg(F.min("line").alias("line")).join(some, [*_LINE])
    # Ranks ascend in the order of the lines, over all leaves; written down, they stay as they are.
    ordered = texts.orderBy(F.desc("docs"), "line").withColumn("rank", F.monotonically_increasing_id())
    texts = saved(ordered.select("rank", *_LINE, "line"), "texts")
    templates = saved(_templates(texts, depth, similar), "templates")
    ranks = texts.select("rank", *_LINE)
    hub_bodies = ranks.toDF("hub", "hub_leaf", "template")
    named = ranks.join(templates, "rank").join(hub_bodies, "hub").select(*_LINE, "template")
    # Lines without a hub are their own template; only those that share one are counted anew.
    members = saved(
        named.unionAll(named.select("leaf", F.col("template").alias("body"), "template")).distinct(), "members"
    )
    joint = of_docs.join(members, [*_LINE]).select(*_DOC, "leaf", "template").distinct()
    spread = joint.groupBy("leaf", "template").agg(F.count("*").alias("docs")).filter(F.col("docs") >= least_docs)
    shared = members.join(spread.select("leaf", "template"), ["leaf", "template"]).select(*_LINE)
    own = bodies.filter(F.col("docs") >= least_docs).select(*_LINE)
    recurring = saved(own.unionAll(shared).distinct(), "recurring")
    return placed.join(recurring, [*_LINE], "left_semi").select(*_DOC, "place")


def drop_recurring_lines(docs: DataFrame, **settings) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped`` of every row, the text without its recurring lines."""
    docs = columns_or_null(docs, {"doc_id": "bigint", "text": "string"})
    docs = docs.select(
        F.coalesce("doc_id", F.lit(-(2**63))).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("tie", F.xxhash64("text"))
    # Equal rows count once; a line of a document is a place, so a set is bounded by the document.
    dropped = recurring_lines(docs, **settings).groupBy(*_DOC).agg(F.collect_set("place").alias("dropped"))
    # What is dropped grows with the texts, so that it is never broadcast: the plan is alike at every size.
    dropped = saved(dropped, "dropped").hint("merge")
    none = F.array().cast("array<int>")
    joined = docs.join(dropped, [*_DOC], "left").withColumn("dropped", F.coalesce("dropped", none))
    lines = joined.withColumn("lines", F.split("text", "\n", -1))
    kept = F.filter("lines", lambda line, place: ~F.array_contains("dropped", place))
    full = F.size(F.filter("lines", lambda line: line.rlike(WORD)))
    return lines.select(
        F.when(F.col("doc_id") != -(2**63), F.col("doc_id")).alias("doc_id"),
        F.array_join(kept, "\n").alias("text"),
        full.alias("n_lines"),
        F.size("dropped").alias("n_dropped"),
    )


def op2_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = drop_recurring_lines(table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id", "n_lines", "n_dropped", F.length("text").alias("kept_chars"), F.md5("text").alias("kept_md5")
    )


# The oracle's expressions know no possessive pattern; this one says the same.
_WITH_DIGIT_SQL = r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*"

OP2_SQL = f"""
    WITH RECURSIVE docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    split AS (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place FROM docs),
    tokens AS MATERIALIZED (
        SELECT *, regexp_extract_all(regexp_replace(line, '{_WITH_DIGIT_SQL}', '{VARIABLE}', 'g'), '{WORD}') AS tokens
        FROM split),
    lines AS MATERIALIZED (
        SELECT doc_id, place, tokens, len(tokens) || ' ' || array_to_string(tokens[1:{DEPTH}], ' ') AS leaf,
               array_to_string(tokens, ' ') AS body FROM tokens WHERE len(tokens) > 0),
    bodies AS (SELECT leaf, body, any_value(tokens) AS tokens, count(DISTINCT doc_id) AS docs FROM lines GROUP BY ALL),
    ordered AS MATERIALIZED (
        SELECT *, row_number() OVER (PARTITION BY leaf ORDER BY docs DESC, body) AS turn FROM bodies),
    -- One line of every leaf at a time: the first hub it is alike to, or a hub itself.
    named AS (
        SELECT leaf, turn, body, body AS template, [{{'body': body, 'tokens': tokens}}] AS hubs FROM ordered WHERE turn = 1
        UNION ALL
        SELECT leaf, turn, body, coalesce(near.body, body) AS template,
               CASE WHEN near IS NULL THEN list_append(hubs, {{'body': body, 'tokens': tokens}}) ELSE hubs END AS hubs
        FROM (SELECT o.leaf, o.turn, o.body, o.tokens, n.hubs,
                     list_filter(n.hubs, lambda h: len(list_filter(range(1, len(o.tokens) + 1),
                         lambda i: h.tokens[i] = o.tokens[i])) >= {SIMILAR} * len(o.tokens))[1] AS near
              FROM named n JOIN ordered o ON o.leaf = n.leaf AND o.turn = n.turn + 1)),
    placed AS MATERIALIZED (
        SELECT doc_id, place, leaf, template FROM lines JOIN (SELECT leaf, body, template FROM named) USING (leaf, body)),
    recurring AS (
        SELECT leaf, template FROM placed GROUP BY ALL HAVING count(DISTINCT doc_id) >= {LEAST_DOCS}),
    dropped AS (
        SELECT doc_id, list(place) AS places FROM placed SEMI JOIN recurring USING (leaf, template) GROUP BY doc_id),
    kept AS (
        SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY place)
                                FILTER (WHERE NOT coalesce(list_contains(places, place), false)), '') AS text,
               CAST(count(*) FILTER (WHERE len(tokens) > 0) AS INT) AS n_lines,
               CAST(count(*) FILTER (WHERE coalesce(list_contains(places, place), false)) AS INT) AS n_dropped
        FROM tokens LEFT JOIN dropped USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, n_lines, n_dropped, CAST(length(text) AS INT) AS kept_chars, md5(text) AS kept_md5 FROM kept"""
