"""Merkle manifest of a dataset: a content-addressed graph of digests, and proofs by descent.

Every row is a leaf, the SHA-256 of its values. Leaves of a group (here: a language) ascend by id; runs
of ``FANOUT`` nodes become the digest of their digests until one is left, the group's root. The roots of
the groups, ordered by group, become the root of the dataset in the same way.

The graph is kept as records, a digest and the digests it is made of, one table for each height above
the leaves. Nothing else is needed to prove a leaf: requests start at the root with the rank of the
group and the rank of the leaf in it, and descend. The digits of the rank, base ``FANOUT``, say which
child is next; the children that are not selected are collected. The segments of that path, reversed,
lead from the leaf to the root. Requests descend together: one that shares its way with others is one
row until they part, so the work is a row for every node on any of the ways, and payloads of requests
wait for the last step instead of travelling along.

Ranks are counted in ranges of ids, and runs are grouped by group and rank, so a group with a third of
all rows is spread over tasks like any other. Jobs grow with the height of the tree, the logarithm of
the rows. The roots of the groups are ranked in one task, a line for each language.

Defined results: a null value is a dash, null languages are one group, the first one; null ids come first and
are never tampered with; rows of equal id ascend by leaf, and equal rows are leaves of their own. An
empty table gives no rows and no root; further columns are ignored.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tailtrim.llm.common import columns_or_null, is_share, running_totals, saved, shared_folder, table
from tailtrim.llm.ranges import with_parts

FANOUT = 8

# The columns that make up a leaf, in this order.
LEAF = {"doc_id": "bigint", "source": "string", "lang": "string", "n_chars": "bigint", "text": "string"}

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def _part(column: Column) -> Column:
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(text: Column | None = None) -> Column:
    """The digest of a row; ``text`` in place of its own text if given."""
    columns = {name: F.col(name) for name in LEAF}
    if text is not None:
        columns["text"] = text
    return digest(F.concat(*[_part(c) for c in columns.values()]))


@dataclass(frozen=True)
class Level:
    """Where the records of a graph are, and the roots of its groups: ``group, height, digest``."""

    folder: str
    heights: int
    roots: DataFrame

    def records(self, height: int) -> DataFrame:
        return self.roots.sparkSession.read.parquet(f"{self.folder}/height-{height}")


@dataclass(frozen=True)
class Manifest:
    """The graph within the groups and the one above them; ``root`` is None without rows."""

    groups: Level
    top: Level
    root: str | None


def ranked(leaves: DataFrame) -> DataFrame:
    """Add ``pos``, the rank of a leaf in its group, and ``n``, the group's leaves.

    ``leaves`` has ``group`` (not null), ``doc_id`` and ``leaf``.
    """
    tie = F.conv(F.substring("leaf", 1, 2), 16, 10)
    parts = with_parts(leaves, tie=tie).withColumn("one", F.lit(1).cast("bigint"))
    order = [F.col("order_id"), F.col("leaf")]
    counted = running_totals(parts, ["one"], ["group"], "part", order, with_total=True)
    renamed = counted.withColumnsRenamed({"one_before": "pos", "one_total": "n"})
    return renamed.drop("one", "part", "order_id")


def build(nodes: DataFrame, folder: str) -> Level:
    """Write the records above some nodes, ``group, pos, n, digest``, a table for each height."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    height, roots = 0, []
    while True:
        root = nodes.filter("n = 1").select("group", F.lit(height).alias("height"), "digest")
        roots.append(root)
        if most <= 1:
            break
        run = [F.col("group"), F.floor(F.col("pos") / FANOUT).alias("pos"), "n"]
        children = F.transform(F.sort_array(F.collect_list(F.struct("pos", "digest"))), lambda c: c.digest)
        parents = nodes.filter("n > 1").groupBy(*run).agg(children.alias("children"))
        parents = saved(
            parents.select(
                "group", "pos", F.ceil(F.col("n") / FANOUT).alias("n"),
                digest(F.array_join("children", "")).alias("digest"), "children",
            ),
            "parents",
        )
        height, most = height + 1, -(-most // FANOUT)
        parents.select("digest", "children").dropDuplicates(["digest"]).write.parquet(f"{folder}/height-{height}")
        nodes = parents.drop("children")
    found = roots[0]
    for more in roots[1:]:
        found = found.unionAll(more)
    return Level(folder, height, saved(found, "roots"))


def write_manifest(leaves: DataFrame, folder: str) -> Manifest:
    """The manifest of ranked leaves, ``group, pos, n, leaf``, below ``folder``."""
    nodes = leaves.select("group", "pos", "n", F.col("leaf").alias("digest"))
    groups = build(nodes, f"{folder}/groups")
    whole = Window.partitionBy(F.lit(0))
    subroots = groups.roots.select(
        F.lit("").alias("group"),
        (F.row_number().over(whole.orderBy("group")) - 1).cast("bigint").alias("pos"),
        F.count("*").over(whole).alias("n"),
        "digest",
        F.col("group").alias("name"),
    )
    subroots = saved(subroots, "subroots")
    top = build(subroots.drop("name"), f"{folder}/top")
    root = top.roots.first()
    return Manifest(groups, top, root.digest if root else None)


_PATH = "array<struct<before:string,after:string>>"


def descend(level: Level, starts: DataFrame, requests: DataFrame, payload: list[str]) -> DataFrame:
    """``group, pos, digest, path, start`` and the payload of each requested leaf, by the records.

    ``starts`` has ``group, height, digest``, a ``path`` that leads to it and what to keep as ``start``;
    ``requests`` has ``group, pos`` and the payload, once for each leaf. Segments of a path hold the
    siblings before and after the selected node; the last segment is that of the leaf.
    """
    own = F.struct(F.lit(0).alias("_"), *payload).alias("payload")
    asked = requests.select("group", "pos", own)
    wanted = [asked]
    for height in range(1, level.heights + 1):
        child = F.struct((F.col("pos") % FANOUT).cast("int").alias("digit"), *(["payload"] if height == 1 else []))
        grouped = wanted[-1].groupBy("group", F.floor(F.col("pos") / FANOUT).alias("pos"))
        wanted.append(grouped.agg(F.collect_list(child).alias("selected")))
        if 1 < height < level.heights:
            wanted[-1] = saved(wanted[-1], "wanted")

    def started(height: int) -> DataFrame:
        at = starts.filter(F.col("height") == height)
        return at.select("group", F.lit(0).cast("bigint").alias("pos"), "digest", "path", "start")

    front = started(level.heights)
    for height in range(level.heights, 0, -1):
        met = front.join(wanted[height], ["group", "pos"]).join(level.records(height), "digest")
        last = height == 1
        digit = F.col("one.digit")
        segment = F.struct(
            F.array_join(F.slice("children", 1, digit), "").alias("before"),
            F.array_join(F.slice("children", digit + 2, FANOUT), "").alias("after"),
        )
        front = met.withColumn("one", F.explode("selected")).select(
            "group",
            (F.col("pos") * FANOUT + digit).alias("pos"),
            F.element_at("children", digit + 1).alias("digest"),
            F.concat("path", F.array(segment)).cast(_PATH).alias("path"),
            "start",
            *(["one.payload"] if last else []),
        )
        if not last:
            front = saved(front.unionAll(started(height - 1)), "front")
    # Groups of one leaf have no records: their root is the leaf.
    lone = started(0).join(asked, ["group", "pos"])
    found = front.unionByName(lone) if level.heights else lone
    return found.select("group", "pos", "digest", "path", "start", *[f"payload.{name}" for name in payload])


def prove(manifest: Manifest, requests: DataFrame, payload: list[str]) -> DataFrame:
    """``leaf, subroot, root, path`` and the payload of each request, ``group, pos``.

    ``path`` leads from the leaf to the root.
    """
    names = saved(manifest.groups.roots.withColumnRenamed("digest", "subroot"), "names")
    order = Window.partitionBy(F.lit(0)).orderBy("group")
    ranks = names.select(
        F.lit("").alias("group"), (F.row_number().over(order) - 1).cast("bigint").alias("pos"),
        F.col("group").alias("name"), F.col("height").alias("under"),
    )
    top = manifest.top.roots.select(
        "group", "height", "digest", F.array().cast(_PATH).alias("path"), F.col("digest").alias("start")
    )
    reached = saved(descend(manifest.top, top, ranks, ["name", "under"]), "reached")
    starts = reached.select(
        F.col("name").alias("group"), F.col("under").alias("height"), "digest", "path",
        F.struct(F.col("digest").alias("subroot"), F.col("start").alias("root")).alias("start"),
    )
    found = descend(manifest.groups, starts, requests, payload)
    return found.select(
        F.col("digest").alias("leaf"), "start.subroot", "start.root", F.reverse("path").alias("path"), *payload
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path make."""
    return F.aggregate(path, leaf, lambda low, s: digest(F.concat(s.before, low, s.after)))


def siblings_digest(path: Column) -> Column:
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s.before, s.after)), ""))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = columns_or_null(table(spark, sf_dir, "documents"), LEAF)
    lowered = F.translate("text", _CAPITALS, _CAPITALS.lower())
    leaves = docs.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("1"), "lang"), F.lit("0")).alias("group"),
        leaf_digest().alias("leaf"),
        F.when(is_share("doc_id", 3, 0), leaf_digest(lowered)).alias("tampered"),
    )
    leaves = saved(ranked(saved(leaves, "leaves")), "ranked")
    folder = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/manifest"
    manifest = write_manifest(leaves, folder)
    proven = prove(manifest, leaves.select("group", "pos", "doc_id", "tampered"), ["doc_id", "tampered"])
    again = folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return proven.select(
        "doc_id", "leaf", "subroot", "root", siblings_digest(F.col("path")).alias("proof_sha256"),
        again.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


_VALUE = "coalesce(CAST(strlen({0}) AS VARCHAR) || ':' || {0}, '-')"


def _leaf_sql(text: str) -> str:
    names = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return f"sha256({' || '.join(_VALUE.format(name) for name in names)})"


# CRC-32 is not a function of the oracle: it is folded over the bytes, bit by bit.
OP11_SQL = f"""
    WITH RECURSIVE docs AS MATERIALIZED (
        SELECT *, {_leaf_sql("text")} AS leaf,
               {_leaf_sql(f"translate(text, '{_CAPITALS}', '{_CAPITALS.lower()}')")} AS lowered,
               xor(list_reduce(list_prepend(4294967295::UBIGINT,
                   list_transform(regexp_extract_all(CAST(doc_id AS VARCHAR), '.'), lambda d: CAST(ascii(d) AS UBIGINT))),
                   lambda c, b: list_reduce(list_prepend(xor(c, b), CAST(range(8) AS UBIGINT[])),
                                            lambda x, y: xor(x // 2, 3988292384 * (x % 2)))), 4294967295::UBIGINT) AS crc
        FROM documents),
    names AS MATERIALIZED (
        SELECT lang, row_number() OVER (ORDER BY lang IS NOT NULL, encode(lang)) - 1 AS name FROM (SELECT DISTINCT lang FROM documents)),
    leaves AS MATERIALIZED (
        SELECT docs.*, name, row_number() OVER (PARTITION BY name ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
        FROM docs JOIN names ON docs.lang IS NOT DISTINCT FROM names.lang),
    inner_nodes AS MATERIALIZED (
        SELECT name, 0 AS height, pos, leaf AS digest, count(*) OVER (PARTITION BY name) AS n FROM leaves
        UNION ALL
        SELECT name, any_value(height) + 1, pos // {FANOUT}, sha256(string_agg(digest, '' ORDER BY pos)),
               CAST(ceil(any_value(n) / {FANOUT}) AS BIGINT)
        FROM inner_nodes WHERE n > 1 GROUP BY name, pos // {FANOUT}),
    subroots AS MATERIALIZED (SELECT name, height, digest FROM inner_nodes WHERE n = 1),
    top_nodes AS MATERIALIZED (
        SELECT 0 AS height, name AS pos, digest, count(*) OVER () AS n FROM subroots
        UNION ALL
        SELECT any_value(height) + 1, pos // {FANOUT}, sha256(string_agg(digest, '' ORDER BY pos)),
               CAST(ceil(any_value(n) / {FANOUT}) AS BIGINT)
        FROM top_nodes WHERE n > 1 GROUP BY pos // {FANOUT}),
    -- All nodes below a group's root, then those below the root, as one numbered ladder for each group.
    ladder AS MATERIALIZED (
        SELECT name, height, pos, digest FROM inner_nodes WHERE n > 1
        UNION ALL
        SELECT s.name, s.height + t.height, t.pos, t.digest FROM subroots s, top_nodes t WHERE t.n > 1),
    steps AS MATERIALIZED (
        SELECT l.doc_id, l.leaf, l.name, l.pos AS leaf_pos, k.height,
               coalesce(string_agg(d.digest, '' ORDER BY d.pos) FILTER (WHERE d.pos < k.at), '') AS before,
               coalesce(string_agg(d.digest, '' ORDER BY d.pos) FILTER (WHERE d.pos > k.at), '') AS after
        FROM leaves l
        JOIN (SELECT r.name, h.height, p.pos AS leaf_pos,
                     CASE WHEN h.height < r.height THEN p.pos // CAST(pow({FANOUT}, h.height) AS BIGINT)
                          ELSE r.name // CAST(pow({FANOUT}, h.height - r.height) AS BIGINT) END AS at
              FROM subroots r JOIN (SELECT DISTINCT name, height FROM ladder) h USING (name)
              JOIN (SELECT name, pos FROM leaves) p USING (name)) k
          ON k.name = l.name AND k.leaf_pos = l.pos
        JOIN ladder d ON d.name = k.name AND d.height = k.height AND d.pos // {FANOUT} = k.at // {FANOUT}
        GROUP BY ALL),
    proofs AS MATERIALIZED (
        SELECT name, leaf_pos AS pos, sha256(string_agg(before || after, '' ORDER BY height)) AS proof FROM steps GROUP BY ALL),
    folds AS (
        SELECT name, pos, 0 AS height, CASE WHEN crc % 3 = 0 THEN lowered ELSE leaf END AS digest FROM leaves
        UNION ALL
        SELECT f.name, f.pos, f.height + 1, sha256(s.before || f.digest || s.after)
        FROM folds f JOIN steps s ON s.name = f.name AND s.leaf_pos = f.pos AND s.height = f.height),
    ends AS (SELECT name, pos, arg_max(digest, height) AS folded FROM folds GROUP BY ALL)
    SELECT l.doc_id, l.leaf, s.digest AS subroot, r.digest AS root, coalesce(p.proof, sha256('')) AS proof_sha256,
           e.folded AS folded_root, e.folded = r.digest AS verified
    FROM leaves l JOIN subroots s USING (name) JOIN ends e USING (name, pos) LEFT JOIN proofs p USING (name, pos),
         (SELECT digest FROM top_nodes WHERE n = 1) r"""
