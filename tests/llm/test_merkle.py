"""The manifest against hashes made by hand, and proofs of a few leaves."""

import hashlib
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tailtrim.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"])
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_levels(nodes):
    """All levels from the leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return levels


def plain_path(levels, pos):
    path = []
    for level in levels[:-1]:
        run = level[pos // 8 * 8 : pos // 8 * 8 + 8]
        path.append(("".join(run[: pos % 8]), "".join(run[pos % 8 + 1 :])))
        pos //= 8
    return path


def plain(rows):
    groups = defaultdict(list)
    for row in rows:
        lang = b"" if row["lang"] is None else b"1" + row["lang"].encode()
        order = (row["doc_id"] is not None, row["doc_id"] or 0, plain_leaf(row))
        groups[lang].append((order, row))
    trees = []
    for lang in sorted(groups):
        members = sorted(groups[lang], key=lambda m: m[0])
        trees.append(([row for _, row in members], plain_levels([order[2] for order, _ in members])))
    top = plain_levels([levels[-1][0] for _, levels in trees])
    found = []
    for number, (members, levels) in enumerate(trees):
        for pos, row in enumerate(members):
            path = plain_path(levels, pos) + plain_path(top, number)
            doc_id, changed = row["doc_id"], dict(row)
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and row["text"] is not None:
                changed["text"] = "".join(c.lower() if "A" <= c <= "Z" else c for c in row["text"])
            at = plain_leaf(changed)
            for before, after in path:
                at = sha(before + at + after)
            root = top[-1][0]
            proof = sha("".join(a + b for a, b in path))
            found.append((doc_id, levels[0][pos], levels[-1][0], root, proof, at, at == root))
    return Counter(found)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def written(df, tmp_path, name):
    df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    return f"{tmp_path}/{name}"


def test_edge_cases(spark, docs, no_docs, tmp_path):
    found = merkle.op11_merkle(spark, written(docs, tmp_path, "edge"))
    rows = [r.asDict() for r in docs.collect()]
    assert Counter(tuple(r) for r in found.select(COLUMNS).collect()) == plain(rows)
    assert merkle.op11_merkle(spark, written(no_docs, tmp_path, "none")).count() == 0
    lone = docs.filter("doc_id = 1")
    assert merkle.op11_merkle(spark, written(lone, tmp_path, "lone")).count() == 1


def test_many_groups_and_heights(spark, tmp_path):
    """Eleven languages, two levels above their roots; one with a third of all rows; ids repeat."""
    rows = [(i % 701, f"Text {i} É", "hot" if i % 3 else f"l{i % 10}", None, i) for i in range(900)]
    rows += [(None, f"No id {i}", None, "s", i) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = merkle.op11_merkle(spark, written(docs, tmp_path, "many"))
    got = Counter(tuple(r) for r in found.select(COLUMNS).collect())
    assert got == plain([r.asDict() for r in docs.collect()])
    assert {verified for *_, verified in got} == {True, False}


def test_proofs_of_some_leaves(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"t{i}", "ab"[i % 2], "s", 1) for i in range(200)], SCHEMA)
    leaves = merkle.ranked(docs.select("doc_id", F.col("lang").alias("group"), merkle.leaf_digest().alias("leaf")))
    manifest = merkle.write_manifest(leaves.cache(), f"{tmp_path}/manifest")
    asked = leaves.filter("doc_id in (0, 1, 77, 199)").select("group", "pos", "doc_id")
    proven = merkle.prove(manifest, asked, ["doc_id"]).withColumn("again", merkle.folded(F.col("leaf"), F.col("path")))
    rows = proven.collect()
    assert sorted(r.doc_id for r in rows) == [0, 1, 77, 199]
    assert {r.again for r in rows} == {r.root for r in rows} == {manifest.root}
    # Records are stored by digest: each is the digest of its children.
    for height in (1, 2, 3):
        records = manifest.groups.records(height)
        assert records.filter(merkle.digest(F.array_join("children", "")) != F.col("digest")).count() == 0
