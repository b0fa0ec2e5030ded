import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidewell.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def leaf(row, fields, text=None):
    values = [text if f == "text" and text is not None else row[f] for f in fields]
    return sha(*("-" if v is None else f"{len(str(v).encode('utf-8', 'surrogatepass'))}:{v}" for v in values))


def tree(level, arity):
    """The root of some digests, and each one's siblings as (left, right) by level."""
    paths, at = [[] for _ in level], [[i] for i in range(len(level))]
    while len(level) > 1:
        above, places = [], []
        for k in range(0, len(level), arity):
            run = level[k : k + arity]
            for j in range(len(run)):
                for i in at[k + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            above.append(sha(*run))
            places.append([i for some in at[k : k + arity] for i in some])
        level, at = above, places
    return level[0], paths


def manifest(rows, arity=8, fields=merkle.FIELDS):
    """Plain Python: (id, leaf, subroot, root, proof) of every row."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, fields), r["doc_id"]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [tree([x[2] for x in sorted(groups[g])], arity) for g in names]
    root, above = tree([t[0] for t in trees], arity)
    return [
        (x[3], x[2], sub, root, [*path, *upper])
        for g, (sub, paths), upper in zip(names, trees, above) for x, path in zip(sorted(groups[g]), paths)
    ]


def found(df, *more):
    path = F.transform("path", lambda s: F.struct(merkle.unpacked(s.left).alias("l"), merkle.unpacked(s.right).alias("r")))
    return [
        (r.doc_id, r.leaf, r.subroot, r.root, [(s.l, s.r) for s in r.p])
        for r in df.select("doc_id", "leaf", "subroot", "root", path.alias("p"), *more).collect()
    ]


@pytest.mark.parametrize("arity, n", [(8, 1), (8, 8), (8, 9), (8, 65), (2, 1), (2, 7), (3, 28), (8, 600)])
def test_trees_of_any_size(spark, arity, n):
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("Text "), "id").alias("text"), F.when(F.col("id") % 5 > 2, "a").when(F.col("id") % 5 == 1, "b").alias("lang"),
        F.lit("s").alias("source"), F.lit(6).alias("n_chars"),
    )
    assert sorted(found(merkle.manifest(docs, arity=arity))) == sorted(manifest(docs.collect(), arity))


def test_odd_documents(odd_docs):
    order = lambda rows: sorted(rows, key=repr)
    assert order(found(merkle.manifest(odd_docs))) == order(manifest(odd_docs.collect()))


def test_no_documents(no_docs):
    assert merkle.manifest(no_docs).columns == ["doc_id", "leaf", "subroot", "root", "path"]
    assert not merkle.manifest(no_docs).collect()


def test_many_groups_make_several_upper_levels(spark):
    docs = spark.range(200).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.concat(F.lit("g"), F.col("id") % 70).alias("lang"),
        F.lit(None).cast("string").alias("source"), F.lit(1).alias("n_chars"),
    )
    assert sorted(found(merkle.manifest(docs))) == sorted(manifest(docs.collect()))


def test_repeated_rows_fill_no_single_task(spark):
    """A third of the rows equal in everything: places still run from 0 without gaps."""
    rows = spark.range(3000).select(F.lit("=a").alias("tree"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("id"))
    placed = merkle.numbered(rows, "tree", ["id"]).collect()
    assert sorted(r.i for r in placed) == list(range(3000)) and {r.n for r in placed} == {3000}
    ids = [r.id for r in sorted(placed, key=lambda r: r.i)]
    assert ids[:1000] == [None] * 1000 and ids[1000:] == sorted(i for i in range(3000) if i % 3)


def test_every_change_is_seen(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    texts = {r.doc_id: r.text for r in rows}
    for r in merkle.op13_merkle_manifest(spark, sf_dir).collect():
        text = texts[r.doc_id]
        changed = zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and any("A" <= c <= "Z" for c in text or "")
        assert r.verified != changed and (r.folded_root == r.root) == r.verified


def test_no_window_holds_a_tree(spark, sf_dir):
    """Places come from ranges: the only windows run over counts."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("lang").alias("tree"), "doc_id")
    plan = merkle.numbered(rows, "tree", ["doc_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and all("_c" in line or "c#" in line for line in plan.splitlines() if "Window [" in line)
