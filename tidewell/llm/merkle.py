r"""Merkle dataset manifest by sibling-shift self-joins.

Rows are leaves, in order within each tree; every ``arity`` consecutive nodes have one parent. A level is built by equijoins of
its nodes with themselves: the sibling ``shift`` places on has a computed index (the index XOR 1 in binary trees, index plus shift
else), the slot-zero node of every run meets its siblings, and then emits the parent. Each node crosses the network once a
level, and runs are alike in size whatever the trees' sizes are.

Places come without a window over a tree: rows are range-partitioned by (tree, order) and sorted, a row's place in its
partition is known there, and one row per (tree, partition) says how many rows went before.

Paths go down again: a run takes the path of its parent, the siblings of all levels above, and gives each child its
own siblings before that. What reaches the leaves is one row per run, so a path is not repeated for every leaf on
the way.

The manifest has two storeys: a tree per group (``lang``), and a tree of the groups' roots in order of the group. Who holds a
leaf's path can recompute the root from the leaf alone.

Defined cases: NULL fields are ``-``; a NULL group is a tree of its own, the first; NULL ids come first; rows equal in
id stand in the order of their digests, and repeated rows are leaves of their own, in any order; a lone leaf is its tree's root
and a lone tree's root the root; an empty table gives no row; other columns are ignored.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.scratch import stored

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def encoded(field: Column) -> Column:
    """``-`` for NULL, else the number of bytes, a colon and the value."""
    value = field.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, one after another."""
    return F.sha2(F.concat(*parts), 256)


def packed(hexes: Column) -> Column:
    return F.unhex(hexes)


def unpacked(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def numbered(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``i``, the place from 0 in its tree by ``order``, and ``n``, the tree's number of rows. No task holds a tree."""
    # Rows that are alike in everything are told apart by where they are stored, so they can be dealt out too.
    held = stored(rows.withColumn("_tie", F.monotonically_increasing_id()), "merkle-rows")
    keys = [tree, *order, "_tie"]
    sorted_ = held.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # The upper bits are the partition, the lower 33 the row's place in it.
    placed = stored(sorted_.withColumn("_at", F.monotonically_increasing_id()).drop("_tie"), "merkle-places")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1).cast("long"))
    placed = placed.withColumns({"_part": part, "_place": place}).drop("_at")
    counts = placed.groupBy(tree, "_part").agg(F.count("*").alias("c"), F.min("_place").alias("first"))
    # A row per partition, and one more for each tree that begins within one.
    before = Window.partitionBy(tree).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        F.col(tree).alias("_tree"), F.col("_part").alias("_p"), (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("_shift"),
        F.sum("c").over(Window.partitionBy(tree)).alias("n"),
    )
    joined = placed.join(shifts, (F.col("_part") == F.col("_p")) & (F.col(tree) == F.col("_tree")))
    return joined.withColumn("i", F.col("_place") + F.col("_shift")).drop("_part", "_place", "_p", "_tree", "_shift")


def sibling(i: Column, shift: int, arity: int) -> Column:
    """Where the slot-zero node stands from which this node is ``shift`` places on."""
    return i.bitwiseXOR(F.lit(1).cast("long")) if arity == 2 else i - shift


def runs(nodes: DataFrame, arity: int) -> DataFrame:
    """tree, i (the parent's place), n (the nodes of the level) and run, the nodes of each run from left to right. ``nodes`` has tree, i,
    n and node."""
    slot = F.col("i") % arity
    run = nodes.where(slot == 0).select("tree", "i", "n", F.col("node").alias("node0"))
    for shift in range(1, arity):
        beside = nodes.where(slot == shift).select("tree", sibling(F.col("i"), shift, arity).alias("i"), F.col("node").alias(f"node{shift}"))
        run = run.join(beside, ["tree", "i"], "left")
    members = F.filter(F.array(*[F.col(f"node{k}") for k in range(arity)]), lambda x: x.isNotNull())
    return run.select("tree", F.floor(F.col("i") / arity).alias("i"), "n", members.alias("run"))


def parents(level: DataFrame, arity: int) -> DataFrame:
    """The nodes above: the digest of each run's digests."""
    whole = F.array_join(F.transform("run", lambda x: unpacked(x.h)), "")
    return level.select("tree", "i", F.ceil(F.col("n") / arity).alias("n"), F.struct(packed(F.sha2(whole, 256)).alias("h")).alias("node"))


def climbed(nodes: DataFrame, arity: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """The runs of every level, and the nodes that end as roots of their trees at each."""
    levels, roots = [], []
    top = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        roots.append(nodes.where("n = 1"))
        if top <= 1:
            return levels, roots
        levels.append(stored(runs(nodes.where("n > 1"), arity), "merkle-runs"))
        nodes = parents(levels[-1], arity)
        top = -(-top // arity)


def with_steps(level: DataFrame) -> DataFrame:
    """A row per member of each run, whose path has its own siblings, those to the left and those to the right of it, in front."""
    beside = lambda x: packed(F.array_join(F.transform(x, lambda y: unpacked(y.h)), ""))
    each = level.select("tree", "i", "path", "top", "run", F.posexplode("run").alias("slot", "node"))
    step = F.struct(
        beside(F.slice("run", F.lit(1), F.col("slot"))).alias("left"),
        beside(F.slice("run", F.col("slot") + 2, F.size("run"))).alias("right"),
    )
    return each.select("tree", "i", "slot", "node", F.concat(F.array(step), "path").alias("path"), "top")


def descended(levels: list[DataFrame], roots: list[DataFrame], above: DataFrame, arity: int) -> DataFrame:
    """node, path and top of every leaf. ``above`` has tree, path and top: what each tree's root begins with."""
    begun = [ends.select("tree", "i", "node").join(above, "tree") for ends in roots]
    here = begun[len(levels)]
    for k in reversed(range(len(levels))):
        # A run and its parent node have one place.
        runs_here = levels[k].select("tree", "i", "run").join(here.select("tree", "i", "path", "top"), ["tree", "i"])
        below = with_steps(runs_here).withColumn("i", F.col("i") * arity + F.col("slot")).drop("slot")
        here = below.unionByName(begun[k])
    return here.select("tree", "node", "path", "top")


def proof(path: Column) -> Column:
    """The siblings' digests, level by level and from left to right, as one hex text."""
    return F.array_join(F.transform(path, lambda s: F.concat(unpacked(s.left), unpacked(s.right))), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: digest(unpacked(s.left), h, unpacked(s.right)))


def manifest(
    docs: DataFrame, group: str = "lang", key: str = "doc_id", fields: Sequence[str] = FIELDS, arity: int = ARITY,
    altered: dict[str, Column] | None = None, where: Column | None = None,
) -> DataFrame:
    """``key``, leaf, subroot, root and path (the siblings of each level, packed) of every row. With ``altered`` fields also
    altered_leaf, the digest that rows ``where`` would have with those, and NULL elsewhere."""
    if arity < 2:
        raise ValueError("arity must be 2 or more")
    kind = docs.schema[key].dataType
    changed = digest(*[encoded((altered or {}).get(f, F.col(f))) for f in fields])
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-")).alias("tree"), F.col(key).alias("id"),
        packed(digest(*[encoded(F.col(f)) for f in fields])).alias("h"),
        packed(F.when(F.lit(True) if where is None else where, changed) if altered else F.lit(None).cast("string")).alias("other"),
    )
    nodes = numbered(leaves, "tree", ["id", "h"]).select("tree", "i", "n", F.struct("h", "id", "other").alias("node"))
    levels, roots = climbed(stored(nodes, "merkle-leaves"), arity)
    ends = roots[0].select("tree", "node.h")
    for more in roots[1:]:
        ends = ends.unionByName(more.select("tree", "node.h"))

    # The upper storey, in which a tree is a leaf. "-" stands before "=", so the NULL group is first.
    upper = numbered(ends.select(F.lit("").alias("tree"), F.col("tree").alias("id"), "h"), "tree", ["id"])
    upper_levels, upper_roots = climbed(stored(upper.select("tree", "i", "n", F.struct("h", "id").alias("node")), "merkle-roots"), arity)
    root = upper_roots[-1].select("node.h").first()
    none = docs.sparkSession.range(1).select(
        F.lit("").alias("tree"), F.array().cast("array<struct<left:binary,right:binary>>").alias("path"), F.lit(None).cast("binary").alias("top")
    )
    above = descended(upper_levels, upper_roots, none, arity).select("node.id", "path", "node.h").toDF("tree", "path", "top")
    return descended(levels, roots, stored(above, "merkle-above"), arity).select(
        F.col("node.id").cast(kind).alias(key), unpacked(F.col("node.h")).alias("leaf"), unpacked(F.col("top")).alias("subroot"),
        unpacked(F.lit(bytes(root[0]) if root else None).cast("binary")).alias("root"), "path",
        *[unpacked(F.col("node.other")).alias("altered_leaf")] * bool(altered),
    )


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    made = manifest(docs, altered={"text": F.translate("text", UPPER, LOWER)}, where=tampered)
    again = folded(F.coalesce("altered_leaf", "leaf"), F.col("path"))
    return made.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof(F.col("path")), 256).alias("proof_sha256"), again.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


# CRC-32 (reflected polynomial 0xEDB88320) of doc_id's decimal digits, which are ASCII.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::bigint],
    list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c)::bigint)),
    lambda acc, c: list_reduce(list_concat([xor(acc, c)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _leaf_sql(text: str) -> str:
    fields = [text if f == "text" else f"cast({f} as varchar)" for f in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


def _climb_sql(name: str, levels: int) -> str:
    """CTEs from ``<name>0`` (tree, i, n, h; a row of nodes per level) to ``<name><levels>``, and per level the siblings of each node."""
    ctes = []
    for k in range(levels):
        run = f"partition by tree, i // {ARITY} order by i rows between"
        ctes.append(f"""{name}s{k} as materialized (select tree, i, n > 1 as grows,
    coalesce(string_agg(h, '') over ({run} unbounded preceding and 1 preceding), '') as l,
    coalesce(string_agg(h, '') over ({run} 1 following and unbounded following), '') as r from {name}{k})""")
        ctes.append(f"""{name}{k + 1} as materialized (select tree, i // {ARITY} as i, (any_value(n) + {ARITY - 1}) // {ARITY} as n,
    case when any_value(n) > 1 then sha256(string_agg(h, '' order by i)) else any_value(h) end as h from {name}{k}
  group by tree, i // {ARITY})""")
    return ",\n".join(ctes)


def _walk_sql(walk: str, name: str, start: str, levels: int) -> str:
    """CTEs that take every row of ``start`` (tree, i, p, f and others) up the levels, with its proof and what it folds to."""
    ctes, before = [], start
    for k in range(levels):
        ctes.append(f"""{walk}{k} as materialized (select w.* replace (w.i // {ARITY} as i, p || l || r as p,
    case when grows then sha256(l || f || r) else f end as f) from {before} w join {name}s{k} s on w.tree = s.tree and w.i = s.i)""")
        before = f"{walk}{k}"
    return ",\n".join(ctes)


#: Levels that the SQL spells out: enough for 8 ** 7 rows a group and 8 ** 3 groups.
_LOWER, _UPPER = 7, 3
ORACLE = rf"""
with d as materialized (select doc_id, coalesce('=' || lang, '-') as tree, {_leaf_sql('text')} as leaf,
    case when {_CRC} % 3 = 0 then {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} end as other from documents),
o as materialized (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by tree) as n from d),
a0 as materialized (select tree, i, n, leaf as h from o),
{_climb_sql('a', _LOWER)},
b0 as materialized (select '' as tree, row_number() over (order by tree) - 1 as i, count(*) over () as n, h, tree as id from a{_LOWER}),
{_climb_sql('b', _UPPER)},
{_walk_sql('w', 'a', "(select tree, i, doc_id, leaf, '' as p, coalesce(other, leaf) as f from o)", _LOWER)},
x as (select '' as tree, b0.i, doc_id, leaf, p, f, b0.h as subroot from w{_LOWER - 1} w join b0 on w.tree = b0.id),
{_walk_sql('y', 'b', 'x', _UPPER)}
select doc_id, leaf, subroot, h as root, sha256(p) as proof_sha256, f as folded_root, f = h as verified from y{_UPPER - 1}, b{_UPPER}
"""
