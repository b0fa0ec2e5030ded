r"""SimHash near-dedup by meet-in-the-middle ball hashing.

A document's fingerprint takes the majority of each bit over the XXH64 values of its word shingles. Two
fingerprints link if at most ``max_bits`` bits differ. Half of an odd radius is one flip less a half, and an erased bit
block counts as that half. The search runs in two steps over distinct fingerprints:

1. Neighbours. Every fingerprint emits its variants within half the radius: one of ``blocks`` bit blocks erased and
   up to ``max_bits // 2`` other bits flipped. Whatever differs, some block holds a differing bit; with it
   erased both sides meet at a variant in the middle. A fingerprint alone at all its variants has no link.
2. Links. Those that met emit all variants within the radius' larger half, and at each variant the smallest
   fingerprint of the smaller half is the anchor: anchor and every other one there add up to at most ``max_bits``. So
   a variant with n fingerprints gives n - 1 links that connect them, never all pairs, and the links of all variants
   connect exactly what the full link relation connects. Links are deduplicated and verified by counting bits.

Equal fingerprints are one node, so thousands of copies cost no more than one. At one variant of step 2 stand at
most as many fingerprints as its ball holds (2,081 for 3 bits). More documents need more blocks to keep chance
meetings of step 1 rare: n * (65 - 64 / blocks) variants fall on 2 ** (64 - 64 / blocks) places per block.

Defined cases: NULL or blank text has no words and the fingerprint 0, linked like any other; fewer words than a
shingle hash as one sequence; repeated rows and NULL doc_ids stay as rows of the result, and a component's id is its
smallest non-NULL doc_id (NULL if it has none); an empty table gives no row; other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.columns import document_key, fresh
from tidewell.llm.components import connected_components
from tidewell.scratch import stored

SEED = 42
#: Shingles hashed at a time, so that a very long text needs no more memory than a short one.
CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint, unsigned. ``bytes`` lower-case A-Z only, and split at [\\x20\\x09-\\x0D]."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    total = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, total, CHUNK):
        part = words[at : at + CHUNK + shingle - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle)))) if total > 1 else [b" ".join(words)]
        hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, key, fp) of every document; ``fp`` has the fingerprint's bits in a signed long."""
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), shingle) for t in batch["text"]], dtype=np.uint64)
            yield pa.record_batch(
                {"doc_id": batch["doc_id"], "key": batch["key"], "fp": pa.array(values.view(np.int64))}
            )

    rows = docs.select("doc_id", document_key().alias("key"), F.col("text").cast("string").alias("text"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key string, fp long"
    return rows.mapInArrow(of_batches, schema)


def _flips(positions: list[int], most: int) -> list[int]:
    """Every mask with at most ``most`` of ``positions`` set, as signed longs."""
    masks = [0]
    for n in range(most):
        last = masks if n == 0 else [m for m in masks if m.bit_count() == n]
        masks += sorted({m | 1 << p for m in last for p in positions if not m >> p & 1})
    return [int(np.uint64(m).view(np.int64)) for m in masks]


def _longs(masks: list[int]) -> Column:
    return F.array(*[F.lit(m).cast("long") for m in masks])


def erased_variants(fp: Column, max_bits: int, blocks: int) -> Column:
    """Variants of step 1. An erased block holds its number, which keeps blocks mostly apart; where two blocks'
    variants agree by chance, that only sends a fingerprint to step 2 for nothing."""
    edges = [64 * b // blocks for b in range(blocks + 1)]
    parts = []
    for b, (low, high) in enumerate(zip(edges, edges[1:])):
        erased = ((1 << high) - 1) ^ ((1 << low) - 1)
        keep = int(np.uint64(((1 << 64) - 1) ^ erased).view(np.int64))
        mark = int(np.uint64(((b + 1) << low) & erased).view(np.int64))
        flips = _flips([i for i in range(64) if not low <= i < high], max_bits // 2)
        base = fp.bitwiseAND(F.lit(keep).cast("long")).bitwiseOR(F.lit(mark).cast("long"))
        parts.append(F.transform(_longs(flips), lambda m: base.bitwiseXOR(m)))
    return F.concat(*parts)


def _dealt(fingerprints: DataFrame) -> DataFrame:
    """Fingerprints over all shuffle partitions: few bytes as they are, they become hundreds of variants each."""
    return fingerprints.repartition(int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")


def neighbours(distinct: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """Fingerprints that meet another one at some variant of step 1."""
    met = distinct.select("fp", F.explode(erased_variants(F.col("fp"), max_bits, blocks)).alias("variant"))
    at = Window.partitionBy("variant").orderBy("fp")
    beside = met.select("fp", F.coalesce(F.lag("fp").over(at), F.lead("fp").over(at)).alias("other"))
    return beside.where(F.col("other").isNotNull()).groupBy("fp").agg(F.count("*").alias("n")).select("fp")


def links(active: DataFrame, max_bits: int) -> DataFrame:
    """Edges (u, v) that connect what fingerprints within ``max_bits`` of each other connect."""
    inner, outer = max_bits // 2, max_bits - max_bits // 2
    flips = _flips(list(range(64)), outer)
    near = sum(1 for m in flips if (m & (1 << 64) - 1).bit_count() <= inner)
    ball = active.select("fp", F.posexplode(_longs(flips)).alias("i", "flip")).select(
        "fp", (F.col("i") < near).alias("near"), F.col("fp").bitwiseXOR(F.col("flip")).alias("variant")
    )
    at = Window.partitionBy("variant")
    anchored = ball.select("fp", F.min(F.when(F.col("near"), F.col("fp"))).over(at).alias("anchor"))
    pairs = anchored.where("fp <> anchor").groupBy("fp", "anchor").agg(F.count("*").alias("n"))
    verified = F.bit_count(F.col("fp").bitwiseXOR(F.col("anchor"))) <= max_bits
    return pairs.where(verified).select(F.col("fp").alias("u"), F.col("anchor").alias("v"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, blocks: int = 4) -> DataFrame:
    """doc_id, key, fp, root (a fingerprint that names the component) and component_id, the smallest doc_id reachable
    over links."""
    if max_bits < 1:
        raise ValueError("max_bits must be 1 or more")
    prints = stored(fingerprints(docs, shingle), "simhash-prints")
    # Copies meet here, combined before the shuffle; from now on a fingerprint is one row.
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    active = stored(neighbours(_dealt(distinct.select("fp")), max_bits, blocks), "simhash-active")
    roots = connected_components(links(_dealt(active), max_bits))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # Only components of several fingerprints need their common id looked up.
    named = rooted.select("fp", "root").join(ids, "root")
    return prints.join(named, "fp").select("doc_id", "key", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id, NULL last."""
    found = near_duplicates(docs, **options)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "key")).alias("first")
    document, keeper, row = fresh(docs, "_document", "_keeper", "_row")
    keepers = found.groupBy("root").agg(first).select(F.col("first.key").alias(keeper))
    # Repeated rows are rows of one key; one of them stays, chosen in part before the shuffle, which the join then shares.
    alike = Window.partitionBy(document).orderBy(document)
    keyed = docs.withColumn(document, document_key()).withColumn(row, F.row_number().over(alike)).where(F.col(row) == 1)
    return keyed.join(keepers, F.col(document) == F.col(keeper), "left_semi").select(*docs.columns)


def op10_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    done = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=3, max_bits=3)
    return done.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
