r"""Quality classifier by importance resampling.

Two generative models of hashed word n-grams (words and pairs of words; a word that repeats the one before it is one
n-gram of its own, whatever the word) are counted: one over target text, the documents labelled good, and one over
all raw text. A log ratio is drawn two standard errors towards zero, so n-grams too rare to tell count as even and the
documents the target was counted on have no lead over others. A document's log importance weight is the mean of
log(target / raw) over its n-grams, for a text of ``LENGTH`` n-grams: long texts do not drift away by their length, and
short ones stay near zero. Sampling without
replacement in proportion to the weights is a top-k over weight plus Gumbel noise; the noise comes from a digest of the
document, so the sample is the same on every run.

The mean weight does not part good documents from well written toxic ones, which differ in a few words. So a second ratio
is counted in the same way, of toxic text over good text, and documents whose toxic weight is above ``toxic_cut``, the value
that best parts labelled toxic documents from good ones, are rejected before the sampling.

``k`` is the number of the other documents whose weight reaches ``cut``, the value that best parts good from poor labelled
documents (the middle of the gap where there is one). The k-th key is found by narrowing histograms, so no task sorts or holds the
documents.

The raw model counts every document. The target model and the cut are fitted on at most ``max_labelled`` documents of
each label, those with the smallest digests of their ids; that bound keeps the broadcast sample small.

Defined cases: NULL or empty text has no n-grams and weight 0; with no document labelled good, or none labelled
poor (toxic), nothing is rejected as poor (toxic); repeated rows and rows tied at the k-th key share their fate; NULL doc_ids carry no
label; a document labelled more than once is good only if every label says so; an empty table gives no row; other
columns are ignored by ``weigh`` and kept by ``select_documents``.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.columns import document_key, extended, fresh
from tidewell.llm.word_hashes import hashes, joined, mixed, pieces, segments
from tidewell.scratch import stored

BUCKETS = 1 << 16
MAX_LABELLED = 20_000
SEED = 7
#: Weights are given for a text of this many n-grams, and this many even ones are added to every text.
LENGTH, EVEN = 256, 64
#: The n-gram of any word said again at once.
AGAIN = np.uint64(1)


def ngrams(texts: list[str | None], buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The row and the bucket of every n-gram of the texts, in order of rows."""
    row_before, last = -1, np.uint64(0)
    for rows, parts in pieces(texts):
        data, at = joined(parts)
        starts, ends = segments(data)
        words = hashes(data, starts, ends)
        row = np.array(rows, dtype=np.int64)[np.searchsorted(at, starts, side="right") - 1]
        if not len(words):
            continue
        # The word before each one, over the seam between two pieces of one long text too.
        before = np.r_[last, words[:-1]]
        paired = np.r_[row[0] == row_before, row[1:] == row[:-1]]
        pair = np.where(words == before, AGAIN, mixed(words * np.uint64(3) + before))
        found = np.concatenate([words, pair[paired]]) % np.uint64(buckets)
        yield np.concatenate([row, row[paired]]), found.astype(np.int64)
        row_before, last = row[-1], words[-1]


def labelled_sample(labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, good, toxic) for at most ``max_labelled`` documents of each kind. Good: quality 1 and not toxic; toxic: quality 1,
    but toxic; all others are poor."""
    toxic = F.coalesce("toxic", F.lit(0)) if "toxic" in labels.columns else F.lit(0)
    each = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min(((F.col("quality") == 1) & (toxic == 0)).cast("int")).alias("good"),
        F.min((F.col("quality") == 1).cast("int")).alias("written"),
    )

    def some(kind: DataFrame) -> DataFrame:
        return kind.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)

    good, bad, poor = each.where("good = 1"), each.where("good = 0 and written = 1"), each.where("written = 0")
    kinds = some(good).unionByName(some(bad)).unionByName(some(poor))
    return kinds.select("doc_id", (F.col("good") == 1).alias("good"), ((F.col("good") == 0) & (F.col("written") == 1)).alias("toxic"))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", document_key().alias("key"), F.col("text").cast("string").alias("text"))


def _with_labels(rows: DataFrame, sample: DataFrame) -> DataFrame:
    # At most 3 * max_labelled rows of ten bytes, whatever the size of the tables.
    return rows.join(F.broadcast(sample), "doc_id", "left")


def fit_ratios(docs: DataFrame, sample: DataFrame, buckets: int = BUCKETS, errors: float = 2.0) -> np.ndarray:
    """log(target / raw) and log(toxic / target) by bucket, or zeros where no document is labelled good (toxic)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target, toxic = np.zeros((3, buckets), dtype=np.int64)
        for batch in batches:
            good, bad = (np.array([g is True for g in batch[n].to_pylist()], dtype=bool) for n in ("good", "toxic"))
            for at in range(0, batch.num_rows, 1024):
                part = batch["text"].slice(at, 1024).to_pylist()
                for row, bucket in ngrams(part, buckets):
                    raw += np.bincount(bucket, minlength=buckets)
                    target += np.bincount(bucket[good[row + at]], minlength=buckets)
                    toxic += np.bincount(bucket[bad[row + at]], minlength=buckets)
        some = np.flatnonzero(raw)
        yield pa.record_batch({
            "bucket": pa.array(some), "raw": pa.array(raw[some]), "target": pa.array(target[some]), "toxic": pa.array(toxic[some]),
        })

    texts = _with_labels(_rows(docs), sample).select("text", "good", "toxic")
    counted = texts.mapInArrow(count, "bucket long, raw long, target long, toxic long")
    # One row per bucket reaches the driver, however many documents there are.
    total = counted.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in ("raw", "target", "toxic")]).toPandas()
    raw, target, toxic = np.zeros((3, buckets))
    raw[total["bucket"]] = total["raw"]
    target[total["bucket"]] = total["target"]
    toxic[total["bucket"]] = total["toxic"]

    def ratio(some: np.ndarray, others: np.ndarray) -> np.ndarray:
        if not some.sum() or not others.sum():
            return np.zeros(buckets, dtype=np.float32)
        expected = others * (some.sum() / others.sum())
        log = np.log((some + 0.5) / (expected + 0.5))
        sure = np.maximum(0, np.abs(log) - errors / np.sqrt(some + 0.5))
        return (np.sign(log) * sure).astype(np.float32)

    # What toxic texts lack says nothing: they are good ones but for some words.
    return np.stack([ratio(target, raw), np.maximum(0, ratio(toxic, target))])


def log_weights(texts: list[str | None], ratios: np.ndarray) -> np.ndarray:
    """Each text's log importance weight and toxic weight."""
    total, size = np.zeros((len(ratios), len(texts))), np.full(len(texts), float(EVEN))
    for row, bucket in ngrams(texts, ratios.shape[1]):
        for sums, ratio in zip(total, ratios):
            sums += np.bincount(row, weights=ratio[bucket].astype(np.float64), minlength=len(texts))
        size += np.bincount(row, minlength=len(texts))
    return LENGTH * total / size


def _weighed(rows: DataFrame, ratios: np.ndarray) -> DataFrame:
    """``rows`` with log_weight and toxic_weight in place of text."""
    kept = rows.drop("text").schema

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                columns = {n: part[n] for n in kept.fieldNames()}
                columns["log_weight"], columns["toxic_weight"] = map(pa.array, log_weights(part["text"].to_pylist(), ratios))
                yield pa.record_batch(columns)

    return rows.mapInArrow(of_batches, extended(kept, "log_weight double, toxic_weight double"))


def gumbel(key: Column, seed: int = SEED) -> Column:
    """Standard Gumbel noise from 52 bits of the document's digest."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 12).cast("double")
    return -F.log(-F.log((bits + 0.5) / float(1 << 52)))


def kth_largest(values: DataFrame, name: str, k: int, bins: int = 1024, few: int = 10_000) -> float:
    """The k-th largest value of a column. Each round counts ``bins`` ranges and goes on in the one that holds it; the last
    ``few`` values are looked at one by one."""
    low, high, count = values.agg(F.min(name), F.max(name), F.count(name)).first()
    rank = k
    while count > few and low < high:
        width = (high - low) / bins
        slot = F.least(F.floor((F.col(name) - low) / width), F.lit(bins - 1))
        within = values.where(F.col(name).between(low, high)).withColumn("slot", slot)
        counts = within.groupBy("slot").agg(
            F.count("*").alias("n"), F.min(name).alias("low"), F.max(name).alias("high")
        ).collect()
        for row in sorted(counts, key=lambda r: -r["slot"]):
            if rank <= row["n"]:
                break
            rank -= row["n"]
        low, high, count = row["low"], row["high"], row["n"]
    if low == high:
        return low
    rest = values.where(F.col(name).between(low, high)).select(name).collect()
    return sorted((r[0] for r in rest), reverse=True)[rank - 1]


def best_cut(good: np.ndarray, poor: np.ndarray) -> float:
    """The cut that keeps the largest share of good plus rejects the largest share of poor; in the widest gap's middle."""
    if not len(good) or not len(poor):
        return float("-inf")
    values = np.unique(np.concatenate([good, poor]))
    kept = 1 - np.searchsorted(np.sort(good), values, side="left") / len(good)
    rejected = np.searchsorted(np.sort(poor), values, side="left") / len(poor)
    gain = kept + rejected
    gap = values - np.r_[values[0], values[:-1]]
    best = max(range(len(values)), key=lambda i: (round(gain[i], 12), gap[i]))
    return float(values[best] - gap[best] / 2)


@dataclass(frozen=True)
class Classifier:
    """What is fitted: the log ratios by bucket, the cuts, and the k-th largest key."""

    ratios: np.ndarray
    cut: float
    toxic_cut: float
    threshold: float


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, buckets: int = BUCKETS) -> tuple[Classifier, DataFrame]:
    """The classifier, and doc_id, key, log_weight, toxic_weight and sample_key of every document."""
    sample = stored(labelled_sample(labels, max_labelled), "quality-sample")
    ratios = fit_ratios(docs, sample, buckets)
    rows = _with_labels(_rows(docs), sample).select("doc_id", "key", "good", "toxic", "text")
    weighed = _weighed(rows, ratios)
    weighed = stored(weighed.withColumn("sample_key", F.col("log_weight") + gumbel(F.col("key"))), "quality-weights")
    # A row per labelled document of the sample, however often the table repeats it.
    known = weighed.where("good is not null").groupBy("doc_id").agg(
        F.max("good").alias("good"), F.max("toxic").alias("toxic"),
        F.avg("log_weight").alias("log_weight"), F.avg("toxic_weight").alias("toxic_weight"),
    ).toPandas()
    good, toxic = known["good"].astype(bool), known["toxic"].astype(bool)
    cut = best_cut(*(known.loc[kind, "log_weight"].to_numpy() for kind in (good, ~good & ~toxic)))
    toxic_cut = -best_cut(*(-known.loc[kind, "toxic_weight"].to_numpy() for kind in (good, toxic)))
    rest = weighed.where(F.col("toxic_weight") <= toxic_cut)
    k = rest.where(F.col("log_weight") >= cut).count()
    threshold = kth_largest(rest, "sample_key", k) if k else float("inf")
    return Classifier(ratios, cut, toxic_cut, threshold), weighed.drop("good", "toxic")


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, log_weight, sample_key and kept of every document."""
    model, weighed = fit(docs, labels, **options)
    kept = (F.col("sample_key") >= model.threshold) & (F.col("toxic_weight") <= model.toxic_cut)
    return weighed.select("doc_id", "log_weight", "sample_key", kept.alias("kept"))


def select_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that are sampled, all columns. Texts are weighed again where they lie rather than joined to
    their verdicts, which would send every text through a shuffle; only the verdict comes back from Python."""
    model, _ = fit(docs, labels, **options)
    (verdict,) = fresh(docs, "_verdict")

    @F.arrow_udf("boolean")
    def chosen(texts: pa.Array, noise: pa.Array) -> pa.Array:
        found = [pa.array([], pa.bool_())]
        for at in range(0, len(texts), 1024):
            weight, toxic = log_weights(texts.slice(at, 1024).to_pylist(), model.ratios)
            found.append(pa.array((weight + noise.slice(at, 1024).to_numpy() >= model.threshold) & (toxic <= model.toxic_cut)))
        return pa.concat_arrays(found)

    weighed = docs.withColumn(verdict, chosen(F.col("text").cast("string"), gumbel(document_key())))
    return weighed.where(F.col(verdict)).select(*docs.columns)


def op5_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    return classify(docs, labels)
