r"""Token counts through a digest cache.

A count belongs to the digest of a text and the digest of a tokenizer's file. Texts are joined to the stored counts by
both digests; only distinct texts without a count are encoded, and their counts are appended to the cache, so a second
run over the same texts encodes nothing, and another version of the tokenizer finds no count of the first.

Normalised content: NULL is the empty text and text is UTF-8; nothing else may change, since any change of the text can
change its count. Copies are thinned in each task before the shuffle, so a text that fills a third of the table reaches
the task that encodes it once per input task.

Files ending in .json are counted by tokenizers, files ending in .model by sentencepiece. For plain byte-level files the same
saving is made for words within a task: a word of the split is encoded by the library once and looked up from then on. Special strings inside texts count as the one token the library makes of them.

Defined cases: repeated rows and NULL doc_ids stay as rows; an empty or NULL text has 0 tokens and 0 bytes; an
empty table gives no row and appends nothing; other columns are ignored.
"""

import hashlib
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.columns import text_or_empty
from tidewell.llm.pretokens import pattern, plain_byte_level
from tidewell.scratch import scratch_dir, stored

CACHE = "digest string, tokenizer string, n_tokens long"
#: Bytes of words a task process remembers in each of two halves, what an entry takes beside its word, and the longest word.
MEMORY, ENTRY, LONG_WORD = 64 << 20, 150, 96


def _one_thread() -> None:
    """The tasks are the threads."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


class TextCounts:
    """Token counts of texts as the file's library gives them for whole texts."""

    def __init__(self, path: str):
        _one_thread()
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: model.encode(texts, num_threads=1)
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.encode = lambda texts: tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def counts(self, texts: list[str]) -> list[int]:
        return list(map(len, self.encode(texts)))


class WordCounts:
    """Token counts of texts under a plain byte-level file, remembering words that are not long, in two halves of bounded bytes."""

    def __init__(self, path: str):
        _one_thread()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.held = 0

    def counts(self, texts: list[str]) -> list[int]:
        cut = pattern().findall
        rows, extra = [], []
        for text in texts:
            parts = self.special.split(text) if self.special else [text]
            extra.append(len(parts) - 1)
            rows.append(cut(text) if len(parts) == 1 else [w for part in parts for w in cut(part)])
        new = set(chain.from_iterable(rows)) - self.known.keys()
        missing = [w for w in new if w not in self.older]
        self.known |= {w: self.older[w] for w in new if w in self.older}
        codes = self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)
        self.known |= zip(missing, map(len, codes))
        look = self.known.__getitem__
        found = [sum(map(look, row)) + n for row, n in zip(rows, extra)]
        for word in new:
            if len(word) > LONG_WORD:
                del self.known[word]
            else:
                self.held += len(word) + ENTRY
        if self.held > MEMORY:
            self.older, self.known, self.held = self.known, {}, 0
        return found


@cache
def counter(path: str) -> TextCounts | WordCounts:
    """One per task process."""
    return WordCounts(path) if path.endswith(".json") and plain_byte_level(path) else TextCounts(path)


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts, or none before the first run."""
    try:
        return spark.read.schema(CACHE).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], CACHE)
        raise


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's rows with each digest once."""
    seen: set[str] = set()
    for batch in batches:
        new = []
        for i, digest in enumerate(batch["digest"].to_pylist()):
            if digest not in seen:
                seen.add(digest)
                new.append(i)
        yield batch.take(pa.array(new, pa.int64()))


def _encoder(path: str, slice_chars: int = 1_000_000):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).counts
        for batch in _first_of_each(batches):
            texts, counts, at = batch["text"].to_pylist(), [], 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= slice_chars):
                    size += len(texts[end])
                    end += 1
                counts += count(texts[at:end])
                at = end
            yield pa.record_batch({"digest": batch["digest"], "n_tokens": pa.array(counts, pa.int64())})

    return encode


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str) -> DataFrame:
    """doc_id, digest, n_bytes and n_tokens of every row; counts that the cache lacks are appended to it. The
    tokenizer's file must be at the same path on every executor."""
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer_path)
    rows = docs.select("doc_id", text_or_empty().alias("text")).withColumn("digest", F.sha2("text", 256))
    known = read_cache(spark, cache_path).where(F.col("tokenizer") == version)
    texts = rows.select("digest", "text").mapInArrow(_first_of_each, "digest string, text string")
    missing = texts.join(known.select("digest"), "digest", "left_anti").repartition("digest")
    encoded = missing.mapInArrow(_encoder(tokenizer_path), "digest string, n_tokens long")
    encoded.select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache_path)

    # A digest stored twice (two runs at once) has the same count both times. Stored, the counts are a plain side of the
    # join, of which Spark can split what a hot digest meets.
    counts = read_cache(spark, cache_path).where(F.col("tokenizer") == version)
    counts = stored(counts.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "token-counts")
    sizes = rows.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    return sizes.join(counts, "digest")


def op2_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counted = count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), scratch_dir(spark, "token-cache"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))
