r"""Line dedup: range-partitioned line hashes, streamed in order, giving keep bitmaps instead of text.

Every non-empty line of a document becomes (hash, document, position). The rows are range-partitioned and sorted by
all three, so one line's occurrences are one run in (document, position) order, and a line that stands in a third of
all documents is simply a run over many partitions. Each task streams its partition, and holds a run's rows only until
``min_docs`` documents are seen. A run inside the partition is then decided; a run at either edge may go on in the next
partition, so what is undecided there is passed on with one summary row per edge. Summaries (two per partition) are
added up and joined to the undecided rows.

Two policies: ``keep="none"`` drops every occurrence of a line found in ``min_docs`` documents or more;
``keep="first"`` leaves the first occurrence in (document, position) order.

The result is a zlib-compressed bitmap for each document that loses a line: a bit per line, 1 for keep.

Defined cases: NULL or empty text is one empty line; an empty key is never dropped; rows equal in doc_id and text
are one document when documents are counted, and all are cut alike; NULL doc_id is a value like any other; an empty
table gives no row; other columns are kept by ``apply`` and ignored otherwise.
"""

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.columns import document_key, fresh
from tidewell.scratch import stored

# Fixed value: what is stripped from both ends of a line's key.
BLANKS = b" \t\n\x0b\x0c\r"

HASHES = "h1 long, h2 long, key string, pos int"
MARKS = "h1 long, h2 long, key string, pos int, state string, docs long, first string, last string"


def line_keys(text: str | None) -> list[bytes]:
    """Each line stripped at both ends, A-Z in lower case (bytes.lower changes nothing else)."""
    return [line.strip(BLANKS).lower() for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n")]


def line_hashes(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """(h1, h2, key, pos) of every line whose key has ``min_chars`` code points, a line once per document and place."""
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, names, places = [], [], []
            for key, text in zip(batch["key"], batch["text"]):
                name = key.as_py()
                for pos, line in enumerate(line_keys(text.as_py())):
                    # A code point takes at most four bytes, so most lines need no count.
                    if len(line) >= 4 * min_chars or len(line.decode("utf-8", "surrogatepass")) >= min_chars:
                        digests.append(xxhash.xxh3_128_digest(line))
                        names.append(name)
                        places.append(pos)
            halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            yield pa.record_batch({
                "h1": pa.array(halves[:, 0]), "h2": pa.array(halves[:, 1]),
                "key": pa.array(names, pa.string()), "pos": pa.array(places, pa.int32()),
            })

    rows = docs.select(document_key().alias("key"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(of_batches, HASHES)


class _Run:
    """A line's occurrences so far in this partition. Rows wait only until ``min_docs`` documents are seen."""

    def __init__(self, h: tuple[int, int], key: str, pos: int):
        self.h, self.first, self.docs, self.last, self.row = h, (key, pos), 0, None, None
        self.waiting: list[tuple[str, int]] = []


def _stream(min_docs: int, keep_first: bool):
    """The task that walks one sorted partition, batch by batch. Rows of one document are next to each other and
    count once."""
    names = [field.split()[0] for field in MARKS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [()] * len(names)
            out.clear()
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        def put(run: _Run, row: tuple[str, int]) -> None:
            # Whether this partition's first occurrence is the first of all is settled with the summaries.
            state = "open" if keep_first and row == run.first else "drop"
            out.append((*run.h, *row, state, None, None, None))

        def close(run: _Run, at_edge: bool) -> None:
            if at_edge:
                out.append((*run.h, None, run.first[1], "edge", run.docs, run.first[0], run.last))
                out.extend((*run.h, *row, "open", None, None, None) for row in run.waiting)

        run, is_first_run = None, True
        for batch in batches:
            h1, h2 = batch["h1"].to_pylist(), batch["h2"].to_pylist()
            for a, b, key, pos in zip(h1, h2, batch["key"].to_pylist(), batch["pos"].to_pylist()):
                if run is None or run.h != (a, b):
                    if run is not None:
                        close(run, is_first_run)
                        is_first_run = False
                    run = _Run((a, b), key, pos)
                if run.row == (key, pos):
                    continue  # a repeated row of the table: the same document, the same place
                run.row = (key, pos)
                if key != run.last:
                    run.docs += 1
                    run.last = key
                if run.docs < min_docs:
                    run.waiting.append((key, pos))
                    continue
                for row in run.waiting:
                    put(run, row)
                run.waiting.clear()
                put(run, (key, pos))
            if len(out) > 50_000:
                yield flush()
        if run is not None:
            close(run, True)
        yield flush()

    return of_partition


def marked_lines(hashes: DataFrame, min_docs: int, keep: str) -> DataFrame:
    """Rows to drop, rows left undecided at partition edges, and the edges' summaries."""
    order = ["h1", "h2", "key", "pos"]
    ranged = hashes.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.mapInArrow(_stream(min_docs, keep == "first"), MARKS)


def dropped_lines(marks: DataFrame, min_docs: int, keep: str) -> DataFrame:
    """(key, pos) of every line to drop, some more than once."""
    # A run's parts in order: a document cut in two by an edge was counted on both sides.
    parts = Window.partitionBy("h1", "h2").orderBy("first", "pos")
    edges = marks.where("state = 'edge'").withColumn("again", F.lag("last").over(parts) == F.col("first"))
    runs = edges.groupBy("h1", "h2").agg(
        (F.sum("docs") - F.count_if(F.coalesce("again", F.lit(False)))).alias("total"),
        F.min(F.struct(F.col("first").alias("key"), "pos")).alias("start"),
    )
    undecided = marks.where("state = 'open'").select("h1", "h2", "key", "pos")
    # A run inside its partition has no summary; its open row is the first occurrence, which stays.
    settled = undecided.join(runs, ["h1", "h2"]).where(F.col("total") >= min_docs)
    if keep == "first":
        settled = settled.where(F.struct("key", "pos") != F.col("start"))
    return marks.where("state = 'drop'").select("key", "pos").unionByName(settled.select("key", "pos"))


def _bitmap(dropped: list[int]) -> bytes:
    """A bit per line, 1 for keep, to the byte of the last dropped line; lines after it all stay."""
    bits = np.ones(max(dropped) // 8 * 8 + 8, dtype=np.uint8)
    bits[dropped] = 0
    return zlib.compress(np.packbits(bits).tobytes())


def cut_text(text: str | None, bitmap: bytes | None) -> str:
    """The text without its dropped lines."""
    if bitmap is None:
        return text or ""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8)).tolist()
    lines = (text or "").split("\n")
    return "\n".join(line for i, line in enumerate(lines) if i >= len(bits) or bits[i])


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: str = "none") -> DataFrame:
    """key, n_dropped and the bitmap of every document that loses a line, once per document."""
    if keep not in ("none", "first"):
        raise ValueError(f"keep must be 'none' or 'first', not {keep!r}")
    hashes = stored(line_hashes(docs, min_chars), "line-hashes")
    marks = stored(marked_lines(hashes, min_docs, keep), "line-marks")
    # A document's own lines meet in one row, as they do in its text.
    lost = dropped_lines(marks, min_docs, keep).groupBy("key").agg(F.collect_set("pos").alias("dropped"))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dropped = batch["dropped"].to_pylist()
            maps = [_bitmap(d) for d in dropped]
            yield pa.record_batch({
                "key": batch["key"], "n_dropped": pa.array(map(len, dropped), pa.int64()),
                "bitmap": pa.array(maps, pa.binary()),
            })

    return lost.mapInArrow(of_batches, "key string, n_dropped long, bitmap binary")


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` with the number of dropped lines and the bitmap, and these columns' names; a document that loses nothing
    has NULL there."""
    document, key, dropped, bitmap = fresh(docs, "_document", "_key", "_n_dropped", "_bitmap")
    found = bitmaps.select(
        F.col("key").alias(key), F.col("n_dropped").alias(dropped), F.col("bitmap").alias(bitmap)
    )
    keyed = docs.withColumn(document, document_key())
    joined = keyed.join(found, F.col(document) == F.col(key), "left").drop(document, key)
    return joined, dropped, bitmap


@F.arrow_udf(T.StringType())
def _cut_texts(texts: pa.Array, bitmaps: pa.Array) -> pa.Array:
    pairs = zip(texts.to_pylist(), bitmaps.to_pylist())
    return pa.array((None if bitmap is None else cut_text(text, bitmap) for text, bitmap in pairs), pa.string())


def apply(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with the dropped lines cut out of ``text``, and ``n_chars``, where there is one, brought up to date. Only texts that
    lose a line go through Python."""
    schema = docs.schema
    rows, _, bitmap_name = with_bitmaps(docs, bitmaps)
    (new,) = fresh(rows, "_new")
    bitmap = F.col(bitmap_name)
    rows = rows.withColumn(new, _cut_texts(F.when(bitmap.isNotNull(), F.col("text").cast("string")), bitmap))
    done = rows.withColumn("text", F.when(bitmap.isNotNull(), F.col(new)).otherwise(F.col("text")))
    if "n_chars" in docs.columns and isinstance(schema["n_chars"].dataType, T.IntegralType):
        done = done.withColumn("n_chars", F.char_length("text").cast(schema["n_chars"].dataType))
    return done.select(*docs.columns)


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows, dropped, bitmap = with_bitmaps(docs, keep_bitmaps(docs, min_docs=10, min_chars=1))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            kept = (cut_text(t, b) for t, b in zip(texts, batch[bitmap].to_pylist()))
            digests = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in kept]
            yield pa.record_batch({
                "doc_id": batch["doc_id"],
                "n_lines": pa.array([t.count("\n") + 1 for t in texts], pa.int64()),
                "n_dropped": batch[dropped].fill_null(0),
                "kept_sha256": pa.array(digests, pa.string()),
            })

    schema = "doc_id long, n_lines long, n_dropped long, kept_sha256 string"
    return rows.mapInArrow(of_batches, schema)


ORACLE = r"""
with l as (select doc_id, i, l, translate(regexp_replace(regexp_replace(l, '^[ \t\n\x0B\f\r]+', ''), '[ \t\n\x0B\f\r]+$', ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
    from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as l,
      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i from documents)),
c as (select k from l where k <> '' group by k having count(distinct doc_id) >= 10)
select doc_id, count(*)::bigint as n_lines, count(c.k)::bigint as n_dropped,
  sha256(coalesce(string_agg(l, chr(10) order by i) filter (c.k is null), '')) as kept_sha256
from l left join c on l.k = c.k group by doc_id
"""
