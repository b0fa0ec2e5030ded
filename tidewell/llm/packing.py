r"""Best-fit packing by sums of squares.

A document is its ids and an end id. It is cut only where it is longer than a sequence. A piece goes where, afterwards, the sum
over all residual gaps of the squared number of open sequences with that gap is smallest: into a sequence of some gap or
into a new one, the tightest among equals. So no gap piles up, and pieces that fit some gap exactly close it.

The work is dealt out by counts, not by content: partly filled pieces go to tasks of about ``share`` pieces each, a task packs its
pieces from long to short, and what it holds is bounded by its share. Each task is left with a few open sequences; their
pieces are dealt out again over as many tasks as they then need, until one task is enough or most pieces stay in open sequences
whatever is done. Pieces that fill a sequence take no part.

Tokens: a vocabulary that drops white space, as word vocabularies do, encodes a text as its blank-free parts one after another, so
each part is encoded once and looked up from then on, in a memory bounded in bytes; other vocabularies encode whole texts. A part
of Latin-1 letters and signs, which normalising only lower-cases, is cut into words here and the library's model merges each; all else is
the library's from end to end.

Defined cases: NULL or empty text is the end id alone; repeated rows and NULL doc_ids are rows of their own, each packed;
an empty table gives no row; other columns are ignored.
"""

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.bpe import byte_letters
from tidewell.llm.columns import extended
from tidewell.scratch import stored

CAPACITY = 4096
#: Pieces a task packs, about; it holds some 60 bytes of each.
SHARE = 1 << 16
#: Bytes of remembered parts in each of the memory's two halves, what an entry is taken for, and the longest part remembered.
MEMORY, ENTRY, LONG_PART = 110 << 20, 180, 48
# The cut of word vocabularies, the same for Latin-1 texts in lower case, the Latin-1 signs that no normal form changes, and
# what marks a word's last token.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")
LATIN = "".join(map(chr, [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]))
WORD_END = "</w>"


def drops_blanks(path: str) -> bool:
    """Whether a tokenizers file cuts texts by ``WORDS``, which leaves out white space, and joins nothing across it."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec["normalizer"] or {}).get("normalizers", [])
    cutters = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    alike = [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and steps[1]["pattern"] == {"Regex": r"\s+"} and steps[1]["content"] == " "
    words = [c.get("type") for c in cutters] == ["Split", "ByteLevel"] and cutters[0]["pattern"] == {"Regex": WORDS}
    return (
        alike and words and cutters[0]["behavior"] == "Removed" and cutters[0]["invert"] and not cutters[1]["add_prefix_space"]
        and not cutters[1]["use_regex"] and spec["post_processor"] is None and spec["model"]["type"] == "BPE"
        and spec["model"]["end_of_word_suffix"] == WORD_END
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"])
    )


class Ids:
    """Texts to ids as the file's library gives them."""

    def __init__(self, path: str):
        # The tasks are the threads.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.by_part = drops_blanks(path)
        # Parts that may hold a special string are left to the library.
        first = {t.content[0] for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.latin = re.compile(f"[{''.join(re.escape(c) for c in LATIN if c not in first)}]+").fullmatch
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        self.letters[ord(" ")] = " "
        self.merger = Tokenizer(self.tokenizer.model)
        self.merger.pre_tokenizer = WhitespaceSplit()
        # Which tokens end a word.
        tokens = sorted((number, token) for token, number in self.tokenizer.get_vocab().items())
        self.last = np.array([token.endswith(WORD_END) for _, token in tokens])
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.held = 0

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.type) for e in found]

    def _merged(self, words: list[str]) -> list[bytes]:
        """Ids of words of the cut."""
        texts = [" ".join(words[at : at + 256]) for at in range(0, len(words), 256)]
        texts = [t if t.isascii() else t.encode().decode("latin-1").translate(self.letters) for t in texts]
        out, size = [], self.type.itemsize
        for found in self.merger.encode_batch_fast(texts, add_special_tokens=False):
            ids = np.array(found.ids, dtype=self.type)
            ends, packed = (size * (np.flatnonzero(self.last[ids]) + 1)).tolist(), ids.tobytes()
            out += [packed[a:b] for a, b in zip([0, *ends], ends)]
        return out

    def _learn(self, parts: set[bytes]) -> dict[bytes, bytes]:
        """Ids of the parts; short ones are remembered."""
        out, others, latin, words, counts = {}, [], [], [], []
        older, is_latin, cut = self.older.get, self.latin, LATIN_WORDS.findall
        for part in parts:
            if (ids := older(part)) is not None:
                out[part] = ids
            elif part.isalpha():
                # ASCII letters alone are one word.
                latin.append(part)
                words.append(part.lower().decode())
                counts.append(1)
            elif is_latin(text := part.decode("utf-8", "surrogatepass")):
                found = cut(text.lower())
                latin.append(part)
                words += found
                counts.append(len(found))
            else:
                others.append(part)
        merged = iter(self._merged(words))
        for part, n in zip(latin, counts):
            out[part] = next(merged) if n == 1 else b"".join(islice(merged, n))
        if others:
            coded = self._library([p.decode("utf-8", "surrogatepass") for p in others])
            out |= zip(others, (ids.tobytes() for ids in coded))
        if self.held > MEMORY:
            self.older, self.known, self.held = self.known, {}, 0
        self.known |= out
        self.held += ENTRY * len(out)
        for part in out:
            if len(part) > LONG_PART:
                del self.known[part]
                self.held -= ENTRY
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if not self.by_part:
            return self._library([t or "" for t in texts])
        # ASCII white space only, which every such vocabulary drops.
        rows = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
        found = [list(map(self.known.get, row)) for row in rows]
        unknown = []
        for row, ids in zip(rows, found):
            at = -1
            for _ in range(ids.count(None)):
                at = ids.index(None, at + 1)
                unknown.append((ids, at, row[at]))
        new = self._learn({part for _, _, part in unknown})
        for ids, at, part in unknown:
            ids[at] = new[part]
        return [np.frombuffer(b"".join(ids), dtype=self.type) for ids in found]


@cache
def ids_of(path: str) -> Ids:
    """One per task process."""
    return Ids(path)


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, row (a number of the table's row), piece, start, length and ids_crc32 of every piece of every document. The
    tokenizer's file must be at the same path on every executor."""
    kind = docs.schema["doc_id"].dataType

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ids_of(tokenizer_path)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                # Texts of about a million characters at a time, whatever the size of a batch.
                texts, size = [], 0
                while at + len(texts) < batch.num_rows and (not texts or size < 1_000_000):
                    texts.append(batch["text"][at + len(texts)].as_py())
                    size += len(texts[-1] or "")
                take, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(coder.encode(texts)):
                    whole = np.empty(len(ids) + 1, dtype="<u4")
                    whole[:-1], whole[-1] = ids, end_id
                    for k, begin in enumerate(range(0, len(whole), capacity)):
                        part = whole[begin : begin + capacity]
                        take.append(at + i)
                        piece.append(k)
                        start.append(begin)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                yield pa.record_batch({
                    "doc_id": batch["doc_id"].take(pa.array(take, pa.int64())), "row": batch["row"].take(pa.array(take, pa.int64())),
                    "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                })
                at += len(texts)

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    schema = f"doc_id {kind.simpleString()}, row long, piece int, start long, length long, ids_crc32 long"
    return rows.mapInArrow(of_batches, schema)


def sum_of_squares(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int], list[int]]:
    """For lengths in order: the sequence and the offset of each, and the gap that each sequence is left with."""
    # Twice the number of open sequences by gap; gap 0 costs nothing, so it stands one below. Gaps without a sequence
    # are out of reach in ``there``.
    twice, out = np.zeros(capacity + 1, dtype=np.int64), -(1 << 40)
    there = np.full(capacity + 1, out, dtype=np.int64)
    twice[0] = -1
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    places, offsets, gaps = [], [], []
    for s in lengths:
        if not 1 <= s <= capacity:
            raise ValueError(f"a length of {s} does not fit a sequence of {capacity}")
        best = None
        if s < capacity:
            change = twice[: capacity - s] - there[s:capacity]
            left = int(change.argmin())
            if change[left] + 2 <= twice[capacity - s] + 1:
                best = left
        if best is None:
            sequence, before, best = len(gaps), capacity, capacity - s
            gaps.append(best)
        else:
            before = s + best
            sequence = open_[before].pop()
            twice[before] -= 2
            there[before] = twice[before] if open_[before] else out
            gaps[sequence] = best
        if best:
            open_[best].append(sequence)
            twice[best] += 2
            there[best] = twice[best]
        places.append(sequence)
        offsets.append(capacity - before)
    return places, offsets, gaps


def _packer(turn: int, capacity: int):
    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not sum(b.num_rows for b in held):
            return
        rows = pa.Table.from_batches(held)
        # From long to short; the row and the piece settle ties, so a task that runs again packs alike.
        order = np.lexsort([rows[n].to_numpy() for n in ("piece", "row")] + [-rows["length"].to_numpy()])
        rows = rows.take(pa.array(order))
        places, offsets, gaps = sum_of_squares(rows["length"].to_pylist(), capacity)
        first = (turn << 24 | TaskContext.get().partitionId()) << 34
        for name, values in (
            ("sequence_id", np.array(places, dtype=np.int64) + first), ("offset", np.array(offsets, dtype=np.int64)),
            ("gap", np.array(gaps, dtype=np.int64)[places]),
        ):
            rows = rows.append_column(name, pa.array(values))
        yield from rows.to_batches(max_chunksize=10_000)

    return of_partition


def pack(pieces: DataFrame, capacity: int = CAPACITY, share: int = SHARE, slack: int = 0) -> DataFrame:
    """``pieces`` (length, and row and piece to tell them apart) with sequence_id and offset. Sequences that are left with more than
    ``slack`` tokens open are taken apart and packed again with those of other tasks."""
    rest, turn = pieces.where(F.col("length") < capacity), 1
    n = rest.count()
    # Full pieces have numbers below zero.
    alone = -1 - F.monotonically_increasing_id()
    done = pieces.where(F.col("length") >= capacity).select("*", alone.alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    schema = extended(pieces.schema, "sequence_id long, offset long, gap long")
    while n:
        tasks = -(-n // share)
        packed = rest.repartition(tasks, "row", "piece").mapInArrow(_packer(turn, capacity), schema)
        packed = stored(packed, "packed")
        loose = packed.where(F.col("gap") > slack)
        before, n = n, loose.count() if tasks > 1 else 0
        if n > before * 3 // 4:
            n = 0  # these pieces fit nothing else
        done = done.unionByName((packed.where(F.col("gap") <= slack) if n else packed).drop("gap"))
        rest, turn = loose.select(*pieces.columns), turn + 1
    return done


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY, share: int = SHARE) -> DataFrame:
    """Every piece of every document with its sequence and its offset there."""
    pieces = stored(token_pieces(docs, tokenizer_path, end_id, capacity), "token-pieces")
    return pack(pieces, capacity, share).drop("row")


def op11_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
