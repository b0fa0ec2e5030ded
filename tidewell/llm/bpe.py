r"""BPE encoding and decoding as a bounded-lookahead streaming transducer.

How far to the right of a token must one look to know that it stays? A token can only be undone by a merge of higher
rank that takes it, or its right part while it forms, together with what follows; that in turn must form and stay.
Following these chains through the merge list, ranks falling at every step, gives each token a number of bytes, and the
largest is the list's sufficient lookahead (``Merges.lookahead``). The encoder walks a text from left to right: it
cuts words, merges a window of a word, and emits the tokens that end at least the lookahead before the window's end.
Emitted tokens never change and what follows them is encoded as if it stood alone, so memory stays constant however
long a text or a word is. Short words are looked up in a bounded memory of words met before.

The decoder is a state machine from token bytes to text: it holds back at most the three bytes of an unfinished
character.

Special strings inside a text become their one id, as in the library's default.

Defined cases: NULL or empty text has no ids and decodes to the empty text; repeated rows and NULL doc_ids stay as
rows; an empty table gives no row; other columns are ignored, or kept where documents are returned.
"""

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.columns import extended, fresh
from tidewell.llm.pretokens import SPACE, pattern, plain_byte_level

#: Bytes of words and ids a task process remembers in each of two halves, and what an entry takes beside them; past it, the older half is let go.
MEMORY, ENTRY = 64 << 20, 180
#: Longer words are encoded window by window and not remembered.
LONG_WORD = 96
#: Characters cut into words at a time.
CHUNK = 1 << 16


def byte_letters() -> dict[str, int]:
    """The printable letter of each byte in byte-level vocabularies: itself where it prints, else the next from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


class Merges:
    """A byte-level vocabulary with its merge list."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if not plain_byte_level(path):
            raise ValueError(f"not a plain byte-level BPE file: {path}")
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.bytes: list[bytes] = [b""] * size
        for token, number in vocab.items():
            self.bytes[number] = bytes(letters[c] for c in token)
        self.single = [0] * 256
        for number, value in enumerate(self.bytes):
            if len(value) == 1:
                self.single[value[0]] = number
        #: left id << 32 | right id -> rank, and the merged id by rank
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault(vocab[left] << 32 | vocab[right], rank)
            self.merged.append(vocab[left + right])
        self.special: dict[str, int] = {}
        for token in spec["added_tokens"]:
            self.special[token["content"]] = token["id"]
            self.bytes[token["id"]] = token["content"].encode()
        #: How ids are packed.
        self.code = "H" if size <= 1 << 16 else "I"
        self.lookahead = self._sufficient_lookahead()

    def _sufficient_lookahead(self) -> int:
        """Bytes past its end that decide whether a token stays, at most, over all tokens."""
        forming = [0] * len(self.bytes)  # bytes past a token's end that decide whether it forms
        taking = [0] * len(self.bytes)  # ... and whether a merge seen so far takes it to the right
        for key, rank in self.ranks.items():
            a, b, merged = key >> 32, key & 0xFFFFFFFF, self.merged[rank]
            left, right = max(forming[a], taking[a]), max(forming[b], taking[b])
            forming[merged] = max(forming[merged], right, left - len(self.bytes[b]))
            taking[a] = max(taking[a], len(self.bytes[b]) + right)
        return max(max(f, t) for f, t in zip(forming, taking))

    def merge(self, word: bytes) -> list[int]:
        """Ids of a word: the pair of lowest rank first, the leftmost among equals."""
        ids = [self.single[b] for b in word]
        return self._merge_short(ids) if len(ids) <= 48 else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        find, none, merged = self.ranks.get, len(self.merged), self.merged
        found = [find(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while found and (best := min(found)) < none:
            i = found.index(best)
            ids[i] = token = merged[best]
            del found[i], ids[i + 1]
            if i:
                found[i - 1] = find(ids[i - 1] << 32 | token, none)
            if i < len(found):
                found[i] = find(token << 32 | ids[i + 1], none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        find, n = self.ranks.get, len(ids)
        after, before, alive = [*range(1, n), -1], [-1, *range(n - 1)], [True] * n
        heap = []
        for i in range(n - 1):
            if (rank := find(ids[i] << 32 | ids[i + 1])) is not None:
                heap.append((rank, i, ids[i], ids[i + 1]))
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = self.merged[rank], False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (rank := find(ids[x] << 32 | ids[y])) is not None:
                    heapq.heappush(heap, (rank, x, ids[x], ids[y]))
        return [t for t, live in zip(ids, alive) if live]

    def stream(self, word: bytes, window: int | None = None) -> Iterator[int]:
        """Ids of a word of any length, each once it is stable."""
        size = window or max(512, 4 * self.lookahead)
        at = 0
        while True:
            part = word[at : at + size]
            last, end = at + len(part) >= len(word), 0
            emitted = 0
            for token in self.merge(part):
                end += len(self.bytes[token])
                if not last and end + self.lookahead > len(part):
                    break
                emitted = end
                yield token
            if last:
                return
            at += emitted
            size = size if emitted else 2 * size


class _Words(dict):
    """Ids of words as packed bytes, worked out when first asked for. ``older`` is what was known before."""

    def __init__(self, merges: Merges, older: dict):
        self.merges, self.older, self.held = merges, older, 0

    def __missing__(self, word: str) -> bytes:
        raw = word.encode("utf-8", "surrogatepass")
        if len(raw) > LONG_WORD:
            return array(self.merges.code, self.merges.stream(raw)).tobytes()
        self[word] = ids = self.older.get(word) or array(self.merges.code, self.merges.merge(raw)).tobytes()
        self.held += len(raw) + len(ids) + ENTRY
        return ids


class Encoder:
    """Text to ids."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.words = _Words(self.merges, {})
        names = sorted(self.merges.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.break_at = re.compile(rf"[^{SPACE}](?=[{SPACE}])")

    def _parts(self, text: str) -> Iterator[str]:
        """``text`` cut before white space that follows something else, where a word always ends."""
        at = 0
        while len(text) - at > CHUNK:
            found = None
            for found in self.break_at.finditer(text, at + CHUNK - 512, at + CHUNK):
                pass
            found = found or self.break_at.search(text, at + CHUNK)
            if not found:
                break
            yield text[at : found.end()]
            at = found.end()
        yield text[at:]

    def packed(self, text: str) -> Iterator[bytes]:
        """Ids of the text in order, packed, word by word."""
        if self.words.held > MEMORY:
            self.words.older = {}
            self.words = _Words(self.merges, self.words)
        pieces = self.special.split(text) if self.special else [text]
        cut, look = pattern().findall, self.words.__getitem__
        for k, piece in enumerate(pieces):
            if k % 2:
                yield array(self.merges.code, [self.merges.special[piece]]).tobytes()
            else:
                for part in self._parts(piece):
                    yield b"".join(map(look, cut(part)))

    def encode_packed(self, text: str) -> array:
        """Ids of the text, two or four bytes each."""
        ids = array(self.merges.code)
        for part in self.packed(text):
            ids.frombytes(part)
        return ids

    def encode(self, text: str) -> list[int]:
        return self.encode_packed(text).tolist()


class ByteText:
    """Bytes in, text out, as soon as characters are whole. Bytes that are no UTF-8 become U+FFFD."""

    def __init__(self):
        self.held = b""

    def feed(self, data: bytes) -> str:
        data = self.held + data
        keep = 0
        # An unfinished character begins within the last three bytes.
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:
                need = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                keep = back if back < need else 0
                break
            if byte < 0x80:
                break
        self.held = data[len(data) - keep :]
        return data[: len(data) - keep].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


def decode(merges: Merges, ids: Sequence[int], step: int = 4096) -> Iterator[str]:
    """Text of the ids, piece by piece."""
    state, value = ByteText(), merges.bytes.__getitem__
    for at in range(0, len(ids), step):
        yield state.feed(b"".join(map(value, ids[at : at + step])))
    yield state.close()


@cache
def encoder(path: str) -> Encoder:
    """One per task process: the vocabulary is read once and the words met stay known."""
    return Encoder(path)


def encode_documents(
    docs: DataFrame, tokenizer_path: str, keep: tuple[str, ...] = ("doc_id",), verify: bool = False
) -> DataFrame:
    """``keep`` columns, ``ids`` and ``n_tokens``; with ``verify`` also ``round_trip``, whether decoding the ids where they
    are made gives the text back. The tokenizer's file must be at the same path on every executor."""
    kept, (text_name,) = docs.select(*keep).schema, fresh(docs, "_text")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part[text_name].to_pylist()]
                ids = [coder.encode_packed(t) for t in texts]
                sizes = np.array(list(map(len, ids)), dtype=np.int64)
                whole = np.concatenate([np.empty(0, dtype=np.int32), *(np.frombuffer(i, dtype=coder.merges.code) for i in ids)])
                columns = {n: part[n] for n in kept.fieldNames()}
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                columns["ids"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(whole.astype(np.int32)))
                columns["n_tokens"] = pa.array(sizes)
                if verify:
                    same = ("".join(decode(coder.merges, i)) == t for i, t in zip(ids, texts))
                    columns["round_trip"] = pa.array(same, pa.bool_())
                yield pa.record_batch(columns)

    rows = docs.select(*keep, F.col("text").cast("string").alias(text_name))
    added = "ids array<int>, n_tokens long" + ", round_trip boolean" * verify
    return rows.mapInArrow(of_batches, extended(kept, added))


def decode_documents(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the text its ``ids`` give back."""
    schema = encoded.schema

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = encoder(tokenizer_path).merges
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = ["".join(decode(merges, ids or [])) for ids in part["ids"].to_pylist()]
                columns = {n: part[n] for n in schema.fieldNames()}
                yield pa.record_batch(columns | {"decoded": pa.array(texts, pa.string())})

    return encoded.mapInArrow(of_batches, extended(schema, "decoded string"))


def op8_bpe_round_trip(spark, sf_dir: str) -> DataFrame:
    """Digests of ids and of the decoded text, taken where they are made: neither leaves its task."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        names = [str(i) for i in range(len(coder.merges.bytes))]
        for batch in batches:
            counts, id_digests, text_digests = [], [], []
            for text in batch["text"]:
                ids = coder.encode_packed(text.as_py() or "")
                counts.append(len(ids))
                # Both digests are fed piece by piece.
                listed, digest = hashlib.sha256(), hashlib.sha256()
                for at in range(0, len(ids), 4096):
                    listed.update((("," if at else "") + ",".join(map(names.__getitem__, ids[at : at + 4096]))).encode())
                for piece in decode(coder.merges, ids):
                    digest.update(piece.encode("utf-8", "surrogatepass"))
                id_digests.append(listed.hexdigest())
                text_digests.append(digest.hexdigest())
            yield pa.record_batch({
                "doc_id": batch["doc_id"], "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(id_digests, pa.string()),
                "decoded_sha256": pa.array(text_digests, pa.string()),
            })

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(of_batches, schema)
