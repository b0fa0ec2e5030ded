r"""Phrase collocation mining by direct-address tiling.

Words are numbers: a digest of the language and the word. A pass over the texts counts the words; then pass ``k`` counts
phrases of ``k`` words as pairs of adjacent phrases of ``k - 1`` words that overlap in all but one, so only pairs of frequent
ones need counting. In each pass the most frequent parts, at most ``RANKS`` of them, are ranked by frequency, and a pair of ranks
is a cell of a square that is cut into tiles. A task counts a tile that many pairs fall on densely, by ``bincount`` over its
cells, and the others as sorted coordinates with counts; pairs with an unranked part are sorted coordinates of their
words' numbers. Tasks send sums, as sorted blocks by digest that are added up block by block; frequent pairs become the parts of the next
pass and are ranked anew.

What a task needs of the pass before is bounded: the ranked parts, and a bitmap of at most 2 ** ``BITS`` bits of the frequent
ones. A fuller bitmap lets more pairs through that turn out to be rare, and loses none. A phrase is told apart by its words'
numbers, all 64 bits of each. Words are counted by number and name, so all counts of words are right where two words share a number; where
such a number is frequent, and only there can it be part of a phrase, the words are numbered anew by another seed. Of ten billion
different words some three pairs share a number, and with a hundred million frequent ones among them one corpus in twenty takes
a second seed; after ``SEEDS`` of them the job fails.

A candidate of two words or more is scored at its weakest cut, in whole numbers of up to 38 digits, and left out if a longer candidate
that holds it is as frequent. All words are counted, and all places of a phrase, overlaps included.

Defined cases: NULL or empty texts have no words; a NULL lang is ``und``; repeated rows count each; ties in score and frequency
go by the phrase's bytes; an empty table gives no row; other columns are ignored. A text longer than what is taken at a time
is counted over the seams.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.columns import text_or_empty
from tidewell.llm.decontamination import bitmap
from tidewell.llm.word_hashes import hashes, joined, mixed, pieces, segments
from tidewell.scratch import stored

MIN_COUNT, LONGEST, TOP = 100, 5, 2000
#: Ranked parts, the side of a tile in ranks, and the tiles a task counts densely at a time.
RANKS, TILE, DENSE = 1 << 14, 1 << 9, 16
#: Words, codes and phrases a task holds before it sends them on.
HELD = 1 << 19
BITS = 27
#: Counts are sent in 2 ** BLOCK_BITS blocks.
BLOCK_BITS = 12
#: Numberings of the words to try.
SEEDS = 4

# Kind of each byte: 0 between words, 2 between pieces, 1 in a word.
_KIND = np.ones(256, dtype=np.int8)
_KIND[[ord(c) for c in " \t"]] = 0
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0xD6E8FEB86659FD93)


def lang_number(lang: str, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 12 + seed)


def byte_order(seed: int) -> np.ndarray:
    """What each byte counts as in a word's number; words that share a number by one seed do not by another."""
    plain = np.arange(256, dtype=np.uint8)
    return np.random.default_rng(seed).permutation(plain) if seed else plain


def numbers(texts: list[str], langs: np.ndarray, carry: int, seed: int = 0) -> Iterator[tuple]:
    """Words of the texts in groups: number, piece, row, the words' bytes (data, starts, ends), and how many words were carried. ``langs`` has a
    number for each text. A long text is several groups; numbers and pieces of each begin with the last ``carry`` words of the one before."""
    held, order = None, byte_order(seed)
    for rows, parts in pieces(texts):
        data, at = joined(parts)
        data = _LOWER[data]
        kinds = _KIND[data]
        starts, ends = segments(data, kinds)
        word = kinds[starts] == 1
        starts, ends = starts[word], ends[word]
        row = np.array(rows, dtype=np.int64)[np.searchsorted(at, starts, side="right") - 1]
        cuts = np.concatenate([[0], np.cumsum(kinds == 2)])
        value, piece = mixed(hashes(order[data] if seed else data, starts, ends) ^ langs[row]), cuts[starts]
        before, carried = 0, 0
        if held and held[0] == rows[0]:
            # The piece goes on unless a separator ended the part before.
            _, last, last_piece, before = held
            value, piece, carried = np.r_[last, value], np.r_[last_piece, piece + before], len(last)
        yield value, piece, row, (data, starts, ends), carried
        keep = max(0, len(value) - carry)
        # The line end that ``joined`` adds is no separator of the text.
        held = (rows[0], value[keep:], piece[keep:], before + cuts[-1] - 1) if len(rows) == 1 else None


def _by_lang(batch: pa.RecordBatch, seed: int = 0) -> Iterator[tuple[list[str], np.ndarray, list[str]]]:
    """Some texts at a time, their languages' numbers and names."""
    known: dict[str, int] = {}
    for at in range(0, batch.num_rows, 1024):
        part = batch.slice(at, 1024)
        names = part["lang"].to_pylist()
        for name in set(names) - known.keys():
            known[name] = lang_number(name, seed)
        yield part["text"].to_pylist(), np.array([known[n] for n in names], dtype=np.uint64), names


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_or_empty().alias("text"))


def count_words(docs: DataFrame, held: int = HELD, seed: int = 0) -> DataFrame:
    """w (the word's number), lang, word and n of every word, and what ``summed`` says of its number."""
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        names: dict[int, tuple[str, bytes]] = {}

        def flush() -> pa.RecordBatch:
            out = pa.record_batch({
                "w": pa.array(np.fromiter(counts, dtype=np.uint64, count=len(counts)).view(np.int64)),
                "lang": pa.array([names[w][0] for w in counts], pa.string()),
                "word": pa.array([names[w][1].decode("utf-8", "surrogatepass") for w in counts], pa.string()),
                "n": pa.array(list(counts.values()), pa.int64()),
            })
            counts.clear()
            names.clear()
            return out

        for batch in batches:
            for texts, langs, lang in _by_lang(batch, seed):
                for value, _, row, (data, starts, ends), _ in numbers(texts, langs, 0, seed):
                    found, first, n = np.unique(value, return_index=True, return_counts=True)
                    for w, i, c in zip(found.tolist(), first.tolist(), n.tolist()):
                        if w in counts:
                            counts[w] += c
                        else:
                            counts[w] = c
                            names[w] = lang[row[i]], data[starts[i] : ends[i]].tobytes()
                    if len(counts) >= held // 2:
                        yield flush()
        yield flush()

    return summed(_rows(docs).mapInArrow(of_batches, "w long, lang string, word string, n long"))


def summed(counted: DataFrame) -> DataFrame:
    """w, lang, word and n of every word, and ``shared``: the count of all words with its number where there are several, else 0. Rows
    are dealt out once, by number."""
    each = counted.repartition("w").groupBy("w", "lang", "word").agg(F.sum("n").alias("n"))
    words = each.groupBy("w").agg(F.collect_list(F.struct("lang", "word", "n")).alias("words"))
    total = F.aggregate("words", F.lit(0).cast("long"), lambda n, word: n + word.n)
    return words.select("w", F.explode("words").alias("one"), F.when(F.size("words") > 1, total).otherwise(0).alias("shared")).select(
        "w", "one.*", "shared"
    )


class Tiles:
    """Counts of pairs of ranks (a, b) as codes a * ranks + b."""

    def __init__(self, ranks: int, tile: int, dense: int, held: int):
        self.ranks, self.tile, self.room, self.held = ranks, tile, dense, held
        self.across = -(-ranks // tile)
        self.dense: dict[int, np.ndarray] = {}
        self.waiting: list[np.ndarray] = []
        self.coo = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))

    def add(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take pairs in, and give codes and counts that no longer fit."""
        self.waiting.append(a * self.ranks + b)
        if sum(map(len, self.waiting)) >= 4 * self.held:
            yield from self._count()

    def _count(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        codes = np.concatenate([np.empty(0, dtype=np.int64), *self.waiting])
        self.waiting = []
        a, b = codes // self.ranks, codes % self.ranks
        tile = a // self.tile * self.across + b // self.tile
        found, n = np.unique(tile, return_counts=True)
        # A tile with a pair for every sixteenth cell is cheaper counted cell by cell; the fullest ones stay.
        many = found[(n >= self.tile**2 // 16)][np.argsort(-n[n >= self.tile**2 // 16], kind="stable")]
        some = np.ones(len(codes), dtype=bool)
        for t in [*self.dense, *(t for t in many.tolist() if t not in self.dense)]:
            if t not in self.dense:
                if len(self.dense) >= self.room:
                    break
                self.dense[t] = np.zeros(self.tile**2, dtype=np.int64)
            own = tile == t
            self.dense[t] += np.bincount(a[own] % self.tile * self.tile + b[own] % self.tile, minlength=self.tile**2)
            some &= ~own
        codes, n = np.unique(codes[some], return_counts=True)
        self.coo = added(np.r_[self.coo[0], codes], np.r_[self.coo[1], n])
        if len(self.coo[0]) >= 2 * self.held:
            yield self.coo
            self.coo = (self.coo[0][:0], self.coo[1][:0])

    def rest(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield from self._count()
        yield self.coo
        for t, cells in self.dense.items():
            at = np.flatnonzero(cells)
            a, b = t // self.across * self.tile + at // self.tile, t % self.across * self.tile + at % self.tile
            yield a * self.ranks + b, cells[at]


def added(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes, each once, with its counts added up."""
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    head = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.empty(0, dtype=np.int64)
    return codes[head], np.add.reduceat(counts, head) if len(codes) else counts


def added_rows(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrases (a row of word numbers each), each once, with its counts added up."""
    if not len(words):
        return words, counts
    h = phrase_numbers(words)
    order = np.argsort(h, kind="stable")
    new = (words[order][1:] != words[order][:-1]).any(axis=1)
    if (h[order][1:][new] == h[order][:-1][new]).any():
        # Two phrases of one digest: sort by the words themselves.
        order = np.lexsort(words.T)
        new = (words[order][1:] != words[order][:-1]).any(axis=1)
    head = np.flatnonzero(np.r_[True, new])
    return words[order][head], np.add.reduceat(counts[order], head)


def phrase_numbers(words: np.ndarray) -> np.ndarray:
    """A digest of each row of word numbers."""
    h = words[:, 0]
    for k in range(1, words.shape[1]):
        h = mixed(h * _STEP + words[:, k])
    return h


class Parts:
    """What a task knows of the frequent phrases of one word less: a bitmap of all, and the ranked ones by number."""

    def __init__(self, ranked: np.ndarray, filled: np.ndarray):
        self.words, self.filled, self.last = ranked, filled, np.uint64(64 * len(filled) - 1)
        h = phrase_numbers(ranked)
        self.order = np.argsort(h, kind="stable")
        self.sorted = h[self.order]

    def maybe(self, h: np.ndarray) -> np.ndarray:
        at = h & self.last
        return (self.filled[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0

    def rank(self, h: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Rank of each phrase, -1 for those without."""
        if not len(self.sorted):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
        rank = self.order[at]
        return np.where((self.sorted[at] == h) & (self.words[rank] == words).all(axis=1), rank, -1)


def _blocks(words: np.ndarray, n: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Phrases with their counts as rows (block, counts): a block holds the phrases of one digest prefix, sorted, each as its words' numbers and
    its count, eight bytes each."""
    for at in range(0, len(n), 1 << 18):
        some, counts = words[at : at + (1 << 18)], n[at : at + (1 << 18)]
        h = phrase_numbers(some)
        order = np.argsort(h, kind="stable")
        block = (h[order] >> np.uint64(64 - bits)).astype(np.int32)
        records = np.concatenate([some[order].view(np.int64), counts[order, None]], axis=1)
        head = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        ends = [*head[1:].tolist(), len(block)]
        yield pa.record_batch({
            "block": pa.array(block[head]), "counts": pa.array([records[i:j].tobytes() for i, j in zip(head.tolist(), ends)], pa.binary()),
        })


def _pairs(parts: Parts, k: int, ranks: int, tile: int, dense: int, held: int, bits: int, seed: int):
    def of_cells(codes: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = codes // ranks, codes % ranks
        if len(codes):
            yield from _blocks(np.concatenate([parts.words[a], parts.words[b][:, -1:]], axis=1), n, bits)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = Tiles(ranks, tile, dense, held)
        coo, waiting = (np.empty((0, k), dtype=np.uint64), np.empty(0, dtype=np.int64)), 0
        more: list[np.ndarray] = []

        def gathered() -> tuple[np.ndarray, np.ndarray]:
            rows = np.concatenate([coo[0], *more])
            return added_rows(rows, np.r_[coo[1], np.ones(len(rows) - len(coo[1]), dtype=np.int64)])

        for batch in batches:
            for texts, langs, _ in _by_lang(batch, seed):
                for value, piece, _, _, carried in numbers(texts, langs, k - 1, seed):
                    if len(value) < k:
                        continue
                    part = np.lib.stride_tricks.sliding_window_view(value, k - 1)
                    h = phrase_numbers(part)
                    # The last word of a pair is new here, and all its words are of one piece.
                    at = np.flatnonzero((piece[: len(value) - k + 1] == piece[k - 1 :]) & (np.arange(len(value) - k + 1) >= carried - k + 1))
                    at = at[parts.maybe(h[at])]
                    at = at[parts.maybe(h[at + 1])]
                    a, b = parts.rank(h[at], part[at]), parts.rank(h[at + 1], part[at + 1])
                    both = (a >= 0) & (b >= 0)
                    for codes, n in tiles.add(a[both], b[both]):
                        yield from of_cells(codes, n)
                    more.append(np.lib.stride_tricks.sliding_window_view(value, k)[at[~both]])
                    waiting += len(more[-1])
                    if waiting >= held:
                        coo, more, waiting = gathered(), [], 0
                        if len(coo[1]) >= held:
                            yield from _blocks(*coo, bits)
                            coo = (coo[0][:0], coo[1][:0])
        for codes, n in tiles.rest():
            yield from of_cells(codes, n)
        rows, n = gathered()
        if len(n):
            yield from _blocks(rows, n, bits)

    return of_batches


def _totals(k: int, min_count: int, held: int):
    """The task that adds up blocks, which come sorted, one at a time: it holds the phrases of one block and ``held`` records more."""
    def frequent(words: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        words, n = words[n >= min_count], n[n >= min_count]
        offsets = pa.array(np.arange(len(words) + 1, dtype=np.int32) * k)
        return pa.record_batch({
            "h": pa.array(phrase_numbers(words).view(np.int64)),
            "ws": pa.ListArray.from_arrays(offsets, pa.array(words.reshape(-1).view(np.int64))), "n": pa.array(n),
        })

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, records, size = None, [np.empty((0, k + 1), dtype=np.int64)], 0

        def added_up() -> np.ndarray:
            whole = np.concatenate(records)
            words, n = added_rows(np.ascontiguousarray(whole[:, :k]).view(np.uint64), whole[:, k])
            return np.concatenate([words.view(np.int64), n[:, None]], axis=1)

        for batch in batches:
            for block, counts in zip(batch["block"].to_pylist(), batch["counts"]):
                if block != now:
                    whole = added_up()
                    yield frequent(np.ascontiguousarray(whole[:, :k]).view(np.uint64), whole[:, k])
                    now, records, size = block, [], 0
                records.append(np.frombuffer(counts.as_buffer(), dtype=np.int64).reshape(-1, k + 1))
                size += len(records[-1])
                if size >= held:
                    records, size = [added_up()], 0
        whole = added_up()
        yield frequent(np.ascontiguousarray(whole[:, :k]).view(np.uint64), whole[:, k])

    return of_partition


def count_pairs(
    docs: DataFrame, parts: Parts, k: int, min_count: int, ranks: int, tile: int, dense: int, held: int, bits: int = BLOCK_BITS,
    seed: int = 0,
) -> DataFrame:
    """h, ws (the words' numbers) and n of every phrase of ``k`` words that occurs ``min_count`` times. Tasks send blocks by digest, and a
    phrase is in each at most once a flush, so blocks are even however often a phrase occurs."""
    counted = _rows(docs).mapInArrow(_pairs(parts, k, ranks, tile, dense, held, bits, seed), "block int, counts binary")
    return counted.repartition("block").sortWithinPartitions("block").mapInArrow(_totals(k, min_count, held), "h long, ws array<long>, n long")


def ranked_parts(frequent: DataFrame, ranks: int, max_bits: int = BITS) -> Parts:
    """At most ``ranks`` of the most frequent phrases reach the driver, by a limit taken from a histogram of counts."""
    level = F.floor(F.log2("n") * 32)
    histogram = frequent.groupBy(level.alias("level")).agg(F.count("*").alias("c"), F.min("n").alias("least")).collect()
    total, least = 0, None
    for row in sorted(histogram, key=lambda r: -r["level"]):
        total += row["c"]
        if total > ranks:
            break
        least = row["least"]
    top = frequent.where(F.col("n") >= least).select("ws", "n").collect() if least is not None else []
    width = len(frequent.select("ws").first()[0]) if histogram else 1
    top.sort(key=lambda r: (-r["n"], r["ws"]))
    words = np.array([r["ws"] for r in top], dtype=np.int64).reshape(len(top), width).view(np.uint64)
    count = sum(r["c"] for r in histogram)
    return Parts(words, bitmap(frequent, min(max_bits, max(10, (64 * count).bit_length()))))


def score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)), exactly."""
    whole = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (whole(a) * whole(n)), whole(left) * whole(right))


def frequent_phrases(
    docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, ranks: int = RANKS, tile: int = TILE, dense: int = DENSE, held: int = HELD,
) -> tuple[DataFrame, list[DataFrame]]:
    """The words (w, lang, word, n), all of them, and h, ws and n of the frequent phrases of 1 to ``longest`` words."""
    for seed in range(SEEDS):
        words = stored(count_words(docs, held, seed), "phrase-words")
        if words.where(F.col("shared") >= min_count).isEmpty():
            break
    else:
        raise ValueError(f"frequent words share a number by each of {SEEDS} seeds")
    levels = [words.where(F.col("n") >= min_count).select(F.col("w").alias("h"), F.array("w").alias("ws"), "n")]
    for k in range(2, longest + 1):
        parts = ranked_parts(levels[-1], ranks)
        if not parts.filled.any():
            break
        levels.append(stored(count_pairs(docs, parts, k, min_count, ranks, tile, dense, held, seed=seed), f"phrases-{k}"))
    return words, levels


def absorbed(candidates: DataFrame, longest: int) -> DataFrame:
    """ws of every phrase of two words or more inside a longer candidate, and the largest count of such a one."""
    places = [
        F.when(F.size("ws") >= max(i + size, size + 1), F.slice("ws", i + 1, size))
        for size in range(2, longest) for i in range(longest - size + 1)
    ]
    inside = F.filter(F.array(*places), lambda x: x.isNotNull()) if places else F.array().cast("array<array<long>>")
    return candidates.select(F.explode(inside).alias("ws"), "a").groupBy("ws").agg(F.max("a").alias("longer"))


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP, absorb: int = 100, **sizes: int
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first ``top`` candidates. ``absorb``: a longer candidate takes those in it
    of which it makes up this percentage."""
    words, levels = frequent_phrases(docs, min_count, longest, **sizes)
    counts = stored(reduce(DataFrame.unionByName, (level.select("ws", F.col("n").alias("f")) for level in levels)), "phrase-counts")
    candidates = counts.where(F.size("ws") > 1).withColumnRenamed("f", "a")
    longer = absorbed(candidates, longest).withColumnRenamed("ws", "inner")
    left = candidates.join(longer, F.col("ws") == F.col("inner"), "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < absorb * F.col("a"))
    ).select("ws", "a")

    # The candidates' own words, language and total.
    each = left.select("ws", F.posexplode("ws").alias("at", "w"))
    named = each.join(words.select("w", "lang", "word"), "w").groupBy("ws").agg(
        F.min("lang").alias("lang"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x.word), " ").alias("phrase"),
    )
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))

    cuts = left.select("ws", "a", F.explode(F.sequence(F.lit(1), F.size("ws") - 1)).alias("k")).select(
        "ws", "a", "k", F.slice("ws", F.lit(1), F.col("k")).alias("first"), F.slice("ws", F.col("k") + 1, F.size("ws")).alias("rest"),
    )
    parted = cuts.join(counts.toDF("first", "l"), "first").join(counts.toDF("rest", "r"), "rest").select("ws", "a", "k", "l", "r")
    whole = parted.join(named, "ws").join(totals, "lang")
    scored = whole.withColumn("score", score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    best = scored.groupBy("ws").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"), *[F.first(c).alias(c) for c in ("lang", "phrase", "a", "n")]
    ).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return best.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )


def op12_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = rf"""
with p as (select lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\n\x0B\f\r]')) as p from (select coalesce(lang, 'und') as lang, coalesce(text, '') as text from documents)),
w as materialized (select lang, list_filter(regexp_split_to_array(p, '[ \t]+'), lambda x: x <> '') as w from p),
n as (select lang, sum(len(w))::bigint as n from w group by lang),
f as materialized (select lang, p, len(p) as k, count(*) as f
  from (select lang, w[i : i + k - 1] as p from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i
      from w, (select unnest(range(1, {LONGEST + 1})) as k))) group by lang, p having count(*) >= {MIN_COUNT}),
c as materialized (select * from f where k > 1),
s as (select lang, p[i : i + m - 1] as p, max(f) as longer from (select lang, p, f, m, unnest(range(1, k - m + 2)) as i
    from c, (select unnest(range(2, {LONGEST})) as m) where m < k) group by all),
q as (select c.* from c left join s on c.lang = s.lang and c.p = s.p where longer is null or 100 * longer < 100 * f),
u as (select q.lang, q.p, q.f as a, j, x.f as l, y.f as r, n.n, (1000::hugeint * q.f * n.n) // (x.f::hugeint * y.f) as score
  from (select *, unnest(range(1, k)) as j from q) q join f x on x.lang = q.lang and x.p = q.p[1 : j]
    join f y on y.lang = q.lang and y.p = q.p[j + 1 :] join n on n.lang = q.lang),
b as (select lang, array_to_string(p, ' ') as phrase, a, l, r, n, score::bigint as score from u
  qualify row_number() over (partition by lang, p order by score, j) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from b qualify rank <= {TOP}
"""
