r"""Language identification by rank-order profiles.

A profile lists the most frequent letter n-grams (one to three letters, a blank at word ends) by falling count. A text's
own profile is held against each language's: the out-of-place distance adds up how far each n-gram's ranks lie apart,
and the profile length where a language lacks it. The nearest language wins.

Learning counts the n-grams of all learning documents in their tasks and adds the counts up by n-gram; what reaches the
driver and then every task is one profile per language, ``size`` n-grams each.

Defined cases: a text without a letter (or NULL) is ``und`` with score 0; documents with NULL lang or NULL doc_id teach
nothing; equal counts rank by n-gram, equal distances go to the first language by name; with nothing learned every
text is ``und``; repeated rows stay and count each; an empty table gives no row; other columns are ignored.
"""

import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.columns import extended, fresh

BLANK = 32
#: Distinct n-grams a task gathers per language before it passes them on.
MAX_GRAMS = 1_000_000


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((unicodedata.category(chr(p))[0] == "L" for p in range(sys.maxunicode + 1)), dtype=bool)


def grams(text: str | None) -> np.ndarray:
    """The text's n-grams, each as one number: its code points, 21 bits apiece."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letters = _letters()[points]
    if not letters.any():
        return np.empty(0, dtype=np.int64)
    c = np.full(len(points) + 2, BLANK, dtype=np.int64)
    c[1:-1][letters] = points[letters]
    c = c[np.r_[True, (c[1:] != BLANK) | (c[:-1] != BLANK)]]
    two = c[:-1] << 21 | c[1:]
    three = (two[:-1] << 21 | c[2:])[c[1:-1] != BLANK]
    return np.concatenate([c[c != BLANK], two, three])


def ranked(text: str | None, size: int) -> np.ndarray:
    """The text's profile: its ``size`` most frequent n-grams, most frequent first."""
    found, counts = np.unique(grams(text), return_counts=True)
    return found[np.argsort(-counts, kind="stable")[:size]]


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of several parts as one."""
    found, place = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    total = np.zeros(len(found), dtype=np.int64)
    np.add.at(total, place, np.concatenate([n for _, n in parts]))
    return found, total


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def row(lang: str) -> pa.RecordBatch:
        found, counts = _added(known.pop(lang))
        return pa.record_batch({
            "lang": pa.array([lang] * len(found), pa.string()), "gram": pa.array(found), "n": pa.array(counts),
        })

    for batch in batches:
        waiting: dict[str, list[np.ndarray]] = {}
        size = 0

        def settle() -> None:
            for lang, parts in waiting.items():
                new = np.unique(np.concatenate(parts), return_counts=True)
                known[lang] = [_added([*known.get(lang, []), new])]
            waiting.clear()

        for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
            found = grams(text.as_py())
            waiting.setdefault(lang, []).append(found)
            size += len(found)
            if size > 4_000_000:
                settle()
                size = 0
        settle()
        for lang in [k for k, parts in known.items() if len(parts[0][0]) > MAX_GRAMS]:
            yield row(lang)
    for lang in sorted(known):
        yield row(lang)


def learn_profiles(docs: DataFrame, size: int = 300) -> dict[str, list[int]]:
    """Each language's profile, from columns ``lang`` and ``text``."""
    counted = docs.select("lang", "text").where("lang is not null").mapInArrow(_count_grams, "lang string, gram long, n long")
    total = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    rows = total.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= size)
    profiles: dict[str, list[int]] = {}
    for row in sorted(rows.collect(), key=lambda r: (r["lang"], r["rank"])):
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


class Profiles:
    """Language profiles, ready to measure texts against."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.names, self.size = sorted(profiles), size
        self.grams = np.array(sorted({g for p in profiles.values() for g in p}), dtype=np.int64)
        self.ranks = np.full((len(self.grams) + 1, len(self.names)), -1, dtype=np.int64)
        for k, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.grams, profiles[name]), k] = np.arange(len(profiles[name]))

    def nearest(self, text: str | None) -> tuple[str, float]:
        own = ranked(text, self.size)
        if not len(own) or not self.names:
            return "und", 0.0
        place = np.searchsorted(self.grams, own)
        place[place == len(self.grams)] = 0
        ranks = self.ranks[np.where(self.grams[place] == own, place, len(self.grams))]
        apart = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None]))
        distances = apart.sum(axis=0)
        best = int(distances.argmin())
        return self.names[best], 1.0 - float(distances[best]) / (self.size * len(own))


def identify(docs: DataFrame, profiles: dict[str, list[int]], size: int = 300, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, lang_pred and score (1: the same ranks, 0: nothing in common)."""
    kept, (text_name,) = docs.select(*keep).schema, fresh(docs, "_text")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Profiles(profiles, size)
        for batch in batches:
            found = [measure.nearest(t.as_py()) for t in batch[text_name]]
            columns = {n: batch[n] for n in kept.fieldNames()}
            yield pa.record_batch(columns | {
                "lang_pred": pa.array([n for n, _ in found], pa.string()),
                "score": pa.array([s for _, s in found], pa.float64()),
            })

    rows = docs.select(*keep, F.col("text").cast("string").alias(text_name))
    return rows.mapInArrow(of_batches, extended(kept, "lang_pred string, score double"))


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 4
    profiles = learn_profiles(docs.where(remainder != 2))
    held_out = F.coalesce(remainder == 2, F.lit(False))
    found = identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


# CRC-32 (reflected polynomial 0xEDB88320) of doc_id's decimal digits, which are ASCII.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::bigint],
    list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c)::bigint)),
    lambda acc, c: list_reduce(list_concat([xor(acc, c)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""

ORACLE = rf"""
with d as (select doc_id, lang, {_CRC} % 4 = 2 as held_out,
    trim(regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}]+', ' ', 'g')) as t from documents),
s as (select *, string_split(' ' || t || ' ', '') as c from d where t <> ''),
u as (select doc_id, lang, held_out, c, unnest(range(1, len(c) + 1)) as i from s),
g as (select doc_id, lang, held_out, c[i] as g, 1 as k from u where c[i] <> ' '
  union all select doc_id, lang, held_out, c[i] || c[i + 1], 2 from u where i < len(c)
  union all select doc_id, lang, held_out, c[i] || c[i + 1] || c[i + 2], 3 from u where i + 1 < len(c) and c[i + 1] <> ' '),
n as (select doc_id, lang, held_out, g, k, count(*) as n from g group by all),
o as (select *, row_number() over (partition by doc_id order by n desc, k, g) as r from n qualify r <= 300),
l as (select lang, g, row_number() over (partition by lang order by sum(n) desc, k, g) as r
  from n where lang is not null and not held_out group by lang, g, k qualify r <= 300),
a as (select doc_id, x.lang, sum(coalesce(abs(o.r - l.r), 300)) as far, count(*) as m
  from o cross join (select distinct lang from l) x left join l on l.lang = x.lang and l.g = o.g group by doc_id, x.lang),
b as (select doc_id, min((far, lang)) as best, any_value(m) as m from a group by doc_id)
select d.doc_id, held_out, coalesce(best[2], 'und') as lang_pred,
  coalesce(1.0::double - best[1]::double / (300 * m), 0.0)::double as score
from d left join b using (doc_id)
"""
