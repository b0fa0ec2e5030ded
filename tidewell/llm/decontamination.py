r"""Benchmark decontamination by template canonicalisation.

Words of benchmark items and documents become literals in lower case or typed placeholders: NUMBER (with its decimals),
NAME (a run of capitalised words inside a sentence) and UNIT (a unit of measure after a number). Windows of ``window``
canonical words are hashed and joined, so a question asked again with other numbers, names or units is found.

A name may open a sentence, and a question may be quoted in other letters. So windows are taken in ``FORMS`` on both
sides, each joined with its own: CANONICAL as above (what ``ORACLE`` says); ANYWHERE, where every capitalised word is a
NAME, at a sentence start too; LOWER, where no word is one; PLAIN, where words and numbers all stand for themselves, so copies of items are found
however many numbers they hold. An item of fewer than ``shortest`` words is looked for in PLAIN alone, and only as a whole sentence or line
(stops, line ends or the text's ends on both sides): its words may stand anywhere by chance.

Slot consistency: a document's window is the benchmark's window with other slot values exactly if one-to-one
replacement of values leads from one to the other, that is, if the same slots hold equal values on both sides. That
pattern of equal slots goes into the window's hash, so inconsistent windows never meet, and a template that fills
half the benchmark is one row of the join.

What a task needs of the benchmark to leave out windows that match nothing is a Bloom filter over template hashes, sized by the
number of windows: ``PER_WINDOW`` bits each, of which ``PROBES`` are looked at, so about one window in 5,000 passes by chance. It takes
2 ** ``MOST_BITS`` bits (32 MB) at most, enough for 8 million windows; a larger benchmark sends more chance hits into the
join, never fewer matches. What passes is joined exactly, on 64-bit hashes.

Defined cases: NULL or blank texts have no windows; an item shorter than a window but of at least ``shortest`` words (in PLAIN any number, as above) is one
window of its length; windows in which fewer than half the words are literals say too little for
other slot values and are left out of the forms with slots; equal windows of several items are reported under the smallest item_id, with all of them in ``item_ids``; repeated rows and NULL doc_ids keep their
own rows of the result; empty tables give no row; other columns are ignored, or kept by ``clean_documents``.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.columns import document_key, fresh
from tidewell.llm.word_hashes import KIND, hashes, joined, mixed, pieces, segments
from tidewell.scratch import stored

WINDOW, SHORTEST = 13, 6
#: The filter's bits a window, how many of them are looked at, and the most bits it may have (as a power of two).
PER_WINDOW, PROBES, MOST_BITS = 32, 4, 28
#: From one looked-at part of a hash to the next.
SHIFT = 12
# Units of measure, in lower case.
UNITS = """
mm cm dm m km inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre
kilometres mg g kg ton tons tonne tonnes gram grams kilogram kilograms ounce ounces pound pounds lb lbs ml cl l liter
liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month
months year years percent degree degrees dollar dollars euro euros cent cents usd eur
""".split()

NUMBER, NAME, UNIT = (np.uint64(n) for n in (1, 2, 3))
SLOT = {"NUMBER": NUMBER, "NAME": NAME, "UNIT": UNIT}
_STEP = np.uint64(0xD6E8FEB86659FD93)
# Forms of a text: names inside sentences only, names wherever a capital is, no names, and no slots at all.
CANONICAL, ANYWHERE, LOWER, PLAIN = range(4)
FORMS = (CANONICAL, ANYWHERE, LOWER, PLAIN)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?\n"]] = True


def _unit_hashes() -> np.ndarray:
    data, at = joined([u.encode() for u in UNITS])
    return np.sort(hashes(data, at[:-1], at[1:] - 1))


_UNITS = _unit_hashes()


def _words(parts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Words of the parts: part number, hash in lower case, whether all digits, whether capitalised, and what lies before
    each: whether no text start or stop does, one ',' or '.', one blank."""
    data, at = joined(parts)
    kinds = KIND[data]
    starts, ends = segments(data, kinds)
    word = kinds[starts] == 1
    starts, ends = starts[word], ends[word]
    part = np.searchsorted(at, starts, side="right") - 1
    if not len(starts):
        none = np.empty(0, dtype=bool)
        return part, np.empty(0, dtype=np.uint64), none, none, none, none, none
    value = hashes(_LOWER[data], starts, ends)
    same_part = np.r_[False, part[1:] == part[:-1]]
    near = same_part & (np.r_[0, starts[1:] - ends[:-1]] == 1)

    digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
    number = digits[ends] - digits[starts] == ends - starts
    stops = np.concatenate([[0], np.cumsum(_STOP[data])])
    inside = same_part & np.r_[False, stops[starts[1:]] == stops[ends[:-1]]]
    first, second = data[starts], data[np.minimum(starts + 1, len(data) - 1)]
    capital = (first >= 65) & (first <= 90) | (first == 0xC3) & (second >= 0x80) & (second <= 0x9E)
    mark = data[np.maximum(starts - 1, 0)]
    return part, value, number, capital & ~number, inside, near & ((mark == 44) | (mark == 46)), near & (KIND[mark] == 0)


def _canonical(words: tuple[np.ndarray, ...], form: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Canonical words in a form: row, canonical hash, slot value (0 for literals), and whether it is a slot."""
    row, value, number, capital, inside, pointed, spaced = words
    if form == PLAIN or not len(row):
        return row, value, np.zeros(len(row), dtype=np.uint64), np.zeros(len(row), dtype=bool)
    name = capital & {CANONICAL: inside, ANYWHERE: True, LOWER: False}[form]
    after_number = np.r_[False, number[:-1]] & inside
    place = np.minimum(np.searchsorted(_UNITS, value), len(_UNITS) - 1)
    unit = (_UNITS[place] == value) & after_number & ~name

    # 1,234.5 is one number, and a name of several words is one name.
    goes_on = number & np.r_[False, number[:-1]] & pointed | name & np.r_[False, name[:-1]] & spaced & inside
    head = np.flatnonzero(~goes_on)
    total = np.add.reduceat(value, head)
    kind = np.where(number, NUMBER, np.where(name, NAME, np.where(unit, UNIT, np.uint64(0))))[head]
    slot = kind > 0
    return row[head], np.where(slot, kind, value[head]), np.where(slot, mixed(total + kind), np.uint64(0)), slot


def _template_hashes(
    word: np.ndarray, slot: np.ndarray, sizes: list[int], form: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each size, from small to large: the size, the hash of every window of so many canonical words, slots by their
    kind, and whether it says enough. Each size goes on where the one before it stopped."""
    h, done = np.zeros(len(word), dtype=np.uint64), 0
    slots = np.concatenate([[0], np.cumsum(slot)])
    for size in sizes:
        if size > len(word):
            return
        for k in range(done, size):
            h = h[: len(word) - k] * _STEP + word[k:]
        done = size
        yield size, mixed(h + np.uint64(size + 1000 * form)), 2 * (slots[size:] - slots[:-size]) <= size


def _window_hashes(h: np.ndarray, at: np.ndarray, value: np.ndarray, slot: np.ndarray, size: int) -> np.ndarray:
    """Hash of the windows that start ``at``, their pattern of equal slots included."""
    h = h[at]
    open_ = np.lib.stride_tricks.sliding_window_view(slot, size)[at]
    several = np.flatnonzero(open_.sum(axis=1) > 1)
    if len(several):
        # Literals and slots alike are named by where their value first stands in the window.
        values, open_ = np.lib.stride_tricks.sliding_window_view(value, size)[at[several]], open_[several]
        pattern = np.zeros(len(several), dtype=np.uint64)
        for k in range(size):
            equal = (values[:, : k + 1] == values[:, k : k + 1]) & open_[:, : k + 1]
            pattern = pattern * _STEP + np.where(open_[:, k], equal.argmax(axis=1) + 1, 0).astype(np.uint64)
        h[several] = mixed(h[several] ^ mixed(pattern))
    return h


def _last_word(data: bytes) -> bytes:
    """From the last word on; all of it where there is none."""
    word = KIND[np.frombuffer(data, dtype=np.uint8)] == 1
    at = np.flatnonzero(word)
    if not len(at):
        return data
    blank = np.flatnonzero(~word[: at[-1]])
    return data[blank[-1] + 1 if len(blank) else 0 :]


def _texts(texts: list[str | None]) -> Iterator[tuple[np.ndarray, ...]]:
    """``_words`` of whole texts, in groups, by row. A long text's pieces are put together again; each is read with the last word of the
    one before it, so what lies between two words does not depend on the cut."""
    held, held_row, tail, known = [], -1, b"", 0
    for rows, parts in pieces(texts):
        if held and rows[0] != held_row:
            yield tuple(map(np.concatenate, zip(*held)))
            held = []
        if len(rows) > 1:
            part, *rest = _words(parts)
            yield (np.array(rows, dtype=np.int64)[part], *rest)
            continue
        whole = tail + parts[0] if held else parts[0]
        part, *rest = _words([whole])
        found = (np.full(len(part), rows[0], dtype=np.int64), *rest)
        # The word read again, if the tail had one, is known.
        held.append(tuple(x[known if held else 0 :] for x in found))
        held_row, tail, known = rows[0], _last_word(whole), int(len(part) > 0)
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def canonical_texts(texts: list[str | None], form: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Canonical words of whole texts, in groups: row, word, value, slot."""
    for words in _texts(texts):
        yield _canonical(words, form)


def _item_windows(window: int, shortest: int, forms: tuple[int, ...]):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Item, hash, hash of the template, size and form.
            found = [np.empty((5, 0), dtype=np.int64)]
            for words in _texts(batch["text"].to_pylist()):
                for form in forms:
                    row, word, value, slot = _canonical(words, form)
                    for r in np.unique(row):
                        own = row == r
                        size = min(window, int(own.sum()))
                        if size < (1 if form == PLAIN else shortest):
                            continue
                        ((_, template, enough),) = _template_hashes(word[own], slot[own], [size], form)
                        at = np.flatnonzero(enough)
                        h = _window_hashes(template, at, value[own], slot[own], size).view(np.int64)
                        template = template[at].view(np.int64)
                        found.append(np.stack([np.full(len(h), r), h, template, np.full(len(h), size), np.full(len(h), form)]))
            take, h, template, size, form = np.concatenate(found, axis=1)
            yield pa.record_batch({
                "item_id": batch["item_id"].take(pa.array(take)), "h": pa.array(h), "template": pa.array(template),
                "size": pa.array(size), "form": pa.array(form),
            })

    return of_batches


def item_windows(
    benchmark: DataFrame, window: int = WINDOW, shortest: int = SHORTEST, forms: tuple[int, ...] = (CANONICAL,)
) -> DataFrame:
    """item_id, h, template, size and form of every window: which items a window stands for."""
    kind = benchmark.schema["item_id"].dataType.simpleString()
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_item_windows(window, shortest, forms), f"item_id {kind}, h long, template long, size long, form long")


def benchmark_windows(
    benchmark: DataFrame, window: int = WINDOW, shortest: int = SHORTEST, forms: tuple[int, ...] = (CANONICAL,)
) -> DataFrame:
    """h, template, size, form, the items that have the window, the smallest item_id among them, and how many there are."""
    return item_windows(benchmark, window, shortest, forms).groupBy("h", "template", "size", "form").agg(
        F.min("item_id").alias("item_id"), F.collect_set("item_id").alias("items")
    ).withColumn("n_items", F.size("items").cast("long"))


def bitmap(windows: DataFrame, bits: int) -> np.ndarray:
    """One bit for each of the last ``bits`` bits of an ``h`` that occurs. At most 2 ** (bits - 6) rows reach the driver."""
    at = F.col("h").bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
    words = windows.select(F.shiftright(at, 6).alias("word"), at.bitwiseAND(F.lit(63).cast("long")).cast("int").alias("bit"))
    found = words.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("set")).toPandas()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[found["word"]] = found["set"]
    return out.view(np.uint64)


def filter_bits(n_windows: int) -> int:
    """The filter's size for so many windows, as a power of two."""
    return min(MOST_BITS, max(6, (PER_WINDOW * n_windows - 1).bit_length()))


def bloom_filter(windows: DataFrame, bits: int) -> np.ndarray:
    """A filter of the templates' hashes: of each the bits from 0, ``SHIFT``, 2 * ``SHIFT``... on."""
    probes = F.array(*[F.shiftrightunsigned("template", SHIFT * k) for k in range(PROBES)])
    return bitmap(windows.select(F.explode(probes).alias("h")), bits)


def passing(h: np.ndarray, at: np.ndarray, filled: np.ndarray, bits: int) -> np.ndarray:
    """Those places ``at`` whose hash passes the filter."""
    for k in range(PROBES):
        place = (h[at] >> np.uint64(SHIFT * k)) & np.uint64((1 << bits) - 1)
        at = at[(filled[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) > 0]
    return at


def _whole_sentences(inside: np.ndarray, size: int) -> np.ndarray:
    """For each window whether it begins and ends with a sentence, a line or the text. ``inside``: whether a word goes on a sentence."""
    ends = np.r_[~inside[1:], True]
    return ~inside[: len(inside) - size + 1] & ends[size - 1 :]


def _document_windows(filled: np.ndarray, sizes: dict[int, list[int]], bits: int, shortest: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, hits = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
            for at in range(0, batch.num_rows, 1024):
                for words in _texts(batch["text"].slice(at, 1024).to_pylist()):
                    for form in sizes:
                        row, word, value, slot = _canonical(words, form)
                        for size, h, enough in _template_hashes(word, slot, sizes[form], form):
                            hit = enough & (row[: len(h)] == row[size - 1 :])
                            if form == PLAIN and size < shortest:
                                hit &= _whole_sentences(words[4], size)
                            where = passing(h, np.flatnonzero(hit), filled, bits)
                            full = _window_hashes(h, where, value, slot, size).view(np.int64)
                            # A window said again and again in one text counts once.
                            pairs = np.unique(np.stack([row[where] + at, full]), axis=1)
                            rows.append(pairs[0])
                            hits.append(pairs[1])
            take = pa.array(np.concatenate(rows))
            yield pa.record_batch({
                "doc_id": batch["doc_id"].take(take), "key": batch["key"].take(take),
                "h": pa.array(np.concatenate(hits)),
            })

    return of_batches


def contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shortest: int = SHORTEST, bits: int | None = None,
    forms: tuple[int, ...] = (CANONICAL,),
) -> DataFrame:
    """doc_id, key, item_id, item_ids, and the number of distinct windows they share, for every document and item that share one in
    any of the forms. Windows are counted in the first form that they share one in. Windows of several items count for the
    smallest; item_ids lists all that have one of these windows, sorted and comma-joined. ``bits``: the filter's size as a
    power of two, by default what the number of windows asks for."""
    windows = stored(benchmark_windows(benchmark, window, shortest, forms), "benchmark-windows")
    sizes = {
        row["form"]: sorted(row["sizes"])
        for row in windows.groupBy("form").agg(F.collect_set("size").alias("sizes")).orderBy("form").collect()
    }
    bits = bits or filter_bits(windows.count())
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", document_key().alias("key"), F.col("text").cast("string").alias("text"))
    passed = rows.mapInArrow(
        _document_windows(bloom_filter(windows, bits), sizes, bits, shortest), f"doc_id {kind}, key string, h long"
    )
    # On the document side a hot passage is split by Spark; the other side has each window once.
    found = stored(passed, "document-windows").join(windows.select("h", "form", "item_id", "items", "n_items"), "h")
    each = found.groupBy("doc_id", "key", "item_id", "form").agg(
        F.count("*").alias("n_windows"), F.max("n_items").alias("n_items"), F.collect_set("items").alias("items")
    )
    first = each.groupBy("doc_id", "key", "item_id").agg(*[F.min_by(c, "form").alias(c) for c in ("n_windows", "n_items", "items")])
    named = F.array_join(F.array_sort(F.array_distinct(F.flatten("items"))).cast("array<string>"), ",")
    return first.select("doc_id", "key", "item_id", "n_windows", "n_items", named.alias("item_ids"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that share no window with an item in any of ``FORMS``, unless ``forms`` are given."""
    document, leak = fresh(docs, "_document", "_leak")
    found = contaminated(docs, benchmark, **{"forms": FORMS} | options).select(F.col("key").alias(leak)).distinct()
    keyed = docs.withColumn(document, document_key())
    return keyed.join(found, F.col(document) == F.col(leak), "left_anti").drop(document)


def op7_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    found = contaminated(docs, benchmark, forms=FORMS)
    return found.select("doc_id", "item_id", "n_windows", "n_items", "item_ids")


def _words_sql(name: str, key: str, table: str) -> str:
    """CTEs that end in ``<name>_k``: the words of each row, with what stands before them."""
    word = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
    lower = "translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
{name}_w as (select {key}, unnest(regexp_extract_all(text, '{word}')) as w, unnest(regexp_split_to_array(text, '{word}')[:-2]) as gap,
    generate_subscripts(regexp_extract_all(text, '{word}'), 1) as i from {table} where regexp_matches(text, '{word}')),
{name}_k as materialized (select *, regexp_full_match(w, '[0-9]+') as number, i > 1 and not regexp_matches(gap, '[.!?\n]') as inside,
    regexp_matches(w, '^[A-Z\x{{C0}}-\x{{DE}}]') as capital, {lower} as low from {name}_w)"""


def _form_sql(name: str, key: str, form: int) -> str:
    """CTEs that end in ``<name><form>_c``: per row the canonical words (c), the slots' values, '' for literals (v), and whether words go on a
    sentence (s, for PLAIN)."""
    at = f"{name}{form}"
    if form == PLAIN:
        return f"""
{at}_c as materialized (select {key}, list(low order by i) as c, list('' order by i) as v, list(inside order by i) as s from {name}_k group by {key})"""
    named = {CANONICAL: "inside", ANYWHERE: "true", LOWER: "false"}[form]
    units = ", ".join(f"'{u}'" for u in UNITS)
    return rf"""
{at}_n as (select *, capital and {named} and not number as name,
    coalesce(lag(number) over (partition by {key} order by i), false) as after_number from {name}_k),
{at}_g as (select *, case when number then '1' when name then '2' when after_number and inside and low in ({units}) then '3'
      else '' end as kind,
    i > 1 and length(gap) = 1 and (number and after_number and gap in (',', '.')
      or name and inside and coalesce(lag(name) over (partition by {key} order by i), false) and regexp_matches(gap, '[\x00-\x20\x7F]')) as on_
  from {at}_n),
{at}_h as (select *, count(*) filter (not on_) over (partition by {key} order by i) as grp from {at}_g),
{at}_s as (select {key}, grp, arg_min(kind, i) as kind, arg_min(low, i) as low,
    array_to_string(list_sort(list(low)), ' ') as v from {at}_h group by {key}, grp),
{at}_c as materialized (select {key}, list(case when kind = '' then low else '<' || kind || '>' end order by grp) as c,
    list(case when kind = '' then '' else kind || v end order by grp) as v, null::boolean[] as s from {at}_s group by {key})"""


#: A window's canonical text, its pattern of equal slots after it.
_TEXT = """array_to_string(c, ' ') || case when len(list_filter(v, lambda y: y <> '')) > 1
    then '|' || array_to_string(list_transform(v, lambda y: case when y = '' then 0 else list_position(v, y) end), ',') else '' end"""
_ENOUGH = "2 * len(list_filter(v, lambda y: y <> '')) <= size"


def _item_sql(form: int) -> str:
    size, least = f"least({WINDOW}, len(c))", 1 if form == PLAIN else SHORTEST
    return f"""
select item_id, {form} as form, size, c[1] as word, {_TEXT} as x from (select item_id, size, c[i : i + size - 1] as c, v[i : i + size - 1] as v
  from (select item_id, c, v, {size} as size, unnest(range(1, len(c) - {size} + 2)) as i from b{form}_c where len(c) >= {least})) where {_ENOUGH}"""


def _document_sql(form: int) -> str:
    whole = f"and (size >= {SHORTEST} or not s[i] and (i + size > len(c) or not s[i + size]))" if form == PLAIN else ""
    return f"""
select doc_id, {form} as form, {_TEXT} as x from (select doc_id, size, c[i : i + size - 1] as c, v[i : i + size - 1] as v
  from (select doc_id, c, v, s, unnest(range(1, len(c) + 1)) as i from d{form}_c) p
    join (select distinct size, word from bw where form = {form}) z on p.c[p.i] = z.word
  where i + size - 1 <= len(c) {whole}) where {_ENOUGH}"""


ORACLE = f"""
with {_words_sql('b', 'item_id', 'benchmark')}, {_words_sql('d', 'doc_id', 'documents')},
{', '.join(_form_sql('b', 'item_id', form) for form in FORMS)}, {', '.join(_form_sql('d', 'doc_id', form) for form in FORMS)},
bw as materialized ({' union all '.join(map(_item_sql, FORMS))}),
bs as (select form, x, min(item_id) as item_id, count(distinct item_id) as n_items, list(distinct item_id) as items from bw group by form, x),
dw as ({' union all '.join(map(_document_sql, FORMS))}),
e as (select doc_id, item_id, form, count(distinct x)::bigint as n_windows, max(n_items)::bigint as n_items, flatten(list(distinct items)) as items
  from dw join bs using (form, x) group by all)
select doc_id, item_id, arg_min(n_windows, form) as n_windows, arg_min(n_items, form) as n_items,
  array_to_string(list_sort(list_distinct(arg_min(items, form))), ',') as item_ids from e group by doc_id, item_id
"""
