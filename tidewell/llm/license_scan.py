r"""License scan: phrases at their places, and an exact set-similarity join with license templates.

The join finds every text block whose words hold at least ``threshold`` of a template's distinct words. A block is a line,
or a passage of a paragraph of several lines, so notices that are wrapped are found too.
Template words are ordered by how many blocks of the whole corpus hold them, rarest first. A block that meets
the threshold ``need = ceil(threshold * size)`` must hold one of the ``size - need + 1`` rarest words of the
template (prefix filter), must hold ``need`` template words at all (length filter), and the words from the
first common one on must be able to make up ``need`` (positional filter). What is left is counted exactly, and
must say what names the license (``Template.required``).
Only DataFrame functions are used.

Defined cases: NULL text is empty (no words, no labels, score 0); rows equal in doc_id and text are
one document and all get its result; NULL doc_id is a value like any other; an empty table gives no
row; other columns are ignored. What is broadcast or sent to the driver has one row per distinct
template word, which the caller's template list bounds, never one per document.
"""

import math
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.columns import join_same, let, row_key, text_or_empty
from tidewell.scratch import stored

# The phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


class Template(NamedTuple):
    """A wording and its label. ``required``: what a block must say, words side by side, to get the label; of each group one."""

    label: str
    text: str
    required: tuple[tuple[str, ...], ...] = ()


# Ways to say a version 4.
BY_4 = ("4", "v4", "version 4", "license 4", "license version 4", "international 4")
# Wordings of public licenses and notices, by label, and what names them.
TEMPLATES = [
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", (("apache",), ("2",))),
    Template("apache-2.0", "you may not use this file except in compliance with the License"),
    Template("apache-2.0", "distributed under the License is distributed on an AS IS BASIS WITHOUT WARRANTIES OR "
             "CONDITIONS OF ANY KIND either express or implied"),
    Template("mit", "Released under the MIT License", (("mit",),)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
             "and associated documentation files", (("associated",),)),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3",
             (("gnu general public license", "gnu gpl"), ("3", "v3"))),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
             "GNU General Public License as published by the Free Software Foundation",
             (("gnu general public license", "gnu gpl"),)),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0",
             (tuple(f"by {nc} {by}" for nc in ("nc", "noncommercial", "non commercial") for by in BY_4),)),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License",
             (tuple(f"{name} {by}" for name in ("attribution", "by") for by in (*BY_4, "international license 4")),)),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or "
             "neighboring rights to this work"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met"),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License", (("mozilla",),)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", (("unencumbered",),)),
    Template("all-rights-reserved", "All rights reserved"),
]
THRESHOLD = 0.8
# Fixed value: what lies between two words.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Fixed value: what lies between two paragraphs, a line without words.
PARAGRAPH = r"\n[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\n"


def no_hits() -> Column:
    return F.array().cast("array<struct<label:string,at:int>>")


def template_words(text: str) -> list[str]:
    """Distinct words of a template, in order."""
    return list(dict.fromkeys(w for w in re.split(GAP, text.lower()) if w))


def lowered(text: Column) -> Column:
    """A-Z in lower case. The two other letters that ``lower`` would turn into ASCII are first
    put out of its reach by letters of their kind, so no word is made or lost."""
    for letter, stand_in in (("\u212a", "\u0138"), ("\u0130", "\u0131")):
        text = F.replace(text, F.lit(letter), F.lit(stand_in))
    return F.lower(text)


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a lower-cased text."""
    return F.array_remove(F.split(text, GAP, -1), "")


def phrase_places(ws: Column, phrase: str) -> Column:
    """Start positions, in words from 0, of a phrase's consecutive words."""
    parts = phrase.split()

    def starts_here(i: Column) -> Column:
        here = F.get(ws, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            here = here & (F.get(ws, i + k) == part)
        return here

    return F.filter(F.sequence(F.lit(0), F.size(ws) - len(parts)), starts_here)


def phrase_hits(ws: Column, phrases: dict[str, str]) -> Column:
    """array<struct<label, at>> of all places of all phrases."""
    def places(phrase: str, label: str) -> Column:
        found = F.transform(phrase_places(ws, phrase), lambda i: F.struct(F.lit(label).alias("label"), i.alias("at")))
        return F.when(F.size(ws) >= len(phrase.split()), found).otherwise(no_hits())

    hits = [places(phrase, label) for phrase, label in phrases.items()]
    return F.concat(no_hits(), *hits)


def may_hold(text: Column, phrases: dict[str, str]) -> Column:
    """Whether a lower-cased text has some phrase's words side by side, if only as parts of words: all others need no
    search by position. Looks for each word by itself first, which is much cheaper."""
    maybe = F.lit(False)
    for phrase in phrases:
        parts = phrase.split()
        each = F.lit(True)
        for part in parts:
            each = each & F.contains(text, F.lit(part))
        maybe = maybe | (each & F.rlike(text, F.lit(GAP.join(map(re.escape, parts)))))
    return maybe


def needed(text: str, threshold: float) -> int:
    return math.ceil(threshold * len(template_words(text)) - 1e-9)


def span(text: str, threshold: float) -> int:
    """The words of the longest passage of which a template's words make up the threshold."""
    return math.ceil(sum(w != "" for w in re.split(GAP, text)) / threshold)


def block(ws: Column, vocabulary: list[str], names: list[str], least: int) -> Column:
    """The distinct template words among a block's words, and the names it says if it can hold a template at all."""
    said = lambda: let(
        F.concat(F.lit(" "), F.array_join(ws, " "), F.lit(" ")),
        lambda x: F.filter(F.array(*map(F.lit, names)), lambda n: F.contains(x, F.concat(F.lit(" "), n, F.lit(" ")))),
    )
    none = F.array().cast("array<string>")
    return let(F.array_distinct(F.filter(ws, lambda w: w.isin(vocabulary))), lambda held: F.struct(
        held.alias("words"), (F.when(F.size(held) >= least, said()).otherwise(none) if names else none).alias("names")
    ))


def wrapped_blocks(
    text: Column, lines: Column, vocabulary: list[str], names: list[str], least: int, templates: list[Template], threshold: float
) -> Column:
    """``block`` of each passage in a paragraph of several lines that holds a template. A passage starts with a word of the
    template and has at most ``span`` words."""
    kinds = F.array(*[
        F.struct(
            F.array(*map(F.lit, template_words(t.text))).alias("words"), F.lit(needed(t.text, threshold)).alias("need"),
            F.lit(span(t.text, threshold)).alias("span"),
        )
        for t in templates
    ])
    holds = lambda ws, t: F.size(F.array_intersect(ws, t["words"])) >= t["need"]

    def passages(ws: Column, t: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(ws)), lambda i: F.array_contains(t["words"], F.get(ws, i - 1)))
        return F.filter(F.transform(starts, lambda i: F.slice(ws, i, t["span"])), lambda part: holds(part, t))

    def of_paragraph(paragraph: Column) -> Column:
        return let(words(paragraph), lambda ws: F.flatten(
            F.transform(F.filter(kinds, lambda t: holds(ws, t)), lambda t: passages(ws, t))
        ))

    paragraphs = F.filter(F.split(text, PARAGRAPH, -1), lambda x: F.contains(x, F.lit("\n")))
    found = F.transform(F.flatten(F.transform(paragraphs, of_paragraph)), lambda ws: block(ws, vocabulary, names, least))
    # Most documents do not hold a template's words even all lines together.
    some = let(F.array_distinct(F.flatten(lines["words"])), lambda ws: F.exists(kinds, lambda t: holds(ws, t)))
    return F.when(F.contains(text, F.lit("\n")) & some, F.array_distinct(found)).otherwise(
        F.array().cast("array<struct<words:array<string>,names:array<string>>>")
    )


def scan(
    docs: DataFrame, phrases: dict[str, str], vocabulary: list[str], templates: list[Template], threshold: float
) -> DataFrame:
    """Per document: word count, phrase hits, and of each line and each wrapped passage the distinct template words."""
    names = sorted({n for t in templates for group in t.required for n in group})
    least = min((needed(t.text, threshold) for t in templates), default=1)

    def of_lines(text: Column, by_line: Column) -> Column:
        # No word crosses a line end, so the text's words are its lines' words.
        ws = F.flatten(by_line)
        held = F.filter(
            F.transform(by_line, lambda line: block(line, vocabulary, names, least)), lambda b: F.size(b["words"]) > 0
        )
        return F.struct(
            F.aggregate(by_line, F.lit(0).cast("long"), lambda n, line: n + F.size(line)).alias("n_words"),
            F.when(may_hold(text, phrases), let(ws, lambda w: phrase_hits(w, phrases))).otherwise(no_hits()).alias("hits"),
            let(held, lambda ls: F.concat(
                ls, wrapped_blocks(text, ls, vocabulary, names, least, templates, threshold)
            )).alias("blocks"),
        )

    found = let(lowered(F.col("text")), lambda low: let(
        F.transform(F.split(low, "\n", -1), words), lambda by_line: of_lines(low, by_line)
    ))
    rows = docs.select("doc_id", text_or_empty().alias("text"), row_key().alias("row_key"))
    return rows.select("doc_id", "row_key", found.alias("f")).select("doc_id", "row_key", "f.*")


def word_order(blocks: DataFrame, vocabulary: list[str]) -> list[str]:
    """The template words by the number of blocks that hold them, rarest first, then by the word."""
    counted = blocks.select(F.explode("words").alias("word")).groupBy("word").count()
    counts = {row["word"]: row["count"] for row in counted.collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def template_index(spark: SparkSession, templates: list[Template], order: list[str], threshold: float) -> DataFrame:
    """One row per prefix word of each template: where it stands and what the template needs."""
    place = {w: i for i, w in enumerate(order)}
    rows = []
    for label, text, required in templates:
        ordered = sorted(template_words(text), key=place.__getitem__)
        need = needed(text, threshold)
        rows += [
            F.struct(
                F.lit(word).alias("word"), F.lit(label).alias("label"),
                F.array(*map(F.lit, ordered)).alias("template_words"), F.lit(need).alias("need"), F.lit(i).alias("i"),
                F.array(*[F.array(*map(F.lit, group)) for group in required])
                .cast("array<array<string>>").alias("required"),
            )
            for i, word in enumerate(ordered[: len(ordered) - need + 1])
        ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def similarity_join(blocks: DataFrame, templates: list[Template], order: list[str], threshold: float) -> DataFrame:
    """(doc_id, row_key, label, containment) of every block that holds ``threshold`` of a template and what it requires."""
    index = template_index(blocks.sparkSession, templates, order, threshold)
    probes = blocks.select("doc_id", "row_key", "words", "names", F.explode("words").alias("word"))
    pairs = probes.join(F.broadcast(index), "word").where(F.size("words") >= F.col("need"))
    t, w = F.col("template_words"), F.col("words")
    first = ~F.exists(F.slice(t, F.lit(1), F.col("i")), lambda x: F.array_contains(w, x))
    # At the first common word, at most the rarest-first rest of either side can still follow.
    place = lambda x: F.array_position(F.array(*map(F.lit, order)), x)
    rest = F.size(F.filter(w, lambda x: place(x) > place(F.col("word"))))
    reachable = 1 + F.least(F.size(t) - F.col("i") - 1, rest)
    held = F.size(F.array_intersect(w, t))
    return (
        pairs.where(first).where(reachable >= F.col("need"))
        .withColumn("held", held).where(F.col("held") >= F.col("need"))
        .where(F.forall("required", lambda group: F.arrays_overlap(group, F.col("names"))))
        .select("doc_id", "row_key", "label", (F.col("held") / F.size(t)).alias("containment"))
    )


def scan_licenses(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: list[Template] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per document: places of the phrases, labels of phrases and templates, best score."""
    vocabulary = sorted({w for t in templates for w in template_words(t.text)})
    scanned = stored(scan(docs, phrases, vocabulary, templates, threshold), "license-scan")
    blocks = scanned.select("doc_id", "row_key", F.explode("blocks").alias("b")).select("doc_id", "row_key", "b.*")
    order = word_order(blocks, vocabulary)
    matched = similarity_join(blocks, templates, order, threshold).groupBy("doc_id", "row_key").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("containment")
    )
    joined = join_same(scanned.drop("blocks"), matched, ["doc_id", "row_key"], "left")
    base = F.sort_array(F.array_distinct(F.transform("hits", lambda h: h.label)))
    every = F.array_union(base, F.coalesce("more", F.array().cast("array<string>")))
    places = F.transform("hits", lambda h: h.at.cast("long"))
    return joined.select(
        "doc_id", "n_words",
        F.size("hits").cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.sort_array(every), ",").alias("labels"),
        F.when(F.size("hits") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _oracle() -> str:
    phrases = " union all ".join(
        f"select {p.split()!r} as p, '{label}' as label" for p, label in PHRASES.items()
    )
    kinds = " union all ".join(
        f"select '{t.label}' as label, {template_words(t.text)!r} as t, {needed(t.text, THRESHOLD)} as need, "
        f"{span(t.text, THRESHOLD)} as span, {[list(g) for g in t.required]!r}::varchar[][] as required"
        for t in TEMPLATES
    )
    return rf"""
with d as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as x
  from documents),
w as (select doc_id, x, list_filter(regexp_split_to_array(x, '{GAP}'), lambda y: y <> '') as w from d),
p as ({phrases}),
h as (select doc_id, label, i from (select doc_id, w, p, label, unnest(range(len(w))) as i
        from w, p where contains(x, p[1])) where w[i + 1 : i + len(p)] = p),
b as (select doc_id, count(*) as n, min(i) as lo, max(i) as hi, list(distinct label) as labels from h group by doc_id),
t as ({kinds}),
l as (select doc_id, list_filter(regexp_split_to_array(unnest(string_split(x, chr(10))), '{GAP}'), lambda y: y <> '') as l from d),
q as (select doc_id, list_filter(regexp_split_to_array(paragraph, '{GAP}'), lambda y: y <> '') as q
  from (select doc_id, unnest(regexp_split_to_array(x, '{PARAGRAPH}')) as paragraph from d where contains(x, chr(10)))
  where contains(paragraph, chr(10))),
v as (select doc_id, q[i : i + span - 1] as l, t, need
  from (select doc_id, q, t, need, span, unnest(range(1, len(q) + 1)) as i from q, t where len(list_intersect(q, t)) >= need)
  where list_contains(t, q[i])),
k as (select doc_id, l from l union all select doc_id, l from v where len(list_intersect(l, t)) >= need),
m as (select doc_id, label, len(list_intersect(l, t)) / len(t) as c, required, ' ' || array_to_string(l, ' ') || ' ' as said
  from k, t where len(list_intersect(l, t)) >= need),
s as (select doc_id, list(distinct label) as labels, max(c) as c from m
  where len(list_filter(required, lambda g: len(list_filter(g, lambda n: contains(said, ' ' || n || ' '))) = 0)) = 0
  group by doc_id)
select w.doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_base, lo::bigint as first_word, hi::bigint as last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') as base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(s.labels, [])))), ','), '')
    as labels,
  case when n > 0 then 1.0 else coalesce(c, 0.0) end::double as score
from w left join b using (doc_id) left join s using (doc_id)
"""


ORACLE = _oracle()
