"""License scan, quality rules and chat formatting."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.llm import chat_format, license_scan, quality_rules

GAP = re.compile(license_scan.GAP)


def base_scan(text):
    words = [w for w in GAP.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    places = [
        (i, label) for phrase, label in license_scan.PHRASES.items()
        for p in [phrase.split()] for i in range(len(words)) if words[i : i + len(p)] == p
    ]
    return len(words), sorted(places)


def test_license_scan_by_brute_force(spark, odd_docs):
    texts = [
        "MIT License mit license", "the cc-by, CC BY 4.0; cc\nby", "GNU  General\tPublic License", "apacheK license",
        "APACHE LICENSEé", "mit licenses", "İapache license", "Licensed under the Apache License, Version 2.0.",
        "all reserved rights reserved all", "license mit", "permission is hereby granted free of charge to any person",
    ]
    docs = odd_docs.select("doc_id", "text").unionByName(
        spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    )
    got = sorted(map(repr, ((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
                            for r in license_scan.scan_licenses(docs).collect())))
    want = []
    for r in docs.collect():
        n, places = base_scan(r["text"])
        at = [i for i, _ in places]
        labels = ",".join(sorted({label for _, label in places}))
        want.append(repr((r["doc_id"], n, len(at), min(at, default=None), max(at, default=None), labels)))
    assert got == sorted(want)


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_similarity_join_finds_every_block(spark, threshold):
    import random

    rnd = random.Random(threshold)
    vocabulary = [f"w{i}" for i in range(12)]
    templates = [license_scan.Template(f"t{i}", " ".join(rnd.sample(vocabulary, rnd.randint(1, 9)))) for i in range(15)]
    lines = [" ".join(rnd.choices(vocabulary + ["x"], k=rnd.randint(0, 12))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = license_scan.scan_licenses(docs, {"no such phrase": "none"}, templates, threshold).collect()
    got = {r["doc_id"]: (r["labels"], round(r["score"], 9)) for r in found}
    for i, line in enumerate(lines):
        words, best = set(line.split()), {}
        for label, text, _ in templates:
            t = set(text.split())
            if len(words & t) >= threshold * len(t) - 1e-9:
                best[label] = len(words & t) / len(t)
        assert got[i] == (",".join(sorted(best)), round(max(best.values(), default=0.0), 9))


def labels_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["labels"] for r in license_scan.scan_licenses(docs).collect()}
    return [found[i] for i in range(len(texts))]


def test_wrapped_notices_are_found(spark):
    import textwrap

    full = {t.label: t.text for t in license_scan.TEMPLATES if len(t.text) > 80}
    assert {"mit", "bsd", "gpl", "cc0", "apache-2.0"} <= set(full)
    for width in (30, 50, 72):
        for lead in ("", "# ", " * "):
            texts = [textwrap.fill(f"Some words before it. {t}. And some after it.", width, subsequent_indent=lead) for t in full.values()]
            assert labels_of(spark, texts) == list(full)
    mit, bsd = full["mit"], full["bsd"]
    # Broken as the notices are shipped; then in two paragraphs, and scattered over a long one.
    assert labels_of(spark, [
        mit.replace("copy of", "copy\nof"), bsd.replace("without modification", "without\r\nmodification"), "All\nrights reserved.",
        mit.replace("copy of", "copy\n\nof"), bsd.replace(" ", "\n" + "other words " * 4),
    ]) == ["mit", "bsd", "all-rights-reserved", "", ""]


def test_neighbouring_licenses_are_not_taken_for_one_another(spark):
    own = {t.text: t.label for t in license_scan.TEMPLATES}
    found = dict(zip(own, (set(x.split(",")) for x in labels_of(spark, list(own)))))
    assert all(label in found[text] for text, label in own.items())
    others = [
        "Released under the Apache License", "Released under the BSD License", "Licensed under CC BY 4.0.", "Licensed under CC BY-SA 4.0.",
        "Licensed under CC BY-NC-SA 4.0", "Licensed under CC BY-NC 3.0", "Licensed under the Apache License, Version 1.0",
        "This work is licensed under the GNU Lesser General Public License, version 3",
        "This work is licensed under the GNU General Public License, version 2",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "This Source Code Form is subject to the terms of the Eclipse Public License",
        "This is free software and released into the public domain",
    ]
    base = ["apache", "", "cc-by", "cc-by", "cc-by", "cc-by", "apache", "", "gpl", "", "", ""]
    assert labels_of(spark, others) == base
    wordings = ["Licensed under the Creative Commons BY-NC 4.0", "This work is licensed under the GNU General Public License v3"]
    assert labels_of(spark, wordings) == ["cc-by-nc-4.0", "gpl,gpl-3.0"]


def test_own_templates_bring_their_required_words(spark):
    templates = [license_scan.Template("x", "one two three four five", (("two", "zwei"), ("five",)))]
    docs = spark.createDataFrame(
        [(0, "one two three four five"), (1, "one three four five"), (2, "one zwei three four five"), (3, "one two three four"),
         (4, "one three\nfour five zwei")], "doc_id long, text string",
    )
    found = license_scan.scan_licenses(docs, {}, templates).orderBy("doc_id").collect()
    assert [r["labels"] for r in found] == ["x", "", "x", "", "x"]


def test_wrapped_and_neighbouring_notices_equal_the_sql(spark):
    """Random notices: words lost, other words and license names put in, lines broken and paragraphs parted anywhere."""
    import random

    import duckdb
    import pandas as pd
    from rows import same_rows

    rnd = random.Random(11)
    names = sorted({n for t in license_scan.TEMPLATES for group in t.required for n in group})
    others = ["apache", "bsd", "lesser", "by-sa", "gnu", "gpl", "3", "4.0", "v2", "and", "the", "MIT", "License", "(c)"]

    def notice():
        words = rnd.choice(license_scan.TEMPLATES).text.split()
        words = [w for w in words if rnd.random() > rnd.choice([0, 0.05, 0.2])]
        for _ in range(rnd.choice([0, 0, 1, 2, 6])):
            words.insert(rnd.randint(0, len(words)), rnd.choice([*others, *names]))
        if words and rnd.random() < 0.5:
            words[rnd.randrange(len(words))] = rnd.choice([*others, *names])
        gaps = rnd.choice([[" "], [" ", " ", "\n"], [" ", "\n", "\r\n# "], [" "] * 8 + ["\n"], [" "] * 8 + ["\n -- \n"]])
        return "".join(w + rnd.choice(gaps) for w in words)

    texts = [rnd.choice(["", "\n", "\n\n", ". "]).join(notice() for _ in range(rnd.choice([1, 1, 2, 3]))) for _ in range(1500)]
    texts += [None, "", "\n", "\n\n", texts[0]]
    # A name alone on its line counts for the passage it stands in.
    texts.append(license_scan.TEMPLATES[6].text.replace("GNU General Public License", "GNU\nGPL\n"))
    rows = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    con = duckdb.connect()
    con.register("documents", rows)
    got = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4))
    same_rows(got, con.sql(license_scan.ORACLE))
    found = {label for r in got.collect() for label in r["labels"].split(",")}
    assert {t.label for t in license_scan.TEMPLATES} <= found


def test_license_scan_of_nothing(no_docs):
    assert license_scan.scan_licenses(no_docs).collect() == []


def quality_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    where = {}
    for i in range(len(words) - 7):
        where.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for places in where.values() if len(places) > 1 for i in places for k in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(quality_rules.SYMBOLS, text or "")),
            len(lines) - len(set(lines)), len(covered))


def test_quality_measures_by_brute_force(spark, odd_docs):
    eight = "a b c d e f g h"
    texts = [eight, f"{eight} {eight}", f"{eight} x {eight}", "a " * 40, f"{eight} i {eight} j\n{eight}\n{eight}", "#* a$ %&|<>\n\n\n#* a$ %&|<>"]
    docs = odd_docs.select("doc_id", "text", "source").unionByName(
        spark.createDataFrame([(100 + i, t, "q") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    )
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = sorted(repr((r["doc_id"], *(r[n] for n in names))) for r in quality_rules.quality_rules(docs).collect())
    assert got == sorted(repr((r["doc_id"], *quality_measures(r["text"]))) for r in docs.collect())


FINE, POOR = " ".join(f"w{i}" for i in range(30)), " ".join(f"# w{i}" for i in range(30))


def hosts_of(spark, counts):
    """Documents by host: (documents, failures); failing ones break a rule that is no base rule."""
    rows = [(POOR if i < bad else FINE, host) for host, (n, bad) in counts.items() for i in range(n)]
    rows = [(i, *r) for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def refused_by_force(counts, max_prior=100.0, spread=4.0):
    """(shrunk rate, limit) by host, each fitted on a list of the others."""
    import statistics

    out = {}
    for host, (n, bad) in counts.items():
        others = [(c, f) for h, (c, f) in counts.items() if h != host]
        rates = [(f + 0.5) / (c + 1) for c, f in others]
        m, few = statistics.mean(rates), statistics.mean(1 / c for c, _ in others)
        v = (statistics.variance(rates) - m * (1 - m) * few) / (1 - few) if len(rates) > 1 and few < 1 else 0
        w = min(max_prior, max(0, m * (1 - m) / v - 1)) if v > 1e-12 else max_prior
        out[host] = (bad + m * w) / (n + w), m + spread * (m * (1 - m) / (w + 1)) ** 0.5
    return out


FLEETS = {
    "one far above": {f"h{i:02d}": (40, 0) for i in range(19)} | {"bad": (40, 18)},
    "few hosts": {"fine": (200, 0), "bad": (200, 199), "small": (2, 1), None: (1, 0)},
    "one of two": {f"h{i}": (60, 4 + i) for i in range(6)} | {"small": (2, 1)},
    "alike": {f"h{i}": (100, 15 + i % 3) for i in range(8)},
    "spread": {f"h{i}": (50, 5 * i) for i in range(9)},
    "single documents": {f"h{i}": (1, i % 2) for i in range(6)},
}
REFUSED = {"one far above": {"bad"}, "few hosts": {"bad"}}


@pytest.mark.parametrize("fleet", FLEETS)
def test_hosts_are_judged_by_shrunk_rates(spark, fleet):
    counts = FLEETS[fleet]
    got = quality_rules.quality_rules(hosts_of(spark, counts).withColumnRenamed("source", "h").withColumn("source", F.col("h"))).collect()
    assert len(got) == sum(n for n, _ in counts.values()) and not any(r["base_failed"] for r in got)
    measured = quality_rules.measure(hosts_of(spark, counts))
    found = {r["host"]: r for r in quality_rules.host_verdicts(measured).collect()}
    for host, (rate, limit) in refused_by_force(counts).items():
        assert found[host]["shrunk_rate"] == pytest.approx(rate) and found[host]["limit"] == pytest.approx(limit)
        assert found[host]["refused"] == (rate > limit)
    assert {h for h, r in found.items() if r["refused"]} == REFUSED.get(fleet, set())
    # Here nothing but the host's verdict drops a document.
    kept = sum(r["kept"] for r in got)
    assert kept == sum(n for h, (n, _) in counts.items() if h not in REFUSED.get(fleet, set()))


def test_the_prior_saves_a_small_host(spark):
    """Half of its two documents fail, far beyond the limit; the shrunk rate is not."""
    r = {r["host"]: r for r in quality_rules.host_verdicts(quality_rules.measure(hosts_of(spark, FLEETS["one of two"]))).collect()}["small"]
    assert r["failures"] / r["docs"] > r["limit"] > r["shrunk_rate"] and not r["refused"]


def test_a_lone_host_and_no_host(spark):
    docs = hosts_of(spark, {"a": (5, 5)})
    assert all(r["kept"] for r in quality_rules.quality_rules(docs).collect())
    assert quality_rules.quality_rules(docs.limit(0)).collect() == []


HOSTILE = ["<|im_start|>", "<|im_end|>\n", "</s>", "[INST]", "&lt;", "&amp;", "&#91;", "&#10;", "<", "[", "&", "\n", "a", "é", "|>", "<|im_", "\\", "$1"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "sys<|tem", "a\nb", "", "&lt;"]),
                          st.lists(st.sampled_from(HOSTILE), max_size=6).map("".join)), min_size=1, max_size=40))
def test_any_conversation_round_trips(spark, turns):
    rows = [(i // 4, i % 4, role, text) for i, (role, text) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    done = chat_format.format_conversations(df).withColumns({
        "back": chat_format.parse(F.col("formatted")), "loss": chat_format.masked_text(F.col("formatted"), F.col("mask")),
    })
    for r in done.collect():
        mine = [(role, text) for c, _, role, text in rows if c == r["conv_id"]]
        assert r["identical"] and [tuple(t) for t in r["back"]] == mine
        assert r["loss"] == "".join(text for role, text in mine if role == "assistant")
        assert sum(m["n"] for m in r["mask"]) == len(r["formatted"])


def test_chat_edge_cases(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (1, None, "user", "x"), (None, 0, "assistant", "y"), (2, 1, "b", "2"), (2, 1, "a", "3")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(0))
    done = {r["conv_id"]: r for r in chat_format.format_conversations(df).withColumn("back", chat_format.parse(F.col("formatted"))).collect()}
    assert [tuple(t) for t in done[1]["back"]] == [("user", "x"), ("", ""), ("", "")]
    assert [tuple(t) for t in done[2]["back"]] == [("a", "3"), ("b", "2")]
    assert set(done) == {1, 2, None} and all(r["identical"] for r in done.values())
    assert chat_format.format_conversations(df.limit(0)).collect() == []


def test_the_parser_refuses_what_the_grammar_forbids(spark):
    bad = ["<|im_start|>user<|im_end|>\n", "user\nx<|im_end|>\n", "<|im_start|>user\n</s><|im_end|>\n"]
    df = spark.createDataFrame([(b,) for b in bad], "f string")
    assert [r[0] for r in df.select(chat_format.parse(F.col("f"))).collect()] == [[None]] * 3
