"""Line dedup, SimHash near-dedup, decontamination."""

import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from tidewell.llm import components, decontamination, line_dedup, simhash_dedup


def lines_by_force(docs, min_docs, keep):
    """Texts after line dedup, by (doc_id, text)."""
    found, first = {}, {}
    for r in docs:
        name = (r["doc_id"], r["text"])
        # The operator's order of documents: by the text form of its document key.
        key = f"{'null' if r['doc_id'] is None else r['doc_id']}:{r['h64']}"
        for pos, line in enumerate(line_dedup.line_keys(r["text"])):
            if line:
                found.setdefault(line, set()).add(name)
                first[line] = min(first.get(line, (key, pos)), (key, pos))
    out = {}
    for r in docs:
        key = f"{'null' if r['doc_id'] is None else r['doc_id']}:{r['h64']}"
        text = (r["text"] or "").split("\n")
        stay = [
            x for pos, (x, k) in enumerate(zip(text, line_dedup.line_keys(r["text"])))
            if not k or len(found[k]) < min_docs or keep == "first" and first[k] == (key, pos)
        ]
        out[(r["doc_id"], r["text"])] = "\n".join(stay)
    return out


@pytest.fixture(scope="module")
def lined(spark, odd_docs):
    rnd = random.Random(3)
    lines = [" Hot line ", "hot LINE", "", "  ", "é", "a", "b\tc", *(f"line {i}" for i in range(30))]
    texts = ["\n".join(rnd.choices(lines, weights=[20, 20, 5, 2, 3] + [1] * 32, k=rnd.randint(0, 12))) for _ in range(300)]
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(more)
    return docs.withColumn("h64", F.xxhash64(F.coalesce("text", F.lit("")))).repartition(5)


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("min_docs", [1, 3, 10])
@pytest.mark.parametrize("parts", [1, 13])
def test_line_dedup_by_brute_force(spark, lined, keep, min_docs, parts):
    rows = lined.collect()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    # With many small partitions the hot line runs over several of them.
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = lined.drop("h64")
        bitmaps = line_dedup.keep_bitmaps(docs, min_docs=min_docs, keep=keep)
        got = line_dedup.apply(docs, bitmaps).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = lines_by_force(rows, min_docs, keep)
    assert sorted(repr((r["doc_id"], r["text"] or "")) for r in got) == sorted(
        repr((r["doc_id"], want[(r["doc_id"], r["text"])])) for r in rows
    )


def test_line_dedup_keeps_columns_and_nothing(odd_docs, no_docs):
    done = line_dedup.apply(odd_docs, line_dedup.keep_bitmaps(odd_docs, min_docs=2, keep="first"))
    assert done.schema == odd_docs.schema and done.count() == odd_docs.count()
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in done.collect())
    assert line_dedup.apply(no_docs, line_dedup.keep_bitmaps(no_docs)).collect() == []
    with pytest.raises(ValueError):
        line_dedup.keep_bitmaps(no_docs, keep="last")


def test_line_query_over_whole_texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("h64", F.xxhash64("text")).collect()
    want = lines_by_force(rows, 10, "none")
    got = {r["doc_id"]: r["kept_sha256"] for r in line_dedup.op6_line_dedup(spark, sf_dir).collect()}
    assert got == {r["doc_id"]: hashlib.sha256(want[(r["doc_id"], r["text"])].encode()).hexdigest() for r in rows}


def print_by_force(text, shingle=3):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(grams))


def components_by_force(values, most):
    """The smallest value reachable from each, over pairs at most ``most`` bits apart."""
    values = np.array(sorted(set(values)), dtype=np.uint64)
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= most):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    return {int(v): find(i) for i, v in enumerate(values)}


@pytest.mark.parametrize("text", [None, "", "a", "A b", "a b c", "x " * 70_000, "É b\x1cc d\x0be"])
def test_fingerprint(text):
    small = text if not text or len(text) < 1000 else text[:3000]
    assert simhash_dedup.fingerprint(small) == print_by_force(small)
    assert isinstance(simhash_dedup.fingerprint(text), int)


def test_fingerprint_in_chunks(monkeypatch):
    text = " ".join(str(i * i) for i in range(500))
    monkeypatch.setattr(simhash_dedup, "CHUNK", 7)
    assert simhash_dedup.fingerprint(text) == print_by_force(text)


@pytest.mark.parametrize("most", [1, 2, 3, 4])
def test_links_connect_what_full_links_connect(spark, most):
    rnd = random.Random(most)
    centres = [rnd.getrandbits(64) for _ in range(12)]
    values = {0}
    for c in centres:
        for _ in range(25):
            v = c
            for b in rnd.sample(range(64), rnd.randint(0, most + 2)):
                v ^= 1 << b
            values.add(v)
    df = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    active = simhash_dedup.neighbours(df, most, 4)
    found = components.connected_components(simhash_dedup.links(active, most)).collect()
    unsigned = lambda x: int(np.int64(x).view(np.uint64))
    mine = {v: v for v in values} | {unsigned(r["node"]): unsigned(r["root"]) for r in found}
    want = components_by_force(values, most)
    groups = lambda m: sorted(sorted(k for k in m if m[k] == g) for g in set(m.values()))
    assert groups(mine) == groups(want)


def test_near_duplicates_by_brute_force(spark, odd_docs, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id") + 100, "text").toDF("doc_id", "text")
    docs = odd_docs.select("doc_id", "text").unionByName(table)
    rows = docs.collect()
    prints = [print_by_force(r["text"]) if len(r["text"] or "") < 50_000 else simhash_dedup.fingerprint(r["text"]) for r in rows]
    roots = components_by_force(prints, 3)
    least = {}
    for r, p in zip(rows, prints):
        if r["doc_id"] is not None:
            least[roots[p]] = min(least.get(roots[p], r["doc_id"]), r["doc_id"])
    got = simhash_dedup.near_duplicates(docs).collect()
    assert sorted(repr((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"])) for r in got) == sorted(
        repr((r["doc_id"], p, least.get(roots[p]))) for r, p in zip(rows, prints)
    )
    one = simhash_dedup.one_of_each(docs).collect()
    assert len(one) == len(set(roots[p] for p in prints))


def test_one_of_each_keeps_columns(odd_docs, no_docs):
    done = simhash_dedup.one_of_each(odd_docs)
    assert done.columns == odd_docs.columns and done.where("doc_id = 1").count() == 0
    assert done.where("doc_id = 0").count() == 1 and simhash_dedup.one_of_each(no_docs).collect() == []


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000 + i, 1000) for i in range(300)] + [(5, 5), (1, 0)]
    random.Random(0).shuffle(edges)
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 300)}
    empty = spark.createDataFrame([], "u long, v long")
    assert components.connected_components(empty).collect() == []


ITEM = (
    "A train leaves the station at 9 and travels 120 km while Maria Lopez waits for 35 minutes near the old bridge "
    "until the second train arrives from the north"
)


def flagged(spark, texts, items, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("h", F.lit(1))
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, benchmark, **options).collect()}


def test_reparameterised_questions_are_found(spark):
    other = ITEM.replace("9", "7.30").replace("120", "1,400").replace("km", "miles").replace("Maria Lopez", "John").replace("35", "20")
    texts = [
        "Intro text here. " + ITEM + ". More text.", "Intro. " + other, ITEM.lower(),
        "A train leaves the station. Nothing else is the same here at all, not even by chance.", None, "", ITEM.upper(),
    ]
    assert {d for d, _ in flagged(spark, texts, [ITEM, None, ""])} == {0, 1, 2}


def test_slots_must_be_consistent(spark):
    item = "if 5 apples and 5 pears cost 10 coins then how many coins do 5 plums cost today"
    consistent = item.replace("5", "8").replace("10", "16")
    merged = item.replace("10", "5")
    split = item.replace("5 pears", "6 pears")
    assert {d for d, _ in flagged(spark, [item, consistent, merged, split], [item], window=18)} == {0, 1}


def test_short_items_and_copies_of_items(spark):
    short = "seven small words make one item"
    assert flagged(spark, [f"x {short} y", "seven small words make"], [short, short, "too short"]) == {(0, 0)}


def test_names_are_found_at_any_place_and_in_any_letters(spark):
    alice = "Alice has 5 apples and buys 3 more pears. How many fruits are there?"
    short = "What is the capital of that country"
    texts = [
        alice.replace("Alice", "Bob").replace("5", "7"), "So we read: " + alice.replace("Alice", "Bob"), f"Q: {short}?",
        f"He asked ({short})", ITEM.upper(), "Alice has 5 pears. How many apples are there?", "WHAT IS THE COLOUR OF THAT COUNTRY",
    ]
    found = flagged(spark, texts, [alice, short, ITEM], forms=decontamination.FORMS)
    assert found == {(0, 0), (1, 0), (2, 1), (3, 1), (4, 2)}


def test_copies_of_items_full_of_numbers_and_of_short_items_are_found(spark):
    numbers = "Compute 12 + 7 + 19 + 3 + 8 + 41 + 5 + 6 + 77 + 2 + 9 + 10 + 4."
    names = "Ada, Alan, Grace, Edsger, Donald, Barbara, John"
    items = [numbers, names, "name the largest inland sea", "12 * 3", "12, 12"]
    texts = [
        f"Work it out. {numbers} Done.", f"The list: {names.lower()}, and more.", "Think well! Name the largest inland sea. Then go on.",
        "as in\n12 * 3\nis 36", "1 12 7 and 12 13", numbers.replace("77", "78").replace("8", "9"), "name the largest inland lake", None,
        "so 12 * 3 is 36", "please name the largest inland sea",
    ]
    assert flagged(spark, texts, items, forms=decontamination.FORMS) == {(i, i) for i in range(4)}


def test_short_items_match_whole_sentences_only(spark, sf_dir):
    items = ["the", "Yes", "12", "Yes. No."]
    texts = ["The end of the day. Yes and no, 12 of them.", "Is it so? Yes. We go.", "the", "on\n12\noff", "No. yes! no; maybe", "Yes. No", None]
    assert flagged(spark, texts, items, forms=decontamination.FORMS) == {(1, 1), (2, 0), (3, 2), (4, 1), (5, 1), (5, 3)}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.createDataFrame(list(enumerate(items[:3])), "item_id long, text string")
    said = {r["doc_id"] for r in docs.collect() for part in re.split("[.!?\n]", r["text"])
            if [w.lower() for w in re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", part)] in (["the"], ["yes"], ["12"])}
    left = {r["doc_id"] for r in decontamination.clean_documents(docs, benchmark).collect()}
    assert left == {r["doc_id"] for r in docs.collect()} - said and len(said) < 0.2 * docs.count()


def test_every_item_of_a_window_is_named(spark):
    """Items 3 and 9 differ in a number; a document asks with a third one."""
    ask = "A shop sells {} boxes of tea each day for a week, how many boxes is that in all"
    docs = spark.createDataFrame([(0, ask.format(7)), (1, "Tell me. " + ask.format(30)), (2, "nothing")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(3, ask.format(5)), (9, ask.format(6)), (10, "What is asked here is not asked there")], "item_id long, text string")
    got = decontamination.contaminated(docs, benchmark, forms=decontamination.FORMS).collect()
    assert {(r.doc_id, r.item_id, r.n_items, r.item_ids) for r in got} == {(0, 3, 2, "3,9"), (1, 3, 2, "3,9")}


def test_any_benchmark_size_gives_the_same_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    full = sorted(decontamination.contaminated(docs, benchmark).drop("key").collect())
    # Six bits let nearly every window into the join.
    assert sorted(decontamination.contaminated(docs, benchmark, bits=6).drop("key").collect()) == full


@pytest.mark.parametrize("n", [3, 1000, 300_000])
def test_few_hashes_pass_the_filter_by_chance(spark, n):
    rnd = np.random.default_rng(n)
    known, others = (rnd.integers(0, 1 << 64, size, dtype=np.uint64) for size in (n, 200_000))
    bits = decontamination.filter_bits(n)
    assert decontamination.PER_WINDOW * n <= 1 << bits < 2 * decontamination.PER_WINDOW * n
    rows = spark.createDataFrame(pd.DataFrame({"template": known.view(np.int64)}))
    filled = decontamination.bloom_filter(rows, bits)
    pass_ = lambda h: len(decontamination.passing(h, np.arange(len(h)), filled, bits))
    assert pass_(known) == n and pass_(others) < 0.001 * len(others)
    assert decontamination.filter_bits(0) == 6 and decontamination.filter_bits(1 << 40) == decontamination.MOST_BITS


def plain_hits(docs, benchmark, n=13):
    words = lambda s: re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), s or ""))
    grams = lambda s: {tuple(w[i : i + n]) for w in [words(s)] for i in range(len(w) - n + 1)}
    seen = set().union(*(grams(r["text"]) for r in benchmark))
    return {r["doc_id"] for r in docs if grams(r["text"]) & seen}


def test_every_shared_passage_is_found(spark, sf_dir):
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    want = plain_hits(docs.collect(), benchmark.collect())
    got = {r["doc_id"] for r in decontamination.op7_benchmark_decontamination(spark, sf_dir).collect()}
    assert want and got == want
    left = decontamination.clean_documents(docs, benchmark)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {r["doc_id"] for r in docs.collect()} - want


def test_decontamination_of_odd_tables(odd_docs, no_docs, spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").withColumn("h", F.lit("x"))
    assert decontamination.clean_documents(odd_docs, benchmark).count() == odd_docs.count()
    assert decontamination.clean_documents(no_docs, benchmark).collect() == []
    assert decontamination.clean_documents(odd_docs, benchmark.limit(0)).count() == odd_docs.count()


def test_pieces_of_long_texts_give_the_same_words(monkeypatch):
    import functools

    from tidewell.llm import quality_classifier, word_hashes

    texts = ["a b c", None, "", "lorem ipsum Dolor. Sit amet\n" * 50, "x y", "word " * 300]
    # Names, numbers and units at seams that are cut at a blank.
    texts += ["went Ana Maria Lopez 12 km and 1,234.5 kg to Rome " * 40, ". , " * 200, "end"]
    together = lambda groups: [np.concatenate(x).tolist() for x in zip(*groups)]
    whole = together(decontamination.canonical_texts(texts)), sorted(zip(*together(quality_classifier.ngrams(texts))))
    for module in (decontamination, quality_classifier):
        monkeypatch.setattr(module, "pieces", functools.partial(word_hashes.pieces, size=100))
    for size in (100, 37, 64):
        for module in (decontamination, quality_classifier):
            monkeypatch.setattr(module, "pieces", functools.partial(word_hashes.pieces, size=size))
        assert together(decontamination.canonical_texts(texts)) == whole[0]
    assert sorted(zip(*together(quality_classifier.ngrams(texts)))) == whole[1]


def test_canonical_windows_equal_their_sql(spark):
    import duckdb
    import pyarrow as pa

    rnd = random.Random(11)
    words = ["the", "train", "runs", "from", "to", "Paris", "Rome", "Maria", "LOPEZ", "Écoute", "élan", "5", "12", "km", "Hours", "é"]
    gaps = [" ", " ", " ", " ", ", ", ". ", "\n", ".", ",", "  ", "-", "\t", "! "]

    def sentence(n):
        return "".join(rnd.choice(words) + rnd.choice(gaps) for _ in range(n))

    items = [sentence(rnd.randint(0, 25)) for _ in range(30)] + [None, ""]
    items += [items[0], items[1].replace("5", "7").replace("Paris", "Oslo"), "the train", "5", "Maria runs to Rome"]
    texts = [None, "", "Zu"] + [sentence(rnd.randint(0, 60)) for _ in range(200)]
    for i in range(100):
        item = rnd.choice(items) or ""
        for old, new in (("5", "9"), ("Maria", "Eva"), ("km", "miles"), ("12", "5"), ("Rome", "Paris")):
            item = item.replace(old, new) if rnd.random() < 0.4 else item
        texts.append(sentence(4) + item + sentence(4))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    con = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", texts), ("benchmark", "item_id", items)):
        con.register(name, pa.table({key: pa.array(range(len(rows)), pa.int64()), "text": pa.array(rows, pa.string())}))
    want = con.sql(decontamination.ORACLE).fetchall()
    found = decontamination.contaminated(docs, benchmark, forms=decontamination.FORMS)
    got = found.select("doc_id", "item_id", "n_windows", "n_items", "item_ids").collect()
    assert len(want) > 20 and any("," in w[-1] for w in want)
    missing, extra = set(want) - set(map(tuple, got)), set(map(tuple, got)) - set(want)
    assert not missing and not extra and len(got) == len(want)
