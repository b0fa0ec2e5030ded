"""Token counts, language identification, quality classifier, BPE."""

import math
import random
import re
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewell.llm import bpe, language_id, pretokens, quality_classifier, token_counts
from tidewell.scratch import scratch_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_strings(n, seed=1):
    rnd = random.Random(seed)
    pool = [chr(rnd.randrange(0x20, 0x3000)) for _ in range(200)]
    pool += list(" \t\n\r\x0b\x0c\x1c\x1d\x85\xa0'sstrdevemll_²½Ⅷ一٣12 ab,.!​　\x00\x7f") * 5
    pool += ["<|endoftext|>", " '", "\n\n", "  ", "\U0001f642"]
    return ["".join(rnd.choices(pool, k=rnd.randrange(60))) for _ in range(n)]


def ids_of(library, texts):
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_the_library(library):
    texts = odd_strings(5000)
    assert token_counts.WordCounts(PATH).counts(texts) == list(map(len, ids_of(library, texts)))


def test_words_are_forgotten_without_harm(library, monkeypatch):
    monkeypatch.setattr(token_counts, "MEMORY", 40 * token_counts.ENTRY)
    counter, texts = token_counts.WordCounts(PATH), odd_strings(300)
    assert [counter.counts([t])[0] for t in texts] == list(map(len, ids_of(library, texts)))
    assert len(counter.known) + len(counter.older) < 300


def test_long_words_are_not_remembered(library):
    """A table of encoded runs: 100,000 different words of 100 to 300 letters."""
    rnd = random.Random(4)
    counter = token_counts.WordCounts(PATH)
    for _ in range(100):
        words = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randrange(100, 300))) for _ in range(1000)]
        counter.counts(words)
        assert not counter.known and not counter.older and not counter.held
    assert counter.counts(words[:50] + ["some words"]) == list(map(len, ids_of(library, words[:50] + ["some words"])))


def test_the_cache_is_asked_first(spark, odd_docs, library):
    cache = scratch_dir(spark, "cache")
    rows = {(r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in token_counts.count_tokens(odd_docs, PATH, cache).collect()}
    texts = [r["text"] or "" for r in odd_docs.collect()]
    ids = ids_of(library, texts)
    want = [(r["doc_id"], len(t.encode()), len(i)) for r, t, i in zip(odd_docs.collect(), texts, ids)]
    assert rows == set(want)
    stored = spark.read.parquet(cache)
    assert stored.count() == len(set(texts)) and set(stored.columns) == {"digest", "tokenizer", "n_tokens"}
    again = token_counts.count_tokens(odd_docs, PATH, cache)
    assert again.count() == len(texts) and spark.read.parquet(cache).count() == len(set(texts))
    # Counts of another version of the tokenizer are not this one's.
    other = scratch_dir(spark, "cache")
    stored.withColumn("tokenizer", F.lit("another")).withColumn("n_tokens", F.lit(-1).cast("long")).write.parquet(other)
    assert token_counts.count_tokens(odd_docs, PATH, other).where("n_tokens < 0").count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_files_are_counted_by_their_library(spark, odd_docs, name):
    import sentencepiece

    path = public_tokenizers.path(name)
    texts = [r["text"] or "" for r in odd_docs.collect()]
    if name.endswith(".model"):
        want = list(map(len, sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)))
    else:
        want = list(map(len, ids_of(Tokenizer.from_file(path), texts)))
        with pytest.raises(ValueError):
            bpe.Merges(path)
    got = token_counts.count_tokens(odd_docs, path, scratch_dir(spark, "cache")).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(want)


def test_counting_nothing(spark, no_docs):
    assert token_counts.count_tokens(no_docs, PATH, scratch_dir(spark, "cache")).collect() == []


def test_count_query_by_brute_force(spark, sf_dir, library):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    ids = ids_of(library, [r["text"] for r in rows])
    got = sorted(map(tuple, token_counts.op2_token_counts(spark, sf_dir).collect()))
    assert got == sorted((r["doc_id"], len(r["text"].encode()), len(i), len(i) > 512) for r, i in zip(rows, ids))


def test_ids_equal_the_library(library):
    texts = odd_strings(5000, seed=2)
    coder = bpe.Encoder(PATH)
    assert [coder.encode(t) for t in texts] == ids_of(library, texts)


@pytest.mark.parametrize("word", [
    "a" * 3000, "".join(random.Random(5).choices("etaoinshrdlu", k=5000)), "!?" * 1500, "-" * 3001, "é" * 2000, "\n" * 2000,
    "".join(random.Random(6).choices(["tion", "the", "ing", "er", "ou", "ss", "s"], k=2000)),
])
def test_stream_with_the_least_window_equals_the_library(library, word):
    merges = bpe.encoder(PATH).merges
    want = library.encode(word, add_special_tokens=False).ids
    assert list(merges.stream(word.encode(), window=merges.lookahead + 40)) == want
    assert bpe.encoder(PATH).encode(word) == want


def test_long_texts_are_cut_where_words_end(library, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", 600)
    rnd = random.Random(9)
    text = "".join(rnd.choice(["word", " ", "\n", "  ", "x" * 50, " a", "1", "'s"]) for _ in range(4000))
    assert bpe.Encoder(PATH).encode(text) == library.encode(text, add_special_tokens=False).ids


def test_words_known_are_bounded(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 50 * bpe.ENTRY)
    coder, texts = bpe.Encoder(PATH), odd_strings(500, seed=3)
    assert [coder.encode(t) for t in texts] == ids_of(library, texts)
    assert len(coder.words) < 200


@pytest.mark.parametrize("step", [1, 3, 4096])
def test_decoding_equals_the_library(library, step):
    rnd, merges = random.Random(step), bpe.encoder(PATH).merges
    # Any ids at all, so that characters are cut and bytes are no UTF-8.
    for _ in range(400):
        ids = [rnd.randrange(len(merges.bytes)) for _ in range(rnd.randrange(30))]
        assert "".join(bpe.decode(merges, ids, step)) == library.decode(ids, skip_special_tokens=False)


def test_a_state_holds_three_bytes_at_most():
    for text in ("é", "€", "\U0001f642", "aé€\U0001f642z"):
        state, out = bpe.ByteText(), ""
        for byte in text.encode():
            out += state.feed(bytes([byte]))
            assert len(state.held) <= 3
        assert out + state.close() == text


def test_documents_round_trip(odd_docs, no_docs):
    encoded = bpe.encode_documents(odd_docs, PATH, keep=("doc_id", "text"), verify=True)
    decoded = bpe.decode_documents(encoded, PATH)
    assert all(r["decoded"] == (r["text"] or "") and r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in decoded.collect())
    assert bpe.encode_documents(no_docs, PATH).collect() == []


def test_bpe_query_by_brute_force(spark, sf_dir, library):
    from hashlib import sha256

    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    ids = ids_of(library, [r["text"] for r in rows])
    want = sorted(
        (r["doc_id"], len(i), sha256(",".join(map(str, i)).encode()).hexdigest(),
         sha256(library.decode(i, skip_special_tokens=False).encode()).hexdigest()) for r, i in zip(rows, ids)
    )
    assert sorted(map(tuple, bpe.op8_bpe_round_trip(spark, sf_dir).collect())) == want


def test_pretokens_of_number_signs():
    assert pretokens.pattern().findall("a²b 1½Ⅷx") == ["a", "²", "b", " 1½Ⅷ", "x"]


def grams_by_force(text):
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    if not words:
        return Counter()
    padded = " " + " ".join(words) + " "
    found = Counter(c for c in padded if c != " ")
    found.update(padded[i : i + 2] for i in range(len(padded) - 1))
    found.update(padded[i : i + 3] for i in range(len(padded) - 2) if padded[i + 1] != " ")
    return found


def code(gram):
    n = 0
    for c in gram:
        n = n << 21 | ord(c)
    return n


def test_profiles_and_distances_by_brute_force(spark, sf_dir):
    size = 50
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows, counts = docs.collect(), {}
    for r in rows:
        counts.setdefault(r["lang"], Counter()).update({code(g): n for g, n in grams_by_force(r["text"]).items()})
    top = lambda c: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:size]]
    want = {lang: top(c) for lang, c in counts.items() if lang is not None}
    profiles = language_id.learn_profiles(docs, size)
    assert profiles == want
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(docs, profiles, size).collect()}
    for r in rows:
        own = top({code(g): n for g, n in grams_by_force(r["text"]).items()})
        far = {
            lang: sum(abs(profile.index(g) - i) if g in profile else size for i, g in enumerate(own))
            for lang, profile in want.items()
        }
        best = min(sorted(far), key=far.__getitem__)
        assert got[r["doc_id"]] == (best, pytest.approx(1 - far[best] / (size * len(own))))


def test_languages_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    found = language_id.op3_language_id(spark, sf).where("held_out").join(truth, "doc_id")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_language_edge_cases(spark, odd_docs, no_docs):
    profiles = language_id.learn_profiles(odd_docs, 30)
    assert set(profiles) == {"en", "fr"}
    got = language_id.identify(odd_docs, profiles, 30).collect()
    assert len(got) == odd_docs.count()
    assert {r["lang_pred"] for r in got if r["doc_id"] in (3, 4, 5)} == {"und"}
    assert language_id.learn_profiles(no_docs, 30) == {}
    assert {r["lang_pred"] for r in language_id.identify(odd_docs, {}, 30).collect()} == {"und"}


def test_good_documents_are_kept_and_poor_ones_go(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    # Half of the labels are held out.
    shown = F.col("doc_id") % 2 == 0
    judged = quality_classifier.classify(docs, labels.where(shown)).join(labels.where(~shown), "doc_id")
    share = lambda where: judged.where(where).agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert share("quality = 1 and toxic = 0") > 0.98 and share("quality = 0") < 0.05


def test_well_written_toxic_documents_go(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    shown = F.col("doc_id") % 2 == 0
    judged = quality_classifier.classify(docs, labels.where(shown)).join(labels, "doc_id")
    share = lambda where: judged.where(where).agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert share(shown & F.expr("quality = 1 and toxic = 1")) < 0.1
    assert share(~shown & F.expr("quality = 1 and toxic = 1")) < 0.3 and share("quality = 1 and toxic = 0") > 0.98


def test_classifier_edge_cases(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(0, 1, 0), (0, 1, 0), (1, 1, None), (6, 0, 0), (None, 0, 0), (2, None, 0), (8, 0, 1), (7, 1, 0), (7, 0, 0)],
        "doc_id long, quality int, toxic int",
    )
    kept = quality_classifier.select_documents(odd_docs, labels)
    assert kept.columns == odd_docs.columns
    judged = quality_classifier.classify(odd_docs, labels)
    assert judged.count() == odd_docs.count() and judged.where("kept").count() == kept.count()
    assert quality_classifier.select_documents(no_docs, labels).collect() == []
    assert quality_classifier.select_documents(odd_docs, labels.limit(0)).count() == odd_docs.count()
    assert quality_classifier.select_documents(odd_docs, labels.where("quality = 1")).count() == odd_docs.count()


def test_weights_by_brute_force(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1 and r["toxic"] == 0}
    raw, target, per_doc = np.zeros(1 << 16), np.zeros(1 << 16), {}
    for r in docs.collect():
        found = np.concatenate([b for _, b in quality_classifier.ngrams([r["text"]])])
        per_doc[r["doc_id"]] = found
        np.add.at(raw, found, 1)
        if r["doc_id"] in good:
            np.add.at(target, found, 1)
    expected = raw * target.sum() / raw.sum()
    ratio = np.log((target + 0.5) / (expected + 0.5))
    ratio = np.sign(ratio) * np.maximum(0, abs(ratio) - 2 / np.sqrt(target + 0.5))
    for r in quality_classifier.classify(docs, labels).collect():
        found = per_doc[r["doc_id"]]
        assert r["log_weight"] == pytest.approx(256 * ratio[found].sum() / (len(found) + 64), abs=1e-3)


ALL = (1 << 64) - 1


def spread(h):
    h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 & ALL
    h = (h ^ (h >> 27)) * 0x94D049BB133111EB & ALL
    return h ^ (h >> 31)


@cache
def word_number(word):
    return spread(sum((b + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, b in enumerate(word)) & ALL)


def buckets_by_force(text):
    """Buckets of the words and of the pairs of words next to each other, word by word."""
    words = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[!-/:-@[-`{-~]+", (text or "").encode())
    numbers = [word_number(w) for w in words]
    pairs = [1 if a == b else spread((b * 3 + a) & ALL) for a, b in zip(numbers, numbers[1:])]
    return Counter(n % (1 << 16) for n in numbers + pairs)


def log_ratio_by_force(some, others):
    share = sum(some.values()) / sum(others.values())
    found = {}
    for bucket in others.keys() | some.keys():
        log = math.log((some[bucket] + 0.5) / (others[bucket] * share + 0.5))
        found[bucket] = math.copysign(max(0.0, abs(log) - 2 / math.sqrt(some[bucket] + 0.5)), log)
    return found


def cut_by_force(good, poor):
    """Tries every value: the shares of good ones at or above it and of poor ones below it; of equals the one above the widest gap."""
    values = sorted({*good, *poor})
    tried = [
        (round(sum(g >= v for g in good) / len(good) + sum(p < v for p in poor) / len(poor), 12), v - below, v)
        for below, v in zip([values[0], *values], values)
    ]
    _, gap, value = max(tried, key=lambda t: t[:2])
    return value - gap / 2


def noise_by_force(doc_id, text):
    signed = xxhash.xxh64_intdigest((text or "").encode(), 42)
    key = f"{doc_id}:{signed - (1 << 64) if signed >> 63 else signed}"
    seed = xxhash.xxh64_intdigest((7).to_bytes(4, "little"), 42)
    return -math.log(-math.log(((xxhash.xxh64_intdigest(key.encode(), seed) >> 12) + 0.5) / (1 << 52)))


def test_classifier_by_brute_force(spark):
    """Both weights, both cuts, k, the keys and the verdicts, from plain Python alone."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    kind = {
        r["doc_id"]: "poor" if r["quality"] != 1 else "toxic" if r["toxic"] else "good"
        for r in labels.collect() if r["doc_id"] in texts
    }
    assert min(Counter(kind.values()).values()) > 20 and len(kind) < len(texts)
    grams = {d: buckets_by_force(t) for d, t in texts.items()}
    total = {name: Counter() for name in ("raw", "good", "toxic", "poor")}
    for d, found in grams.items():
        total["raw"].update(found)
        if d in kind:
            total[kind[d]].update(found)
    target = log_ratio_by_force(total["good"], total["raw"])
    toxic = {b: max(0.0, x) for b, x in log_ratio_by_force(total["toxic"], total["good"]).items()}

    def weight(found, ratio):
        return 256 * sum(n * ratio.get(b, 0.0) for b, n in found.items()) / (sum(found.values()) + 64)

    weights = {d: (weight(found, target), weight(found, toxic)) for d, found in grams.items()}
    of = lambda name, which: [weights[d][which] for d in kind if kind[d] == name]
    cut = cut_by_force(of("good", 0), of("poor", 0))
    toxic_cut = -cut_by_force([-w for w in of("good", 1)], [-w for w in of("toxic", 1)])
    keys = {d: weights[d][0] + noise_by_force(d, texts[d]) for d in texts}
    rest = [d for d in texts if weights[d][1] <= toxic_cut]
    k = sum(weights[d][0] >= cut for d in rest)
    kept = set(sorted(rest, key=lambda d: -keys[d])[:k])
    assert 0 < k < len(rest) < len(texts)

    model, _ = quality_classifier.fit(docs, labels)
    assert (model.cut, model.toxic_cut) == (pytest.approx(cut, abs=1e-4), pytest.approx(toxic_cut, abs=1e-4))
    got = quality_classifier.classify(docs, labels).collect()
    assert {r["doc_id"] for r in got if r["kept"]} == kept and len(got) == len(texts)
    for r in got:
        assert r["log_weight"] == pytest.approx(weights[r["doc_id"]][0], abs=1e-4)
        assert r["sample_key"] == pytest.approx(keys[r["doc_id"]], abs=1e-4)
    chosen = quality_classifier.select_documents(docs, labels)
    assert {r["doc_id"] for r in chosen.collect()} == kept


def test_documents_tied_at_the_last_key_share_their_fate(spark):
    docs = spark.createDataFrame([(1, "a good word")] * 3 + [(2, "poor poor rows")] * 3, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    judged = quality_classifier.classify(docs, labels).collect()
    assert len(judged) == 6 and len({(r["doc_id"], r["kept"]) for r in judged}) == 2


@pytest.mark.parametrize("k", [1, 17, 5000, 9999, 10_000])
def test_kth_largest(spark, k):
    values = [random.Random(4).gauss(0, 1) for _ in range(1)] + [random.Random(i).gauss(0, 10) for i in range(9000)] + [1.5] * 999
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    assert quality_classifier.kth_largest(df, "v", k, bins=16, few=20) == sorted(values, reverse=True)[k - 1]
