import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import collocations as c
from tidewell.llm import word_hashes

SMALL = {"ranks": 6, "tile": 2, "dense": 2, "held": 50}


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def mined(rows, min_count, longest=5, top=2000, absorb=100):
    """Plain Python over (lang, text)."""
    n, f = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", lower(text)):
            words = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                f.update((lang or "und", tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    frequent = {k: v for k, v in f.items() if v >= min_count}
    out = defaultdict(list)
    for (lang, p), a in frequent.items():
        if len(p) == 1:
            continue
        inside = [v for (g, q), v in frequent.items() if g == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if any(100 * v >= absorb * a for v in inside):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        best, k = min(cuts)
        out[lang].append((-best, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n[lang], -s)
        for lang, some in out.items() for rank, (s, a, p, left, right) in enumerate(sorted(some)[:top], 1)
    )


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def some_text(seed, words, size):
    random.seed(seed)
    common = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    text = random.choices(common, weights, k=size)
    return "".join(w + random.choices([" ", "  ", "\t", ", ", ". ", "\n", "-"], [30, 2, 2, 1, 1, 1, 1])[0] for w in text)


@pytest.mark.parametrize("sizes", [{}, SMALL, SMALL | {"dense": 0}, SMALL | {"ranks": 1, "tile": 1}, {"ranks": 64, "tile": 64, "dense": 1, "held": 7}])
def test_equals_plain_counting(spark, sizes):
    rows = [(("en", "de", None)[i % 3], some_text(i, 12, 300)) for i in range(9)] + [("en", "Many many MANY many many many " * 5)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    for min_count, longest, top, absorb in ((4, 5, 2000, 100), (15, 3, 7, 60)):
        found = rows_of(c.collocations(docs, min_count, longest, top, absorb, **sizes))
        assert found == mined(rows, min_count, longest, top, absorb) and found


def test_phrases_over_the_seams_of_long_texts(spark, monkeypatch):
    text = some_text(3, 6, 400)
    langs = np.array([5], dtype=np.uint64)
    for size in (16, 40, 64, 1000):
        monkeypatch.setattr(c, "pieces", lambda texts, s=size: word_hashes.pieces(texts, s))
        for k in range(1, 6):
            seen = Counter()
            for value, piece, _, _, carried in c.numbers([text], langs, k - 1):
                for s in range(max(0, carried - k + 1), len(value) - k + 1):
                    if piece[s] == piece[s + k - 1]:
                        seen[tuple(value[s : s + k].tolist())] += 1
            plain = Counter(
                tuple(words[i : i + k]) for p in re.split("[.,;:!?\n-\r]", lower(text)) for words in [re.findall("[^ \t]+", p)]
                for i in range(len(words) - k + 1)
            )
            assert sorted(seen.values()) == sorted(plain.values())


def test_odd_documents(odd_docs):
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    assert rows_of(c.collocations(odd_docs, 2)) == mined(rows, 2)


def test_no_documents_and_no_phrases(no_docs, spark):
    assert c.collocations(no_docs).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert not c.collocations(no_docs).collect()
    assert not c.collocations(spark.createDataFrame([("en", "a, b. c")], "lang string, text string"), 1).collect()


def test_scores_are_exact_beyond_64_bits(spark):
    random.seed(1)
    rows = []
    for _ in range(200):
        left, right = (random.randrange(100, 10 ** random.randint(3, 15)) for _ in range(2))
        a = random.randrange(100, min(left, right) + 1)
        rows.append((a, random.randrange(max(left, right), 10**16), left, right))
    found = spark.createDataFrame(rows, "a long, n long, l long, r long").select("*", c.score(*map(F.col, "anlr")).alias("s"))
    assert dict(found.dtypes)["s"] == "bigint"
    for a, n, left, right, s in found.collect():
        assert s == 1000 * a * n // (left * right)


def test_words_that_share_a_number_are_counted_apart(spark):
    rows = [(1, "en", "one", 2), (1, "en", "one", 3), (2, "en", "two", 1), (2, "de", "two", 4), (2, "en", "too", 1), (2, "de", "two", 2)]
    found = c.summed(spark.createDataFrame(rows, "w long, lang string, word string, n long"))
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted(map(tuple, found.collect())) == [(1, "en", "one", 5, 0), (2, "de", "two", 6, 8), (2, "en", "too", 1, 8), (2, "en", "two", 1, 8)]


def test_frequent_words_that_share_a_number_are_numbered_anew(spark, monkeypatch):
    rows = [(("en", None)[i % 2], some_text(i, 12, 300)) for i in range(6)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    count_words, seeds = c.count_words, []

    def shared_until(last, n):
        def counted(docs, held, seed):
            seeds.append(seed)
            return count_words(docs, held, seed).withColumn("shared", F.lit(n if seed < last else 0))

        return counted

    # A rare shared number is no part of a frequent phrase, so the first seed stays.
    for last, n, wanted in ((2, 5, [0, 1, 2]), (2, 4, [0])):
        seeds.clear()
        monkeypatch.setattr(c, "count_words", shared_until(last, n))
        assert rows_of(c.collocations(docs, 5, **SMALL)) == mined(rows, 5) != []
        assert seeds == wanted
    monkeypatch.setattr(c, "count_words", shared_until(c.SEEDS, 5))
    with pytest.raises(ValueError, match="share a number"):
        c.collocations(docs, 5)


def test_seeds_give_other_numbers_to_the_same_words():
    texts, first = ["one two two Three"], None
    for seed in range(c.SEEDS):
        (value, *_), = c.numbers(texts, np.array([c.lang_number("en", seed)], dtype=np.uint64), 0, seed)
        assert value[1] == value[2] and len(set(value.tolist())) == 3
        first = set(value.tolist()) if first is None else first
        assert seed == 0 or not first & set(value.tolist())


def test_tiles_count_like_a_dictionary():
    rng = np.random.default_rng(0)
    for ranks, tile, dense, held in ((7, 3, 2, 10), (16, 4, 100, 8), (5, 8, 1, 3)):
        tiles, seen, wanted = c.Tiles(ranks, tile, dense, held), Counter(), Counter()
        for _ in range(40):
            a, b = (rng.integers(0, ranks, 9) ** 2 // ranks for _ in range(2))
            wanted.update(zip(a.tolist(), b.tolist()))
            for codes, n in tiles.add(a, b):
                for code, m in zip(codes.tolist(), n.tolist()):
                    seen[divmod(code, ranks)] += m
        for codes, n in tiles.rest():
            for code, m in zip(codes.tolist(), n.tolist()):
                seen[divmod(code, ranks)] += m
        assert seen == wanted and len(tiles.dense) <= dense


def test_phrases_of_one_digest_stay_apart(monkeypatch):
    monkeypatch.setattr(c, "phrase_numbers", lambda words: words[:, 0] % np.uint64(2))
    words = np.array([[1, 2], [3, 2], [1, 2], [2, 9], [4, 9], [3, 2]], dtype=np.uint64)
    found, n = c.added_rows(words, np.array([1, 2, 3, 4, 5, 6]))
    assert dict(zip(map(tuple, found.tolist()), n.tolist())) == {(1, 2): 4, (3, 2): 8, (2, 9): 4, (4, 9): 5}
