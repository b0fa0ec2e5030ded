import pytest

LONG = " ".join(f"word{i % 997} of the long text" for i in range(60_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with NULLs, empty and long texts, repeated rows, one id with two texts, and columns whose names the
    operators use inside."""
    base = "The quick brown fox jumps over the lazy dog and runs into the wide open field"
    rows = [
        (0, base, "en", "a"), (1, base, "en", "a"), (1, base, "en", "a"), (2, base + " today", "en", None),
        (3, None, None, None), (None, base, "en", "b"), (None, None, None, None), (4, "", "en", "b"),
        (5, " \n\t ", "en", "b"), (6, LONG, "en", "a"), (7, "Released under the MIT License.\n" + base, None, "c"),
        (7, "another text under the same id", "en", "c"), (8, "é中\U0001f600 <|endoftext|> </s> a\x00b", "fr", "c"),
    ]
    rows = [(*r, None if r[1] is None else len(r[1]), "x", 1, "y", 2, "z", 3) for r in rows]
    names = "doc_id long, text string, lang string, source string, n_chars long, key string, h long, _document string, " \
            "_bitmap long, _key string, fp long"
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
