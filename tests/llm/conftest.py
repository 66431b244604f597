import pytest

LONG = "lorem ipsum dolor " * 40_000  # 720 kB in one line
WORDS = [f"w{i}" for i in range(4000)]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, clashing extra columns."""
    base = " ".join(WORDS[:300])
    rows = [
        (1, "A first line of text\nshared line of many\nend one", "en", "s1", 10),
        (2, "shared line of many  \nanother line here\n\nshort", "en", "s1", 11),
        (3, None, "en", "s2", None), (4, "", None, None, 0), (5, "   \t\n \n", "de", "s2", 4),
        (6, base, "en", "s1", 1), (7, base.upper(), "en", "s2", 1), (8, base + " tail", "fr", None, 1),
        (9, LONG, "en", "s3", len(LONG)), (9, LONG, "en", "s3", len(LONG)),
        (10, "one two", "de", "s3", 7), (11, "one  two", "de", "s3", 8), (11, "three four five six seven", "de", "s3", 8),
        (None, "A first line of text\nno id", "en", "s1", 3), (None, None, None, None, None),
        (12, "\u2014 \u2014 123", "en", "s1", 9), (13, "\u65e5\u672c\u8a9e" * 50, "en", "s1", 150),
    ]
    names = ["size", "score", "rule", "kept", "n_hit", "n_lines", "digest", "component_id", "n_tokens", "lang_pred", "taken", "bucket"]
    cols = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([r + ("x",) * len(names) for r in rows], cols)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
