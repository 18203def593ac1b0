import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """A documents table from (doc_id, text[, lang[, source]]) rows."""
    def make(rows, extra=None):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, *("en", "src0")[len(row) - 2:])[:4]
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        df = spark.createDataFrame(full, DOC_SCHEMA)
        return df.selectExpr("*", *extra) if extra else df
    return make


# Names that the operators use themselves, as columns of the input.
CLASHES = ["'x' AS fp", "1 AS root", "2 AS part", "'y' AS key", "3 AS bucket", "'z' AS spans", "4 AS size",
           "5 AS rank", "6 AS score", "7 AS piece", "8 AS position", "'w' AS component_id", "9 AS length"]


@pytest.fixture
def clashes():
    return CLASHES


# Null and empty texts, ties, repeated rows, null ids, a very long text.
@pytest.fixture
def odd_rows():
    return [(1, None, None, None), (2, "", "en", "a"), (3, "   \n\t ", "en", "a"), (4, "one", "de", "b"),
            (5, "one two three four five six seven eight nine ten eleven", "en", "a"),
            (5, "one two three four five six seven eight nine ten eleven", "en", "a"),
            (None, "one two three four five six seven eight nine ten eleven", "en", None),
            (None, None, "en", "a"), (7, "word " * 30_000, "en", "b"), (8, "ünï 日本 😀 " * 40, "fr", "a"),
            (9, "x" * 50_000, None, "b")]


# Names that operators use for columns of their own, and the struct that carries foreign ones.
HIDDEN = ["'x' AS __size", "1 AS __part", "2 AS __key", "'y' AS __visits", "3 AS __h", "'z' AS __id", "4 AS __hash", "5 AS __redacted",
          "'v' AS __visit", "6 AS __s", "7 AS __n", "'u' AS __row", "8 AS rest", "9 AS predicted", "'t' AS redacted", "'s' AS `a b.c`",
          "'r' AS row", "10 AS f0"]


@pytest.fixture
def hidden():
    return HIDDEN
