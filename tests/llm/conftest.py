import re

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("n_words", T.StringType()), T.StructField("spans", T.StringType())])


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents of (id, text[, lang[, source]]), with two extra columns whose names operators use themselves."""

    def make(*rows):
        full = [(*r, *[None] * (4 - len(r)), None, "clash", "clash") for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls everywhere, empty, blank and very long texts, ties, repeated rows and repeated ids."""
    long = "lorem ipsum dolor " * 30_000
    return make_docs((1, None), (2, ""), (3, " \t\n"), (4, "one two three"), (4, "one two three"), (4, "another text here now"), (None, "one two three"), (None, None), (5, "x" * 200_000), (6, long), (7, "á́ 中文 \0   😀"), (8, "One TWO three", "en", "s"))
