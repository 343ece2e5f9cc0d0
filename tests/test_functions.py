import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from foliant.functions import arrays, documents, scores, text


def value(spark, column, **cells):
    schema = ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'array<int>' if isinstance(v, list) else 'double'}" for k, v in cells.items()) or "x int"
    return spark.createDataFrame([tuple(cells.values()) or (1,)], schema).select(column).first()[0]


@pytest.mark.parametrize(
    ("cell", "expected"),
    [("556", [5, 5, 6]), ("10", [10]), ("5.5", [5.5]), ("5 6 7", [5, 6, 7]), ("5,6,7", [5, 6, 7]), ("5，6", [5, 6]), ("5/6/7", [5, 6, 7]), ("5-6-7", [5, 6, 7]), ("5;6;7", [5, 6, 7]), ("5, 6", [5, 6]), ("0 0 3", [0, 0, 3]), ("", []), (None, [])],
)
def test_score_list(spark, cell, expected):
    assert value(spark, scores.score_list(F.col("c")), c=cell) == expected


def test_score_list_error(spark):
    with pytest.raises(PySparkException):
        value(spark, scores.score_list(F.col("c")), c="5|6")


@pytest.mark.parametrize(("cell", "expected"), [("8: accept", 8), ("10", 10), ("3 fair", 3), ("", 0), (None, 0), ("good", 0), ("Strong Accept: x", 9)])
def test_label_score(spark, cell, expected):
    assert value(spark, scores.label_score(F.col("c"), {"Strong Accept": 9}), c=cell) == expected


def test_score_mean(spark):
    df = spark.createDataFrame([([],), ([0.0, 0.0],), ([5.0, 0.0],)], "a array<double>")
    assert [r[0] for r in df.select(scores.score_mean(F.col("a"))).collect()] == [0.0, 0.0, 2.5]


def test_histogram_bins_equal_numpy(spark):
    values = sorted({s / n for n in range(1, 9) for s in range(10 * n + 1)} | {10.0, 12.0, -1.0})
    got = [r[0] for r in spark.createDataFrame([(float(v),) for v in values], "x double").select(scores.histogram_bin(F.col("x"))).collect()]
    clipped = np.clip(values, 0, 10)
    assert got == [int(np.flatnonzero(np.histogram([v], bins=np.linspace(0, 10, 101))[0])[0]) for v in clipped]


def test_transfer_cell(spark):
    df = spark.createDataFrame([(5.0, 5.5), (10.0, 10.0), (9.0, 0.0), (0.0, 9.9), (3.0, 2.61)], "b double, a double")
    r, c = scores.transfer_cell(F.col("b"), F.col("a"))
    assert [tuple(x) for x in df.select(r, c).collect()] == [(50, 55), (99, 50), (90, 0), (0, 99), (30, 47)]
    assert [x[0] for x in df.select(scores.transfer_clamped(F.col("b"), F.col("a"))).collect()] == [False, True, True, True, False]


@pytest.mark.parametrize(("threshold", "expected"), [(3, "0*4;5;6;0*5;1;0*5;8;9;0;0;0"), (2, "0*4;5;6;0*5;1;0*5;8;9;0*3")])
def test_rle_examples(spark, threshold, expected):
    a = [0, 0, 0, 0, 5, 6, 0, 0, 0, 0, 0, 1, 0, 0, 0, 0, 0, 8, 9, 0, 0, 0]
    assert value(spark, arrays.rle_encode(F.col("a"), threshold), a=a) == expected


def test_rle_round_trip(spark):
    own = random.Random(3)
    rows = [([own.choice([0, 0, 0, 0, 7]) for _ in range(own.randint(0, 40))],) for _ in range(200)]
    df = spark.createDataFrame(rows, "a array<int>")
    assert df.where(arrays.rle_decode(arrays.rle_encode(F.col("a"))) != F.col("a")).count() == 0
    assert value(spark, arrays.reshape(F.col("a"), 2), a=[1, 2, 3, 4]) == [[1, 2], [3, 4]]


@pytest.mark.parametrize(("href", "expected"), [("/b/c.pdf", "https://h.org/b/c.pdf"), ("c.pdf", "https://h.org/x/c.pdf"), ("../c.pdf", "https://h.org/c.pdf"), ("//o.org/c", "https://o.org/c"), ("http://o.org/c", "http://o.org/c"), ("", "https://h.org/x/y.html")])
def test_url_join(spark, href, expected):
    assert value(spark, text.url_join(F.lit("https://h.org/x/y.html"), F.col("h")), h=href) == expected


def test_text_functions(spark):
    assert value(spark, text.title_normalise(F.col("t")), t=" a​ b\n c ") == "a b c"
    assert value(spark, text.conference_id(F.lit("nips"), F.lit(2024), F.col("t")), t="Datasets & Benchmarks") == "nips2024_data"
    assert value(spark, text.conference_id(F.lit("nips"), F.lit(2024), F.col("t")), t="main") == "nips2024"
    assert value(spark, text.forum_id(F.col("u")), u="https://openreview.net/forum?id=abc") == "abc"
    assert value(spark, text.comma_number(F.col("n")), n="1,234") == 1234
    assert value(spark, text.comma_number(F.col("n")), n="x") is None
    assert value(spark, text.status_cleanup(F.col("s")), s="a / oral paper accept") == "oral"
    assert value(spark, text.strip_fence(F.col("s")), s='x ```json\n{"a": 1}\n``` y') == '{"a": 1}'
    assert value(spark, text.first_link(F.col("s"), True), s="see https://a.org/x, https://github.com/a/b.") == "https://github.com/a/b"
    assert value(spark, text.first_link(F.col("s"), False), s="see https://a.org/x, https://github.com/a/b.") == "https://a.org/x"
    assert value(spark, text.first_link(F.col("s"), False), s="none") is None
    assert value(spark, text.semicolon_list(F.col("s")), s=" 0a; b ;;") == ["0a", "b"]
    assert text.rebuttal_column("Initial Ratings") == "[Optional] Ratings after Rebuttal"


def test_maps(spark):
    df = spark.createDataFrame([({"2": "b", "x": "c", "1": "b"},)], "m map<string,string>")
    assert df.select(arrays.integer_keys(F.col("m"))).first()[0] == {2: "b", 1: "b"}
    assert df.select(arrays.key_values(arrays.sorted_map(F.col("m")))).first()[0] == "1:b;2:b;x:c"
    ordered = F.create_map(*[F.lit(x) for x in ("2", "b", "x", "c", "1", "b")])
    assert df.select(arrays.inverted_map(ordered)).first()[0] == {"b": "1", "c": "x"}


@pytest.mark.parametrize(
    ("raw", "expected"),
    [('{"a": 1}', '{"a": 1}'), ('x {"a": 1} y', '{"a": 1}'), ('{{"a": 1}}', '{"a": 1}'), ("{'a': 1}", '{"a": 1}'), ('{"a": [1, 2', '{"a": [1, 2]}'), ('{"a": 1,}', '{"a": 1}'), ("none", None), (None, None), ('{"a": "b\x00c"}', '{"a": "b\\u0000c"}')],
)
def test_repair_json(raw, expected):
    assert documents.repair_json(raw) == expected


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_repair_json_never_fails(raw):
    documents.repair_json(raw)
    documents.call_arguments(raw)


def test_call_arguments():
    assert documents.call_arguments("f(a=1, b='x')") == '{"a": 1, "b": "x"}'
    assert documents.call_arguments("f(a=__import__('os'))") is None


def test_pages():
    p = documents.page("<html lang=en><title>A &amp; B</title><p>one<br>two<script>var x='</p>'</script><h2>S</h2><table><tr><td>1<td>2</tr></table><a href='/x'>link</a>")
    assert ("".join(p.title), p.lang, p.headings) == ("A & B", "en", ["S"])
    assert p.anchors[0][:2] == ("/x", ["link"])
    assert p.tables[0][0] == [["1"], ["2"]] and "var x" not in " ".join(p.text)


def test_affiliations():
    page = "A Great Title\nJane Doe1, John Roe2\n1 University of X, 2 Institute of Y\njane@x.org\nAbstract\nWe ..."
    assert documents.affiliations(page, "Jane Doe; John Roe") == "University of X; Institute of Y"
    assert documents.affiliations("Jane Doe\nUniversity of X\nAbstract", "Jane Doe") == "University of X"
    assert documents.affiliations("", "x") == "" and documents.affiliations(None, None) == ""
    assert documents.affiliations("T\nJ Doe1,2\n1I2R, 23Dwe.ai\n{a, b}@x.org\nAbstract", "J Doe") == "I2R; 3Dwe.ai"
    assert documents.affiliations("T\nJane Doe\n1 3Dwe.ai, 2 Institute of Y\nAbstract", "Jane Doe") == "3Dwe.ai; Institute of Y"


def test_ratio():
    assert documents.ratio("abc", "abc") == 1.0 and documents.ratio("abc", "xyz", 0.5) == 0.0


def test_phrases(spark):
    df = spark.createDataFrame([(" Self - Supervised ( GAN ) ",), (None,), ("",)], "p string")
    assert [r[0] for r in df.select(documents.phrase(F.col("p"))).collect()] == ["self-supervised (gan)", None, ""]
    assert [r[0] for r in df.select(documents.phrase(F.col("p"), str.title)).collect()] == [" Self - Supervised ( Gan ) ", None, ""]


def test_titles_and_texts_of_given_pages(spark, sf_dir):
    """Against the whole parser, page by page in plain Python."""
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").select("html", documents.page_title("html").alias("short"), documents.parse_page("html").alias("p")).collect()
    assert len(rows) > 20
    for r in rows:
        plain = documents.page(r.html)
        assert r.short == r.p.title == " ".join(" ".join(plain.title).split())
        assert r.p.text == " ".join(" ".join(plain.text).split()) and len(r.p.anchors) == len(plain.anchors)


def test_written_titles_equal_their_sql(spark, tmp_path):
    """Cut and other references stay as they are; titles with attributes, in capitals or with tags are none."""
    from oracle import connect, rows

    from foliant import catalog

    titles = ["a &amp;&amp", "x &quot;y&quot; &#39;", "&amp;lt; &lt;b&gt;", " \t a\u00a0\n\x0b b ", "", "a<b>c</b>"]
    pages = [(i, "u", f"<html><title>{x}</title><title>second</title>") for i, x in enumerate(titles)]
    pages += [(10, "u", None), (11, "u", ""), (12, "u", "<TITLE>a</TITLE>"), (13, "u", '<title lang="en">a</title>'), (14, "u", "<title>open")]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = connect("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    expected = con.execute(catalog.oracle_sql()["html_title"]).fetchall()
    assert rows(catalog.queries()["html_title"](spark, str(tmp_path)), ["page_id", "title"]) == sorted(expected, key=repr)


def test_similarity_equals_the_standard_library(spark, sf_dir):
    from difflib import SequenceMatcher

    rows = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_name", "p_type", documents.similarity(F.col("p_name"), F.col("p_type")).alias("s")).collect()
    assert all(r.s == SequenceMatcher(None, r.p_type, r.p_name).ratio() for r in rows) and len(rows) > 100


def test_notes_of_odd_json(spark):
    from foliant.plans import variant_notes as V

    lines = ["{}", "not json", '{"content": 3}', '{"id": 7, "content": {"title": {"value": null}, "keywords": []}}', '{"id":"x","content":{"title":["t"]},"details":{"directReplies":[{"content":{"decision":"Yes"}},{"invitations":["A/Decision"],"content":{"decision":"No"}},{"invitation":"Decision","content":7}]}}', None]
    rows = V.papers(V.parsed(spark.createDataFrame([(x,) for x in lines], "value string")), "reply").collect()
    assert [(r.id, r.status, r.n_reviews, r.keywords) for r in rows] == [(None, "", 0, ""), (None, "", 0, ""), (None, "", 0, ""), ("7", "", 0, ""), ("x", "No", 0, ""), (None, "", 0, "")]
    schema = V.merged_schema(V.parsed(spark.createDataFrame([("a", '{"x": 1}'), ("a", '{"y": "z"}')], "g string, value string")), "g").first()
    assert "x: BIGINT" in schema.schema and "y: STRING" in schema.schema


def test_checks_name_the_groups_of_violations(spark):
    from foliant.operators.checks import checked

    df = spark.createDataFrame([("a", 1), ("b", 11), ("c", None), ("d", 12)], "g string, v int")
    job = checked(df, {"small": F.col("v") < 10, "any": F.lit(True)}, F.col("g"))
    assert job.frame.count() == 4
    assert job.report() == [("small", 4, 3, "b", "d"), ("any", 4, 0, None, None)]
    empty = checked(df.limit(0), {"small": F.col("v") < 10})
    empty.frame.collect()
    assert empty.report() == [("small", 0, 0, None, None)]


def test_pages_are_parsed_in_slices(monkeypatch):
    import pandas as pd

    from foliant.functions import documents

    monkeypatch.setattr(documents, "PARSED_PAGES", 3)
    monkeypatch.setattr(documents, "PARSED_CHARS", 100)
    html = pd.Series(["<title>a</title>", None, "x" * 150, "<p>b", "<p>c", "<p>d", "<p>e"])
    parts = list(documents.parsed_slices(iter([html, pd.Series([None], dtype=object)])))
    assert max(map(len, parts)) <= 3 and [t for p in parts for t in p["text"]] == ["", "", "x" * 150, "b", "c", "d", "e", ""]
