import zlib

import pytest
from oracle import check, connect
from tokenizers import Tokenizer

import corpus_pipeline
from foliant.llm import queries

SQL = queries.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, sf_dir, con, name):
    check(spark, sf_dir, con, queries.queries()[name], SQL[name])


def test_all_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.queries() if k.startswith("op")) == list(range(1, 14))


def brute_pipeline(rows, items):
    """What run() gives for documents (doc_id, text, lang, source), in plain Python but for the mixture's own SQL."""
    import re
    import struct
    import zlib

    import duckdb
    import pandas as pd
    from test_llm_operators import BYTE_BPE, LETTERS, brute_components, plain_languages, words

    found = plain_languages([r[:3] for r in rows])
    rows = [(r[0], r[1], lang, *r[3:]) for r, lang in zip(rows, found, strict=True) if lang is not None]
    comp = brute_components([(i, r[1]) for i, r in enumerate(rows)], 5, 80, 100)
    best = {}
    for i, r in enumerate(rows):
        key = (r[0] is None, r[0] or 0, i)
        best[comp[i][1]] = min(best.get(comp[i][1], key), key)
    rows = [rows[i] for i in sorted(k[2] for k in best.values())]

    windows = set()
    for _, text in items:
        w = words(text, LETTERS)
        windows |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12) if w else 0)}
    kept = []
    for doc_id, text, *rest in rows:
        w, at, hit = words(text, LETTERS), [m.span() for m in re.finditer(LETTERS, text)], set()
        for m in {len(k) for k in windows}:
            for i in range(len(w) - m + 1):
                if tuple(w[i : i + m]) in windows:
                    hit |= set(range(i, i + m))
        if hit and 20 * len(hit) >= len(w):
            continue
        # A run of hit words goes from its first character to its last.
        out, i = [], 0
        for k in sorted(hit):
            if k - 1 not in hit:
                out.append(text[i : at[k][0]])
            i = at[k][1]
        kept.append((doc_id, "".join(out) + text[i:], *rest))

    con = duckdb.connect()
    remaining = pd.DataFrame(kept, columns=["doc_id", "text", "lang", "source"]).astype({"doc_id": "Int64"})  # noqa: F841
    con.execute("CREATE TABLE documents AS SELECT row_number() OVER () AS place, * FROM remaining")
    sql = SQL["op3_mixture"].replace("SELECT doc_id, coalesce(source", "SELECT place, doc_id, coalesce(source", 1).replace("SELECT doc_id, source, lang, topic, doc.tokens", "SELECT place, doc_id, source, lang, topic, doc.tokens", 1)
    sampled = {place for place, ok in con.execute(f"SELECT place, sampled FROM ({sql})").fetchall() if ok}
    library, expected, start = Tokenizer.from_file(BYTE_BPE), [], 0
    for _, (doc_id, text, *_) in sorted(((i, r) for i, r in enumerate(kept, 1) if i in sampled), key=lambda x: (x[1][0] is not None, x[1][0] or 0)):
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        expected.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return expected


def test_pipeline_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    expected = brute_pipeline(rows, items)
    assert len(expected) > 50 and sorted(tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect()) == sorted(expected)


def test_pipeline_on_odd_documents_equals_brute_force(spark, make_docs, odd_docs, tmp_path):
    """Repeated and missing ids, texts without words, near copies under one id, benchmark passages cut or dropped."""
    passage = " ".join(f"bench{i}" for i in range(15))
    filler = " ".join(f"Fill{i}" for i in range(400))
    more = make_docs((20, filler + " " + passage + ", end " + passage + "."), (20, "short " + passage), (None, "None " + passage), (None, "x " * 30 + "no id"), (21, "x " * 30 + "no id"), (22, "a b c d e f g h"), (22, "a b c d e f g h"), (22, "one other text under this id"), (23, "123 456"), (24, None, "en", None), (25, "some more words here", None, "s"), *((200 + i, " ".join(f"plain{i}x{j}" for j in range(30)), "en", "s") for i in range(40)))
    docs = odd_docs.union(more)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items = [("1", passage), ("2", None), ("3", "")]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    expected = brute_pipeline([(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()], items)
    got = corpus_pipeline.run(spark, f"file://{tmp_path}")
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and len(expected) >= 3
    by_row = lambda rows: sorted(((i, n, c) for i, _, n, c in rows), key=str)
    assert by_row(got.collect()) == by_row(expected)


def test_the_language_stage_uses_its_prediction(spark, make_docs):
    """Missing and wrong languages become what the text says."""
    german, english = "der schnelle braune Fuchs springt über den faulen Hund", "the quick brown fox jumps over the lazy dog"
    rows = [(i, f"{german if i % 2 else english} {'abc'[i % 3]}", "de" if i % 2 else "en") for i in range(40)]
    one, two, three, four = [i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 3 == 1][:4]  # not learned from
    docs = make_docs(*rows, (one, german, None), (two, english, "de"), (three, german, "xx"), (four, "123", "en"))
    got = {r.doc_id: r.lang for r in corpus_pipeline.identify_language(spark, docs, "").collect()}
    assert got == {i: lang for i, _, lang in rows} | {one: "de", two: "en", three: "de"}


def test_stages_keep_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, docs.limit(0), sf_dir)
        assert empty.columns == docs.columns and empty.count() == 0, name
