import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from foliant import schema, sinks, specs
from foliant.operators import aggregates as A
from foliant.operators import filters as P
from foliant.operators import fuzzy
from foliant.operators import joins as J
from foliant.operators import rows as R
from foliant.plans import extraction, forms, notes, venue
from foliant.sources import files, pages, pdf, rest
from foliant.streaming import incremental


def collected(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_topk_ties_and_modes(spark):
    df = spark.createDataFrame([(1, "Poster", ["b", "a", "b"]), (2, "Oral", ["a", "c"]), (3, "Reject", ["z"])], "row_ix bigint, status string, items array<string>")
    top = A.topk(df, F.col("items"), ["Poster", "Oral"])
    assert [(r["name"], r.total, r.c0, r.c1) for r in top.collect()] == [("b", 2, 2, 0), ("a", 2, 1, 1), ("c", 1, 0, 1)]
    assert A.topk_string(top, 2).first()[0] == "b:2:2,0;a:2:1,1;c:1:0,1"
    assert [r["name"] for r in A.topk(df, F.col("items"), ["Poster", "Oral"], mode="last").collect()] == ["b", "c"]
    assert A.topk(df.limit(0), F.col("items"), ["Poster"]).count() == 0


def test_topk_authors_skip_uneven_lists(spark):
    df = spark.createDataFrame([(1, "Oral", ["A B", "C"], ["~A1", ""]), (2, "Oral", ["A. B"], ["~A1"]), (3, "Oral", ["X", "Y"], ["~X1"]), (4, "Oral", ["C"], [])], "row_ix bigint, status string, n array<string>, i array<string>")
    got = [(r["name"], r.author_id, r.total) for r in A.topk_authors(df, F.col("n"), F.col("i"), ["Oral"]).collect()]
    assert got == [("A B", "~A1", 2), ("C", "", 2)]


def test_accepted_list_precedence(spark):
    df = spark.createDataFrame([("1", ""), ("2", "Oral"), ("3", ""), ("a-1", "Oral")], "id string, status string")
    acc = spark.createDataFrame([("1",), ("2",)], "id string")
    assert collected(P.accepted_list_status(df, acc), "id", "status") == [("1", "Poster"), ("2", "Poster"), ("3", "Reject"), ("a-1", "Unknown")]


def test_range_guard_raises(spark):
    df = spark.createDataFrame([(3.0,), (7.0,)], "avg double")
    assert P.range_guard(df, "avg", 5).count() == 1
    with pytest.raises(PySparkException):
        P.range_guard(df, "avg", 5, "raise").collect()


def test_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert P.add_column(df, "c", before="b").columns == ["a", "c", "b"]
    assert P.move_column(df, "b", "a").columns == ["b", "a"]
    assert P.id_first(df, "b").columns == ["b", "a"]


def titles(spark, rows):
    return spark.createDataFrame(rows, "block string, ix bigint, title string")


def test_fuzzy_is_one_to_one(spark):
    left = titles(spark, [("x", 1, "deep learning for cats"), ("x", 2, "deep learning for cats"), ("x", 3, "graph neural networks"), ("y", 4, "deep learning for cats"), ("x", 5, None)])
    right = titles(spark, [("x", 11, "deep learning for cats"), ("x", 12, "deep learning for cat"), ("x", 13, "graph neural network"), ("x", 14, "unrelated")])
    got = collected(fuzzy.fuzzy_match(left, right), "left_ix", "right_ix")
    assert got == [(1, 11), (2, 12), (3, 13)]


def test_exact_match_pairs_by_rank(spark):
    left = titles(spark, [("x", 1, "a"), ("x", 2, "a"), ("x", 3, ""), (None, 4, "a"), ("x", 5, None), ("y", 6, "a")])
    right = titles(spark, [("x", 12, "a"), ("x", 11, "a"), ("x", 13, "a"), ("x", 14, ""), (None, 15, "a"), ("x", 16, None)])
    # Blank titles match nothing.
    assert collected(fuzzy.exact_match(left, right), "left_ix", "right_ix") == [(1, 11), (2, 12)]
    assert collected(fuzzy.fuzzy_match(left, right), "left_ix", "right_ix") == [(1, 11), (2, 12)]


@pytest.mark.parametrize(("seed", "options"), [(4, {}), (5, {"tile": 5, "finish": 0, "bands": (0.95, 0.9, 0.8)}), (6, {"finish": 0, "bands": ()}), (7, {"tile": 3, "finish": 40})])
def test_fuzzy_equals_plain_greedy(spark, monkeypatch, seed, options):
    """Against a plain loop over the levels, left rows in order, each taking its best unused candidate; also in small tiles,
    to the end in rounds, and, where a round settles little, by components."""
    import random

    from foliant.functions.documents import ratio

    own = random.Random(seed)
    if seed == 6:
        monkeypatch.setattr(fuzzy, "LITTLE", 0.9)
    words = ["deep", "learning", "graph", "for", "cats", "net", "nets"]
    left, right = ([(own.choice("xy"), i, " ".join(own.choice(words) for _ in range(own.randint(1, 4)))) for i in range(k, k + 40)] for k in (0, 100))
    expected, used_left, used_right = [], set(), set()
    for title in sorted({t for _, _, t in left}):
        for block in "xy":
            pairs = list(zip([i for b, i, t in left if (b, t) == (block, title)], [i for b, i, t in right if (b, t) == (block, title)], strict=False))
            expected += pairs
            used_left |= {i for i, _ in pairs}
            used_right |= {j for _, j in pairs}
    for cut in range(100, 70, -1):
        for b, i, t in left:
            found = [(ratio(t, u, 0.71), u, j) for c, j, u in right if c == b and j not in used_right]
            found = [f for f in found if f[0] >= cut / 100]
            if i not in used_left and found:
                _, _, j = max(found, key=lambda f: (f[0], f[1], -f[2]))
                expected.append((i, j))
                used_left.add(i)
                used_right.add(j)
    assert collected(fuzzy.fuzzy_match(titles(spark, left), titles(spark, right), **options), "left_ix", "right_ix") == sorted(expected)


def test_band_links_stand_for_all_pairs(spark):
    """Rows grow with titles and the pairs behind them are those of the plain join; equal lengths are one class."""
    import random

    own = random.Random(3)
    left, right = ([(own.choice(["x", "y", None]), k + i, own.choice([None, "", "ä" * own.randint(1, 40)])) for i in range(200)] for k in (0, 1000))
    got = {r.ix: r for r in fuzzy.band_links(titles(spark, left), titles(spark, right)).collect()}
    assert len(got) == 400
    for one, two in ((left, right), (right, left)):
        for b, i, t in one:
            band = [len(u) for c, _, u in two if b and c == b and t is not None and u is not None and min(len(t), len(u)) * 2 >= 0.71 * (len(t) + len(u))]
            same = [j for c, j, u in one if b and c == b and t is not None and u is not None and len(u) == len(t)]
            assert tuple(got[i])[2:] == (min(same, default=None), len(band), min(band, default=None), max(band, default=None))
    pairs = fuzzy.length_band(titles(spark, left), titles(spark, right)).count()
    assert pairs == sum(got[i].n_links for _, i, _ in left) == sum(got[j].n_links for _, j, _ in right) > 400


def test_tile_bound_keeps_every_similar_pair():
    import random

    from foliant.functions.documents import ratio

    own = random.Random(2)
    word = lambda: "".join(own.choice("abcdeé中") for _ in range(own.randint(1, 5)))
    left, right = ([" ".join(word() for _ in range(own.randint(1, 5))) for _ in range(60)] for _ in "lr")
    for least in (0.5, 0.71, 0.9):
        found = {(i, j) for a, b in fuzzy.candidates(left, right, least) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
        similar = {(i, j) for i, x in enumerate(left) for j, y in enumerate(right) if ratio(x, y) >= least}
        assert similar <= found and len(found) < len(left) * len(right)


def test_common_subsequences():
    import random

    import numpy as np

    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for k, y in enumerate(b):
                new.append(row[k] + 1 if x == y else max(row[k + 1], new[-1]))
            row = new
        return row[-1]

    own = random.Random(3)
    left, right = (["".join(own.choice("abcde é") for _ in range(own.choice((0, 1, 9, 63, 64, 65, 128, 140)))) for _ in range(40)] for _ in "lr")
    i, j = (x.ravel() for x in np.meshgrid(np.arange(40), np.arange(40)))
    keep = np.array([bool(left[x]) for x in i])
    i, j = i[keep], j[keep]
    assert fuzzy.common_subsequences(left, right, i, j).tolist() == [plain(left[x], right[y]) for x, y in zip(i, j, strict=True)]


def test_bounds_of_a_tile_are_small():
    """Counts of a tile's pairs are held a byte each, a piece at a time."""
    import random
    import tracemalloc

    own = random.Random(2)
    left, right = (["".join(own.choice("0123456789abcdef") for _ in range(32)) for _ in range(1024)] for _ in range(2))
    tracemalloc.start()
    try:
        assert sum(len(i) for i, _ in fuzzy.candidates(left, right, 0.95)) == 0
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 8 << 20


def test_a_hot_block_is_many_tiles(spark):
    """Rows that meet grow with the tiles, not with pairs of rows, and no group is larger than a tile."""
    left = titles(spark, [("x", i, f"title number {i:05d}") for i in range(2000)])
    right = titles(spark, [("x", i, f"another name {i:05d}") for i in range(2000)])
    pairs = fuzzy.scored_pairs(left, right, 0.95, tile=256)
    assert pairs.count() == 0
    plan = pairs._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_fuzzy_of_odd_tables(spark):
    empty = titles(spark, [])
    left = titles(spark, [("x", 1, "  "), ("x", 2, ""), (None, 3, "a title"), ("x", 4, None), ("x", 5, "long " * 3000), ("x", 6, "a title")])
    assert fuzzy.fuzzy_match(left, empty).count() == fuzzy.fuzzy_match(empty, left).count() == 0
    more = left.withColumns({"score": F.lit(1), "b": F.lit("clash"), "n": F.lit(0)})
    assert collected(fuzzy.fuzzy_match(more, left), "left_ix", "right_ix") == [(5, 5), (6, 6)]


def test_tables_between_steps_are_deleted(spark, tmp_path, monkeypatch):
    """What stays in the shared folder is the result and the last leftovers; a user's own tables stay, too."""
    import os

    from foliant import storage

    left = titles(spark, [("x", i, f"title number {i}") for i in range(30)])
    left.write.parquet(f"{tmp_path}/own")
    own = spark.read.parquet(f"file://{tmp_path}/own")
    monkeypatch.setattr(storage, "shared_root", lambda _: f"file://{tmp_path}/shared")
    got = fuzzy.fuzzy_match(own, own.withColumn("title", F.concat("title", F.lit("!"))), finish=0)
    assert got.count() == 30
    kinds = [f.split("-")[0] for f in os.listdir(tmp_path / "shared")]
    assert kinds.count("matches") == 1 and not {"pairs", "open", "matched"} & set(kinds), kinds
    storage.discard(own)
    assert own.count() == 30


def test_connected(spark):
    import random

    from foliant.operators.components import connected

    own = random.Random(1)
    links = [(own.randrange(80), own.randrange(80)) for _ in range(55)] + [(200 + i, 201 + i) for i in range(40)]
    parent = {x: x for pair in links for x in pair}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = connected(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.label for r in got} == {x: find(x) for x in parent} and len(got) == len(parent)


def test_levels_and_lookup(spark):
    m = spark.createDataFrame([("x", 100), ("x", 71), ("y", 95)], "block string, level int")
    assert [tuple(r) for r in fuzzy.match_levels(m).collect()] == [(100, 1), (95, 1), (71, 1)]
    assert collected(fuzzy.lowest_level(m), "block", "n", "lowest", "warn") == [("x", 2, 71, True), ("y", 1, 95, False)]
    hits = spark.createDataFrame([(1, 0, "Deep nets"), (1, 1, "DEEP NET"), (1, 2, "deep net"), (2, 0, "zzz")], "ix long, hit_ix int, hit_title string")
    got = fuzzy.lookup_title(titles(spark, [("x", 1, "Deep Net"), ("x", 2, "abc"), ("x", 3, "none")]), hits, 0.5)
    assert collected(got, "ix", "hit_ix", "confidence") == [(1, 1, 1.0)]


def test_form_lengths_have_to_match(spark):
    from foliant.plans import forms
    from foliant.specs import form_spec

    sheet = spark.createDataFrame([(1, "3;4", "1;2", "5;5"), (2, "3;4", "1", "5")], "row_ix bigint, a string, b string, c string")
    for venue, year, bad in (("kdd", 2025, True), ("uai", 2024, True), ("aaai", 2026, True), ("icml", 2024, True), ("icml", 2025, False), ("cvpr", 2025, False)):
        out = forms.responses(sheet, form_spec(venue, year, {"rating": "a", "confidence": "b", "novelty": "c"}))
        if bad:
            with pytest.raises(PySparkException):
                out.collect()
            assert forms.responses(sheet.where("row_ix = 1"), form_spec(venue, year, {"rating": "a", "confidence": "b", "novelty": "c"})).count() == 1
        else:
            assert out.count() == 2


def test_upsert_after_a_broken_merge(spark, tmp_path):
    """The old table stands aside if a merge broke off between its renames; the next merge takes it up."""
    import os

    path = f"{tmp_path}/t"
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    sinks.save_upsert(rows, path, "k")
    os.rename(path, path + ".old")
    got = sinks.save_upsert(spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int"), path, "k")
    assert collected(got, "k", "v") == [("a", 1), ("b", 3), ("c", 4)] and not os.path.exists(path + ".old")


def test_leftovers_and_coalesce(spark):
    site = spark.createDataFrame([(1, "https://openreview.net/forum?id=a", "T1", "", "s1"), (2, "", "T2", "Oral", "s2")], "row_ix bigint, openreview string, title string, status string, site string")
    platform = spark.createDataFrame([(1, "a", "T one", "Poster"), (2, "b", "T3", "")], "row_ix bigint, id string, title string, status string")
    m = J.by_forum(site, platform)
    assert collected(m, "left_ix", "right_ix") == [(1, 1)]
    merged = J.coalesced(m, site, platform, site_only=("site",))
    assert merged.select("id", "title", "status", "site", "title_site").first() == ("a", "T one", "Poster", "s1", "T1")
    out = J.with_leftovers(merged, J.leftovers(site, m, "left_ix"), J.leftovers(platform, m, "right_ix"))
    assert out.count() == 3 and out.where("id like 'site_%'").count() == 1


def test_meta_lookup_raises(spark):
    stats, meta = spark.createDataFrame([("a",), ("b",)], "conference string"), spark.createDataFrame([("a", 1)], "conference string, total int")
    with pytest.raises(PySparkException):
        J.meta_lookup(stats, meta).collect()
    assert J.merge_rule("site", "openreview") == "openreview" and J.merge_rule("form", "site") is None


def test_interval_and_snapshot(spark):
    e = spark.createDataFrame([("a", "", "2020", "X", 0), ("a", "2019", "", "Y", 1), ("b", "x", "2000", "Z", 0)], "k string, start string, end string, value string, ord int")
    p = spark.createDataFrame([("a", 2019), ("a", 2018), ("b", 2010)], "k string, at int")
    assert sorted(map(tuple, J.at_date(e, p, on="k", now=2025).collect()), key=str) == [("a", 2018, "X"), ("a", 2019, "Y"), ("b", 2010, None)]
    now = spark.createDataFrame([("p", 1, 6.0), ("p", 2, 9.0), ("q", 3, 5.0)], "id string, row_ix int, avg double")
    old = spark.createDataFrame([("p", 1, 4.0)], "id string, row_ix int, avg double")
    assert collected(J.snapshot_pairs(now, old), "id", "before", "avg") == [("p", 4.0, 6.0)]


def test_keep_best_and_upsert(spark):
    df = spark.createDataFrame([(1, "a long enough title", 5.0), (2, "A long enough title", 7.0), (3, "a long enough TITLE", 7.0), (4, "short", 1.0), (5, "short", 2.0)], "row_ix bigint, title string, avg double")
    assert collected(R.keep_best(df, F.lower("title"), "avg"), "row_ix") == [(2,), (4,), (5,)]
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), spark.createDataFrame([(2, "z"), (3, "w")], "k int, v string")
    once = R.upsert(a, b, "k")
    assert collected(once, "k", "v") == [(1, "x"), (2, "z"), (3, "w")] == collected(R.upsert(once, b, "k"), "k", "v")


def test_transfer_strings_match_the_fold(spark):
    from foliant.functions.arrays import rle_decode

    cells = spark.createDataFrame([("a", 0, 0, 2), ("a", 0, 4, 1), ("a", 99, 99, 3), ("b", 5, 5, 1)], "s string, r int, c int, n bigint")
    out = A.transfer_string(cells, ("s",)).withColumn("d", rle_decode(F.col("tsf")))
    assert collected(out, F.size("d"), F.aggregate("d", F.lit(0), lambda x, y: x + y)) == [(10000, 1), (10000, 6)]


def test_forms(spark):
    rows = spark.createDataFrame(
        [(0, "p1", "445", "3", "", "Yes", "Poster"), (1, "p1", "3,5", "4", "444", "No", "Oral"), (2, "p2", "abc", "1", "1", "Yes", ""), (3, "", "99", "", "", "Yes", "")],
        ["row_ix", "Paper ID", "Initial Ratings", "Initial Confidence", "[Optional] Ratings after Rebuttal", "Open to Community", "Decision"],
    ).withColumn("[Optional] Confidence after Rebuttal", F.lit("4"))
    spec = specs.form_spec("cvpr", 2025, {"rating": "Initial Ratings", "confidence": "Initial Confidence"}, id_column="Paper ID", status_column="Decision", consent_column="Open to Community")
    every = forms.responses(rows, spec)  # letters and averages over 5 are out
    assert collected(every, "row_ix", "id", "rating") == [(0, "p1", "4.0;4.0;5.0"), (1, "p1", "3.0;5.0")]
    assert collected(forms.responses(rows, spec, forms.NOW), "id", "rating", "rating_avg") == [("p1", "4.0;4.0;4.0", 4.0)]
    assert collected(forms.responses(rows, spec, forms.INITIAL), "id", "rating") == [("p1", "3.0;5.0")]
    merged = forms.papers(every, spec, hash_ids=False)
    assert collected(merged, "id", "status", "rating", "open2public") == [("p1", "Poster", "3.0;5.0", "Yes")]
    assert forms.published(forms.papers(every, spec)).first().id.startswith("GF_")


def test_notes(spark):
    content = {"title": json.dumps({"value": " A  title "}), "authors": json.dumps(["X Y", "Z"]), "authorids": '["~X_Y1", "mail@x.org"]', "venue": json.dumps({"value": "V oral"}), "keywords": "ml"}
    review = {"invitation": "V/Paper1/-/Official_Review", "invitations": None, "content": {"rating": '{"value":"8: accept"}'}}
    other = {"invitation": None, "invitations": ["V/-/Comment"], "content": {}}
    df = spark.createDataFrame([("a", content, (2, [review, other])), ("b", {"title": "B"}, None)], schema.NOTE)
    got = {r.id: r for r in notes.papers(df, {"rating": "rating"}, {"V oral": "Oral"}).collect()}
    assert (got["a"].title, got["a"].status, got["a"].rating, got["a"].authorids, got["a"].author) == ("A  title".replace("  ", " "), "Oral", "8.0", "~X_Y1", "X Y;Z")
    assert (got["b"].status, got["b"].rating, got["b"].rating_avg, got["b"].replies) == ("Unknown", "", 0.0, 0)


def test_resolve_and_server_row(spark):
    site = spark.createDataFrame([(1, "x", "deep learning for cats", "Oral", "s1"), (2, "x", "only on the site here", "Poster", "s2")], "row_ix bigint, block string, title string, status string, site string")
    platform = spark.createDataFrame([(1, "x", "a", "Deep learning for cats", ""), (2, "x", "b", "a rejected title", "Reject")], "row_ix bigint, block string, id string, title string, status string")
    merged, matches = venue.resolve(site, platform, "icml")
    assert matches.count() == 1 and merged.count() == 3
    assert merged.where("id = 'a'").first().status == "Oral"
    summary = spark.createDataFrame([("c1", "Oral", 3), ("c1", "Reject", 7)], "conference string, tier string, n int")
    row = venue.server_row(summary, spark.createDataFrame([("c1", "1,000")], "conference string, total string"), ["Oral", "Reject"]).first()
    assert (row.total, row.accept, row.ac_rate) == (1000, 3, 0.003)
    p = spark.createDataFrame([("Oral", "A", 5.0, 3), ("Reject", "", 2.0, 1)], "status string, primary_area string, rating_avg double, replies int")
    s = venue.summaries(p, ("rating", "replies"))
    assert A.unequal_sums(s, ("tier", "area"), "dim").count() == 0


def test_extraction(spark):
    answers = [(0, '```json\n{"title": "T", "authors": "A;B", "aff": "X", "email": "a@b"}\n```'), (1, 'Here: {"title": "U",}'), (2, "f(title='V', aff='Q')"), (3, "nothing")]
    d = {r.row_ix: r for r in extraction.decoded(spark.createDataFrame(answers, "row_ix bigint, content string")).collect()}
    assert [d[i].title for i in range(4)] == ["T", "U", "V", ""] and [d[i].ok for i in range(4)] == [True, True, True, False]
    papers = spark.createDataFrame([(0,), (9,)], "row_ix bigint")
    joined, without, quality = extraction.applied(papers, spark.createDataFrame(answers, "row_ix bigint, content string"))
    assert joined.count() == 1 and collected(without, "row_ix") == [(9,)]
    assert {r["class"]: r.n for r in quality.collect()}["unreadable"] == 1


def test_files(spark, tmp_path):
    p = tmp_path / "nips" / "nips2024.json"
    p.parent.mkdir()
    p.write_text(json.dumps([{"id": "b", "title": "x"}, {"id": "a", "title": ""}]))
    df = files.paper_list(spark, str(p), schema.SITE_PAPER)
    assert [r.id for r in df.collect()] == ["a", "b"]
    assert schema.from_files(df).where("title is null").count() == 1
    assert files.paper_list(spark, str(tmp_path / "no.json"), schema.SITE_PAPER).count() == 0
    assert files.paper_list(spark, "x.txt", schema.SITE_PAPER).count() == 0
    assert files.paper_tree(spark, str(tmp_path), schema.SITE_PAPER).select("folder").distinct().first()[0] == "nips"
    (tmp_path / "s.json").write_text(json.dumps({"2024": {"openreview": {"track": {"main": "1"}, "tname": {"main": {"v poster": "Poster", "v oral": "Oral"}}, "rname": {"main": {"rating": "Rating"}}, "aname": {"main": ["A", "B"]}}}}))
    dims = files.settings(spark, str(tmp_path / "s.json"))
    assert collected(dims["dim_tier"], "raw", "name") == [("v oral", "Oral"), ("v poster", "Poster")]
    assert collected(dims["dim_area"], "area") == [("A",), ("B",)] and collected(dims["dim_review"], "key", "label") == [("rating", "Rating")]
    (tmp_path / "r.jsonl").write_text('{"custom_id": "request-f-7", "content": "x"}\n')
    assert files.json_lines(spark, str(tmp_path / "r.jsonl"), schema.strings("custom_id", "content")).first().row_ix == 7
    (tmp_path / "a.xml").write_text("<feed><entry><id>i</id><title> A\n b </title></entry></feed>")
    assert files.atom_entries(spark, str(tmp_path / "a.xml")).first() == ("i", "A b")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    assert sinks.save_list(df, str(tmp_path / "l")) and not sinks.save_list(df.limit(0), str(tmp_path / "e"))
    with pytest.raises(ValueError):
        sinks.save_list(df, str(tmp_path / "l"), mode="x")
    out = str(tmp_path / "u")
    sinks.save_upsert(df, out, "k")
    assert collected(sinks.save_upsert(spark.createDataFrame([(2, "z")], "k int, v string"), out, "k"), "k", "v") == [(1, "x"), (2, "z")]
    sinks.save_requests(spark.createDataFrame([(0, "Univ"), (1, "")], "row_ix bigint, aff string"), str(tmp_path / "q"), "f", "p", "m")
    assert json.loads(spark.read.text(str(tmp_path / "q")).first()[0])["custom_id"] == "request-f-0"
    h = spark.createDataFrame([("main", "rating", "Oral", "overall", "1;2")], "track string, dim string, tier string, area string, hist string")
    doc = json.loads(sinks.summary_document(h, h.withColumnRenamed("hist", "tsf")).first().document)
    assert doc["hist"]["rating"]["Oral"]["overall"] == "1;2"


def fake_fetch(url, offset, limit):
    return [{"id": f"n{i}", "content": {"title": i}} for i in range(offset, min(offset + limit, 25))]


def test_paged_source(spark):
    rest.register(spark)
    reader = spark.read.format("paged_notes").option("url", "x").option("fetch", "test_operators.fake_fetch")
    got = rest._Reader({"url": "x", "fetch": "test_operators.fake_fetch", "limit": "10", "total": "25"})
    assert [(p.offset, p.limit) for p in got.partitions()] == [(0, 10), (10, 10), (20, 5)]
    assert [r[1] for p in got.partitions() for r in got.read(p)] == [f"n{i}" for i in range(25)]
    assert reader is not None
    calls = []
    assert rest.get_with_retries("u", tries=3, open_url=lambda *a, **k: (_ for _ in ()).throw(OSError()), sleep=calls.append) is None
    assert calls == [0.5, 1.0]


def test_pages_and_pdf(spark):
    html = "<h2>Day 1</h2><table><tr><td>A</td><td></td></tr></table><a href='/paper/1'>First  paper</a><a href='https://github.com/a/b'>Code</a><a href='x.pdf'>PDF</a>"
    df = spark.createDataFrame([("https://h.org/l/", html), ("https://h.org/n", None)], "url string, html string")
    assert collected(pages.cards(df, "/paper/"), "title", "site", "id") == [("First paper", "https://h.org/paper/1", "1")]
    assert collected(pages.tables(df), "section", "row", F.col("cells")[0]) == [("Day 1", 0, "A")]
    d = pages.details(df).where("url like '%l/'").first()
    assert (d.github, d.pdf, d.poster) == ("https://github.com/a/b", "https://h.org/l/x.pdf", "")
    content = b"%PDF-1.4 /Author (Jane) <</Length 9>> stream\nBT [(Hel) -20 (lo)] TJ T* (World) Tj ET\nendstream"
    assert pdf.first_page(content) == ("Jane", "Hello\nWorld")


def test_streaming(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "c", 3.0)], "k int, v string, s double").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("k int, v string, s double").parquet(src)
    incremental.upsert_stream(stream, str(tmp_path / "out"), "k", str(tmp_path / "cp"), order="s").awaitTermination(60)
    table = incremental.stored_rows(spark, str(tmp_path / "out"), stream.schema, "k", "s")
    assert collected(table.read(), "k", "v") == [(1, "b"), (2, "c")]
    work = spark.createDataFrame([("t", 0, "pending"), ("u", 2, "pending")], "title string, attempts int, status string")
    done = spark.createDataFrame([("t", "no_record"), ("u", "no_record")], "title string, status string")
    assert collected(incremental.retry_queue(work, done), "title", "attempts", "status") == [("t", 1, "pending"), ("u", 3, "no_record")]


def test_registry():
    assert specs.source_kind("cvpr", "site", 2022) == "tables" and specs.source_kind("cvpr", "site", 2023) == "cards"
    assert specs.source_kind("icml", "openaccess", 2024) is None
    with pytest.raises(KeyError):
        specs.source_kind("none", "site", 2024)


def test_highest_status_of_many_kinds(spark, tmp_path):
    from foliant.plans import review_queries, views

    rows = [(i, f"kind{i}") for i in range(80)] + [(100, "view"), (100, "click"), (101, "view"), (102, None), (103, "view"), (103, "other")]
    spark.createDataFrame(rows, "user_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    got = {r.user_id: r.event_type for r in review_queries.highest_status(views.Tables(spark, str(tmp_path))).collect()}
    assert got == {i: f"kind{i}" for i in range(80)} | {100: "click", 101: "view", 102: None, 103: "other"}


def test_long_titles_are_bounded_by_their_runs():
    """Long titles of the same few letters pass every count; few of them are left to be scored one by one."""
    import random

    from foliant.functions.documents import ratio

    own = random.Random(5)
    parts = ["th", "er", "in", "on", "ing", "tion", "ou", "ea", "st", "an", "nd", "ha", "re", "ble"]
    word = lambda: "".join(own.choice(parts) for _ in range(own.randint(1, 4)))
    text = lambda n: " ".join(word() if own.random() > 0.08 else word().title() for _ in range(n))
    left = [text(own.randint(22, 230)) for _ in range(60)]
    changed = [("".join(c for c in t if own.random() > 0.12), t[:150] + text(4) + t[150:], text(3) + t, "É, 7" + t[40:]) for t in left[:12]]
    right = [text(own.randint(22, 230)) for _ in range(60)] + [t for more in changed for t in more]
    found = {(i, j) for a, b in fuzzy.candidates(left, right, 0.71) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
    similar = {(i, j) for i, x in enumerate(left) for j, y in enumerate(right) if ratio(x, y) >= 0.71}
    assert len(similar) >= 12 and similar <= found and len(found) <= len(similar) + 30, (len(found), len(similar))


def test_rows_of_many_tiles_are_copied_few_times(spark, monkeypatch):
    """Tiles grow with their table, so that all are about as many, up to the rows and characters that one may hold."""
    left, right = (titles(spark, [("x", i, f"{name} {i:05d}") for i in range(400)]) for name in ("title number", "another name"))

    def sizes(least):
        return lambda a, b: pd.DataFrame([("x", len(a), len(b), "", 0.0, 0)], columns=["block", "left_ix", "right_ix", "right_title", "score", "level"])

    import pandas as pd

    monkeypatch.setattr(fuzzy, "_tile_scores", sizes)
    monkeypatch.setattr(fuzzy, "TILES", 4, raising=False)
    for most, copies in (((1 << 16, 1 << 22), 2), ((100, 1 << 22), 4), ((1 << 16, 1800), 4)):
        monkeypatch.setattr(fuzzy, "MOST", most, raising=False)
        met = fuzzy.scored_pairs(left, right, 0.95, tile=16).agg(F.sum("left_ix"), F.sum("right_ix"), F.sum(F.col("left_ix") * F.col("right_ix"))).first()
        assert met[0] <= 400 * copies and met[1] <= 400 * copies and met[2] == 400 * 400, (most, met)
