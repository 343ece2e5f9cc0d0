"""Prefix scans, intervals, sheets of many files, top lists and paged sources on hot and odd tables."""

import random

import pytest
from pyspark.sql import functions as F

from foliant.operators import aggregates as A
from foliant.operators import joins as J
from foliant.operators import rows as R
from foliant.operators import scans
from foliant.sources import files, rest


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_numbers_along_an_order(spark):
    own = random.Random(1)
    values = [own.randrange(50) for _ in range(500)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, __start int").repartition(5)
    got = scans.numbered(df.withColumnRenamed("__start", "i"), "v", "i").collect()
    assert [(r.v, r.i) for r in sorted(got, key=lambda r: r.row_ix)] == sorted((v, i) for i, v in enumerate(values))
    assert [r.row_ix for r in sorted(got, key=lambda r: r.row_ix)] == list(range(500))
    assert scans.numbered(df.limit(0).drop("__start"), "v").count() == 0


def test_places_within_groups(spark):
    """One group holds most rows, which the ranges cut."""
    own = random.Random(5)
    rows = [(own.choice("aaaaab"), own.choice("xy"), i) for i in range(300)]
    got = scans.numbered_within(spark.createDataFrame(rows, "g string, h string, i int").repartition(4), ["g", "h"], "i").collect()
    for g, h in {r[:2] for r in rows}:
        assert [r.i for r in sorted((r for r in got if (r.g, r.h) == (g, h)), key=lambda r: r.n)] == [i for x, y, i in rows if (x, y) == (g, h)]
        assert sorted(r.n for r in got if (r.g, r.h) == (g, h)) == list(range(sum(r[:2] == (g, h) for r in rows)))


def test_carry_forward_over_ranges(spark):
    """One large group, groups without values, null groups and nulls; the ranges cut the large group."""
    own = random.Random(2)
    rows = [(own.choice(["a", "a", "a", "b", None]), i, own.choice(["", None, "", "", f"v{i}"])) for i in range(400)] + [("empty", 1000, ""), ("empty", 1001, None)]
    expected, last = {}, {}
    for g, i, v in rows:
        last[g] = v or last.get(g)
        expected[i] = last[g]
    df = spark.createDataFrame(rows, "g string, row_ix int, v string").repartition(3)
    assert {r.row_ix: r.v for r in R.carry_forward(df, "v", "g").collect()} == expected
    assert R.carry_forward(df.limit(0), "v", "g").count() == 0


def test_intervals_meet_points_by_equality(spark):
    """Against all pairs; one key holds most rows, intervals may be empty, open or beyond the points."""
    own = random.Random(3)
    entries = [(own.choice([1, 1, 1, 2, None]), own.choice(["", str(own.randrange(1980, 2040)), "x"]), own.choice(["", str(own.randrange(1980, 2050))]), f"v{i}", i) for i in range(300)]
    points = [(own.choice([1, 2, 3, None]), own.choice([None, *range(1985, 2035)]), own.randrange(3)) for _ in range(300)]

    def best(k, at):
        found = [(o, v) for key, s, e, v, o in entries if key == k and k is not None and at is not None and (int(s) if s.isdigit() else 0) <= at <= (int(e) if e.isdigit() else 2030)]
        return max(found)[1] if found else None

    e = spark.createDataFrame(entries, "k int, start string, end string, value string, ord int")
    p = spark.createDataFrame(points, "k int, at int, more int")
    out = J.at_date(e, p, on="k", now=2030)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted(((k, at, m, best(k, at)) for k, at, m in set(points)), key=repr)
    assert "NestedLoop" not in plan_of(out) and "Cartesian" not in plan_of(out)
    assert J.at_date(e, p.limit(0), on="k", now=2030).count() == 0
    assert {r.value for r in J.at_date(e.limit(0), p, on="k", now=2030).collect()} == {None}


def test_a_sheet_of_many_files(spark, tmp_path):
    for name, body in (("a.csv", "x\n1\n\"2\n2\"\n3\n"), ("b.csv", "x\n4\n5\n6\n"), ("c.csv", "x\n")):
        (tmp_path / name).write_text(body)
    assert [(r.x, r.row_ix) for r in files.sheet(spark, str(tmp_path), content_start=3).orderBy("row_ix").collect()] == [("3", 2), ("4", 3), ("5", 4), ("6", 5)]


def test_top_lists(spark):
    df = spark.createDataFrame([(1, "t", "Oral", ["b", "a", ""], ["~b", ""]), (2, "t", "Poster", ["a"], []), (3, "u", "Oral", ["a", "x"], ["one"]), (4, "t", "Other", ["z"], [])], "row_ix bigint, track string, status string, names array<string>, ids array<string>")
    df = df.withColumn("two", F.slice("names", 1, 2))
    lists = {"names": A.named(F.col("names")), "people": A.identified(F.col("two"), F.col("ids"))}
    got = A.top_lists(df, lists, ["Oral", "Poster"], k=2)
    rows = {(r.track, r.list, r["rank"]): (r.name, r.key, r.total, r.c0, r.c1) for r in got.collect()}
    assert rows == {("t", "names", 1): ("a", "a", 2, 1, 1), ("t", "names", 2): ("b", "b", 1, 1, 0), ("t", "people", 1): ("a", "a", 2, 1, 1), ("t", "people", 2): ("b", "~b", 1, 1, 0), ("u", "names", 1): ("a", "a", 1, 1, 0), ("u", "names", 2): ("x", "x", 1, 1, 0)}
    every = A.top_lists(df, lists, None, k=5)
    assert "c0" not in every.columns and {r.name for r in every.where("track = 't' and list = 'names'").collect()} == {"a", "b", "z"}
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()
    assert A.top_lists(df.limit(0), lists, ["Oral"]).count() == 0


# --- paged sources ----------------------------------------------------------------------------------------------------

ANSWERS = []


def failing_fetch(url, offset, limit):
    """Fails as often as ANSWERS says before each answer."""
    if ANSWERS and ANSWERS[0]:
        ANSWERS[0] -= 1
        raise OSError("no answer")
    if ANSWERS:
        ANSWERS.pop(0)
    return [{"id": f"n{i}"} for i in range(offset, offset + limit)]


def test_throttle_pauses_after_six_failures(monkeypatch):
    slept = []
    throttle = rest.Throttle(gap=0, jitter=0, clock=lambda: 0.0, sleep=slept.append)
    for _ in range(2):
        with pytest.raises(OSError, match="no answer"):
            throttle(lambda: None)
    assert slept == [300.0] and throttle.failed == 0
    assert throttle(lambda: b"x") == b"x"
    # Through the reader: the first page fails twice and is then read.
    monkeypatch.setattr("time.sleep", lambda _: None)
    ANSWERS[:] = [2, 0, 1]
    reader = rest._Reader({"url": "x", "fetch": f"{__name__}.failing_fetch", "limit": "10", "total": "25", "gap": "0"})
    monkeypatch.setattr(rest, "_named", lambda name: failing_fetch)
    assert [r[1] for p in reader.partitions() for r in reader.read(p)] == [f"n{i}" for i in range(25)]
    ANSWERS[:] = [3]
    with pytest.raises(OSError):
        list(reader.read(reader.partitions()[0]))


def test_stream_of_stored_pages(spark, tmp_path):
    """Several micro-batches, a restart that goes on from the checkpoint, and pages that come later."""
    notes = spark.createDataFrame([(i, f"n{i}") for i in range(23)], "k int, id string")
    folder, out, checkpoint = (f"{tmp_path}/{x}" for x in ("pages", "out", "cp"))
    rest.register(spark)
    rest.store_pages(notes, folder, "k", limit=5)
    assert rest.stored_count(folder) == 23 and [n["id"] for n in rest.stored_fetch(folder, 3, 4)] == ["n3", "n4", "n5", "n6"]
    assert rest.stored_count(f"{folder}/none") == 0 and rest.stored_fetch(f"{folder}/none", 0, 5) == []

    def run(rows):
        options = {"url": folder, "limit": 5, "batch": rows, "checkpointLocation": checkpoint, "fetch": "foliant.sources.rest.stored_fetch", "count": "foliant.sources.rest.stored_count"}
        query = spark.readStream.format("paged_notes").options(**options).load().writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        running = query.trigger(availableNow=True).start()
        running.awaitTermination(120)
        return running.lastProgress["numInputRows"]

    assert [run(10), run(7), run(100)] == [10, 7, 6]
    assert sorted(r.row_ix for r in spark.read.parquet(out).collect()) == list(range(23))


def test_a_fetch_reads_its_own_pages(spark, tmp_path):
    """Other pages are neither listed nor opened, and many pages share a task."""
    notes = spark.createDataFrame([(i, f"n{i}") for i in range(23)], "k int, id string")
    rest.store_pages(notes, f"{tmp_path}/p", "k", limit=5)
    for f in (tmp_path / "p" / "page=0").glob("*.json"):
        f.write_text("not JSON\n")
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    assert [n["id"] for n in rest.stored_fetch(f"{tmp_path}/p", 13, 4)] == ["n13", "n14", "n15", "n16"]
    assert rest.stored_count(f"{tmp_path}/p") == 23
    pages = rest._Reader({"url": "x", "limit": "10", "total": "100005"}).partitions()
    assert len(pages) <= rest.MOST_PARTITIONS and [p.offset for p in pages[1:]] == [p.offset + p.limit for p in pages[:-1]]
    assert all(p.offset % 10 == 0 for p in pages) and pages[-1].offset + pages[-1].limit == 100005


def test_top_lists_sorts_no_rows_before_it_counts(spark):
    """What is counted per row has buffers of fixed width; only the few names of a key are sorted."""
    df = spark.createDataFrame([(0, "t", "Oral", ["a"], ["1"]), (1, "t", "Oral", ["b", "a"], ["1", ""])], "row_ix long, track string, status string, n array<string>, i array<string>")
    top = A.top_lists(df, {"own": A.identified(F.col("n"), F.col("i"))}, None)
    assert sorted((r.key, r.name, r.total, r.first_seen) for r in top.collect()) == [("1", "a", 2, 0), ("a", "a", 1, (1 << 20) + 1)]
    plan = top._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("HashAggregate") - plan.count("ObjectHashAggregate") >= 2
