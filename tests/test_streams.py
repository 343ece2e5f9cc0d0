"""Bucket tables and stateful streams: late rows, broken merges, repeated batches, timers."""

import collections
import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from foliant.operators import rows as R
from foliant.streaming import incremental, stateful
from foliant.upserts import BucketTable, ConcurrentMerge, latest, summed

SCHEMA = "k string, v string, o bigint"


def table(spark, path, buckets=8):
    schema = spark.createDataFrame([], SCHEMA).schema
    return BucketTable(spark, f"file://{path}/table", schema, ["k"], latest("k", "o", schema.names), buckets)


def stored(t):
    return sorted(((r.k, r.v, r.o) for r in t.read().collect()), key=repr)


def test_late_rows_lose(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.read().count() == 0
    t.merge(spark.createDataFrame([("a", "new", 10), ("a", "older", 9), (None, "x", 1), ("c", "null order", None)], SCHEMA))
    t.merge(spark.createDataFrame([("a", "late", 5), ("b", "y", 1), (None, "z", 2), ("c", "any", 0)], SCHEMA))
    assert stored(t) == sorted([("a", "new", 10), (None, "z", 2), ("b", "y", 1), ("c", "any", 0)], key=repr)
    # Of equal orders the largest row, whichever came first.
    t.merge(spark.createDataFrame([("b", "a", 1)], SCHEMA))
    assert ("b", "y", 1) in stored(t)
    assert t.merge(spark.createDataFrame([], SCHEMA))["version"] == 3


def test_any_order_of_batches_gives_the_same_table(spark, tmp_path):
    own = random.Random(3)
    rows = [(f"k{own.randrange(30)}", f"v{i}", i) for i in range(200)]
    expected = sorted(({k: (k, v, o) for k, v, o in rows}).values(), key=repr)
    own.shuffle(rows)
    t = table(spark, tmp_path)
    for i in range(0, 200, 50):
        t.merge(spark.createDataFrame(rows[i : i + 50], SCHEMA))
    assert stored(t) == expected


def test_only_touched_buckets_are_written(spark, tmp_path):
    t = table(spark, tmp_path, buckets=16)
    t.merge(spark.createDataFrame([(f"k{i}", "v", 1) for i in range(400)], SCHEMA))
    before = t.commit()["buckets"]
    t.merge(spark.createDataFrame([("k7", "w", 2)], SCHEMA))
    after = t.commit()["buckets"]
    assert sum(before[b] != after[b] for b in before) == 1 and len(after) == 16
    new = [f for f in os.listdir(tmp_path / "table/data") if f.startswith("2-")]
    size = lambda d: sum(os.path.getsize(os.path.join(x, f)) for x, _, fs in os.walk(d) for f in fs)
    assert size(tmp_path / "table/data" / new[0]) < size(tmp_path / "table/data") / 4
    assert t.read(1).where("k = 'k7'").first().v == "v" and t.read().where("k = 'k7'").first().v == "w"
    assert t.vacuum(keep=1) == 0 and t.versions() == [2]
    t.merge(spark.createDataFrame([(f"k{i}", "x", 3) for i in range(400)], SCHEMA))
    assert t.vacuum(keep=1) == 2 and {r.v for r in t.read().collect()} == {"x"}


def test_a_broken_merge_leaves_the_table(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    t.merge(spark.createDataFrame([("a", "x", 1)], SCHEMA))
    with monkeypatch.context() as m:
        m.setattr(BucketTable, "_create", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError, match="gone"):
            t.merge(spark.createDataFrame([("a", "y", 2), ("b", "y", 2)], SCHEMA))
    assert stored(t) == [("a", "x", 1)]
    t.merge(spark.createDataFrame([("a", "z", 3)], SCHEMA))
    assert stored(t) == [("a", "z", 3)]


def test_a_second_writer_is_refused(spark, tmp_path):
    one, two = table(spark, tmp_path), table(spark, tmp_path)
    one.merge(spark.createDataFrame([("a", "x", 1)], SCHEMA))
    seen = two.commit()
    one.merge(spark.createDataFrame([("a", "y", 2)], SCHEMA))
    with pytest.raises(ConcurrentMerge):
        two.merge(spark.createDataFrame([("a", "z", 3)], SCHEMA), seen=seen)
    assert stored(two) == [("a", "y", 2)] and not [f for f in os.listdir(tmp_path / "table/commits") if f.startswith(".2-") and not f.endswith(".crc")]


def test_a_repeated_batch_counts_once(spark, tmp_path):
    schema = spark.createDataFrame([], "c string, n bigint").schema
    t = BucketTable(spark, f"file://{tmp_path}/t", schema, ["c"], summed(["c"], "n"), 4)
    one = spark.createDataFrame([("a", 2), ("b", 1)], schema)
    for batch in (0, 0, 1):
        t.merge(one, "s", batch)
    t.merge(spark.createDataFrame([("b", -2)], schema), "s", 2)
    assert [tuple(r) for r in t.read().collect()] == [("a", 4)]
    assert t.merge(one.limit(0), "s", 3)["batches"] == {"s": 3}


def streamed(spark, path, rows, schema, files):
    """A stream of so many files, rows dealt to them in turn."""
    for k in range(files):
        spark.createDataFrame(rows[k::files], schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")


def test_stream_of_late_events(spark, tmp_path):
    """The newer event comes first, in a batch of its own."""
    rows = streamed(spark, tmp_path, [("a", "new", 10), ("a", "old", 5)], SCHEMA, 2)
    incremental.upsert_stream(rows, f"file://{tmp_path}/t", "k", f"{tmp_path}/c", order="o").awaitTermination(120)
    assert stored(incremental.stored_rows(spark, f"file://{tmp_path}/t", rows.schema, "k", "o")) == [("a", "new", 10)]


def test_stream_keep_best_equals_batch(spark, tmp_path):
    own = random.Random(1)
    rows = [(f"a long title {own.randrange(12)}", float(own.randrange(4)), i) for i in range(150)]
    own.shuffle(rows)
    rows.append(("a title without score", None, 999))
    schema = "title string, score double, row_ix bigint"
    best = stateful.keep_best_stream(streamed(spark, tmp_path, rows, schema, 3), "title", "score", "row_ix").withColumn("rank", F.struct("score", -F.col("row_ix")))
    incremental.upsert_stream(best, f"file://{tmp_path}/t", "title", f"{tmp_path}/c", order="rank").awaitTermination(120)
    got = incremental.stored_rows(spark, f"file://{tmp_path}/t", best.schema, "title", "rank").read().drop("rank")
    batch = R.keep_best(spark.createDataFrame(rows, schema).where("score is not null"), F.col("title"), "score")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def when(minute):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minute)


def test_quiet_keys_are_forgotten(spark, tmp_path):
    """After the quiet time a key starts anew; a later sink still knows its best."""
    schema = "k string, score double, o bigint, ts timestamp"
    batches = [[("a", 5.0, 1, when(0)), ("b", 1.0, 2, when(0))], [("x", 0.0, 3, when(600))], [("y", 0.0, 4, when(601))], [("a", 3.0, 5, when(602)), ("b", 4.0, 6, when(602))]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in").withWatermark("ts", "1 minute")
    best = stateful.keep_best_stream(rows, "k", "score", "o", time="ts", quiet_ms=3_600_000)
    out = []
    best.writeStream.outputMode("update").foreachBatch(lambda b, _: out.append(sorted((r.k, r.score) for r in b.collect()))).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination(120)
    flat = [x for b in out for x in b]
    assert ("a", 5.0) in flat and ("a", 3.0) in flat and ("b", 4.0) in flat


@pytest.mark.parametrize("files", [1, 4])
def test_signed_changes_equal_the_batch(spark, tmp_path, files):
    """After any sequence of status and score changes the counts are those of each key's last row."""
    own = random.Random(files)
    rows = [(f"p{own.randrange(20)}", i, own.choice(["Oral", "Poster", None]), own.randrange(3)) for i in range(200)]
    last = {}
    for r in rows:
        last[r[0]] = r
    own.shuffle(rows)
    changes = stateful.cell_changes(streamed(spark, tmp_path, rows, "id string, o bigint, status string, bin int", files), "id", "o", ["status", "bin"])
    incremental.count_stream(changes, f"file://{tmp_path}/t", ["status", "bin"], f"{tmp_path}/c").awaitTermination(120)
    got = incremental.stored_counts(spark, f"file://{tmp_path}/t", changes.schema, ["status", "bin"]).read().collect()
    assert {(r.status, r.bin): r.n for r in got} == collections.Counter((s, b) for _, _, s, b in last.values())


def test_retries_have_timers(spark, tmp_path):
    """A task without record is due after its backoff, twice as long each time, and final after the last try. The clock is the watermark of the batches before."""
    schema = "title string, order bigint, outcome string, time timestamp"
    batches = [[("t", 1, "no_record", when(0)), ("u", 2, "success", when(0))], [("x", 3, "failed", when(30))], [("z", 4, "failed", when(30))], [("t", 5, "no_record", when(31))], [("x", 6, "success", when(90))], [("z", 7, "failed", when(90))], [("t", 8, "no_record", when(91))], [("y", 9, "failed", when(500))]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in").withWatermark("time", "0 seconds")
    out = []
    states = stateful.retry_stream(rows, most=2, backoff_ms=600_000)
    states.writeStream.outputMode("update").foreachBatch(lambda b, _: out.extend(b.collect())).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination(120)
    t = [(r.event, r.tries, r.status, r.due) for r in out if r.title == "t"]
    minute = lambda m: int(when(m).replace(tzinfo=datetime.timezone.utc).timestamp() * 1000)
    assert t == [("outcome", 1, "pending", minute(10)), ("due", 1, "pending", minute(10)), ("outcome", 2, "pending", minute(51)), ("due", 2, "pending", minute(51)), ("outcome", 3, "no_record", None)]
    assert [(r.tries, r.status) for r in out if r.title == "u"] == [(1, "success")]


def test_keep_best_without_timers_runs_no_python(spark, tmp_path):
    rows = streamed(spark, tmp_path, [("a", 1.0, 1)], "k string, score double, o bigint", 1)
    plan = stateful.keep_best_stream(rows, "k", "score", "o")._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" not in plan and "Aggregate" in plan
