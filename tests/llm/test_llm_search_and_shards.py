"""Centroid clustering, sharding and ranked search against brute force and on odd tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from foliant.llm import clustering, lexical_search, queries, sharding

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("cluster", T.StringType()), T.StructField("v", T.StringType())])


# --- clustering -------------------------------------------------------------------------------------------------------


def brute_clusters(rows, dims, scale, k, rounds):
    """(vec_id, cluster, distance) of all vectors, and the final centroids."""
    kept = [(i, [math.floor(x * scale) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    rank = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in rank[:k]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for n in range(rounds + 1):
        own = [min((square(v, c), j) for j, c in enumerate(centres)) for _, v in kept]
        if n < rounds:
            for j in range(len(centres)):
                if members := [v for (_, v), (_, c) in zip(kept, own, strict=True) if c == j]:
                    centres[j] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    return [(i, c, d) for (i, _), (d, c) in zip(kept, own, strict=True)], centres


@pytest.mark.parametrize(("seed", "dims", "k", "spread"), [(1, 3, 7, 40), (2, 2, 5, 3), (3, 8, 30, 200), (4, 1, 2, 6)])
def test_clusters_equal_brute_force(spark, seed, dims, k, spread):
    """Small spreads give many ties and equal vectors."""
    own = random.Random(seed)
    rows = [(i, [own.randint(-spread, spread) / 4 for _ in range(dims)]) for i in range(300)]
    got = clustering.clusters(spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS).repartition(3), dims=dims, scale=4, k=k, rounds=4).collect()
    expected, centres = brute_clusters(rows, dims, 4, k, 4)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == sorted(expected)
    inertia = collections.Counter()
    for _, c, d in expected:
        inertia[c] += d
    assert {(r.cluster, r.cluster_inertia, r.inertia) for r in got} == {(c, inertia[c], inertia.total()) for c in {c for _, c, _ in expected}}
    assert {(r.cluster, r.centroid_sha256) for r in got} == {(c, hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()) for c in inertia}


def test_search_looks_at_few_centroids():
    """Vectors near their centroids: bounds spare most distances, and the result is that of looking at all."""
    own = np.random.default_rng(5)
    centroids = own.integers(-10_000, 10_000, (64, 8))
    v = centroids[own.integers(0, 64, 5000)] + own.integers(-300, 300, (5000, 8))
    all_of = np.stack([clustering.squared(v, c) for c in centroids])
    start = np.zeros(5000, np.int64), np.full(5000, np.inf), np.zeros(5000)
    cluster, upper, lower, distance, _ = clustering.assign(v, *start, clustering.Ball(centroids), True)
    assert (cluster == all_of.argmin(0)).all() and (distance == all_of.min(0)).all()
    near = np.sqrt(np.sort(all_of, axis=0))
    assert (upper >= near[0]).all() and (lower <= near[1]).all()
    moved = centroids + own.integers(-20, 20, centroids.shape)
    far = np.sqrt(clustering.squared(moved, centroids)).max() * (1 + 1e-9)
    cluster, _, _, _, looked = clustering.assign(v, cluster, upper + far, lower - far, clustering.Ball(moved), False)
    assert (cluster == np.stack([clustering.squared(v, c) for c in moved]).argmin(0)).all()
    assert looked < 5000


def test_clusters_of_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [2.0, 2.0]), (2, None), (3, []), (4, [1.0]), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0, 2.0, 3.0]), (9, [-0.1, 1e300])]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS)
    got = clustering.clusters(df, dims=2, scale=4, k=16, rounds=2).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in got) == [(False, 1), (False, 1), (False, 9), (True, 0)]
    assert {r.distance for r in got} == {0}
    assert clustering.clusters(df.limit(0), dims=2).count() == 0
    assert clustering.clusters(df.where("vec_id = 2"), dims=2).count() == 0
    assert clustering.clusters(df, dims=2, k=1, rounds=0).agg({"cluster": "max"}).first()[0] == 0
    with pytest.raises(ValueError):
        clustering.clusters(df, k=0)


# --- sharding ---------------------------------------------------------------------------------------------------------


def plain_jump(key, shards):
    at, ahead = -1, 0
    while ahead < shards:
        at = ahead
        key = (key * 2862933555777941757 + 1) % 2**64
        ahead = int((at + 1) * (2**31 / ((key >> 33) + 1)))
    return at


def test_jump_moves_rows_to_the_new_shard_only():
    keys = np.random.default_rng(3).integers(0, 2**64, 20_000, dtype=np.uint64)
    for shards in (1, 2, 39, 40, 1000):
        now, grown = sharding.jump(keys, shards), sharding.jump(keys, shards + 1)
        assert now[:500].tolist() == [plain_jump(int(k), shards) for k in keys[:500]]
        assert set(grown[grown != now].tolist()) <= {shards}
        assert abs((grown != now).mean() - 1 / (shards + 1)) < 0.02
    sizes = np.bincount(sharding.jump(keys, 40), minlength=40)
    assert sizes.min() > 400 and sizes.max() < 600


@pytest.mark.parametrize("broadcast_ranges", [200_000, 0])
def test_sharding(make_docs, odd_docs, broadcast_ranges):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()] + [(i, f"text {i % 7}") for i in range(400)] + [(77, "hot")] * 300
    docs = make_docs(*rows).repartition(5)
    got = sharding.digest(sharding.assign(docs, 6, broadcast_ranges=broadcast_ranges)).collect()
    expected = []
    for i, t in rows:
        key = int(hashlib.md5(b"null id" if i is None else str(i).encode()).hexdigest()[:16], 16)
        body = (t or "").encode()
        expected.append((i, len(body) + 16, zlib.crc32(body), plain_jump(key, 6), plain_jump(key, 7)))
    by = lambda rows: sorted(rows, key=lambda r: (r[3], r[0] is not None, r[0] or 0, r[2], r[1]))
    assert by((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in got) == by(expected)
    for s in range(6):
        own = sorted((r for r in got if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        order = [(r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.size) for r in own]
        assert order == sorted(order)
    assert sharding.assign(docs.limit(0), 6).count() == 0


def test_textual_ids(spark):
    docs = spark.createDataFrame([("a", "x"), ("b", None), (None, "y"), ("a", "x")], "doc_id string, text string")
    got = sharding.assign(docs, 2).collect()
    assert sorted((r.doc_id or "", r.size) for r in got) == [("", 17), ("a", 17), ("a", 17), ("b", 16)]


def test_shards_as_folders(spark, odd_docs, make_docs, tmp_path):
    docs = odd_docs.unionByName(make_docs(*[(i, f"t{i}") for i in range(100, 300)]))
    sharding.write_shards(docs, 4, f"file://{tmp_path}/shards", files=2)
    stored = spark.read.parquet(f"file://{tmp_path}/shards")
    assert sorted(map(repr, stored.select(*docs.columns).collect())) == sorted(map(repr, docs.collect()))
    wanted = {r.doc_id: r.shard for r in sharding.assign(docs, 4).collect()}
    assert all(wanted[r.doc_id] == r.shard for r in stored.select("doc_id", "shard").collect())
    moved = sharding.movers(spark, f"file://{tmp_path}/shards", 4)
    assert {r.doc_id for r in moved.collect()} == {r.doc_id for r in sharding.assign(docs, 5).where("shard = 4").collect()}
    assert moved.columns == [*docs.columns, "shard"] and 20 < moved.count() < 70


# --- ranked search ----------------------------------------------------------------------------------------------------


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_search(docs, items, k):
    counted = [(i, collections.Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, length, out = len(counted), sum(c.total() for _, c in counted), []
    df = collections.Counter(t for _, c in counted for t in c)
    for name, text in items:
        found = []
        for i, c in counted:
            m = 10 + 90 * c.total() * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(name, rank, None if null else i, -score) for rank, (score, null, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("segment_words", "block_terms", "window"), [(1 << 20, 200_000, 4096), (60, 5, 3)])
def test_search_equals_brute_force(spark, make_docs, odd_docs, monkeypatch, segment_words, block_terms, window):
    """Small segments, blocks and windows; many equal scores; repeated and missing ids in no order."""
    monkeypatch.setattr(lexical_search.best_of, "__defaults__", (window,))
    own = random.Random(8)
    vocab = [f"w{i}" for i in range(60)] + ["É", "中文", "X9"]
    text = lambda n: " ".join(own.choice(vocab) for _ in range(n))
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()] + [(own.randrange(150), text(own.randint(0, 30))) for _ in range(200)] + [(200 + i, "w1 w2") for i in range(30)] + [(None, "w1, W2")]
    items = [(1, "W1 w2"), (2, text(12)), (3, None), (4, ""), (2, text(3)), (None, "É x9 w1"), (5, "absent"), (6, "one lorem"), (7, "x" * 200_000)]
    docs = make_docs(*rows).repartition(3)
    asked = spark.createDataFrame([(*i, "clash", 1) for i in items], "item_id long, text string, doc_id string, score long")
    root, segments = lexical_search.build_index(docs, segment_words=segment_words)
    got = lexical_search.search(root, segments, asked, k=10, block_terms=block_terms)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_search(rows, items, 10)
    assert lexical_search.search(root, segments, asked.limit(0)).count() == 0
    root, segments = lexical_search.build_index(docs.limit(0))
    assert lexical_search.search(root, segments, asked).count() == 0
    root, segments = lexical_search.build_index(docs.where("text is null or text = ''"))
    assert lexical_search.search(root, segments, asked).count() == 0


def test_postings_round_trip(tmp_path):
    import pyarrow.fs as pafs

    own = np.random.default_rng(1)
    values = np.concatenate([own.integers(0, 2**k, 50) for k in (1, 7, 8, 14, 21, 40, 62)])
    data, size = lexical_search.encode(values)
    assert len(data) == size.sum() and lexical_search.decode(data).tolist() == values.tolist()
    docs = [own.integers(0, 50, n).astype(np.uint64) for n in (0, 5, 300, 1, 0, 77)]
    ids = np.array([5, 3, 9, 1, 3, 2])
    (tmp_path / "s").write_bytes(b"before" + lexical_search.pack(ids, np.array(list(map(len, docs))), np.concatenate(docs)))
    with pafs.LocalFileSystem().open_input_file(str(tmp_path / "s")) as file:
        s = lexical_search.Segment(file, 6)
        order = np.argsort(ids, kind="stable")
        assert s.ids.tolist() == ids[order].tolist() and s.lengths.tolist() == [len(docs[i]) for i in order]
        at = s.find(np.array([0, 7, 30, 99], np.uint64))
        assert at[3] == -1
        for t, (found, tf) in zip((0, 7, 30), s.postings(at[:3]), strict=True):
            assert dict(zip(found.tolist(), tf.tolist(), strict=True)) == {p: n for p, i in enumerate(order) if (n := int((docs[i] == t).sum()))}


def test_new_queries_have_sql():
    assert {"op11_centroid_clustering", "op12_sharding", "op13_lexical_search"} <= set(queries.oracle_sql())
