"""Exact n-gram Jaccard self-join by grouped prefixes, and its connected components.

A document's set holds its distinct k-word shingles; the order of all shingles is that of their hashes. Documents with
equal sets are one node. A set's prefix is the part of it below a fixed cut of that order, and nodes with the same prefix
and size are one group, which enters the search once:

1. Candidates. Two sets of similarity t differ in at most H shingles, which follows from their sizes, and so do any parts
   of them that a rule picks by the shingle alone. For each class of sizes the prefix is cut at fixed places of the order
   into more than H segments. Frequent shingles, such as those of a template, are left out of them, so that what meets in a
   block shares something that few sets have:
   a. Every group offers its segments. If more than H of them are filled, a similar one has an equal segment.
   b. Otherwise it also offers its first H + 1 shingles that are not frequent; if it has more than H, a similar one that
      does the same shares one of them.
   c. Otherwise it also offers the segments with their frequent shingles, and, if these are filled too rarely, its first
      n - ceil(t n) + 1 shingles.
   Two similar sets meet by the first of these steps at which one of them stops.
2. Filter of group pairs: sizes, and a lower bound of how much two prefixes differ, from bitmaps of parities.
3. Stars: each group is verified on whole sets against the nearest of its blocks' pivots, and each member of a group
   against the group's leader. The links form first components.
4. Rest: blocks (and groups) whose members lie in several components are dealt to tiles of bounded size. Group pairs that
   pass the filter are expanded to members, which then are held against each other by bitmaps of their whole sets. Each
   tile names the nearest pairs that would connect its components, a forest; these are verified on whole sets.
5. Tiles that still have pairs of different components get their texts and verify them, least distance first, skipping
   what is connected already. A tile returns links only, fewer than it has members.

So no link between components is lost, and no pairs are listed. A block of m nodes that stays in many components costs m
rows for each m / TILE and one product of bit matrices for each pair of tile sides, which is work with the square of its
size. Blocks of steps a and b are no larger than a shingle may be without being frequent. Those of step c can be: that is
left for sets which are frequent shingles but for H others at most and yet are not similar, as with documents that share
85 % of a template at a threshold of 90 %.

Defined results: a null, empty or blank text has an empty set and is linked with nothing; rows that repeat a doc_id are
one document for linking; a row without doc_id is returned with a null component and links with nothing. Other columns are
not read; distinct_documents() keeps all, of any names. Texts of any length are taken whole, and empty tables give empty
results. Shingles and whole sets are compared as 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliant.llm.common import id_text, release_memory, removed, renamed_apart, slices, with_names, written
from foliant.llm.components import components
from foliant.llm.textcodes import mix, shingles, space_words

#: The prefix is this part of the order of shingles.
CUT = 0.75
#: Counters of the sketch of block sizes, and the most of them that are told to executors as frequent. They decide how
#: blocks are dealt, so work and not results.
SKETCH, FREQUENT = 1 << 20, 1 << 16
#: Sets from which on a shingle's bucket can be frequent.
RARE = 512
#: Rows of a frequent block that one task searches for a pivot.
BLOCK = 2048
#: Nodes of one side of a tile.
TILE = 256
#: Nodes (24 bytes each) whose list is broadcast to look up their texts.
SHORT = 200_000
#: Rows that one copy of a pivot's text serves.
PART = 512
#: Bits of a prefix's and of a whole set's bitmap for each shingle that similar sets may differ in.
SPREAD, WHOLE = 8, 16
#: Characters that are cut into shingles at once, and signatures that are counted at once.
CHARS, COUNTED = 1 << 18, 1 << 19
#: Columns of a bit matrix that are multiplied at once.
COLUMNS = 4096

_U = np.uint64


def _sets(texts: list[str | None], k: int) -> Iterator[np.ndarray]:
    words, at = space_words(texts, lower=True)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        yield np.unique(shingles(words[a:b], k))


def _differ(total, num: int, den: int):
    """The most shingles that two similar sets with so many in all can differ in."""
    return (den - num) * total // (den + num)


def _hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


@lru_cache
def _classes(num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size classes: the least size of each (and of one more), the differences that its sets may have, its segments.

    A similar larger set lies in the same class or the next one, as the least sizes grow by (den / num)^2, and by more
    than den / num where they are small.
    """
    low = [1]
    while low[-1] < 1 << 31:
        low.append(max(low[-1] + 1, low[-1] * den * den // (num * num)))
    low = np.array(low, np.int64)
    most = _differ(2 * (low[1:] - 1), num, den)
    parts = most + 1.0
    for _ in range(8):  # so many more as are empty, and three times their deviation
        empty = parts * np.exp(-CUT * (low[1:] - 1) / parts)
        parts = most + 2 + empty + 3 * np.sqrt(empty)
    return low, most, parts.astype(np.int64)


class _Batch:
    """Sets of some texts: flat shingles and their rows, sizes, prefixes and segment signatures."""

    def __init__(self, texts: list[str | None], k: int, num: int, den: int):
        self.num, self.den = num, den
        self.sets = list(_sets(texts, k))
        self.n = np.fromiter(map(len, self.sets), np.int64, len(self.sets))
        flat = np.concatenate(self.sets) if self.sets else np.empty(0, _U)
        row = np.repeat(np.arange(len(self.n)), self.n)
        self.place = (flat >> _U(11)).astype(np.float64) * 2.0**-53 / CUT
        inside = self.place < 1
        self.every = flat, row
        self.flat, self.row, self.place = flat[inside], row[inside], self.place[inside]
        self.p = np.bincount(self.row, minlength=len(self.n))
        #: Two similar sets share one of so many first shingles.
        self.first = self.n + (-self.num * self.n) // self.den + 1

    def nodes(self) -> list[int]:
        return [_hash(s.tobytes()) for s in self.sets]

    def groups(self) -> list[int]:
        """A hash of prefix and size for each row."""
        return [_hash(s[: max(p, f)].tobytes() + len(s).to_bytes(8, "little")) for s, p, f in zip(self.sets, self.p.tolist(), self.first.tolist(), strict=True)]

    def signatures(self, frequent: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row, signature) of all rows; a row may have one twice. frequent: by bucket, whether its shingles are."""
        low, most, parts = _classes(self.num, self.den)
        own = np.searchsorted(low, self.n, "right") - 1
        rare = np.ones(len(self.flat), bool) if frequent is None else ~frequent[(self.flat & _U(SKETCH - 1)).astype(np.int64)]
        few = np.bincount(self.row[rare], minlength=len(self.n))
        rows, sigs = [np.empty(0, np.int64)], [np.empty(0, _U)]
        for step in (0, 1):
            cell = own + step
            use = (self.n > 0) & (most[cell] > 0)
            if step:
                use &= self.n * self.den >= low[cell] * self.num
            if not use.any():
                continue
            top = np.minimum(self.n * self.den // self.num, low[cell + 1] - 1)
            differ = _differ(self.n + top, self.num, self.den)
            filled = self._segments(use[self.row] & rare, cell, parts, rows, sigs)
            rest = use & (filled <= differ)
            if frequent is not None:
                self._first(rest, rare, differ + 1, cell, 3, rows, sigs)
                rest &= few <= differ
                # Segments without frequent shingles are there already.
                filled = self._segments(rest[self.row], cell, parts, rows, sigs, mixed=~rare)
            # Where empty segments could hide the equal one, the first shingles are offered as well.
            for i in np.flatnonzero(rest & (filled <= differ)).tolist():
                first = self.sets[i][: self.first[i]]
                rows.append(np.full(len(first), i))
                sigs.append(mix(first + _U((int(cell[i]) * 2 + 1) * 0xA0761D6478BD642F % 2**64)))
        return np.concatenate(rows), np.concatenate(sigs)

    def _segments(self, ok: np.ndarray, cell: np.ndarray, parts: np.ndarray, rows: list, sigs: list, mixed: np.ndarray | None = None) -> np.ndarray:
        """Adds the hashes of the segments of some shingles, only of segments that hold a `mixed` one if that is given; how
        many segments with any of the shingles each row has."""
        flat, row = self.flat[ok], self.row[ok]
        if not len(row):
            return np.zeros(len(self.n), np.int64)
        segment = (self.place[ok] * parts[cell][row]).astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (segment[1:] != segment[:-1])]))
        h = mix(np.add.reduceat(flat * _U(0x9E3779B97F4A7C15) ^ flat >> _U(29), starts))
        r, c = row[starts], cell[row[starts]]
        filled = np.bincount(r, minlength=len(self.n))
        sig = mix(h + (segment[starts] * 1_000_003 + c * 7_919 + 1).astype(_U) * _U(0xD6E8FEB86659FD93))
        if mixed is not None:
            keep = np.logical_or.reduceat(mixed[ok], starts)
            r, sig = r[keep], sig[keep]
        rows.append(r)
        sigs.append(sig)
        return filled

    def _first(self, use: np.ndarray, rare: np.ndarray, most: np.ndarray, cell: np.ndarray, kind: int, rows: list, sigs: list) -> None:
        """Adds the first `most` rare shingles of rows, each by itself."""
        ok = use[self.row] & rare
        flat, row = self.flat[ok], self.row[ok]
        before = np.searchsorted(row, np.arange(len(self.n)))
        keep = np.arange(len(row)) - before[row] < most[row]
        flat, row = flat[keep], row[keep]
        rows.append(row)
        sigs.append(mix(flat + (cell[row] * 4 + kind).astype(_U) * _U(0xA0761D6478BD642F)))

    def bitmaps(self, flat: np.ndarray, row: np.ndarray, spread: int) -> pa.Array:
        """Each row's bits: whether an odd number of its shingles has a value modulo the width."""
        width = _width(spread * ((self.den - self.num) * self.n // self.num))
        off = np.concatenate([[0], np.cumsum(width)])
        bits = np.bincount(off[row] + (flat & (width[row] - 1).astype(_U)).astype(np.int64), minlength=int(off[-1])) & 1
        data = np.packbits(bits.astype(np.uint8), bitorder="little")
        return pa.Array.from_buffers(pa.binary(), len(width), [None, pa.py_buffer((off // 8).astype(np.int32)), pa.py_buffer(data)])


def _width(bits: np.ndarray) -> np.ndarray:
    """The next power of two, 64 at least."""
    return np.left_shift(1, np.ceil(np.log2(np.maximum(64, bits))).astype(np.int64))


def _facts(k: int, num: int, den: int):
    """One row a text, and a partition's frequent buckets (bucket, times): of signatures as if no shingle were frequent,
    and, above SKETCH, of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, shingled = np.zeros(SKETCH, np.int64), [], np.zeros(SKETCH, np.int64)
        names = ["doc_id", "th", "n", "node", "grp", "p", "bits", "whole", "bucket", "times"]
        for batch in batches:
            for part, texts in slices(batch, chars=CHARS):
                b = _Batch(texts, k, num, den)
                held.append((b.signatures()[1] & _U(SKETCH - 1)).astype(np.int64))
                np.add.at(shingled, (b.flat & _U(SKETCH - 1)).astype(np.int64), 1)
                if sum(map(len, held)) >= COUNTED:
                    counts += np.bincount(np.concatenate(held), minlength=SKETCH)
                    held = []
                none = pa.nulls(len(b.n), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("th"), pa.array(b.n), pa.array(b.nodes(), pa.int64()), pa.array(b.groups(), pa.int64()), pa.array(b.p, pa.int64()), b.bitmaps(b.flat, b.row, SPREAD), b.bitmaps(*b.every, WHOLE), none, none], names=names)
        counts += np.bincount(np.concatenate([np.empty(0, np.int64), *held]), minlength=SKETCH)
        for n, base in ((counts, 0), (shingled, SKETCH)):
            mean = n.sum() / SKETCH
            top = np.flatnonzero(n >= mean + 4 * mean**0.5 + 4)
            none = pa.nulls(len(top), pa.int64())
            bits = pa.nulls(len(top), pa.binary())
            yield pa.RecordBatch.from_arrays([none, none, none, none, none, none, bits, bits, pa.array(top + base, pa.int64()), pa.array(n[top])], names=names)

    return run


def _signed(shared, k: int, num: int, den: int):
    """(sig, salt, grp): each group's signatures, once a partition. Frequent signatures have a salt above zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = np.zeros(SKETCH, np.int64)
        buckets, times, often = shared.value
        parts[buckets] = times // BLOCK + 1
        frequent = np.zeros(SKETCH, bool)
        frequent[often] = True
        seen: set[int] = set()
        for batch in batches:
            for _, texts in slices(batch, chars=CHARS):
                b = _Batch(texts, k, num, den)
                grp = b.groups()
                grp, fresh = np.array(grp, np.int64), np.zeros(len(grp), bool)
                for i, g in enumerate(grp.tolist()):
                    if g not in seen:
                        seen.add(g)
                        fresh[i] = True
                row, sigs = b.signatures(frequent if len(often) else None)
                row, sigs = row[fresh[row]], sigs[fresh[row]]
                own = parts[(sigs & _U(SKETCH - 1)).astype(np.int64)]
                spread = (mix(grp[row].view(_U) ^ _U(0x632BE59BD9B4E019)) % np.maximum(own, 1).astype(_U)).astype(np.int64)
                salt = np.where(own > 0, spread + 1, 0)
                yield pa.RecordBatch.from_arrays([pa.array(sigs.view(np.int64)), pa.array(salt, pa.int32()), pa.array(grp[row])], names=["sig", "salt", "grp"])

    return run


def _folded(bits: bytes, size: int) -> np.ndarray:
    return np.bitwise_xor.reduce(np.frombuffer(bits, np.uint64).reshape(-1, size // 8), axis=0)


def _near(num: int, den: int):
    """Pairs of groups that can hold similar sets, with a distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, p, q = (batch.column(c).to_numpy() for c in ("n", "m", "p", "q"))
            far = np.empty(len(n), np.int64)
            for i, (x, y) in enumerate(zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)):
                size = min(len(x), len(y))
                far[i] = int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum())
            far += np.abs((n - p) - (m - q))
            ok = (far <= _differ(n + m, num, den)) & (np.minimum(n, m) * den >= np.maximum(n, m) * num)
            yield pa.RecordBatch.from_arrays([batch.column("grp"), batch.column("pivot"), pa.array(far / (n + m))], names=["grp", "pivot", "far"]).filter(pa.array(ok))

    return run


def _similar(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    both = np.concatenate([x, y])
    both.sort()
    inter = int((both[1:] == both[:-1]).sum())
    return den * inter >= num * (len(both) - inter)


def _linked(k: int, num: int, den: int):
    """Keeps the pairs of texts (x, y) whose sets have a similarity of num / den at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, right in slices(batch, "y", CHARS):
                left = part.column("x").to_pylist()
                # A star's rows share their pivot's text: each different one is cut into shingles once.
                pivots = list(dict.fromkeys(left))
                own = dict(zip(pivots, _sets(pivots, k), strict=True))
                keep = [_similar(x, y, num, den) for x, y in zip((own[t] for t in left), _sets(right, k), strict=True)]
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _hamming(bits: list[bytes]) -> np.ndarray:
    """Of each pair, the places where two bitmaps differ: a lower bound of the shingles that only one of two sets has."""
    size = min(map(len, bits))
    packed = np.stack([_folded(x, size) for x in bits]).view(np.uint8)
    far = np.zeros((len(bits), len(bits)), np.float32)
    for lo in range(0, size, COLUMNS // 8):
        m = np.unpackbits(packed[:, lo : lo + COLUMNS // 8], axis=1).astype(np.float32)
        ones = m.sum(axis=1)
        far += ones[:, None] + ones[None, :] - 2 * (m @ m.T)
    return far.astype(np.int64)


def _group_distances(cols: dict) -> np.ndarray:
    """Lower bounds by prefixes, computed for pairs of groups and then spread to their members."""
    _, first, of = np.unique(cols["grp"], return_index=True, return_inverse=True)
    rest = (cols["n"] - cols["p"])[first]
    far = _hamming([cols["bits"][i] for i in first.tolist()]) + np.abs(rest[:, None] - rest[None, :])
    return far[of][:, of]


def _open_pairs(cols: dict, far: np.ndarray, num: int, den: int) -> np.ndarray:
    """Pairs (i < j) of a tile that may be similar, by distances at least `far`, and lie in different components."""
    n, side, label = cols["n"], cols["side"], cols["label"]
    ok = (far <= _differ(n[:, None] + n[None, :], num, den)) & (np.minimum(n[:, None], n[None, :]) * den >= np.maximum(n[:, None], n[None, :]) * num)
    ok &= label[:, None] != label[None, :]
    if side.max() > 0:
        ok &= side[:, None] != side[None, :]
    return np.triu(ok, 1)


def _by_tile(work: Callable[[dict], dict], names: list[str]):
    """work on each run of rows of one tile; rows come sorted by tile."""

    def columns(table: pa.Table) -> dict:
        return {c: table.column(c).to_pylist() if c in ("bits", "whole", "text") else table.column(c).to_numpy() for c in table.column_names}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        def done(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = work(columns(pa.Table.from_batches(parts)))
            if len(out[names[0]]):
                yield pa.RecordBatch.from_pydict({c: out[c] for c in names})

        for batch in batches:
            if not batch.num_rows:
                continue
            tile = batch.column("tile").to_numpy()
            cuts = [0, *(np.flatnonzero(tile[1:] != tile[:-1]) + 1).tolist(), len(tile)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if held and tile[a] != last:
                    yield from done(held)
                    held = []
                held.append(batch.slice(a, b - a))
                last = tile[a]
        if held:
            yield from done(held)
        release_memory()

    return run


KEPT = ["tile", "node", "n", "label", "side"]
FACTS = [*KEPT, "grp", "p", "bits"]


def _candidates(num: int, den: int, whole: bool):
    """The rows of a tile that are in an open pair, by prefixes or by whole sets."""

    def work(cols: dict) -> dict:
        ok = _open_pairs(cols, _hamming(cols["whole"]) if whole else _group_distances(cols), num, den)
        use = np.flatnonzero(ok.any(axis=0) | ok.any(axis=1))
        out = {c: pa.array(cols[c][use]) for c in KEPT}
        return out | ({"whole": pa.array([cols["whole"][i] for i in use.tolist()], pa.binary())} if whole else {})

    return _by_tile(work, [*KEPT, "whole"] if whole else KEPT)


class _Union:
    def __init__(self) -> None:
        self.root: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = self.root
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    def join(self, x: int, y: int) -> None:
        u, v = self.find(x), self.find(y)
        self.root[max(u, v)] = min(u, v)


def _connecting(num: int, den: int, check: Callable[[dict], Callable[[int, int], bool]], names: dict[str, str]):
    """Pairs that connect a tile's components, nearest first, each checked before it counts; as columns out of both rows."""

    def work(cols: dict) -> dict:
        far = _hamming(cols["whole"])
        i, j = np.nonzero(_open_pairs(cols, far, num, den))
        order = np.lexsort((cols["node"][j], cols["node"][i], far[i, j]))
        label, union, good, x_y = cols["label"].tolist(), _Union(), check(cols), []
        for x, y in zip(i[order].tolist(), j[order].tolist(), strict=True):
            if union.find(label[x]) != union.find(label[y]) and good(x, y):
                union.join(label[x], label[y])
                x_y.append((x, y))
        at = np.array(x_y, np.int64).reshape(-1, 2)
        return {name: pa.array(cols[c][at[:, 0 if name.endswith("a") else 1]], pa.int64()) for name, c in names.items()}

    return _by_tile(work, list(names))


def _forest(num: int, den: int):
    """The pairs (a, b) of nodes, with their labels, that would connect a tile's components if they are similar."""
    return _connecting(num, den, lambda cols: lambda x, y: True, {"a": "node", "b": "node", "la": "label", "lb": "label"})


def _tile_links(k: int, num: int, den: int):
    """Verified links (a, b) between a tile's components."""

    def check(cols: dict) -> Callable[[int, int], bool]:
        sets = list(_sets(cols["text"], k))
        return lambda x, y: _similar(sets[x], sets[y], num, den)

    return _connecting(num, den, check, {"a": "label", "b": "label"})


def _verified(chosen: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The links (a, b) among rows (node, pivot, text) and their pivots. A pivot of many rows has its text copied to as
    many parts (own_copies), and its rows are dealt to them (copies)."""
    left = chosen.where("own_copies > 0").select(F.col("node").alias("a"), F.col("text").alias("x"), F.explode(F.sequence(F.lit(0), F.col("own_copies") - 1)).alias("salt"))
    right = chosen.where("copies > 0").select(F.col("pivot").alias("a"), F.col("node").alias("b"), F.col("text").alias("y"), F.pmod(F.xxhash64("node"), F.col("copies")).cast("int").alias("salt"))
    return right.join(left, ["a", "salt"]).select("a", "b", "x", "y").mapInArrow(_linked(k, num, den), "a long, b long")


class _Join:
    """The nodes and components of docs: `every` has a row for each document, `labels` the nodes that have links."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, k: int, threshold: tuple[int, int], *, without_id: bool):
        spark, (num, den) = docs.sparkSession, threshold
        self.how, self.without_id = (k, num, den), without_id
        texts = id_text(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))
        both = written(texts.mapInArrow(_facts(k, num, den), "doc_id long, th long, n long, node long, grp long, p long, bits binary, whole binary, bucket long, times long"), "sets")
        self.every = both.where("bucket is null").select("doc_id", "th", "n", "node", "grp", "p", "bits", "whole")
        counts = both.where("bucket is not null").groupBy("bucket").agg(F.sum("times").alias("times")).orderBy(F.desc("times"), "bucket")
        top, often = counts.where(F.col("bucket") < SKETCH).limit(FREQUENT).collect(), counts.where((F.col("bucket") >= SKETCH) & (F.col("times") >= RARE)).limit(FREQUENT).collect()
        shared = spark.sparkContext.broadcast((np.array([r.bucket for r in top], np.int64), np.array([r.times for r in top], np.int64), np.array([r.bucket - SKETCH for r in often], np.int64)))
        self.full = self.every.where("n > 0" if without_id else "n > 0 and doc_id is not null")
        self.texts = texts if without_id else texts.where("doc_id is not null")

        # Equal sets are one node; nodes of one prefix and size are one group, led by the least of them.
        at = F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("o"), "doc_id", "th", "n", "grp", "p", "bits")).alias("at")
        nodes = written(self.full.groupBy("node").agg(at).select("node", "at.doc_id", "at.th", "at.n", "at.grp", "at.p", "at.bits"), "nodes")
        leads = nodes.groupBy("grp").agg(F.min("node").alias("lead"), F.count("*").alias("members"))
        # Different sets of one size differ in two shingles at least.
        loose = nodes.join(leads.where("members > 1"), "grp").where((den - num) * 2 * F.col("n") >= 2 * (den + num)).select("node", "grp", "lead")
        loose = written(loose, "loose")

        blocks = self._blocks(shared)
        stars = written(self._stars(blocks, nodes, leads).union(loose.where("node != lead").select("node", F.col("lead").alias("pivot"))), "stars")
        known = self._repeated_ids()
        links = self._star_links(stars, nodes)
        label = written(components(links if known is None else links.union(known)), "labels")
        rest = self._rest(blocks, loose, nodes, label)
        joined = written(components(rest), "joined")
        self.labels = label.join(joined.toDF("label", "last"), "label", "left").select("node", F.coalesce("last", "label").alias("label"))
        self.labels = written(self.labels.union(joined.join(label.select("node"), "node", "left_anti")), "components")
        removed(nodes, loose, blocks, stars, links, label, rest, joined)

    def _blocks(self, shared) -> DataFrame:
        """(sig, grp, pivot): groups that share a signature with another one; a frequent signature has several pivots."""
        signed = self.texts.select("text").mapInArrow(_signed(shared, *self.how), "sig long, salt int, grp long")
        block = Window.partitionBy("sig", "salt")
        seen = signed.withColumns({"pivot": F.min("grp").over(block), "last": F.max("grp").over(block)})
        return written(seen.where("pivot != last or salt > 0").select("sig", "salt", "grp", "pivot").distinct(), "blocks")

    def _stars(self, blocks: DataFrame, nodes: DataFrame, leads: DataFrame) -> DataFrame:
        """(node, pivot): of the pivots that a group meets and that pass the filter of group pairs, the nearest."""
        _, num, den = self.how
        pivots = blocks.where("salt > 0").select("sig", "pivot").distinct()
        tops = pivots.groupBy("sig").agg(F.min("pivot").alias("top"))
        pairs = blocks.select("grp", "pivot").union(pivots.join(tops, "sig").select(F.col("pivot").alias("grp"), F.col("top").alias("pivot")))
        pairs = pairs.where("grp != pivot").distinct()
        facts = nodes.join(leads.select(F.col("lead").alias("node"), "grp"), ["node", "grp"], "left_semi")
        own = facts.select("grp", "n", "p", F.col("bits").alias("x"))
        other = facts.select(F.col("grp").alias("pivot"), F.col("n").alias("m"), F.col("p").alias("q"), F.col("bits").alias("y"))
        near = pairs.join(own, "grp").join(other, "pivot").mapInArrow(_near(num, den), "grp long, pivot long, far double")
        best = near.groupBy("grp").agg(F.min_by("pivot", F.struct("far", "pivot")).alias("pivot"))
        lead = leads.select("grp", F.col("lead").alias("node"))
        return best.join(lead, "grp").join(lead.toDF("pivot", "top"), "pivot").select("node", F.col("top").alias("pivot"))

    def _star_links(self, stars: DataFrame, nodes: DataFrame) -> DataFrame:
        copies = stars.groupBy("pivot").agg(F.ceil(F.count("*") / PART).cast("int").alias("copies"))
        wanted = stars.join(copies, "pivot").withColumnRenamed("copies", "n").join(copies.toDF("node", "own"), "node", "full_outer")
        wanted = wanted.select("node", "pivot", F.col("n").alias("copies"), F.col("own").alias("own_copies"))
        chosen = written(self._with(wanted, nodes, self.texts, "text"), "texts")
        links = written(_verified(chosen, *self.how), "verified")
        removed(chosen)
        return links

    def _with(self, wanted: DataFrame, nodes: DataFrame, rows: DataFrame, column: str) -> DataFrame:
        """wanted with a column of its nodes' rows, such as the text."""
        named = wanted.select("node").distinct().join(nodes.select("node", F.col("doc_id").alias("of"), F.col("th").alias("hash")), "node")
        # A short list goes to where the rows are; a longer one meets them in a shuffle.
        named = written(named, "named")
        at = F.broadcast(named) if named.count() <= SHORT else named
        found = rows.select("doc_id", "th", column).join(at, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("th") == F.col("hash"))).select("node", column)
        if self.repeats:
            found = found.dropDuplicates(["node"])
        return wanted.join(found, "node")

    def _repeated_ids(self) -> DataFrame | None:
        """Links between the nodes of rows that repeat a doc_id; also notes if there are such rows."""
        self.repeats = not self.full.groupBy("doc_id").count().where("count > 1").isEmpty()
        if self.without_id or not self.repeats:
            return None
        per = self.full.where("doc_id is not null").groupBy("doc_id").agg(F.min("node").alias("a"))
        return self.full.join(per, "doc_id").select("a", F.col("node").alias("b")).where("a != b").distinct()

    def _rest(self, blocks: DataFrame, loose: DataFrame, nodes: DataFrame, label: DataFrame) -> DataFrame:
        """Links (a, b) between labels that lie in one block or group without being connected."""
        k, num, den = self.how
        labels = label.select("node", F.col("label").alias("l"))
        member = nodes.join(labels, "node", "left").select("node", "grp", "n", "p", "bits", F.coalesce("l", "node").alias("label"))
        shares = blocks.select("sig", "grp").distinct().join(member.select("grp", "node", "label"), "grp").select("sig", "grp", "node", "label")
        within = loose.join(labels, "node", "left").select(F.col("grp").alias("sig"), "grp", "node", F.coalesce("l", "node").alias("label"))
        shares = shares.union(within)
        mixed = shares.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"), F.count("*").alias("m")).where("lo != hi")
        once = mixed.groupBy("x", "y", "m").agg(F.min("sig").alias("sig"))  # blocks of the same nodes count once
        parts = once.select("sig", F.ceil(F.col("m") / TILE).cast("int").alias("parts"))
        dealt = shares.join(parts, "sig").withColumn("part", F.pmod(F.xxhash64("node", "sig"), F.col("parts")).cast("int"))
        here = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least("part", o).alias("i"), F.greatest("part", o).alias("j"), F.when(F.col("part") > o, 1).otherwise(0).alias("side"), (o != F.col("part")).alias("two")))
        tiles = dealt.select("sig", "node", F.explode(here).alias("t")).select(F.xxhash64("sig", "t.i", "t.j").alias("tile"), "node", F.when(F.col("t.two"), F.col("t.side") + 1).otherwise(0).cast("int").alias("side"))
        facts = tiles.join(member, "node").select(*FACTS)
        found = written(_sorted(facts).mapInArrow(_candidates(num, den, False), "tile long, node long, n long, label long, side int"), "groups")
        types = "tile long, node long, n long, label long, side int, whole binary"
        found, before = written(_sorted(self._with(found, nodes, self.every, "whole")).mapInArrow(_candidates(num, den, True), types), "members"), found
        removed(before)

        pairs = _sorted(found).mapInArrow(_forest(num, den), "a long, b long, la long, lb long").distinct()
        pairs = written(pairs, "pairs")
        texts = written(self._with(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), nodes, self.texts, "text"), "texts")
        both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
        links = written(both.select(F.col("la").alias("a"), F.col("lb").alias("b"), "x", "y").mapInArrow(_linked(k, num, den), "a long, b long"), "verified")

        # What is open after these links is verified within its tiles.
        joined = written(components(links), "joined")
        again = found.join(joined.toDF("label", "last"), "label", "left").withColumn("label", F.coalesce("last", "label")).select(*KEPT, "whole")
        left = written(_sorted(again).mapInArrow(_candidates(num, den, True), types), "open")
        more = written(_sorted(self._with(left, nodes, self.texts, "text")).mapInArrow(_tile_links(k, num, den), "a long, b long"), "more")
        every = written(links.union(more), "rest")
        removed(found, pairs, texts, links, joined, left, more)
        return every

    def labelled(self) -> DataFrame:
        """doc_id, th and label of every row with words; the label of a node without links is its own."""
        of = self.full.select("doc_id", "th", "node").join(self.labels.select("node", F.col("label").alias("l")), "node", "left")
        return of.select("doc_id", "th", F.coalesce("l", "node").alias("label"))


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition("tile").sortWithinPartitions("tile")


def similar_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 3, threshold: tuple[int, int] = (90, 100)) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every document."""
    join = _Join(docs, id_col, text_col, k, threshold, without_id=False)
    of = join.labelled()
    least = of.groupBy("label").agg(F.min("doc_id").alias("least"))
    ids = of.join(least, "label").groupBy("doc_id").agg(F.min("least").alias("least"))
    return join.every.select("doc_id", F.col("n").alias("n_shingles")).join(ids, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def distinct_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """One row of each component, all columns kept: that with the smallest doc_id (null last), of those the one with the
    least hash of its text, of equal ones any. Each row is a document of its own, also where a doc_id is repeated or
    missing. Rows without words stay. Columns may have any names."""
    own, names = renamed_apart(docs, "__id", "__th", "__gone", "__hash")
    return with_names(_distinct(own, names[id_col], names[text_col], k, threshold), names)


def _distinct(docs: DataFrame, id_col: str, text_col: str, k: int, threshold: tuple[int, int]) -> DataFrame:
    join = _Join(docs, id_col, text_col, k, threshold, without_id=True)
    of = join.labelled()
    best = of.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("o"), "doc_id", "th")).alias("best"))
    other = ~F.col("doc_id").eqNullSafe(F.col("best.doc_id")) | (F.col("th") != F.col("best.th"))
    gone = of.join(best, "label").where(other).select(F.col("doc_id").alias("__gone"), F.col("th").alias("__hash")).distinct()
    own_id, own_hash = docs[id_col].cast("long"), F.xxhash64(docs[text_col].cast("string"))
    kept = docs.join(gone, own_id.eqNullSafe(F.col("__gone")) & (own_hash == F.col("__hash")), "left_anti")
    if not join.repeats:
        return kept
    keyed = kept.withColumns({"__id": F.col(id_col).cast("long"), "__th": F.xxhash64(F.col(text_col).cast("string"))})
    twice = join.full.groupBy("doc_id", "th").count().where("count > 1").select(F.col("doc_id").alias("__gone"), F.col("th").alias("__hash"))
    same = F.col("__id").eqNullSafe(F.col("__gone")) & (F.col("__th") == F.col("__hash"))
    once = keyed.join(twice, same, "left_semi").dropDuplicates(["__id", "__th"])
    return keyed.join(twice, same, "left_anti").union(once).drop("__id", "__th")
