"""One-to-one fuzzy title join by descending similarity levels.

1. Equal titles are paired first, by rank within the title.
2. Of the rest, titles can only reach a similarity if their lengths are close and they share enough characters. Rows meet in
   tiles: those of a block and length bucket are dealt to tiles of about `tile` rows a side, or larger ones where there would
   be many, so a hot block is many tasks and a row is copied few times. A tile bounds all its pairs at once by bits that say
   how often they have which characters, those that pass by their counts of characters, then, long ones, by their runs of
   equal characters and by their longest common subsequence, scores what is left, and gives the pairs that reach the similarity.
3. The choice is greedy over all pairs: by level, then left row, then score, then right title (the last in order), then
   right row. It runs in rounds over the whole table of pairs: a pair that is the best open one of both its rows is final,
   and the pairs of matched rows go. That is the greedy choice, whatever the number of rounds. When few pairs are left
   (FINISH) or a round settles little, each connected component of them is finished by a pass over its sorted pairs, which
   holds the rows it has used and nothing else.

`bands` are similarities, descending to the least: rows matched at or above one are gone before candidates for the next
are made, which changes nothing in the result, as pairs of a level never depend on those of lower ones.

Blocks (such as conference and year) bound the join: rows of different blocks never match. Rows with a null block or a
null or blank title match nothing; rows of equal titles are told apart by ix; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.operators.components import connected
from foliant.operators.scans import numbered_within
from foliant.storage import discard, stored

#: Rows of a side that meet in one tile, about, where all tiles are few. A tile's two sides are copied for each other tile of
#: their row and column, so that larger tables have larger tiles, about TILES in all, of up to MOST rows and characters a side.
TILE, TILES, MOST = 1024, 256, (1 << 16, 1 << 22)
#: Length buckets of blocks up to which their numbers of tiles are broadcast.
BUCKETS = 200_000
#: Pairs of a tile that are held for the second bound, those that the first compares in one step, and its words of bits.
STEP, CACHED, WORDS = 1 << 17, 1 << 15, 3
#: Classes of characters that are counted; characters of one class are not told apart, which only weakens the bound.
CLASSES = 96
#: Lengths of left and right titles up to which common subsequences are looked for, and pairs of one step.
LONGEST, PAIRS = (1024, 2048), 1 << 12
#: Open pairs up to which the choice is finished without further rounds, and the part of its pairs that a round has to settle.
FINISH, LITTLE = 200_000, 0.05


def _bucket(least: float) -> Column:
    """Geometric buckets of a title's length: titles within the band of one another are at most one bucket apart."""
    step = math.log((2 - least) / least)  # the ratio of lengths within the band is (2 - least) / least at most
    size = F.greatest(F.length("title"), F.lit(1))
    return F.floor(F.log(size.cast("double")) / (step * 1.000001)) if step > 0 else size.cast("bigint")


def length_band(left: DataFrame, right: DataFrame, least: float = 0.71) -> DataFrame:
    """Candidate pairs whose lengths allow the similarity: 2 * min / (la + lb) >= least.

    left, right: block, ix, title. Each right title goes to the geometric length buckets that its partners can be in.
    """
    bucket = _bucket(least)
    a = left.select("block", F.col("ix").alias("left_ix"), F.col("title").alias("left_title"), bucket.alias("b"))
    b = right.select("block", F.col("ix").alias("right_ix"), F.col("title").alias("right_title"), F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("b"))
    la, lb = F.length("left_title"), F.length("right_title")
    return a.join(b, ["block", "b"]).where(F.least(la, lb) * 2 >= F.lit(least) * (la + lb)).drop("b")


def band_links(left: DataFrame, right: DataFrame, least: float = 0.71) -> DataFrame:
    """The candidates of length_band() without their pairs, a row for each title of both sides: block, ix, class_ix, n_links,
    shortest and longest.

    Titles of a side, block and length are a class, named by its smallest ix. A title's candidates are the n_links titles of
    the other side whose length is from shortest to longest. Without a block or title there is no class and no link.
    """

    def classes(df: DataFrame) -> DataFrame:
        known = df.where(F.col("block").isNotNull() & F.col("title").isNotNull())
        return known.groupBy("block", F.length("title").alias("size")).agg(F.min("ix").alias("ix"), F.count("*").alias("n"), F.min_by("title", "ix").alias("title"))

    a, b = classes(left), classes(right)
    pairs = length_band(a, b, least).select("block", "left_ix", "right_ix", F.length("left_title").alias("left_size"), F.length("right_title").alias("right_size"))
    out = []
    for df, own, other, one, two in ((left, a, b, "left", "right"), (right, b, a, "right", "left")):
        met = pairs.join(other.select("block", F.col("ix").alias(f"{two}_ix"), "n"), ["block", f"{two}_ix"])
        links = met.groupBy("block", F.col(f"{one}_size").alias("size")).agg(F.sum("n").alias("n_links"), F.min(f"{two}_size").alias("shortest"), F.max(f"{two}_size").alias("longest"))
        named = own.select("block", "size", F.col("ix").alias("class_ix")).join(links, ["block", "size"], "left")
        out.append(df.select("block", "ix", F.length("title").alias("size")).join(named, ["block", "size"], "left"))
    return out[0].unionByName(out[1]).select("block", "ix", "class_ix", F.coalesce("n_links", F.lit(0)).alias("n_links"), "shortest", "longest")


# --- candidates -------------------------------------------------------------------------------------------------------


class Coded(NamedTuple):
    """Titles as classes of characters, one after the other: all classes, where each title begins, and the titles' lengths."""

    codes: np.ndarray
    start: np.ndarray
    size: np.ndarray


def coded(titles: list[str]) -> Coded:
    size = np.fromiter(map(len, titles), np.int64, len(titles))
    codes = (np.frombuffer("".join(titles).encode("utf-32-le"), np.uint32) % CLASSES).astype(np.uint8)
    return Coded(codes, np.cumsum(size) - size, size)


def counted(texts: Coded, kind: type) -> np.ndarray:
    """Counts of each class of characters, those that kind can't hold as its largest number."""
    out = np.empty((len(texts.size), CLASSES), kind)
    for begin in range(0, len(out), 4096):
        size, start = texts.size[begin : begin + 4096], texts.start[begin : begin + 4096]
        at = np.repeat(np.arange(len(size)) * CLASSES, size)
        at += texts.codes[start[0] : start[-1] + size[-1]]
        out[begin : begin + len(size)] = np.minimum(np.bincount(at, minlength=len(size) * CLASSES), np.iinfo(kind).max).reshape(-1, CLASSES)
    return out


def common_subsequences(left: Coded | list[str], right: Coded | list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of pairs of titles, by classes of characters, all pairs in step.

    Each left title is a row of bits a class; a row of set bits for each pair loses one with every longer match. Pairs of a
    left title are close together, so that the rows of bits of a step's titles are few.
    """
    left, right = (x if isinstance(x, Coded) else coded(x) for x in (left, right))
    out = np.zeros(len(i), np.int64)
    needed = -(-left.size[i] // 64)
    for w in np.unique(needed[right.size[j] > 0]).tolist():
        own = np.flatnonzero((needed == w) & (right.size[j] > 0))
        own = own[np.argsort(i[own], kind="stable")]
        step = PAIRS if w <= 4 else PAIRS // 4
        for begin in range(0, len(own) if w else 0, step):
            pairs = own[begin : begin + step]
            pairs = pairs[np.argsort(-right.size[j[pairs]], kind="stable")]
            some, a = np.unique(i[pairs], return_inverse=True)
            size, length = left.size[some], right.size[j[pairs]]
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            at = np.repeat(np.arange(len(some)) * CLASSES, size) + left.codes[np.repeat(left.start[some], size) + place]
            flat = np.zeros(len(some) * CLASSES * w, np.uint64)
            np.bitwise_or.at(flat, at * w + place // 64, np.uint64(1) << (place % 64).astype(np.uint64))
            first, begins = a * CLASSES, right.start[j[pairs]]
            on = np.searchsorted(-length, -np.arange(length[0]), side="left").tolist()  # pairs whose right title goes on
            bits = np.full((w, len(pairs)), np.uint64(0xFFFFFFFFFFFFFFFF))
            hits, totals = np.empty(len(pairs), np.uint64), np.empty(len(pairs), np.uint64)
            for p, m in enumerate(on):
                at = first[:m] + right.codes.take(begins[:m] + p)
                if w == 1:
                    x, hit, total = bits[0, :m], hits[:m], totals[:m]
                    flat.take(at, mode="clip", out=hit)
                    hit &= x
                    np.add(x, hit, out=total)
                    np.subtract(x, hit, out=x)
                    x |= total
                    continue
                at *= w
                carry = None
                for k in range(w):
                    x, hit, total = bits[k, :m], hits[:m], totals[:m]
                    flat.take(at, mode="clip", out=hit)
                    hit &= x
                    np.add(x, hit, out=total)
                    over = total < x if k + 1 < w else None
                    if carry is not None:
                        total += carry
                        if over is not None:
                            over |= total < carry
                    carry = over
                    np.subtract(x, hit, out=x)
                    x |= total
                    at += 1
            for k in range(w):
                inside = np.clip(size[a] - 64 * k, 0, 64)
                mask = np.where(inside == 64, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (inside % 64).astype(np.uint64)) - np.uint64(1))
                out[pairs] += np.bitwise_count(~bits[k] & mask)
    return out


def _signatures(ca: np.ndarray, la: np.ndarray, cb: np.ndarray, lb: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of bits of left and right titles: a bit says that a title has a class of characters more than so many times.

    The bits that tell most titles apart are taken, and as many words of them as make the bound of some pairs cheapest.
    """
    few = [np.linspace(0, len(c) - 1, min(len(c), 192)).astype(int) for c in (ca, cb)]
    level = np.arange(min(128, max(int(ca[few[0]].max(initial=0)), int(cb[few[1]].max(initial=0)), 1)))
    has = [c[k][:, :, None] > level for c, k in zip((ca, cb), few, strict=True)]
    p, q = (x.mean(0).ravel() for x in has)
    told = p * (1 - q) + q * (1 - p)
    best = np.argsort(-told, kind="stable")[: 64 * WORDS]
    best = best[: max(1, int((told[best] > 0).sum()))]
    x, y = (h.reshape(len(h), -1)[:, best].astype(np.float32) for h in has)
    size, other = la[few[0]][:, None], lb[few[1]][None, :]
    spare = np.minimum(size, other) - np.ceil((least * (size + other) - 1e-9) / 2)
    cost = []
    for words in range(1, -(-len(best) // 64) + 1):
        u, v = x[:, : 64 * words], y[:, : 64 * words]
        both = u @ v.T
        apart = np.where(size <= other, u.sum(1)[:, None] - both, v.sum(1)[None, :] - both)
        cost.append(words + 80 * ((apart <= spare) & (spare >= 0)).sum() / max(1, (spare >= 0).sum()))
    words = 1 + int(np.argmin(cost))
    out = []
    for c in (ca, cb):
        bits = np.zeros((words, len(c)), np.uint64)
        for n, at in enumerate(best[: 64 * words].tolist()):
            bits[n // 64] |= (c[:, at // len(level)] > at % len(level)).astype(np.uint64) << np.uint64(n % 64)
        out.append(bits)
    return out[0], out[1]


def _apart(ca: np.ndarray, la: np.ndarray, cb: np.ndarray, lb: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs whose shorter title hasn't more bits that the longer one lacks than it can have characters without a partner,
    about STEP of them at a time. Titles meet by lengths, so that pairs beyond the band cost nothing."""
    by_left, by_right = np.argsort(la, kind="stable"), np.argsort(lb, kind="stable")
    a, b = _signatures(ca, la, cb, lb, least)
    a, b = np.ascontiguousarray(a[:, by_left]), np.ascontiguousarray(b[:, by_right])
    sides, length = ((~a, b), (a, ~b)), lb[by_right]
    sizes, begins = np.unique(la[by_left], return_index=True)
    cells, counts, more, fits = (np.empty(CACHED, t) for t in (np.uint64, np.uint8, np.uint8, bool))
    found, n = [], 0
    for size, begin, end in zip(sizes.tolist(), begins.tolist(), [*begins[1:].tolist(), len(la)], strict=True):
        spare = np.minimum(size, length) - np.ceil((least * (size + length) - 1e-9) / 2)
        near = np.flatnonzero(spare >= 0)
        if not len(near):
            continue
        spare, middle = np.clip(spare, 0, 255).astype(np.uint8), int(np.searchsorted(length, size))
        for (own, other), lo, hi in ((sides[0], near[0], min(middle, near[-1] + 1)), (sides[1], max(middle, near[0]), near[-1] + 1)):
            for column in range(lo, hi, CACHED // 4):
                width = min(CACHED // 4, hi - column)
                rows = min(CACHED // width, end - begin)
                for row in range(begin, end, rows):
                    m = min(rows, end - row)
                    cell, count, extra, fit = (x[: m * width].reshape(m, width) for x in (cells, counts, more, fits))
                    for k in range(len(own)):
                        np.bitwise_and(own[k, row : row + m, None], other[k, column : column + width], out=cell)
                        np.bitwise_count(cell, out=extra if k else count)
                        if k:
                            count += extra
                    np.less_equal(count, spare[column : column + width], out=fit)
                    if fit.any():
                        x, y = np.divmod(np.flatnonzero(fit), width)
                        found.append((by_left[x + row], by_right[y + column]))
                        n += len(x)
                    if n >= STEP:
                        yield tuple(map(np.concatenate, zip(*found, strict=True)))
                        found, n = [], 0
    if found:
        yield tuple(map(np.concatenate, zip(*found, strict=True)))


def _common(left: Coded, right: Coded, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of which twice the common characters are at least `least` of both lengths.

    Counts are kept in the least type that holds what two titles can share.
    """
    la, lb = left.size, right.size
    top = min(int(la.max(initial=0)), int(lb.max(initial=0)))
    kind = np.uint8 if top < 256 else np.uint16 if top < 65536 else np.int32
    ca, cb = counted(left, kind), counted(right, kind)
    used = np.flatnonzero(ca.any(0) | cb.any(0))
    ca, cb = np.ascontiguousarray(ca[:, used]), np.ascontiguousarray(cb[:, used])
    for i, j in _apart(ca, la, cb, lb, least):
        keep = np.empty(len(i), bool)
        for begin in range(0, len(i), PAIRS):
            x, y = i[begin : begin + PAIRS], j[begin : begin + PAIRS]
            common = np.minimum(ca[x], cb[y]).sum(1, dtype=np.uint16 if kind == np.uint8 else np.int64)
            keep[begin : begin + PAIRS] = 2 * common.astype(np.int64) >= least * (la[x] + lb[y]) - 1e-9
        yield i[keep], j[keep]


def _runs(left: list[str], a: Coded, b: Coded, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """At least the characters that SequenceMatcher matches, of pairs whose left titles have 200 characters or more.

    From that length on it begins a match only at characters that are not popular in the left title, or else at the beginning
    of both titles, and stretches it as far as the titles are equal. So it finds no more than the longest run of each of those
    places together. i is sorted.
    """
    out = np.zeros(len(i), np.int64)
    cuts = np.flatnonzero(np.diff(i, prepend=-1, append=-1)).tolist() if len(i) else []
    for begin, end in zip(cuts, cuts[1:], strict=False):
        n = int(i[begin])
        title, codes = left[n], a.codes[a.start[n] : a.start[n] + a.size[n]]
        popular = len(title) // 100 + 1
        rare = {c for c, k in Counter(title).items() if k <= popular}
        place = np.fromiter((k for k, c in enumerate(title) if c in rare), np.int64)
        place = place[np.argsort(codes[place], kind="stable")]
        first = np.searchsorted(codes[place], np.arange(CLASSES + 1))
        own = np.concatenate([[254], codes, [254]])  # ends differ from all classes and from one another
        at = 0
        while begin + at < end:
            size, lo = b.size[j[begin + at : end]], begin + at
            step = max(1, int(np.searchsorted(np.cumsum(size), PAIRS * 4)))
            size, start = size[:step], b.start[j[lo : lo + step]]
            at += step
            ends = np.cumsum(size + 1)
            other = np.full(ends[-1] + 1, 255)
            text = np.repeat(np.arange(len(size)), size)
            inside = np.arange(size.sum()) + text + 1
            other[inside] = found = b.codes[np.arange(len(text)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)]
            times = first[found + 1] - first[found]
            y, pair, of = np.repeat(inside, times), np.repeat(text, times), np.repeat(first[found], times)
            of += np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
            x = place[of] + 1
            # The beginnings of both titles are one place more.
            x, y = np.append(x, np.ones(len(size), np.int64)), np.append(y, ends - size)
            pair, of = np.append(pair, np.arange(len(size))), np.append(of, np.full(len(size), len(place)))
            run = np.zeros(len(x), np.int64)
            for way in (1, -1):
                on, p, q = np.arange(len(x)), x - (way < 0), y - (way < 0)
                while len(on):
                    same = own[p] == other[q]
                    on, p, q = on[same], p[same] + way, q[same] + way
                    run[on] += 1
            longest = np.zeros((len(size), len(place) + 1), np.int64)
            np.maximum.at(longest, (pair, of), run)
            out[lo : lo + step] = longest.sum(1)
    return out


def _reached(a: Coded, b: Coded, i: np.ndarray, j: np.ndarray, some: np.ndarray, most: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs without those of `some` of which `most` common characters are too few."""
    keep = ~some
    keep[some] = 2 * most >= least * (a.size[i[some]] + b.size[j[some]]) - 1e-9
    return i[keep], j[keep]


def candidates(left: list[str], right: list[str], least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of which twice the common characters, counted with repeats, are at least `least` of both lengths, and
    so are, but for long titles, twice those that are common in order and, from 200 characters on, twice those of all runs.

    Matching blocks hold common characters in the order of both titles, so no pair that reaches the similarity is left out.
    """
    a, b = coded(left), coded(right)
    for i, j in _common(a, b, least):
        own = np.argsort(i, kind="stable")
        i, j = i[own], j[own]
        some = a.size[i] >= 200
        most = _runs(left, a, b, i[some], j[some])
        i, j = _reached(a, b, i, j, some, most, least)
        some = (a.size[i] <= LONGEST[0]) & (b.size[j] <= LONGEST[1])
        most = common_subsequences(a, b, i[some], j[some])
        yield _reached(a, b, i, j, some, most, least)


def _level(score: float) -> int:
    """The largest number of hundredths that the score reaches."""
    c = int(score * 100) + 1
    while score < c / 100:
        c -= 1
    return c


_PAIR = "block string, left_ix bigint, right_ix bigint, right_title string, score double, level int"


def _tile_scores(least: float):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        a, b = left["title"].tolist(), right["title"].tolist()
        left_ix, right_ix = left["ix"].tolist(), right["ix"].tolist()
        matcher = SequenceMatcher()
        for rows, columns in candidates(a, b, least) if a and b else ():
            last = -1
            for i, j in zip(rows.tolist(), columns.tolist(), strict=True):
                if i != last:
                    matcher.set_seq2(a[i])
                    last = i
                matcher.set_seq1(b[j])
                if matcher.quick_ratio() >= least and (score := matcher.ratio()) >= least:
                    out.append((left["block"].iat[0], left_ix[i], right_ix[j], b[j], score, _level(score)))
        return pd.DataFrame(out, columns=["block", "left_ix", "right_ix", "right_title", "score", "level"])

    return run


def scored_pairs(left: DataFrame, right: DataFrame, least: float, tile: int = TILE) -> DataFrame:
    """block, left_ix, right_ix, right_title, score and level of all pairs within a block that reach the similarity."""
    a = left.select("block", "ix", "title", _bucket(least).alias("b"))
    b = right.select("block", "ix", "title", F.explode(F.array(*[_bucket(least) + k for k in (-1, 0, 1)])).alias("b"))
    # Tiles of each side in each bucket: short rows, one for each bucket in use.
    count = lambda df, n: df.groupBy("block", "b").agg(F.count("*").alias(f"rows_{n}"), F.sum(F.length("title")).alias(f"size_{n}"))
    both = count(a, "a").join(count(b, "b"), ["block", "b"])
    pairs, buckets = both.agg(F.sum(F.col("rows_a").cast("double") * F.col("rows_b")), F.count("*")).first()
    tall = float(max(tile, min(MOST[0], math.isqrt(int(pairs or 0) // TILES))))
    dealt = lambda n: F.ceil(F.greatest(F.col(f"rows_{n}") / tall, F.least(F.col(f"rows_{n}"), F.col(f"size_{n}") / MOST[1]))).cast("int").alias(f"n{n}")
    tiles = both.select("block", "b", dealt("a"), dealt("b"))
    if buckets <= BUCKETS:
        tiles = F.broadcast(tiles)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("ix", "title"), F.col(n)).cast("int")
    a = a.join(tiles, ["block", "b"]).select("block", "b", "ix", "title", own("na").alias("ta"), every("nb").alias("tb"))
    b = b.join(tiles, ["block", "b"]).select("block", "b", "ix", "title", every("na").alias("ta"), own("nb").alias("tb"))
    key = ["block", "b", "ta", "tb"]
    return a.groupBy(*key).cogroup(b.groupBy(*key)).applyInPandas(_tile_scores(least), _PAIR)


# --- choice -----------------------------------------------------------------------------------------------------------

_FINAL = ["block", "left_ix", "right_ix", "score", "level"]


def _finished(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The greedy choice over sorted pairs, component by component."""
    component, left, right = None, set(), set()
    for b in batches:
        keep = []
        for n, (c, x, y) in enumerate(zip(b["component"], b["left_ix"], b["right_ix"], strict=True)):
            if c != component:
                component, left, right = c, set(), set()
            if x not in left and y not in right:
                left.add(x)
                right.add(y)
                keep.append(n)
        yield b.iloc[keep][_FINAL]


def greedy(pairs: DataFrame, finish: int = FINISH) -> DataFrame:
    """The one-to-one choice among scored pairs (see the module): block, left_ix, right_ix, score and level.

    Two tables are written a round: what it settles, and the pairs that stay open.
    """
    pairs, found = stored(pairs, "pairs"), []
    n = pairs.count()
    while n > finish:
        best = F.struct(F.col("level"), (-F.col("left_ix")).alias("l"), F.col("score"), F.col("right_title"), (-F.col("right_ix")).alias("r"))
        by_left = pairs.groupBy("block", "left_ix").agg(F.max(best).alias("best"))
        by_right = pairs.groupBy("block", "right_ix").agg(F.max(best).alias("best"))
        final = by_left.join(by_right, ["block", "best"]).select("block", "left_ix", "right_ix", F.col("best.score").alias("score"), F.col("best.level").alias("level"))
        found.append(stored(final, "matched"))
        open_ = stored(pairs.join(found[-1].select("block", "left_ix"), ["block", "left_ix"], "left_anti").join(found[-1].select("block", "right_ix"), ["block", "right_ix"], "left_anti"), "open")
        discard(pairs)
        pairs = open_
        before, n = n, pairs.count()
        if before - n < LITTLE * before:
            break
    if n:
        if n <= finish:
            own = pairs.withColumn("component", F.xxhash64("block"))  # few pairs: a block is a small enough unit
        else:
            nodes = pairs.select("*", F.xxhash64(F.lit("l"), "block", "left_ix").alias("a"), F.xxhash64(F.lit("r"), "block", "right_ix").alias("z"))
            labels = connected(nodes.select("a", F.col("z").alias("b")))
            own = nodes.join(labels.select(F.col("node").alias("a"), F.col("label").alias("component")), "a").drop("a", "z")
        order = [F.desc("level"), F.asc("left_ix"), F.desc("score"), F.desc("right_title"), F.asc("right_ix")]
        dealt = own.repartition("component", "block").sortWithinPartitions("component", "block", *order)
        found.append(dealt.withColumn("component", F.struct("component", "block").cast("string")).mapInPandas(_finished, "block string, left_ix bigint, right_ix bigint, score double, level int"))
    elif found:
        discard(pairs)
    out = found[0] if found else pairs.select(*_FINAL)
    for more in found[1:]:
        out = out.unionByName(more)
    return out


# --- matching ---------------------------------------------------------------------------------------------------------


def _titled(df: DataFrame) -> DataFrame:
    return df.select("block", F.col("ix").cast("bigint").alias("ix"), "title").where(F.col("block").isNotNull() & (F.trim("title") != ""))


def exact_match(left: DataFrame, right: DataFrame) -> DataFrame:
    """block, left_ix and right_ix of rows with equal titles, the n-th of a title with the n-th; nothing is scored."""
    a, b = (numbered_within(_titled(df), ["block", "title"], "ix") for df in (left, right))
    return a.join(b.withColumnRenamed("ix", "right_ix"), ["block", "title", "n"]).select("block", F.col("ix").alias("left_ix"), "right_ix")


def fuzzy_match(left: DataFrame, right: DataFrame, least: float = 0.71, *, bands: tuple[float, ...] = (0.86,), tile: int = TILE, finish: int = FINISH) -> DataFrame:
    """block, left_ix, right_ix, score and level (in hundredths) of a one-to-one match.

    A row without a title or a block matches nothing; an ix names one row of its block. bands: whole hundredths.
    """
    a, b = _titled(left), _titled(right)
    found = stored(exact_match(left, right).select("block", "left_ix", "right_ix", F.lit(1.0).alias("score"), F.lit(100).alias("level")), "exact")
    before = ()
    for band in [x for x in bands if x > least] + [least]:
        left_over = stored(a.join(found.select("block", F.col("left_ix").alias("ix")), ["block", "ix"], "left_anti"), "left")
        right_over = stored(b.join(found.select("block", F.col("right_ix").alias("ix")), ["block", "ix"], "left_anti"), "right")
        both = found.unionByName(greedy(scored_pairs(left_over, right_over, band, tile), finish))
        found = stored(both, "matches")
        discard(both, *before)
        a, b = before = left_over, right_over
    return found


def lookup_title(titles: DataFrame, hits: DataFrame, least: float = 0.0) -> DataFrame:
    """Case-folded titles with the hit that is most like them: ix, hit_ix and confidence, the first hit on ties.

    titles: ix, title; hits: ix, hit_ix, hit_title, a few for each title. Confidence is the similarity of the lower-cased
    titles; hits under `least` don't count, and titles without a hit are left out.
    """
    from foliant.functions.documents import similarity

    j = titles.select("ix", F.lower("title").alias("title")).join(hits.select("ix", "hit_ix", F.lower("hit_title").alias("hit_title")), "ix")
    j = j.withColumn("confidence", similarity(F.col("title"), F.col("hit_title"))).where(F.col("confidence") >= least)
    return j.groupBy("ix").agg(F.max_by(F.struct("hit_ix", "confidence"), F.struct("confidence", -F.col("hit_ix"))).alias("r")).select("ix", "r.hit_ix", "r.confidence")


def match_levels(matches: DataFrame) -> DataFrame:
    """Matches at each level."""
    return matches.groupBy("level").agg(F.count("*").alias("n")).orderBy(F.desc("level"))


def lowest_level(matches: DataFrame, warn_under: int = 90) -> DataFrame:
    """block, n, the lowest level that a match of the block has, and whether it is low enough to be looked at."""
    return matches.groupBy("block").agg(F.count("*").alias("n"), F.min("level").alias("lowest")).withColumn("warn", F.col("lowest") < warn_under)
