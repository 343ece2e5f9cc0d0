"""Benchmark decontamination with a generalised suffix automaton.

The words of all benchmark items form one automaton. The words of each document stream through it; at every word the
automaton knows the longest run of words, ending there, that occurs in some item. A run of at least `window` words, or a
whole shorter item, is a hit: its words are marked, and documents whose marked share reaches the coverage limit are
contaminated.

Defined results: a null or empty text has no words, no hits and is clean; a null or wordless item matches nothing; items
that repeat an id count once in the list of items; an item without id hits words like any other, but isn't listed; rows that repeat a doc_id are judged one by one; a null doc_id is kept.
An empty benchmark leaves every document clean. Columns other than the id and the text are not read; those that
without_benchmark() keeps may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import id_text, renamed_apart, slices, with_names
from foliant.llm.textcodes import letter_words, spans

#: Words of benchmark text in one automaton. A larger benchmark is dealt to several, which documents pass in turn.
SHARD_WORDS = 200_000

_HITS = "array<struct<start:int,end:int>>"
#: What documents carry from one automaton to the next: their words, hit word spans, hit character spans, hit items.
_STATE = {"__n_words": "long", "__hits": _HITS, "__spans": _HITS, "__items": "array<string>"}


class SuffixAutomaton:
    """Generalised suffix automaton over items' words; a state knows in which items its runs of words occur."""

    def __init__(self, items: list[tuple[str | None, str]], window: int) -> None:
        self.window = window
        self.trans: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        hashes, first, *_ = letter_words([t for _, t in items])
        self.vocab, ids = np.unique(hashes, return_inverse=True)
        words = [ids[a:b].tolist() for a, b in zip(first, first[1:], strict=False)] if items else []
        short: dict[int, set[tuple[int, str | None]]] = {}
        for (name, _), seq in zip(items, words, strict=True):
            last = 0
            for c in seq:
                last = self._extend(last, c)
            if 0 < len(seq) < window:
                short.setdefault(last, set()).add((len(seq), name))
        within: list[set[str | None]] = [set() for _ in self.trans]
        for (name, _), seq in zip(items, words, strict=True):
            at = 0
            for c in seq:
                at = up = self.trans[at][c]
                while up > 0 and name not in within[up]:
                    within[up].add(name)
                    up = self.link[up]
        # By state: the items of the window-long run that ends there, and whole short items among its suffixes.
        self.at_window: list[frozenset[str] | None] = [None] * len(self.trans)
        self.short: list[tuple[tuple[int, str], ...]] = [()] * len(self.trans)
        for v in sorted(range(1, len(self.trans)), key=self.length.__getitem__):
            up = self.link[v]
            if self.length[v] >= window:
                self.at_window[v] = self.at_window[up] if self.length[up] >= window else frozenset(within[v])
            self.short[v] = self.short[up] + tuple(short.get(v, ()))
        self.least = min([window, *(m for s in short.values() for m, _ in s)])

    def _extend(self, last: int, c: int) -> int:
        trans, link, length = self.trans, self.link, self.length
        if c in trans[last]:
            q = trans[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        new = self._add(length[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in trans[p]:
            trans[p][c] = new
            p = link[p]
        if p >= 0:
            q = trans[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return new

    def _clone(self, p: int, c: int, q: int) -> int:
        new = self._add(self.length[p] + 1, dict(self.trans[q]), self.link[q])
        self.link[q] = new
        while p >= 0 and self.trans[p].get(c) == q:
            self.trans[p][c] = new
            p = self.link[p]
        return new

    def _add(self, length: int, trans: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.trans.append(trans)
        self.link.append(link)
        return len(self.length) - 1

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """The automaton's letter for each word, -1 for a word that no item has."""
        if not len(self.vocab):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.vocab, hashes), len(self.vocab) - 1)
        return np.where(self.vocab[at] == hashes, at, -1)

    def stream(self, seq: list[int], base: int, hits: list[tuple[int, int]], items: set[str]) -> None:
        """Feeds known words; adds word spans [start, end), moved by base, and the items they come from."""
        trans, link, length, window = self.trans, self.link, self.length, self.window
        v = matched = 0
        for i, c in enumerate(seq, base + 1):
            step = trans[v]
            while c not in step and v:
                v = link[v]
                matched = length[v]
                step = trans[v]
            if c in step:
                v = step[c]
                matched += 1
            if matched >= window:
                hits.append((i - window, i))
                items |= self.at_window[v]
            if self.short[v]:
                for m, name in self.short[v]:
                    if m <= matched:
                        hits.append((i - m, i))
                        items.add(name)


def _merged(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(hits):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _pass(shared, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton: SuffixAutomaton = shared.value
        for batch in batches:
            for part, texts in slices(batch, text):
                hashes, at, starts, ends, text_at = letter_words(texts)
                ids = automaton.ids(hashes)
                known = ids >= 0
                # Runs of known words end at unknown ones and at the ends of documents.
                inside = np.zeros(len(ids) + len(at), bool)
                moved = np.arange(len(ids)) + np.repeat(np.arange(len(texts)), np.diff(at))
                inside[moved] = known
                a, b = spans(inside)
                keep = (b - a) >= automaton.least
                found: dict[int, tuple[list, set]] = {}
                for d, (h, names) in enumerate(zip(part.column("__hits").to_pylist(), part.column("__items").to_pylist(), strict=True)):
                    if h:
                        found[d] = ([(x["start"], x["end"]) for x in h], set(names))
                gaps = at[1:] + np.arange(len(texts))
                for x, y in zip(a[keep].tolist(), b[keep].tolist(), strict=True):
                    d = int(np.searchsorted(gaps, x))
                    w = x - d
                    hits, items = found.setdefault(d, ([], set()))
                    automaton.stream(ids[w : w + y - x].tolist(), w - int(at[d]), hits, items)
                rows = {"__n_words": np.diff(at), "__hits": [], "__spans": [], "__items": []}
                for d in range(len(texts)):
                    hits, items = found.get(d, ((), ()))
                    words = _merged(list(hits))
                    base = int(at[d])
                    rows["__hits"].append([{"start": x, "end": y} for x, y in words])
                    rows["__spans"].append([{"start": int(starts[base + x] - text_at[d]), "end": int(ends[base + y - 1] - text_at[d])} for x, y in words])
                    rows["__items"].append(sorted(x for x in items if x is not None))
                own = [pa.array(rows[f.name], f.type) if f.name in rows else part.column(i) for i, f in enumerate(part.schema)]
                yield pa.RecordBatch.from_arrays(own, schema=part.schema)

    return run


def _streamed(rows: DataFrame, text: str, benchmark: DataFrame, *, item_col: str = "item_id", item_text_col: str = "text", window: int = 13, shard_words: int = SHARD_WORDS) -> DataFrame:
    """rows with the columns of _STATE.

    The driver holds one automaton of at most about shard_words words (or one longer item) at a time.
    """
    spark = rows.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("words")).where(F.col("words").isNotNull())
    size = items.agg(F.sum(F.length("words") / 2 + 1)).first()[0] or 0  # a word takes two characters at least
    shards = max(1, -(-int(size) // (3 * shard_words)))
    out = rows.withColumns({name: F.lit(None).cast(kind) for name, kind in _STATE.items()})
    for k in range(shards):
        own = items.where(F.pmod(F.xxhash64("item", "words"), F.lit(shards)) == k).orderBy("item", "words").collect()
        out = out.mapInArrow(_pass(spark.sparkContext.broadcast(SuffixAutomaton([(r[0], r[1]) for r in own], window)), text), out.schema)
    return out


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, text, n_words, hits (word spans), spans (character spans) and items of every document."""
    return _streamed(id_text(docs, id_col, text_col), "text", benchmark, **options).withColumnsRenamed({name: name[2:] for name in _STATE})


def _n_hit(hits: str) -> Column:
    return F.aggregate(hits, F.lit(0).cast("long"), lambda s, x: s + (x["end"] - x["start"]))


def _contaminated(n_hit: Column, n_words: Column, coverage: tuple[int, int]) -> Column:
    return (n_hit > 0) & (n_hit * coverage[1] >= n_words * coverage[0])


def _cut(text: str, spans: str) -> Column:
    """The text without its hit spans."""
    rest = f"array_join(transform({spans}, (x, i) -> substring({text}, x.end + 1, coalesce(try_element_at({spans}, i + 2).start, length({text})) - x.end)), '')"
    return F.when(F.size(spans) == 0, F.col(text)).otherwise(F.expr(f"concat(substring({text}, 1, {spans}[0].start), {rest})"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, coverage: tuple[int, int] = (1, 20), **options) -> DataFrame:
    """benchmark_hits with n_hit, n_items, contaminated and clean_text.

    contaminated: a hit, and at least coverage[0] / coverage[1] of the words are hit. clean_text: the text without its hit
    spans, null where the whole document is contaminated.
    """
    hits = benchmark_hits(docs, benchmark, **options)
    out = hits.withColumns({"n_hit": _n_hit("hits"), "n_items": F.size("items").cast("long")})
    out = out.withColumn("contaminated", _contaminated(F.col("n_hit"), F.col("n_words"), coverage))
    return out.withColumn("clean_text", F.when(~F.col("contaminated"), _cut("text", "spans")))


def without_benchmark(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", chars_col: str | None = None, coverage: tuple[int, int] = (1, 20), **options) -> DataFrame:
    """The rows of docs that are not contaminated, their texts (strings) without hit spans, all columns kept. Each row
    follows its own verdict, whatever its id. chars_col, where a text was cut, becomes its new length."""
    own, names = renamed_apart(docs, *_STATE)
    text_col, chars_col = names[text_col], names.get(chars_col)
    rows = _streamed(own, text_col, benchmark, **options)
    kept = rows.where(~_contaminated(_n_hit("__hits"), F.col("__n_words"), coverage))
    changed = {text_col: _cut(f"`{text_col}`", "__spans")}
    if chars_col:
        changed[chars_col] = F.when(F.size("__spans") == 0, F.col(f"`{chars_col}`")).otherwise(F.length(changed[text_col]).cast(own.schema[chars_col].dataType))
    return with_names(kept.withColumns(changed), names)


def digest(df: DataFrame) -> DataFrame:
    """The contract's columns."""
    return df.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
