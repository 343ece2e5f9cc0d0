"""Language identification with hyperdimensional profiles.

Every letter (and the gap between words) has a random vector of +1 and -1. A letter trigram's vector binds the three by
elementwise product after permuting the first twice and the second once (rotations), so order counts. A document's vector
bundles (adds) those of all its trigrams, a language's prototype those of all its documents, and a document goes to the
prototype with the largest cosine.

Learning reads the text and language of the documents that are not held out; prediction reads the text alone.
Defined results: `und` with score 0 for a null text, one without letters, or where nothing could be learned; the first
language in alphabetical order among equal cosines; the score is the cosine, 0 if negative. A null doc_id is not held out
and not learned from. Rows that repeat an id are predicted one by one; whole texts of any length are read, a slice at a time;
an empty table gives an empty result. Other columns are not read; those that with_language() keeps may have any names.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import id_text, kept, renamed_apart, slices, with_names
from foliant.llm.textcodes import code_points

DIMENSIONS = 1024
SEED = 20240
#: Languages whose prototypes are broadcast at once (4 KB each); with more of them documents pass several broadcasts.
LANGUAGES = 4096
#: Trigram vectors that a worker remembers, and documents and trigrams that meet in one matrix product.
_REMEMBERED, _ROWS, _COLUMNS = 24_000, 256, 2048
#: Characters of text, and documents, that are bundled at once: a document's vector takes 8 KB.
_CHARS, _DOCUMENTS = 1 << 17, 1024


def _parts(batch: pa.RecordBatch, text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Slices of a batch of _CHARS characters and _DOCUMENTS rows at most, unless one document is longer."""
    for part, texts in slices(batch, text, _CHARS):
        for lo in range(0, len(texts), _DOCUMENTS):
            yield part.slice(lo, _DOCUMENTS), texts[lo : lo + _DOCUMENTS]


class Binder:
    """Vectors of trigrams, kept in a bounded memory."""

    def __init__(self, dimensions: int = DIMENSIONS) -> None:
        self.dimensions = dimensions
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.vectors = np.empty((0, dimensions), np.int8)

    def letter(self, c: int) -> np.ndarray:
        if c not in self.letters:
            if len(self.letters) > 100_000:
                self.letters.clear()
            self.letters[c] = np.random.default_rng([SEED, c]).integers(0, 2, self.dimensions, np.int8) * np.int8(2) - np.int8(1)
        return self.letters[c]

    def _bind(self, grams: list[int]) -> np.ndarray:
        low = (1 << 21) - 1
        return np.stack([np.roll(self.letter(g >> 42), 2) * np.roll(self.letter(g >> 21 & low), 1) * self.letter(g & low) for g in grams])

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        keys = grams.tolist()
        if new := [g for g in keys if g not in self.rows]:
            if len(self.rows) + len(new) > _REMEMBERED:
                self.rows, self.vectors = {}, self.vectors[:0]
                new = keys
            self.rows |= {g: len(self.vectors) + i for i, g in enumerate(new)}
            self.vectors = np.concatenate([self.vectors, self._bind(new)])
        return self.vectors[[self.rows[g] for g in keys]].astype(np.float32)


@lru_cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, place in the list of different trigrams) of every trigram around a letter, and that list."""
    codes, ends = code_points([t.lower() if t else t for t in texts])
    letter = _letters()[codes]
    c = np.where(letter, codes, 0)
    alphabet = np.flatnonzero(np.bincount(c))
    at = np.flatnonzero(letter)
    doc = np.searchsorted(ends, at)
    before, after = np.where(at > 0, c[at - 1], 0), c[at + 1]
    if len(alphabet) <= 128:
        small = np.zeros(int(alphabet[-1]) + 1 if len(alphabet) else 1, np.int64)
        small[alphabet] = np.arange(len(alphabet))
        gram = (small[before] << 14) | (small[c[at]] << 7) | small[after]
        present = np.flatnonzero(np.bincount(gram)) if len(gram) else gram
        place = np.zeros(1 << 21, np.int64)
        place[present] = np.arange(len(present))
        full = (alphabet[present >> 14] << 42) | (alphabet[present >> 7 & 127] << 21) | alphabet[present & 127] if len(present) else present
        return doc, place[gram], full
    full, place = np.unique((before.astype(np.int64) << 42) | (c[at].astype(np.int64) << 21) | after, return_inverse=True)
    return doc, place, full


def bundles(rows: np.ndarray, place: np.ndarray, grams: np.ndarray, n: int, bind: Binder) -> np.ndarray:
    """Sums of the trigram vectors of n rows; whole numbers, exact in float32 up to 2**24 and added up in float64."""
    out = np.zeros((n, bind.dimensions))
    for lo in range(0, len(grams), _COLUMNS):
        own = (place >= lo) & (place < lo + _COLUMNS) if len(grams) > _COLUMNS else slice(None)
        r, p, width = rows[own], place[own] - lo, min(_COLUMNS, len(grams) - lo)
        vectors = bind(grams[lo : lo + width])
        edge = np.searchsorted(r, np.arange(0, n + _ROWS, _ROWS))
        for k, (a, b) in enumerate(zip(edge, edge[1:], strict=False)):
            m = min(_ROWS, n - k * _ROWS)
            if b > a:
                counts = np.bincount((r[a:b] - k * _ROWS) * width + p[a:b], minlength=m * width).reshape(m, width)
                out[k * _ROWS : k * _ROWS + m] += counts.astype(np.float32) @ vectors
    return out


def _binder(dimensions: int) -> Binder:
    return kept("language_id", dimensions, lambda: Binder(dimensions))


def _learn(dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part, texts in _parts(batch):
                doc, place, grams = trigrams(texts)
                names, own = np.unique(np.array(part.column("lang").to_pylist(), object), return_inverse=True)
                lang = own[doc]
                order = np.argsort(lang, kind="stable")
                for name, v in zip(names, bundles(lang[order], place[order], grams, len(names), _binder(dimensions)), strict=True):
                    sums[name] = sums.get(name, 0) + v
        rows = [(name, i, int(x)) for name, v in sums.items() for i, x in enumerate(v)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int64()))], names=["lang", "dim", "x"])

    return run


def prototypes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """The learned languages in order, and a unit prototype for each. Tasks send one vector a language; the driver holds
    8 KB for each different language."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    known = texts.where(~held_out("doc_id") & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sums = known.select("text", "lang").mapInArrow(_learn(dimensions), "lang string, dim int, x long").groupBy("lang", "dim").agg(F.sum("x").alias("x"))
    rows = sums.groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("dim", "x"))), lambda s: s["x"]).alias("v")).orderBy("lang").toArrow()
    names = rows.column("lang").to_pylist()
    vectors = rows.column("v").combine_chunks().flatten().to_numpy().astype(float).reshape(len(names), dimensions)
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    keep = size[:, 0] > 0
    return [n for n, k in zip(names, keep, strict=True) if k], vectors[keep] / size[keep]


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def _predict(shared, text: str, dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, vectors = shared.value
        for batch in batches:
            for part, texts in _parts(batch, text):
                doc, place, grams = trigrams(texts)
                own = bundles(doc, place, grams, len(texts), _binder(dimensions))
                size = np.linalg.norm(own, axis=1)
                names, cosine = np.array(part.column("__lang").to_pylist(), object), part.column("__cosine").to_numpy().copy()
                some = np.bincount(doc, minlength=len(texts)) > 0
                if languages and some.any():
                    each = own @ vectors.T / np.where(size > 0, size, 1)[:, None]
                    best = each.argmax(axis=1)
                    top = each[np.arange(len(best)), best]
                    # Of equal cosines the earlier language stays.
                    some &= np.equal(names, None) | (top > cosine)
                    names[some] = np.array(languages, object)[best[some]]
                    cosine[some] = top[some]
                kept = part.schema.names[:-2]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in range(len(kept))), pa.array(names, pa.string()), pa.array(cosine)], schema=part.schema)

    return run


def _predicted(rows: DataFrame, text: str, model: tuple[list[str], np.ndarray], dimensions: int) -> DataFrame:
    """rows and their nearest language (__lang, null without one) and its cosine (__cosine)."""
    names, vectors = model
    out = rows.withColumns({"__lang": F.lit(None).cast("string"), "__cosine": F.lit(0.0)})
    for lo in range(0, len(names), LANGUAGES):
        shared = rows.sparkSession.sparkContext.broadcast((names[lo : lo + LANGUAGES], vectors[lo : lo + LANGUAGES]))
        out = out.mapInArrow(_predict(shared, text, dimensions), out.schema)
    return out


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], *, id_col: str = "doc_id", text_col: str = "text", dimensions: int = DIMENSIONS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    out = _predicted(id_text(docs, id_col, text_col), "text", model, dimensions)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), F.coalesce("__lang", F.lit("und")).alias("lang_pred"), F.least(F.greatest("__cosine", F.lit(0.0)), F.lit(1.0)).alias("score"))


def with_language(docs: DataFrame, model: tuple[list[str], np.ndarray], *, text_col: str = "text", lang_col: str | None = None, dimensions: int = DIMENSIONS) -> DataFrame:
    """The rows of docs that a language is found for, all columns kept; each row follows its own verdict, whatever its id.
    lang_col becomes the language that is found, whatever it was."""
    own, names = renamed_apart(docs, "__lang", "__cosine")
    found = _predicted(own, names[text_col], model, dimensions).where("__lang is not null")
    if lang_col:
        found = found.withColumn(names[lang_col], F.col("__lang"))
    return with_names(found, names)
