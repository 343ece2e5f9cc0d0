"""Ranked lexical search over compressed postings, document at a time.

Indexing reads the texts once, where they lie: each task cuts its documents into segments of about SEGMENT_WORDS terms (or
one longer document) and writes them to one file in the shared folder. A segment numbers its documents in order of their
ids and holds, for each term, the documents that have it in that order, as variable-length differences with the number of
occurrences. What the driver gets of the index is sums.

Searching takes items in blocks of about BLOCK_TERMS terms. The documents that hold each of a block's terms are summed
over all segments, which gives the terms' weights; then every segment ranks its documents for every item. The postings of
the item's terms are merged by a heap of cursors, keyed by each cursor's next document; all cursors in a window of
documents are advanced together, so that a document has its whole score before a later one is looked at, and a heap of the
best documents, keyed by score and then id, is bounded by the wanted number. Tasks merge the heaps of their segments, and
a ranked window merges those of the tasks. All arithmetic but the weights' logarithm is in 64-bit integers.

Terms are told apart by 64-bit hashes (see textcodes): of ten thousand query terms and ten thousand million other words one
pair collides with a chance near 1 in 200,000.

Defined results: a null or empty text, or one without terms, is indexed as a document without terms and not counted; a
repeated id names rows that are ranked each on its own; documents without id come after all others of their score; items
that repeat an id are ranked each on its own, an item without terms has no results; a word longer than a text slice is one
term; empty tables give an empty result. Columns other than ids and texts are not read.
"""

from __future__ import annotations

import heapq
import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.common import id_text, shared_dir, slices, written
from foliant.llm.seekable import filesystem, write_whole
from foliant.llm.textcodes import letter_words

#: Terms of a segment: about 6 MB of text.
SEGMENT_WORDS = 1 << 20
#: Query terms that one pass over the index takes.
BLOCK_TERMS = 200_000
#: Documents of a segment that cursors cover in one step.
WINDOW = 4096
#: Segments that one task searches, about.
TASK_SEGMENTS = 16

_NULL = (1 << 63) - 1  # after all other ids
_HEAD = struct.Struct("<QQQ")


# --- postings -------------------------------------------------------------------------------------------------------------


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of non-negative integers, seven bits each, the last byte of each under 128; and the number of bytes of each."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), np.int64)
    for bits in range(7, 64, 7):
        size += values >> np.uint64(bits) > 0
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    begins = ends - size
    for k in range(int(size.max(initial=0))):
        rows = np.flatnonzero(size > k)
        more = (size[rows] > k + 1) * np.uint8(128)
        out[begins[rows] + k] = ((values[rows] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | more
    return out, size


def decode(data: np.ndarray) -> np.ndarray:
    last = data < 128
    ends = np.flatnonzero(last)
    if not len(ends):
        return np.empty(0, np.int64)
    begins = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(begins, ends - begins + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), begins)


def pack(ids: np.ndarray, lengths: np.ndarray, terms: np.ndarray) -> bytes:
    """A segment of documents: their ids, numbers of terms, and terms one after another."""
    order = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    doc = np.repeat(place, lengths)
    by = np.lexsort((doc, terms))
    terms, doc = terms[by], doc[by]
    new_term = np.concatenate([[True], terms[1:] != terms[:-1]]) if len(terms) else np.empty(0, bool)
    new = new_term.copy()
    new[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(new)
    count = np.diff(np.concatenate([at, [len(terms)]]))
    doc, first = doc[at], new_term[at]
    gap = doc.copy()
    gap[1:] -= np.where(first[1:], 0, doc[:-1])
    data, size = encode(np.column_stack([gap, count]).ravel())
    starts = np.flatnonzero(first)
    df = np.diff(np.concatenate([starts, [len(at)]]))
    sizes = np.add.reduceat(size.reshape(-1, 2).sum(1), starts) if len(starts) else np.empty(0, np.int64)
    parts = (ids[order].astype("<i8"), lengths[order].astype("<i8"), terms[at][starts].astype("<u8"), df.astype("<u4"), sizes.astype("<u4"), data)
    return _HEAD.pack(len(ids), len(starts), len(data)) + b"".join(p.tobytes() for p in parts)


class Segment:
    """A segment's documents and dictionary, and its postings on demand."""

    def __init__(self, file, begin: int) -> None:
        self.file = file
        file.seek(begin)
        docs, terms, self.size = _HEAD.unpack(file.read(_HEAD.size))
        body = file.read(16 * docs + 16 * terms)
        self.ids, self.lengths = np.frombuffer(body, "<i8", 2 * docs).reshape(2, docs)
        self.terms = np.frombuffer(body, "<u8", terms, 16 * docs)
        self.df, sizes = np.frombuffer(body, "<u4", 2 * terms, 16 * docs + 8 * terms).reshape(2, terms).astype(np.int64)
        self.ends = np.cumsum(sizes)
        self.begin = begin + _HEAD.size + len(body)

    def find(self, terms: np.ndarray) -> np.ndarray:
        """The places of terms in the dictionary, -1 for those that it lacks."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def postings(self, places: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Documents and counts of the terms at ascending places; places that are near each other are read at once."""
        begins = np.concatenate([[0], self.ends])[places]
        out: list[tuple[np.ndarray, np.ndarray]] = []
        cuts = np.flatnonzero(begins[1:] - self.ends[places][:-1] > 1 << 16) + 1 if len(places) else []
        for own, b in zip(np.split(places, cuts), np.split(begins, cuts), strict=True):
            if not len(own):
                continue
            self.file.seek(self.begin + int(b[0]))
            data = np.frombuffer(self.file.read(int(self.ends[own[-1]] - b[0])), np.uint8)
            wanted = np.concatenate([data[x:y] for x, y in zip((b - b[0]).tolist(), (self.ends[own] - b[0]).tolist(), strict=True)])
            pairs = decode(wanted).reshape(-1, 2)
            firsts = np.concatenate([[0], np.cumsum(self.df[own])])
            run = np.cumsum(pairs[:, 0])
            # Differences start anew at each term: what had run up before it is taken off.
            run -= np.repeat(run[firsts[:-1]] - pairs[firsts[:-1], 0], self.df[own])
            out += [(run[x:y], pairs[x:y, 1]) for x, y in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True)]
        return out


def _index(root: str, segment_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, rows = TaskContext.get(), []
        name = f"postings-{context.partitionId():07d}"

        def fill(out) -> None:
            at, held = 0, ([], [], [])

            def flush() -> None:
                nonlocal at
                ids, lengths, terms = (np.concatenate(x) for x in held)
                data = pack(ids, lengths, terms)
                out.write(data)
                rows.append({"file": name, "begin": at, "documents": int((lengths > 0).sum()), "terms": int(lengths.sum())})
                at += len(data)
                for x in held:
                    x.clear()

            for batch in batches:
                for part, texts in slices(batch):
                    hashes, first, *_ = letter_words(texts)
                    if held[0] and sum(map(len, held[2])) + len(hashes) > segment_words:
                        flush()
                    for x, new in zip(held, (part.column("doc_id").fill_null(_NULL).to_numpy(), np.diff(first), hashes), strict=True):
                        x.append(new)
            if held[0]:
                flush()

        first = next(batches, None)
        if first is None:
            return
        batches = _before(first, batches)
        write_whole(root, name, f"{context.taskAttemptId()}", fill)
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("file", pa.string()), ("begin", pa.int64()), ("documents", pa.int64()), ("terms", pa.int64())]))

    return run


def _before(first, rest):
    yield first
    yield from rest


def build_index(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", root: str | None = None, segment_words: int = SEGMENT_WORDS) -> tuple[str, DataFrame]:
    """The folder of the postings and the table of their segments (file, begin, documents, terms), which is written."""
    root = root or shared_dir(docs.sparkSession, "postings")
    rows = id_text(docs, id_col, text_col).mapInArrow(_index(root, segment_words), "file string, begin long, documents long, terms long")
    return root, written(rows, "segments")


# --- search ---------------------------------------------------------------------------------------------------------------


def best_of(cursors: list[tuple[np.ndarray, np.ndarray]], documents: int, k: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """(score, document) of the k best of a segment's documents, best first, equal scores by document.

    cursors: documents in ascending order and the scores they add, for each term.
    """
    upcoming = [(int(docs[0]), i) for i, (docs, _) in enumerate(cursors) if len(docs)]
    heapq.heapify(upcoming)
    at, best = [0] * len(cursors), []  # best: heap of (score, -document)
    while upcoming:
        low = upcoming[0][0]
        end = min(low + window, documents)
        total = np.zeros(end - low, np.int64)
        while upcoming and upcoming[0][0] < end:
            _, i = heapq.heappop(upcoming)
            docs, add = cursors[i]
            upto = int(np.searchsorted(docs, end))
            total[docs[at[i] : upto] - low] += add[at[i] : upto]
            at[i] = upto
            if upto < len(docs):
                heapq.heappush(upcoming, (int(docs[upto]), i))
        # A later document of an equal score has a larger number, so it never takes the place of an earlier one.
        found = np.flatnonzero(total > (best[0][0] if len(best) == k else 0))
        if len(found) > k:
            found = np.sort(found[np.lexsort((found, -total[found]))[:k]])
        for d in found.tolist():
            entry = (int(total[d]), -(low + d))
            if len(best) < k:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)
    return [(score, -d) for score, d in sorted(best, reverse=True)]


def _open(root: str, batches: Iterator[pa.RecordBatch]) -> Iterator[Segment]:
    fs, folder = filesystem(root)
    for batch in batches:
        for name, begin in zip(batch.column("file").to_pylist(), batch.column("begin").to_pylist(), strict=True):
            with fs.open_input_file(f"{folder}/{name}") as file:
                yield Segment(file, begin)


def _frequencies(root: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        total = np.zeros(len(terms), np.int64)
        for s in _open(root, batches):
            at = s.find(terms)
            total[at >= 0] += s.df[at[at >= 0]]
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], names=["term", "df"])

    return run


def _search(root: str, shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights, items, n, length = shared.value
        best: dict[int, list] = {}
        for s in _open(root, batches):
            m = 10 + 90 * s.lengths * n // length
            at = s.find(terms)
            known = np.flatnonzero(at >= 0)  # terms ascend, and so do their places
            lists = {t: (docs, 1_000_000_000 * tf // (1000 * tf + 8 * m[docs])) for t, (docs, tf) in zip(known.tolist(), s.postings(at[known]), strict=True)}
            for row, own in items:
                cursors = [(lists[t][0], lists[t][1] * weights[t]) for t in own if t in lists]
                heap = best.setdefault(row, [])
                for score, d in best_of(cursors, len(s.ids), k):
                    entry = (score, -int(s.ids[d]))
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                    else:
                        break
        found = [(row, -d, score) for row, heap in best.items() for score, d in heap]
        rows, ids, scores = (np.array(x, np.int64) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 3
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(ids, mask=ids == _NULL), pa.array(scores)], names=["row", "doc_id", "score"])

    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in slices(batch):
            hashes, first, *_ = letter_words(texts)
            own = [np.unique(hashes[a:b]).astype(np.int64) for a, b in zip(first, first[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([part.column("row"), part.column("item_id"), pa.array(own, pa.list_(pa.int64()))], names=["row", "item_id", "terms"])


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def search(root: str, segments: DataFrame, items: DataFrame, *, item_col: str = "item_id", text_col: str = "text", k: int = 10, block_terms: int = BLOCK_TERMS, task_segments: int = TASK_SEGMENTS) -> DataFrame:
    """item_id, rank, doc_id and score of each item's k highest-scoring documents, those without a score left out.

    The driver holds the items of one block at a time: about block_terms hashes, or one longer item.
    """
    spark = segments.sparkSession
    kind = items.schema[item_col].dataType.simpleString()
    rows = items.select(F.monotonically_increasing_id().alias("row"), F.col(item_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
    asked = written(rows.mapInArrow(_item_terms, f"row long, item_id {kind}, terms array<long>"), "items")
    sizes = segments.agg(F.sum("documents").alias("n"), F.sum("terms").alias("l"), F.count("*").alias("segments")).first()
    blocks = max(1, -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // block_terms))
    tasks = max(1, min(sizes.segments, max(2 * spark.sparkContext.defaultParallelism, sizes.segments // task_segments)))
    dealt, found = segments.select("file", "begin").repartition(tasks), []
    for b in range(blocks if sizes.n else 0):
        own = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).select("row", "terms").orderBy("row").collect()
        terms = np.unique(np.array([t for r in own for t in r.terms], np.int64).view(np.uint64))
        df = np.zeros(len(terms), np.int64)
        for r in dealt.mapInArrow(_frequencies(root, spark.sparkContext.broadcast(terms)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
            df[r.term] = r.df
        wanted = [(r.row, np.searchsorted(terms, np.array(r.terms, np.int64).view(np.uint64)).tolist()) for r in own if r.terms]
        weights = [weight(sizes.n, x) for x in df.tolist()]
        found.append(dealt.mapInArrow(_search(root, spark.sparkContext.broadcast((terms, weights, wanted, sizes.n, sizes.l)), k), "row long, doc_id long, score long"))
    if not found:
        found = [spark.createDataFrame([], "row long, doc_id long, score long")]
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    top = every.withColumn("rank", rank).where(F.col("rank") <= k)
    return top.join(asked.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score")
