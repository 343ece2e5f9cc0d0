"""Token ids of documents in seekable zstd shards.

Documents are range-partitioned and sorted by id; each task writes one shard. A shard's content is the ids of its
documents, each with the end id, as little-endian unsigned integers of one width; its frames are independent and hold
FRAME_IDS ids at most, so long documents span frames. Its metadata lists the documents and their lengths. Readers need the
seek table, the list and the frames of the documents they want.

Defined results: a null or empty text is the end id alone; documents without id come first; rows that repeat an id are
ordered by their text; an empty table writes no shard. Other columns are not read. The list of shards is a table, too: it
grows with the input, and nothing of it but its length reaches the driver.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm.common import before, id_text, shared_dir, slices, written
from foliant.llm.pretokens import byte_level_encoder
from foliant.llm.seekable import Reader, Writer, filesystem, write_whole

FRAME_IDS = 1 << 16
SHARD_BYTES = 64 << 20
_NULL = -(1 << 63)


def _write_shards(root: str, tokenizer: str, end_id: int, frame_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        encode = byte_level_encoder(tokenizer)
        kind = np.dtype("<u2" if max(encode.vocab_size, end_id + 1) <= 1 << 16 else "<u4")
        docs: list[np.ndarray] = []
        lengths: list[np.ndarray] = []

        def fill(out) -> None:
            writer, rest = Writer(out), np.empty(0, kind)
            for batch in batches:
                for part, texts in slices(batch):
                    ids, n = encode(texts)
                    ends = np.cumsum(n)
                    ids = np.insert(ids.astype(kind), ends, end_id)
                    docs.append(part.column("doc_id").fill_null(_NULL).to_numpy())
                    lengths.append(n + 1)
                    rest = np.concatenate([rest, ids])
                    full = len(rest) // frame_ids * frame_ids
                    for x in range(0, full, frame_ids):
                        writer.frame(rest[x : x + frame_ids].tobytes())
                    rest = rest[full:]
            if len(rest):
                writer.frame(rest.tobytes())
            head = json.dumps({"width": kind.itemsize, "documents": sum(map(len, docs))}).encode()
            table = np.concatenate([np.concatenate(docs), np.concatenate(lengths)]) if docs else np.empty(0, np.int64)
            writer.metadata(head + b"\n" + table.astype("<i8").tobytes())
            writer.close()

        first = next(batches, None)
        if first is None:
            return
        batches = _before(first, batches)
        shard = context.partitionId()
        write_whole(root, f"shard-{shard:07d}.zst", f"{context.taskAttemptId()}", fill)
        yield pa.RecordBatch.from_pylist([{"shard": shard, "documents": sum(map(len, docs)), "tokens": int(sum(map(np.sum, lengths)))}])

    return run


def _before(first, rest):
    yield first
    yield from rest


def open_shard(root: str, shard: int) -> tuple[Reader, np.ndarray, np.ndarray, np.dtype]:
    """A shard's reader, its documents' ids and lengths, and the type of its token ids."""
    fs, folder = filesystem(root)
    reader = Reader(fs.open_input_file(f"{folder}/shard-{shard:07d}.zst"))
    head, _, table = reader.metadata().partition(b"\n")
    head = json.loads(head)
    docs, lengths = np.frombuffer(table, "<i8").reshape(2, head["documents"])
    return reader, docs, lengths, np.dtype(f"<u{head['width']}")


def write_tokens(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, root: str | None = None, frame_ids: int = FRAME_IDS) -> tuple[str, DataFrame]:
    """Writes the shards; their folder and the table (shard, documents, tokens, start) of them, start being the ids of all
    shards before."""
    spark = docs.sparkSession
    root = root or shared_dir(spark, "tokens")
    texts = id_text(docs, id_col, text_col)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    dealt = texts.withColumn("tie", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    rows = dealt.select("doc_id", "text").mapInArrow(_write_shards(root, tokenizer, end_id, frame_ids), "shard long, documents long, tokens long")
    return root, written(before(written(rows, "shards"), "shard", "tokens", "start"), "listed")


def _read_shards(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, start in zip(batch.column("shard").to_pylist(), batch.column("start").to_pylist(), strict=True):
                reader, docs, lengths, kind = open_shard(root, shard)
                ends = np.cumsum(lengths)
                crcs, crc, d, at = np.zeros(len(docs), np.int64), 0, 0, 0
                for k in range(len(reader)):
                    ids = np.frombuffer(reader.frame(k), kind).astype("<u4")
                    wide, done = memoryview(ids.tobytes()), 0
                    while done < len(ids):
                        upto = min(len(ids), int(ends[d]) - at)
                        crc = zlib.crc32(wide[4 * done : 4 * upto], crc)
                        done = upto
                        if at + upto == ends[d]:
                            crcs[d], crc, d = crc, 0, d + 1
                    at += len(ids)
                reader.close()
                if d != len(docs):
                    raise ValueError(f"shard {shard} ends early")
                yield pa.RecordBatch.from_arrays([pa.array(docs, mask=docs == _NULL), pa.array(start + ends - lengths), pa.array(lengths), pa.array(crcs)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read_digests(spark: SparkSession, root: str, shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files. shards: as write_tokens() gives them."""
    listed = shards.select("shard", "start").repartition(max(1, shards.count()))
    return listed.mapInArrow(_read_shards(root), "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_document(root: str, shard: int, doc_id: int) -> list[np.ndarray]:
    """The ids of a document's rows in a shard; only the frames that hold them are read."""
    reader, docs, lengths, kind = open_shard(root, shard)
    ends = np.cumsum(lengths) * kind.itemsize
    with reader:
        return [np.frombuffer(reader.content(int(ends[d] - lengths[d] * kind.itemsize), int(ends[d])), kind) for d in np.flatnonzero(docs == doc_id)]
