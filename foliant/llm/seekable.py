"""Zstandard files of independent frames with a trailing seek table (the public seekable format).

Content frames are followed by an optional skippable frame of metadata and by the seek table: for each frame its
compressed size, its content size and the low 32 bits of the content's XXH64. A plain zstd reader reads the content and
skips the rest; a seeking reader needs the end of the file and the wanted frames only.
"""

from __future__ import annotations

import struct
from collections.abc import Callable
from typing import BinaryIO
from urllib.parse import urlparse

import numpy as np
import pyarrow.fs as pafs
import xxhash
import zstandard

# Fixed values of the format.
SKIPPABLE = 0x184D2A50
SEEK_TABLE = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder and the path within it."""
    return pafs.FileSystem.from_uri(uri if urlparse(uri).scheme else f"file://{uri}")


class Writer:
    def __init__(self, out: BinaryIO, level: int = 3) -> None:
        self.out, self.entries, self.at = out, [], 0
        self.compressor = zstandard.ZstdCompressor(level=level, write_content_size=True)

    def frame(self, content: bytes) -> int:
        """Adds a frame; its number."""
        self._add(self.compressor.compress(content), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF)
        return len(self.entries) - 1

    def metadata(self, content: bytes) -> None:
        body = self.compressor.compress(content)
        self._add(struct.pack("<II", SKIPPABLE, len(body)) + body, 0, 0)

    def _add(self, body: bytes, size: int, check: int) -> None:
        if max(len(body), size) >= 1 << 32:
            raise ValueError("a frame holds less than 4 GB")
        self.out.write(body)
        self.at += len(body)
        self.entries.append((len(body), size, check))

    def close(self) -> int:
        """Writes the seek table; the file's size."""
        table = b"".join(struct.pack("<III", *e) for e in self.entries) + struct.pack("<IBI", len(self.entries), CHECKSUMS, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SEEK_TABLE, len(table)) + table)
        return self.at + 8 + len(table)


class Reader:
    """file: an opened pyarrow file, or anything with size(), seek() and read()."""

    def __init__(self, file) -> None:
        self.file, end = file, file.size()
        if end < 17:
            raise ValueError("no seek table")
        n, flags, magic = struct.unpack("<IBI", self._read(end - 9, 9))
        if magic != SEEK_MAGIC:
            raise ValueError("no seek table")
        width = 12 if flags & CHECKSUMS else 8
        entries = np.frombuffer(self._read(end - 9 - width * n, width * n), "<u4").reshape(n, width // 4).astype(np.int64)
        if n and int(entries[:, 0].sum()) + 8 + width * n + 9 != end:
            raise ValueError("the seek table does not fit the file")
        self.sizes, self.contents = entries[:, 0], entries[:, 1]
        self.checks = entries[:, 2] if width == 12 else None
        self.places = np.concatenate([[0], np.cumsum(self.sizes)])
        self.starts = np.concatenate([[0], np.cumsum(self.contents)])
        self.decompressor = zstandard.ZstdDecompressor()

    def close(self) -> None:
        self.file.close()

    def __enter__(self) -> Reader:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def __len__(self) -> int:
        return len(self.sizes)

    def frame(self, k: int) -> bytes:
        if not self.contents[k]:
            return b""
        content = self.decompressor.decompress(self._read(int(self.places[k]), int(self.sizes[k])))
        if self.checks is not None and xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.checks[k]:
            raise ValueError(f"frame {k} does not match its checksum")
        return content

    def metadata(self) -> bytes:
        """Of the last frame that has no content."""
        k = int(np.flatnonzero(self.contents == 0)[-1])
        body = self._read(int(self.places[k]), int(self.sizes[k]))
        if struct.unpack("<I", body[:4])[0] != SKIPPABLE:
            raise ValueError("no metadata")
        return self.decompressor.decompress(body[8:])

    def content(self, begin: int, end: int) -> bytes:
        """Bytes [begin, end) of the joined contents, from the frames that hold them."""
        if begin >= end:
            return b""
        first, last = int(np.searchsorted(self.starts, begin, "right")) - 1, int(np.searchsorted(self.starts, end, "left"))
        joined = b"".join(self.frame(k) for k in range(first, last))
        return joined[begin - int(self.starts[first]) : end - int(self.starts[first])]


def write_whole(root: str, name: str, attempt: str, fill: Callable[[BinaryIO], None]) -> str:
    """Fills a file under another name and then moves it, so that a lost or repeated task leaves no half file."""
    fs, folder = filesystem(root)
    fs.create_dir(folder, recursive=True)
    part, path = f"{folder}/.{name}.{attempt}", f"{folder}/{name}"
    with fs.open_output_stream(part) as out:
        fill(out)
    fs.move(part, path)
    return path
