"""A paged REST source: one input partition for each page of (offset, limit), or, of many pages, for several.

The reader's partitions do the requests on executors; `fetch` is any importable callable (url, offset, limit) -> list of
rows, so tests and replays need no network. `count` gives the number of rows, which becomes the partitions.
"""

from __future__ import annotations

import importlib
import json
import random
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from foliant.operators.scans import numbered


def get_with_retries(url: str, tries: int = 10, backoff: float = 0.5, timeout: float = 20, open_url: Callable = urllib.request.urlopen, sleep: Callable = time.sleep) -> bytes | None:
    """The body, or None after all tries; waits double each time."""
    for k in range(tries):
        try:
            with open_url(url, timeout=timeout) as r:
                return r.read()
        except OSError:
            if k + 1 < tries:
                sleep(backoff * 2**k)
    return None


class Throttle:
    """A least gap between requests with jitter, and a long pause after several failures in a row."""

    def __init__(self, gap: float = 5.0, jitter: float = 0.5, failures: int = 6, pause: float = 300.0, clock: Callable = time.monotonic, sleep: Callable = time.sleep) -> None:
        self.gap, self.jitter, self.failures, self.pause, self.clock, self.sleep = gap, jitter, failures, pause, clock, sleep
        self.last, self.failed = None, 0

    def __call__(self, request: Callable[[], list | bytes | None], tries: int = 3) -> list | bytes:
        """What the request gives, tried again after an OSError or None; the last error after all tries."""
        for k in range(tries):
            if self.last is not None and (wait := self.last + self.gap - self.clock()) > 0:
                self.sleep(wait + random.uniform(0, self.jitter))
            error = OSError("no answer")
            try:
                out = request()
            except OSError as e:
                out, error = None, e
            self.last = self.clock()
            self.failed = 0 if out is not None else self.failed + 1
            if out is not None:
                return out
            if self.failed >= self.failures:
                self.sleep(self.pause)
                self.failed = 0
            if k + 1 == tries:
                raise error
        raise ValueError("no tries")


def http_fetch(url: str, offset: int, limit: int) -> list[dict]:
    """Notes of a JSON endpoint that takes offset and limit."""
    mark = "&" if urllib.parse.urlparse(url).query else "?"
    body = get_with_retries(f"{url}{mark}offset={offset}&limit={limit}")
    if body is None:
        raise OSError(f"no answer from {url} at {offset}")
    return json.loads(body).get("notes", [])


def http_count(url: str) -> int:
    body = get_with_retries(f"{url}{'&' if urllib.parse.urlparse(url).query else '?'}limit=1")
    if body is None:
        raise OSError(f"no answer from {url}")
    return int(json.loads(body)["count"])


_SIZE = "_page_size"


def _folder(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def _lines(fs: pafs.FileSystem, path: str, page: int) -> list[dict]:
    """The rows of one page, from its own folder; none where it isn't there."""
    rows = []
    for f in fs.get_file_info(pafs.FileSelector(f"{path}/page={page}", allow_not_found=True)):
        if f.is_file and not f.base_name.startswith((".", "_")):
            with fs.open_input_stream(f.path) as source:
                rows += [json.loads(x) for x in source.read().decode().split("\n") if x]
    return sorted(rows, key=lambda r: r["row_ix"])


def store_pages(notes: DataFrame, folder: str, *order: str, limit: int = 1000) -> None:
    """Notes as pages of `limit` rows along an order, for stored_fetch: JSON lines in folders page=<n>, and the size of a page."""
    rows = numbered(notes, *order, name="row_ix").withColumn("page", F.floor(F.col("row_ix") / limit))
    rows.repartition("page").write.mode("append").partitionBy("page").json(folder)
    fs, path = _folder(folder)
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(f"{path}/{_SIZE}") as out:
        out.write(str(limit).encode())


def stored_fetch(url: str, offset: int, limit: int) -> list[dict]:
    """Rows of stored pages: a replay without network. A request may cover several pages, or parts of them, and reads no
    others, however many are stored."""
    fs, path = _folder(url)
    if fs.get_file_info(f"{path}/{_SIZE}").is_file:
        with fs.open_input_stream(f"{path}/{_SIZE}") as source:
            size = int(source.read())
    else:
        size = len(_lines(fs, path, 0)) or 1  # every page but the last is full
    rows = [r for p in range(offset // size, (offset + limit - 1) // size + 1) for r in _lines(fs, path, p)]
    return [{k: v for k, v in r.items() if k != "row_ix"} for r in rows if offset <= r["row_ix"] < offset + limit]


def stored_count(url: str) -> int:
    """From the names of the pages and the rows of the last one."""
    fs, path = _folder(url)
    pages = [int(f.base_name.removeprefix("page=")) for f in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)) if f.base_name.startswith("page=")]
    return _lines(fs, path, max(pages))[-1]["row_ix"] + 1 if pages else 0


def _named(name: str) -> Callable:
    module, _, attribute = name.rpartition(".")
    return getattr(importlib.import_module(module), attribute)


class Page(InputPartition):
    def __init__(self, offset: int, limit: int) -> None:
        self.offset, self.limit = offset, limit


#: Partitions of a read at most: beyond, each takes several pages in turn, because a task costs more than a page.
MOST_PARTITIONS = 1024


def _pages(begin: int, end: int, limit: int) -> list[Page]:
    """Whole pages of `limit` rows (but for the last), dealt to MOST_PARTITIONS partitions at most."""
    step = limit * max(1, -(-(end - begin) // (limit * MOST_PARTITIONS)))
    return [Page(x, min(step, end - x)) for x in range(begin, end, step)]


def _paged(options, partition: Page) -> Iterator[tuple]:
    """The rows of a partition, a page a request."""
    fetch, limit = _named(options.get("fetch", "foliant.sources.rest.http_fetch")), int(options.get("limit", 1000))
    for at in range(partition.offset, partition.offset + partition.limit, limit):
        yield from _rows(fetch(options["url"], at, min(limit, partition.offset + partition.limit - at)), at)


def _rows(notes: list[dict], offset: int) -> Iterator[tuple]:
    for i, note in enumerate(notes):
        yield offset + i, note.get("id"), json.dumps(note, sort_keys=True, ensure_ascii=False)


class _Reader(DataSourceReader):
    def __init__(self, options) -> None:
        self.options = options

    def partitions(self):
        limit = int(self.options.get("limit", 1000))
        total = int(self.options["total"]) if "total" in self.options else _named(self.options.get("count", "foliant.sources.rest.http_count"))(self.options["url"])
        # A least gap between requests needs one reader that does them in turn.
        if "gap" in self.options:
            return [Page(0, total)] if total else []
        return _pages(0, total, limit)

    def read(self, partition: Page):
        if "gap" not in self.options:
            yield from _paged(self.options, partition)
            return
        fetch = _named(self.options.get("fetch", "foliant.sources.rest.http_fetch"))
        throttle, limit = Throttle(float(self.options["gap"]), float(self.options.get("jitter", 0.5))), int(self.options.get("limit", 1000))
        for at in range(partition.offset, partition.offset + partition.limit, limit):
            n = min(limit, partition.offset + partition.limit - at)
            yield from _rows(throttle(lambda at=at, n=n: fetch(self.options["url"], at, n)), at)


class _StreamReader(DataSourceStreamReader):
    """Pages as a stream: the offset is the number of rows planned so far. Each micro-batch takes `batch` rows at most, a
    page a partition, which executors fetch. After a restart it goes on where the checkpoint's log of offsets ends."""

    def __init__(self, options) -> None:
        self.options, self.at = options, None

    def initialOffset(self):
        return {"offset": 0}

    def _logged(self) -> int:
        """The last offset that the query has planned, from its checkpoint."""
        if "checkpointLocation" not in self.options:
            return 0
        folder = self.options["checkpointLocation"]
        fs, path = pafs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        logs = [f for f in fs.get_file_info(pafs.FileSelector(f"{path}/offsets", allow_not_found=True)) if f.base_name.isdigit()]
        if not logs:
            return 0
        with fs.open_input_stream(max(logs, key=lambda f: int(f.base_name)).path) as source:
            last = source.read().decode().strip().split("\n")[-1]
        return json.loads(last)["offset"] if last.startswith("{") else 0

    def latestOffset(self):
        if self.at is None:
            self.at = self._logged()
        total = _named(self.options.get("count", "foliant.sources.rest.http_count"))(self.options["url"])
        return {"offset": max(self.at, min(total, self.at + int(self.options.get("batch", 10_000))))}

    def partitions(self, start, end):
        self.at = max(self.at or 0, end["offset"])
        return _pages(start["offset"], end["offset"], int(self.options.get("limit", 1000)))

    def read(self, partition: Page):
        yield from _paged(self.options, partition)


class PagedNotes(DataSource):
    """spark.read.format("paged_notes").option("url", ..).option("limit", 1000).load(): row_ix, id, note (JSON).

    One input partition a page, up to MOST_PARTITIONS; with option gap (seconds between requests, jitter on top) one for all, read in turn. As a
    stream: `batch` rows at most in a micro-batch; `checkpointLocation`, that of the query, to go on after a restart.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_notes"

    def schema(self) -> str:
        return "row_ix bigint, id string, note string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def streamReader(self, schema):
        return _StreamReader(self.options)


def register(spark) -> None:
    spark.dataSource.register(PagedNotes)
