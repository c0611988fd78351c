"""Paged services (feeds, bibliographic indexes, libraries) as a Python data source, and runs over them.

A source is read by one task, page by page along its cursors. Its entries count only if the traversal
is complete: a page that fails, comes twice or cannot be read leaves the source with one failure and
no entry, and the other sources as they are. A run reads every source from its mark on and publishes
the entries and the new marks as one revision, in which a failed source keeps its old mark: what
was not seen whole is asked for again."""

from __future__ import annotations

import hashlib
import importlib
import json
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from lodestone.sources import revisions, shared

SCHEMA = "source string, position long, entry string, mark string, pages int, error string"


def folder_service(path: str) -> Callable[[str, str | None, str | None], dict]:
    """Answers as they lie in a folder: ``source=<s>/page=<cursor>/`` holds one text file, a JSON object with entries,
    next (the next cursor or null) and mark. The first page is 0; entries up to the mark ``since`` are left out
    where the entries have marks of their own."""
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)

    def fetch(source: str, since: str | None, cursor: str | None) -> dict:
        held = system.get_file_info(fs.FileSelector(f"{root}/source={source}/page={cursor or 0}"))
        names = [x.path for x in held if x.type == fs.FileType.File and not x.base_name.startswith(("_", "."))]
        if len(names) != 1:
            raise ValueError(f"{source}: page {cursor or 0} is {len(names)} files")
        with system.open_input_stream(names[0]) as raw:
            page = json.loads(raw.read())
        return page | {"entries": [e for e in page["entries"] if since is None or e.get("mark", since + "\U0010ffff") > since]}

    return fetch


def traversed(fetch: Callable[[str, str | None, str | None], dict], source: str, since: str | None, keep: Callable[[list[str]], None]) -> tuple[str | None, int]:
    """The new mark of a source and the number of its pages after ``since``; an error if any page fails, if a cursor
    or a page's entries come again, or if an answer has another form. ``keep`` gets each page's entries as JSON;
    of the pages before, only digests are held."""
    cursor, seen, pages, mark = None, set(), 0, since

    def came(kind: str, parts: list[str]) -> bool:
        digest = hashlib.sha256("\n".join((kind, *parts)).encode("utf-8", "surrogatepass")).digest()
        known = digest in seen
        seen.add(digest)
        return known

    while True:
        page = fetch(source, since, cursor)
        if not isinstance(page, dict) or not isinstance(page.get("entries"), list):
            raise ValueError(f"{source}: page {pages} has no list of entries")
        pages += 1
        entries = [json.dumps(e, sort_keys=True, ensure_ascii=False) for e in page["entries"]]  # no line breaks in them
        if entries and came("page", entries):
            raise ValueError(f"{source}: page {pages - 1} came before")
        keep(entries)
        mark = max(filter(None, (mark, page.get("mark"))), default=None)
        cursor = page.get("next")
        if cursor is None:
            return mark, pages
        if came("cursor", [json.dumps(cursor)]):
            raise ValueError(f"{source}: cursor {cursor} came before")


class _Spool:
    """Rows of one source in a temporary file of its task, in batches, until it is known that they count."""

    def __init__(self, file, source: str):
        self.file, self.source, self.waiting, self.n = file, source, [], 0
        self.out = pa.ipc.new_stream(file, _batch([(None,) * 6]).schema)

    def keep(self, entries: list[str]) -> None:
        for entry in entries:
            self.waiting.append((self.source, self.n, entry, None, None, None))
            self.n += 1
            if len(self.waiting) == 10_000:
                self._write()

    def _write(self) -> None:
        if self.waiting:
            self.out.write_batch(_batch(self.waiting))
            self.waiting = []

    def batches(self) -> Iterator[pa.RecordBatch]:
        self._write()
        self.out.close()
        self.file.seek(0)
        yield from pa.ipc.open_stream(self.file)


class _Source(InputPartition):
    def __init__(self, source: str, since: str | None):
        super().__init__((source, since))


class FeedReader(DataSourceReader):
    def __init__(self, service: str, sources: list[tuple[str, str | None]]):
        self.service, self.sources = service, sources

    def pushFilters(self, filters):
        """Equality and IN on the source leave out whole sources; Spark applies the others."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("source",):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.sources = [x for x in self.sources if x[0] in wanted]
            else:
                yield f

    def partitions(self):
        return [_Source(*x) for x in self.sources] or [_Source("", None)]

    def read(self, partition: _Source) -> Iterator[pa.RecordBatch]:
        source, since = partition.value
        if not self.sources:
            return
        kind, _, where = self.service.partition(":")
        fetch = folder_service(where) if kind == "folder" else getattr(importlib.import_module(kind), where)
        with tempfile.TemporaryFile() as file:
            spool = _Spool(file, source)
            try:
                mark, pages = traversed(fetch, source, since, spool.keep)
            except Exception as error:  # this source's, whatever it is
                yield _batch([(source, None, None, since, None, f"{type(error).__name__}: {error}")])
                return
            yield from spool.batches()
            yield _batch([(source, None, None, mark, pages, None)])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=["source", "position", "entry", "mark", "pages", "error"])


class FeedSource(DataSource):
    """``spark.read.format("lodestone_feed")`` with the options service (``folder:<path>`` or
    ``<module>:<function>``, which executors can import) and sources (JSON: [[source, mark], ...]).

    A row for each entry; of each source also one row without an entry: its new mark and the pages
    read, or its error. A source's entries wait in a temporary file of its task until its last page has come."""

    @classmethod
    def name(cls) -> str:
        return "lodestone_feed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FeedReader:
        return FeedReader(self.options["service"], [(str(s), m) for s, m in json.loads(self.options["sources"])])


def read_sources(spark: SparkSession, service: str, sources: list[tuple[str, str | None]]) -> DataFrame:
    """The rows of the sources from their marks on. Sources are a stated list, as feeds are; a name that
    repeats is an error."""
    if len({s for s, _ in sources}) < len(sources):
        raise ValueError("a source is named twice")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FeedSource)
    return spark.read.format("lodestone_feed").option("service", service).option("sources", json.dumps(sources)).load()


def declared(lines: DataFrame) -> list[str]:
    """The sources of a file of feeds (value), in order: lines without blank ends, comments and empty ones."""
    own = [r[0].strip() for r in lines.collect()]
    return [x for x in own if x and not x.startswith("#")]


def run(spark: SparkSession, service: str, sources: list[str], path: str) -> tuple[DataFrame, DataFrame]:
    """One discovery run: the new (source, position, entry) and the (source, error) of those that failed.

    ``path`` holds revisions of rows (source, position, entry, mark, pages, error), one a run; marks come
    from the last one, also those of sources that this run does not ask. If another run has
    published meanwhile, Conflict, and this one has no effect."""
    known = revisions.revisions(spark, path)
    last = known[-1] if known else 0
    marks = {}
    if last:
        marks = {r["source"]: r["mark"] for r in revisions.read(spark, path).where("entry is null").select("source", "mark").collect()}  # a row a source
    rows = shared.written(read_sources(spark, service, [(s, marks.get(s)) for s in sources]), f"{shared.folder(spark)}/rows")
    others = [(s, m) for s, m in marks.items() if s not in set(sources)]
    kept = spark.createDataFrame([(s, None, None, m, None, None) for s, m in others], SCHEMA)
    revisions.compare_and_swap(rows.unionByName(kept), path, last)
    return rows.where("entry is not null").select("source", "position", "entry"), rows.where("error is not null").select("source", "error")
