"""WARC archives: a Python data source that writes and reads them.

A row to be written is a whole record. Each task compresses its records, one gzip member each with
the member's length in its header (the extra field ``sl``), into a file of its own below
``_temporary``; the files get their names when all tasks have ended, so a task that is run again
leaves nothing twice. The reader plans a partition for each archive file, takes equality and IN
predicates on WARC headers from Spark, inflates a record as far as its header block first, and
reads the rest only if a wanted record's payload column is asked for; other records are skipped by
their length. Plain archives are skipped through by Content-Length; gzip files of other writers,
which don't say how long a member is, are read as one stream."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage

from . import common as c

LEAST_REVISIT = 1000
SCHEMA = "record_type string, record_id string, target_uri string, refers_to string, payload_digest string, payload_length long, content_length long, headers map<string,string>, payload binary, file string, offset long"
_HEADER_OF = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}


# --------------------------------------------------------------------- writing
def classify(pages: DataFrame, key: str = "page_id", html: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """``pages`` with payload_bytes, payload_digest, record_type and refers_to.

    Digests are grouped with pre-aggregation (count and greatest key); only groups of two and
    more are joined back, and a join splits a hot group. Payloads are equal if their SHA-256 is, so
    pages made to agree in SHA-1 alone stay two. Of equal payloads of at least ``least`` bytes the
    greatest key is the response. Rows that repeat that key are responses all; a group
    whose keys are all null is responses only; null keys in other groups are revisits."""
    pages = c.without(pages, ["payload_bytes", "payload_digest", "record_type", "refers_to", "_same", "_d", "_first", "_n"])
    text = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    digested = pages.withColumn("payload_bytes", F.octet_length(text).cast("long")).withColumn("payload_digest", F.sha1(text.cast("binary"))).withColumn("_same", F.sha2(text.cast("binary"), 256))
    slim = digested.where(F.col("payload_bytes") >= least).groupBy(F.col("_same").alias("_d")).agg(F.max(f"`{key}`").alias("_first"), F.count("*").alias("_n"))
    joined = digested.join(slim.where("_n > 1 and _first is not null"), F.col("_same") == F.col("_d"), "left")
    revisit = F.col("_first").isNotNull() & ~F.col(f"`{key}`").eqNullSafe(F.col("_first"))
    return joined.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn("refers_to", F.when(revisit, F.col("_first"))).drop("_same", "_d", "_first", "_n")


def _urn(key: Column) -> Column:
    return F.when(key.isNull(), "<urn:lodestone:no-page>").otherwise(F.concat(F.lit("<urn:lodestone:page:"), F.url_encode(key.cast("string")), F.lit(">")))


def _key(urn: Column) -> Column:
    """The key that ``_urn`` wrote, as a string; null for a null key."""
    return F.when(urn.startswith("<urn:lodestone:page:"), F.url_decode(F.regexp_extract(urn, r"^<urn:lodestone:page:(.*)>$", 1)))


def record(key: str, url: str, html: str, date: Column) -> Column:
    """The WARC/1.1 record of a classified page, as text: its header block and an HTTP response.

    A revisit's block is the HTTP header alone; its digest and length headers describe the full
    payload. Keys are percent-encoded and so are line breaks in URLs, so that neither ends a header."""
    line = "\r\n"
    response = F.col("record_type") == "response"
    body = F.when(response, F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))).otherwise(F.lit(""))
    uri = F.regexp_replace(F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("")), r"[\x00-\x20\x7f]", "%20")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{line}Content-Type: text/html; charset=utf-8{line}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(line * 2))
    again = F.concat(F.lit(f"{line}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{line}WARC-Refers-To: "), _urn(F.col("refers_to")))
    return F.concat(
        F.lit(f"WARC/1.1{line}WARC-Type: "), F.col("record_type"), F.lit(f"{line}WARC-Record-ID: "), _urn(F.col(f"`{key}`")), F.lit(f"{line}WARC-Date: "), date,
        F.lit(f"{line}WARC-Target-URI: "), uri, F.lit(f"{line}WARC-Payload-Digest: sha1:"), F.col("payload_digest"), F.lit(f"{line}X-Payload-Length: "), F.col("payload_bytes").cast("string"),
        F.when(response, F.lit("")).otherwise(again), F.lit(f"{line}Content-Type: application/http;msgtype=response{line}Content-Length: "), (F.octet_length(http) + F.octet_length(body)).cast("string"), F.lit(line * 2), http, body, F.lit(line * 2),
    )


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", compression: str = "gzip", date: Column | None = None) -> None:
    """Adds a record for each row of classified pages to the archives below ``path``, ``gzip`` or ``none``.

    A null key has a name of its own. ``date`` (text, as WARC-Date has it) is by default the time at which
    the job begins. An empty table writes no record."""
    spark = pages.sparkSession
    date = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'") if date is None else date
    spark.dataSource.register(WarcSource)
    pages.select(record(key, url, html, date).alias("record")).write.format("lodestone_warc").mode("append").option("path", _qualified(spark, path)).option("compression", compression).save()


@dataclass
class _Written(WriterCommitMessage):
    name: str | None


def member(record: bytes) -> bytes:
    """A gzip member that says its own length (0 from 4 GiB on) and that of the record."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    data = packer.compress(record) + packer.flush()
    size = 24 + len(data) + 8
    sizes = (size, len(record)) if max(size, len(record)) < 1 << 32 else (0, 0)
    head = struct.pack("<BBBBIBBHccHII", 0x1F, 0x8B, 8, 4, 0, 0, 255, 12, b"s", b"l", 8, *sizes)
    return head + data + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


class WarcWriter(DataSourceArrowWriter):
    """A file a task below ``_temporary``; all move up together when the job commits."""

    def __init__(self, path: str, packed: bool):
        self.path, self.packed = path.rstrip("/"), packed

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        system, root = _system(self.path)
        name, out = f"part-{uuid.uuid4().hex}.warc{'.gz' if self.packed else ''}", None
        for batch in iterator:
            for text in batch.column(0):
                if out is None:
                    system.create_dir(f"{root}/_temporary", recursive=True)
                    out = system.open_output_stream(f"{root}/_temporary/{name}", compression=None)
                held = text.as_py().encode()
                out.write(member(held) if self.packed else held)
        if out:
            out.close()
        return _Written(name if out else None)

    def commit(self, messages: list[_Written | None]) -> None:
        system, root = _system(self.path)
        system.create_dir(root, recursive=True)
        for m in messages:
            if m and m.name:
                system.move(f"{root}/_temporary/{m.name}", f"{root}/{m.name}")
        self.abort(messages)

    def abort(self, messages: list[_Written | None]) -> None:
        """What remains below ``_temporary`` goes: files of failed tasks, and of those that were run twice."""
        from pyarrow import fs

        system, root = _system(self.path)
        if system.get_file_info(f"{root}/_temporary").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/_temporary")


# --------------------------------------------------------------------- reading
class _File(InputPartition):
    def __init__(self, path: str, size: int):
        super().__init__((path, size))


def _qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that Spark would use: executors' tasks don't know its default file system."""
    held = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = held.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(held).toString()
    return whole.replace("file:/", "file:///", 1) if whole.startswith("file:/") and not whole.startswith("file://") else whole


def _system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class WarcReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str], schema):
        self.path, self.columns, self.schema = path, columns, schema
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters):
        """Keeps equality and IN on header columns for the scan; Spark applies the others."""
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name in _HEADER_OF:
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[name] = self.wanted[name] & values if name in self.wanted else values
            else:
                yield f

    def partitions(self):
        from pyarrow import fs

        system, root = _system(self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=True)) if system.get_file_info(root).type == fs.FileType.Directory else [system.get_file_info(root)]
        files = [_File(x.path, x.size) for x in found if x.type == fs.FileType.File and x.size and not x.base_name.startswith(("_", "."))]
        return sorted(files, key=lambda f: f.value) or [_File("", 0)]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(self.schema)
        path, _ = partition.value
        if not path:
            return
        system, _ = _system(self.path)
        rows, size = [], 0
        packed = path.endswith(".gz") and not _tells_lengths(system, path)
        with system.open_input_stream(path, compression="gzip") if packed else system.open_input_file(path) as raw:
            reader = members if path.endswith(".gz") and not packed else records
            for row in reader(raw, path, self.wanted, "payload" in self.columns):
                rows.append(row)
                size += len(row["payload"] or b"") + 400
                if size >= 8 << 20:
                    yield _batch(rows, target)
                    rows, size = [], 0
        if rows:
            yield _batch(rows, target)


def _batch(rows: list[dict], target: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[f.name] if f.name != "headers" else list(r["headers"].items()) for r in rows], f.type) for f in target], schema=target)


class _Window:
    """Buffered forward reading with cheap skips over an input file; of a stream, what is skipped is read."""

    def __init__(self, raw, step: int = 1 << 20):
        self.raw, self.step, self.held, self.at = raw, step, b"", 0
        self.size = raw.size() if raw.seekable() else None

    def until(self, mark: bytes) -> bytes | None:
        scanned = 0
        while (i := self.held.find(mark, max(0, scanned - len(mark)))) < 0:
            scanned = len(self.held)
            more = self.raw.read(self.step)
            if not more:
                return None
            self.held += more
        out, self.held = self.held[:i], self.held[i + len(mark) :]
        self.at += i + len(mark)
        return out

    def take(self, n: int) -> bytes:
        if n > len(self.held):
            self.held += self.raw.read(n - len(self.held))
        out, self.held = self.held[:n], self.held[n:]
        if len(out) < n:
            raise ValueError("the archive ends inside a record")
        self.at += n
        return out

    def skip(self, n: int) -> None:
        if n <= len(self.held):
            self.held = self.held[n:]
            self.at += n
        elif self.size is None:
            while n > len(self.held):
                n -= len(self.held)
                self.at += len(self.held)
                self.held = self.raw.read(self.step)
                if not self.held:
                    raise ValueError("the archive ends inside a record")
            self.skip(n)
        else:
            self.raw.seek(self.at + n)
            self.held = b""
            self.at += n
            if self.at > self.size:
                raise ValueError("the archive ends inside a record")


def _headers(block: bytes, path: str, start: int) -> dict[str, str]:
    first, *lines = block.decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"{path}: no record begins at {start}")
    headers = {}
    for line in lines:
        name, _, value = line.partition(":")
        headers[name.strip().lower()] = value.strip()
    if not headers.get("content-length", "").isdecimal():
        raise ValueError(f"{path}: no Content-Length in the record that begins at {start}")
    return headers


def _row(headers: dict[str, str], path: str, start: int) -> dict:
    size = int(headers["content-length"])
    return {k: headers.get(h) for k, h in _HEADER_OF.items()} | {"payload_length": int(headers.get("x-payload-length", size)), "content_length": size, "headers": headers, "payload": None, "file": path, "offset": start}


def _payload(headers: dict[str, str], block: bytes) -> bytes:
    """Of an HTTP message its body, else the whole block."""
    return block.partition(b"\r\n\r\n")[2] if headers.get("content-type", "").lower().startswith("application/http") else block


def records(raw, path: str, wanted: dict[str, set], with_payload: bool) -> Iterator[dict]:
    """The records of one archive: header block first; payloads of unwanted records are skipped.

    A record without a Content-Length of digits is an error, as nothing tells where it ends. Offsets
    count uncompressed bytes."""
    window = _Window(raw)
    while True:
        start = window.at
        block = window.until(b"\r\n\r\n")
        if block is None:
            if window.held.strip():
                raise ValueError(f"{path}: no end of the header block that begins at {start}")
            return
        headers = _headers(block, path, start)
        row = _row(headers, path, start)
        if all(row[k] in values for k, values in wanted.items()):
            if with_payload:
                row["payload"] = _payload(headers, window.take(row["content_length"]))
            else:
                window.skip(row["content_length"])
            yield row
        else:
            window.skip(row["content_length"])
        window.skip(4)


#: Compressed bytes that are inflated at a time until the header block ends.
_FIRST = 1024


def _length(head: bytes) -> int:
    """The length that a member's header tells; 0 if it tells none."""
    told = len(head) == 24 and head[:4] == b"\x1f\x8b\x08\x04" and head[10:16] == b"\x0c\x00sl\x08\x00"
    return struct.unpack("<I", head[16:20])[0] if told else 0


def _tells_lengths(system, path: str) -> bool:
    """Whether the file's first member does; its other ones are of the same writer then."""
    with system.open_input_file(path) as raw:
        return bool(_length(raw.read(24)))


def members(raw, path: str, wanted: dict[str, set], with_payload: bool) -> Iterator[dict]:
    """The records of a file of gzip members that tell their length: each is inflated up to the end of its
    header block, and further only for a wanted record's payload. Offsets are those of members. A
    member among them that tells no length is an error."""
    window = _Window(raw)
    while window.at < window.size:
        start = window.at
        left = _length(window.take(24)) - 24
        if left < 0:
            raise ValueError(f"{path}: the member that begins at {start} doesn't tell its length")
        inflater, block = zlib.decompressobj(-15), b""
        while (end := block.find(b"\r\n\r\n")) < 0:
            if not left:
                raise ValueError(f"{path}: no end of the header block that begins at {start}")
            step = min(left, _FIRST)
            block += inflater.decompress(window.take(step))
            left -= step
        headers = _headers(block[:end], path, start)
        row = _row(headers, path, start)
        if all(row[k] in values for k, values in wanted.items()):
            if with_payload:
                block += inflater.decompress(window.take(left))
                left = 0
                body = block[end + 4 : end + 4 + row["content_length"]]
                if len(body) < row["content_length"]:
                    raise ValueError("the archive ends inside a record")
                row["payload"] = _payload(headers, body)
            yield row
        window.skip(left)


class WarcSource(DataSource):
    """``spark.read.format("lodestone_warc").option("columns", "record_type,...").load(path)``; it writes rows
    of one text column, a record each (option ``compression``: gzip or none), and appends only."""

    @classmethod
    def name(cls) -> str:
        return "lodestone_warc"

    def _columns(self) -> list[str]:
        asked = [x.strip() for x in self.options.get("columns", "").split(",") if x.strip()]
        return asked or [x.split(" ")[0] for x in SCHEMA.split(", ")]

    def schema(self) -> str:
        of = dict(x.split(" ", 1) for x in SCHEMA.split(", "))
        return ", ".join(f"`{k}` {of[k]}" for k in self._columns())

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self._columns(), schema)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are added to, not replaced")
        return WarcWriter(self.options["path"], self.options.get("compression", "gzip") == "gzip")


def read_archives(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The records below ``path`` with the given columns (all by default); filters on record_type
    and the other header columns reach the scan."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("lodestone_warc").option("columns", ",".join(columns or [])).load(_qualified(spark, path))


def round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """Archives ``pages`` and reads them back, once: page_id, payload_bytes, payload_digest, record_type
    and refers_to. Of responses, size and digest are computed from the payload read; of revisits,
    which have none, they come from the headers. Null keys come back null; keys that repeat come back
    as often; an empty table gives no rows; other columns are left out."""
    write_archives(classify(pages), folder)
    read = read_archives(pages.sparkSession, folder, ["record_type", "record_id", "refers_to", "payload_digest", "payload_length", "payload"]).where(F.col("record_type").isin("response", "revisit"))
    kind, full = pages.schema["page_id"].dataType, F.col("record_type") == "response"
    return read.select(
        _key(F.col("record_id")).cast(kind).alias("page_id"), F.when(full, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(full, F.sha1("payload")).otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"), "record_type", _key(F.col("refers_to")).cast(kind).alias("refers_to"),
    )
