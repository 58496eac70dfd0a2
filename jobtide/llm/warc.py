"""WARC archives with a two-level capture index.

Writing: each task writes archives of its own, a gzip member per record.  Captures are then sorted
by reversed host, path and page; each task writes one index file of compressed blocks, followed by
a sparse directory of the blocks' first keys.  Reading: the first key of each index file (one per
task) leads to the file, a binary search in its directory to the block, one in the block to the
capture, and a range read to the record.

Files are named after the task attempt and known only through what a successful task returns, so a
task that is run again leaves a file behind that nobody reads.
"""

import bisect
import gzip
import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm.common import settle, workspace
from jobtide.llm.urls import host

SMALLEST_REVISIT = 100  # bytes of payload
ARCHIVE_BYTES = 1 << 26  # an archive is closed beyond
BLOCK_LINES = 512
READ_BYTES = 1 << 23  # of an archive read by one task
_LEVEL = 4
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_TRAILER = 16


def location(spark: SparkSession, folder: str) -> str:
    """The folder as a URI that any process can open."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path)
    uri = full.toString()
    return f"file://{uri[5:]}" if uri.startswith("file:/") and not uri.startswith("file://") else uri


_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def plain_uri(uri: str) -> str:
    """The address of a store as pyarrow knows it: Hadoop has other names for the same."""
    scheme, rest = uri.split(":", 1)
    return f"{_SCHEMES.get(scheme, scheme)}:{rest}"


def _store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(plain_uri(uri))


def _one_line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def _record_id(page: object) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def pack_record(page, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One record as a gzip member; a revisit leaves the payload out."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {_one_line(url or '')}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    coder = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return coder.compress(raw) + coder.flush()


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "surrogatepass").partition(": ") for line in lines)
    return {name: value for name, _, value in pairs}


def unpack_record(member: bytes) -> tuple[dict[str, str], int, bytes | None]:
    """Header, length of the full payload, and the payload unless the record is a revisit."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _fields(head.split(b"\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(_fields(http.split(b"\r\n")[1:])["Content-Length"])
    return fields, size, payload if fields["WARC-Type"] == "response" else None


def key(url: Column, page: Column) -> Column:
    """Reversed host, rest of the URL, and the page: sorts a site's captures together."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(.*)$", 1), F.lit(""))
    names = F.array_join(F.reverse(F.split(host(url), r"\.")), ",")
    return F.concat(names, F.lit(")"), rest, F.lit("\t"), F.coalesce(page.cast("string"), F.lit("")))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per page; returns ``key, file, offset, length``, itself written."""
    uri = location(pages.sparkSession, folder)
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        "page_id", "url", payload.alias("html"), F.sha2(payload.cast("binary"), 256).alias("digest")
    )
    firsts = settle(
        rows.where(F.octet_length("html") >= SMALLEST_REVISIT)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first"),
        folder,
        "firsts",
    )
    refers_to = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))
    rows = rows.join(firsts, "digest", "left").select(
        "page_id",
        "url",
        "html",
        "digest",
        refers_to.alias("refers_to"),
        key(F.col("url"), F.col("page_id")).alias("key"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(uri)
        store.create_dir(f"{root}/archives", recursive=True)
        attempt, number, file, size = TaskContext.get().taskAttemptId(), 0, None, 0
        for batch in batches:
            found = []
            # Row by row: a batch of pages as Python objects could be large.
            for i in range(batch.num_rows):
                page, url, html, digest, first, name = (c[i].as_py() for c in batch.columns)
                if file is None:
                    path = f"archives/{attempt}-{number}.warc.gz"
                    file, size = store.open_output_stream(f"{root}/{path}", compression=None), 0
                member = pack_record(page, url, html.encode("utf-8", "surrogatepass"), digest, first)
                file.write(member)
                found.append((name, path, size, len(member)))
                size += len(member)
                if size >= ARCHIVE_BYTES:
                    file.close()
                    file, number = None, number + 1
            columns = list(zip(*found, strict=True)) or [[], [], [], []]
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["key", "file", "offset", "length"],
            )
        if file is not None:
            file.close()

    captures = rows.mapInArrow(work, "key string, file string, offset bigint, length bigint")
    return settle(captures, folder, "captures")


def write_index(captures: DataFrame, folder: str) -> list[tuple[str, str]]:
    """Write the sorted index; returns (first key, file) of each of its files, in order."""
    uri = location(captures.sparkSession, folder)
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "file", "offset"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(uri)
        store.create_dir(f"{root}/index", recursive=True)
        path = f"index/{TaskContext.get().taskAttemptId()}.idx"
        file, size, lines, directory = None, 0, [], []

        def close_block() -> None:
            nonlocal size
            block = zlib.compress(json.dumps(lines).encode("utf-8", "surrogatepass"), _LEVEL)
            file.write(block)
            directory.append((lines[0][0], size, len(block)))
            size += len(block)
            lines.clear()

        for batch in batches:
            if batch.num_rows and file is None:
                file = store.open_output_stream(f"{root}/{path}", compression=None)
            for line in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                lines.append(line)
                if len(lines) == BLOCK_LINES:
                    close_block()
        if file is not None:
            if lines:
                close_block()
            sparse = zlib.compress(json.dumps(directory).encode("utf-8", "surrogatepass"), _LEVEL)
            file.write(sparse)
            file.write(len(sparse).to_bytes(_TRAILER, "big"))
            file.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([directory[0][0]]), pa.array([path])], ["first", "file"]
            )

    sorted_captures = captures.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    files = settle(sorted_captures.mapInArrow(work, "first string, file string"), folder, "files")
    # Spark compares the bytes of keys; so does the search.
    return sorted(((r["first"], r["file"]) for r in files.collect()), key=lambda r: r[0].encode("utf-8", "surrogatepass"))


class IndexFile:
    """Binary search in one index file."""

    def __init__(self, uri: str, path: str):
        store, root = _store(uri)
        self.file = store.open_input_file(f"{root}/{path}")
        end = self.file.size() - _TRAILER
        length = int.from_bytes(self.file.read_at(_TRAILER, end), "big")
        self.directory = json.loads(zlib.decompress(self.file.read_at(length, end - length)))
        self.firsts = [self._bytes(entry[0]) for entry in self.directory]
        self.number, self.block, self.keys = -1, [], []

    @staticmethod
    def _bytes(text: str) -> bytes:
        return text.encode("utf-8", "surrogatepass")

    def _read(self, number: int) -> None:
        if number != self.number:
            _, offset, length = self.directory[number]
            self.block = json.loads(zlib.decompress(self.file.read_at(length, offset)))
            self.keys = [self._bytes(line[0]) for line in self.block]
            self.number = number

    def find(self, name: str) -> Iterator[tuple[str, int, int]]:
        """File, offset and length of every capture with the key."""
        wanted = self._bytes(name)
        number = max(0, bisect.bisect_left(self.firsts, wanted) - 1)
        while number < len(self.firsts) and self.firsts[number] <= wanted:
            self._read(number)
            at = bisect.bisect_left(self.keys, wanted)
            while at < len(self.keys) and self.keys[at] == wanted:
                yield tuple(self.block[at][1:])
                at += 1
            number += 1


def look_up(requests: DataFrame, files: list[tuple[str, str]], folder: str) -> DataFrame:
    """``file, offset, length`` of the captures of the distinct ``key`` values."""
    uri = location(requests.sparkSession, folder)
    firsts = [first.encode("utf-8", "surrogatepass") for first, _ in files]
    parts = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, index = -1, None
        for batch in batches:
            found = []
            for name in batch.column(0).to_pylist():
                # Equal keys may reach over the border of two files.
                number = max(0, bisect.bisect_left(firsts, name.encode("utf-8", "surrogatepass")) - 1)
                while number < len(firsts) and firsts[number] <= name.encode("utf-8", "surrogatepass"):
                    if number != opened:
                        opened, index = number, IndexFile(uri, files[number][1])
                    found += index.find(name)
                    number += 1
            columns = list(zip(*found, strict=True)) or [[], [], []]
            kinds = [pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["file", "offset", "length"],
            )

    wanted = requests.select("key").distinct()
    # In the order of the index, so that a block is read once.
    wanted = wanted.repartitionByRange(parts, "key").sortWithinPartitions("key")
    return wanted.mapInArrow(work, "file string, offset bigint, length bigint")


def read_records(places: DataFrame, folder: str, page_kind: str) -> DataFrame:
    """Range-read the records at ``file, offset, length``."""
    uri = location(places.sparkSession, folder)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(uri)
        opened, file = None, None
        for batch in batches:
            rows = []
            for path, offset, length in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if path != opened:
                    opened, file = path, store.open_input_file(f"{root}/{path}")
                fields, size, payload = unpack_record(file.read_at(length, offset))
                digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                if payload is not None:
                    size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                page = fields["WARC-Record-ID"][10:-1]
                first = fields.get("WARC-Refers-To", "<urn:page:>")[10:-1]
                rows.append((page or None, size, digest, fields["WARC-Type"], first or None))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
            )

    part = F.floor(F.col("offset") / READ_BYTES)
    dealt = places.repartition("file", part).sortWithinPartitions("file", "offset")
    kind = "page_id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string"
    return dealt.mapInArrow(work, kind).select(
        F.col("page_id").cast(page_kind),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(page_kind),
    )


def archive(pages: DataFrame) -> DataFrame:
    """Write all pages to archives, index them, and read every capture back through the index.

    ``pages`` needs ``page_id``, ``url`` and ``html``.  Returns ``page_id, payload_bytes,
    payload_digest, record_type, refers_to``.  A null text is an empty payload, a null URL an empty
    one.  Of equal payloads of at least ``SMALLEST_REVISIT`` bytes that of the smallest page is
    the response; a page without id is a revisit of it, or a response if no copy has an id.
    Repeated rows are records of their own: those of the smallest page are all responses.
    """
    folder = workspace(pages.sparkSession)
    pages = pages.select("page_id", "url", "html")
    files = write_index(write_archives(pages, folder), folder)
    requests = pages.select(key(F.col("url"), F.col("page_id")).alias("key"))
    found = look_up(requests, files, folder)
    return read_records(found, folder, pages.schema["page_id"].dataType.simpleString())
