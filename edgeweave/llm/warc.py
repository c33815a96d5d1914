"""WARC archives: writing, normalising whole-file gzip streams, and reading by a sidecar index.

``write_archives`` writes one record per page into files that are one gzip stream each, as crawls often
hand them over. ``normalise`` inflates such a stream once, from front to back, rewrites every record
as a gzip member of its own and writes an index with each member's offset and length beside the
file. ``read_records`` opens members by that index alone. All three work file by file inside tasks and
hold one buffer of a record's bytes at a time when they copy; files are named anew by every
attempt, and only those that a finished task reports are used, so a lost executor or a second
attempt does no harm. Files are written through ``pyarrow.fs``, which must know the folder's scheme.

Records with equal payloads of at least ``MIN_REVISIT`` bytes are written once: the page with the
smallest id is the response, the others are revisits that refer to it.
"""

from __future__ import annotations

from collections.abc import Iterator
import hashlib
import posixpath
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F
from urllib.parse import quote

from edgeweave.session import cut_lineage, drop_table, fresh_path, written_table

MIN_REVISIT, FILE_BYTES, CHUNK, GZIP = 100, 1 << 28, 1 << 18, 31
# Fixed values of the format.
VERSION, END, BREAK = b"WARC/1.1", b"\r\n\r\n", b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


def _member():
    """A compressor for one gzip member."""
    return zlib.compressobj(6, zlib.DEFLATED, GZIP)


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _head(fields: list[tuple[str, object]]) -> bytes:
    return VERSION + BREAK + b"".join(f"{k}: {v}".encode() + BREAK for k, v in fields) + BREAK


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """One record; a revisit when ``first``, the id of the response with the same payload, is another id."""
    revisit = first is not None and first != page_id
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:page:{page_id}"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += f"Content-Length: {len(payload)}".encode() + END
    block = http if revisit else http + payload
    fields: list[tuple[str, object]] = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(first)), ("Refers-To-Page", first)]
    if page_id is not None:
        fields.append(("Page-ID", page_id))
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    return _head(fields) + block + END


class Inflated:
    """The bytes of a gzip file of one or more members, read once from front to back."""

    def __init__(self, source) -> None:
        self.source, self.raw, self.ready = source, b"", b""
        self.inflate = zlib.decompressobj(GZIP)

    def _filled(self) -> bool:
        self.raw = self.raw or self.source.read(CHUNK)
        return bool(self.raw)

    def _more(self) -> bool:
        """Whether ``ready`` grew; false at the end of the file."""
        while True:
            if self.inflate.eof:
                self.raw = self.inflate.unused_data
                if not self._filled():
                    return False
                self.inflate = zlib.decompressobj(GZIP)
            if not self._filled():
                raise ValueError("the gzip stream ends early")
            fresh = self.inflate.decompress(self.raw, CHUNK)
            self.raw = self.inflate.unconsumed_tail
            if fresh:
                self.ready += fresh
                return True

    def head(self) -> bytes | None:
        """The lines up to and with the next empty line, or None at the end; skips line breaks before."""
        while END not in (begun := self.ready.lstrip(BREAK)):
            self.ready = begun
            if not self._more():
                if begun:
                    raise ValueError("a record ends early")
                return None
        lines, self.ready = begun.split(END, 1)
        return lines + END

    def pieces(self, count: int) -> Iterator[bytes]:
        """The next ``count`` bytes, a buffer at a time."""
        while count:
            if not self.ready and not self._more():
                raise ValueError("a record ends early")
            piece, self.ready = self.ready[:count], self.ready[count:]
            count -= len(piece)
            yield piece


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.strip().split(BREAK)
    if not lines[0].startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (line.decode().partition(":") for line in lines[1:])}


def _marked(pages: DataFrame) -> tuple[DataFrame, str]:
    """``(page_id, url, payload, digest, first)``; ``first`` is set where several payloads are equal.

    The equal digests are a table of their own (the second result is its path), so Spark knows its
    size: with few of them no page is shuffled, with many the join splits a hot digest.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long_enough = rows.filter(F.octet_length("payload") >= MIN_REVISIT)
    equal = long_enough.groupBy(F.col("digest").alias("shared")).agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("rows"))
    equal, path = written_table(equal.filter("rows > 1").select("shared", "first"), "digests")
    # short payloads match no digest of ``equal``, which has the long ones alone
    return rows.join(equal, rows["digest"] == equal["shared"], "left").drop("shared"), path


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write one record per row of ``pages (page_id, url, html)``; returns ``(path, records)`` per file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _place(folder)
        system.create_dir(base, recursive=True)
        out = squeeze = name = None
        size = records = 0

        def finished() -> pa.RecordBatch:
            out.write(squeeze.flush())
            out.close()
            return pa.RecordBatch.from_pydict({"path": [posixpath.join(folder, name)], "records": pa.array([records], pa.int64())})

        for rows in batches:
            for page, url, payload, digest, first in zip(*(rows.column(c) for c in ("page_id", "url", "payload", "digest", "first"))):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, squeeze = system.open_output_stream(posixpath.join(base, name), compression=None), _member()
                    size = records = 0
                data = record(page.as_py(), url.as_py(), payload.as_py(), digest.as_py(), first.as_py())
                out.write(squeeze.compress(data))
                size, records = size + len(data), records + 1
                if size >= FILE_BYTES:
                    yield finished()
                    out = None
        if out is not None:
            yield finished()

    marked, digests = _marked(pages)
    files = cut_lineage(marked.mapInArrow(run, "path string, records long"))
    drop_table(pages.sparkSession, digests)
    return files


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Rewrite every file of ``files (path)`` with one gzip member per record; ``(path, index, records)`` per file.

    The index has one line per record: the member's offset and length, the record's type and id,
    separated by tabs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = _place(folder)
        target.create_dir(base, recursive=True)
        for rows in batches:
            for path in rows.column("path").to_pylist():
                system, at = _place(path)
                name = f"{uuid.uuid4().hex}.warc.gz"
                offset = records = 0
                with (
                    system.open_input_stream(at, compression=None) as source,
                    target.open_output_stream(posixpath.join(base, name), compression=None) as out,
                    target.open_output_stream(posixpath.join(base, name + ".idx"), compression=None) as index,
                ):
                    stream = Inflated(source)
                    while (head := stream.head()) is not None:
                        fields = fields_of(head)
                        squeeze = _member()
                        length = out.write(squeeze.compress(head))
                        for piece in stream.pieces(int(fields["content-length"])):
                            length += out.write(squeeze.compress(piece))
                        length += out.write(squeeze.compress(END) + squeeze.flush())
                        line = (str(offset), str(length), fields["warc-type"], fields["warc-record-id"])
                        index.write("\t".join(line).encode() + b"\n")
                        offset, records = offset + length, records + 1
                where = posixpath.join(folder, name)
                yield pa.RecordBatch.from_pydict({"path": [where], "index": [where + ".idx"], "records": pa.array([records], pa.int64())})

    return cut_lineage(_one_by_one(files, "path").mapInArrow(run, "path string, index string, records long"))


def _one_by_one(files: DataFrame, *columns: str) -> DataFrame:
    """A partition per file, which Spark does not merge however few bytes the names have."""
    return files.select(*columns).repartition(max(1, files.count()))


_RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("url", pa.string()),
    ]
)


def parsed(member: bytes) -> tuple:
    """A row of ``_RECORD`` from one gzip member; a payload that does not fit its digest is an error."""
    data = zlib.decompress(member, GZIP)
    head, rest = data.split(END, 1)
    fields = fields_of(head)
    block = rest[: int(fields["content-length"])]
    if rest[len(block) :] != END:
        raise ValueError("a record does not end as it should")
    http, payload = block.split(END, 1)
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    length = int(http.rpartition(b"Content-Length:")[2])
    revisit = fields["warc-type"] == "revisit"
    if not revisit and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
    number = lambda key: int(fields[key]) if key in fields else None
    return number("page-id"), length, digest, fields["warc-type"], number("refers-to-page"), fields["warc-target-uri"]


def read_records(files: DataFrame) -> DataFrame:
    """The records of ``files (path, index)``, each read through its index entry."""
    names = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'string'}" for f in _RECORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for path, index in zip(rows.column("path").to_pylist(), rows.column("index").to_pylist()):
                system, at = _place(path)
                with system.open_input_stream(_place(index)[1], compression=None) as lines:
                    entries = lines.read().decode().splitlines()
                with system.open_input_file(at) as source:
                    for first in range(0, len(entries), 1000):
                        found = []
                        for line in entries[first : first + 1000]:
                            offset, length, kind, name = line.split("\t")
                            source.seek(int(offset))
                            found.append(parsed(source.read(int(length))))
                        columns = [pa.array(c, f.type) for c, f in zip(zip(*found), _RECORD)]
                        yield pa.RecordBatch.from_arrays(columns, schema=_RECORD)

    return _one_by_one(files, "path", "index").mapInArrow(run, names)


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages (page_id, url, html)`` to archives, normalise them and read the records back.

    ``(page_id, payload_bytes, payload_digest, record_type, refers_to, url)`` per row. A null html is an
    empty payload, a null url gets a name made of the id, a null id stays null and never is what
    others refer to. Repeated rows are written each; those with the smallest id are all responses.
    An empty table gives no rows, columns beyond the three are ignored. The normalised archives stay
    in the shared folder; the whole-file streams are removed once they are rewritten.
    """
    spark = pages.sparkSession
    raw, final = fresh_path(spark, "warc-streams"), fresh_path(spark, "warc")
    files = normalise(write_archives(pages, raw), final)
    drop_table(spark, raw)
    return read_records(files)


#: DuckDB SQL for the digest columns of ``archived`` over ``pages``.
ARCHIVED_SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
firsts AS (
  SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest,
         CASE WHEN strlen(html) >= 100 THEN min(page_id) OVER (PARTITION BY html) END AS response
  FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN response IS NULL OR response IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN response IS NOT NULL AND response IS DISTINCT FROM page_id THEN response END AS refers_to
FROM firsts
"""
