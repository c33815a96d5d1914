import gzip
import hashlib
import zlib

import pytest

from compare import connect, spark_bag, sql_bag
from edgeweave.llm import queries, warc

LONG = "<p>é " * 40


def plain_rows(rows):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        first = min(same) if same and len(data) >= 100 else None
        revisit = first is not None and first != page
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


ROWS = [
    (5, "http://a/é\r\nX: y", LONG),
    (3, None, LONG),
    (9, "http://b", LONG),
    (None, "http://c", LONG),
    (None, "http://c", "none other " * 30),
    (1, "http://d", None),
    (2, "http://d", ""),
    (4, "http://e", "short"),
    (6, "http://e", "short"),
    (7, "http://f", "\r\n\r\nWARC/1.1\r\n\r\n" * 20),
    (8, "http://g", "x" * 700_000),
    (9, "http://b", LONG),
    (10, "", "b" * 100),
    (11, "", "b" * 100),
    (12, "", "b" * 99),
    (13, "", "b" * 99),
]


def frame(spark, rows):
    return spark.createDataFrame([(p, u, h, "x") for p, u, h in rows], "page_id long, url string, html string, digest string")


def test_round_trip(spark):
    got = [tuple(r)[:5] for r in warc.archived(frame(spark, ROWS)).collect()]
    assert sorted(got, key=str) == plain_rows(ROWS)
    assert warc.archived(frame(spark, ROWS).limit(0)).collect() == []


def test_files(spark, tmp_path, monkeypatch):
    """The first files are one stream each, the others have a member per record where the index says."""
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    streams = warc.write_archives(frame(spark, ROWS).coalesce(1), str(tmp_path / "a"))
    paths = [r.path for r in streams.collect()]
    assert sum(r.records for r in streams.collect()) == len(ROWS)
    records = []
    for path in paths:
        one = zlib.decompressobj(31)
        one.decompress(open(path, "rb").read())
        assert one.eof and not one.unused_data  # a single member
    for r in warc.normalise(streams, str(tmp_path / "b")).collect():
        data = open(r.path, "rb").read()
        end = 0
        for line in open(r["index"]).read().splitlines():
            offset, length, kind, name = line.split("\t")
            assert int(offset) == end
            end += int(length)
            whole = gzip.decompress(data[int(offset) : end])
            assert whole.startswith(b"WARC/1.1\r\n") and whole.endswith(b"\r\n\r\n") and name.encode() in whole
            records.append(whole)
        assert end == len(data)
    want = b"".join(gzip.decompress(open(p, "rb").read()) for p in paths)
    assert len(records) == len(ROWS) and len(want) == sum(map(len, records)) and all(r in want for r in records)


def test_streams_of_many_members_and_damage(spark, tmp_path):
    one = warc.record(1, "http://a", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    (tmp_path / "m.warc.gz").write_bytes(gzip.compress(one[:30]) + gzip.compress(one[30:] + one))
    files = spark.createDataFrame([(str(tmp_path / "m.warc.gz"),)], "path string")
    assert warc.read_records(warc.normalise(files, str(tmp_path / "out"))).count() == 2
    with pytest.raises(ValueError, match="damaged"):
        warc.parsed(gzip.compress(one.replace(b"payload\r", b"pay1oad\r")))
    for broken in (gzip.compress(one)[:-20], gzip.compress(one[:-30])):
        (tmp_path / "n.warc.gz").write_bytes(broken)
        with pytest.raises(ValueError, match="ends early"):
            stream = warc.Inflated(open(tmp_path / "n.warc.gz", "rb"))
            while (head := stream.head()) is not None:
                list(stream.pieces(int(warc.fields_of(head)["content-length"])))


def test_query_matches_sql(spark):
    sf, name = "/root/testdata/sf0.001", "op8_warc_members"
    assert spark_bag(queries.queries()[name](spark, sf)) == sql_bag(connect(sf), queries.oracle_sql()[name])
