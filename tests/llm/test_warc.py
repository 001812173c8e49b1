"""WARC records and the data source: round trips, foreign files, predicates, what is left undecoded."""

import gzip
import hashlib
import io
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In, IsNotNull, Not, StringStartsWith
from pyspark.sql.types import StructType

from __spark_entry__ import oracle_sql, queries
from compare import differences, duck
from veracast.llm import warc, warc_records

LONG = "<p>" + "é" * 400_000 + "</p>"
SAME = "<html>" + "x" * 1200 + "</html>"
PAGES = [
    (1, "http://a/1", SAME, "clash"),
    (7, "http://a/7", SAME, "clash"),
    (3, None, SAME, None),
    (None, "http://a/none", SAME, None),
    (4, "http://a/4\r\nX-Evil: 1", "short", None),
    (5, "http://a/5", "short", None),
    (6, "http://a/6", None, None),
    (8, "http://a/8", "", None),
    (9, "http://a/9", LONG, None),
    (10, "http://a/10", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", None),
    (11, "http://a/11", "y" * 1000, None),
    (11, "http://a/11", "y" * 1000, None),
    (-2, "http://a/-2", "y" * 1000, None),
]
SCHEMA = "page_id long, url string, html string, payload_bytes string"


def _expected():
    out = []
    for key, _, html, _ in PAGES:
        data = (html or "").encode()
        same = [k for k, _, h, _ in PAGES if (h or "").encode() == data and k is not None]
        top = max(same, default=None) if len(data) >= 1000 else key
        first = key == top
        out.append(
            (key, len(data), hashlib.sha1(data).hexdigest())
            + (("response", None) if first else ("revisit", top))
        )
    return sorted(out, key=str)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_pages_come_back(spark, compression):
    pages = spark.createDataFrame(PAGES, SCHEMA)
    back = warc.archived(pages, compression=compression, file_bytes="4000")
    got = [
        (*[r[c] if c != "key" else r[c] and int(r[c]) for c in ("key", "payload_bytes", "payload_digest", "record_type")],
         r["refers_to"] and int(r["refers_to"]))
        for r in back.collect()
    ]
    assert sorted(got, key=str) == _expected()


def test_empty_table_and_other_names(spark):
    assert warc.archived(spark.createDataFrame([], SCHEMA)).count() == 0
    named = spark.createDataFrame([("a b~%", "u", "h")], "id string, link string, body string")
    assert warc.archived(named, key="id", url="link", html="body").first()["key"] == "a b~%"


def test_matches_duckdb(spark):
    small = "/root/testdata/sf0.001"
    assert differences(queries()["op11_warc"](spark, small), duck(small), oracle_sql()["op11_warc"]) == []


def _foreign() -> bytes:
    """An archive as other tools write it: chunked and coded bodies, requests, no skip lengths."""
    body = gzip.compress(b"<p>coded</p>")
    chunked = b"".join(b"%x\r\n%s\r\n" % (len(c), c) for c in (body[:5], body[5:])) + b"0\r\n\r\n"
    coded = b"HTTP/1.1 404 Not Found\r\nTransfer-Encoding: chunked\r\nContent-Encoding: gzip\r\n\r\n" + chunked
    parts = [
        ([("WARC-Type", "request"), ("Content-Type", "application/http; msgtype=request")], b"GET / HTTP/1.1\r\n\r\n"),
        ([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x:1>"), ("Content-Type", "application/http")], coded),
        ([("WARC-Type", "metadata"), ("Content-Type", "text/plain")], b"plain"),
    ]
    return [warc_records.record_bytes(f, b) for f, b in parts]


@pytest.mark.parametrize("packed", [False, True])
def test_foreign_archives(spark, tmp_path, packed):
    pack = gzip.compress if packed else bytes
    name = "crawl.warc.gz" if packed else "crawl.warc"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / name).write_bytes(b"".join(map(pack, _foreign())))
    (tmp_path / "in" / "_old.warc").write_bytes(b"not read")
    rows = {r["record_type"]: r for r in warc.read_archives(spark, str(tmp_path / "in")).collect()}
    assert (rows["response"]["payload"], rows["response"]["payload_bytes"]) == (b"<p>coded</p>", 12)
    assert rows["response"]["http_status"] == 404
    assert (rows["metadata"]["payload"], rows["metadata"]["record_id"]) == (b"plain", None)
    cut = b"".join(map(pack, _foreign()))[:-30]
    (tmp_path / "in" / name).write_bytes(cut)
    with pytest.raises(Exception, match="DamagedArchive"):
        warc.read_archives(spark, str(tmp_path / "in")).collect()
    left = warc.read_archives(spark, str(tmp_path / "in"), damaged="skip").collect()
    assert [r["record_type"] for r in left][:2] == ["request", "response"]


def _reader(folder, columns, *predicates, **options):
    schema = StructType([warc.SCHEMA[c] for c in columns])
    reader = warc.WarcReader(schema, {"path": str(folder), **options})
    assert list(reader.pushFilters(list(predicates))) == []
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    return rows


def _archive(folder, with_lengths=True):
    folder.mkdir()
    parts = []
    for i in range(20):
        kind = "response" if i % 4 else "revisit"
        block = b"HTTP/1.1 200 OK\r\nContent-Length: 300000\r\n\r\n" + bytes(i % 7 for _ in range(300_000))
        data = warc_records.record_bytes(
            [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:x:{i}>"), ("Content-Type", "application/http")], block
        )
        parts.append(warc_records.gzip_member(data, 1) if with_lengths else gzip.compress(data))
    (folder / "a.warc.gz").write_bytes(b"".join(parts))


class _Counting:
    """zlib with a count of the bytes inflated."""

    def __init__(self):
        self.inflated = 0

    def decompressobj(self, bits):
        outer, inner = self, zlib.decompressobj(bits)

        class One:
            eof = property(lambda s: inner.eof)
            unconsumed_tail = property(lambda s: inner.unconsumed_tail)
            unused_data = property(lambda s: inner.unused_data)

            def decompress(self, raw, most):
                data = inner.decompress(raw, most)
                outer.inflated += len(data)
                return data

        return One()

    error = zlib.error
    decompress = staticmethod(zlib.decompress)


def test_unwanted_payloads_are_not_inflated(tmp_path, monkeypatch):
    _archive(tmp_path / "sl")
    count = _Counting()
    monkeypatch.setattr(warc_records, "zlib", count)
    one = EqualTo(("record_id",), "urn:x:5")
    rows = _reader(tmp_path / "sl", ["record_id", "payload"], one)
    assert [r["record_id"] for r in rows] == ["urn:x:5"] and len(rows[0]["payload"]) == 300_000
    assert count.inflated < 300_000 + 21 * 17_000
    # No payload asked for: only headers are inflated, though all records are wanted.
    count.inflated = 0
    assert len(_reader(tmp_path / "sl", ["record_id", "payload_bytes"])) == 20
    assert count.inflated < 20 * 17_000
    monkeypatch.undo()
    # Without lengths the same rows, if at a higher price.
    _archive(tmp_path / "plain", with_lengths=False)
    assert _reader(tmp_path / "plain", ["record_id", "payload"], one) == rows


def test_predicates(tmp_path):
    _archive(tmp_path / "a")
    at = lambda *p: [r["record_id"] for r in _reader(tmp_path / "a", ["record_id"], *p)]
    assert len(at(EqualTo(("record_type",), "revisit"))) == 5
    assert len(at(Not(EqualTo(("record_type",), "revisit")))) == 15
    assert at(In(("record_id",), ["urn:x:2", "urn:x:3"]), EqualTo(("record_type",), "response")) == ["urn:x:2", "urn:x:3"]
    assert at(StringStartsWith(("record_id",), "urn:x:1"), IsNotNull(("record_id",)))[0] == "urn:x:1"
    assert at(EqualTo(("target_uri",), "x")) == at(Not(EqualTo(("target_uri",), "x"))) == []
    assert len(at(EqualTo(("http_status",), 200))) == 20
    left = warc.WarcReader(warc.SCHEMA, {"path": str(tmp_path)}).pushFilters([EqualTo(("payload",), b"")])
    assert len(list(left)) == 1


def test_filters_reach_the_reader(spark, tmp_path):
    _archive(tmp_path / "a")
    found = warc.read_archives(spark, str(tmp_path / "a"), ["record_id", "record_type"])
    some = found.where(F.col("record_type") == "revisit")
    assert some.count() == 5
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and "Filter (" not in plan


def test_partitions_hold_whole_files(tmp_path):
    for i, size in enumerate((10, 400, 30, 300, 200)):
        (tmp_path / f"{i}.warc").write_bytes(b"x" * size)
    reader = warc.WarcReader(warc.SCHEMA, {"path": str(tmp_path), "partition_bytes": "400"})
    parts = reader.partitions()
    assert len(parts) == 3
    assert sorted(n for p in parts for _, n in p.paths) == [10, 30, 200, 300, 400]
    assert max(sum(n for _, n in p.paths) for p in parts) == 400


def test_only_committed_files_are_read(spark, tmp_path):
    path = str(tmp_path / "out")
    pages = spark.createDataFrame(PAGES, SCHEMA)
    warc.write_pages(pages, path)
    read = warc.read_archives(spark, path, ["record_id", "record_type"])
    n = read.count()
    left = warc_records.record_bytes([("WARC-Type", "response")], b"left by a lost task")
    (tmp_path / "out" / "part-000000-lost-0000.warc").write_bytes(left)
    assert read.count() == n
    warc.write_pages(pages, path)
    assert read.where("record_type <> 'warcinfo'").count() == 2 * len(PAGES)


def test_skip_lengths_are_those_of_the_member():
    data = b"WARC" * 5000
    member = warc_records.gzip_member(data, 6)
    assert gzip.decompress(member) == data
    assert warc_records._member_length(member) == len(member)
    assert warc_records._member_length(gzip.compress(data)) is None
    assert list(warc_records.records(io.BytesIO(b""), 0)) == []
