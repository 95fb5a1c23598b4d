"""Archives: records are read back as they were written, revisits are resolved as a dictionary of payloads says."""

import base64
import gzip
import hashlib
import io
import uuid

import pytest
from pyspark.sql import functions as F

from folioforge.llm import warc

PAGES = [(7, "http://a.example/%41 b\r\nX: y", "one"), (3, None, "one"), (5, "http://b.example/ü", None), (6, "u", ""), (7, "u", "one"), (9, "u", "two\r\n\r\nWARC/1.1\r\n"), (None, "n", "one"), (None, "n", "only"), (1, "v", "é" * 5000), (2, "v", "é" * 5000)]


def plain(pages, min_bytes=0):
    """(key, uri, bytes, digest, type, refers_to); rows that repeat a key and payload are told apart by their number."""
    first = {}
    for k, _, p in pages:
        p = (p or "").encode()
        first[p] = min(first.get(p, (True, 0)), (k is None, k or 0))
    seen, out = set(), []
    for k, u, p in sorted(pages, key=lambda x: (x[0] is None, x[0] or 0)):
        p = (p or "").encode()
        again = len(p) >= min_bytes and p in seen
        seen.add(p)
        out.append((k, u, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response", (None if first[p][0] else first[p][1]) if again else None))
    return sorted(out, key=str)


def without_uri(rows):
    return sorted((r[0], *r[2:]) for r in rows if r[0] is not None) + sorted(r[2:5] for r in rows if r[0] is None)


@pytest.fixture()
def root(tmp_path):
    return f"file://{tmp_path}/{uuid.uuid4().hex}"


def table(spark, pages=PAGES, parts=2):
    return spark.createDataFrame([(*p, "c", 1) for p in pages], "page_id long, url string, html string, archive string, place int").repartition(parts)


@pytest.mark.parametrize("limits", [(16_000_000, 20_000), (10, 20_000), (16_000_000, 2)])
@pytest.mark.parametrize("heavy", [1000, 2])
@pytest.mark.parametrize("min_bytes", [0, 4])
def test_pages(spark, root, monkeypatch, limits, heavy, min_bytes):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", limits[0])
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", limits[1])
    monkeypatch.setattr(warc, "HEAVY", heavy)
    rows = warc.archive_pages(table(spark), root, min_bytes=min_bytes).collect()
    assert without_uri([tuple(r) for r in rows]) == without_uri(plain(PAGES, min_bytes))
    assert sorted((r.uri for r in rows), key=str) == sorted((u for _, u, _ in PAGES), key=str)


def test_archives_hold_what_they_say(spark, root, tmp_path):
    """Read with gzip and by hand: a response holds its payload, a revisit names a record that holds it."""
    warc.archive_pages(table(spark), root).collect()
    folder = tmp_path / root.rpartition("/")[2] / "deduplicated"
    records = {}
    for path in folder.glob("*.warc.gz"):
        stream = io.BytesIO(gzip.decompress(path.read_bytes()))
        while line := stream.readline():
            assert line == b"WARC/1.1\r\n"
            fields = {}
            while (line := stream.readline()) != b"\r\n":
                k, _, v = line.decode().rstrip("\r\n").partition(": ")
                fields[k] = v
            block = stream.read(int(fields["Content-Length"]))
            assert stream.read(4) == b"\r\n\r\n"
            records[fields["WARC-Record-ID"]] = fields, block
    assert not list(folder.glob(".*"))
    kept = [(f, b) for f, b in records.values() if f["WARC-Type"] != "warcinfo"]
    assert len(kept) == len(PAGES)
    for fields, block in kept:
        head, _, payload = block.partition(b"\r\n\r\n")
        if fields["WARC-Type"] == "revisit":
            assert not payload and fields["WARC-Profile"] == warc.PROFILE
            other, block = records[fields["WARC-Refers-To"]]
            assert other["WARC-Type"] == "response" and other.get("WARC-Target-URI") == fields.get("WARC-Refers-To-Target-URI")
            payload = block.partition(b"\r\n\r\n")[2]
        assert f"Content-Length: {len(payload)}".encode() in head
        assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_payloads_come_back(spark, root):
    archives = warc.write_archives(table(spark), root, "page_id", "url", "html")
    got = warc.read_archives(archives, "long", payloads=True).collect()
    assert sorted((str(r.key), str(r.uri), bytes(r.payload).decode()) for r in got) == sorted((str(k), str(u), p or "") for k, u, p in PAGES)
    again = warc.write_archives(table(spark).filter("page_id = 1"), f"{root}/b", "page_id", "url", "html").first().archive.removeprefix("file://")
    with open(again, "rb") as f:
        data = f.read()
    with open(again, "wb") as f:
        f.write(data[:-9])
    with pytest.raises(Exception, match="ends inside a record"):
        warc.read_archives(spark.createDataFrame([("file://" + again,)], "archive string")).collect()


def test_long_payloads_and_empty_tables(spark, root):
    pages = spark.createDataFrame([(1, "u"), (2, "u")], "page_id long, url string").withColumn("html", F.repeat(F.lit("<p>abc</p>"), 3_000_000))
    rows = warc.archive_pages(pages, root).orderBy("key").collect()
    assert [(r.payload_bytes, r.record_type, r.refers_to) for r in rows] == [(30_000_000, "response", None), (30_000_000, "revisit", 1)]
    assert warc.archive_pages(table(spark).limit(0), f"{root}/none").count() == 0
