"""Operator 13: WARC archives and revisit resolution.

`write_archives` writes one record for each row, a gzip member each, into archives
of bounded size; `read_archives` streams them back, payloads left out unless
they are asked for. `resolve` deals the headers alone by payload digest: of the
records with equal payloads that with the smallest key is the response and the
others revisit it. `deduplicate` writes the archives anew, one for each old one,
with fresh headers: revisits keep their HTTP header and name the record, address
and date that they refer to. `revisited` joins the revisits of such archives to
their responses and so gives each record the length and digest of its full payload.

At scale: payloads never move between tasks; a digest's smallest key is found by
combining before the shuffle, and digests that hold over a HEAVY-th of the records
(so HEAVY at most) meet their records by broadcast, the rest by a shuffle. Tasks
stream archives record by record. Archives are written under a name of their own
and then moved to a name that depends on task and number only, and are read by the
lists that finished tasks return, so a task that runs twice leaves the same files.

Paths are URIs that pyarrow's file systems know; `root` has to be shared by all
executors.

Edge cases: a null payload is empty; null addresses have no WARC-Target-URI and are
null again; control characters and % in them are percent-encoded. Records that
repeat a key and its payload are told apart by their place: the first is the
response, the others revisit it. Null keys come after all others. Payloads
shorter than min_bytes are always responses. Empty tables give no archives and
no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import checkpoint_root, map_rows, stage, text_bytes

#: Bytes of payload and records in an archive, at most (a larger payload has one to itself).
ARCHIVE_BYTES, ARCHIVE_RECORDS = 16_000_000, 20_000
#: Digests with more than this part of all records are joined by broadcast.
HEAVY = 1000
#: Bytes read at once.
READ = 1 << 20
LEVEL = 3
#: The format's version line, and the profile of revisits by payload digest.
VERSION, PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"

HEADERS = "archive string, place long, record_id string, record_type string, uri string, date string, digest string, payload_bytes long, refers_to_record string"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(*parts) -> str:
    """An id that a task gives again when it runs again."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '/'.join(map(str, parts)))}>"


def encode_uri(uri: str) -> str:
    return quote(uri, safe="".join(chr(c) for c in range(33, 127) if c != 37), encoding="utf-8", errors="surrogatepass")


def record_bytes(fields: dict[str, str | None], block: bytes) -> bytes:
    """A record as a gzip member of its own; fields that are None are left out."""
    lines = [VERSION, *(f"{k}: {v}" for k, v in fields.items() if v is not None), f"Content-Length: {len(block)}"]
    packed = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packed.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packed.flush()


def http_header(payload_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()


def members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, one after another."""
    rest = b""
    while rest or (rest := stream.read(READ)):
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:
            if not rest and not (rest := stream.read(READ)):
                raise ValueError("an archive ends inside a record")
            parts.append(unpack.decompress(rest))
            rest = unpack.unused_data
        yield b"".join(parts)


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """(fields by lower-case name, block) of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    return fields, rest[: int(fields["content-length"])]


class _Writer:
    """One archive: written under another name, then moved to its own."""

    def __init__(self, path: str):
        self.system, self.path = fs.FileSystem.from_uri(path)
        folder = self.path.rpartition("/")[0]
        self.system.create_dir(folder)
        self.part = f"{folder}/.{uuid.uuid4().hex}"
        self.out = self.system.open_output_stream(self.part, compression=None)
        self.add({"WARC-Type": "warcinfo", "WARC-Record-ID": record_id(path, "info"), "WARC-Date": DATE, "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n")

    def add(self, fields: dict[str, str | None], block: bytes) -> None:
        self.out.write(record_bytes(fields, block))

    def close(self) -> None:
        self.out.close()
        self.system.move(self.part, self.path)


def write_archives(df: DataFrame, root: str, key_col: str, uri_col: str, payload_col: str, date: str = DATE) -> DataFrame:
    """(archive, n_records) of the archives written, one response for each row; the list is stored, so nothing is written twice."""

    def run(batches):
        number, writer, size, records = 0, None, 0, 0
        for batch in batches:
            for key, uri, payload in zip(*(batch.column(i) for i in range(3))):
                key, uri, payload = key.as_py(), uri.as_py(), payload.as_py()
                if writer and (size + len(payload) > ARCHIVE_BYTES or records >= ARCHIVE_RECORDS):
                    writer.close()
                    yield {"archive": [path], "n_records": [records]}
                    writer = None
                if not writer:
                    path = f"{root}/part-{TaskContext.get().partitionId():06d}-{number:05d}.warc.gz"
                    writer, size, records, number = _Writer(path), 0, 0, number + 1
                fields = {
                    "WARC-Type": "response", "WARC-Record-ID": record_id(path, records), "WARC-Date": date, "WARC-Target-URI": None if uri is None else encode_uri(uri),
                    "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}", "Folioforge-Key": None if key is None else encode_uri(key), "Content-Type": "application/http; msgtype=response",
                }
                writer.add(fields, http_header(len(payload)) + payload)
                size, records = size + len(payload), records + 1
        if writer:
            writer.close()
            yield {"archive": [path], "n_records": [records]}

    rows = df.select(F.col(key_col).cast("string"), F.col(uri_col).cast("string"), text_bytes(payload_col))
    return stage(map_rows(rows, run, "archive string, n_records long"), "archives", tidy=False)


def _records(path: str) -> Iterator[tuple[int, dict[str, str], bytes, bytes]]:
    """(place, fields, HTTP header, payload) of an archive's records, the one about the archive left out."""
    system, own = fs.FileSystem.from_uri(path)
    place = 0
    with system.open_input_stream(own, compression=None) as stream:
        for record in members(stream):
            fields, block = parse(record)
            if fields["warc-type"] != "warcinfo":
                head, gap, payload = block.partition(b"\r\n\r\n")
                yield place, fields, head + gap, payload
                place += 1


def _spread(archives: DataFrame) -> DataFrame:
    """The list of archives over as many tasks as there are archives, a thousand for each of the session's shuffle tasks at most."""
    most = 1000 * int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.repartition(max(1, min(most, archives.count())))


def read_archives(archives: DataFrame, key_type: str = "string", payloads: bool = False) -> DataFrame:
    """The headers of all records of the listed archives, each with its key; payloads adds what a record holds itself.

    digest and payload_bytes are taken from the payload of a response, and from the header of a revisit.
    """

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                out: dict[str, list] = {}
                size = 0
                for place, fields, head, payload in _records(path):
                    own = fields["warc-type"] == "response"
                    stated = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                    digest = base32_sha1(payload) if own else stated
                    if digest != stated:
                        raise ValueError(f"{path}: record {place} does not have the payload that its digest states")
                    uri, key = fields.get("warc-target-uri"), fields.get("folioforge-key")
                    row = {
                        "archive": path, "place": place, "record_id": fields["warc-record-id"], "record_type": fields["warc-type"], "uri": None if uri is None else unquote(uri, errors="surrogatepass"),
                        "date": fields["warc-date"], "digest": digest, "payload_bytes": len(payload) if own else None, "refers_to_record": fields.get("warc-refers-to"), "key": None if key is None else unquote(key),
                    }
                    if payloads:
                        row["payload"] = payload if own else None
                    for name, v in row.items():
                        out.setdefault(name, []).append(v)
                    size += len(payload) if payloads else 1000
                    if size > ARCHIVE_BYTES:
                        yield out
                        out, size = {}, 0
                if out:
                    yield out

    found = map_rows(_spread(archives.select("archive")), run, f"{HEADERS}, key string{', payload binary' if payloads else ''}")
    return found.withColumn("key", F.col("key").cast(key_type))


def join_heavy(rows: DataFrame, on: str, lookup: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """rows joined to the row of lookup with the same `on`, those that have none left out.

    counts has (on, n). Keys of over a HEAVY-th of all rows, which HEAVY at most can be, are joined by broadcast.
    """
    heavy = stage(counts.filter(F.col("n") > total / HEAVY).select(on), "heavy", tidy=False)
    frequent = F.broadcast(lookup.join(F.broadcast(heavy), on, "left_semi"))
    rare = rows.join(F.broadcast(heavy), on, "left_anti").join(lookup.join(F.broadcast(heavy), on, "left_anti"), on)
    return rows.join(frequent, on).unionByName(rare)


def resolve(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """For each header its archive and place, record_type (response or revisit) and, for revisits, `original`: the response's
    archive, place, key, uri and date."""
    first = F.struct(F.col("key").isNull().alias("last"), "key", "archive", "place", "uri", "date")
    groups = headers.filter(F.col("payload_bytes") >= min_bytes).groupBy("digest", "payload_bytes").agg(F.min(first).alias("original"), F.count("*").alias("n")).filter("n > 1")
    groups = stage(groups.withColumn("payload", F.concat_ws(":", "digest", "payload_bytes")).select("payload", "original", "n"), "originals", tidy=False)
    rows = headers.select("archive", "place", F.concat_ws(":", "digest", "payload_bytes").alias("payload"), (F.col("payload_bytes") >= min_bytes).alias("counts"))
    found = join_heavy(rows.filter("counts"), "payload", groups.select("payload", "original"), groups.select("payload", "n"), headers.count())
    return found.filter("archive <> original.archive OR place <> original.place").select("archive", "place", F.lit("revisit").alias("record_type"), "original")


def deduplicate(archives: DataFrame, revisits: DataFrame, root: str) -> DataFrame:
    """(archive, n_records) of new archives under root, one for each listed one; what `resolve` has found becomes revisits."""
    kept = F.struct("place", F.col("original.archive").alias("of"), F.col("original.place").alias("at"), F.col("original.uri").alias("uri"), F.col("original.date").alias("date"))
    lists = revisits.groupBy("archive").agg(F.collect_list(kept).alias("revisits"))

    def run(batches):
        for batch in batches:
            for path, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                of = {r["place"]: r for r in found or ()}
                new = f"{root}/{path.rpartition('/')[2]}"
                writer, n = _Writer(new), 0
                for place, old, head, payload in _records(path):
                    fields = {
                        "WARC-Type": "response", "WARC-Record-ID": record_id(root, path, place), "WARC-Date": old["warc-date"], "WARC-Target-URI": old.get("warc-target-uri"),
                        "WARC-Payload-Digest": old["warc-payload-digest"], "Folioforge-Key": old.get("folioforge-key"), "Content-Type": old["content-type"],
                    }
                    if r := of.get(place):
                        fields |= {
                            "WARC-Type": "revisit", "WARC-Profile": PROFILE, "WARC-Refers-To": record_id(root, r["of"], r["at"]),
                            "WARC-Refers-To-Target-URI": None if r["uri"] is None else encode_uri(r["uri"]), "WARC-Refers-To-Date": r["date"],
                        }
                        payload = b""
                    writer.add(fields, head + payload)
                    n += 1
                writer.close()
                yield {"archive": [new], "n_records": [n]}

    rows = stage(archives.select("archive").join(lists, "archive", "left"), "revisits", tidy=False)
    return stage(map_rows(_spread(rows), run, "archive string, n_records long"), "archives", tidy=False)


def revisited(headers: DataFrame) -> DataFrame:
    """(key, uri, payload_bytes, digest, record_type, refers_to): all records of deduplicated archives; revisits get the
    length of their response's payload, and its key as refers_to."""
    own = headers.filter("record_type = 'response'")
    counts = stage(headers.filter("record_type = 'revisit'").groupBy("refers_to_record").agg(F.count("*").alias("n")), "referred", tidy=False)
    lookup = own.select(F.col("record_id").alias("refers_to_record"), F.col("payload_bytes").alias("bytes"), F.col("digest").alias("original"), F.col("key").alias("refers_to"))
    again = join_heavy(headers.filter("record_type = 'revisit'"), "refers_to_record", lookup, counts, headers.count())
    again = again.select("key", "uri", F.col("bytes").alias("payload_bytes"), F.col("original").alias("digest"), "record_type", "refers_to")
    return own.select("key", "uri", "payload_bytes", "digest", "record_type", F.lit(None).cast(headers.schema["key"].dataType).alias("refers_to")).unionByName(again)


def archive_pages(df: DataFrame, root: str | None = None, key_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """The rows written as archives, deduplicated and read back; see `revisited`. The archives stay under root: new ones in
    `deduplicated`, those with all payloads in `captured`."""
    root = root or f"{checkpoint_root(df.sparkSession)}/folioforge/warc-{uuid.uuid4().hex}"
    kind = df.schema[key_col].dataType.simpleString()
    captured = write_archives(df, f"{root}/captured", key_col, uri_col, payload_col)
    found = resolve(stage(read_archives(captured, kind), "headers"), min_bytes)
    return revisited(stage(read_archives(deduplicate(captured, found, f"{root}/deduplicated"), kind), "headers"))
