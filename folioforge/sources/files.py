"""JSON, text and glossary files in; JSON, text and tagged files out.

Through Spark's own readers and writers, but for trees of many small files: those
are written, found and read by tasks, as Spark's reader keeps every name on the
driver and opens 32 files a task at most.
"""

from __future__ import annotations

import hashlib
import os
import re
import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CHAPTER = "array<struct<title:string,content:string>>"
OCR = "struct<input_path:string,rec_texts:array<string>,rec_scores:array<double>,rec_polys:array<array<array<double>>>>"
GLOSSARY = "array<struct<jp:string,tw:string,info:string,match:array<string>>>"


#: Names, files and bytes of files that a task hands on at once.
NAMES_AT_ONCE, FILES_AT_ONCE, BYTES_AT_ONCE = 10_000, 1_000, 4 << 20
#: Suffixes of files that Spark's readers decompress.
PACKED = {"bz2", "deflate", "gz", "lz4", "snappy", "zst", "zstd"}


def _hidden(name: str, folder: bool) -> bool:
    """Whether Spark's readers pass over a file or folder of this name."""
    out = name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")
    return out and not (folder and name.startswith(("_common_metadata", "_metadata")))


def _quoted(path: str) -> str:
    """A local path as the URI that input_file_name() gives."""

    def code(m: re.Match) -> str:
        c = m[0]
        return "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogateescape")) if c < "\x80" or c.isspace() or c <= "\x9f" else c

    return "file://" + re.sub(r"""[^A-Za-z0-9\-_.!~*'():@&=+$,;/]""", code, path)


def _found(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """(path): the files of a local tree whose names end so. One task lists the root, others what is below its folders."""

    def listed(folder: str, deep: bool) -> Iterator[tuple[str, bool]]:
        with os.scandir(folder) as entries:
            for e in entries:
                is_folder = e.is_dir()
                if _hidden(e.name, is_folder):
                    continue
                if not is_folder:
                    if e.name.endswith(suffix):
                        yield e.path, False
                elif deep:
                    yield from listed(e.path, True)
                else:
                    yield e.path, True

    def batches_of(items: Iterator[tuple[str, bool]]) -> Iterator[pa.RecordBatch]:
        held = []
        for item in items:
            held.append(item)
            if len(held) == NAMES_AT_ONCE:
                yield packed(held)
                held = []
        yield packed(held)

    def packed(held: list[tuple[str, bool]]) -> pa.RecordBatch:  # names are bytes, not always UTF-8
        return pa.RecordBatch.from_arrays([pa.array([os.fsencode(p) for p, _ in held], pa.binary()), pa.array([d for _, d in held], pa.bool_())], names=["path", "folder"])

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _ in range(batch.num_rows):
                yield from batches_of(listed(root, False))

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, folder in zip(*(c.to_pylist() for c in batch.columns)):
                own = os.fsdecode(path)
                yield from batches_of(listed(own, True) if folder else iter([(own, False)]))

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = "path binary, folder boolean"
    return spark.range(1, numPartitions=1).mapInArrow(top, kind).repartition(n).mapInArrow(below, kind).select("path").repartition(n)


def _read_tree(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """(file, text) of a local tree as Spark's reader has them, found and read by tasks."""
    root = "/" + path.removeprefix("file:").strip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts, size = [], [], 0
            for own in batch.column(0).to_pylist():
                with open(own, "rb") as source:
                    data = source.read()
                if data:  # empty files have no row
                    names.append(_quoted(os.fsdecode(own)))
                    texts.append(data)
                    size += len(data)
                if size >= BYTES_AT_ONCE or len(names) == FILES_AT_ONCE:
                    yield packed(names, texts)
                    names, texts, size = [], [], 0
            yield packed(names, texts)

    def packed(names: list[str], texts: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([n.encode("utf-8", "surrogateescape") for n in names], pa.binary()), pa.array(texts, pa.binary())], names=["file", "text"])

    files = _found(spark, root, suffix).mapInArrow(run, "file binary, text binary")
    return files.select(F.col("file").cast("string").alias("file"), F.col("text").cast("string").alias("text"))


def _is_local(spark: SparkSession, path: str) -> bool:
    """Whether a path is one of the local file system: by its scheme or, without one, by Hadoop's default."""
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return path.startswith("file:") or path.startswith("/") and default.startswith("file:")


def _whole(spark: SparkSession, path: str, glob: str) -> DataFrame:
    plain = re.fullmatch(r"\*(\.\w+)", glob)
    if _is_local(spark, path) and plain and plain[1][1:] not in PACKED and not re.search(r"[*?\[\]{}\\]", path):
        return _read_tree(spark, path, plain[1])
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    return files.select(F.input_file_name().alias("file"), F.col("value").alias("text"))


def read_json_arrays(spark: SparkSession, path: str, schema: str = CHAPTER, glob: str = "*.json") -> DataFrame:
    """(file, chapter_idx, columns of the elements): one row per array element, its place kept; broken files have no rows."""
    flat = _whole(spark, path, glob).select("file", F.posexplode(F.from_json("text", schema)).alias("chapter_idx", "e"))
    return flat.select("file", "chapter_idx", "e.*")


def read_json_objects(spark: SparkSession, path: str, schema: str = OCR, glob: str = "*.json") -> DataFrame:
    """(file, columns of the object): one row per file of a folder tree."""
    return _whole(spark, path, glob).select("file", F.from_json("text", schema).alias("e")).filter("e IS NOT NULL").select("file", "e.*")


def read_texts(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """(file, text): whole files; empty ones have no row, as with all of Spark's file readers."""
    return _whole(spark, path, glob)


def read_valid_texts(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(file, text) of the files of a tree that are valid UTF-8; the others are skipped."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.filter(F.is_valid_utf8(F.col("content").cast("string"))).select(F.col("path").alias("file"), F.col("content").cast("string").alias("text"))


def read_glossary(spark: SparkSession, path: str) -> DataFrame:
    """(entry, jp, tw, info, match)."""
    return read_json_arrays(spark, path, GLOSSARY).select(F.col("chapter_idx").alias("entry"), "jp", "tw", "info", "match")


def json_arrays(df: DataFrame, file: str, order: list[str], columns: list[str]) -> DataFrame:
    """(file, text): each file's rows as one JSON array in order."""
    rows = F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("o"), F.struct(*columns).alias("v"))))
    return df.groupBy(file).agg(F.to_json(F.transform(rows, lambda r: r["v"]), {"ignoreNullFields": "false"}).alias("text"))


def write_json(df: DataFrame, path: str, file: str, order: list[str], columns: list[str]) -> None:
    """A folder for each file, with one JSON array in it; other scripts are written as they are."""
    json_arrays(df, file, order, columns).withColumnRenamed(file, "file").repartition("file").write.partitionBy("file").text(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    df.write.partitionBy(*(partition_by or [])).parquet(path)


def ordered_text(df: DataFrame, keys: list[str], order: list[str], text: str | Column, separator: str = "") -> DataFrame:
    """(keys, text): texts of a key joined in order."""
    value = F.col(text) if isinstance(text, str) else text
    rows = F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("o"), value.alias("v"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(rows, lambda r: r["v"]), separator, "").alias("text"))


def write_texts(df: DataFrame, path: str, keys: list[str], order: list[str], text: str) -> None:
    """One text for each combination of the keys, under key=value folders; Spark's text writer ends each with a newline."""
    ordered_text(df, keys, order, text).repartition(*keys).write.partitionBy(*keys).text(path)


def text_name(index: Column, title: Column) -> Column:
    """`{index}.{title}.txt`, without the characters that part folders."""
    return F.concat(index.cast("string"), F.lit("."), F.regexp_replace(title, r"[/\\\x00]", "_"), F.lit(".txt"))


def write_named_texts(df: DataFrame, path: str, name: str, text: str) -> int:
    """Each row's text as the file `name` under `path`, nothing added; returns the number of files.

    `path` is an absolute path or a URI that Arrow's file systems know. A file is
    written under another name and then moved, so a task that runs twice leaves
    the same file. Names have to be distinct and may have folders; a null text is
    an empty file, and a binary one is written as it is.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = fs.FileSystem.from_uri(path)
        system.create_dir(root)
        made = set()
        for batch in batches:
            for n, t in zip(batch["name"], batch["text"]):
                part = f"{root}/.{uuid.uuid4().hex}"
                with system.open_output_stream(part, compression=None) as out:
                    out.write(t if isinstance(t, bytes) else (t or "").encode())
                folder = n.rpartition("/")[0]
                if folder and folder not in made:
                    system.create_dir(f"{root}/{folder}")
                    if len(made) == NAMES_AT_ONCE:
                        made.clear()
                    made.add(folder)
                system.move(part, f"{root}/{n}")
            yield pd.DataFrame({"n": [len(batch)]})

    rows = df.select(F.col(name).alias("name"), F.col(text).alias("text")).mapInPandas(run, "n long")
    return rows.agg(F.sum("n")).first()[0] or 0


#: Bytes copied at once.
COPIED = 1 << 20


def _segments(df: DataFrame, root: str, name: str, order: list[str], text: str, separator: str) -> DataFrame:
    """(name, part, segment, n_bytes): the rows in order of name and `order`, a file for each name of each range, stored as a list."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.select(F.col(name).cast("string").alias("name"), *(F.col(c).alias(f"o{i}") for i, c in enumerate(order)), F.coalesce(F.col(text), F.lit("")).alias("text"))
    by = ["name", *(f"o{i}" for i in range(len(order)))]
    ranged = cut.repartitionByRange(n, *by).sortWithinPartitions(*by).select("name", "text", F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, at = fs.FileSystem.from_uri(root)
        system.create_dir(at)
        out, own, size, done = None, None, 0, []
        for batch in batches:
            for n, t, part in zip(batch["name"], batch["text"], batch["part"]):
                if out is None or n != own:
                    if out:
                        out.close()
                        done.append((own, part, path, size))
                    own, path, size = n, f"{at}/.{uuid.uuid4().hex}", 0
                    out = system.open_output_stream(path, compression=None)
                    data = t.encode()
                else:
                    data = (separator + t).encode()
                out.write(data)
                size += len(data)
        if out:
            out.close()
            done.append((own, part, path, size))
        yield pd.DataFrame(done, columns=["name", "part", "segment", "n_bytes"])

    return stored(ranged.mapInPandas(run, "name string, part int, segment string, n_bytes long"))


def write_joined(df: DataFrame, root: str, name: str, order: list[str], text: str, separator: str = "", side_by_side: bool | None = None) -> DataFrame:
    """One file for each name, all of its texts in order; returns (name, file, n_bytes).

    Rows are sorted over all tasks by ranges of name and order, each range writes
    a segment for every name in it, and sums of the segments' sizes say where in
    its file a segment goes. On file systems that write at any place (`file:`, or as
    side_by_side says) all segments are copied there at once; on others one task a
    file copies its segments one after another. No text is ever held whole, a task
    that runs again writes the same bytes, and a name with most of the rows is cut
    into as many segments as there are ranges. Null texts are empty; rows that tie
    in `order` stand in any order; names must do as file names.
    """
    places = side_by_side if side_by_side is not None else root.startswith(("file:", "/"))
    segments, gap = _segments(df, root, name, order, text, separator), len(separator.encode())
    earlier = Window.partitionBy("name").orderBy("part")
    placed = segments.withColumn("first", F.row_number().over(earlier) == 1)
    placed = placed.withColumn("n_bytes", F.col("n_bytes") + F.when(F.col("first"), 0).otherwise(gap))
    placed = placed.withColumn("offset", F.sum("n_bytes").over(earlier) - F.col("n_bytes"))
    files_ = placed.groupBy("name").agg(F.sum("n_bytes").alias("n_bytes"), F.sort_array(F.collect_list(F.struct("offset", "segment", "first"))).alias("segments"))

    def blocks(system: fs.FileSystem, segment: str, first: bool) -> Iterator[bytes]:
        if not first:
            yield separator.encode()
        with system.open_input_stream(segment, compression=None) as source:
            while data := source.read(COPIED):
                yield data

    def at_once(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, at = fs.FileSystem.from_uri(root)
        for batch in batches:
            for n, segment, offset, first in zip(batch["name"], batch["segment"], batch["offset"], batch["first"]):
                with open(os.open(f"{at}/{n}", os.O_WRONLY | os.O_CREAT, 0o644), "wb") as out:
                    out.seek(offset)
                    for data in blocks(system, segment, first):
                        out.write(data)
            yield batch[["segment"]]

    def in_turn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, at = fs.FileSystem.from_uri(root)
        for batch in batches:
            for n, own in zip(batch["name"], batch["segments"]):
                part = f"{at}/.{uuid.uuid4().hex}"
                with system.open_output_stream(part, compression=None) as out:
                    for s in own:
                        for data in blocks(system, s["segment"], s["first"]):
                            out.write(data)
                system.move(part, f"{at}/{n}")
                yield pd.DataFrame({"segment": [s["segment"] for s in own]})

    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copied = stored(placed.repartition(tasks).mapInPandas(at_once, "segment string") if places else files_.repartition(tasks).mapInPandas(in_turn, "segment string"))

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, _ = fs.FileSystem.from_uri(root)
        for batch in batches:
            for segment in batch["segment"]:
                if system.get_file_info(segment).is_file:  # a task that ran twice has removed it
                    system.delete_file(segment)
            yield pd.DataFrame({"n": [len(batch)]})

    copied.mapInPandas(remove, "n long").agg(F.sum("n")).first()
    return stored(files_.select("name", F.concat(F.lit(f"{root}/"), "name").alias("file"), "n_bytes"))


def file_digests(files: DataFrame, file: str = "file") -> DataFrame:
    """The columns of files, and md5: digests of whole files, read in blocks."""
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            digests = []
            for path in batch[file]:
                system, own = fs.FileSystem.from_uri(path)
                digest = hashlib.md5()
                with system.open_input_stream(own, compression=None) as source:
                    while data := source.read(COPIED):
                        digest.update(data)
                digests.append(digest.hexdigest())
            yield batch.assign(md5=digests)

    return files.mapInPandas(run, f"{kind}, md5 string")


def shared_folder(spark: SparkSession) -> str:
    """A new folder's path under the one that all executors share; only local masters do without the setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="folioforge-")
    return f"{root.rstrip('/')}/folioforge/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """df written once under the shared folder and read from there: losing executors later costs a read, not the work before."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_contents(chapters: DataFrame, file: str = "file", index: str = "chapter_idx", title: str = "title", text: str = "content") -> DataFrame:
    """Chapters moved up by one place, with a first one that lists the titles of those that have a text."""
    listed = ordered_text(chapters.filter(F.length(text) > 0), [file], [index], title, "\n")
    first = listed.select(file, F.lit(0).alias(index), F.lit("contents").alias(title), F.col("text").alias(text))
    moved = chapters.filter(F.length(text) > 0).select(file, (F.col(index) + 1).alias(index), title, text)
    return first.unionByName(moved)


def replace_text(df: DataFrame, text: str, old: str, new: str) -> DataFrame:
    return df.withColumn(text, F.replace(F.col(text), F.lit(old), F.lit(new)))


def write_tagged(df: DataFrame, path: str, status: str, text: str) -> None:
    """Texts under status=... folders, passed and not."""
    df.select(status, text).write.partitionBy(status).text(path)
