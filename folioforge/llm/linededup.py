"""Operator 6: line dedup by levelled sorted runs of line hashes.

Batches of documents come in ascending order of id. The lines seen so far are
kept as sorted runs of (hash, first document). A new batch is merge-joined with
the runs: lines found there belong to an earlier document and go, the others
anti-join and become a sorted run of their own. When a level has `fanout` runs
they are compacted into one run of the next level, so that there are only
logarithmically many.

A run is a table in the shared folder, bucketed and sorted by hash, with as many
buckets as shuffles have partitions. A batch is dealt out once and then meets
every run bucket by bucket; compaction merges two runs bucket by bucket, without
an exchange. Lines that make up over 1/HOT of all, of which there are fewer than
HOT, are settled before by one aggregation and a broadcast, so that none of them
meets in one task.

A line's key is the line without the white space at its ends, A-Z lower-cased.
Keys of at least `min_chars` code points that stand in two or more documents
keep their lines only in the document with the smallest id.

Edge cases: ids are whole numbers (others have to be mapped to such before, as
they are compared as longs); null and empty texts are one empty line; a null id counts as the
largest; rows with the same id are one document, each row losing the same
lines; a text that loses every line becomes empty; other columns stay where
`replace_texts` is used and are ignored elsewhere.
"""

from __future__ import annotations

import contextlib
import hashlib
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from folioforge.llm.common import checkpoint_root, discard, fresh, map_rows, stage, text_bytes

#: Code points from which a repeated line counts.
MIN_CHARS = 10
#: Bytes of text in a batch for each core of the cluster, batches at most, and runs that are compacted at once.
BATCH_BYTES, BATCHES, FANOUT = 32 << 20, 16, 2
#: Lines that are more than one in HOT are settled apart.
HOT = 20_000
#: What a null id counts as.
LAST = (1 << 63) - 1
WHITE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The 16-byte hash of a line's key, None if it is too short."""
    key = line.strip(WHITE).lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def line_keys(df: DataFrame, id_col: str, text_col: str, min_chars: int, cuts: list[int] | None = None) -> DataFrame:
    """(doc, hi, lo, batch): the keys of each row's lines, each once; batch is the number of cuts below the id."""

    def run(batches):
        edges = np.array(cuts or [], np.int64)
        for batch in batches:
            docs, keys = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = {line_key(x, min_chars) for x in text.as_py().split(b"\n")}
                found.discard(None)
                docs += [doc] * len(found)
                keys += found
            docs = np.array(docs, np.int64)
            hi, lo = np.frombuffer(b"".join(keys), ">i8").astype(np.int64).reshape(-1, 2).T
            at = np.searchsorted(edges, docs).astype(np.int32)
            yield {"doc": pa.array(docs), "hi": pa.array(hi), "lo": pa.array(lo), "batch": pa.array(at)}

    return map_rows(df.select(_doc(id_col), text_bytes(text_col)), run, "doc long, hi long, lo long, batch int")


def _doc(id_col: str):
    return F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))


def batch_cuts(df: DataFrame, id_col: str, text_col: str, batches: int | None) -> list[int]:
    """The largest ids of all batches but the last."""
    parts = F.percentile_approx(_doc(id_col), [i / 240 for i in range(1, 240)], 10_000)
    size, at = df.agg(F.sum(F.octet_length(text_col)), parts).first()
    if batches is None:
        batches = min(BATCHES, -(-(size or 0) // (BATCH_BYTES * df.sparkSession.sparkContext.defaultParallelism)))
    return sorted({at[round(240 * i / batches) - 1] for i in range(1, batches)}) if at and batches > 1 else []


@contextlib.contextmanager
def sorted_buckets(spark: SparkSession):
    """Lets scans of bucketed tables count as sorted where a bucket is one file."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def write_run(df: DataFrame) -> DataFrame:
    """df (hi, lo, owner) as a run: a file for each bucket, sorted by hash."""
    spark = df.sparkSession
    name = f"folioforge_line_run_{uuid.uuid4().hex}"
    path = f"{checkpoint_root(spark)}/folioforge/{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, "hi", "lo").sortBy("hi", "lo").option("path", path).saveAsTable(name)
    run = spark.table(name)
    run._staged, run._table = path, name
    return run


def drop_run(run: DataFrame) -> None:
    run.sparkSession.sql(f"DROP TABLE IF EXISTS {run._table}")
    discard(run)


def merged(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two runs without a common key as one; sorted buckets are merged, nothing is dealt out anew."""
    return a.join(b.withColumnRenamed("owner", "other"), ["hi", "lo"], "full_outer").select("hi", "lo", F.coalesce("owner", "other").alias("owner"))


class Runs:
    """Levels of sorted runs of (hi, lo, owner); a key stands in one run only."""

    def __init__(self, fanout: int):
        self.fanout, self.levels = fanout, [[]]

    def all(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def unseen(self, own: DataFrame) -> DataFrame:
        for r in self.all():
            own = own.join(r.select("hi", "lo"), ["hi", "lo"], "left_anti")
        return own

    def add(self, run: DataFrame) -> None:
        self.levels[0].append(run)
        depth = 0
        while len(self.levels[depth]) >= self.fanout:
            first, *more = self.levels[depth]
            for r in more:
                both = write_run(merged(first, r))
                drop_run(first)
                drop_run(r)
                first = both
            self.levels[depth] = []
            depth += 1
            if depth == len(self.levels):
                self.levels.append([])
            self.levels[depth].append(first)


def dropped_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, batches: int | None = None, fanout: int = FANOUT) -> DataFrame:
    """(doc, keys): for each document that loses lines, the 16-byte keys of those that go."""
    cuts = batch_cuts(df, id_col, text_col, batches)
    lines = stage(line_keys(df, id_col, text_col, min_chars, cuts), "line-keys", by="batch")
    least = max(2, lines.count() // HOT)
    often = lines.groupBy("hi", "lo").agg(F.count("*").alias("n"), F.min("doc").alias("owner")).filter(F.col("n") > least)
    hot = stage(often.select("hi", "lo", "owner"), "hot-lines")
    gone = [lines.join(F.broadcast(hot), ["hi", "lo"]).filter("owner < doc").select("doc", "hi", "lo")]
    runs, parts = Runs(fanout), []
    with sorted_buckets(df.sparkSession):
        for number in range(len(cuts) + 1):
            batch = lines.filter(F.col("batch") == number).join(F.broadcast(hot), ["hi", "lo"], "left_anti")
            runs.add(write_run(runs.unseen(batch.groupBy("hi", "lo").agg(F.min("doc").alias("owner")))))
            found = None
            for r in runs.all():
                here = batch.join(r, ["hi", "lo"]).filter("owner < doc").select("doc", "hi", "lo")
                found = here if found is None else found.unionByName(here)
            parts.append(stage(found, "line-gone"))
    for g in [*gone, *parts]:
        out = g if g is gone[0] else out.unionByName(g)
    key = F.concat(*(F.unhex(F.lpad(F.hex(c), 16, "0")) for c in ("hi", "lo")))
    out = stage(out.groupBy("doc").agg(F.collect_set(key).alias("keys")), "lines-gone")
    for r in runs.all():
        drop_run(r)
    discard(lines, hot, *parts)
    return out


def _with_keys(df: DataFrame, id_col: str, text_col: str, options: dict) -> DataFrame:
    """df with the keys of its lines that go as one more column, the last."""
    gone = dropped_lines(df, id_col, text_col, **options)
    own, doc, keys = fresh(df, "own", "doc", "keys")
    rows = df.withColumn(own, _doc(id_col))
    return rows.join(gone.toDF(doc, keys), F.col(own) == F.col(doc), "left").drop(own, doc)


def keep_lines(text: bytes, gone: set, min_chars: int) -> tuple[bytes, int, int]:
    """(what stays, lines before, lines dropped)."""
    lines = text.split(b"\n")
    kept = [x for x in lines if line_key(x, min_chars) not in gone] if gone else lines
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, batches: int | None = None, fanout: int = FANOUT, keep: bool = True) -> DataFrame:
    """One row per row of df: id, lines before, lines dropped, the digest of the kept text and, as asked, that text."""
    kind = df.schema[id_col].dataType.simpleString()
    found = _with_keys(df.select(id_col, text_col), id_col, text_col, {"min_chars": min_chars, "batches": batches, "fanout": fanout})

    def run(batches):
        for batch in batches:
            out = {id_col: batch.column(0)} | {n: [] for n in ("n_lines", "n_dropped", "kept_sha256", "kept")}
            for t, g in zip(batch.column(1), batch.column(2).to_pylist()):
                kept, lines, dropped = keep_lines(t.as_py(), set(g or ()), min_chars)
                out["n_lines"].append(lines)
                out["n_dropped"].append(dropped)
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if keep:
                    out["kept"].append(kept.decode("utf-8", "replace"))
            yield out

    cut = found.select(id_col, text_bytes(text_col).alias("text"), found.columns[-1])
    return map_rows(cut, run, f"`{id_col}` {kind}, n_lines long, n_dropped long, kept_sha256 string{', kept string' * keep}")


def replace_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", **options) -> DataFrame:
    """df with the lines dropped from its texts, all columns kept; length_col, if there, counts code points anew.

    A null text stays null.
    """
    min_chars = options.setdefault("min_chars", MIN_CHARS)
    found = _with_keys(df, id_col, text_col, options)
    kind = df.schema
    arrow = to_arrow_schema(kind)

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = [
                t if t is None or not g else keep_lines(t.encode(), set(g), min_chars)[0].decode("utf-8", "replace")
                for t, g in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())
            ]
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, arrow.field(at).type)
            if length_col in arrow.names:
                i = arrow.get_field_index(length_col)
                columns[i] = pa.array([None if t is None else len(t) for t in texts], arrow.field(i).type)
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return found.mapInArrow(run, from_arrow_schema(arrow))
