"""What the operators of this subpackage share: typed Arrow maps, shared-folder tables, word rules."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

MASK64 = (1 << 64) - 1


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str = "text"):
    """A text as UTF-8 bytes; null is the empty text."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b"").cast("binary"))


def map_rows(df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """mapInArrow where the function yields a dict of columns for each batch."""
    kind = _schema(schema)
    arrow = to_arrow_schema(kind)

    def run(batches):
        for columns in rows(batches):
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for f, c in zip(arrow, (columns[f.name] for f in arrow), strict=True)], schema=arrow
            )
        give_back_memory()

    return df.mapInArrow(run, kind)


def give_back_memory() -> None:
    """Returns what a finished task has freed to the system, as Python workers live on for the next one."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def _schema(ddl: str) -> StructType:
    return _parse_datatype_string(ddl)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder that the session names; a temporary one only where none is named, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        got = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = got.get() if got.isDefined() else None
    if not named:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="folioforge-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def stage(df: DataFrame, tag: str, by: str | None = None, tidy: bool = True) -> DataFrame:
    """Writes df once to the shared folder, in folders by the column `by` if that is given, and returns a frame that reads it.

    Cuts the lineage: losing executors later costs a read, not the work before.
    tidy has the driver collect its garbage, which small tables need not.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/folioforge/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path, partitionBy=by)
    if tidy:  # shuffle files of finished steps go only when the driver collects its garbage
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out._staged = path
    return out


def discard(*frames: DataFrame | None) -> None:
    """Deletes what `stage` has written for these frames; nothing that is still to be computed may read them."""
    for df in frames:
        path = getattr(df, "_staged", None)
        if path:
            sc = df.sparkSession.sparkContext
            at = sc._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def bounded_sample(df: DataFrame, by: list[str], most: int) -> DataFrame:
    """The `most` distinct values of the columns `by` with the smallest hashes, whatever the number of rows.

    Values that repeat count once. Where there are many more, a cut on the hash
    that leaves about twice as many as are wanted, and never fewer, keeps the tasks
    from sending `most` each to the driver.
    """
    h = F.shiftrightunsigned(F.xxhash64(*by), 2)
    keys = df.select(*by).distinct()
    rows, share = keys.count(), 1.0
    if rows > 2 * most:
        share, found = most / rows, 0
        while found < most:
            share = min(1.0, 2 * share)
            keys = df.filter(h <= int(((1 << 62) - 1) * share)).select(*by).distinct()
            found = most if share == 1.0 else keys.count()
    return keys.orderBy(h, *by).limit(most)


def fresh(df: DataFrame, *names: str) -> tuple[str, ...]:
    """Column names like `names` that df does not have."""
    taken = {c.lower() for c in df.columns}
    return tuple(next(f"{n}{'_' * i}" for i in range(len(taken) + 1) if f"{n}{'_' * i}".lower() not in taken) for n in names)


def mapped_file(data: bytes) -> np.memmap:
    """data as a read-only memory map that holds no name in the file system."""
    if not data:
        return np.zeros(0, np.uint8)
    fd, name = tempfile.mkstemp(prefix="folioforge-")
    try:
        with os.fdopen(fd, "wb") as f:
            f.write(data)
        return np.memmap(name, dtype=np.uint8, mode="r")
    finally:
        os.unlink(name)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit values (the SplitMix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word (bytes) to its XXH64; forgets all when it holds `most` words, so memory is bounded."""

    def __init__(self, seed: int = 0, most: int = 150_000):
        import xxhash

        super().__init__()
        self.digest, self.seed, self.most = xxhash.xxh64_intdigest, seed, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = self.digest(word, self.seed)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def fold_words(columns) -> np.ndarray:
    """One 64-bit hash per row of equally long columns of word hashes, by their order."""
    h = np.uint64(0)
    for c in columns:
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + c + np.uint64(1))
    return h


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Order-dependent 64-bit hashes of each k consecutive word hashes; of all words if there are fewer."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    k = min(k, n)
    return fold_words(words[i : n - k + 1 + i] for i in range(k))


def bit_sums(hashes: np.ndarray) -> np.ndarray:
    """For rows of uint64 words, how many rows have each bit set, most significant bit of each word first.

    Bytes of unpacked bits are added eight at a time as uint64 lanes, 255 rows
    between carries.
    """
    rows = hashes.reshape(len(hashes), -1)
    bits = np.unpackbits(np.ascontiguousarray(rows.astype(">u8")).view(np.uint8), axis=1)
    total = np.zeros(bits.shape[1], np.int64)
    for i in range(0, len(bits), 255):
        total += np.ascontiguousarray(bits[i : i + 255]).view(np.uint64).sum(axis=0, dtype=np.uint64).view(np.uint8)
    return total
