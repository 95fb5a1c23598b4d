"""Operator 5: SimHash near-dedup through an inverted index of positional bytes with count filtering.

A fingerprint is B bytes in fixed positions. Fingerprints within r bits share at
least B - r positional bytes (5 of 8 within 3 bits), of which at least half lie in
one half of the positions. Postings are therefore keyed by every choice of that
many bytes from one half (8 triples): a pair within the radius meets in one of
them at least. Within a posting the shared positional bytes of a pair are
tallied, pairs that reach the guaranteed number are retained, and bits are
compared. One fingerprint is held against all that no chain has reached yet,
which yields the links of a spanning forest and never all pairs. Components then
come from the links of all postings.

A posting of more than SPLIT members is split by one further byte at a time: a
pair that must share n more of m free positions shares one of any m - n + 1.
Where nothing is left to split by, the nearest fingerprints are looked up
instead of compared: the free bits are few, so all values within r bits of one's
own can be enumerated. Links are the same either way.

Wide fingerprints with a large radius (for similarity 0.8) have no guaranteed
matches; `nearcopies` keys them by byte triples and by shingles.

Edge cases: ids are whole numbers; a null text is empty; texts without words have
fingerprint zero; a bit that is set in exactly half of the hashes is 0; null ids are kept, with the component of a null id being the smallest id that
it reaches or null; repeated rows share their component; other columns are
ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import WordHashes, bit_sums, map_rows, shingle_hashes, stage, text_bytes
from folioforge.llm.components import connected_components

BYTES = 8
#: Members from which a posting is split by a further byte, and those from which one that cannot be is searched by enumeration.
SPLIT, DENSE = 4096, 100_000


def word_shingles(words: list[bytes], k: int) -> list[bytes]:
    """Space-joined runs of k words, repeats included; all words if there are fewer; none of none."""
    if len(words) <= k:
        return [b" ".join(words)] if words else []
    text = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    return [text[a : b - 1] for a, b in zip([0, *ends], ends[k - 1 :])]


def fingerprint(words: list[bytes], k: int = 3, seed: int = 42) -> int:
    """64 bits, each set if it is set in over half of the shingles' XXH64."""
    shingles = word_shingles(words, k)
    if not shingles:
        return 0
    digest = xxhash.xxh64_digest
    h = np.frombuffer(b"".join([digest(s, seed) for s in shingles]), ">u8").astype(np.uint64)
    return int.from_bytes(np.packbits(2 * bit_sums(h) > len(h)).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3) -> DataFrame:
    """(doc, fp): ids and 64-bit fingerprints as signed longs."""

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t.as_py().lower().split(), k) for t in batch.column(1)], np.uint64)
            yield {"doc": batch.column(0), "fp": pa.array(fps.view(np.int64))}

    return map_rows(df.select(F.col(id_col).cast("long"), text_bytes(text_col)), run, "doc long, fp long")


def key_places(radius: int) -> list[tuple[int, ...]]:
    """The choices of positions that key the postings."""
    half, shared = BYTES // 2, BYTES - radius
    return [c for side in (range(half), range(half, BYTES)) for c in combinations(side, -(-shared // 2))]


def postings(fps: DataFrame, radius: int) -> DataFrame:
    """(key, fp): key has the number of a choice of positions and the bytes there."""
    byte = [F.shiftrightunsigned("fp", 8 * i).bitwiseAND(F.lit(255)) for i in range(BYTES)]
    keys = []
    for number, places in enumerate(key_places(radius)):
        value = F.lit(number).cast("long")
        for p in places:
            value = F.shiftleft(value, 8).bitwiseOR(byte[p])
        keys.append(value)
    return fps.select("fp", F.explode(F.array(*keys)).alias("key"))


def spanning_links(fps: np.ndarray, radius: int, shared: int = 0) -> list[tuple[int, int]]:
    """Places (i, j) of a spanning forest of the graph that links rows of uint64 words within the radius.

    Pairs with fewer than `shared` positional bytes in common are not compared by bits.
    """
    rows = fps.reshape(len(fps), -1)
    links, rest = [], np.arange(1, len(rows))
    queue = [0]
    while len(rest):
        if not queue:
            queue, rest = [int(rest[0])], rest[1:]
            continue
        i = queue.pop()
        differ = rows[rest] ^ rows[i]
        near = np.ones(len(rest), bool)
        if shared:
            tally = (differ.view(np.uint8) == 0).sum(axis=1)
            near = tally >= shared
        near[near] = np.bitwise_count(differ[near]).sum(axis=1, dtype=np.int64) <= radius
        if near.any():
            found = rest[near].tolist()
            links += [(i, j) for j in found]
            queue += found
            rest = rest[~near]
    return links


def posting_links(fps: np.ndarray, fixed: tuple[int, ...], radius: int) -> list[tuple[int, int]]:
    """Places (i, j) that connect what is connected within the radius, for fingerprints that share the bytes at the positions `fixed`."""
    free = [p for p in range(BYTES) if p not in fixed]
    need = BYTES - radius - len(fixed)
    if need <= 0 and len(fps) >= DENSE:
        return _enumerated_links(fps, radius, sum(255 << (8 * p) for p in free))
    if need <= 0 or len(fps) <= SPLIT:
        return spanning_links(fps, radius, BYTES - radius)
    links = []
    for p in free[: len(free) - need + 1]:
        byte = (fps >> np.uint64(8 * p)) & np.uint64(255)
        order = np.argsort(byte, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(byte[order])) + 1):
            if len(part) > 1:
                links += [(int(part[i]), int(part[j])) for i, j in posting_links(fps[part], (*fixed, p), radius)]
    return links


def _enumerated_links(fps: np.ndarray, radius: int, free: int) -> list[tuple[int, int]]:
    bits = [np.uint64(1 << b) for b in range(64) if free >> b & 1]
    masks = np.array([np.bitwise_xor.reduce(np.array(c, np.uint64)) for r in range(1, radius + 1) for c in combinations(bits, r)], np.uint64)
    order = np.argsort(fps)
    sorted_fps = fps[order]
    open_ = np.ones(len(fps), bool)
    links = []
    for first in range(len(fps)):
        if not open_[first]:
            continue
        open_[first] = False
        queue = [first]
        while queue:
            i = queue.pop()
            probe = sorted_fps[i] ^ masks
            at = np.minimum(np.searchsorted(sorted_fps, probe), len(fps) - 1)
            hit = np.unique(at[(sorted_fps[at] == probe) & open_[at]]).tolist()
            open_[hit] = False
            links += [(int(order[i]), int(order[j])) for j in hit]
            queue += hit
    return links


def _runs(batches, names: list[str]):
    """(key, columns) for each run of two or more rows with one key, of batches sorted by the first column."""
    held = None
    for batch in batches:
        columns = [np.concatenate([h, n]) if held is not None else n for h, n in zip(held or names, (_numpy(batch.column(n)) for n in names))]
        key = columns[0]
        if not len(key):
            continue
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        for a, b in zip(starts[:-1], starts[1:]) if len(starts) > 1 else ():
            if b - a > 1:
                yield key[a], [c[a:b] for c in columns[1:]]
        held = [c[starts[-1] :] for c in columns]
    if held is not None and len(held[0]) > 1:
        yield held[0][0], [c for c in held[1:]]


def _numpy(column: pa.Array) -> np.ndarray:
    if pa.types.is_binary(column.type):
        return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(len(column), -1)
    return column.to_numpy(zero_copy_only=False)


def near_links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """(a, b): fingerprints linked within the radius, enough of them to connect what is connected.

    fps has distinct fingerprints in `fp`.
    """
    if not 0 < radius < BYTES - 1:
        raise ValueError("the radius has to leave two positions or more")

    places = key_places(radius)

    def run(batches):
        for key, (members,) in _runs(batches, ["key", "fp"]):
            fixed = places[int(key) >> (8 * len(places[0]))]
            links = posting_links(members.view(np.uint64), fixed, radius)
            if links:
                at = np.array(links)
                yield {"a": pa.array(members[at[:, 0]]), "b": pa.array(members[at[:, 1]])}

    dealt = postings(fps, radius).repartition("key").sortWithinPartitions("key")
    return map_rows(dealt, run, "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, radius: int = 3) -> DataFrame:
    """One row per row of df: its id, fingerprint (16 hex digits) and component_id, the smallest id that it reaches."""
    docs = stage(fingerprints(df, id_col, text_col, k), "fingerprints")
    first = docs.groupBy("fp").agg(F.min("doc").alias("first"))
    parts = connected_components(near_links(first.select("fp"), radius))
    named = first.join(parts, first.fp == parts.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("part"))
    named = stage(named, "fingerprint-parts")
    least = named.groupBy("part").agg(F.min("first").alias("component_id"))
    classes = named.join(least, "part").select("fp", "component_id")
    out = docs.join(classes, "fp")
    return out.select(F.col("doc").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
