"""SimHash near-dedup at similarity 0.8: wide fingerprints over 5-word shingles (used by the pipeline).

Texts are linked if the Jaccard similarity of their sets of 5-word shingles is
SIMILARITY or more. Fingerprints only find the candidates; sets of shingles
decide. At similarity 0.8 about 15 % of all fingerprint bits differ, so no small
radius over 64 bits finds such pairs and no byte is guaranteed to match. This
variant of operator 5 therefore takes 512 bits and keys the positional byte
index by byte triples: of 64 byte positions two texts of similarity 0.8 share 17
on average, unrelated ones a quarter of one. Triples alone miss a part of the
pairs near 0.8, short texts above all, so texts are also keyed by the shingles
with the smallest values of each of the WORDS hashes that the fingerprint is made
of: two texts share one such key with a probability that is their similarity, so
all of them miss 0.2 ** WORDS (3 in a million) of the pairs at 0.8.

A posting's rows carry 32 further bits, so that members by mere chance drop out
before the fingerprints are fetched. Within every posting, of triples and of smallest hashes, the
shared positional bytes of a pair are tallied, pairs with SHARED or more are
retained, and their bits are compared: no pair gets by the count filter. Members of a posting whose retained fingerprints hang together within
RADIUS form a candidate group, equal groups are taken once, and
within a group shingle sets are compared until everything is connected or
compared. The keys come in two rounds: what the first has connected counts as one
in the second. Texts with equal sets are one node from the beginning.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.common import MASK64, WordHashes, bit_sums, fresh, map_rows, mix64, shingle_hashes, stage, text_bytes
from folioforge.llm.components import connected_components
from folioforge.llm.simhash import spanning_links

SHINGLE = 5
WORDS = 8  # 64-bit words of a fingerprint
#: Least similarity of linked texts, in hundredths.
SIMILARITY = 80
#: Byte triples that key the index, and those of them in the first round.
TRIPLES, FIRST_ROUND = 48, 8
#: Bits of 512 in which candidates may differ. At similarity 0.8 77 are expected, 96 where four shingles stand in five; deviations are below 9.
RADIUS = 140
#: Positional bytes of 64 that a pair has to share. 17 are expected at similarity 0.8, a quarter of one by chance.
SHARED = 5
#: Of the 32 bits that travel with a triple's rows, those that may differ. At similarity 0.8 one pair in 500 differs in more; smallest hashes are not held against it.
SKETCH_RADIUS = 10
#: Members of a posting whose sketches are compared at once; this bounds memory and changes no result.
AT_ONCE = 2048

SALTS = np.array([(0x9E3779B97F4A7C15 * (i + 1)) & MASK64 for i in range(WORDS)], np.uint64)


def triples(n: int = TRIPLES) -> np.ndarray:
    """n fixed choices of three of the 64 positions."""
    draw = np.random.default_rng(5)
    return np.stack([draw.permutation(8 * WORDS)[:3] for _ in range(n)])


def shingle_set(words: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """The sorted hashes of the distinct k-word shingles, given the words' hashes."""
    return np.unique(shingle_hashes(words, k))


def wide_fingerprint(shingles: np.ndarray) -> tuple[bytes, bytes]:
    """512 bits of a set of shingles, and the smallest of each of the hashes that they are made of."""
    if not len(shingles):
        return b"\0" * (8 * WORDS), b"\0" * (8 * WORDS)
    hashes = mix64(shingles[:, None] + SALTS)
    return np.packbits(2 * bit_sums(hashes) > len(shingles)).tobytes(), hashes.min(axis=0).tobytes()


def _wide_rows(df: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(own, doc, hi, lo, fp, mins): 128 bits of id and text, the id, 128 bits of the set of shingles, the fingerprint, the smallest hashes."""

    def run(batches):
        import xxhash

        table = WordHashes()
        for batch in batches:
            node, fps = [], []
            for t in batch.column(2):
                shingles = shingle_set(table.of(t.as_py().lower().split()), k)
                node.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                fps.append(wide_fingerprint(shingles))
            hi, lo = np.frombuffer(b"".join(node), np.int64).reshape(-1, 2).T
            yield {"own": batch.column(0), "doc": batch.column(1), "hi": pa.array(hi), "lo": pa.array(lo), "fp": [f for f, _ in fps], "mins": [m for _, m in fps]}

    schema = "own struct<hi:long,lo:long>, doc long, hi long, lo long, fp binary, mins binary"
    return map_rows(df.select(_own(id_col, text_col), F.col(id_col).cast("long"), text_bytes(text_col)), run, schema)


def _own(id_col: str, text_col: str):
    """128 bits that stand for an id with its text."""
    doc, text = F.col(id_col).cast("long"), F.col(text_col)
    return F.struct(F.xxhash64(doc, text).alias("hi"), F.xxhash64(F.lit("own"), text, doc).alias("lo"))


def posting_rows(nodes: DataFrame, places: np.ndarray, first: int = 0) -> DataFrame:
    """(key, node, part): key has the triple's number and bytes in its upper half and 32 other bits in the lower.

    places are those from triple `first` on. With triple 0 come the smallest hashes, as numbers from TRIPLES on; their keys
    have 24 bits of the hash in the upper half and 32 in the lower.
    """

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            bytes_ = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(n, 8 * WORDS)
            sketch = np.ascontiguousarray(bytes_[:, :4]).view(">u4").reshape(n).astype(np.uint64)
            for at in range(0, len(places), 50):
                some = places[at : at + 50]
                key = np.arange(first + at, first + at + len(some), dtype=np.uint64)[None, :]
                for i in range(3):
                    key = (key << np.uint64(8)) | bytes_[:, some[:, i]].astype(np.uint64)
                key = (key << np.uint64(32)) | sketch[:, None]
                yield rows(batch, key)
            if not first:
                mins = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint64).reshape(n, WORDS)
                number = np.arange(TRIPLES, TRIPLES + WORDS, dtype=np.uint64)[None, :] << np.uint64(56)
                yield rows(batch, number | (mins & np.uint64((1 << 56) - 1)))

    def rows(batch, key):
        node, part = (pa.array(np.repeat(batch.column(c).to_numpy(), key.shape[1])) for c in (0, 1))
        return {"key": pa.array(key.view(np.int64).reshape(-1)), "node": node, "part": part}

    return map_rows(nodes.select("node", "part", "fp", "mins"), run, "key long, node long, part long")


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition(F.shiftrightunsigned("key", 32)).sortWithinPartitions("key")


def _postings(batches, names):
    """Columns of each run of rows with one upper half of the key, two rows or more."""
    held = None
    for batch in batches:
        now = [batch.column(n) for n in names]
        now = [np.array(c.to_pylist(), object) if pa.types.is_binary(c.type) else c.to_numpy() for c in now]
        columns = [np.concatenate([h, n]) for h, n in zip(held, now)] if held else now
        if not len(columns[0]):
            continue
        upper = columns[0].view(np.uint64) >> np.uint64(32)
        starts = np.flatnonzero(np.r_[True, upper[1:] != upper[:-1]])
        sizes = np.diff(starts)
        for i in np.flatnonzero(sizes > 1):
            yield [c[starts[i] : starts[i + 1]] for c in columns]
        held = [c[starts[-1] :] for c in columns]
    if held and len(held[0]) > 1:
        yield held


def has_neighbour(sketch: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Which sketches are within SKETCH_RADIUS of one of another part; those that have found one are not compared further."""
    found = np.zeros(len(sketch), bool)
    for i in range(0, len(sketch), AT_ONCE):
        rest = np.flatnonzero(~found)
        for r in np.split(rest, range(AT_ONCE, len(rest), AT_ONCE)):
            near = np.bitwise_count(sketch[r, None] ^ sketch[None, i : i + AT_ONCE]) <= SKETCH_RADIUS
            found[r] = (near & (parts[r, None] != parts[None, i : i + AT_ONCE])).any(axis=1)
    return found


def _likely(batches):
    """Of each posting the members whose sketch is near to that of a member of another part, or whose smallest hash another has."""
    for keys, nodes, parts in _postings(batches, ["key", "node", "part"]):
        if (parts == parts[0]).all():
            continue
        if keys[:1].view(np.uint64)[0] >> np.uint64(56) >= TRIPLES:
            _, place, size = np.unique(keys, return_inverse=True, return_counts=True)
            ok = size[place] > 1
            keys, nodes, parts = keys[ok], nodes[ok], parts[ok]
        else:
            ok = has_neighbour((keys.view(np.uint64) & np.uint64(0xFFFFFFFF)).astype(np.uint32), parts)
            keys, nodes, parts = keys[ok], nodes[ok], parts[ok]
        if len(keys):
            yield {"key": pa.array(keys), "node": pa.array(nodes), "part": pa.array(parts)}


def _candidates(batches):
    """members: the nodes of a posting that fingerprints connect, by tally and bits, if they have two parts or more."""
    for keys, nodes, parts, fps in _postings(batches, ["key", "node", "part", "fp"]):
        rows = np.frombuffer(b"".join(fps), np.uint64).reshape(len(fps), WORDS)
        label = np.arange(len(rows))
        for i, j in spanning_links(rows, RADIUS, SHARED):  # i is linked before it links
            label[j] = label[i]
        order = np.argsort(label, kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(label[order])) + 1)
        found = [np.sort(nodes[g]) for g in groups if len(g) > 1 and (parts[g] != parts[g[0]]).any()]
        if found:
            yield {"members": found}


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sorted sets is SIMILARITY or more."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= SIMILARITY * (len(a) + len(b) - both)


def verified_links(parts: np.ndarray, fps: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Places (i, j) of alike members, enough of them to connect what is connected; equal parts are connected already."""
    links, root, size = [], np.unique(parts, return_inverse=True)[1], np.array([len(s) for s in sets])
    apart = int(root.max(initial=0))  # links that are missing until all is connected
    for i in range(len(sets) - 1):
        if len(links) == apart:
            break
        near = (root[i + 1 :] != root[i]) & (100 * np.minimum(size[i + 1 :], size[i]) >= SIMILARITY * np.maximum(size[i + 1 :], size[i]))
        near = np.flatnonzero(near) + i + 1
        near = near[np.bitwise_count(fps[near] ^ fps[i]).sum(axis=1, dtype=np.int64) <= RADIUS]
        for j in near.tolist():
            if root[j] != root[i] and alike(sets[i], sets[j]):
                links.append((i, j))
                root[root == root[j]] = root[i]
    return links


def _links(batches):
    """(a, b): parts that a group's sets of shingles link; rows are sorted by group."""
    group, rows = None, []

    def linked():
        parts = np.array([r[0] for r in rows], np.int64)
        fps = np.frombuffer(b"".join(r[1] for r in rows), np.uint64).reshape(len(rows), WORDS)
        at = np.array(verified_links(parts, fps, [np.frombuffer(r[2], np.uint64) for r in rows]), int).reshape(-1, 2)
        return {"a": pa.array(parts[at[:, 0]]), "b": pa.array(parts[at[:, 1]])}

    for batch in batches:
        for now, *row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), *(batch.column(c) for c in (2, 3))):
            if rows and now != group:
                yield linked()
                rows = []
            group = now
            rows.append((row[0], row[1].as_py(), row[2].as_py()))
    if rows:
        yield linked()


def _shingles(wanted: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(node, part, fp, shingles) of wanted (own, node, part, fp), read from texts (own, text)."""

    def run(batches):
        table = WordHashes()
        for batch in batches:
            sets = [shingle_set(table.of(t.as_py().lower().split()), k).tobytes() for t in batch.column(3)]
            yield {"node": batch.column(0), "part": batch.column(1), "fp": batch.column(2), "shingles": sets}

    once = texts.join(wanted, "own").dropDuplicates(["own"])
    return map_rows(once.select("node", "part", "fp", "text"), run, "node long, part long, fp binary, shingles binary")


def _joined(nodes: DataFrame, texts: DataFrame, k: int, first: int, last: int) -> DataFrame:
    """nodes (node, part, fp, mins, least) with the parts made one that are alike and meet by the triples from first to last."""
    likely = map_rows(_dealt(posting_rows(nodes, triples()[first:last], first)), _likely, "key long, node long, part long")
    members = likely.join(nodes.select("node", "fp"), "node").select("key", "node", "part", "fp")
    groups = stage(map_rows(_dealt(members), _candidates, "members array<long>").distinct(), "wide-groups")
    groups = groups.select(F.xxhash64("members").alias("group"), F.explode("members").alias("node"))
    wanted = nodes.join(groups.select("node").distinct(), "node", "left_semi")
    sets = _shingles(wanted.select(F.col("least.own").alias("own"), "node", "part", "fp"), texts, k)
    sets = groups.join(sets, "node").select("group", "part", "fp", "shingles")
    links = map_rows(sets.repartition("group").sortWithinPartitions("group"), _links, "a long, b long")
    found = connected_components(links)
    return nodes.join(found, nodes.part == found.node, "left").select(nodes.node, F.coalesce("component", "part").alias("part"), "fp", "mins", "least")


def representatives(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE) -> DataFrame:
    """The rows of df, all columns, that come first in their group of near copies.

    First is the smallest id, nulls last, then the smallest hash of id and text.
    Ids are whole numbers. Rows with the same id and text are one document and one
    of them stays; texts without words are copies of each other; a null text is
    empty. Documents and sets of shingles are told apart by 128 bits, nodes by
    numbers that are given out once.
    """
    rows = stage(_wide_rows(df, id_col, text_col, k), "wide-fingerprints")
    order = F.struct(F.col("doc").isNull().alias("late"), "doc", "own")
    nodes = rows.groupBy("hi", "lo").agg(F.first("fp").alias("fp"), F.first("mins").alias("mins"), F.min(order).alias("least"))
    numbered = stage(nodes.select(F.monotonically_increasing_id().alias("node"), "fp", "mins", "least"), "wide-nodes")
    nodes = numbered.select("node", F.col("node").alias("part"), "fp", "mins", "least")
    texts = df.select(_own(id_col, text_col).alias("own"), text_bytes(text_col).alias("text"))
    nodes = stage(_joined(nodes, texts, k, 0, FIRST_ROUND), "wide-parts")
    nodes = _joined(nodes, texts, k, FIRST_ROUND, TRIPLES)
    own, nth = fresh(df, "own", "nth")
    keep = nodes.groupBy("part").agg(F.min("least").alias("least")).select(F.col("least.own").alias(own))
    once = Window.partitionBy(own).orderBy(own)
    kept = df.withColumn(own, _own(id_col, text_col)).join(keep.distinct(), own, "left_semi")
    return kept.withColumn(nth, F.row_number().over(once)).filter(F.col(nth) == 1).select(*df.columns)
