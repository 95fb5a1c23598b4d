"""Operator 9: benchmark decontamination by SimHash over item-sized windows.

For every benchmark item, windows of as many words as the item has slide over a
text. A window's fingerprint is compared with the item's through Hamming blocks:
64 bits within the radius have a block in eight with at most radius/8 differing
bits, so blocks are looked up first and all fingerprints in the radius are found.
Candidates are verified by the exact weighted similarity of their 5-word
shingles: the sum of the smaller multiplicities over the sum of the larger ones.

At this radius blocks alone let about three quarters of unrelated pairs through,
so they are only looked up for pairs that a rare shingle leads to. A window that
is similar to an item of n shingles shares SIMILARITY * n of them at least, and
so one of any other n - SIMILARITY * n + 1; those that are rarest in the
benchmark are indexed. Nothing that could pass is lost, and a shingle that many
items share leads to none of them if they have rarer ones.

Words are runs of letters and digits, A-Z lower-cased. Items shorter than five
words are their own single shingle. A text shorter than an item is one window.

The benchmark is compiled into arrays of about 20 bytes a word and broadcast in
parts of at most PART_CHARS characters each; the texts are read once for each
part.

Edge cases: null and empty texts match nothing, as do null items and items
without words; repeated rows give repeated results; an empty benchmark gives no
matches; a null item_id is reported as null; other columns stay in
`decontaminate` and are ignored by `find_leaks`.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from folioforge.llm.common import WordHashes, bit_sums, map_rows, shingle_hashes, stage, text_bytes

SHINGLE, SIMILARITY = 5, 0.8
#: Bits in which the fingerprints of similar windows may differ: 3.5 deviations above what similarity 0.8 leads to.
RADIUS = 20
BLOCKS = 8
#: Characters of benchmark texts in one broadcast part; compiled they take about 30 MB.
PART_CHARS = 8_000_000
#: Windows that are fingerprinted at once; this bounds memory.
TOGETHER = 16_384
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


def window_fingerprints(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """64-bit fingerprints of the runs of `size` shingle hashes at `starts`."""
    bits = np.unpackbits(np.ascontiguousarray(hashes.astype(">u8")).view(np.uint8).reshape(-1, 8), axis=1)
    sums = np.vstack([np.zeros((1, 64), np.int32), bits.cumsum(0, dtype=np.int32)])
    on = 2 * (sums[starts + size] - sums[starts]) > size
    return np.packbits(on, axis=1).view(">u8").reshape(-1).astype(np.uint64)


class HammingBlocks:
    """Fingerprints within a radius of one of them, found by block: table[v] tells whether a block's difference v is small enough."""

    def __init__(self, radius: int, blocks: int = BLOCKS):
        self.radius, self.blocks, width = radius, blocks, 64 // blocks
        self.kind = np.dtype(f"u{width // 8}")
        self.table = np.bitwise_count(np.arange(1 << width)) <= radius // blocks

    def near(self, own: np.uint64, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, distances) of the probes within the radius of own."""
        differ = probes ^ own
        at = np.flatnonzero(self.table[differ.view(self.kind).reshape(len(probes), self.blocks)].any(axis=1))
        d = np.bitwise_count(differ[at])
        ok = d <= self.radius
        return at[ok], d[ok]


class Leads:
    """Shingles of one length and the items that each leads to."""

    def __init__(self, pairs: list[tuple[np.ndarray, int]]):
        hashes = np.concatenate([h for h, _ in pairs])
        owners = np.repeat(np.array([i for _, i in pairs], np.int32), [len(h) for h, _ in pairs])
        order = np.argsort(hashes, kind="stable")
        self.grams, first = np.unique(hashes[order], return_index=True)
        self.first, self.owners = np.append(first, len(order)).astype(np.int64), owners[order]
        self.bits = max(8, min(24, 4 + int(len(hashes)).bit_length()))
        self.held = np.zeros(1 << self.bits, bool)
        self.held[self.grams >> np.uint64(64 - self.bits)] = True

    def hits(self, shingles: np.ndarray) -> dict[int, np.ndarray]:
        """item: ascending places of shingles that lead to it."""
        places = np.flatnonzero(self.held[shingles >> np.uint64(64 - self.bits)])
        at = np.minimum(np.searchsorted(self.grams, shingles[places]), len(self.grams) - 1)
        ok = self.grams[at] == shingles[places]
        places, at = places[ok], at[ok]
        if not len(at):
            return {}
        n = self.first[at + 1] - self.first[at]
        ends = np.cumsum(n)
        items = self.owners[np.repeat(self.first[at] - (ends - n), n) + np.arange(ends[-1])]
        order = np.argsort(items, kind="stable")
        cuts = np.flatnonzero(np.diff(items[order])) + 1
        return {int(items[part[0]]): np.repeat(places, n)[part] for part in np.split(order, cuts)}


class Benchmark:
    """Items compiled: ids, words, fingerprints, shingles with multiplicities, and the rare shingles that lead to them."""

    def __init__(self, items: list[tuple[int, bytes]], k: int = SHINGLE, radius: int = RADIUS, least: float = SIMILARITY):
        self.k, self.least, self.blocks = k, least, HammingBlocks(radius)
        table, kept = WordHashes(), [(i, w) for i, w in ((i, words_of(t)) for i, t in items) if w]
        self.ids = [i for i, _ in kept]
        self.size = np.array([len(w) for _, w in kept], np.int64)
        hashes = [shingle_hashes(table.of(w), k) for _, w in kept]
        self.fps = np.array([int.from_bytes(np.packbits(2 * bit_sums(h) > len(h)).tobytes(), "big") for h in hashes], np.uint64)
        own = [np.unique(h, return_counts=True) for h in hashes]
        self.offset = np.cumsum([0, *(len(g) for g, _ in own)])
        self.grams, self.counts = (np.concatenate([o[i] for o in own]) if own else np.zeros(0, t) for i, t in enumerate((np.uint64, np.int64)))
        self.counts = self.counts.astype(np.int32)
        seen, times = np.unique(self.grams, return_counts=True)
        leads = defaultdict(list)
        for place, h in enumerate(hashes):
            rarity = times[np.searchsorted(seen, h)]
            rare = h[np.lexsort((h, rarity))][: len(h) - math.ceil(least * len(h) - 1e-9) + 1]
            leads[min(k, int(self.size[place]))].append((np.unique(rare), place))
        self.leads = {n: Leads(pairs) for n, pairs in leads.items()}

    def matches(self, text: bytes, table: WordHashes) -> list[tuple]:
        """(item_id, first word, words, similarity, distance): for each item that matches, its best window."""
        words = words_of(text)
        hashes, best = table.of(words), {}
        for own, leads in self.leads.items():
            if len(words) >= own:
                shingles = shingle_hashes(hashes, own)
                for item, places in leads.hits(shingles).items():
                    found = self._best(shingles, own, item, places, len(words))
                    if found:
                        best[item] = found
        return [(self.ids[i], -neg, size, sim, dist) for i, (sim, neg, size, dist) in sorted(best.items())]

    def _best(self, shingles: np.ndarray, own: int, item: int, places: np.ndarray, words: int) -> tuple | None:
        """(similarity, -first word, words, distance) of the item's best window over one of the places."""
        size = min(int(self.size[item]), words)
        n, best = size - own + 1, None  # shingles of a window
        low, high = np.maximum(places - n + 1, 0), np.minimum(places, words - size)
        apart = np.flatnonzero(low[1:] > high[:-1] + 1) + 1
        for a, b in zip(low[np.r_[0, apart]].tolist(), high[np.r_[apart - 1, len(low) - 1]].tolist()):
            for start in range(a, b + 1, TOGETHER):
                found = self._window(shingles[start : min(b + 1, start + TOGETHER) + n - 1], n, item, start)
                if found and (best is None or found > best):
                    best = found
        return best and (best[0], best[1], size, best[2])

    def _window(self, part: np.ndarray, n: int, item: int, start: int) -> tuple | None:
        probes = window_fingerprints(part, np.arange(len(part) - n + 1), n)
        near, distance = self.blocks.near(self.fps[item], probes)
        if not len(near):
            return None
        grams, counts = (x[self.offset[item] : self.offset[item + 1]] for x in (self.grams, self.counts))
        at = np.minimum(np.searchsorted(grams, part), len(grams) - 1)
        at = np.where(grams[at] == part, at, len(grams))
        total, best = int(counts.sum()), None
        for i, d in zip(near.tolist(), distance.tolist()):
            mine = np.bincount(at[i : i + n], minlength=len(grams) + 1)[:-1]
            both = int(np.minimum(mine, counts).sum())
            sim = both / (n + total - both)
            if sim >= self.least and (best is None or (sim, -start - i) > best[:2]):
                best = (sim, -start - i, d)
        return best


def parts_of(benchmark: DataFrame, item_col: str, text_col: str, most: int = PART_CHARS):
    """The benchmark's items in parts of bounded size, in order of id and text; one part is on the driver at a time."""
    rows = benchmark.filter(F.col(text_col).isNotNull()).select(F.col(item_col).alias("item"), text_bytes(text_col).alias("text")).orderBy("item", "text")
    part, size = [], 0
    for r in rows.toLocalIterator():
        if part and size + len(r.text) > most:
            yield part
            part, size = [], 0
        part.append((r.item, bytes(r.text)))
        size += len(r.text)
    if part:
        yield part


def find_leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", **options) -> DataFrame:
    """One row per row of df and item that it holds: ids, first word and words of the best window, similarity, distance."""
    kind, item_kind = df.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    cut = df.select(F.col(id_col), text_bytes(text_col))
    schema = f"`{id_col}` {kind}, `{item_col}` {item_kind}, first_word long, n_words long, similarity double, distance int"
    out = None
    for items in parts_of(benchmark, item_col, item_text_col):
        compiled = df.sparkSession.sparkContext.broadcast(Benchmark(items, **options))

        def run(batches, compiled=compiled):
            table = WordHashes()
            for batch in batches:
                got = [(doc, *m) for doc, t in zip(batch.column(0).to_pylist(), batch.column(1)) for m in compiled.value.matches(t.as_py(), table)]
                yield {n: [g[i] for g in got] for i, n in enumerate((id_col, item_col, "first_word", "n_words", "similarity", "distance"))}

        found = map_rows(cut, run, schema)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else df.sparkSession.createDataFrame([], schema)


def decontaminate(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", **options) -> DataFrame:
    """The rows of df, all columns, whose texts hold no benchmark item; what one part of the benchmark leaves is written before the next one's turn."""
    arrow = to_arrow_schema(df.schema)
    out = df
    for number, items in enumerate(parts_of(benchmark, item_col, item_text_col)):
        if number:
            out = stage(out, "decontaminated")
        compiled = df.sparkSession.sparkContext.broadcast(Benchmark(items, **options))

        def run(batches, compiled=compiled):
            table = WordHashes()
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
                clean = pa.array([t is None or not compiled.value.matches(t.encode(), table) for t in texts], pa.bool_())
                yield pa.RecordBatch.from_arrays([c.filter(clean) for c in batch.columns], schema=arrow)

        out = out.mapInArrow(run, from_arrow_schema(arrow))
    return out
