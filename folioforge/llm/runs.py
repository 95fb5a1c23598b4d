"""Operator 11: maximal periodic runs of words, from Lyndon stacks.

A text's words are numbered; any order of the numbers serves. For an order and
its reverse, a stack is scanned from right to left and gives for every word the
longest Lyndon word that begins there: up to the next smaller suffix. Every run
has a root among these, under one of the two orders, so each root that two
neighbouring copies could share is extended to both sides, and what reaches
twice its length is a run with that root's length as its smallest period.

Suffixes are compared and roots extended by longest common extensions: a few
words directly, then a binary search over rolling hashes (polynomials modulo
2^64), and what the hashes call equal is compared word by word; where that
fails, the place of the first difference is taken from the words. Comparisons
inside a stretch that has been found periodic take their answer from it, so
texts that are one long repeat stay cheap. No suffix array is built.

Words are runs of anything but ASCII white space. Work is that of a row: texts
are never gathered, and memory is some tens of bytes for each word of one text.

Edge cases: a null or empty text, or one of white space, has no words and no
runs; its collapsed text is empty. Repeated rows give repeated results. Of runs
of equal length the first one is reported, then that of the smaller period.
Null ids stay null. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import MASK64, map_rows, mix64, text_bytes

#: Words that a run has at least, besides two periods.
MIN_WORDS = 12
#: Words that are compared directly before hashes are.
DIRECT = 4
BASE = 0x9E3779B97F4A7C15


class Extensions:
    """Longest common extensions of a sequence of numbers, and the periodic stretches that they have met."""

    def __init__(self, numbers: np.ndarray):
        self.n = n = len(numbers)
        self.words = numbers.astype(np.int32)
        self.list = self.words.tolist()
        self.raw = self.words.tobytes()
        # a prefix's polynomial, and the powers of its base
        power = np.full(n + 1, BASE, np.uint64)
        power[0] = 1
        self.power = np.multiply.accumulate(power)
        hashes = mix64(self.words.astype(np.uint64) + np.uint64(1)) * self.power[:n]
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(hashes)])
        self._prefix, self._power = memoryview(self.prefix), memoryview(self.power)
        #: period to the stretch with that period that was met last: (start, end)
        self.stretch: dict[int, tuple[int, int]] = {}

    def alike(self, i: int, j: int, length: int) -> bool:
        """Whether the hashes of two pieces are equal, i < j."""
        p = self._prefix
        return not ((p[i + length] - p[i]) * self._power[j - i] - p[j + length] + p[j]) & MASK64

    def all_alike(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.prefix[i + length] - self.prefix[i]) * self.power[j - i] == self.prefix[j + length] - self.prefix[j]

    def ahead(self, i: int, j: int) -> int:
        """How many words from i < j on are the same."""
        known = self.stretch.get(j - i)
        if known and known[0] <= i and j < known[1]:
            return known[1] - j
        w, most = self.list, self.n - j
        length = 0
        while length < most and w[i + length] == w[j + length]:
            length += 1
            if length == DIRECT:
                length = self._longest(most, lambda k: self.alike(i, j, k), lambda k: (i, j, k))
                break
        if length >= j - i:
            self.stretch[j - i] = (i - self.behind(i, j), j + length)
        return length

    def behind(self, i: int, j: int) -> int:
        """How many words before i < j are the same."""
        w, length = self.list, 0
        while length < i and w[i - 1 - length] == w[j - 1 - length]:
            length += 1
            if length == DIRECT:
                return self._longest(i, lambda k: self.alike(i - k, j - k, k), lambda k: (i - k, j - k, k), back=True)
        return length

    def _longest(self, most: int, alike: Callable[[int], bool], piece: Callable[[int], tuple[int, int, int]], back: bool = False) -> int:
        """Binary search between doubled lengths; the pieces called equal are then compared themselves."""
        low, step = DIRECT, DIRECT
        while low + step <= most and alike(low + step):
            low, step = low + step, 2 * step
        high = min(most, low + step - 1)
        while low < high:
            middle = (low + high + 1) // 2
            if alike(middle):
                low = middle
            else:
                high = middle - 1
        i, j, k = piece(low)
        if self.raw[4 * i : 4 * (i + k)] == self.raw[4 * j : 4 * (j + k)]:
            return low
        differ = np.flatnonzero(self.words[i : i + k] != self.words[j : j + k])
        return int(k - 1 - differ[-1] if back else differ[0])


def next_smaller(keys: list[int], ahead: Callable[[int, int], int]) -> np.ndarray:
    """For each place the next one whose suffix is smaller; the end is smaller than all."""
    n = len(keys)
    keys = [*keys, min(keys, default=0) - 1]
    after = [n] * (n + 1)
    for i in range(n - 1, -1, -1):
        own, j = keys[i], i + 1
        while True:
            other = keys[j]
            if other == own:
                if keys[i + 1] != keys[j + 1]:
                    smaller = keys[i + 1] > keys[j + 1]
                else:
                    length = ahead(i, j)
                    smaller = keys[i + length] > keys[j + length]
            else:
                smaller = other < own
            if smaller:
                break
            j = after[j]
        after[i] = j
    return np.array(after[:n], np.int64)


def find_runs(numbers: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of each maximal run of numbers from 0, by start, then period."""
    n = len(numbers)
    if n < min_words or n < 2:
        return []
    lce = Extensions(numbers)
    words, keys = lce.words, lce.list
    largest = max(keys)
    found: dict[tuple[int, int], int] = {}
    for own in (keys, [largest - k for k in keys]):
        after = next_smaller(own, lce.ahead)
        for i, period in zip(*(x.tolist() for x in _roots(lce, words, after, min_words))):
            known = lce.stretch.get(period)
            if not (known and known[0] <= i <= known[1] - period):
                known = i - lce.behind(i, i + period), i + period + lce.ahead(i, i + period)
                lce.stretch[period] = known
            start, end = known
            if end - start >= max(min_words, 2 * period):
                found[start, period] = end
    return sorted((start, end - start, period) for (start, period), end in found.items())


def _roots(lce: Extensions, words: np.ndarray, after: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, length) of the Lyndon words that can be roots of a run.

    What is missing to a run's length is made up of equal words to the left and
    to the right of the root and its copy, so one side has half of it.
    """
    n, i = len(words), np.arange(len(words))
    padded = np.append(words, -1)
    same = padded[after] == words
    same[1:] |= words[:-1] == words[after[1:] - 1]
    i = i[same]
    j = after[i]
    period = j - i
    half = (np.maximum(period, min_words - period) + 1) // 2
    right = j + half <= n
    right[right] = lce.all_alike(i[right], j[right], half[right])
    left = i - half >= 0
    left &= ~right
    left[left] = lce.all_alike(i[left] - half[left], j[left] - half[left], half[left])
    kept = right | left
    return i[kept], period[kept]


def numbered(words: list[bytes]) -> np.ndarray:
    """Words by the order in which they first appear."""
    table: defaultdict = defaultdict()
    table.default_factory = table.__len__
    return np.fromiter(map(table.__getitem__, words), np.int64, len(words))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run contains after its first period, with one space between."""
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    if not runs:
        return b" ".join(words)
    return b" ".join([w for w, d in zip(words, np.cumsum(depth[:-1]).tolist()) if not d])


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, edit: Callable | None = None, keep: bool = True) -> DataFrame:
    """One row per row of df: its runs, the longest one, and digests of the runs and of the collapsed text.

    keep leaves the runs themselves and the collapsed text in. edit(id, words)
    may give other words in place of a text's own.
    """
    kind = df.schema[id_col].dataType.simpleString()
    names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs", "collapsed")

    def row(key, text: bytes) -> tuple:
        words = text.split()
        if edit:
            words = edit(key, words)
        runs = find_runs(numbered(words), min_words)
        start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        short = collapsed(words, runs)
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        exponent = 1000 * length // period if runs else None
        out = len(runs), start, length, period, exponent, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(short).hexdigest()
        return (*out, [dict(zip(("start", "length", "period"), r)) for r in runs], short.decode()) if keep else out

    def run(batches):
        for batch in batches:
            rows = [row(key.as_py(), text.as_py()) for key, text in zip(batch.column(0), batch.column(1))]
            out = dict(zip(names, zip(*rows))) if rows else {n: [] for n in names}
            if keep:
                out["runs"] = pa.array(out["runs"], pa.list_(pa.struct([pa.field(n, pa.int64()) for n in ("start", "length", "period")])))
            yield {id_col: batch.column(0)} | {n: c if isinstance(c, pa.Array) else list(c) for n, c in out.items()}

    more = ", runs array<struct<start:long,length:long,period:long>>, collapsed string" if keep else ""
    schema = f"`{id_col}` {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string{more}"
    return map_rows(df.select(F.col(id_col), text_bytes(text_col)), run, schema)
