"""Degenerate repetition within a text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Shortest and longest pattern, and from how many repeats it counts.
MIN_LEN, MAX_LEN, REPEATS = 5, 64, 3


def _apart(at: np.ndarray, kind: np.ndarray, n: int) -> np.ndarray:
    """For each kind, at how many of its places a pattern of length n stands without overlap, counted from the left."""
    order = np.argsort(kind, kind="stable")
    place, number = at[order], np.bincount(kind)
    ends = np.cumsum(number)
    close = np.diff(place) < n
    close &= np.diff(kind[order]) == 0
    for k in np.unique(kind[order][1:][close]):
        last, seen = -n, 0
        for p in place[ends[k] - number[k] : ends[k]].tolist():
            if p - last >= n:
                last, seen = p, seen + 1
        number[k] = seen
    return number


def _falls(text: str, min_len: int, max_len: int) -> tuple[np.ndarray, np.ndarray]:
    """(count, fall) for each place: how often its first min_len characters stand in the text without overlap, and the
    first length up to max_len at which the pattern is less frequent than that; 0 where there is none.

    Places are refined into kinds by one more character at a time. Places of a
    kind fall together, so those that fell or stand once are left behind.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    count, fall = np.ones(len(codes), np.int64), np.zeros(len(codes), np.int64)
    at, kind = np.arange(len(codes)), np.zeros(len(codes), np.int64)
    for n in range(1, max_len + 1):
        fits = at + n <= len(codes)
        at, kind = at[fits], kind[fits]
        if not len(at):
            break
        kind = np.unique(kind * 0x110000 + codes[at + n - 1], return_inverse=True)[1]
        if n < min_len:
            continue
        seen = _apart(at, kind, n)[kind]
        if n == min_len:
            count[at], going = seen, seen > 1
        else:
            going = seen == count[at]
            fall[at[~going]] = n
        at, kind = at[going], kind[going]
    return count, fall


def repeated_content(text: str, min_len: int = MIN_LEN, max_len: int = MAX_LEN, repeats: int = REPEATS, compat: bool = False) -> dict[str, int]:
    """Patterns that occur `repeats` times or more without overlap, with their counts.

    From each place the pattern grows while it stays as frequent as it was; the
    scan goes on behind the first length at which it is not. compat stops at the
    first pattern that would reach over the end of the text; else the lengths
    that still fit are tried.
    """
    found: dict[str, int] = {}
    count, fall = (x.tolist() for x in _falls(text, min_len, max_len))
    at, size = 0, len(text)
    while at < size:
        n = fall[at]
        if not n and compat and size - at < max_len:
            break
        if count[at] >= repeats and (n or size - at < max_len):
            pattern = text[at : at + n - 1] if n else text[at:]
            found[pattern] = max(count[at], found.get(pattern, 0))
        at += n or 1
    return found


def repeated_column(text: Column, **options) -> Column:
    @F.pandas_udf("map<string,int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: {} if t is None else repeated_content(t, **options))

    return run(text)


def merged_repeats(df: DataFrame, key: str, order: str, text: str, **options) -> DataFrame:
    """(pattern, n) over all texts: of several counts of a pattern the last in order stands; ascending by n, then pattern."""
    flat = df.select(key, order, F.explode(repeated_column(F.col(text), **options)).alias("pattern", "n"))
    return flat.groupBy("pattern").agg(F.max_by("n", F.struct(order, key)).alias("n")).orderBy("n", "pattern")
