"""Delimiter-preserving segmentation: Spark SQL expressions, and the cascade of them in Arrow batches.

All functions take and return Columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The delimiter sets and the piece limit of the cascade.
NEWLINE = "\n"
CLOSERS = "」』）)"
ENDERS = "。.！!？?；;"
COMMAS = "，,：:、"
MAX_PIECE = 256
#: Texts of a batch that are Python objects at once.
TEXTS_AT_ONCE = 64


def char_class(symbols: str) -> str:
    """The inside of a regex character class that matches exactly these symbols."""
    return "".join({"\n": r"\n", "\t": r"\t"}.get(c, re.escape(c)) for c in symbols)


def segment(text: Column, symbols: str = NEWLINE) -> Column:
    """Pieces of text: a run of other characters with the delimiter run that follows.

    A leading delimiter run is a piece of its own. Joining the pieces gives the
    text back; the empty text has no pieces and null stays null.
    """
    s = char_class(symbols)
    return F.regexp_extract_all(text, F.lit(f"[^{s}]*[{s}]+|[^{s}]+"), F.lit(0))


def hard_slices(text: Column, size: int = MAX_PIECE) -> Column:
    """Consecutive slices of `size` code points; the last may be shorter."""
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(size)),
        lambda k: F.substring(text, k, F.lit(size)),
    )


def segment_cascade(text: Column, limit: int = MAX_PIECE, keep_newline: bool = True) -> Column:
    """Segments by line, closers, enders, commas and at last fixed slices.

    Each level touches only the pieces that are still longer than `limit`. With
    keep_newline the later levels treat a newline as a delimiter too, so that it
    stays with the piece before it. Texts pass in Arrow batches, as array
    expressions in expressions are interpreted element by element; bytes that are
    no UTF-8 become U+FFFD, as in Spark's expressions of patterns.
    """
    extra = NEWLINE if keep_newline else ""
    levels = [char_class(s) for s in (NEWLINE, *(extra + level for level in (CLOSERS, ENDERS, COMMAS)))]

    @F.arrow_udf("array<string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # the pieces of `segment`, without its step back from a text's end
        lines, *finer = (re.compile(f"[^{s}]+[{s}]*|[{s}]+").findall for s in levels)

        def cut(data: bytes | None) -> list[str] | None:
            if data is None:
                return None
            pieces = lines(data.decode(errors="replace"))
            for level in finer:
                pieces = [q for p in pieces for q in ((p,) if len(p) <= limit else level(p))]
            return [q for p in pieces for q in ((p,) if len(p) <= limit else [p[k : k + limit] for k in range(0, len(p), limit)])]

        kind = pa.list_(pa.string())
        # a batch stays in Arrow; some texts at a time are Python objects
        for texts in batches:
            data = texts.cast(pa.binary())
            parts = (data.slice(i, TEXTS_AT_ONCE) for i in range(0, len(data), TEXTS_AT_ONCE))
            yield pa.concat_arrays([pa.array([], kind), *(pa.array([cut(t) for t in part.to_pylist()], kind) for part in parts)])
        pa.default_memory_pool().release_unused()

    return run(text)
