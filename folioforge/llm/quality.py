"""Operator 10: a quality classifier, a generalised additive model with pairwise interactions.

Features describe the whole text only. The model is fitted on a bounded sample
of labelled rows (SAMPLE, those with the smallest hash of the id, over all of
the table), and every row is scored by adding up its bins' numbers.

Edge cases: a null text is empty, and empty texts get a score like any other;
labels that are null or neither 0 nor 1 are not learned from; without labels
every score is 0.5; a null id is not learned from and never held out; repeated
rows give repeated rows, in either function; labels that repeat and rows that
share an id are learned from once; other columns are ignored by `score_quality`
and kept by `keep_good`. Two features end at a bound, beyond which they tell
nothing more: words to a line at 200, words to a sentence at 100.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from folioforge.llm.boosting import AdditiveModel
from folioforge.llm.common import bounded_sample, map_rows, stage, text_bytes

#: Labelled rows to fit on, at most.
SAMPLE = 20_000
#: Ids with this remainder of their CRC-32 are never learned from.
HELD_OUT_OF, HELD_OUT = 3, 1

UPPER, LOWER, DIGIT = (np.isin(np.arange(256), np.frombuffer(s, np.uint8)) for s in (bytes(range(65, 91)), bytes(range(97, 123)), b"0123456789"))
SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))
HIGH = np.arange(256) >= 128
FIRST_OF_MANY = (np.arange(256) & 0xC0) != 0x80
SYMBOLS = ~(UPPER | LOWER | DIGIT | SPACE | HIGH)
ENDERS, COMMAS = (np.isin(np.arange(256), np.frombuffer(s, np.uint8)) for s in (b".", b",;:"))
SHOUTS, MARKS = (np.isin(np.arange(256), np.frombuffer(s, np.uint8)) for s in (b"!?", b"#$%&*+<=>@\\^_`{|}~"))

FEATURES = (
    "log_chars", "upper", "digit", "symbol", "ender", "comma", "shout", "mark", "high", "space", "word_length", "long_word", "distinct_words",
    "log_words", "words_a_line", "distinct_lines", "words_a_sentence", "top_word", "entropy", "marked_words", "capital_words",
)


def features(text: bytes) -> list[float]:
    """FEATURES of a text as UTF-8; an empty one has all zero but for ratios of themselves."""
    n = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = max(1, int(n[FIRST_OF_MANY].sum()))
    words = text.split()
    w = max(1, len(words))
    lines = text.split(b"\n")
    kinds = set(words)
    share = n[n > 0] / max(1, len(text))
    some = words if len(words) < 2 else [*kinds]
    return [
        float(np.log1p(len(text))), *(float(n[m].sum()) / chars for m in (UPPER, DIGIT, SYMBOLS, ENDERS, COMMAS, SHOUTS, MARKS, HIGH, SPACE)),
        (len(text) - int(n[SPACE].sum())) / w, max(map(len, some), default=0) / 32, len(kinds) / w,
        float(np.log1p(len(words))), min(200.0, w / len(lines)), len(set(lines)) / len(lines), min(100.0, w / (int(n[ENDERS].sum() + n[SHOUTS].sum()) + 1)),
        _top(words), -float((share * np.log2(share)).sum()), sum(not x[-1:].isalnum() and x[-1] < 128 and x[-1:] not in b".,;:" for x in some) / max(1, len(some)),
        sum(x.isupper() for x in some) / max(1, len(some)),
    ]


def _top(words: list[bytes]) -> float:
    """The share of the most frequent word."""
    return Counter(words).most_common(1)[0][1] / len(words) if words else 0.0


def feature_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            yield {id_col: batch.column(0), "x": [features(t.as_py()) for t in batch.column(1)]}

    return map_rows(df.select(id_col, text_bytes(text_col)), run, f"`{id_col}` {kind}, x array<double>")


def chosen_labels(labels: DataFrame, id_col: str, label_col: str, sample: int, of: int = HELD_OUT_OF, rest: int = HELD_OUT) -> DataFrame:
    """(id, y): at most `sample` labels of ids that are not held out."""
    usable = labels.filter(F.col(label_col).isin(0, 1) & (crc(id_col) % of != rest))
    return bounded_sample(usable.select(id_col, F.col(label_col).cast("int").alias("y")), [id_col, "y"], sample)


def fit_quality(labelled: DataFrame, id_col: str) -> AdditiveModel:
    """From (id, x, y) rows; of an id with several rows the one with the smallest features, so that no more come than labels were chosen."""
    once = labelled.groupBy(id_col, "y").agg(F.min("x").alias("x"))
    got = once.toPandas().sort_values([id_col, "y"], kind="stable")
    x = np.array(got["x"].tolist(), float).reshape(len(got), len(FEATURES))
    return AdditiveModel.fit(x, got["y"].to_numpy(float))


def crc(id_col: str):
    return F.crc32(F.col(id_col).cast("string").cast("binary"))


def score_quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """One row per row of df: id, held_out, score (higher: label 1 is likelier) and predicted."""
    rows = stage(feature_rows(df, id_col, text_col), "quality-features")
    chosen = chosen_labels(labels, id_col, label_col, sample)
    model = df.sparkSession.sparkContext.broadcast(fit_quality(rows.join(F.broadcast(chosen), id_col), id_col))
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), float).reshape(batch.num_rows, len(FEATURES))
            yield {id_col: batch.column(0), "score": model.value.predict(x)}

    scored = map_rows(rows, run, f"`{id_col}` {kind}, score double")
    return scored.select(id_col, F.coalesce(crc(id_col) % HELD_OUT_OF == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, least: float = 0.5) -> DataFrame:
    """The rows of df, all columns, whose score is at least `least`."""
    chosen = stage(chosen_labels(labels, id_col, label_col, sample), "quality-labels")
    texts = df.select(id_col, text_col).join(F.broadcast(chosen.select(id_col).distinct()), id_col, "left_semi")
    labelled = feature_rows(texts, id_col, text_col).join(F.broadcast(chosen), id_col)
    model = df.sparkSession.sparkContext.broadcast(fit_quality(labelled, id_col))
    arrow = to_arrow_schema(df.schema)

    def run(batches):
        for batch in batches:
            x = [features(b"" if t is None else t.encode()) for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
            good = model.value.predict(np.array(x, float).reshape(len(x), len(FEATURES))) >= least
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(good)) for c in batch.columns], schema=arrow)

    return df.mapInArrow(run, from_arrow_schema(arrow))
