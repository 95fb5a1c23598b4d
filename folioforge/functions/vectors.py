"""Vector similarity as expressions over arrays."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors of one length; null if either is zero."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def similarity_gap(source: Column, target: Column, other: Column) -> tuple[Column, Column]:
    """(how much closer one of two translations is to the source, how close they are to each other)."""
    return F.abs(cosine(source, target) - cosine(source, other)), cosine(target, other)


def rounded(value: Column, digits: int) -> Column:
    """value rounded as SQL engines do, half away from zero once it is scaled; F.round goes by the decimal that is printed."""
    unit = F.lit(10.0**digits)
    return F.round(value * unit, 0) / unit


def exp(value: Column) -> Column:
    """exp as the C library has it. The JVM's may be a unit in the last place off, which shows in a rounded result."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(v: float) -> float:
            return math.exp(v) if v < 709 else float(np.exp(v))  # math.exp raises where the result is infinite

        for values in batches:
            found = np.fromiter(map(one, values.to_numpy(float, na_value=np.nan)), float, len(values))
            yield pd.Series(found, index=values.index)

    return F.when(value.isNotNull(), run(value))


def perplexity(loss: Column) -> Column:
    """exp of a loss; the largest double where the loss is no number."""
    return F.when(F.isnan(loss), sys.float_info.max).otherwise(exp(loss))
