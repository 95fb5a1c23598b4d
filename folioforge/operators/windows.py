"""Windows over ordered rows: context by budget, moving means, cuts, priority.

Every operator takes `keys` (the columns of a document or series) and the column
of the position; one shuffle on the keys serves a whole chain of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _starts(df: DataFrame, keys: list[str], pos: str, size: Column) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(pos)
    return df.withColumn("__size", size.cast("long")).withColumn("__start", F.sum("__size").over(w) - F.col("__size"))


def look_back(df: DataFrame, keys: list[str], pos: str, text: str, size: Column, budget: int, out: str = "context") -> DataFrame:
    """Adds the longest run of texts right before each row whose sizes add up to the budget at most.

    Sizes have to be 1 or more. The run is a RANGE frame over the running start,
    so no row looks further than its budget.
    """
    w = Window.partitionBy(*keys).orderBy("__start").rangeBetween(-budget, -1)
    return _starts(df, keys, pos, size).withColumn(out, F.array_join(F.collect_list(text).over(w), "")).drop("__size", "__start")


def look_ahead(df: DataFrame, keys: list[str], pos: str, text: str, size: Column, budget: int, out: str = "lookahead") -> DataFrame:
    """Adds each row's text with the following ones while their sizes add up to the budget at most."""
    started = _starts(df, keys, pos, size).withColumn("__end", F.col("__start") + F.col("__size"))
    ends = Window.partitionBy(*keys).orderBy("__end")
    # a row is in the window if its end is within the budget from the start of the first: count by ends
    counted = started.withColumn("__n", F.count("*").over(ends.rangeBetween(1, budget)))
    shifted = counted.withColumn("__limit", F.col("__start") + budget)
    order = Window.partitionBy(*keys).orderBy(pos)
    before = F.coalesce(F.lag("__n").over(order), F.lit(-1))
    # the row before ends where this one starts, so its count is the number of rows that fit from here
    first = F.count_if(F.col("__end") <= budget).over(Window.partitionBy(*keys))
    n = F.greatest(F.when(before < 0, first).otherwise(before), F.lit(1)).cast("int")
    rest = F.collect_list(text).over(order.rowsBetween(0, budget))
    return shifted.withColumn("__k", n).withColumn(out, F.array_join(F.slice(rest, F.lit(1), F.col("__k")), "")).drop("__size", "__start", "__end", "__n", "__limit", "__k")


def char_context(df: DataFrame, keys: list[str], pos: str, text: str, size: Column, budget: int, out: str = "context") -> DataFrame:
    """Adds the longest run of texts that ends with each row's own and adds up to the budget; the own text always stays."""
    started = _starts(df, keys, pos, size).withColumn("__end", F.col("__start") + F.col("__size"))
    back = Window.partitionBy(*keys).orderBy("__start").rangeBetween(-budget, -1)
    # rows that start within the budget before this row's end
    own = F.array(F.struct(F.col("__start").alias("s"), F.col(text).alias("t")))
    run = F.concat(F.collect_list(F.struct(F.col("__start").alias("s"), F.col(text).alias("t"))).over(back), own)
    fits = F.filter(run, lambda x: (x["s"] >= F.col("__end") - budget) | (x["s"] == F.col("__start")))
    return started.withColumn(out, F.array_join(F.transform(fits, lambda x: x["t"]), "")).drop("__size", "__start", "__end")


def forward_mean(df: DataFrame, keys: list[str], pos: str, value: str, size: int = 3, out: str = "forward_mean") -> DataFrame:
    """Adds the mean of each value and the next size - 1, fewer at the end."""
    return df.withColumn(out, F.avg(value).over(Window.partitionBy(*keys).orderBy(pos).rowsBetween(0, size - 1)))


def argmin(df: DataFrame, keys: list[str], pos: str, value: str) -> DataFrame:
    """For each key the position of the smallest value, the first of equals."""
    least = F.min(F.struct(F.col(value).alias("value"), F.col(pos).alias("pos")))
    return df.groupBy(*keys).agg(least.alias("m")).select(*keys, F.col("m.pos").alias(pos), F.col("m.value").alias(value))


def proportions(df: DataFrame, keys: list[str], value: str, out: str = "proportion", pos: str | None = None) -> DataFrame:
    """Adds each value's share of its key's total; null where the total is zero.

    A total is summed in order of pos. Without it, rows are summed as the shuffle
    brings them, and the last digit of a share of doubles is open.
    """
    whole = Window.partitionBy(*keys)
    if pos:
        whole = whole.orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn(out, F.try_divide(F.col(value), F.sum(value).over(whole)))


def threshold_cuts(df: DataFrame, keys: list[str], pos: str, value: str, threshold: float, out: str = "segment") -> DataFrame:
    """Adds a segment number from 0; a value over its key's median times the threshold begins a new one, but for the first row."""
    order = Window.partitionBy(*keys).orderBy(pos)
    median = df.groupBy(*keys).agg(F.median(value).alias("__median"))
    joined = df.join(median, keys)
    cut = (F.col(value) > F.col("__median") * threshold) & (F.row_number().over(order) > 1)
    return joined.withColumn("__cut", F.coalesce(cut.cast("int"), F.lit(0))).withColumn(out, F.sum("__cut").over(order).cast("int")).drop("__cut", "__median")


def first_by_priority(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row for each key: the first in the order."""
    return df.withColumn("__nth", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("__nth = 1").drop("__nth")


def forward_fill(df: DataFrame, keys: list[str], pos: str, value: str) -> DataFrame:
    """value with each null replaced by the last one before it."""
    return df.withColumn(value, F.last(value, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(pos)))
