"""Duplicates, keywords, scores, characters and chunk sizes."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.text import snippet
from folioforge.operators.windows import first_by_priority

# The keywords by which pages are dropped, one of them given twice.
DROP_KEYWORDS = [
    "拷貝", "拷贝", "拷貝漫畫", "拷贝漫画", "拷貝漫画", "拷贝漫畫", "DMS", "dms", "DM5", "dm5", "ZEROBYW", "zerobyw", "搬運網", "搬运网", "運網", "运网",
    "Scan ", "scan ", "墮落的猴子", "堕落的猴子", "团子", "汉化", "漢化", "嵌字", "嵌字", "校對", "校对", "圖源", "图源", "合購", "合购",
]


def text_key(text: Column) -> Column:
    """What stands for a text in shuffles: its MD5, so that whole texts never travel."""
    return F.md5(text.cast("binary"))


def exact_duplicates(df: DataFrame, text: Column, item: str) -> DataFrame:
    """(text_md5, item, n): one row for each item whose text others have too, with the number of rows of that text.

    Counting combines before the shuffle and comes first, so that only rows of
    repeated texts meet it; they stay rows, as a text may be that of a third of all.
    """
    rows = df.select(text_key(text).alias("text_md5"), F.col(item).alias("item"))
    repeated = rows.groupBy(F.col("text_md5").alias("__key")).agg(F.count("*").alias("n")).filter("n > 1")
    return rows.join(repeated, F.col("text_md5").eqNullSafe(F.col("__key"))).select("text_md5", "item", "n")


def duplicate_stats(df: DataFrame, text: Column) -> DataFrame:
    """One row: groups of repeated texts and the rows in them."""
    groups = df.groupBy(text_key(text).alias("key")).agg(F.count("*").alias("n")).filter("n > 1")
    return groups.agg(F.count("*").alias("n_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))


def later_occurrences(df: DataFrame, text: Column, order: str) -> DataFrame:
    """Rows whose text stood in an earlier row.

    The first row of each text comes from an aggregation that combines before the
    shuffle, so a text that a third of all rows share stays in no single task.
    """
    rows = df.withColumn("__text", text_key(text))
    first = rows.groupBy(F.col("__text").alias("__key")).agg(F.min(order).alias("__first"), F.count("*").alias("__n")).filter("__n > 1")
    return rows.join(first, F.col("__text").eqNullSafe(F.col("__key"))).filter(F.col(order) > F.col("__first")).select(*df.columns)


def distinct_characters(df: DataFrame, text: str) -> DataFrame:
    """(ch, n): each character and how often it occurs."""
    return df.select(F.explode(F.split(text, "")).alias("ch")).filter("ch <> ''").groupBy("ch").agg(F.count("*").alias("n"))


def keyword_hits(df: DataFrame, item: str, text: str, keywords: list[str], reach: int = 8) -> DataFrame:
    """(item, keyword, snippet) for each keyword that a text holds; the keyword list stays in the plan, no join."""
    words = F.array(*[F.lit(k) for k in dict.fromkeys(keywords)])
    hits = F.filter(words, lambda k: F.contains(F.col(text), k))
    return df.select(item, text, F.explode(hits).alias("keyword")).select(item, "keyword", snippet(F.col(text), F.col("keyword"), reach).alias("snippet"))


def keyword_priority(hits: DataFrame, item: str) -> DataFrame:
    """Each item's row of its longest keyword, the greatest of equally long ones."""
    return first_by_priority(hits, item, [F.length("keyword").desc(), F.col("keyword").desc()])


def keyword_counts(hits: DataFrame, item: str) -> DataFrame:
    """(keyword, n) after the priority rule, and a total; keywords that lost all their items have 0."""
    counts = keyword_priority(hits, item).groupBy("keyword").agg(F.count("*").alias("n"))
    named = hits.select("keyword").distinct().join(counts, "keyword", "left").select("keyword", F.coalesce("n", F.lit(0)).alias("n"))
    return named.unionByName(named.agg(F.lit("total").alias("keyword"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")))


def low_score_stats(df: DataFrame, scores: str, least: float = 0.8) -> DataFrame:
    """One row: scores, low ones, items with a low one."""
    low = F.size(F.filter(scores, lambda s: s < least))
    return df.agg(
        F.coalesce(F.sum(F.size(scores)), F.lit(0)).alias("n_scores"), F.coalesce(F.sum(low), F.lit(0)).alias("n_low"), F.count_if(low > 0).alias("n_items")
    )


def match_stats(df: DataFrame, item: str, texts: str, matches) -> DataFrame:
    """One row: texts of all items, those that match, items with one."""
    hit = F.size(F.filter(texts, matches))
    return df.agg(F.coalesce(F.sum(F.size(texts)), F.lit(0)).alias("n_texts"), F.coalesce(F.sum(hit), F.lit(0)).alias("n_matching"), F.count_if(hit > 0).alias("n_items"))


def first_matches(df: DataFrame, item: str, texts: str, matches, limit: int = 10) -> DataFrame:
    """The first few matching texts in order of item and place (a report)."""
    flat = df.select(item, F.posexplode(texts).alias("place", "text"))
    return flat.filter(matches(F.col("text"))).orderBy(item, "place").limit(limit)


def size_stats(df: DataFrame, keys: list[str], size: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum(size).alias("total"), F.count(size).alias("n"), F.avg(size).alias("mean"), F.median(size).alias("median")
    )


def first_mode(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """(keys, mode, n): per key the most frequent value; of equals the one whose first row comes first."""
    counts = df.groupBy(*keys, F.col(value).alias("mode")).agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("first"))
    best = Window.partitionBy(*keys).orderBy(F.desc("n"), "first")
    return counts.withColumn("__nth", F.row_number().over(best)).filter("__nth = 1").select(*keys, "mode", "n")


def extremes(df: DataFrame, keys: list[str], size: str, places: list[str], show: dict[str, Column]) -> DataFrame:
    """Per key the longest and the shortest row by (size, places) with what `show` takes from them."""
    row = F.struct(F.col(size), *places, *[c.alias(n) for n, c in show.items()])
    both = df.groupBy(*keys).agg(F.max(row).alias("hi"), F.min(row).alias("lo"))
    names = [size, *places, *show]
    return both.select(*keys, *[F.col(f"{s}.{n}").alias(f"{p}_{n}") for s, p in (("hi", "max"), ("lo", "min")) for n in names])


def ngram_counts(df: DataFrame, key: str, text: str, n: int, least: int = 2) -> DataFrame:
    """(key, gram, n): character n-grams, overlapping ones too, that occur `least` times or more in a text.

    Counted text by text in Arrow batches: as rows, every character would travel
    as a gram of its own.
    """

    @F.pandas_udf("map<string,long>")
    def count(texts: pd.Series) -> pd.Series:
        def grams(t):
            seen = Counter(t[i : i + n] for i in range(len(t) - n + 1)) if t else {}
            return {g: c for g, c in seen.items() if c >= least}

        return texts.map(grams)

    return df.select(key, F.explode(count(text)).alias("gram", "n"))
