"""Positional alignment of two or three texts by line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.text import line_count_differs, stripped_lines


def zip_chapters(a: DataFrame, b: DataFrame, index: str) -> DataFrame:
    """Chapters of both sides by position; those that only one side has go."""
    return a.join(b, index)


#: Numbers that are ranked together.
SUFFIXES = 1 << 16


def pair_by_suffix(a: DataFrame, b: DataFrame, name_a: str, name_b: str) -> DataFrame:
    """Names of two folders paired in order of the number after the last underscore; the shorter side decides.

    Ranks count within ranges of numbers, after the names of all lower ranges, so
    no task orders a whole folder; names without a number come first and are one range.
    """

    def ranked(df, name):
        number = F.regexp_extract(F.element_at(F.split(name, "_"), -1), r"(\d+)", 1).try_cast("long")
        rows = df.select(F.col(name), number.alias("__number")).withColumn("__range", F.coalesce(F.floor(F.col("__number") / SUFFIXES), F.lit(-1)))
        lower = rows.groupBy("__range").agg(F.count("*").alias("__n"))
        lower = lower.select("__range", (F.sum("__n").over(Window.orderBy("__range")) - F.col("__n")).alias("__before"))
        own = F.row_number().over(Window.partitionBy("__range").orderBy("__number", name))
        return rows.withColumn("__own", own).join(lower, "__range").select(name, (F.col("__before") + F.col("__own")).cast("int").alias("rank"))

    return ranked(a, name_a).join(ranked(b, name_b), "rank").select("rank", name_a, name_b)


def align_lines(df: DataFrame, index: str, jp: str, tw: str) -> DataFrame:
    """(index, line_idx, jp, tw): lines of both texts by position, empty where one has none left."""
    left = df.select(index, F.posexplode(F.split(jp, "\n", -1)).alias("line_idx", "jp"))
    right = df.select(index, F.posexplode(F.split(tw, "\n", -1)).alias("line_idx", "tw"))
    joined = left.join(right, [index, "line_idx"], "full_outer")
    return joined.select(index, "line_idx", F.coalesce("jp", F.lit("")).alias("jp"), F.coalesce("tw", F.lit("")).alias("tw"))


def chunk_lines(chunks: DataFrame, index: str, chunk: str, text: str, n_lines: Column | None = None) -> DataFrame:
    """Lines of ordered chunks with their running position in the chapter: (index, chunk, line_idx, line)."""
    lines = stripped_lines(F.col(text))
    count = n_lines if n_lines is not None else F.size(lines)
    w = Window.partitionBy(index).orderBy(chunk)
    numbered = chunks.withColumn("__lines", lines).withColumn("__n", count).withColumn("__first", F.sum("__n").over(w) - F.col("__n"))
    flat = numbered.select(index, chunk, "__n", "__first", F.posexplode("__lines").alias("__p", "line"))
    return flat.filter("__p < __n").select(index, chunk, (F.col("__first") + F.col("__p")).cast("int").alias("line_idx"), "line")


def align_chunked(jp_chunks: DataFrame, tw: DataFrame, index: str, chunk: str, jp: str, tw_text: str, strip_tw: bool = True) -> DataFrame:
    """(index, chunk, line_idx, jp, tw): chunked lines against a whole text; left-over lines go to the last chunk."""
    left = chunk_lines(jp_chunks, index, chunk, jp).withColumnRenamed("line", "jp")
    lines = stripped_lines(F.col(tw_text)) if strip_tw else F.split(tw_text, "\n", -1)
    right = tw.select(index, F.posexplode(lines).alias("line_idx", "tw"))
    last = jp_chunks.groupBy(index).agg(F.max(chunk).alias("__last"))
    joined = left.join(right, [index, "line_idx"], "full_outer").join(last, index)
    return joined.select(index, F.coalesce(chunk, "__last").alias(chunk), "line_idx", F.coalesce("jp", F.lit("")).alias("jp"), F.coalesce("tw", F.lit("")).alias("tw"))


def align_three(chunks: DataFrame, tw: DataFrame, index: str, chunk: str, jp: str, translation: str, tw_text: str) -> DataFrame:
    """(index, chunk, line_idx, jp, tw, translation): source and translation lines zipped within each chunk, then against tw."""
    pairs = F.arrays_zip(stripped_lines(F.col(jp)).alias("j"), stripped_lines(F.col(translation)).alias("t"))
    n = F.least(F.size(stripped_lines(F.col(jp))), F.size(stripped_lines(F.col(translation))))
    w = Window.partitionBy(index).orderBy(chunk)
    numbered = chunks.withColumn("__pairs", F.slice(pairs, F.lit(1), n)).withColumn("__n", n).withColumn("__first", F.sum("__n").over(w) - F.col("__n"))
    left = numbered.select(index, chunk, "__first", F.posexplode("__pairs").alias("__p", "__x")).select(
        index, chunk, (F.col("__first") + F.col("__p")).cast("int").alias("line_idx"), F.col("__x.j").alias("jp"), F.col("__x.t").alias("translation")
    )
    right = tw.select(index, F.posexplode(F.split(tw_text, "\n", -1)).alias("line_idx", "tw"))
    last = chunks.groupBy(index).agg(F.max(chunk).alias("__last"))
    joined = left.join(right, [index, "line_idx"], "full_outer").join(last, index)
    empty = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return joined.select(index, F.coalesce(chunk, "__last").alias(chunk), "line_idx", empty("jp"), empty("tw"), empty("translation"))


def align_slices(chunks: DataFrame, tw: DataFrame, index: str, chunk: str, jp: str, tw_text: str) -> DataFrame:
    """(index, chunk, jp, tw): each chunk takes as many tw lines as it has newlines, and one; the last takes the rest too."""
    w = Window.partitionBy(index).orderBy(chunk)
    n = F.length(jp) - F.length(F.replace(F.col(jp), F.lit("\n"), F.lit(""))) + 1
    last = F.max(chunk).over(Window.partitionBy(index))
    cut = chunks.withColumn("__n", n).withColumn("__first", F.sum("__n").over(w) - F.col("__n")).withColumn("__is_last", F.col(chunk) == last)
    joined = cut.join(tw.select(index, F.split(tw_text, "\n", -1).alias("__tw")), index)
    left = F.greatest(F.size("__tw") - F.col("__first"), F.lit(0))
    take = F.when(F.col("__is_last"), left).otherwise(F.least(F.col("__n"), left)).cast("int")
    part = F.array_join(F.slice("__tw", (F.col("__first") + 1).cast("int"), take), "\n")
    return joined.select(index, chunk, F.col(jp).alias("jp"), part.alias("tw"))


def _newlines(c: str) -> Column:
    return F.length(c) - F.length(F.replace(F.col(c), F.lit("\n"), F.lit("")))


def count_alignment(aligned: DataFrame, index: str, chunk: str, strict: bool = False) -> DataFrame:
    """Adds jp_tw_count_alignment to align_slices' rows: whether the last chunk (strict: every chunk) has as many newlines on both sides."""
    same = _newlines("jp") == _newlines("tw")
    whole = Window.partitionBy(index)
    flag = F.every(same).over(whole) if strict else F.max_by(same, F.col(chunk)).over(whole)
    return aligned.withColumn("jp_tw_count_alignment", flag)


def mismatch_report(df: DataFrame, group: str, jp: str, translation: str) -> DataFrame:
    """Per group: mismatched rows, those of them whose source ends in a newline, and rows."""
    differs = line_count_differs(F.col(jp), F.col(translation))
    ends = F.endswith(jp, F.lit("\n"))
    return df.groupBy(group).agg(
        F.count_if(differs).alias("n_mismatch"), F.count_if(differs & ends).alias("n_mismatch_newline"), F.count("*").alias("n_rows")
    )


def file_status(df: DataFrame, file: str, passed: Column) -> DataFrame:
    """Per file: its name, with not_pass_ before it if any row fails."""
    ok = F.every(F.coalesce(passed, F.lit(False)))
    return df.groupBy(file).agg(ok.alias("passed")).select(file, "passed", F.when(F.col("passed"), F.col(file)).otherwise(F.concat(F.lit("not_pass_"), file)).alias("out_name"))
