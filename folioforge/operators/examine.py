"""Rules over pairs of lines and their similarities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioforge.functions.text import contains_any


# Words that make a translated line suspicious alone, and those that do so together.
FIRST_WORDS = ["※", "*", "【", "】"]
TOP_WORDS = [":", "："]
SECOND_WORDS = [
    "㊟", "注", "编", "原", "译", "这句", "这条", "这行", "这段", "这边", "这个", "这里", "此处", "日文", "ps", "PS", "Ps", "pS", "(", "（", ")", "）",
]


def examine(jp: Column, tw: Column, translation: Column, sim_jp: Column, sim_tr: Column, first: list[str] = FIRST_WORDS, top: list[str] = TOP_WORDS, second: list[str] = SECOND_WORDS) -> Column:
    """The first rule that holds: suspicious words, different last characters with a weak similarity, a weak similarity."""
    last = lambda c: F.right(c, F.lit(1))
    words = contains_any(tw, first) | (contains_any(tw, top) & contains_any(tw, second))
    ends = ((last(jp) != last(tw)) | (last(translation) != last(tw))) & ((sim_jp > 0.05) | (sim_tr < 0.95))
    return F.when(words, "True_匹配").when(ends, "True_尾字不同").when((sim_jp > 0.15) | (sim_tr < 0.75), "True_小於").otherwise("False")
