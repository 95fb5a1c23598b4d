"""Operator 4: URL filters with gradient-boosted trees on lexical features.

A table of rules by host and path comes first, the longest fitting rule wins.
URLs that no rule fits are judged by boosted trees over lexical features
(lengths, depth, digit ratio, entropy, parameter counts, suffix statistics),
trained from all distinct labelled URLs: by default those that a rule judges. Up
to HELD of them are fitted on the driver, more by passes over the executors that
bring it only sums; the trees are the same.

Suffix statistics are counted over all distinct URLs: how many there are of a
suffix, with a label or without, and which share of the labelled ones is blocked.
They are joined to the rows, so that there may be any number of suffixes. A URL
that is fitted has its suffix's numbers without those of its own fold of hosts,
so that the trees don't learn to read their own labels back. What the rules test
is no feature by itself: neither hosts nor beginnings of paths.

The trees block where they have shown that they know: trees fitted without a fold
of hosts score its URLs, and the threshold is the lowest score, in STEPS, from which on
PRECISION of those that are scored so are labelled as blocked. Where there is no
such score, URLs without a rule are allowed.

Edge cases: a null URL and one without `://` have empty host and path and fit no
rule; without labelled URLs, or with allowed ones only, the model allows all, and
with blocked ones only it blocks all; repeated rows give repeated
rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.boosting import BoostedTrees, HeldRows, grow
from folioforge.llm.common import discard, map_rows, stage
from folioforge.llm.spread import SpreadRows

#: Verdict by rule, a rule being host/path.
RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
#: Labelled URLs that are fitted on the driver, at most; this changes no result.
HELD = 4_096
#: How many URLs the overall share of blocked ones is worth in that of a suffix.
PRIOR = 4.0
#: Parts that hosts fall into by hash, for statistics without one's own.
FOLDS = 5
#: Share of rightly blocked URLs, among those of hosts that were not fitted, from which the trees may block.
PRECISION = 0.9
#: Numbers that are counted by suffix.
COUNTS = ("seen", "known", "bad")
#: Steps of a score in which the threshold is looked for.
STEPS = 1 << 16

FEATURES = (
    "url_length", "host_length", "path_length", "query_length", "depth", "labels", "digit_ratio", "hyphens", "entropy", "parameters", "has_fragment",
    "https", "dots_in_path", "longest_part", "host_digit_ratio", "vowel_ratio", "suffix_block", "suffix_seen",
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url):
    """(host, path) Columns of a URL Column: from the first :// to /, ?, # or end; from there to ?, # or end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER), F.coalesce(path, F.lit(""))


def rule_for(host, path, rules: dict[str, str]):
    """The longest rule whose host is the URL's or a parent of it and whose path begins the URL's; else null."""
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        own_host, slash, tail = rule.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(slash + tail)
        out = F.when(fits, rule) if out is None else out.when(fits, rule)
    return out if out is not None else F.lit(None).cast("string")


def suffix_of(host):
    """What stands behind the last dot of a host."""
    return F.substring_index(host, ".", -1)


def _parts(url: str) -> tuple[str, str, str]:
    rest = url.partition("://")[2]
    m = re.match(r"([^/?#]*)([^?#]*)(.*)", rest, re.S)
    return m[1].lower(), m[2], m[3]


def lexical(url: str) -> list[float]:
    """FEATURES of one URL but for the last two."""
    host, path, tail = _parts(url)
    query = tail.partition("#")[0]
    n = max(1, len(url))
    share = np.array(list(Counter(url).values())) / n
    return [
        len(url), len(host), len(path), len(query), path.count("/"), host.count(".") + 1, sum(c.isdigit() for c in url) / n, url.count("-"),
        -float((share * np.log2(share)).sum()), query.count("=") + query.count("&"), float("#" in tail), float(url.startswith("https")), path.count("."),
        max(map(len, re.split(r"[./\-_?&=#]", host + path))), sum(c.isdigit() for c in host) / max(1, len(host)), sum(c in "aeiou" for c in host) / max(1, len(host)),
    ]


def feature_matrix(urls: list[str], seen: np.ndarray, blocked: np.ndarray, rate: float, known: np.ndarray | None = None) -> np.ndarray:
    """FEATURES of URLs, given how many others of their suffix there are, how many of those are blocked and how many have a label (all, if not given)."""
    own = np.array([lexical(u) for u in urls], float).reshape(len(urls), len(FEATURES) - 2)
    return np.column_stack([own, (blocked + PRIOR * rate) / ((seen if known is None else known) + PRIOR), np.log1p(seen)])


def _host_keys(rows: DataFrame) -> DataFrame:
    """rows (url, ...) with the suffix of the host and the fold that it falls into."""
    host = split_url(F.col("url"))[0]
    return rows.withColumns({"suffix": suffix_of(host), "fold": F.pmod(F.xxhash64(host), F.lit(FOLDS)).cast("int")})


def suffix_statistics(labelled: DataFrame) -> DataFrame:
    """(suffix, fold, seen, known, bad) over the distinct URLs of (url, blocked): all, those with a label, those that are blocked."""
    once = labelled.filter("url IS NOT NULL").groupBy("url").agg(F.max("blocked").alias("blocked"))
    bad = F.coalesce(F.sum(F.col("blocked").cast("long")), F.lit(0))
    return _host_keys(once).groupBy("suffix", "fold").agg(F.count("*").alias("seen"), F.count("blocked").alias("known"), bad.alias("bad"))


def _suffix_sums(statistics: DataFrame) -> DataFrame:
    """(suffix, seen, known, bad) of all folds."""
    return statistics.groupBy("suffix").agg(*(F.sum(c).alias(c) for c in COUNTS))


def labelled_rows(labelled: DataFrame, statistics: DataFrame, rate: float) -> DataFrame:
    """(x, y, fold) of each distinct labelled (url, blocked): FEATURES as bytes, with the suffix's numbers in the other folds."""
    rows = _host_keys(labelled.filter("url IS NOT NULL AND blocked IS NOT NULL").select("url", "blocked").distinct())
    own, all_ = statistics.alias("own"), _suffix_sums(statistics).alias("all")
    others = own.join(all_, "suffix").select("suffix", "fold", *((F.col(f"all.{c}") - F.col(f"own.{c}")).alias(c) for c in COUNTS))

    def run(batches):
        for batch in batches:
            seen, known, bad = (batch.column(i).to_numpy().astype(float) for i in (3, 4, 5))
            x = feature_matrix(batch.column(0).to_pylist(), seen, bad, rate, known)
            yield {"x": [row.tobytes() for row in x], "y": batch.column(1), "fold": batch.column(2)}

    return map_rows(rows.join(others, ["suffix", "fold"]).select("url", "blocked", "fold", *COUNTS), run, "x binary, y boolean, fold int")


def fit_urls(labelled: DataFrame, statistics: DataFrame) -> tuple[float, BoostedTrees, float]:
    """(share of blocked URLs, trees, score from which they block) from all labelled (url, blocked)."""
    sums = statistics.agg(F.sum("known").alias("known"), F.sum("bad").alias("bad")).first()
    rate = ((sums.bad or 0) + 1) / ((sums.known or 0) + 2)
    table = stage(labelled_rows(labelled, statistics, rate), "url-features")
    rows = SpreadRows(table, len(FEATURES), FOLDS)
    if rows.counts[0][0] <= HELD:
        got = table.toPandas()
        x = np.frombuffer(b"".join(got["x"])).reshape(len(got), len(FEATURES))
        rows = HeldRows(x, got["y"].to_numpy(float), got["fold"].to_numpy(int))
    trees = grow(rows)[0]
    threshold = lowest_score(rows.score_counts(STEPS))
    if isinstance(rows, SpreadRows):
        rows.close()
    discard(table)
    return rate, trees, threshold


def block_threshold(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> float:
    """The lowest score of one half or more, by trees of the other folds, from which on PRECISION of the rows are blocked; infinite if there is none."""
    rows = HeldRows(x, y, fold)
    grow(rows)
    return lowest_score(rows.score_counts(STEPS))


def lowest_score(counts: np.ndarray) -> float:
    """The same from the numbers of rows and of blocked ones with each score, in steps."""
    n, bad = counts[::-1].cumsum(axis=0).T  # from each score on, the highest first
    good = np.flatnonzero((counts[::-1, 0] > 0) & (bad >= PRECISION * n))
    return max(0.5, (len(n) - 1 - good[-1]) / (len(n) - 1)) if len(good) else np.inf


def filter_urls(df: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: dict[str, str] | None = None, labelled: DataFrame | None = None) -> DataFrame:
    """One row per row of df: id, host, path, rule, block_score of the model and verdict."""
    rules = RULES if rules is None else rules
    url = F.col(url_col).cast("string")
    host, path = split_url(url)
    parts = df.select(id_col, url.alias("url"), host.alias("host"), path.alias("path")).withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("boolean")
    if rules:
        by_rule = F.col("rule").isin([r for r, v in rules.items() if v == "block"])
    if labelled is None:
        labelled = parts.select("url", by_rule.alias("blocked"))
    statistics = stage(suffix_statistics(labelled), "url-suffixes")
    model = df.sparkSession.sparkContext.broadcast(fit_urls(labelled, statistics))
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        rate, trees, threshold = model.value
        for batch in batches:
            urls = [u or "" for u in batch.column(1).to_pylist()]
            seen, known, bad = (np.array(batch.column(i).to_pylist(), float) for i in (5, 6, 7))
            score = trees.predict(feature_matrix(urls, seen, bad, rate, known))
            yield {id_col: batch.column(0), "host": batch.column(2), "path": batch.column(3), "rule": batch.column(4), "block_score": score, "bad": score >= threshold}

    counted = parts.withColumn("suffix", suffix_of(F.col("host"))).join(_suffix_sums(statistics), "suffix", "left")
    rows = counted.select(id_col, "url", "host", "path", "rule", *(F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS))
    scored = map_rows(rows, run, f"`{id_col}` {kind}, host string, path string, rule string, block_score double, bad boolean")
    return scored.withColumn("verdict", F.when(F.coalesce(by_rule, F.col("bad")), "block").otherwise("allow")).drop("bad")
