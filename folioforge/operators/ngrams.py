"""A bigram model of a corpus, counted and applied by joins.

Tokens are those of the built-in tokenizer. A sentence's first token follows the
last one of the sentences before it, or the start of its chapter. A pair has the
probability (c(h, w) + MASS * p(w)) / (c(h) + MASS) with p(w) = (c(w) + 1) / (N + V + 1).

Sentences are dealt to blocks of some million tokens. A block's pairs are counted
where it lies, and only its distinct ones are shuffled, to be summed and to come
back with their probabilities; places of pairs never are.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.vectors import perplexity
from folioforge.sources.files import stored

#: Weight of the unigrams in a pair's probability, in pairs.
MASS = 16.0
TOKEN = r"[A-Za-z0-9]+|[^A-Za-z0-9 \t\n\r\f]"
#: Tokens of a block at most, and those from which there is one for every shuffle partition; a task holds the probabilities
#: of a block's distinct pairs, 16 bytes each. The larger blocks are, the fewer pairs are in several.
BLOCK_TOKENS, LEAST_TOKENS = 16 << 20, 1 << 20


class BigramModel(NamedTuple):
    """pairs (h, w, c), heads (h, ch) and words (w, cw), stored, with the number of tokens and of distinct ones; h is empty at a start."""

    pairs: DataFrame
    heads: DataFrame
    words: DataFrame
    n_tokens: int
    n_words: int


def _tokens(text: str) -> Column:
    return F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(TOKEN), F.lit(0))


def sentence_tokens(df: DataFrame, keys: list[str], pos: str, text: str) -> DataFrame:
    """(keys, pos, t, first): each sentence's tokens and the one before them, empty at a start; stored, for counting and scoring."""
    before = Window.partitionBy(*keys).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.select(*keys, pos, text).repartition(*keys).select(*keys, pos, _tokens(text).alias("t")).withColumn("last", F.try_element_at("t", F.lit(-1)))
    return stored(rows.select(*keys, pos, "t", F.coalesce(F.last("last", ignorenulls=True).over(before), F.lit("")).alias("first")))


def token_pairs(tokens: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """(keys, pos, h, w): the pairs of tokens in the sentences, a row for each place."""
    heads = F.concat(F.array("first"), F.slice("t", 1, F.greatest(F.size("t") - 1, F.lit(0))))
    return tokens.filter(F.size("t") > 0).select(*keys, pos, F.explode(F.arrays_zip(heads.alias("h"), F.col("t").alias("w"))).alias("p")).select(*keys, pos, "p.h", "p.w")


def block_pairs(tokens: DataFrame, keys: list[str], pos: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(h, w, c, blocks): distinct pairs with their number and the blocks of tokens that hold them; stored."""
    dealt = _dealt(tokens, keys, pos, block_tokens).repartition("__block").withColumn("t", _apart("joined"))
    places = token_pairs(dealt, ["__block", *keys], pos)
    counted = places.groupBy("__block", "h", "w").agg(F.count("*").alias("c"))
    return stored(counted.groupBy("h", "w").agg(F.sum("c").alias("c"), F.collect_list("__block").alias("blocks")))


def _dealt(tokens: DataFrame, keys: list[str], pos: str, block_tokens: int) -> DataFrame:
    """(keys, pos, joined, first, __block): sentences with the block that each belongs to. Tokens have no blanks and are
    joined by them, in a third of the bytes that an array takes in a shuffle."""
    n = tokens.agg(F.coalesce(F.sum(F.size("t").cast("long")), F.lit(0))).first()[0]
    parts = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(-(-n // block_tokens), min(-(-n // LEAST_TOKENS), parts), 1)
    block = F.pmod(F.xxhash64(*keys, pos), F.lit(blocks)).cast("int")
    return tokens.select(*keys, pos, F.array_join("t", " ").alias("joined"), "first", block.alias("__block"))


def _apart(joined: str) -> Column:
    return F.when(F.col(joined) != "", F.split(joined, " ", -1)).otherwise(F.array().cast("array<string>"))


def train(df: DataFrame, keys: list[str], pos: str, text: str, tokens: DataFrame | None = None, counted: DataFrame | None = None) -> BigramModel:
    """The model of df's sentences; tokens are their sentence_tokens, counted the block_pairs of those, if they are there already."""
    tokens = sentence_tokens(df, keys, pos, text) if tokens is None else tokens
    pairs = block_pairs(tokens, keys, pos) if counted is None else counted
    words = stored(pairs.groupBy("w").agg(F.sum("c").alias("cw")))
    n_tokens, n_words = words.agg(F.coalesce(F.sum("cw"), F.lit(0)), F.count("*")).first()
    return BigramModel(pairs.select("h", "w", "c"), stored(pairs.groupBy("h").agg(F.sum("c").alias("ch"))), words, n_tokens, n_words)


def log_probabilities(model: BigramModel, pairs: DataFrame, counted: bool = False) -> DataFrame:
    """(pairs' columns, lnp) for distinct pairs (h, w), seen in training or not; counted says that they have the model's own c."""
    known = pairs if counted else pairs.join(model.pairs, ["h", "w"], "left")
    known = known.join(model.words, "w", "left").join(model.heads, "h", "left")
    count = lambda c: F.coalesce(F.col(c), F.lit(0))
    unigram = (count("cw") + 1) / F.lit(float(model.n_tokens + model.n_words + 1))
    return known.select(*pairs.columns, F.log((count("c") + MASS * unigram) / (count("ch") + MASS)).alias("lnp"))


def _pair_hashes() -> Column:
    """The hashes of a sentence's pairs."""
    heads = F.concat(F.array("first"), F.slice("t", 1, F.greatest(F.size("t") - 1, F.lit(0))))
    return F.when(F.size("t") > 0, F.zip_with(heads, "t", lambda h, w: F.xxhash64(h, w))).otherwise(F.array().cast("array<long>"))


def score_sentences(
    df: DataFrame, model: BigramModel, keys: list[str], pos: str, text: str, tokens: DataFrame | None = None, counted: DataFrame | None = None, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """(keys, pos, n_tokens, loss, perplexity): each sentence's mean negative log-probability; NaN where it has no tokens.

    tokens are df's sentence_tokens, if they are there already, and counted their
    block_pairs, of the same block_tokens, if it is they that the model was trained on. A block's task holds the
    probabilities of the pairs in it, found by 64-bit hashes of those, while its
    sentences pass in batches.
    """
    own = sentence_tokens(df, keys, pos, text) if tokens is None else tokens
    asked = block_pairs(own, keys, pos, block_tokens).drop("c") if counted is None else counted
    answers = log_probabilities(model, asked, counted is not None).select(F.explode("blocks").alias("__block"), F.xxhash64("h", "w").alias("hash"), "lnp")
    rows = _dealt(own, keys, pos, block_tokens).withColumn("is_row", F.lit(True))
    met = answers.withColumn("is_row", F.lit(False)).unionByName(rows, allowMissingColumns=True).repartition("__block").sortWithinPartitions("__block", "is_row")
    places = [F.col(c) for c in (*keys, pos)]
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in (*keys, pos))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, known, lnp = None, [], None, None
        for batch in batches:
            of, is_row = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            ends = np.flatnonzero(np.diff(of) | np.diff(is_row.astype(np.int8))) + 1
            for lo, hi in zip([0, *ends], [*ends, len(of)] if len(of) else []):
                part = batch.slice(lo, hi - lo)
                if of[lo] != block:
                    block, parts, known = of[lo], [], None
                if not is_row[lo]:
                    parts.append((part.column(3).flatten().to_numpy(), part.column(2).to_numpy()))
                    continue
                if known is None:
                    known, lnp = (np.concatenate([p[k] for p in parts] or [np.zeros(0, t)]) for k, t in ((0, np.int64), (1, np.float64)))
                    order, parts = np.argsort(known), []
                    known, lnp = known[order], lnp[order]
                n = part.column(3).value_lengths().to_numpy()
                found = lnp[np.searchsorted(known, part.column(3).flatten().to_numpy())]
                loss = np.full(len(n), np.nan)
                starts = np.cumsum(n) - n
                if len(found):
                    loss[n > 0] = -np.add.reduceat(found, starts[n > 0]) / n[n > 0]
                yield pa.RecordBatch.from_arrays([*part.columns[4:], pa.array(n, pa.int64()), pa.array(loss)], names=[*keys, pos, "n_tokens", "loss"])

    apart = met.withColumn("t", F.when(F.col("is_row"), _apart("joined")))
    # an answer's hash is a list of one: for lists that are null Spark's Arrow writer takes time in the square of a batch's rows
    hashes = F.when(F.col("is_row"), _pair_hashes()).otherwise(F.array("hash"))
    scored = apart.select("__block", "is_row", "lnp", hashes.alias("hashes"), *places)
    out = scored.mapInArrow(run, f"{kinds}, n_tokens long, loss double")
    return out.select(*keys, pos, "n_tokens", "loss", perplexity(F.col("loss")).alias("perplexity"))
