"""Pluggable model steps with deterministic offline defaults.

Anything with the methods below can stand in: a tokenizer counts and cuts, an
embedder maps texts to vectors, a scorer gives the loss of a text in its
context, a generator answers prompts. They run in iterator pandas UDFs, so a
model is set up once for each worker and sees whole batches.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple, Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import token_count


class Tokenizer(Protocol):
    def tokens(self, text: str) -> list[str]: ...


class Embedder(Protocol):
    def embed(self, texts: list[str]) -> np.ndarray: ...


class Scorer(Protocol):
    def loss(self, context: str, text: str) -> float: ...


class Generator(Protocol):
    def generate(self, prompts: list[str]) -> list[str]: ...


class BatchGenerator(Protocol):
    """Works on several requests at once and gives answers in any order."""

    def submit(self, request: int, prompt: str) -> None: ...
    def step(self) -> list[tuple[int, str]]: ...


class Batching(NamedTuple):
    """What a model takes at once: texts, and tokens when all are as long as the longest."""

    sequences: int = 32
    tokens: int = 32 * 514


class RegexTokenizer:
    """Runs of ASCII letters and digits, and every other character that is not white space; what is between stays with the next."""

    pattern = re.compile(r"[ \t\n\r\f]*(?:[A-Za-z0-9]+|[^A-Za-z0-9 \t\n\r\f])|[ \t\n\r\f]+\Z")

    def tokens(self, text: str) -> list[str]:
        return self.pattern.findall(text)


class HashedEmbedder:
    """Signed hashed character bigrams; equal texts have equal vectors of length 1, the empty text the zero vector."""

    def __init__(self, size: int = 64):
        self.size = size

    def _counts(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        h = (codes[:-1] << np.uint64(32) | codes[1:]) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return np.bincount((h >> np.uint64(32)) % np.uint64(self.size), np.where(h >> np.uint64(63), 1.0, -1.0), self.size)

    def extend(self, text: str, state: tuple[np.ndarray, str] | None = None) -> tuple[np.ndarray, str]:
        """The state of a text after another has been added at its end: bigram counts and the last character."""
        counts, last = state or (np.zeros(self.size), "")
        return counts + self._counts(last + text), (last + text)[-1:]

    def vector(self, state: tuple[np.ndarray, str]) -> np.ndarray:
        """What embed gives for the text of a state."""
        out = state[0] + self._counts(state[1] + "\n")
        norm = np.linalg.norm(out)
        return out / norm if norm > 0 else out

    def embed(self, texts: list[str]) -> np.ndarray:
        return np.array([self.vector(self.extend(t)) for t in texts]).reshape(len(texts), self.size)


class CharacterScorer:
    """Mean negative log-probability of a text's characters under add-one unigrams of its context and itself."""

    def loss(self, context: str, text: str) -> float:
        if not text:
            return math.nan
        seen = Counter(context)
        total, kinds = len(context), len(set(context) | set(text))
        return float(-np.mean([math.log((seen[c] + 1) / (total + kinds)) for c in text]))


class WindowScorer:
    """Losses of sentences one after another, under add-one unigrams of the tokens before each and its own.

    The window holds a sentence and what is before it; counts are added and
    taken away as it moves, so the work is in proportion to the tokens.
    """

    def __init__(self, window: int = 4096):
        self.window, self.tokens, self.seen = window, deque(), Counter()

    def loss(self, tokens: list[str]) -> float:
        """The loss of the next sentence; NaN if it has no tokens."""
        while self.tokens and len(self.tokens) + len(tokens) > self.window:
            old = self.tokens.popleft()
            self.seen[old] -= 1
            if not self.seen[old]:
                del self.seen[old]
        own = Counter(tokens)
        total = len(self.tokens) + len(self.seen) + sum(t not in self.seen for t in own)
        loss = -sum(n * math.log((self.seen[t] + 1) / total) for t, n in own.items()) / len(tokens) if tokens else math.nan
        self.tokens.extend(tokens)
        self.seen.update(own)
        return loss


class EchoGenerator:
    """Answers a prompt with its last line."""

    def generate(self, prompts: list[str]) -> list[str]:
        return [p.rsplit("\n", 1)[-1] for p in prompts]


def embed_column(text: Column, embedder: Embedder) -> Column:
    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(list(embedder.embed(texts.fillna("").tolist())), index=texts.index)

    return run(text)


def generate_column(prompt: Column, generator: Generator) -> Column:
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for prompts in batches:
            yield pd.Series(generator.generate(prompts.fillna("").tolist()), index=prompts.index)

    return run(prompt)


class SteppedEcho:
    """Answers with a prompt's last line, longer prompts later than shorter ones that came after them."""

    def __init__(self):
        self.left: dict[int, list] = {}

    def submit(self, request: int, prompt: str) -> None:
        self.left[request] = [1 + len(prompt) % 7, prompt.rsplit("\n", 1)[-1]]

    def step(self) -> list[tuple[int, str]]:
        for waiting in self.left.values():
            waiting[0] -= 1
        return [(r, self.left.pop(r)[1]) for r in [r for r, (n, _) in self.left.items() if n <= 0]]


def packed(texts: Iterable[tuple[int, object]], batching: Batching) -> Iterator[list]:
    """Items of (tokens, item), shortest first, in batches that the model takes; one too long for it is alone."""
    batch: list = []
    for n, item in texts:
        if batch and (len(batch) == batching.sequences or (len(batch) + 1) * n > batching.tokens):
            yield batch
            batch = []
        batch.append(item)
    if batch:
        yield batch


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def embed_texts(df: DataFrame, text: str, embedder: Embedder, batching: Batching = Batching()) -> DataFrame:
    """(key, vector): every distinct text of a column once, key being its text_key; null is the empty text.

    Texts are dealt by their keys and sorted by length within a task, so a batch
    holds texts of about the same length.
    """
    texts = df.select(text_key(F.col(text)).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).dropDuplicates(["key"])
    sized = texts.withColumn("n", token_count(F.col("text"))).sortWithinPartitions("n", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a batch stays in Arrow; only the texts that the model is about to take are Python objects
        parts = (b.slice(i, batching.sequences) for b in batches for i in range(0, b.num_rows, batching.sequences))
        rows = ((n, (k, t)) for part in parts for k, t, n in zip(*(c.to_pylist() for c in part.columns)))
        for batch in packed(rows, batching):
            vectors = [v.tolist() for v in embedder.embed([t for _, t in batch])]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in batch], pa.string()), pa.array(vectors, pa.list_(pa.float64()))], names=["key", "vector"])

    return sized.select("key", "text", "n").mapInArrow(run, "key string, vector array<double>")


def embed_distinct(df: DataFrame, texts: list[str], embedder: Embedder, batching: Batching = Batching()) -> dict[str, DataFrame]:
    """For each column of texts, (text, vector) with every distinct text embedded once, in batches."""
    out = {}
    for t in texts:
        own = df.select(F.col(t).alias("text")).distinct()
        out[t] = own.withColumn("key", text_key(F.col("text"))).join(embed_texts(own, "text", embedder, batching), "key").drop("key")
    return out


def continuous(requests: Iterator[tuple[int, str, int]], generator: BatchGenerator, sequences: int, tokens: int) -> Iterator[tuple[int, str]]:
    """Answers of (request, prompt, tokens) as they come. A request is handed in as soon as those at work leave room for it;
    one that needs more than all the tokens works alone."""
    running: dict[int, int] = {}
    used, ahead = 0, next(requests, None)
    while running or ahead:
        while ahead and len(running) < sequences and (used + ahead[2] <= tokens or not running):
            generator.submit(ahead[0], ahead[1])
            running[ahead[0]] = ahead[2]
            used, ahead = used + ahead[2], next(requests, None)
        for request, answer in generator.step():
            used -= running.pop(request)
            yield request, answer


def answer_requests(df: DataFrame, ids: list[str], prompt: Column, generator: Callable[[], BatchGenerator], out: str = "response", sequences: int = 96, tokens: int = 81_920, answer_tokens: int = 2048) -> DataFrame:
    """(ids, response) in whatever order the generator finishes; the ids, of any types, say to whom an answer goes.

    Each task keeps a generator of its own busy with `sequences` requests and
    `tokens` tokens at most, answer_tokens of which each request may add.
    """
    kinds = ", ".join(f"`{i}` {df.schema[i].dataType.simpleString()}" for i in ids)
    text = F.coalesce(prompt, F.lit(""))
    asked = df.select(*ids, text.alias("__prompt"), (token_count(text) + answer_tokens).alias("__tokens"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[int, tuple] = {}

        def requests():
            number = 0
            for batch in batches:
                for row in batch.itertuples(index=False, name=None):
                    waiting[number] = row[:-2]
                    yield number, row[-2], row[-1]
                    number += 1

        done: list[tuple] = []
        for request, answer in continuous(requests(), generator(), sequences, tokens):
            done.append((*waiting.pop(request), answer))
            if len(done) == 1000:
                yield pd.DataFrame(done, columns=[*ids, out])
                done = []
        yield pd.DataFrame(done, columns=[*ids, out])

    return asked.mapInPandas(run, f"{kinds}, `{out}` string")


def route(df: DataFrame, answers: DataFrame, ids: list[str]) -> DataFrame:
    """df with the answers joined to the rows whose ids, distinct ones, they carry."""
    return df.join(answers, ids, "left")


def answer(df: DataFrame, prompt: Column, generator: Generator, out: str = "response") -> DataFrame:
    """Adds the generator's answers; the row carries its keys, so nothing has to be routed back."""
    return df.withColumn(out, generate_column(prompt, generator))


def regenerate(df: DataFrame, needed: Column, prompt: Column, generator: Generator, out: str) -> DataFrame:
    """Replaces `out` with new answers in the rows that need it; only those rows reach the generator."""
    flagged = df.withColumn("__needed", F.coalesce(needed, F.lit(False)))
    again = flagged.filter("__needed").withColumn(out, generate_column(prompt, generator))
    return flagged.filter(~F.col("__needed")).unionByName(again).drop("__needed")
