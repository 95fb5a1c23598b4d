"""Chunking of scored sentences: the sequential algorithms, one group of rows to a chapter.

The plain functions state the algorithms; the operators run them over the gathered
sentences of a (file, chapter) in order, so one shuffle serves a chain of
them and a chapter is what a task holds.
"""

from __future__ import annotations

import functools
import heapq
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from folioforge.operators.models import Batching, CharacterScorer, Embedder, HashedEmbedder, RegexTokenizer, Scorer, WindowScorer, packed

# Budgets in characters, tokens and, for score-driven chunks, characters again.
MAX_CHARS, MAX_TOKENS, MAX_SCORED = 1280, 896, 768
THRESHOLD, DECAY = 2.0, 0.99
DELIMITERS = "\n」』）)。.！!？?；;，,：:、"


def bisect(sentences: list[str], values: list[float], sizes: list[int], budget: int, window: int = 3) -> list[list[int]]:
    """Chunks as lists of sentence numbers, each within the budget unless it is one sentence.

    A chunk over it is cut before the smallest mean of `window` values from there
    on, of equals the first; means end with the chunk. The cut is never before
    the first sentence.
    """
    n, v = len(sentences), np.asarray(values, float)
    ends = np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64))])

    def mean(i: int, to: int) -> float:
        return float(np.add.reduce(v[i:to])) / (to - i)

    inner = max(n - window + 1, 0)
    means = sum((v[k : k + inner] for k in range(1, window)), v[:inner].copy()) / window
    out, todo = [], [(0, n)]
    while todo:
        lo, hi = todo.pop()
        if ends[hi] - ends[lo] <= budget or hi - lo < 2:
            out.append(list(range(lo, hi)))
            continue
        tail = max(lo + 1, hi - window + 1)
        best = [(mean(i, hi), i) for i in range(tail, hi)]
        if tail > lo + 1:
            i = lo + 1 + int(means[lo + 1 : tail].argmin())
            best.append((float(means[i]), i))
        cut = min(best)[1]
        todo += [(cut, hi), (lo, cut)]
    return out


def merge_small(chunks: list[str], sizes: list[int], budget: int, similarity: Callable[[str, str], float], only_if_both: bool = False) -> list[str]:
    """Joins the smallest chunk that can be joined with a neighbour until none can.

    Ends have one neighbour. Inside, the more similar one is taken, the next of
    equals; if it does not fit, the next larger chunk has its turn. With
    only_if_both similarity decides only where both fit, else whichever fits.
    """
    chunks, sizes = list(chunks), list(sizes)
    last = len(chunks) - 1
    before, after = [i - 1 for i in range(last + 1)], [i + 1 for i in range(last + 1)]  # neighbours, -1 and last + 1 beyond the ends
    gone = [False] * (last + 1)

    def fits(left: int) -> bool:
        return sizes[left] + sizes[after[left]] <= budget

    def partner(i: int) -> int | None:
        """The left one of the pair to join."""
        if before[i] < 0:
            return i if after[i] <= last and fits(i) else None
        if after[i] > last:
            return before[i] if fits(before[i]) else None
        if only_if_both and not (fits(i) and fits(before[i])):
            return i if fits(i) else before[i] if fits(before[i]) else None
        left = before[i] if similarity(chunks[i], chunks[before[i]]) > similarity(chunks[i], chunks[after[i]]) else i
        return left if fits(left) else None

    # a chunk that finds no partner has to be asked again only when a neighbour has changed
    waiting = [(size, i) for i, size in enumerate(sizes)]
    heapq.heapify(waiting)
    while waiting:
        size, i = heapq.heappop(waiting)
        if gone[i] or size != sizes[i] or (left := partner(i)) is None:
            continue
        right = after[left]
        chunks[left] += chunks[right]
        sizes[left] += sizes[right]
        gone[right], after[left] = True, after[right]
        if after[left] <= last:
            before[after[left]] = left
        for k in (before[left], left, after[left]):
            if 0 <= k <= last:
                heapq.heappush(waiting, (sizes[k], k))
    return [c for c, g in zip(chunks, gone) if not g]


def semantic_fold(lines: list[str], similarity: Callable[[str, str], float], threshold: float = 0.4) -> list[str]:
    """Lines joined to the running chunk while they are similar enough to it, to twelve places."""
    out: list[str] = []
    for line in lines:
        if out and round(similarity(out[-1], line), 12) >= threshold:
            out[-1] += line
        else:
            out.append(line)
    return out


def embedded_fold(lines: list[str], embedder: Embedder, threshold: float = 0.4) -> list[str]:
    """semantic_fold by an embedder's cosine. One that can extend a text's vector never reads the running chunk again."""
    if not hasattr(embedder, "extend"):
        return semantic_fold(lines, similarity_of(embedder), threshold)
    out: list[list[str]] = []
    state = None
    for line in lines:
        if out and round(cosine(embedder.vector(state), embedder.embed([line])[0]), 12) >= threshold:
            out[-1].append(line)
            state = embedder.extend(line, state)
        else:
            out.append([line])
            state = embedder.extend(line)
    return ["".join(parts) for parts in out]


def threshold_chunks(sentences: list[str], losses: list[float], threshold: float = THRESHOLD, decay: float = DECAY, budget: int = MAX_SCORED) -> list[str]:
    """Cuts where a loss's share of the total is over the median share times the threshold; chunks over the budget are cut
    again under a threshold that decays, as long as they have two sentences."""
    if not sentences:
        return []
    total = sum(losses[1:]) or 1.0
    shares = [0.0, *(x / total for x in losses[1:])]
    median = float(np.median(shares[1:])) if len(shares) > 1 else 0.0

    def cut(chunk: list[int], t: float) -> list[list[int]]:
        parts = [[chunk[0]]]
        for i in chunk[1:]:
            if shares[i] > median * t:
                parts.append([])
            parts[-1].append(i)
        return parts

    chunks = cut(list(range(len(sentences))), threshold)
    big = lambda c: len(c) > 1 and sum(len(sentences[i]) for i in c) > budget
    while any(map(big, chunks)) and threshold > 1e-6:
        threshold *= decay
        chunks = [p for c in chunks for p in (cut(c, threshold) if big(c) else [c])]
    return ["".join(sentences[i] for i in c) for c in chunks]


def truncate_tokens(tokens: list[str], budget: int, reverse: bool = False, discard: bool = False) -> str:
    """The last (reverse: first) tokens within the budget, cut at the first delimiter from the outer side.

    With discard the delimiters at the cut go too. Without any delimiter the
    tokens stay as they are.
    """
    if budget <= 0:
        return ""
    kept = tokens[:budget] if reverse else tokens[-budget:]
    text = "".join(kept)
    if reverse:
        text = text[::-1]
    at = next((i for i, c in enumerate(text) if c in DELIMITERS), None)
    if at is not None:
        if discard:
            while at < len(text) and text[at] in DELIMITERS:
                at += 1
        text = text[at:]
    return text[::-1] if reverse else text


def full_context(sentences: list[str], at: int, tokens: list[list[str]], budget: int, ahead: bool = False) -> str:
    """Look-back (or look-ahead) context that fills its budget with a part of the sentence that no longer fits."""
    if ahead:
        out, used = sentences[at], len(tokens[at])
        for i in range(at + 1, len(sentences)):
            if used + len(tokens[i]) > budget:
                return out + truncate_tokens(tokens[i], budget - used, reverse=True)
            out, used = out + sentences[i], used + len(tokens[i])
        return out
    out, used = "", 0
    for i in range(at - 1, -1, -1):
        if used + len(tokens[i]) > budget:
            return truncate_tokens(tokens[i], budget - used, discard=True) + out
        out, used = sentences[i] + out, used + len(tokens[i])
    return out


def cosine(x: np.ndarray, y: np.ndarray) -> float:
    norm = np.linalg.norm(x) * np.linalg.norm(y)
    return float(x @ y / norm) if norm else 0.0


def similarity_of(embedder: Embedder, kept: int = 4096) -> Callable[[str, str], float]:
    """The cosine of two texts' vectors; the last ones used are kept."""

    @functools.lru_cache(kept)
    def vector(text: str) -> np.ndarray:
        return embedder.embed([text])[0]

    return lambda a, b: cosine(vector(a), vector(b))


#: Characters of finished rows that a task holds before it hands them on.
HANDED_ON = 1 << 20


def _grouped(df: DataFrame, keys: list[str], pos: str, columns: list[str], schema: str, rows: Callable[[dict[str, list]], dict], handed_on: int = HANDED_ON) -> DataFrame:
    """One row to a group in the shuffle, its sentences gathered and sorted there.

    Groups then pass one at a time: a batch stays in Arrow, only the group at work
    is made of Python objects, and its rows go on once they have handed_on
    characters. A worker so holds a batch, a group and that, however large the table.
    """
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    gathered = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(pos, *columns))).alias("__rows"))
    kind = _parse_datatype_string(f"{kinds}, {schema}")
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(len(keys))
            held: list[pa.RecordBatch] = []
            size = 0
            for i in range(batch.num_rows):
                group = own.slice(i, 1).flatten().flatten()
                out = rows({c: column.to_pylist() for c, column in zip((pos, *columns), group)})
                n = len(next(iter(out.values())))
                if not n:
                    continue
                again = pa.array(np.full(n, i))
                cells = [batch.column(k).take(again) for k in range(len(keys))]
                made = pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(cells, arrow)), *(pa.array(out[f.name], f.type) for f in list(arrow)[len(keys) :])], schema=arrow)
                held.append(made)
                size += made.nbytes
                if size >= handed_on:
                    yield from _whole(held)
                    held, size = [], 0
            yield from _whole(held)
        pa.default_memory_pool().release_unused()

    return gathered.mapInArrow(run, kind)


def _whole(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if batches:
        yield from pa.Table.from_batches(batches).combine_chunks().to_batches()


def _numbered(chunks: list[str]) -> dict:
    return {"chunk_idx": list(range(len(chunks))), "chunk": chunks}


CHUNKS = "chunk_idx int, chunk string"


def bisect_chunks(df: DataFrame, keys: list[str], pos: str, text: str, value: str, budget: int = MAX_CHARS, window: int = 3, by_tokens: bool = False) -> DataFrame:
    """Chunks of scored sentences within a budget of characters, or of tokens with the built-in tokenizer."""

    def rows(g):
        texts = g[text]
        sizes = [len(RegexTokenizer().tokens(t)) if by_tokens else len(t) for t in texts]
        return _numbered(["".join(texts[i] for i in c) for c in bisect(texts, g[value], sizes, budget, window)])

    return _grouped(df, keys, pos, [text, value], CHUNKS, rows)


def merge_small_chunks(df: DataFrame, keys: list[str], pos: str, text: str, budget: int = MAX_CHARS, embedder: Embedder | None = None, only_if_both: bool = False, by_tokens: bool = False) -> DataFrame:
    """Small sentences joined with neighbours within a budget, see merge_small; similarities are compared to twelve places."""
    embedder = embedder or HashedEmbedder()

    def rows(g):
        texts, same = g[text], similarity_of(embedder)
        sizes = [len(RegexTokenizer().tokens(t)) if by_tokens else len(t) for t in texts]
        return _numbered(merge_small(texts, sizes, budget, lambda a, b: round(same(a, b), 12), only_if_both))

    return _grouped(df, keys, pos, [text], CHUNKS, rows)


def semantic_chunks(df: DataFrame, keys: list[str], pos: str, text: str, threshold: float = 0.4, embedder: Embedder | None = None) -> DataFrame:
    embedder = embedder or HashedEmbedder()
    return _grouped(df, keys, pos, [text], CHUNKS, lambda g: _numbered(embedded_fold(g[text], embedder, threshold)))


def rechunk_decay(df: DataFrame, keys: list[str], pos: str, text: str, loss: str, threshold: float = THRESHOLD, decay: float = DECAY, budget: int = MAX_SCORED) -> DataFrame:
    return _grouped(df, keys, pos, [text, loss], CHUNKS, lambda g: _numbered(threshold_chunks(g[text], g[loss], threshold, decay, budget)))


def _contexts(texts: list[str], back: int, ahead: int | None, fill: bool) -> Iterator[tuple[str, str]]:
    """For each sentence but the first what is before it and what it is compared by, see similarity_distribution."""
    tokens = [RegexTokenizer().tokens(t) for t in texts]

    def whole(at, budget, step):
        i, used, out = at, 0, []
        while 0 <= i < len(texts) and (used + len(tokens[i]) <= budget or (step > 0 and i == at)):
            out.append(texts[i])
            used += len(tokens[i])
            i += step
        return "".join(out[::step])

    for i in range(1, len(texts)):
        before = full_context(texts, i, tokens, back) if fill else whole(i - 1, back, -1)
        yield before, texts[i] if ahead is None else full_context(texts, i, tokens, ahead, True) if fill else whole(i, ahead, 1)


def similarity_distribution(df: DataFrame, keys: list[str], pos: str, text: str, back: int = 2048, ahead: int | None = None, fill: bool = False, embedder: Embedder | None = None) -> DataFrame:
    """Each sentence's similarity to the context before it; the first has 1.

    back and ahead are token budgets; with ahead a sentence is compared with what
    follows it too. fill cuts the sentence that no longer fits instead of leaving
    it out. Texts are embedded where they are made, one by one; for models that
    want batches there is batched_similarity_distribution.
    """
    embedder = embedder or HashedEmbedder()

    def rows(g):
        same = similarity_of(embedder)
        scores = [1.0, *(same(a, b) for a, b in _contexts(g[text], back, ahead, fill))]
        return {pos: g[pos], "sentence": g[text], "similarity": scores[: len(g[text])]}

    kind = df.schema[pos].dataType.simpleString()
    return _grouped(df, keys, pos, [text], f"`{pos}` {kind}, sentence string, similarity double", rows)


#: Characters of contexts that a task holds before it embeds them.
EMBEDDED_AT_ONCE = 4 << 20


def _similarities(pairs: list[tuple[str, str]], embedder: Embedder, batching: Batching) -> list[float]:
    """The cosines of pairs of texts, distinct ones embedded once, in batches of about the same length."""
    place = {t: i for i, t in enumerate(dict.fromkeys(t for pair in pairs for t in pair))}
    sized = sorted((len(RegexTokenizer().tokens(t)), i, t) for t, i in place.items())
    vectors: list = [None] * len(place)
    for batch in packed(((n, (i, t)) for n, i, t in sized), batching):
        for (i, _), v in zip(batch, embedder.embed([t for _, t in batch])):
            vectors[i] = v
    return [cosine(vectors[place[a]], vectors[place[b]]) for a, b in pairs]


def batched_similarity_distribution(
    df: DataFrame,
    keys: list[str],
    pos: str,
    text: str,
    back: int = 2048,
    ahead: int | None = None,
    fill: bool = False,
    embedder: Embedder | None = None,
    batching: Batching = Batching(),
    at_once: int = EMBEDDED_AT_ONCE,
) -> DataFrame:
    """similarity_distribution with texts embedded in batches of about the same length.

    A task gathers contexts of one group after another up to at_once characters
    and embeds the distinct ones among them. Contexts are many times the size of
    the sentences, and a vector larger than most; neither leaves the task that made it.
    """
    embedder = embedder or HashedEmbedder()
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    kind = _parse_datatype_string(f"{kinds}, `{pos}` {df.schema[pos].dataType.simpleString()}, sentence string, similarity double")
    arrow = to_arrow_schema(kind)
    gathered = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(pos, text))).alias("__rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(len(keys))
            held: list[tuple] = []
            size = 0

            def finished() -> pa.RecordBatch:
                found = iter(_similarities([pair for *_, pair in held if pair], embedder, batching))
                scores = [next(found) if pair else 1.0 for *_, pair in held]
                again = pa.array([i for i, *_ in held], pa.int64())
                cells = [batch.column(k).take(again).cast(arrow[k].type) for k in range(len(keys))]
                rest = ([p for _, p, *_ in held], [t for _, _, t, _ in held], scores)
                return pa.RecordBatch.from_arrays([*cells, *(pa.array(c, f.type) for c, f in zip(rest, list(arrow)[len(keys) :]))], schema=arrow)

            for i in range(batch.num_rows):
                places, texts = (c.to_pylist() for c in own.slice(i, 1).flatten().flatten())
                pairs = itertools.chain([None], _contexts(texts, back, ahead, fill))
                for p, t, pair in zip(places, texts, pairs):
                    held.append((i, p, t, pair))
                    size += len(t or "") + (len(pair[0]) + len(pair[1]) if pair else 0)
                    if size >= at_once:
                        yield finished()
                        held, size = [], 0
            if held:
                yield finished()
        pa.default_memory_pool().release_unused()

    return gathered.mapInArrow(run, kind)


def perplexity_distribution(df: DataFrame, keys: list[str], pos: str, text: str, context_chars: int = 4096, scorer: Scorer | None = None) -> DataFrame:
    """Loss and perplexity of each sentence given the text before it; those of the first are 0."""
    scorer = scorer or CharacterScorer()

    def rows(g):
        texts, context, losses = g[text], "", []
        for i, t in enumerate(texts):
            losses.append(scorer.loss(context, t) if i else 0.0)
            context = (context + t)[-context_chars:]
        x = np.array(losses, float)
        perplexity = np.where(np.isnan(x), np.finfo(float).max, np.exp(x))
        if len(x):
            perplexity[0] = 0.0
        return {pos: g[pos], "sentence": texts, "loss": x.tolist(), "perplexity": perplexity.tolist()}

    kind = df.schema[pos].dataType.simpleString()
    return _grouped(df, keys, pos, [text], f"`{pos}` {kind}, sentence string, loss double, perplexity double", rows)


def windowed_perplexity(df: DataFrame, keys: list[str], pos: str, text: str, window: int = 4096) -> DataFrame:
    """perplexity_distribution by a window of tokens, the sentence's own included, whose counts are carried from sentence to sentence."""

    def rows(g):
        scorer, tokenizer = WindowScorer(window), RegexTokenizer()
        losses = [scorer.loss(tokenizer.tokens(t)) for t in g[text]]
        losses[:1] = [0.0]
        x = np.array(losses, float)
        perplexity = np.where(np.isnan(x), np.finfo(float).max, np.exp(x))
        perplexity[:1] = 0.0
        return {pos: g[pos], "sentence": g[text], "loss": x.tolist(), "perplexity": perplexity.tolist()}

    kind = df.schema[pos].dataType.simpleString()
    return _grouped(df, keys, pos, [text], f"`{pos}` {kind}, sentence string, loss double, perplexity double", rows)
