"""Operator 2: LM scoring with a weighted backoff automaton.

Smoothed n-grams are states. Reading token w in the state of its context takes
the arc of w if the context was seen before w, and otherwise the failure arc to
the state of the context without its first word, whose weight it multiplies in.
With c the counts in the training texts and m the smoothing mass,

    arc(h, w) = (c(h w) + m P(w | h')) / (c(h) + m),   failure(h) = m / (c(h) + m),

down to P(w) = (c(w) + 1) / (N + V + 1), where the one left over stands for all
unknown words together. Every state's arcs and failures add up to one.

The counts of a large corpus fit no machine, so they stay distributed. Texts are
packed into blocks of bounded bytes and written once. Each block sends the sorted
hashes of its distinct n-grams, with its own training counts, to the bucket of
the hash's range; each bucket adds the counts up and answers every block in the
order in which it asked; each block compiles the part of the automaton that its
texts can reach and traverses it once. What moves is a few bytes for each
distinct n-gram of a block.

Edge cases: a null or empty text has the end as its only token; a null id is
never held out; repeated rows count as often as they occur; without any training
text P is 1 for whatever comes, as V = N = 0; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from folioforge.llm.common import WordHashes, map_rows, mix64, stage, text_bytes

#: Smoothing mass: how many observations the lower order is worth.
MASS = 500.0
#: Words in an n-gram.
ORDER = 2
#: Every HELD_OUT_OF-th part of the ids by CRC-32, that with remainder HELD_OUT, is not learned from.
HELD_OUT_OF, HELD_OUT = 7, 2
#: Bytes of text to a block, whose automaton a worker holds at once, and bytes of text for which there is one bucket of counts.
BLOCK_BYTES, BUCKET_BYTES = 3_000_000, 16_000_000
#: Tokens of a text that are read in one piece.
PIECE = 64
#: Words whose hashes a worker remembers.
WORDS = 100_000

# Hashes of what no text holds: the end of a text and its start.
END, START = 0x656E64, 0x7374617274
ONE = np.uint64(1)


def held_out(id_col: str, of: int = HELD_OUT_OF, rest: int = HELD_OUT):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % of == rest, F.lit(False))


def ngram_hashes(words: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1..order the hashes of the n tokens that end at each place of: start, words, end.

    Single tokens have odd hashes and longer n-grams even ones. Where the start
    is nearer than n tokens, the place has the longest n-gram that there is; the
    start itself stands for its own n-gram at every n.
    """
    tokens = np.concatenate([np.array([START], np.uint64), words, np.array([END], np.uint64)])
    out = [mix64(tokens) | ONE]
    out[0][0] &= ~ONE  # the start is no token
    for n in range(2, order + 1):
        h = out[-1].copy()
        h[n - 1 :] = mix64(mix64(out[-1][n - 2 : -1]) * np.uint64(0x9E3779B97F4A7C15) + tokens[n - 1 :]) & ~ONE
        out.append(h)
    return out


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned integers by bytes of one significance after another, compressed."""
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1).astype(np.uint64)


class BackoffAutomaton:
    """States, arcs and failure arcs, compiled from the n-grams of some texts.

    Nodes are the places in a list of distinct n-grams, `counts` telling how often
    each was seen in training, and one more for the empty context. Seen contexts
    are states. An arc is found by its state and token; a failure arc leads to the
    state without the first word. Weights are log10 probabilities.
    """

    def __init__(self, counts: np.ndarray, orders: list[tuple[np.ndarray, ...]], start: int, total: int, distinct: int, mass: float):
        """orders[n-1] has (n-gram, its context, its n-gram without the first word, its last token) as columns, each n-gram once."""
        self.root = root = len(counts)
        self.width = root + 1
        self.word = np.log10((counts + 1) / (total + distinct + 1.0))
        self.known = counts > 0
        p, fail, drop = np.append((counts + 1) / (total + distinct + 1.0), 1.0), np.full(root + 1, root), np.zeros(root + 1)
        keys, to, weight = [], [], []
        for n, (gram, context, shorter, token) in enumerate(orders, 1):
            seen = self.known[gram]
            if n == 1:
                context, shorter = np.full(len(gram), root), np.full(len(gram), root)
            else:
                p[gram] = (counts[gram] + mass * p[shorter]) / (counts[context] + mass)
            arcs = np.ones(len(gram), bool) if n == 1 else seen
            state = np.where(seen, gram, root) if n < len(orders) else shorter
            keys.append(context[arcs] * self.width + token[arcs])
            to.append(state[arcs])
            weight.append(np.log10(p[gram[arcs]]))
            fail[gram] = shorter
        drop[:root] = np.log10(mass / (counts + mass))
        keys = np.concatenate(keys)
        by_key = np.argsort(keys)
        self.keys, self.to, self.weight = keys[by_key], np.concatenate(to)[by_key], np.concatenate(weight)[by_key]
        self.fail, self.drop, self.reach = fail, drop, len(orders) - 1
        self.start = start if len(orders) > 1 and self.known[start] else root

    def traverse(self, tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """log10 of the probability of each token of texts that lie end to end; sizes has their tokens, one or more.

        Texts are read from left to right and the state is carried from token to
        token. A token that it has no arc for takes failure arcs, whose weights add
        up, until a shorter context has one. Texts are cut into pieces that are read
        side by side, one token of each at a time; a later piece begins so many tokens
        early that its state is the one that was carried there.
        """
        first = np.cumsum(sizes) - sizes
        pieces = -(-sizes // PIECE)
        text = np.repeat(np.arange(len(sizes)), pieces)
        number = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        early = np.where(number > 0, self.reach, 0)
        begin = first[text] + PIECE * number - early
        length = np.minimum(sizes[text] - PIECE * number, PIECE) + early
        longest = np.argsort(-length, kind="stable")
        begin, length, early = begin[longest], length[longest], early[longest]
        state = np.where(number[longest] > 0, self.root, self.start)
        out = np.zeros(len(tokens))
        for k in range(int(length[0]) if len(length) else 0):
            m = int(np.searchsorted(-length, -k))  # as many are longer than k
            at = begin[:m] + k
            token, now, weight, left = tokens[at], state[:m].copy(), np.zeros(m), np.arange(m)
            while len(left):
                key = now[left] * self.width + token[left]
                arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                ok = self.keys[arc] == key
                there, arc, left = left[ok], arc[ok], left[~ok]
                weight[there] += self.weight[arc]
                state[there] = self.to[arc]
                weight[left] += self.drop[now[left]]
                now[left] = self.fail[now[left]]
            own = early[:m] <= k
            out[at[own]] = weight[own]
        return out


class _Block:
    """The distinct n-grams of a block's texts, and where in them each text's states are."""

    def __init__(self, rows: list[tuple], table: WordHashes, order: int):
        grams, fresh = [], []
        for _, held, text in rows:
            for n, g in enumerate(ngram_hashes(table.of(text.lower().split()), order)):
                grams.append(g)
                # where n tokens reach back over the start, a shorter n-gram stands in for them and must not count again
                count = np.full(len(g), not held)
                count[:n] = False
                fresh.append(count)
        self.size, self.order = [len(g) for g in grams], order
        self.fresh = np.concatenate(fresh)
        hashes = np.concatenate(grams)
        del grams, fresh
        self.hashes, self.place = np.unique(hashes, return_inverse=True)

    def trained(self) -> np.ndarray:
        """How often each n-gram stands in the texts to learn from."""
        return np.bincount(self.place[self.fresh], minlength=len(self.hashes))

    def texts(self):
        """For each text its places by n."""
        parts = np.split(self.place, np.cumsum(self.size)[:-1])
        return [parts[i : i + self.order] for i in range(0, len(parts), self.order)]

    def automaton(self, counts: np.ndarray, total: int, distinct: int, mass: float) -> BackoffAutomaton:
        """Over the n-grams of all texts, given their counts in the whole corpus."""
        texts, orders = self.texts(), []
        for n in range(1, self.order + 1):
            # a text's places from n - 1 on have n-grams; the start is a context and no token
            skip = max(1, n - 1)
            gram, context, shorter, token = (
                np.concatenate([t[max(m, 1) - 1][skip + back : len(t[0]) + back] for t in texts]) for m, back in ((n, 0), (n - 1, -1), (n - 1, 0), (1, 0))
            )
            gram, first = np.unique(gram, return_index=True)
            orders.append((gram, context[first], shorter[first], token[first]))
        return BackoffAutomaton(counts, orders, int(texts[0][0][0]), total, distinct, mass)


def _groups(batches, key: str):
    """(key, rows) of batches that are sorted by the key; one group is held at a time."""
    now, rows = None, []
    for batch in batches:
        for r in batch.to_pylist():
            if rows and r[key] != now:
                yield now, rows
                rows = []
            now = r[key]
            rows.append(r)
    if rows:
        yield now, rows


def _blocks(rows, most: int):
    """Lists of (id, held out, text) of about `most` bytes of text; a longer text is alone."""
    block, size = [], 0
    for row in rows:
        if block and size + len(row[2]) > most:
            yield block, size
            block, size = [], 0
        block.append(row)
        size += len(row[2])
    if block:
        yield block, size


def score_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, mass: float = MASS, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of df with the log10 probability of its text; see the module for the model."""
    kind = df.schema[id_col].dataType.simpleString()
    texts = df.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), text_bytes(text_col).alias("text"))
    packed_kind = to_arrow_schema(texts.schema)

    def pack_texts(batches):
        """Blocks of the rows of a task, compressed. Their numbers are those of the task and of the block in it."""
        own = TaskContext.get().partitionId() << 32
        rows = (row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(3))))
        for number, (block, size) in enumerate(_blocks(rows, block_bytes)):
            columns = [pa.array(c, f.type) for c, f in zip(zip(*block), packed_kind)]
            data = pa.RecordBatch.from_arrays(columns, schema=packed_kind).serialize().to_pybytes()
            yield {"block": [own + number], "bytes": [size], "texts": [zstandard.ZstdCompressor(1).compress(data)]}

    def unpacked(data):
        batch = pa.ipc.read_record_batch(pa.py_buffer(zstandard.ZstdDecompressor().decompress(data)), packed_kind)
        return list(zip(*(c.to_pylist() for c in batch.columns)))

    packed = stage(map_rows(texts, pack_texts, "block long, bytes long, texts binary"), "lm-texts")
    sizes = packed.agg(F.count("*").alias("blocks"), F.sum("bytes").alias("bytes")).first()
    blocks, n = max(1, sizes.blocks), max(1, -(-(sizes.bytes or 0) // bucket_bytes))

    def ask(batches):
        """A row for each block and bucket: the n-grams that the block needs, with what it adds to their counts."""
        table = WordHashes(most=WORDS)
        bounds = np.array([-(-(b << 32) // n) for b in range(n + 1)], np.uint64)
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = _Block(unpacked(data.as_py()), table, order)
                counts = own.trained()
                cuts = np.searchsorted(own.hashes >> np.uint64(32), bounds)
                for b in range(n):
                    part = slice(cuts[b], cuts[b + 1])
                    if part.stop > part.start:
                        yield {"bucket": [b], "block": [number], "hashes": [pack(np.diff(own.hashes[part], prepend=np.uint64(0)))], "counts": [pack(counts[part])]}

    def answer(batches):
        """Adds up a bucket and answers each block in the order in which it asked."""
        for number, rows in _groups(batches, "bucket"):
            asked = [(r["block"], np.cumsum(unpack(r["hashes"]), dtype=np.uint64), unpack(r["counts"])) for r in rows]
            hashes, place = np.unique(np.concatenate([a[1] for a in asked]), return_inverse=True)
            total = np.bincount(place, np.concatenate([a[2] for a in asked]).astype(float), len(hashes)).astype(np.int64)
            words = total[(hashes & ONE) == ONE]
            parts = np.split(total[place], np.cumsum([len(a[1]) for a in asked])[:-1])
            yield {
                "block": [a[0] for a in asked], "bucket": [number] * len(asked), "counts": [pack(p) for p in parts],
                "tokens": [int(words.sum()), *[0] * (len(asked) - 1)], "distinct": [int((words > 0).sum()), *[0] * (len(asked) - 1)],
            }

    asked = map_rows(packed.select("block", "texts"), ask, "bucket int, block long, hashes binary, counts binary")
    answers = stage(map_rows(_dealt(asked, n, "bucket"), answer, "block long, bucket int, counts binary, tokens long, distinct long"), "lm-counts")
    sums = answers.agg(F.sum("tokens").alias("tokens"), F.sum("distinct").alias("distinct")).first()
    total, distinct = sums.tokens or 0, sums.distinct or 0

    def walk(batches):
        table = WordHashes(most=WORDS)
        for _, rows in _groups(batches, "block"):
            docs = unpacked(next(r["texts"] for r in rows if r["texts"] is not None))
            own = _Block(docs, table, order)
            counts = np.concatenate([unpack(c) for _, c in sorted((r["bucket"], r["counts"]) for r in rows if r["texts"] is None)])
            automaton = own.automaton(counts.astype(np.int64), total, distinct, mass)
            texts = [t[0][1:] for t in own.texts()]
            tokens, sizes = np.concatenate(texts), np.array([len(t) for t in texts])
            cuts = np.cumsum(sizes)[:-1]
            add = lambda values: [x.sum().item() for x in np.split(values, cuts)]
            yield {
                id_col: [d[0] for d in docs], "held_out": [d[1] for d in docs], "n_tokens": sizes.tolist(), "n_known": add(automaton.known[tokens]),
                "train_tokens": [total] * len(docs), "base_score": add(automaton.word[tokens]), "score": add(automaton.traverse(tokens, sizes)),
            }

    both = packed.select("block", "texts").unionByName(answers.select("block", "bucket", "counts"), allowMissingColumns=True)
    return map_rows(_dealt(both, blocks, "block"), walk, f"`{id_col}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _dealt(df: DataFrame, n: int, key: str) -> DataFrame:
    return df.repartition(n, key).sortWithinPartitions(key)
