"""Operator 1: BPE encoding and decoding through a minimal acyclic transducer.

The frequent words of the corpus are compiled into a minimal acyclic automaton
in which words share prefixes and suffixes. Each transition adds a number to
the output, and the sum along a word is its rank in the sorted lexicon, under
which its token ids are stored. The compiled arrays travel as one byte string
of bounded size and are memory-mapped by each Python worker. Words outside the
lexicon are merged exactly by the merge table, so the ids never depend on which
words the lexicon holds.

Edge cases: a null text is the empty text, which has no ids and decodes to "";
texts of any length and words of any length are encoded whole; repeated rows
give repeated rows; an empty table gives an empty table with an empty lexicon;
other columns of the input are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from unicodedata import category, normalize

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folioforge.llm.common import map_rows, mapped_file, mix64, stage, text_bytes

#: Words in the compiled lexicon, at most; this bounds what is collected and broadcast.
LEXICON_WORDS = 131_072
#: Entries of a worker's memo; as many older ones are kept besides.
MEMO = 220_000
#: Bytes of texts that are encoded together.
TOGETHER = 500_000
#: Characters that every Unicode version since 2015 normalises, lower-cases and classifies alike. Texts with others go
#: through the tokenizer library's own normaliser and splitter, since Python's tables may be of another version. Python
#: also takes 1C to 1F for white space.
SETTLED = (
    r"[\x00-\x1B\x20-\u052F\u1E00-\u1FBC\u2000-\u206F\u20A0-\u20BD\u2100-\u218B\u2200-\u23FA\u2500-\u2B73\u3000-\u3029\u3041-\u3096"
    r"\u309B-\u30FF\u4E00-\u9FA5\uAC00-\uD7A3\uFF01-\uFFBE\U0001F300-\U0001F579]*+"
)


# The word pattern and the normaliser that word_places and Encoder.normal stand for. Vocabularies with
# others are split by the tokenizer library.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALISER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b if b in plain else 256 + rest.index(b)) for b in range(256)]


@dataclass
class Merges:
    """A word-end BPE vocabulary: ids of the single bytes and the ranked merges."""

    start: list[int]  # id of byte b inside a word
    last: list[int]  # id of byte b at a word's end
    ranks: dict[tuple[int, int], int]  # (left, right): rank
    made: list[int]  # id that the merge of a rank makes
    strings: dict[int, str]  # id: token as decoding prints it
    special: dict[str, int]
    plain: bool  # whether PATTERN and NORMALISER are the vocabulary's own
    splitter: str  # the file without its model: what comes before the merges
    digest: str  # of the file

    @classmethod
    def read(cls, path: str) -> Merges:
        """From a tokenizer file of the kind that lower-cases, splits by a pattern and marks word ends."""
        with open(path, "rb") as f:
            data = f.read()
        t = json.loads(data)
        vocab, end = t["model"]["vocab"], t["model"]["end_of_word_suffix"]
        letters = byte_alphabet()
        merges = t["model"]["merges"]
        ranks = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(merges)}
        special = {a["content"]: a["id"] for a in t["added_tokens"]}
        strings = {i: s for s, i in vocab.items()} | {i: s for s, i in special.items()}
        split = next(p for p in t["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        splitter = {"version": t["version"], "added_tokens": [], "normalizer": t["normalizer"], "pre_tokenizer": split, "model": {"type": "BPE", "vocab": {}, "merges": []}}
        return cls([vocab[c] for c in letters], [vocab[c + end] for c in letters], ranks, [vocab[a + b] for a, b in merges], strings, special, split["pattern"]["Regex"] == PATTERN and t["normalizer"] == NORMALISER, json.dumps(splitter), hashlib.sha256(data).hexdigest())

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: the lowest-ranked pair is merged first, the leftmost of equals."""
        ids = [self.start[b] for b in word[:-1]] + [self.last[word[-1]]]
        if len(ids) > 48:
            return self._merge_long(ids)
        get, never = self.ranks.get, len(self.made)
        found = [get(p, never) for p in zip(ids, ids[1:])]
        while found and (best := min(found)) < never:
            at = found.index(best)
            ids[at : at + 2] = [self.made[best]]
            del found[at]
            if at:
                found[at - 1] = get((ids[at - 1], ids[at]), never)
            if at < len(found):
                found[at] = get((ids[at], ids[at + 1]), never)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same by a heap over a linked list, n log n in the length of the word."""
        get, n = self.ranks.get, len(ids)
        after, before, live = [*range(1, n), -1], [*range(-1, n - 1)], [True] * n
        heap = [(rank, i) for i, p in enumerate(zip(ids, ids[1:])) if (rank := get(p)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if live[i] else -1
            if j < 0 or get((ids[i], ids[j])) != rank:
                continue
            ids[i], live[j], after[i] = self.made[rank], False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (rank := get((ids[a], ids[b]))) is not None:
                    heapq.heappush(heap, (rank, a))
        return [x for x, alive in zip(ids, live) if alive]


class Transducer:
    """A minimal acyclic automaton over bytes whose outputs add up to a word's rank.

    edges are sorted by state * 256 + byte; `add` of an edge is the number of
    accepted words that sort before every word through it, counted from its
    state.
    """

    PARTS = (("key", np.int64), ("to", np.int32), ("add", np.int32), ("final", np.uint8), ("offset", np.int64), ("ids", np.uint32))

    def __init__(self, parts: dict[str, np.ndarray]):
        self.__dict__ |= parts

    @classmethod
    def build(cls, words: list[bytes], ids_of) -> Transducer:
        """From any words; equal states are shared as soon as sorted order shows them to be complete."""
        words = sorted({w for w in words if w})
        register: dict[tuple, int] = {}
        states: list[tuple[bool, tuple]] = []  # (final, ((byte, state), ...))

        def freeze(node) -> int:
            sig = (node[0], tuple(node[1]))
            if sig not in register:
                register[sig] = len(states)
                states.append(sig)
            return register[sig]

        path = [[False, []]]  # open nodes of the last word; a closed child is (byte, state)
        labels: list[int] = []

        def close(depth: int) -> None:
            while len(path) > depth:
                done = freeze(path.pop())
                path[-1][1].append((labels.pop(), done))

        for w in words:
            same = 0
            while same < min(len(labels), len(w)) and labels[same] == w[same]:
                same += 1
            close(same + 1)
            for b in w[same:]:
                labels.append(b)
                path.append([False, []])
            path[-1][0] = True
        close(1)
        root = freeze(path[0])
        below = [0] * len(states)
        edges = []
        for s, (final, out) in enumerate(states):  # children come before their parents
            seen = int(final)
            for b, to in out:
                edges.append((s * 256 + b, to, seen))
                seen += below[to]
            below[s] = seen
        edges.sort()
        column = lambda i, t: np.array([e[i] for e in edges], t)
        ids = [ids_of(w) for w in words]
        parts = {
            "key": column(0, np.int64), "to": column(1, np.int32), "add": column(2, np.int32), "final": np.array([s[0] for s in states], np.uint8),
            "offset": np.cumsum([0, *map(len, ids)], dtype=np.int64), "ids": np.array([i for x in ids for i in x], np.uint32),
        }
        out = cls(parts)
        out.root = root
        return out

    def to_bytes(self) -> bytes:
        head = np.array([self.root, *(len(getattr(self, n)) for n, _ in self.PARTS)], np.int64).tobytes()
        return head + b"".join(p + b"\0" * (-len(p) % 8) for p in (getattr(self, n).tobytes() for n, _ in self.PARTS))

    @classmethod
    def mapped(cls, data: bytes) -> Transducer:
        """Over a memory map of the compiled form."""
        m = mapped_file(data)
        head = m[: 8 * (1 + len(cls.PARTS))].view(np.int64)
        at, parts = 8 * len(head), {}
        for (name, kind), n in zip(cls.PARTS, head[1:], strict=True):
            size = int(n) * np.dtype(kind).itemsize
            parts[name] = m[at : at + size].view(kind).view(np.ndarray)
            at += size + -size % 8
        out = cls(parts)
        out.root = int(head[0])
        return out

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """Rank of each word, -1 for those outside; all words advance by one byte at a time."""
        rank = np.full(len(words), -1, np.int64)
        if not len(self.key) or not words:
            return rank
        size = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"".join(words), np.uint8)
        first = np.cumsum(size) - size
        row = np.flatnonzero(size)
        state, total = np.full(len(row), self.root, np.int64), np.zeros(len(row), np.int64)
        depth = 0
        while len(row):
            key = state * 256 + text[first[row] + depth]
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            ok = self.key[at] == key
            row, at = row[ok], at[ok]
            state, total = self.to[at].astype(np.int64), total[ok] + self.add[at]
            depth += 1
            ends = size[row] == depth
            done = ends & (self.final[state] != 0)
            rank[row[done]] = total[done]
            row, state, total = row[~ends], state[~ends], total[~ends]
        return rank

    def output(self, rank: int) -> np.ndarray:
        return self.ids[self.offset[rank] : self.offset[rank + 1]]


class Memo(dict):
    """Remembers up to MEMO newer and as many older entries; those in use move up."""

    old: dict = {}

    def recall(self, keys: list, learn) -> list:
        """What is remembered of each key; learn gives the entries of those that are not."""
        found = list(map(self.get, keys))
        if None in found:
            missed = {k for k, f in zip(keys, found) if f is None}
            if len(self) > MEMO:
                self.old = dict(self)
                self.clear()
            for k in missed.intersection(self.old):
                self[k] = self.old[k]
            new = [k for k in missed if k not in self]
            self.update(zip(new, learn(new)))
            found = [self[k] if f is None else f for k, f in zip(keys, found)]
        return found


@functools.cache
def character_classes() -> np.ndarray:
    """0 for white space, 1 for letters, 2 for numbers, 3 for all else, by code point."""
    kinds = {"L": 1, "N": 2}
    out = np.array([kinds.get(category(chr(c))[0], 3) for c in range(0x110000)], np.uint8)
    out[[c for c in range(0x3001) if chr(c).isspace() and not 0x1C <= c <= 0x1F]] = 0
    return out


class Powers:
    """Powers of two odd bases and of their inverses modulo 2 ** 64, as far as they were asked for."""

    BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

    def __init__(self):
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []

    def of(self, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
        if not self.tables or len(self.tables[0][0]) < n:
            size = max(n, 1 << 19)
            self.tables = [tuple(np.multiply.accumulate(np.full(size, x, np.uint64)) for x in (b, pow(b, -1, 1 << 64))) for b in self.BASES]
        return self.tables


POWERS = Powers()


def word_places(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the words in the code points of a normalised text.

    Words are runs of letters, single numbers, runs of what is neither, and the
    endings that a lone apostrophe begins.
    """
    kind = character_classes()[text]
    edge = np.concatenate([[True], kind[1:] != kind[:-1], [True]])
    number = kind == 2
    starts = np.flatnonzero((edge[:-1] | number) & (kind != 0))
    ends = np.flatnonzero((edge[1:] | number) & (kind != 0)) + 1
    lone = np.flatnonzero((text[starts] == 0x27) & (ends - starts == 1))
    if len(lone):
        padded = np.append(text, np.zeros(2, text.dtype))
        a, b = padded[starts[lone] + 1], padded[starts[lone] + 2]
        size = 2 * np.isin(a, [0x73, 0x74, 0x6D, 0x64]) + 3 * (((a == 0x72) | (a == 0x76)) & (b == 0x65) | (a == 0x6C) & (b == 0x6C))
        lone, size = lone[size > 0], size[size > 0]
        ends[lone] = starts[lone] + size
        starts[lone + 1] = ends[lone]  # the letters after it begin behind it
        keep = ends > starts
        starts, ends = starts[keep], ends[keep]
    return starts, ends


class WordTable:
    """The words of some texts: each distinct one once, and for every place which it is.

    Hashes put the places of a word together; then every place is compared with
    the first of its group, code point by code point, so that what a word is
    never depends on a hash.
    """

    def __init__(self, texts: list[str]):
        joined = "\n".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts, ends = word_places(codes)
        mixed = mix64(codes.astype(np.uint64) + np.uint64(1))
        hashes = []
        for up, down in POWERS.of(len(codes) + 1):
            sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed * up[: len(codes)], dtype=np.uint64)])
            hashes.append((sums[ends] - sums[starts]) * down[starts])
        order = np.argsort(hashes[0])
        ranked, second = hashes[0][order], hashes[1][order]
        fresh = np.concatenate([[True], (ranked[1:] != ranked[:-1]) | (second[1:] != second[:-1])]) if len(order) else np.zeros(0, bool)
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(fresh) - 1
        first = order[fresh]
        self.words = [joined[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        self._part(joined, codes, starts, ends, first)
        begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        #: places[i] to places[i + 1] are the words of text i
        self.places = np.searchsorted(starts, begins)

    def _part(self, joined: str, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> None:
        """Makes words of their own of those that only share their hashes with the first of their group."""
        size, own = ends - starts, first[self.which]
        other = size != size[own]
        if not other.any():
            total = np.cumsum(size)
            steps = np.zeros(len(codes) + 1, np.int8)
            steps[starts] += 1
            steps[ends] -= 1
            mine = codes[np.cumsum(steps[:-1], dtype=np.int8) > 0]
            differ = mine != codes[np.repeat(starts[own] - (total - size), size) + np.arange(len(mine))]
            if not differ.any():
                return
            other[np.searchsorted(total, np.flatnonzero(differ), side="right")] = True
        number = {}
        for i in np.flatnonzero(np.isin(self.which, self.which[other])).tolist():
            word = joined[starts[i] : ends[i]]
            if word not in number:
                number[word] = len(self.words)
                self.words.append(word)
            self.which[i] = number[word]

    def counts(self) -> np.ndarray:
        return np.bincount(self.which, minlength=len(self.words))

    def spread(self, entries: list[bytes], kind: str) -> tuple[np.ndarray, np.ndarray]:
        """(all words' entries in order, where each text's begin) for the entries of the distinct words."""
        table = np.frombuffer(b"".join(entries), kind)
        size = np.fromiter(map(len, entries), np.int64, len(entries)) // table.itemsize
        begin = np.cumsum(size) - size
        n = size[self.which]
        total = np.concatenate([[0], np.cumsum(n)])
        return table[np.repeat(begin[self.which] - total[:-1], n) + np.arange(total[-1])], total[self.places]


class Encoder:
    """Encodes texts in groups; words by the lexicon or by merging, both remembered.

    A remembered entry is (ids as little-endian bytes, decoded with a blank
    behind it).
    """

    def __init__(self, merges: Merges, lexicon: Transducer | None = None):
        self.merges, self.lexicon, self.known = merges, lexicon, Memo()
        #: tokens as decoding prints them, with the blank that parts them
        self.shown = {i: s + " " for i, s in merges.strings.items()}
        self.settled = regex.compile(SETTLED).fullmatch
        self.library = Tokenizer.from_str(merges.splitter)
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in merges.special) + ")").split if merges.special else None

    def normal(self, text: str) -> str | None:
        """The normalised text if its words can be told by class of character, else None."""
        if not self.merges.plain or any(s in text for s in self.merges.special):
            return None
        if not text.isascii():
            if not self.settled(text) or "Σ" in text:
                return None
            text = normalize("NFC", text)
        elif any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return None
        return text.lower()

    def words(self, text: str) -> list[str]:
        """The words of any text by the tokenizer library's own normaliser and splitter; special tokens stand for themselves."""
        out = []
        for part in self.cut(text) if self.cut else [text]:
            if part in self.merges.special:
                out.append(part)
            elif part:
                out += [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))]
        return out

    def learn(self, words: list[str]):
        coded = [w.encode("utf-8", "surrogatepass") for w in words]
        show, special = self.shown, self.merges.special
        for w, b, rank in zip(words, coded, self.lexicon.ranks(coded).tolist(), strict=True):
            ids = [special[w]] if w in special else self.lexicon.output(rank).tolist() if rank >= 0 else self.merges.merge(b)
            yield array("I", ids).tobytes(), "".join([show[i] for i in ids]).encode()

    def encode(self, texts: list[str]):
        """The ids as little-endian 32-bit integers, their number, and the UTF-8 of the text decoded from them, of each text."""
        normal = [self.normal(t) for t in texts]
        table = WordTable([n for n in normal if n is not None])
        found = self.known.recall(table.words, self.learn)
        ids, id_ends = table.spread([f[0] for f in found], "<u4")
        decoded, decoded_ends = table.spread([f[1] for f in found], "u1")
        at = 0
        for text, plain in zip(texts, normal):
            if plain is None:
                own = self.known.recall(self.words(text), self.learn)
                yield b"".join([f[0] for f in own]), sum([len(f[0]) for f in own]) // 4, b"".join([f[1] for f in own])[:-1]
            else:
                part = ids[id_ends[at] : id_ends[at + 1]]
                yield part.tobytes(), len(part), decoded[decoded_ends[at] : max(decoded_ends[at], decoded_ends[at + 1] - 1)].tobytes()
                at += 1


#: One encoder to a worker process, so that what it remembers outlives a task.
_ENCODERS: dict[str, Encoder] = {}


def _encoder(merges: Merges, lexicon: bytes) -> Encoder:
    key = merges.digest + hashlib.sha256(lexicon).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(merges, Transducer.mapped(lexicon))
    return _ENCODERS[key]


def grouped_texts(column) -> Iterator[list[str]]:
    """A column of UTF-8 as texts, in groups of about TOGETHER bytes; a longer text is a group of its own."""
    group, size = [], 0
    for t in column:
        text = t.as_py()
        if group and size + len(text) > TOGETHER:
            yield group
            group, size = [], 0
        group.append(text.decode("utf-8", "replace"))
        size += len(text)
    if group:
        yield group


def frequent_words(df: DataFrame, merges: Merges, text_col: str = "text", most: int = LEXICON_WORDS) -> list[bytes]:
    """The `most` most frequent words of all texts, about; never more.

    Words are counted over everything; the driver gets a histogram of their
    counts by eighths of powers of two, the words above the cut, and of the level
    below it as many as there is room for.
    """
    bound = df.sparkSession.sparkContext.broadcast(merges)

    def count(batches):
        encoder = Encoder(bound.value)
        seen: Counter = Counter()

        def rows():
            return {"word": [w.encode("utf-8", "replace") for w in seen], "n": list(seen.values())}

        for batch in batches:
            for texts in grouped_texts(batch.column(0)):
                normal = [encoder.normal(t) for t in texts]
                table = WordTable([n for n in normal if n is not None])
                for w, n in zip(table.words, table.counts().tolist()):
                    seen[w] += n
                for t, n in zip(texts, normal):
                    if n is None:
                        seen.update(encoder.words(t))
                if len(seen) > 2 * MEMO:
                    yield rows()
                    seen = Counter()
        yield rows()

    counts = stage(map_rows(df.select(text_bytes(text_col)), count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    level = F.floor(F.log2("n") * 8).cast("int")
    cut, room, full = None, most, None
    for r in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        if r["count"] > room:
            full = r["level"]
            break
        cut, room = r["level"], room - r["count"]
    words = [] if cut is None else [bytes(r.word) for r in counts.filter(level >= cut).select("word").collect()]
    if full is not None and room:
        words += _some_of(counts.filter(level == full), room)
    return words


def _some_of(counts: DataFrame, room: int) -> list[bytes]:
    """The most frequent of more than `room` words; of equally frequent ones those with the smallest hashes."""
    out = []
    for r in counts.groupBy("n").count().orderBy(F.desc("n")).collect():
        same, left = counts.filter(F.col("n") == r["n"]), room - len(out)
        if r["count"] > left:
            h = F.shiftrightunsigned(F.xxhash64("word"), 34)
            share = min(1.0, (1.1 * left + 100) / r["count"])  # leaves enough but for one chance in millions
            some = same.filter(h < int((1 << 30) * share)).select(h.alias("h"), "word").collect()
            return out + [w for _, w in sorted((x.h, bytes(x.word)) for x in some)[:left]]
        out += [bytes(x.word) for x in same.select("word").collect()]
    return out


def encode_decode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", lexicon_words: int = LEXICON_WORDS, keep_ids: bool = True, keep_decoded: bool = True) -> DataFrame:
    """One row per row of df: id, n_tokens, digests of the ids and of the decoded text, and as asked both themselves.

    tokenizer is the path of the vocabulary file; only the driver reads it.
    """
    spark = df.sparkSession
    merges = Merges.read(tokenizer)
    lexicon = Transducer.build(frequent_words(df, merges, text_col, lexicon_words), merges.merge).to_bytes()
    model = spark.sparkContext.broadcast((merges, lexicon))
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        encoder = _encoder(*model.value)
        for batch in batches:
            out = {id_col: batch.column(0), "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": [], "decoded": []}
            for texts in grouped_texts(batch.column(1)):
                for ids, n, decoded in encoder.encode(texts):
                    out["n_tokens"].append(n)
                    out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                    out["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
                    if keep_ids:
                        out["ids"].append(np.frombuffer(ids, "<u4").astype(np.int32))
                    if keep_decoded:
                        out["decoded"].append(decoded.decode())
            yield out

    more = ", ids array<int>" * keep_ids + ", decoded string" * keep_decoded
    return map_rows(df.select(id_col, text_bytes(text_col).alias("text")), run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
