"""The other operators on texts against plain versions, and their edge cases."""

import collections
import hashlib
import itertools
import math
import pickle
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioforge.llm import common, decontaminate, licenses, linededup, lm, media, nearcopies, quality, simhash
from folioforge.llm.boosting import AdditiveModel, BoostedTrees
from folioforge.llm.components import connected_components

ODD = [(1, "a b a b", "s"), (2, None, None), (3, "", "s"), (None, "a b", "s"), (1, "a b a b", "s"), (5, " \t\n\x0b ", "s"), (6, "é " * 5000, None), (7, "one", "s")]
SCHEMA = "doc_id long, text string, score string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


# --- language model --------------------------------------------------------------------------------------------------


def plain_lm(rows, order, mass):
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    grams = collections.Counter()
    for i, t in rows:
        if not held(i):
            w = [0, *tokens(t)]
            for n in range(1, order + 1):
                grams.update(tuple(w[j - n : j]) for j in range(n, len(w) + 1))
    start = sum(not held(i) for i, _ in rows)
    words = {g: c for g, c in grams.items() if len(g) == 1 and g != (0,)}
    total, kinds = sum(words.values()), len(words)
    grams[(0,)] = start
    out = []
    for i, t in rows:
        w, base, score, known = [0, *tokens(t)], 0.0, 0.0, 0
        for j in range(1, len(w)):
            p = (words.get((w[j],), 0) + 1) / (total + kinds + 1)
            base += math.log10(p)
            known += (w[j],) in words
            for n in range(2, min(order, j + 1) + 1):
                p = (grams[tuple(w[j - n + 1 : j + 1])] + mass * p) / (grams[tuple(w[j - n + 1 : j])] + mass)
            score += math.log10(p)
        out.append((i, held(i), len(w) - 1, known, total, base, score))
    return out


@pytest.mark.parametrize("order", [2, 3])
def test_lm(spark, order):
    rng = random.Random(order)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 30)))) for i in range(60)] + [(None, "a b"), (70, None), (1, "a b c"), (1, "a b c")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit("x"))
    got = sorted(lm.score_texts(df, order=order, mass=3.0, block_bytes=300, bucket_bytes=700).collect(), key=lambda r: (r.doc_id is None, r.doc_id, r.n_tokens))
    expected = sorted(plain_lm(rows, order, 3.0), key=lambda r: (r[0] is None, r[0], r[2]))
    for g, e in zip(got, expected, strict=True):
        assert (g.doc_id, g.held_out, g.n_tokens, g.n_known, g.train_tokens) == e[:5]
        assert (g.base_score, g.score) == pytest.approx(e[5:], abs=1e-9)


def test_lm_probabilities_add_up():
    """From every state the arcs and what fails add up to one, the words left over standing for one more."""
    rng = random.Random(4)
    texts = [(i, False, " ".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9))).encode()) for i in range(30)]
    for order in (1, 2, 3):
        block = lm._Block(texts, common.WordHashes(), order)
        counts = block.trained()
        tokens = sorted({int(x) for t in block.texts() for x in t[0][1:]})
        a = block.automaton(counts, int(counts[tokens].sum()), len(tokens), 2.0)
        end = int(block.texts()[0][0][-1])  # nothing follows the end
        states = {a.start, *a.to[a.keys % a.width != end].tolist()}
        assert len(states) > 1 or order == 1
        for s in states:
            a.start = s
            unknown = 1 / (int(counts[tokens].sum()) + len(tokens) + 1)
            at = s
            while at != a.root:  # the word that no text has takes all failure arcs
                unknown *= 10 ** a.drop[at]
                at = a.fail[at]
            assert (10 ** a.traverse(np.array(tokens), np.ones(len(tokens), int))).sum() + unknown == pytest.approx(1.0)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_lm_pieces_change_nothing(monkeypatch, order):
    rng = random.Random(order)
    texts = [(i, i % 4 == 0, " ".join(rng.choice("abcdefg") for _ in range(rng.randrange(0, 40))).encode()) for i in range(50)]
    block = lm._Block(texts, common.WordHashes(), order)
    counts = block.trained()
    a = block.automaton(counts, int(counts.sum()), 8, 2.0)
    tokens = [t[0][1:] for t in block.texts()]
    sizes = np.array([len(t) for t in tokens])
    whole = a.traverse(np.concatenate(tokens), sizes)
    one = np.concatenate([a.traverse(t, np.array([len(t)])) for t in tokens])
    monkeypatch.setattr(lm, "PIECE", 5)
    assert whole.tolist() == one.tolist() == a.traverse(np.concatenate(tokens), sizes).tolist()


def test_lm_blocks_are_bounded_by_bytes():
    rows = [(i, False, b"x" * n) for i, n in enumerate([10, 10, 10, 90, 5, 5, 200, 1])]
    assert [([r[0] for r in block], size) for block, size in lm._blocks(iter(rows), 25)] == [([0, 1], 20), ([2], 10), ([3], 90), ([4, 5], 10), ([6], 200), ([7], 1)]


def test_lm_of_one_long_text(spark):
    """Half a million tokens in one row, over and over the same words, beside short rows that repeat."""
    rows = [(1, "a b a c " * 125_000), *[(i % 3 + 3, "a b") for i in range(40)]]
    got = lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=100)
    expected = {(e[0], e[2]): e for e in plain_lm(rows, 2, lm.MASS)}
    out = got.collect()
    assert len(out) == len(rows)
    for g in out:
        e = expected[g.doc_id, g.n_tokens]
        assert (g.n_known, g.train_tokens) == e[3:5] and (g.base_score, g.score) == pytest.approx(e[5:], rel=1e-9)


def test_lm_without_training_texts(spark):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    got = lm.score_texts(spark.createDataFrame([(i, "a") for i in held], "doc_id long, text string")).collect()
    assert [(r.train_tokens, r.base_score, r.score) for r in got] == [(0, 0.0, 0.0)] * 2
    assert lm.score_texts(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# --- licenses --------------------------------------------------------------------------------------------------------


def plain_phrases(text):
    words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_licenses(spark):
    rng = random.Random(1)
    parts = ["MIT License", "mit", "license", "CC BY-NC 4.0", "cc-by", "Apache License, Version 2.0", "GNU General Public License", "gnu general", "É", "x9", "\n", "Released under the"]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randrange(0, 12))), None) for i in range(150)] + ODD
    got = licenses.scan_licenses(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    texts = collections.defaultdict(set)
    for i, t, _ in rows:
        texts[i].add(plain_phrases(t))
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) in texts[r.doc_id]
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_templates():
    s = licenses.Scanner(licenses.PHRASES, licenses.TEMPLATES)
    labels = lambda t: set(s.scan(t.encode())["labels"].split(","))
    assert {"apache", "apache-2.0-notice"} <= labels("x Licensed under the Apache License, Version 2.0.")
    assert "gpl-notice" in labels("This work is licensed under the GNU General Public License, version 3.")
    assert "mit-notice" in labels("Released under the terms of the MIT License") and "mit-notice" not in labels("Released beneath the MIT License")
    assert "cc-by-notice" in labels("Licensed under CC BY-NC 4.0.")
    assert labels("a license to kill") == {""}
    a = licenses.TokenAutomaton.compile('a <<beginOptional>>b <<beginOptional>>c<<endOptional>><<endOptional>> <<var;match="[0-9]+";most=2>> d')
    w = lambda t: a.longest(t.encode().split(), 0)
    assert [w(t) for t in ("a 1 d", "a b 1 2 d", "a b c 1 d x", "a c 1 d", "a 1 2 3 d", "a d")] == [3, 5, 5, 0, 0, 0]


def markup_tree(markup):
    """Nested lists of (kind, value) read from the markup: words, patterns with their most, optional lists."""
    stack = [[]]
    for part in re.findall(r"<<[^>]*>>|[^<]+", markup):
        if part == "<<beginOptional>>":
            stack.append([])
        elif part == "<<endOptional>>":
            inner = stack.pop()
            stack[-1].append(("optional", inner))
        elif part.startswith("<<var"):
            pattern, most = part[len('<<var;match="') : -2].split('";most=')
            stack[-1].append(("some", (pattern, int(most))))
        else:
            stack[-1] += [("word", w) for w in re.findall("[0-9a-z]+", part.lower())]
    return stack[0]


def plain_ends(tree, words, starts):
    for kind, x in tree:
        if kind == "word":
            starts = {i + 1 for i in starts if words[i : i + 1] == [x]}
        elif kind == "optional":
            starts = starts | plain_ends(x, words, starts)
        else:
            runs = {(i, n) for i in starts for n in range(1, x[1] + 1) if i + n <= len(words)}
            starts = {i + n for i, n in runs if all(re.fullmatch(x[0], w) for w in words[i : i + n])}
    return starts


def written(tree, rng):
    pool = ["2", "0", "3", "4", "sa", "nc", "nd", "and", "or", "its", "the", "work", "program", "software", "file", "released", "licensed", "distributed", "available", "acme", "é1"]
    out = []
    for kind, x in tree:
        if kind == "word":
            out.append(x)
        elif kind == "optional":
            out += written(x, rng) if rng.random() < 0.5 else []
        else:
            fitting = [w for w in pool if re.fullmatch(x[0], w)]
            out += [rng.choice(fitting) for _ in range(rng.randrange(1, x[1] + 1))]
    return out


def test_templates_against_a_plain_matcher():
    rng, seen = random.Random(5), collections.Counter()
    trees = {name: markup_tree(m) for name, m in licenses.TEMPLATES.items()}
    scanner = licenses.Scanner(licenses.PHRASES, licenses.TEMPLATES)
    for trial in range(240):
        words = []
        for name in rng.sample(sorted(trees), rng.randrange(1, 3)):
            words += ["x"] * rng.randrange(3) + written(trees[name], rng)
        for _ in range(rng.choice([0, 0, 1, 2])):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[], ["x"], [words[at]] * 2])
        expected = [(n, i, max(ends) - i) for n, t in trees.items() for i in range(len(words)) if (ends := plain_ends(t, words, {i})) and max(ends) > i]
        got = scanner.scan(" ".join(words).encode())
        assert sorted((s["template"], s["start"], s["words"]) for s in got["spans"]) == sorted(expected)
        assert set(got["labels"].split(",")) - {""} == {e[0] for e in expected} | set(plain_phrases(" ".join(words))[4].split(",")) - {""}
        seen.update({e[0] for e in expected})
    assert set(seen) == set(trees)


def test_templates_without_mandatory_words_and_empty_sets(spark):
    s = licenses.Scanner({"": "none"}, {"any": '<<var;match="[0-9]+";most=2>>', "maybe": "<<beginOptional>>a<<endOptional>>"})
    assert [tuple(x.values()) for x in s.scan(b"a 1 2")["spans"]] == [("any", 1, 2), ("any", 2, 1), ("maybe", 0, 1)]
    assert s.scan(b"")["labels"] == ""
    df = spark.createDataFrame([(1, "MIT License")], "doc_id long, text string")
    r = licenses.scan_licenses(df, phrases={}, templates={}).first()
    assert (r.n_words, r.n_base, r.labels, r.score) == (2, 0, "", 0.0)


# --- near duplicates -------------------------------------------------------------------------------------------------


def plain_components(fps, radius):
    parent = {i: i for i in fps}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(fps)
    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_fingerprint():
    import xxhash

    words = b"a b c d a b c".split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(5)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    assert simhash.fingerprint(words) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > 5)
    assert simhash.fingerprint([]) == 0 and simhash.fingerprint([b"a"]) == xxhash.xxh64_intdigest(b"a", 42)
    assert simhash.word_shingles(words, 3) == shingles


def joined(n, links):
    """The parts, by smallest place, that links make of n places."""
    part = list(range(n))
    for a, b in links:
        x, y = sorted((part[a], part[b]))
        part = [x if p == y else p for p in part]
    return part


def chains(rng, n, radius):
    """Fingerprints in chains of one to radius + 1 bits, and strangers."""
    fps, now = {}, 5
    for i in range(n):
        now = rng.getrandbits(64) if i % 20 == 0 else now ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, radius + 2)))
        fps[i] = now
    return fps


@pytest.mark.parametrize("radius,split,dense", [(1, 4096, 100_000), (3, 4096, 100_000), (5, 4096, 100_000), (1, 2, 100_000), (3, 2, 100_000), (5, 2, 100_000), (1, 2, 2), (3, 2, 2)])
def test_links_connect_what_is_near(spark, radius, split, dense):
    fps = chains(random.Random(radius), 160, radius)
    signed = {i: f - (1 << 64) if f >> 63 else f for i, f in fps.items()}
    back = {s: i for i, s in signed.items()}
    if split == 4096:
        got = [(back[r.a], back[r.b]) for r in simhash.near_links(spark.createDataFrame([(s,) for s in signed.values()], "fp long"), radius).collect()]
    else:
        got = []
        old = simhash.SPLIT, simhash.DENSE
        simhash.SPLIT, simhash.DENSE = split, dense
        for places in simhash.key_places(radius):
            byte = collections.defaultdict(list)
            for i, f in fps.items():
                byte[tuple(f >> (8 * p) & 255 for p in places)].append(i)
            for members in byte.values():
                got += [(members[i], members[j]) for i, j in simhash.posting_links(np.array([fps[m] for m in members], np.uint64), places, radius)]
        simhash.SPLIT, simhash.DENSE = old
    assert all((fps[a] ^ fps[b]).bit_count() <= radius for a, b in got)
    assert dict(enumerate(joined(len(fps), got))) == plain_components(fps, radius)


def test_every_pair_in_the_radius_meets():
    for radius in range(1, 7):
        keys = simhash.key_places(radius)
        assert all(any(set(k) <= set(c) for k in keys) for c in itertools.combinations(range(8), 8 - radius))


def test_a_hot_posting_is_split(monkeypatch):
    """12,000 fingerprints that share three bytes, in chains: as many parts as by comparing all."""
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 1 << 40, 4000, dtype=np.uint64)
    near = fps.copy()
    for _ in range(3):
        near ^= np.uint64(1) << rng.integers(0, 40, len(near)).astype(np.uint64)
    fps = np.unique(np.concatenate([fps, near, fps ^ np.uint64(1)]))
    links = simhash.posting_links(fps, (5, 6, 7), 3)
    whole = simhash.spanning_links(fps, 3)
    assert all((int(fps[i]) ^ int(fps[j])).bit_count() <= 3 for i, j in links)
    assert joined(len(fps), links) == joined(len(fps), whole)


def test_enumeration_equals_comparison():
    rng = np.random.default_rng(1)
    for n in (60, 300, 1500):
        fps = np.unique(rng.integers(0, 1 << 12, n, dtype=np.uint64))
        a, b = simhash.spanning_links(fps, 2), simhash._enumerated_links(fps, 2, (1 << 12) - 1)
        assert joined(len(fps), a) == joined(len(fps), b) and all((int(fps[i]) ^ int(fps[j])).bit_count() <= 2 for i, j in b)


def test_near_duplicates(spark):
    rng = random.Random(5)
    base = ["w%d" % rng.randrange(50) for _ in range(120)]
    rows = [(i, " ".join(base[:k] + ["zz"] + base[k + 1 :]), "x") for i, k in enumerate([0, 119, 60, 60])] + [(10 + i, t, s) for i, (_, t, s) in enumerate(ODD)]
    got = {r.doc_id: r for r in simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    fps = {i: simhash.fingerprint((t or "").encode().lower().split()) for i, t, _ in rows}
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: ("%016x" % fps[i], c) for i, c in plain_components(fps, 3).items()}
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_near_duplicates_with_null_and_repeated_ids(odd):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    assert {r.component_id for r in got if r.doc_id in (2, 3, 5)} == {2}


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (-5, 100), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: -5, 101: -5, -5: -5}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_recall_of_the_near_stage(spark):
    import measure_recall

    got = measure_recall.recall(spark, "/root/testdata/sf0.01", every=1)
    assert got["pairs"] > 10 and got["caught"] >= 0.99 and got["by triples"] >= 0.9


def test_op5_on_a_whole_table(spark):
    """The registered operator over all documents of sf0.01 against comparing all pairs of fingerprints."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in simhash.near_duplicates(df).collect()}
    fps = {i: int(r.fingerprint, 16) for i, r in got.items()}
    assert {i: r.component_id for i, r in got.items()} == plain_components(fps, 3)


def test_sketches_are_compared_alike_at_every_size(monkeypatch):
    rng = np.random.default_rng(6)
    sketch, parts = rng.integers(0, 1 << 32, 700, dtype=np.uint32), rng.integers(0, 300, 700)
    near = (np.bitwise_count(sketch[:, None] ^ sketch[None, :]) <= 6) & (parts[:, None] != parts[None, :])
    monkeypatch.setattr(nearcopies, "SKETCH_RADIUS", 6)
    for at_once in (16, 100, 5000):
        monkeypatch.setattr(nearcopies, "AT_ONCE", at_once)
        assert nearcopies.has_neighbour(sketch, parts).tolist() == near.any(axis=1).tolist()


def test_shared_bytes_are_tallied():
    """Within the radius, but with too few shared positional bytes: no candidate, in whatever posting a pair meets."""
    rng = np.random.default_rng(3)
    one = rng.integers(0, 256, 64, dtype=np.uint8)
    for equal in (3, nearcopies.SHARED - 1, nearcopies.SHARED, 64):
        other = one ^ (np.arange(64) >= equal).astype(np.uint8)
        for number in (0, nearcopies.TRIPLES - 1, nearcopies.TRIPLES):
            columns = [pa.array([number << 56 | 7] * 2), pa.array([4, 2]), pa.array([4, 2]), pa.array([one.tobytes(), other.tobytes()], pa.binary())]
            got = [m.tolist() for c in nearcopies._candidates([pa.RecordBatch.from_arrays(columns, ["key", "node", "part", "fp"])]) for m in c["members"]]
            assert got == ([[2, 4]] if equal >= nearcopies.SHARED else [])


def test_columns_may_have_any_name(spark):
    """Inner names of earlier versions and of this one as columns of the input."""
    names = ["own", "Nth", "doc", "keys", "__own", "__nth", "__doc", "__keys", "hi", "node", "part", "least"]
    rows = [(1, "a line of some length\nother words here", *range(12)), (2, "a line of some length\nmore words there", *range(12)), (2, "a line of some length\nmore words there", *range(12))]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} long" for n in names))
    got = sorted(tuple(r) for r in linededup.replace_texts(df).collect())
    assert got == [rows[0], *[(2, "more words there", *range(12))] * 2]
    assert sorted(tuple(r) for r in nearcopies.representatives(df).collect()) == rows[:2]
    assert linededup.dedup_lines(df).count() == 3


def test_representatives(spark):
    rng = random.Random(6)
    doc = lambda: ["w%d" % rng.randrange(5000) for _ in range(150)]
    a, b = doc(), doc()
    near = a[:70] + ["changed"] + a[71:]
    rows = [(5, " ".join(a), "x", 1), (3, " ".join(near), "x", 1), (4, " ".join(a), "x", 1), (9, " ".join(b), None, None), (9, " ".join(b), None, None), (None, " ".join(doc()), "x", 1), (20, None, "x", 1), (21, "", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, node int")
    kept = nearcopies.representatives(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=lambda i: (i is None, i)) == [3, 9, 20, None]
    assert nearcopies.representatives(df.limit(0)).collect() == []


def plain_groups(texts, least=0.8, k=5):
    """Ids that come first in their group, every pair of shingle sets compared."""
    words = {i: t.lower().split() for i, t in texts.items()}
    sets = {i: {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} for i, w in words.items()}
    part = {i: i for i in texts}
    for i in sets:
        for j in sets:
            if i < j and part[i] != part[j] and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                a, b = sorted((part[i], part[j]))
                part = {n: a if p == b else p for n, p in part.items()}
    return set(part.values())


def test_representatives_are_those_of_exact_similarity(spark):
    """Pairs at 0.7 to 0.9, long and short; the texts of 8 to 20 words have one more at their end."""
    rng = random.Random(8)
    texts = {}
    for n in [*range(8, 21)] * 6:
        words = ["w%d" % rng.randrange(9000) for _ in range(n)]
        texts[len(texts)] = " ".join(words)
        texts[len(texts)] = " ".join([*words, "more"])
    for i in range(240):
        words = ["w%d" % rng.randrange(9000) for _ in range(rng.randrange(60, 400))]
        texts[len(texts)] = " ".join(words)
        drop = int(len(words) * (0.1 + 0.2 * i / 240))
        texts[len(texts)] = " ".join(words[: len(words) - drop])
    for i in range(20):  # 0.8 exactly, and just below
        words = ["v%d" % rng.randrange(9000) for _ in range(104)]
        texts[len(texts)] = " ".join(words)
        texts[len(texts)] = " ".join(words[: 84 - i % 2])
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id for r in nearcopies.representatives(df).collect()} == plain_groups(texts)


# --- lines -----------------------------------------------------------------------------------------------------------


def plain_lines(rows, least=10):
    strip, lower = " \t\n\x0b\x0c\r", lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s)
    key = lambda line: lower(line.strip(strip))
    owners = collections.defaultdict(set)
    last = (1 << 63) - 1
    for i, t in rows:
        for line in (t or "").split("\n"):
            owners[key(line)].add(last if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        own = last if i is None else i
        kept = [x for x in lines if len(key(x)) < least or min(owners[key(x)]) == own]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=lambda r: (r[0] is None, r[0], r[3]))


@pytest.mark.parametrize("batches,fanout", [(1, 2), (4, 2), (5, 3)])
def test_line_dedup(spark, batches, fanout):
    rng = random.Random(batches)
    pool = ["The same line here", "  the SAME line here\t", "short", "ééééééééé", "éééééééééé", "", "another long enough line", "x" * 500]
    rows = [(rng.randrange(40), "\n".join(rng.choice(pool + [str(rng.random())]) for _ in range(rng.randrange(0, 9)))) for _ in range(60)]
    rows += [(None, "The same line here\nother"), (100, None), (101, ""), (-4, "another long enough line")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("keys", F.lit(1))
    got = linededup.dedup_lines(df, batches=batches, fanout=fanout).collect()
    mine = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got), key=lambda r: (r[0] is None, r[0], r[3]))
    assert mine == plain_lines(rows)
    assert all(r.kept_sha256 == hashlib.sha256(r.kept.encode()).hexdigest() for r in got)
    assert linededup.dedup_lines(df.limit(0)).collect() == []


def test_runs_meet_without_exchange(spark):
    """Plans of compaction and of a batch against runs: only the batch is dealt out."""
    frame = lambda lo, hi: spark.range(lo, hi).select(F.xxhash64("id").alias("hi"), F.xxhash64("id", F.lit(1)).alias("lo"), F.col("id").alias("owner"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    runs = linededup.Runs(3)
    with linededup.sorted_buckets(spark):
        a, b = (linededup.write_run(frame(*ids).groupBy("hi", "lo").agg(F.min("owner").alias("owner"))) for ids in ((0, 500), (500, 900)))
        both = linededup.merged(a, b)
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan
        assert sorted(map(tuple, both.collect())) == sorted(map(tuple, frame(0, 900).collect()))
        for r in (a, b):
            runs.add(r)
        unseen = runs.unseen(frame(850, 950).groupBy("hi", "lo").agg(F.min("owner").alias("owner")))
        assert unseen._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1 and unseen.count() == 50
        runs.add(linededup.write_run(unseen))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert [len(level) for level in runs.levels] == [0, 1] and runs.all()[0].count() == 950
    linededup.drop_run(runs.all()[0])


def test_hot_lines_are_settled_apart(spark, monkeypatch):
    monkeypatch.setattr(linededup, "HOT", 20)
    rows = [(i, "the line that all have\nanother that half have" if i % 2 else f"the line that all have\nown line number {i}") for i in range(200)] + [(3, "The line that all have")]
    got = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), batches=3).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got), key=lambda r: (r[0], r[3])) == plain_lines(rows)


def test_batches_by_bytes(spark, monkeypatch):
    df = spark.createDataFrame([(i, "x" * 100) for i in range(1000)], "doc_id long, text string")
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(linededup, "BATCH_BYTES", 25_000 // cores)
    assert linededup.batch_cuts(df, "doc_id", "text", None) == [249, 499, 749] and linededup.batch_cuts(df.limit(0), "doc_id", "text", None) == []


def test_replace_texts_keeps_columns(spark):
    df = spark.createDataFrame([(1, "a line of text\nx", "en", 99), (2, "A line of text\ny", None, 99), (3, None, "en", 99)], "doc_id long, text string, lang string, n_chars long")
    got = sorted(linededup.replace_texts(df).collect(), key=lambda r: r.doc_id)
    assert [tuple(r) for r in got] == [(1, "a line of text\nx", "en", 16), (2, "y", None, 1), (3, None, "en", None)]


# --- media -----------------------------------------------------------------------------------------------------------


def test_media(spark, odd):
    got = media.media_columns(odd).collect()
    assert len(got) == len(ODD)
    for r in got:
        text = {i: t or "" for i, t, _ in ODD}[r.doc_id].encode()
        payload = text + b"\0" * (-len(text) % 64 or 64 * (not text))
        assert (r.n_bytes, r.payload_bytes, r.tail_crc32) == (len(text), len(payload), zlib.crc32(payload[-64:]))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and media.read_wav(bytes(r.media)) == payload
        assert (r.media_bytes, r.media_sha256) == (len(r.media), hashlib.sha256(r.media).hexdigest())
        assert len(r.times) == len(r.codes) and r.times == sorted(r.times)


def test_peaks_of_tones():
    t = np.arange(256 * 40)
    on = (t // 256) % 4 < 1
    wave = np.where(on, np.sin(2 * np.pi * 20 * t / 256) * 100, 0) + 128
    frame, tone = media.spectral_peaks(wave.astype(np.uint8).tobytes())
    assert set(tone[(tone > 12) & (tone < 40)]) <= {19, 20, 21} and set(frame % 4) == {0}
    times, codes = media.landmarks(wave.astype(np.uint8).tobytes())
    assert len(times) and ((codes & 255) == 4).any()


@pytest.mark.parametrize("at", [0, 224, 384])
def test_every_part_of_a_payload_counts(at):
    """Payloads of 448 bytes that differ in 64 only: the first ones, those around a window's border, the last ones."""
    rng = np.random.default_rng(at)
    one = rng.integers(97, 123, 448, dtype=np.uint8)
    other = one.copy()
    other[at : at + 64] = 128 + 100 * np.sin(2 * np.pi * np.arange(64) / 4)
    (f, tone), (g, other_tone) = (media.spectral_peaks(x.tobytes()) for x in (one, other))
    assert 64 in other_tone and (f.tolist(), tone.tolist()) != (g.tolist(), other_tone.tolist())


def test_short_bursts_anywhere_give_peaks():
    for n in (64, 448, 1000):
        peaks = [media.spectral_peaks(np.where(np.arange(n) // 8 == i // 8, 128 + 100 * (-1) ** np.arange(n), 128).astype(np.uint8).tobytes()) for i in range(0, n, 8)]
        assert all(len(f) for f, _ in peaks)


def plain_landmarks(samples):
    """Frame by frame and peak by peak."""
    w, h = 256, 128
    x = [128] * h + list(samples)
    x += [128] * (-len(x) % h) + [128] * h
    level = []
    for i in range(0, len(x) - w + 1, h):
        level.append(np.abs(np.fft.rfft((np.array(x[i : i + w], np.float32) - 128) * np.hanning(w).astype(np.float32))).astype(np.float32))
    peaks = []
    for i, power in enumerate(level):
        for band, (lo, hi) in enumerate([(2, 12), (12, 40), (40, 129)]):
            top = [max(level[k][lo:hi]) if 0 <= k < len(level) else 0 for k in (i - 1, i, i + 1)]
            if top[1] > 2 * power[2:].mean() and top[1] >= top[0] and top[1] > top[2]:
                peaks.append((i - 1, lo + int(power[lo:hi].argmax())))
    pairs = []
    for k, (f, tone) in enumerate(peaks):
        for g, other in peaks[k + 1 : k + 1 + 5]:
            if f < g <= f + 16:
                pairs.append((f, ((g - f) % 2 << 24) + tone * 65536 + other * 256 + (g - f) // 2))
    return sorted(pairs)


def test_landmarks_against_a_plain_version(monkeypatch):
    rng = np.random.default_rng(3)
    payloads = [b"\0" * 64, b"a" * 640, "Ein Satz, noch einer. ".encode() * 40, rng.integers(32, 127, 4032, dtype=np.uint8).tobytes(), rng.integers(0, 256, 1984, dtype=np.uint8).tobytes()]
    expected = [plain_landmarks(media.pad(p)) for p in payloads]
    for block in (4096, 3):
        monkeypatch.setattr(media, "BLOCK", block)
        assert [list(zip(*(x.tolist() for x in media.landmarks(media.pad(p))))) for p in payloads] == expected
    assert any(expected)


# --- decontamination -------------------------------------------------------------------------------------------------


def plain_leaks(docs, items, least=0.8, k=5):
    words = lambda t: re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().lower())
    shingles = lambda w: collections.Counter(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1)))
    out = {}
    for i, t in docs:
        w = words(t)
        for item, own in items:
            v = words(own)
            if not v or not w:
                continue
            n = min(len(v), len(w))
            theirs = shingles(v)
            for a in range(len(w) - n + 1):
                mine = shingles(w[a : a + n])
                both = (mine & theirs).total()
                sim = both / (mine.total() + theirs.total() - both)
                if sim >= least and (i, item) not in out or sim > out.get((i, item), (2,))[0]:
                    out[i, item] = (sim, a)
    return out


def test_leaks(spark):
    rng = random.Random(8)
    word = lambda: "w%d" % rng.randrange(3000)
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 5, 6, 17, 40, 60])))) for i in range(30)] + [(50, None), (51, ""), (52, "the the the the the the the the")]
    docs = []
    for i in range(90):
        own = [word() for _ in range(rng.randrange(0, 80))]
        passage = (items[rng.randrange(30)][1] or "").split()
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            passage[rng.randrange(len(passage))] = "changed"
        at = rng.randrange(len(own) + 1)
        docs.append((i, " ".join(own[:at]) + ", " + " ".join(passage).capitalize() + ". " + " ".join(own[at:])))
    docs += [(100, None), (101, ""), (102, "the " * 400), (103, items[6][1]), (103, items[6][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = plain_leaks(docs, items)
    got = {(r.doc_id, r.item_id): (r.similarity, r.first_word) for r in decontaminate.find_leaks(df, bench).collect()}
    assert got == expected and len(expected) > 20
    clean = {r.doc_id for r in decontaminate.decontaminate(df, bench).collect()}
    assert clean == {i for i, _ in docs} - {i for i, _ in expected}
    assert decontaminate.find_leaks(df, bench.limit(0)).collect() == [] and decontaminate.find_leaks(df.limit(0), bench).collect() == []


def test_leaks_in_parts(spark, monkeypatch):
    bench = spark.createDataFrame([(1, "one two three four five six"), (2, "seven eight nine ten eleven twelve")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x one two three four five six"), (2, "seven eight nine ten eleven twelve y"), (3, "none")], "doc_id long, text string")
    monkeypatch.setattr(decontaminate, "PART_CHARS", 10)
    parts = list(decontaminate.parts_of(bench, "item_id", "text", 10))
    assert [len(p) for p in parts] == [1, 1]
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect()) == [(1, 1), (2, 2)]


def test_hamming_blocks_find_all_in_the_radius():
    rng = np.random.default_rng(4)
    own = rng.integers(0, 1 << 63, 50, dtype=np.uint64)
    probes = own[rng.integers(0, 50, 400)].copy()
    for p in range(400):
        for b in rng.permutation(64)[: rng.integers(0, 25)]:
            probes[p] ^= np.uint64(1) << np.uint64(b)
    for one in own:
        at, d = decontaminate.HammingBlocks(20).near(one, probes)
        near = np.bitwise_count(probes ^ one)
        assert at.tolist() == np.flatnonzero(near <= 20).tolist() and d.tolist() == near[at].tolist()


def test_shingles_that_all_items_share_lead_to_few(spark):
    """Items with a common beginning: texts that hold it meet no item by it, and leaks are found all the same."""
    rng = random.Random(3)
    common_part = " ".join("c%d" % i for i in range(12))
    items = [(i, (common_part + " " + " ".join("w%d" % rng.randrange(9000) for _ in range(40))).encode()) for i in range(200)]
    compiled = decontaminate.Benchmark(items)
    leads = compiled.leads[5]
    shared = common.shingle_hashes(common.WordHashes().of(common_part.encode().split()), 5)
    assert leads.hits(shared) == {} and len(pickle.dumps(compiled)) < 60 * 52 * 200
    assert compiled.matches(common_part.encode() + b" and more words that follow", common.WordHashes()) == []
    assert [m[0] for m in compiled.matches(b"x y " + items[7][1] + b" z", common.WordHashes())] == [7]


def test_windows_in_pieces(monkeypatch):
    """A text of one word over and over, and windows fingerprinted a few at a time."""
    items = [(0, b"the " * 30), (1, b"a b c d e f g h")]
    text = b"the " * 500 + b"a b c d e f g h " + b"the " * 29
    whole = decontaminate.Benchmark(items).matches(text, common.WordHashes())
    monkeypatch.setattr(decontaminate, "TOGETHER", 7)
    assert decontaminate.Benchmark(items).matches(text, common.WordHashes()) == whole
    assert [(m[0], m[1], m[3]) for m in whole] == [(0, 0, 1.0), (1, 500, 1.0)]


# --- quality ---------------------------------------------------------------------------------------------------------


def test_quality(spark):
    rng = random.Random(9)
    good = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "of", "the"]) for _ in range(80)) + "."
    bad = lambda: " ".join(rng.choice(["BUY", "NOW", "$$$", "!!!"]) for _ in range(80))
    rows = [(i, bad() if i % 3 == 0 else good(), "x") for i in range(300)] + [(1000 + k, t, s) for k, (_, t, s) in enumerate(ODD)] + [(None, "the", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(300)] + [(None, 1, 0), (5000, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.score_quality(df, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    assert np.mean([r.predicted == (r.doc_id % 3 != 0) for r in held]) > 0.95
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.predicted}
    none = quality.score_quality(df, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and quality.score_quality(df.limit(0), labels).collect() == []


def test_labels_that_repeat(spark):
    """One id with most of the labels, and one with most of the rows: the sample keeps all others."""
    rng = random.Random(9)
    text = lambda i: " ".join(rng.choice(["BUY", "$$$"] if i % 2 else ["alpha", "of"]) for _ in range(40))
    free = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 != 1]
    for hot in free[:2]:
        labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in free], "doc_id long, quality int")
        labels = labels.union(spark.range(50_000).select(F.lit(hot), F.lit(int(hot % 2 == 0))))
        for most in (20, 60):
            chosen = quality.chosen_labels(labels, "doc_id", "quality", most)
            assert chosen.count() == most == chosen.distinct().count()
        docs = spark.createDataFrame([(i, text(i)) for i in range(200)], "doc_id long, text string")
        docs = docs.union(spark.range(3000).select(F.lit(hot), F.lit("alpha of the")))
        scores = {r.doc_id: r.predicted for r in quality.score_quality(docs, labels, sample=100).collect() if r.doc_id != hot}
        assert np.mean([p == (i % 2 == 0) for i, p in scores.items()]) > 0.95


def test_samples_have_the_smallest_hashes(spark):
    df = spark.range(5000).select((F.col("id") % 1000).alias("a"))
    got = {r.a for r in common.bounded_sample(df, ["a"], 50).collect()}
    every = df.distinct().select("a", F.shiftrightunsigned(F.xxhash64("a"), 2).alias("h")).orderBy("h").limit(50)
    assert got == {r.a for r in every.collect()} and common.bounded_sample(df, ["a"], 5000).count() == 1000


def test_models_learn_interactions():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    assert ((AdditiveModel.fit(x[:3000], y[:3000], pairs=1).predict(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.85
    y = ((x[:, 0] > 0.3) & (x[:, 1] > 0.6)).astype(float)
    trees = BoostedTrees.fit(x[:3000], y[:3000])
    assert ((trees.predict(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.97
    assert BoostedTrees.fit(x[:0], y[:0]).predict(x[:2]).tolist() == [0.5, 0.5]
