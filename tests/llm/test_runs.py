"""Periodic runs against trying every period of every text."""

import hashlib
import random

import numpy as np
import pytest

from folioforge.llm import catalog, runs


def plain_runs(words, least):
    """Stretches of each period from the shortest on; one that a shorter period has is not its own."""
    n, out = len(words), []
    for period in range(1, n):
        i = 0
        while i + period < n:
            start = i
            while i + period < n and words[i] == words[i + period]:
                i += 1
            if i > start and i + period - start >= max(least, 2 * period):
                out.append((start, i + period - start, period))
            i += 1
    whole = lambda s, n, q: all(words[k] == words[k + q] for k in range(s, s + n - q))
    return sorted(r for r in out if not any(whole(r[0], r[1], q) for q in range(1, r[2])))


@pytest.mark.parametrize("kinds", [1, 2, 3, 6])
@pytest.mark.parametrize("least", [2, 5, 12])
def test_all_runs_are_found(kinds, least):
    rng = random.Random(kinds * 100 + least)
    for _ in range(300):
        words = [rng.randrange(kinds) for _ in range(rng.randrange(60))]
        if rng.random() < 0.5:
            period = rng.randrange(1, 12)
            words = words[:5] + [words[5 + i % period] if 5 + i % period < len(words) else 0 for i in range(max(0, len(words) - 8))] + words[-3:]
        assert runs.find_runs(np.array(words, np.int64), least) == plain_runs(words, least)


def test_texts_on_which_hashes_collide():
    """Thue-Morse words of that length have equal polynomials modulo 2^64 whatever the base."""
    word = [0]
    while len(word) < 4096:
        word += [1 - x for x in word]
    lce = runs.Extensions(np.array(word))
    assert lce.alike(0, 2048, 2048) and lce.ahead(0, 2048) == 0
    other = [0, 1] * 3 + word[:1024]
    assert runs.find_runs(np.array(other), 12) == plain_runs(other, 12)


def test_long_repeats_and_long_texts():
    assert runs.find_runs(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]
    assert runs.find_runs(np.arange(3_000_000) % 99_991) == [(0, 3_000_000, 99_991)]
    assert runs.find_runs(np.arange(3_000_000)) == []


ODD = [(1, None, 1), (2, "", 2), (3, " \n\t\x0b", 3), (4, "a " * 30, 4), (4, "a " * 30, 4), (None, "x y " * 9, 5), (6, "é　b " * 12, 6), (7, "one", 7)]


def test_digests_and_edges(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string, runs long")
    rows = runs.periodic_runs(df).collect()
    assert sorted(((r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.collapsed) for r in rows), key=str) == sorted(
        [(1, 0, None, None, None, None, ""), (2, 0, None, None, None, None, ""), (3, 0, None, None, None, None, ""), (4, 1, 0, 30, 1, 30000, "a"), (4, 1, 0, 30, 1, 30000, "a"), (None, 1, 0, 18, 2, 9000, "x y"), (6, 1, 0, 12, 1, 12000, "é　b"), (7, 0, None, None, None, None, "one")],
        key=str,
    )
    for r in rows:
        assert r.collapsed_sha256 == hashlib.sha256(r.collapsed.encode()).hexdigest()
        assert r.runs_sha256 == hashlib.sha256("".join(f"{x.start},{x.length},{x.period}\n" for x in r.runs).encode()).hexdigest()
    assert runs.periodic_runs(df.limit(0)).count() == 0


def test_query_against_all_periods(spark):
    """The registered query over its whole smallest table; texts over 400 words are left to the tests above."""
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in catalog.QUERIES["op11_runs"](spark, sf).collect():
        words = catalog.planted_period(r.doc_id, texts[r.doc_id].split())
        if len(words) > 400:
            continue
        found = plain_runs(words, 12)
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        gone = {k for s, n, q in found for k in range(s + q, s + n)}
        assert (r.n_runs, (r.start, r.length, r.period)) == (len(found), best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert r.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest()
