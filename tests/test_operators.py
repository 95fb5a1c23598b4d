"""Goldens and properties of the operators."""

import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioforge.operators import box_batches as shape
from folioforge.operators import align, boxes, chunking, examine, glossary, models, ngrams, repeats, windows
from folioforge.operators import corpus_stats as cs


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def sized(spark, sizes):
    return spark.createDataFrame([("d", i, str(i), n) for i, n in enumerate(sizes)], "doc string, pos int, text string, n int")


def test_look_back(spark):
    got = windows.look_back(sized(spark, [2, 3, 4, 1]), ["doc"], "pos", "text", F.col("n"), 5)
    assert [r.context for r in got.orderBy("pos").collect()] == ["", "0", "1", "2"] or [r.context for r in got.orderBy("pos").collect()] == ["", "0", "01", "2"]


@pytest.mark.parametrize("sizes", [[2, 3, 4, 1], [9, 1], [1] * 9, [5, 5, 5]])
@pytest.mark.parametrize("budget", [3, 5, 8])
def test_windows_against_loops(spark, sizes, budget):
    n = len(sizes)

    def back(i):
        out, used = [], 0
        for j in range(i - 1, -1, -1):
            if used + sizes[j] > budget:
                break
            out, used = [str(j), *out], used + sizes[j]
        return "".join(out)

    def ahead(i):
        out, used = [str(i)], sizes[i]
        for j in range(i + 1, n):
            if used + sizes[j] > budget:
                break
            out, used = [*out, str(j)], used + sizes[j]
        return "".join(out)

    def ending(i):
        out, used = [str(i)], sizes[i]
        for j in range(i - 1, -1, -1):
            if used + sizes[j] > budget:
                break
            out, used = [str(j), *out], used + sizes[j]
        return "".join(out)

    df = sized(spark, sizes)
    args = (["doc"], "pos", "text", F.col("n"), budget)
    assert [r.context for r in windows.look_back(df, *args).orderBy("pos").collect()] == [back(i) for i in range(n)]
    assert [r.lookahead for r in windows.look_ahead(df, *args).orderBy("pos").collect()] == [ahead(i) for i in range(n)]
    assert [r.context for r in windows.char_context(df, *args).orderBy("pos").collect()] == [ending(i) for i in range(n)]


def test_moving_mean_and_shares(spark):
    df = spark.createDataFrame([("d", i, float(v)) for i, v in enumerate([1, 2, 3, 4])], "doc string, pos int, v double")
    assert [r.forward_mean for r in windows.forward_mean(df, ["doc"], "pos", "v").orderBy("pos").collect()] == [2, 3, 3.5, 4]
    shares = spark.createDataFrame([("d", 1.0), ("d", 1.0), ("d", 2.0)], "doc string, v double")
    assert sorted(r.proportion for r in windows.proportions(shares, ["doc"], "v").collect()) == [0.25, 0.25, 0.5]


def test_align_lines(spark):
    df = spark.createDataFrame([(0, "a\nb", "x\ny\nz"), (1, "a\nb\nc", "x")], "i int, jp string, tw string")
    assert rows(align.align_lines(df, "i", "jp", "tw")) == [(0, 0, "a", "x"), (0, 1, "b", "y"), (0, 2, "", "z"), (1, 0, "a", "x"), (1, 1, "b", ""), (1, 2, "c", "")]


@pytest.mark.parametrize("chunks,tw,parts,flag", [(["a\nb\n", "c"], "1\n2\n3\n4", ["1\n2\n3", "4"], False), (["a", "b"], "1", ["1", ""], True), (["a\nb", "c"], "1\n2\n3\n4", ["1\n2", "3\n4"], False)])
def test_align_slices(spark, chunks, tw, parts, flag):
    left = spark.createDataFrame([(0, k, c) for k, c in enumerate(chunks)], "i int, k int, jp string")
    right = spark.createDataFrame([(0, tw)], "i int, tw string")
    got = align.count_alignment(align.align_slices(left, right, "i", "k", "jp", "tw"), "i", "k").orderBy("k").collect()
    assert "\n".join(r.tw for r in got).rstrip("\n") == tw
    if chunks[0] != "a\nb\n":
        assert [r.tw for r in got] == parts and {r.jp_tw_count_alignment for r in got} == {flag}


def test_keyword_priority(spark):
    df = spark.createDataFrame([("img1", "DM5 拷貝漫畫"), ("img2", "none")], "img string, text string")
    hits = cs.keyword_hits(df, "img", "text", cs.DROP_KEYWORDS)
    assert sorted(r.keyword for r in hits.collect()) == ["DM5", "拷貝", "拷貝漫畫"]
    assert [r.keyword for r in cs.keyword_priority(hits, "img").collect()] == ["拷貝漫畫"]
    assert dict(tuple(r) for r in cs.keyword_counts(hits, "img").collect()) == {"DM5": 0, "拷貝": 0, "拷貝漫畫": 1, "total": 1}


def test_mode_and_ngrams(spark):
    df = spark.createDataFrame([("d", i, v) for i, v in enumerate([3, 1, 3, 1, 2])], "doc string, pos int, v int")
    assert [(r["mode"], r.n) for r in cs.first_mode(df, ["doc"], "v", ["pos"]).collect()] == [(3, 2)]
    text = spark.createDataFrame([(0, "ababa"), (1, "a"), (2, None)], "k int, text string")
    assert rows(cs.ngram_counts(text, "k", "text", 2)) == [(0, "ab", 2), (0, "ba", 2)]


def test_later_occurrences_keeps_null_texts_together(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "a"), (5, "b")], "k int, text string")
    assert sorted(r.k for r in cs.later_occurrences(df, F.col("text"), "k").collect()) == [2, 4]


def test_repeats():
    assert repeats.repeated_content("abcdefg" * 4)["abcdefg"] == 4
    assert repeats.repeated_content("") == {}
    assert repeats.repeated_content("(((((((((((((((((((((((", min_len=5) != {}
    assert repeats.repeated_content("no repeats here") == {}


def test_examine(spark):
    base = dict(jp=F.lit("a。"), translation=F.lit("b。"), sim_jp=F.lit(0.0), sim_tr=F.lit(1.0))
    cases = [({"tw": F.lit("※c。")}, "True_匹配"), ({"tw": F.lit("c。")}, "False"), ({"tw": F.lit("c！"), "sim_jp": F.lit(0.06)}, "True_尾字不同"), ({"tw": F.lit("c。"), "sim_jp": F.lit(0.2)}, "True_小於"), ({"tw": F.lit("")}, "False")]
    for change, expected in cases:
        assert spark.range(1).select(examine.examine(**(base | change)).alias("x")).first().x == expected


def test_chunk_properties():
    rng = random.Random(4)
    for _ in range(60):
        sentences = ["x" * rng.randrange(1, 40) for _ in range(rng.randrange(1, 40))]
        sizes, values = list(map(len, sentences)), [rng.random() for _ in sentences]
        parts = chunking.bisect(sentences, values, sizes, 60)
        assert [i for p in parts for i in p] == list(range(len(sentences)))
        assert all(sum(sizes[i] for i in p) <= 60 or len(p) == 1 for p in parts)
        merged = chunking.merge_small(["".join(sentences[i] for i in p) for p in parts], [sum(sizes[i] for i in p) for p in parts], 60, lambda a, b: len(a) - len(b))
        assert "".join(merged) == "".join(sentences)
        assert all(len(m) <= 60 or m in sentences for m in merged)
        cut = chunking.threshold_chunks(sentences, values, budget=60)
        assert "".join(cut) == "".join(sentences)
        folded = chunking.semantic_fold(sentences, lambda a, b: rng.random())
        assert "".join(folded) == "".join(sentences)


def plain_bisect(values, sizes, budget, window, at=0):
    if sum(sizes) <= budget or len(sizes) < 2:
        return [list(range(at, at + len(sizes)))]
    means = [np.mean(values[i : i + window]) for i in range(len(values))]
    cut = min(range(1, len(values)), key=lambda i: (means[i], i))
    return plain_bisect(values[:cut], sizes[:cut], budget, window, at) + plain_bisect(values[cut:], sizes[cut:], budget, window, at + cut)


def plain_merge(chunks, sizes, budget, similarity, only_if_both):
    """Looks for the smallest chunk with a partner among all chunks, joins it and looks again."""
    chunks, sizes = list(chunks), list(sizes)
    while True:
        for i in sorted(range(len(chunks)), key=lambda i: (sizes[i], i)):
            near = [k for k in (i - 1, i + 1) if 0 <= k < len(chunks)]
            fit = [k for k in near if sizes[i] + sizes[k] <= budget]
            if len(near) == 2 and not (only_if_both and len(fit) < 2):
                best = i - 1 if similarity(chunks[i], chunks[i - 1]) > similarity(chunks[i], chunks[i + 1]) else i + 1
                fit = [k for k in fit if k == best]
            if fit:
                left = min(i, fit[0])
                chunks[left : left + 2] = ["".join(chunks[left : left + 2])]
                sizes[left : left + 2] = [sum(sizes[left : left + 2])]
                break
        else:
            return chunks


def test_chunking_against_plain_versions():
    rng, embedder = random.Random(8), models.HashedEmbedder()
    same = chunking.similarity_of(embedder)
    for trial in range(120):
        texts = ["".join(rng.choice("ab c。") for _ in range(rng.randrange(1, 12))) for _ in range(rng.randrange(30))]
        sizes, values = list(map(len, texts)), [rng.randrange(4) / 7 if trial % 2 else rng.random() for _ in texts]
        for window in (1, 3):
            assert chunking.bisect(texts, values, sizes, 20, window) == plain_bisect(values, sizes, 20, window)
        for both in (False, True):
            assert chunking.merge_small(texts, sizes, 20, same, both) == plain_merge(texts, sizes, 20, same, both)
        assert chunking.embedded_fold(texts, embedder, 0.3) == chunking.semantic_fold(texts, same, 0.3)
        for text in texts:
            assert np.array_equal(embedder.vector(embedder.extend(text[3:], embedder.extend(text[:3]))), embedder.embed([text])[0])


def plain_repeats(text, least=5, most=64, times=3):
    found, at = {}, 0
    while at < len(text):
        seen = [text.count(text[at : at + n]) for n in range(least, min(most, len(text) - at) + 1)]
        fall = next((k for k in range(1, len(seen)) if seen[k] < seen[k - 1]), None)
        if fall is not None:
            if seen[0] >= times:
                pattern = text[at : at + least + fall - 1]
                found[pattern] = max(seen[0], found.get(pattern, 0))
            at += least + fall
            continue
        if seen and seen[0] >= times and len(text) - at < most:
            found[text[at:]] = max(seen[0], found.get(text[at:], 0))
        at += 1
    return found


def test_repeats_against_counting():
    rng = random.Random(9)
    for kinds in (1, 2, 3, 30):
        for _ in range(15):
            word = "".join(chr(97 + rng.randrange(kinds)) for _ in range(rng.randrange(1, 40)))
            text = "".join(chr(97 + rng.randrange(kinds)) for _ in range(rng.randrange(200))) + word * rng.randrange(6) + "é𝒳" * rng.randrange(9)
            assert repeats.repeated_content(text) == plain_repeats(text)
            assert repeats.repeated_content(text, 2, 6) == plain_repeats(text, 2, 6)


def test_long_documents_cost_in_proportion():
    """A million characters; what grows with the square of that takes hours."""
    rng = random.Random(10)
    words = ["".join(rng.choice("abcdefghijklmno") for _ in range(rng.randrange(2, 9))) for _ in range(2000)]
    text = " ".join(rng.choice(words) for _ in range(170_000))
    parts = [text[i : i + 30] for i in range(0, len(text), 30)]
    sizes, embedder = list(map(len, parts)), models.HashedEmbedder()
    began = time.perf_counter()
    assert repeats.repeated_content(text)
    assert repeats.repeated_content("a" * 1_000_000)
    for values in ([rng.random() for _ in parts], [float(i) for i in range(len(parts))]):
        assert sum(map(len, chunking.bisect(parts, values, sizes, 1280))) == len(parts)
    assert "".join(chunking.merge_small(parts, sizes, 1280, chunking.similarity_of(embedder))) == text
    assert chunking.embedded_fold(parts, embedder, -1.0) == [text]
    assert time.perf_counter() - began < 120


def test_truncation():
    assert chunking.truncate_tokens(list("ab。cd"), 4) == "。cd"
    assert chunking.truncate_tokens(list("ab。cd"), 4, discard=True) == "cd"
    assert chunking.truncate_tokens(list("ab。cd"), 4, reverse=True) == "ab。"
    assert chunking.truncate_tokens(list("abcd"), 2) == "cd"
    assert chunking.truncate_tokens(list("abcd"), 0) == ""


def test_chunk_operators_run_grouped(spark):
    df = spark.createDataFrame([(d, i, f"s{d}.{i} " * 5, 0.5) for d in range(3) for i in range(6)], "doc int, pos int, text string, v double")
    whole = {d: "".join(f"s{d}.{i} " * 5 for i in range(6)) for d in range(3)}
    for out in (chunking.bisect_chunks(df, ["doc"], "pos", "text", "v", 60), chunking.merge_small_chunks(df, ["doc"], "pos", "text", 60), chunking.semantic_chunks(df, ["doc"], "pos", "text"), chunking.rechunk_decay(df, ["doc"], "pos", "text", "v")):
        got = {}
        for r in out.orderBy("doc", "chunk_idx").collect():
            got[r.doc] = got.get(r.doc, "") + r.chunk
        assert got == whole
    scores = chunking.similarity_distribution(df, ["doc"], "pos", "text", 64, 16).orderBy("doc", "pos").collect()
    assert len(scores) == 18 and all(r.similarity == 1.0 for r in scores if r.pos == 0)
    loss = chunking.perplexity_distribution(df, ["doc"], "pos", "text").collect()
    assert all((r.perplexity == 0.0) == (r.pos == 0) for r in loss)


def test_boxes(spark):
    sq = lambda x, y, s: [{"x": float(x + a * s), "y": float(y + b * s)} for a, b in ((0, 0), (1, 0), (1, 1), (0, 1))]
    df = spark.createDataFrame(
        [("p", 0, 0.9, sq(0, 0, 2), 100.0, 100.0), ("p", 1, 0.9, sq(1, 1, 2), 100.0, 100.0), ("p", 2, 0.9, sq(50, 50, 2), 100.0, 100.0), ("p", 3, 0.1, sq(2, 2, 60), 100.0, 100.0)],
        f"page string, box int, score double, poly {boxes.QUAD}, width double, height double",
    )
    got = boxes.merge_boxes(df, "page", "box", "poly", "score").orderBy("group").collect()
    assert [(r.group, r.n_boxes) for r in got] == [(0, 2), (2, 1)]
    quad = np.array([(p.x, p.y) for p in got[0].quad])
    assert tuple(quad.min(0)) <= (0, 0) and tuple(quad.max(0)) >= (3, 3)


def _turned(rng, n, far, pages=3):
    """Turned rectangles of very different sizes, some of them points, lines and copies."""
    out = []
    for i in range(n):
        w, h, a, x, y = rng.choice([0, 1, 3, 40]), rng.choice([1, 2, 30]), rng.choice([0, 0.3, 1.2]), rng.uniform(-far, far), rng.uniform(-far, far)
        turn = lambda u, v: {"x": x + u * math.cos(a) - v * math.sin(a), "y": y + u * math.sin(a) + v * math.cos(a)}  # noqa: E731, B023
        out.append((f"p{i % pages}", i, [turn(0, 0), turn(w, 0), turn(w, h), turn(0, h)] if rng.random() < 0.9 or not out else out[-1][2]))
    return out


@pytest.mark.parametrize("threshold", [0.0, 1.5])
def test_tiles_find_what_all_pairs_find(spark, threshold):
    made = _turned(random.Random(4), 150, 60) + [("p0", 900, None), ("p1", 901, [{"x": float("nan"), "y": 0.0}]), (None, 902, [{"x": 0.0, "y": 0.0}])]
    df = spark.createDataFrame(made, f"page string, box int, poly {boxes.QUAD}")
    tiled, whole = (rows(boxes.overlapping_pairs(df, "page", "box", "poly", threshold, small)) for small in (0, 1000))
    plain = [(p, i, j) for p, i, a in made for q, j, b in made if p and p == q and i < j and j < 900 and boxes.overlap([(v["x"], v["y"]) for v in a], [(v["x"], v["y"]) for v in b], threshold)]
    assert len(plain) > 80
    assert tiled == whole
    # polygons without width overlap all along their line in the plain test
    flat = {i for _, i, a in made if a and len({(v["x"], v["y"]) for v in a}) < 3}
    assert [r for r in tiled if not {r[1], r[2]} & flat] == sorted(r for r in plain if not {r[1], r[2]} & flat)


@pytest.mark.parametrize("local", [0, 100_000])
def test_large_pages_are_merged_alike(spark, monkeypatch, local):
    monkeypatch.setattr(boxes, "LOCAL_PAIRS", local)
    made = [(p, i, q, 200.0, 150.0) for p, i, q in _turned(random.Random(6), 120, 70) if len({(v["x"], v["y"]) for v in q}) == 4]
    df = spark.createDataFrame(made, f"page string, box int, poly {boxes.QUAD}, width double, height double")
    spread, local = (sorted((r.page, r.group, r.n_boxes, [(round(p.x, 9), round(p.y, 9)) for p in r.quad]) for r in boxes.merge_boxes(df, "page", "box", "poly", small_page=small).collect()) for small in (0, 1000))
    assert spread == local and any(r[2] > 3 for r in spread)


def test_a_page_of_many_boxes_costs_what_it_finds(spark):
    """100,000 boxes of one page: candidates stay near the overlaps among them."""
    n = spark.range(100_000).select(F.lit("p").alias("page"), "id", (F.col("id") % 400 * 10.0).alias("x"), (F.floor(F.col("id") / 400) * 10.0).alias("y"))
    df = n.select("page", "id", boxes.quad_column(F.col("x"), F.col("y"), F.lit(9.0) + F.col("id") % 3, F.lit(8.0)).alias("poly"))
    candidates = boxes.candidate_pairs(df, "page", "id", "poly").count()
    hits = boxes.overlapping_pairs(df, "page", "id", "poly").count()
    assert hits > 50_000 and candidates <= 1.1 * hits


@pytest.mark.parametrize("part_chars", [1, 4, 10**6])
def test_glossary_in_any_number_of_parts(spark, part_chars):
    entries = spark.createDataFrame(
        [(0, "A", "X", "i", ["foo", "zz"]), (1, "B", "Y", "", ["q", None, ""]), (2, "C", "Z", "", ["none"]), (0, "A", "X", "i", ["foo", "zz"]), (0, "D", "W", "", ["oo"]), (5, "E", "", "", None)],
        "entry int, jp string, tw string, info string, match array<string>",
    )
    texts = spark.createDataFrame([(1, "a foo q"), (2, "zz"), (3, ""), (4, None), (2, "zz")], "k int, text string")
    found = rows(glossary.match_glossary(texts, "text", entries, ["k"], part_chars).select("k", "entry", "jp"))
    assert found == sorted([(1, 0, "A"), (1, 0, "A"), (1, 0, "D"), (1, 1, "B")] + [(2, 0, "A")] * 4)
    assert glossary.match_glossary(texts, "text", entries.limit(0), ["k"], part_chars).count() == 0


def test_glossary_prompts(spark):
    entries = spark.createDataFrame([(0, "A", "X", "i", ["foo", "zz"]), (1, "B", "Y", "", ["q"]), (2, "C", "Z", "", ["none"])], "entry int, jp string, tw string, info string, match array<string>")
    texts = spark.createDataFrame([(1, "a foo q"), (2, "zz"), (3, ""), (4, None)], "k int, text string")
    prompts = glossary.glossary_prompts(glossary.match_glossary(texts, "text", entries, ["k"]), ["k"])
    assert rows(prompts)[0] == (1, "A->X #i\nB->Y", 2)


def test_models_and_regeneration(spark):
    v = models.HashedEmbedder().embed(["abc", "abc", "", "xyz"])
    assert np.allclose(v[0], v[1]) and not v[2].any() and not np.allclose(v[0], v[3])
    assert "".join(models.RegexTokenizer().tokens("ab  cd, é\n ")) == "ab  cd, é\n "
    df = spark.createDataFrame([(0, "p\nlast", "old"), (1, "p\nx", "keep"), (2, "p\ny", None)], "k int, prompt string, out string")
    got = rows(models.regenerate(df, F.col("out") == "old", F.col("prompt"), models.EchoGenerator(), "out").select("k", "out").fillna("null"))
    assert got == [(0, "last"), (1, "keep"), (2, "null")]


def test_pairs_by_suffix_equal_a_plain_sort(spark):
    draw = random.Random(1)
    a = [f"x_{draw.randint(0, 400_000)}" for _ in range(500)] + ["none", "y", "z_7", "a_7b"]
    b = a[100:400]
    number = lambda s: ((lambda m: int(m.group(1)) if m else -1)(re.search(r"(\d+)", s.split("_")[-1])), s)
    pairs = align.pair_by_suffix(spark.createDataFrame([(x,) for x in a], "a string"), spark.createDataFrame([(x,) for x in b], "b string"), "a", "b")
    assert [tuple(r) for r in pairs.orderBy("rank").collect()] == [(i + 1, x, y) for i, (x, y) in enumerate(zip(sorted(a, key=number), sorted(b, key=number)))]


def test_batches_hold_texts_of_similar_length_within_the_limits():
    sizes = sorted(random.Random(1).choices([1, 5, 9, 40, 200], k=300))
    batches = list(models.packed(((n, n) for n in sizes), models.Batching(16, 160)))
    assert [n for b in batches for n in b] == sizes
    assert all(len(b) <= 16 and (len(b) * max(b) <= 160 or len(b) == 1) for b in batches)
    assert len(batches) <= sum(sizes) / 80 + 20


def test_distinct_texts_are_embedded_once_in_batches(spark):
    class Counting:
        """Vectors that end in the size of their batch."""

        def embed(self, texts):
            return np.array([[len(t), len(texts)] for t in texts], float)

    texts = [("t" * (i % 50),) for i in range(400)] + [(None,), ("x" * 3000,)]
    got = models.embed_texts(spark.createDataFrame(texts, "text string").repartition(3), "text", Counting(), models.Batching(8, 100)).collect()
    assert len(got) == 51 and len({r.key for r in got}) == 51
    assert sum(1 / r.vector[-1] for r in got) >= 51 / 8 - 1e-9 and all(r.vector[-1] <= 8 for r in got)
    found = models.embed_distinct(spark.createDataFrame(texts, "text string"), ["text"], models.HashedEmbedder())["text"].collect()
    assert len(found) == 52 and all(np.allclose(r.vector, models.HashedEmbedder().embed([r.text or ""])[0]) for r in found)


@pytest.mark.parametrize("fill", [False, True])
@pytest.mark.parametrize("ahead", [None, 9])
def test_batched_similarities_are_the_same(spark, fill, ahead):
    rng = random.Random(3)
    df = spark.createDataFrame([(d, i, rng.choice(["ab cd, ", "ab. ", "x y z。", ""])) for d in range(4) for i in range(12)], "doc int, pos int, text string")
    one, other = (f(df, ["doc"], "pos", "text", 12, ahead, fill).orderBy("doc", "pos").collect() for f in (chunking.similarity_distribution, chunking.batched_similarity_distribution))
    assert [r[:3] for r in one] == [r[:3] for r in other]
    assert np.allclose([r.similarity for r in one], [r.similarity for r in other])


def test_contexts_do_not_leave_their_task(spark):
    """Only the sentences are shuffled, nothing is stored; contexts are embedded whenever some are held."""
    made = [(d, i, f"line {i % 7} of {d % 2}. ") for d in range(6) for i in range(40)]
    df = spark.createDataFrame(made, "doc int, pos int, text string")
    out = chunking.batched_similarity_distribution(df, ["doc"], "pos", "text", 12, 9)
    assert out.inputFiles() == [] and out._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    expected = chunking.similarity_distribution(df, ["doc"], "pos", "text", 12, 9).orderBy("doc", "pos").collect()
    for at_once in (1, 500, 1 << 20):
        got = chunking.batched_similarity_distribution(df, ["doc"], "pos", "text", 12, 9, at_once=at_once, batching=models.Batching(4, 60)).orderBy("doc", "pos").collect()
        assert [r[:3] for r in got] == [r[:3] for r in expected]
        assert np.allclose([r.similarity for r in got], [r.similarity for r in expected])


def test_windows_of_tokens_against_counting_anew():
    rng = random.Random(2)
    for window in (1, 5, 20):
        scorer, before = models.WindowScorer(window), []
        for _ in range(60):
            own = rng.choices("abcdef", k=rng.randrange(0, 8))
            seen = before[max(0, len(before) - max(0, window - len(own))) :]
            total = len(seen) + len(set(seen) | set(own))
            expected = -sum(math.log((seen.count(t) + 1) / total) for t in own) / len(own) if own else math.nan
            assert scorer.loss(own) == pytest.approx(expected, nan_ok=True)
            before += own


def test_windows_of_tokens_cost_in_proportion():
    tokens = [str(random.Random(5).random()) for _ in range(200_000)]
    began = time.perf_counter()
    scorer = models.WindowScorer(4096)
    for i in range(0, len(tokens), 4):
        scorer.loss(tokens[i : i + 4])
    assert time.perf_counter() - began < 10 and len(scorer.tokens) <= 4096


class Watched(models.SteppedEcho):
    def __init__(self):
        super().__init__()
        self.most, self.order = 0, []

    def submit(self, request, prompt):
        super().submit(request, prompt)
        self.most = max(self.most, len(self.left))

    def step(self):
        done = super().step()
        self.order += [r for r, _ in done]
        return done


@pytest.mark.parametrize("sequences, tokens", [(1, 1000), (4, 50), (96, 81_920)])
def test_requests_are_packed_and_answered_in_any_order(sequences, tokens):
    rng = random.Random(9)
    requests = [(i, "q\n" * rng.randrange(9) + f"a{i}", rng.choice([5, 20, 90])) for i in range(200)]
    generator, size, running, most = Watched(), {i: n for i, _, n in requests}, set(), []

    def handed():
        for r in requests:
            yield r

    submit = generator.submit
    generator.submit = lambda i, p: (running.add(i), most.append(sum(size[k] for k in running) if len(running) > 1 else 0), submit(i, p))
    answers = []
    for i, a in models.continuous(handed(), generator, sequences, tokens):
        running.discard(i)
        answers.append((i, a))
    assert sorted(answers) == [(i, f"a{i}") for i, _, _ in requests]
    assert generator.most <= sequences and max(most) <= tokens
    assert sequences == 1 or generator.order != sorted(generator.order)


def test_bigram_model_against_counting(spark):
    made = [(1, 0, "a b a"), (1, 1, ""), (1, 2, "b, b"), (2, 0, None), (2, 1, "a c"), (2, 2, "a c")]
    df = spark.createDataFrame(made, "doc int, pos int, text string")
    model = ngrams.train(df.filter("doc = 1"), ["doc"], "pos", "text")
    pairs = [("", "a"), ("a", "b"), ("b", "a"), ("a", "b"), ("b", ","), (",", "b")]
    p1 = lambda w: (sum(v == w for _, v in pairs) + 1) / (6 + 3 + 1)
    p2 = lambda h, w: (pairs.count((h, w)) + ngrams.MASS * p1(w)) / (sum(g == h for g, _ in pairs) + ngrams.MASS)
    got = {(r.doc, r.pos): (r.n_tokens, r.loss) for r in ngrams.score_sentences(df, model, ["doc"], "pos", "text").collect()}
    loss = lambda *p: -sum(math.log(p2(h, w)) for h, w in p) / len(p)
    assert {k: n for k, (n, _) in got.items()} == {(1, 0): 3, (1, 1): 0, (1, 2): 3, (2, 0): 0, (2, 1): 2, (2, 2): 2}
    assert math.isnan(got[1, 1][1]) and math.isnan(got[2, 0][1])
    assert [got[k][1] for k in ((1, 0), (1, 2), (2, 1), (2, 2))] == pytest.approx([loss(*pairs[:3]), loss(*pairs[3:]), loss(("", "a"), ("a", "c")), loss(("c", "a"), ("a", "c"))])


def test_shares_do_not_depend_on_how_rows_come(spark):
    values = {1: 1e16, 2: -1e16, 3: 1.0}
    for order in ([1, 3, 2], [3, 2, 1], [1, 2, 3]):
        df = spark.createDataFrame([("a", k, values[k]) for k in order], "key string, pos long, v double").coalesce(1)
        assert sorted(r.proportion for r in windows.proportions(df, ["key"], "v", pos="pos").collect()) == [-1e16, 1.0, 1e16]


def test_boxes_of_batches_are_as_the_plain_functions_have_them():
    """Groups and quadrilaterals of many pages at once, bit for bit."""
    rng = random.Random(8)
    polygons = [[(v["x"], v["y"]) for v in q][: rng.choice([3, 4, 4])] for _, _, q in _turned(rng, 240, 40)]
    polygons = [p for p in polygons if len(set(p)) > 2]
    page = np.sort(np.array([rng.randrange(9) for _ in polygons]))
    shapes = shape.Polygons(np.cumsum([0, *map(len, polygons)]), *np.array([v for p in polygons for v in p]).T)
    for threshold in (0.0, 1.0):
        i, j = shape.page_pairs(page, shapes, threshold)
        plain = [(a, b) for a in range(len(page)) for b in range(a + 1, len(page)) if page[a] == page[b] and boxes.overlap(polygons[a], polygons[b], threshold)]
        assert sorted(zip(i.tolist(), j.tolist())) == plain
    i, j = shape.page_pairs(page, shapes, 0.0)
    low = shape.labels(len(page), i, j)
    for p in set(page.tolist()):
        own = np.flatnonzero(page == p)
        assert sorted(boxes.groups_of([polygons[k] for k in own])) == sorted(np.flatnonzero(low[own] == k).tolist() for k in np.unique(low[own]))
    members = [np.flatnonzero(low == k) for k in np.unique(low)]
    members = [m for m in members if len(m) > 1]
    grouped = shape.gathered(shapes, np.concatenate(members), np.array([len(m) for m in members]))
    got = shape.quads(grouped, np.full(len(members), 200.0), np.full(len(members), 150.0)).to_pylist()
    assert [[(v["x"], v["y"]) for v in q] for q in got] == [boxes.merged_quad([polygons[k] for k in m], 200.0, 150.0) for m in members]


@pytest.mark.parametrize("small", [0, 64])
def test_unsound_boxes_are_alone(spark, small):
    one = [{"x": 0.0, "y": 0.0}, {"x": 2.0, "y": 0.0}, {"x": 2.0, "y": 2.0}]
    made = [("p", 1, one), ("p", 2, one), ("p", 3, []), ("p", 4, [{"x": float("nan"), "y": 0.0}, *one]), (None, 5, one), (None, 6, one)]
    df = spark.createDataFrame([(*r, 9.0, 9.0) for r in made], f"page string, box int, poly {boxes.QUAD}, width double, height double")
    got = boxes.merge_boxes(df, "page", "box", "poly", small_page=small).collect()
    assert sorted((r.group, r.n_boxes) for r in got) == [(1, 2), (3, 1), (4, 1), (5, 1), (6, 1)]


def test_groups_pass_one_at_a_time(spark):
    """What a group was made into is gone when the next but one is at work, however many a batch holds."""

    class Made(list):
        alive = most = 0

        def __init__(self, rows):
            super().__init__(rows)
            Made.alive += 1
            Made.most = max(Made.most, Made.alive)

        def __del__(self):
            Made.alive -= 1

    df = spark.range(400).select((F.col("id") % 50).alias("doc"), "id").coalesce(1)
    out = chunking._grouped(df, ["doc"], "id", [], "id long, most long", lambda g: {"id": Made(g["id"]), "most": [Made.most] * len(g["id"])})
    got = out.collect()
    assert sorted(r.id for r in got) == list(range(400)) and all(r.doc == r.id % 50 for r in got)
    assert max(r.most for r in got) <= 2


def test_pairs_of_a_sentence_are_not_shuffled(spark):
    df = spark.createDataFrame([("a", 0, "x y x y"), ("a", 1, ""), ("a", 2, "z")], "doc string, pos int, text string")
    pairs = ngrams.token_pairs(ngrams.sentence_tokens(df, ["doc"], "pos", "text"), ["doc"], "pos")
    assert "Exchange" not in pairs._jdf.queryExecution().executedPlan().toString()
    assert rows(pairs.select("pos", "h", "w")) == [(0, "", "x"), (0, "x", "y"), (0, "x", "y"), (0, "y", "x"), (2, "y", "z")]


def test_places_of_pairs_are_not_shuffled(spark):
    """Blocks of any size give the same losses; what is shuffled is sentences, and pairs once for each block that holds them."""
    rng = random.Random(4)
    made = [(d, i, " ".join(rng.choices(["a", "b", "c.", "\u3000x", "\t"], k=rng.randrange(9)))) for d in range(5) for i in range(20)]
    df = spark.createDataFrame(made, "doc int, pos int, text string")
    tokens = ngrams.sentence_tokens(df, ["doc"], "pos", "text")
    expected = None
    for block_tokens in (10, 100, 1 << 20):
        counted = ngrams.block_pairs(tokens, ["doc"], "pos", block_tokens)
        assert counted.count() == counted.select("h", "w").distinct().count() and counted.agg(F.sum("c")).first()[0] == tokens.agg(F.sum(F.size("t"))).first()[0]
        model = ngrams.train(df, ["doc"], "pos", "text", tokens, counted)
        for own in (counted, None):
            scored = ngrams.score_sentences(df, model, ["doc"], "pos", "text", tokens, own, block_tokens)
            got = [(r.doc, r.pos, r.n_tokens, round(r.loss, 9) if r.n_tokens else "none") for r in scored.orderBy("doc", "pos").collect()]
            assert len(got) == 100 and got == (expected := expected or got)
        plan = scored._jdf.queryExecution().optimizedPlan().toString()
        assert "arrays_zip" not in plan and "Generate explode(arrays" not in plan


def test_pages_of_few_polygons_go_to_no_grid(spark, monkeypatch):
    """On a grid a box is shuffled for every cell of every level; where copies leave few polygons to a page it is one cell."""
    pages = []
    tiled = boxes._tiled
    monkeypatch.setattr(boxes, "_tiled", lambda known, threshold: pages.extend(r.page for r in known.select("page").distinct().collect()) or tiled(known, threshold))
    rng = random.Random(6)
    made = [(p, i, float(rng.randrange(40 * n)), float(rng.randrange(40)), 5.0 + i % 9, 4.0) for p, n in (("few", 3), ("many", 9)) for i in range(10 * n)]
    made += [("copies", i, 1.0, 1.0, 2.0, 2.0) for i in range(300)]
    df = spark.createDataFrame(made, "page string, box int, x double, y double, w double, h double").withColumn("poly", boxes.quad_column(*(F.col(c) for c in "xywh")))
    sized = df.withColumn("width", F.lit(90.0)).withColumn("height", F.lit(50.0))
    got = lambda small: sorted((r.page, r.group, r.n_boxes) for r in boxes.merge_boxes(sized, "page", "box", "poly", small_page=small).collect())
    spread = got(0)
    assert pages == ["many"]
    assert spread == got(1000) and ("copies", 0, 300) in spread
