"""Goldens of the scalar functions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from folioforge.functions import geometry as geo
from folioforge.functions import html
from folioforge.functions import segmentation as seg
from folioforge.functions import text as tx
from folioforge.functions import vectors as vec
from folioforge.sources import markup


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "text,symbols,pieces",
    [("\n\nabc", "\n", ["\n\n", "abc"]), ("a\n\nb\nc", "\n", ["a\n\n", "b\n", "c"]), ("", "\n", []), ("い。う！？え", "。！？", ["い。", "う！？", "え"])],
)
def test_segment(spark, text, symbols, pieces):
    assert one(spark, text, lambda c: seg.segment(c, symbols)) == pieces


def test_cascade(spark):
    text = ("長" * 260 + "。\n") * 3
    kept = one(spark, text, seg.segment_cascade)
    assert kept == ["長" * 256, "長" * 4 + "。\n"] * 3
    split = one(spark, text, lambda c: seg.segment_cascade(c, keep_newline=False))
    assert split == ["長" * 256, "長" * 4 + "。", "\n"] * 3
    assert one(spark, None, seg.segment_cascade) is None
    assert one(spark, "", seg.segment_cascade) == []


@pytest.mark.parametrize("keep_newline", [True, False])
def test_cascade_takes_one_pass_over_a_text(spark, keep_newline):
    extra = "\n" if keep_newline else ""

    def refine(pieces, symbols):
        parts = F.when(F.length("s") <= 256, F.array("s")).otherwise(seg.segment(F.col("s"), symbols))
        rows = spark.createDataFrame(list(enumerate(pieces)), "i int, s string").coalesce(1).select("i", parts.alias("y")).collect()
        return [q for r in sorted(rows) for q in r.y]

    rng = random.Random(5)
    texts = ["".join(rng.choice(["x" * rng.randrange(90), "長𠮷 \t\r\u2028\x00", rng.choice("\n」』）).。.！!？?；;，,：:、]^\\-[")]) for _ in range(200)) for _ in range(3)]
    texts += ["", "\n", "\n\na", "𠮷" * 257, "𠮷" * 256, "a" * 300 + "\n\n", ("b" * 255 + "，\n") * 2, None, "c" * 513]
    frame = spark.createDataFrame(list(enumerate(texts)), "k int, x string").coalesce(1)
    mine = frame.select("k", seg.segment_cascade(F.col("x"), keep_newline=keep_newline).alias("y"))
    lines = dict(frame.select("k", seg.segment(F.col("x"))).collect())
    mark = "\x01"  # tells pieces of different texts apart, and is no delimiter
    expected = {k: list(lines[k] or []) for k in lines}
    for level in (seg.CLOSERS, seg.ENDERS, seg.COMMAS):
        flat = refine([p for k in sorted(expected) for p in [*expected[k], mark]], extra + level)
        ends = [-1, *(i for i, p in enumerate(flat) if p == mark)]
        expected = {k: flat[ends[k] + 1 : ends[k + 1]] for k in range(len(texts))}
    sliced = {k: [q for p in v for q in ([p] if len(p) <= 256 else [p[i : i + 256] for i in range(0, len(p), 256)])] for k, v in expected.items()}
    found = dict(mine.collect())
    assert found.pop(texts.index(None)) is None and found == {k: v for k, v in sliced.items() if texts[k] is not None}
    bad = spark.sql("SELECT cast(x'61FF0A62E9950AC328' AS string) AS x")
    assert bad.select(seg.segment_cascade(F.col("x"), keep_newline=keep_newline).alias("y")).first() == bad.select(seg.segment(F.col("x")).alias("y")).first()
    plan = mine._jdf.queryExecution().executedPlan().toString()
    assert "transform(" not in plan and plan.count("ArrowEvalPython") == 1  # no interpreted expressions, once a text


def test_truncate_and_collapse(spark):
    assert one(spark, "abcdefghijklmnop", lambda c: tx.truncate_middle(c, 10)) == "abc...mnop"
    assert one(spark, "　 a\n\n\nb \n", tx.collapse_newlines) == "a\nb"
    assert one(spark, "0123456789DM5abcdefghij", lambda c: tx.snippet(c, F.lit("DM5"))) == "23456789DM5abcde"
    assert one(spark, "none", lambda c: tx.snippet(c, F.lit("DM5"))) is None


def test_strip_suffix(spark):
    assert one(spark, "volub.epub", lambda c: tx.strip_suffix(c, ".epub")) == "volub"
    assert one(spark, "volub.epub", lambda c: tx.strip_suffix(c, ".epub", compat=True)) == "vol"


@pytest.mark.parametrize("text,number", [("v01-10.xhtml", 110.0), ("-", None), ("x", None), ("a-1.5.2", -1.52), ("0.xhtml", 0.0), ("", None)])
def test_only_numbers(spark, text, number):
    assert one(spark, text, tx.only_numbers) == number


def test_document_name(spark):
    assert one(spark, "0.xhtml", tx.is_document_name) is False
    assert one(spark, "toc.xhtml", tx.is_document_name) is True


def test_answers(spark):
    two = "<answer>\nFalse\n</answer> x <answer>\nTrue\n</answer>"
    assert one(spark, two, tx.last_answer) == "True"
    assert one(spark, "no tag", tx.last_answer) == "True_NoAnswer"


def test_glossary_line(spark):
    row = spark.range(1).select(tx.glossary_line(F.lit("A"), F.lit("B"), F.lit("c")).alias("a"), tx.glossary_line(F.lit("A"), F.lit("B"), F.lit("")).alias("b"), tx.glossary_line(F.lit("A"), F.lit("B"), F.lit(""), True).alias("c")).first()
    assert (row.a, row.b, row.c) == ("A->B #c", "A->B", "")


def test_template_fills_slots_once(spark):
    got = spark.range(1).select(tx.fill_template("{jp}|{tw}|{x}", jp=F.lit("{tw}"), tw=F.lit("t")).alias("y")).first().y
    assert got == "{tw}|t|{x}"


def test_line_counts(spark):
    rows = spark.createDataFrame([("a\nb\n", "x\ny"), ("a\nb", "xy"), ("", "")], "a string, b string")
    assert [r[0] for r in rows.select(tx.line_count_differs(F.col("a"), F.col("b"))).collect()] == [False, True, False]


def test_conversion_prefers_long_phrases(spark):
    assert one(spark, "abc ab a", lambda c: tx.convert_characters(c, {"a": "1"}, {"ab": "X", "abc": "Y"})) == "Y X 1"
    # from left to right, the longest at each place; what a phrase turns into is not converted again
    assert one(spark, "abcd a", lambda c: tx.convert_characters(c, {"a": "1", "d": "2"}, {"ab": "a", "bcd": "X"})) == "ac2 1"
    assert one(spark, "", lambda c: tx.convert_characters(c, {"a": "1"}, {"ab": "X"})) == ""
    assert one(spark, None, lambda c: tx.convert_characters(c, {"a": "1"}, {"ab": "X"})) is None


def test_many_phrases_equal_a_plain_scan(spark):
    draw = random.Random(5)
    phrases = {"".join(draw.choices("abc", k=draw.randint(1, 5))): str(i) for i in range(3000)}
    texts = ["".join(draw.choices("abcd", k=40)) for _ in range(50)]

    def plain(t):
        out, i = "", 0
        while i < len(t):
            n = next((n for n in range(5, 0, -1) if i + n <= len(t) and t[i : i + n] in phrases), 0)
            out, i = out + (phrases[t[i : i + n]] if n else t[i]), i + (n or 1)
        return out

    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.convert_characters(F.col("t"), {}, phrases).alias("c")).collect()
    assert [r.c for r in rows] == [plain(r.t) for r in rows]


def test_vectors(spark):
    row = spark.range(1).select(
        vec.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0))).alias("c"), vec.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0))).alias("z"), vec.perplexity(F.lit(math.nan)).alias("p")
    ).first()
    assert row.c == pytest.approx(0.7071067811865475) and row.z is None and row.p == 1.7976931348623157e308


def square(x, y, side=1):
    return F.array(geo.point(x, y), geo.point(x + side, y), geo.point(x + side, y + side), geo.point(x, y + side))


def test_geometry(spark):
    p = lambda x, y: geo.point(x, y)
    row = spark.range(1).select(
        geo.polygons_overlap(square(0, 0), square(1, 0)).alias("touch"), geo.overlap_gap(square(0, 0), square(1, 0)).alias("gap"),
        geo.polygons_overlap(square(0, 0), square(3, 0)).alias("apart"), geo.overlap_gap(square(0, 0), square(3, 0)).alias("far"),
        geo.point_in_polygon(square(0, 0), p(1, 0.5)).alias("edge"), geo.segment_distance(p(0, 0), p(2, 0), p(1, 3)).alias("d"),
        geo.segment_distance(p(1, 1), p(1, 1), p(1, 3)).alias("dot"), geo.line_intersection(p(0, 0), p(2, 2), p(0, 2), p(2, 0)).alias("x"),
        geo.line_intersection(p(0, 0), p(1, 0), p(0, 1), p(1, 1)).alias("parallel"), geo.segments_intersect(p(0, 0), p(2, 2), p(0, 2), p(2, 0)).alias("cross"),
    ).first()
    assert (row.touch, row.gap, row.apart, row.far, row.edge, row.d, row.dot) == (True, 0.0, False, -2.0, True, 3.0, 2.0)
    assert (row.x.x, row.x.y) == (1.0, 1.0) and row.parallel is None and row.cross


def test_html_text_against_the_parser(spark):
    rng = random.Random(6)
    pieces = ["<p>", "</p>", "<br/>", "a b", "é\n", "<!-- x <script> -->", "<script>var t = '<p>' // <!-- </script>", "<style>p{}</style>", '<a href="x>y" title=\'<b>\'>', "</a>", "&amp;", "&amp", "&lt;p&gt;", "&copy;",
              "&copyx", "&notin;", "&notit;", "&#233;", "&#xe9;", "&#x1F600;", "&#150;", "&#0;", "&#xD800;", "&#1114112;", "&#1;", "&#65", "&", "& b", "&nosuch;", "&#x;", "1 < 2 "]
    pages = ["".join(rng.choice(pieces) for _ in range(rng.randrange(0, 12))) for _ in range(400)]
    pages += [f"<html><head><title>t</title></head><body class='x'>{p}</body>tail</html>" for p in pages[:200]] + [f"<body>{p}" for p in pages[:50]] + ["", "x" * 100_000 + "&amp;" * 1000]
    got = spark.createDataFrame(list(enumerate([*pages, None])), "i int, html string").select("i", html.html_text(F.col("html")).alias("text")).collect()
    for r in got:
        page = None if r.i == len(pages) else pages[r.i]
        assert r.text == markup.html_text(page), page


def test_perplexity_by_the_c_library_and_rounded_as_sql_does(spark):
    """The JVM's exp is a unit in the last place lower here, which a rounding to nine places shows."""
    losses = [26.47558488867236 / 100, -3.0, 0.0, 709.5, 800.0, None]
    rows = spark.createDataFrame([(v,) for v in losses], "v double").select(vec.exp(F.col("v")).alias("e"), vec.rounded(vec.perplexity(F.col("v")), 9).alias("p")).collect()
    assert [r.e for r in rows] == [*map(math.exp, losses[:4]), math.inf, None]
    assert rows[0].p == 1.303112781
    assert [one(spark, v, lambda c: vec.rounded(c.cast("double"), 6)) for v in (-1.5, 2.0000005, 1e300)] == [-1.5, 2.000001, 1e300]


def test_phrases_of_more_texts_than_are_held_at_once(spark):
    n = 3 * tx.TEXTS_AT_ONCE + 1
    df = spark.range(n).coalesce(1).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("and é an "), F.col("id"))).alias("t"))
    got = df.select("id", tx.convert_characters(F.col("t"), {"é": "e"}, {"an": "1", "and": "2"}).alias("c")).collect()
    assert {r.id: r.c for r in got} == {i: f"2 e 1 {i}" if i % 7 else None for i in range(n)}


def test_gaps_of_batches_equal_the_expressions(spark):
    def span(polygon, v):
        on_axis = F.transform(polygon, lambda p: p["x"] * v["x"] + p["y"] * v["y"])
        return F.array_min(on_axis), F.array_max(on_axis)

    def gap(a, b, v):
        (lo_a, hi_a), (lo_b, hi_b) = span(a, v), span(b, v)
        return F.least(hi_a - lo_b, hi_b - lo_a)

    a, b = F.col("a"), F.col("b")
    plain = F.array_min(F.transform(F.concat(geo.edge_normals(a), geo.edge_normals(b)), lambda v: gap(a, b, v)))
    rng = random.Random(3)

    def number():
        return rng.choice([None, float("nan"), float("inf"), 0.0, -0.0, 1e200]) if rng.random() < 0.03 else rng.choice([rng.randrange(6) / 1.0, rng.uniform(-5, 5)])

    def polygon():
        if rng.random() < 0.03:
            return None
        points = [(number(), number()) for _ in range(rng.randrange(1, 6))]
        return [rng.choice(points) for _ in points] if rng.random() < 0.1 else [None if rng.random() < 0.02 else p for p in points]

    pairs = spark.createDataFrame([(i, polygon(), polygon()) for i in range(3000)], "i int, a array<struct<x:double,y:double>>, b array<struct<x:double,y:double>>").coalesce(2)
    rows = pairs.select(plain.alias("plain"), geo.overlap_gap(a, b).alias("gap")).collect()
    same = [r.plain == r.gap or r.plain is not None and r.gap is not None and r.plain != r.plain and r.gap != r.gap for r in rows]
    assert all(same) and sum(r.plain is None for r in rows) > 50 and sum(r.plain is not None and r.plain != 0 for r in rows) > 1000
    empty = pairs.limit(1).select(geo.overlap_gap(F.array().cast("array<struct<x:double,y:double>>"), F.array(geo.point(0, 0), geo.point(1, 0))).alias("y"))
    assert empty.first().y is None
    assert "transform(" not in pairs.select(geo.overlap_gap(a, b))._jdf.queryExecution().executedPlan().toString()


def test_points_in_polygons_of_batches_equal_the_expressions(spark):
    rng = random.Random(4)

    def number():
        return rng.choice([None, float("nan"), float("inf"), -0.0, 1e200]) if rng.random() < 0.03 else float(rng.randrange(4))

    def polygon():
        if rng.random() < 0.4:
            x, y, w, h = (rng.randrange(3) for _ in range(4))
            return [(float(a), float(b)) for a, b in ((x, y), (x + w, y), (x + w, y + h), (x, y + h))][:: rng.choice([1, -1])]
        return None if rng.random() < 0.03 else [None if rng.random() < 0.02 else (number(), number()) for _ in range(rng.randrange(1, 6))]

    rows = [(i, polygon(), None if rng.random() < 0.02 else (number(), number())) for i in range(4000)]
    pairs = spark.createDataFrame(rows, "i int, a array<struct<x:double,y:double>>, p struct<x:double,y:double>").coalesce(2)
    found = pairs.select(geo._inside(F.col("a"), F.col("p")).alias("plain"), geo.point_in_polygon(F.col("a"), F.col("p")).alias("inside")).collect()
    assert [r.inside for r in found] == [r.plain for r in found] and all(sum(r.plain is v for r in found) > 50 for v in (None, True, False))
    assert "transform(" not in pairs.select(geo.point_in_polygon(F.col("a"), F.col("p")))._jdf.queryExecution().executedPlan().toString()
