"""Archives, markup and files, on material built here."""

import hashlib
import io
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from folioforge.sources import archives, files, markup
from folioforge.streaming import ingest

PAGES = {
    "a.xhtml": "<html><body><div><h1 id='c1'>One</h1><p>first　line</p><p><a href='#x'>second</a></p><p>third</p></div></body></html>",
    "b.xhtml": "<html><body><div><p>still one</p><h1 id='c2'>Two</h1><p>text &amp; more</p><!-- no --><script>var t='</p>';</script></div></body></html>",
}


def epub(with_ids=True, guide=True, pages=PAGES):
    toc = "".join(f"<a href='{n}{'#' + i if with_ids else ''}'>{t}</a>" for n, i, t in (("a.xhtml", "c1", "One"), ("b.xhtml", "c2", "Two"), ("c.xhtml", "c3", "Gone")))
    items = "".join(f"<item id='p{i}' href='{n}' media-type='application/xhtml+xml'/>" for i, n in enumerate(pages))
    opf = (
        f"<package><manifest>{items}<item id='toc' href='toc.xhtml' media-type='text/toc'/></manifest>"
        f"<spine>{''.join(f'<itemref idref={chr(39)}p{i}{chr(39)}/>' for i in range(len(pages)))}<itemref idref='none'/></spine>"
        + ("<guide><reference type='toc' href='toc.xhtml'/></guide>" if guide else "") + "</package>"
    )
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("META-INF/container.xml", "<container><rootfiles><rootfile full-path='OEBPS/book.opf'/></rootfiles></container>")
        z.writestr("mimetype", "application/epub+zip")
        z.writestr("OEBPS/book.opf", opf)
        z.writestr("OEBPS/toc.xhtml", f"<html><body>{toc}</body></html>")
        for n, page in pages.items():
            z.writestr(f"OEBPS/{n}", page)
        z.writestr("OEBPS/pic.png", b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (3).to_bytes(4, "big") + (5).to_bytes(4, "big"))
    return out.getvalue()


@pytest.mark.parametrize("guide", [True, False])
def test_chapters_by_id(guide):
    found = archives.epub_chapters(epub(guide=guide))
    assert [t for t, _ in found] == ["contents", "One", "Two"]
    assert found[0][1] == "One\nTwo"
    assert found[1][1].replace("\n", " ") == "Onefirst　linesecondthird still one"
    assert found[2][1] == "Twotext & more"


def test_chapters_by_page():
    found = dict(archives.epub_chapters(epub(with_ids=False)))
    assert found["One"] == "Onefirst　linesecondthird" and found["Two"] == "still oneTwotext & more"


def test_fragments_and_pages():
    found = dict(archives.epub_fragments(epub()))
    assert found["One"] == "One\nfirst　line\nsecond\nthird\nstill one" and found["Two"] == "Two\ntext & more"
    assert [t for t, _ in archives.epub_pages(epub())] == ["One", "Two"]


def test_chapters_operator(spark):
    df = spark.createDataFrame([("x.epub", bytearray(epub())), ("broken.epub", bytearray(b"no zip"))], "path string, content binary")
    got = archives.chapters(df).orderBy("chapter_idx").collect()
    assert [(r.file, r.chapter_idx, r.title) for r in got] == [("x.epub", 0, "contents"), ("x.epub", 1, "One"), ("x.epub", 2, "Two")]
    assert [r.member for r in archives.epub_documents(df.filter("path = 'x.epub'")).orderBy("idx").collect()] == ["OEBPS/a.xhtml", "OEBPS/b.xhtml"]


def test_rewrite(spark):
    lines = spark.createDataFrame([("x.epub", 0, "first line", "ERSTE"), ("x.epub", 1, "second", "ZWEITE"), ("x.epub", 2, "nowhere", "X"), ("x.epub", 3, "thir", "D")], "path string, pos int, source string, target string")
    files_ = spark.createDataFrame([("x.epub", bytearray(epub()))], "path string, content binary")
    r = archives.rewrite_epubs(files_, lines).first()
    assert r.missed == ["nowhere"]
    with zipfile.ZipFile(io.BytesIO(bytes(r.content))) as z:
        assert z.namelist()[0] == "mimetype" and z.getinfo("mimetype").compress_type == zipfile.ZIP_STORED
        assert set(z.namelist()) == set(zipfile.ZipFile(io.BytesIO(epub())).namelist())
        page = z.read("OEBPS/a.xhtml").decode()
        assert "<p>ERSTE</p>" in page and '<p><a href="#x">ZWEITE</a></p>' in page and "<p>Dd</p>" in page
        assert "var t='</p>';" in z.read("OEBPS/b.xhtml").decode()


def test_archives_and_images(spark):
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("1.webp", b"RIFF\0\0\0\0WEBPVP8X\n\0\0\0\0\0\0\0" + (99).to_bytes(3, "little") + (49).to_bytes(3, "little"))
        z.writestr("note.txt", b"x")
        z.writestr("2.WEBP", b"x")
    outer = io.BytesIO()
    with zipfile.ZipFile(outer, "w") as z:
        z.writestr("book.cbz", inner.getvalue())
    df = spark.createDataFrame([("a.cbz", bytearray(inner.getvalue())), ("o.zip", bytearray(outer.getvalue()))], "path string, content binary")
    assert [r.member for r in archives.archive_members(df.filter("path = 'a.cbz'")).collect()] == ["1.webp"]
    nested = archives.with_image_size(archives.archive_members(df.filter("path = 'o.zip'"), nested=True)).collect()
    assert [(r.member, r.width, r.height) for r in nested] == [("book.cbz/1.webp", 100, 50)]
    assert archives.image_size(b"\xff\xd8\xff\xe0\0\x04ab\xff\xc0\0\x0b\x08\0\x07\0\x09") == (9, 7) and archives.image_size(b"x") is None


def test_broken_archives_do_not_end_the_job(spark):
    pack = io.BytesIO()
    with zipfile.ZipFile(pack, "w") as z:
        z.writestr("1.png", b"first" * 9)
        z.writestr("2.png", b"other" * 9)
    damaged = bytearray(pack.getvalue().replace(b"first" * 9, b"fIrst" * 9, 1))
    whole = bytearray(pack.getvalue())
    df = spark.createDataFrame([("n", bytearray(b"no zip")), ("d", damaged), ("w", whole), ("e", bytearray()), ("x.epub", bytearray(epub()))], "path string, content binary")
    got = archives.archive_members(df)
    assert sorted((r.file, r.member) for r in got.collect()) == [("d", "2.png"), ("w", "1.png"), ("w", "2.png"), ("x.epub", "OEBPS/pic.png")]
    assert {r.file for r in archives.epub_documents(df).collect()} == {"x.epub"} == {r.file for r in archives.chapters(df).collect()}
    lines = spark.createDataFrame([("n", 0, "a", "b"), ("n", 1, "c", "d")], "path string, pos int, source string, target string")
    kept = {r.path: (bytes(r.content), r.missed) for r in archives.rewrite_epubs(df, lines).collect()}
    assert kept["n"] == (b"no zip", ["a", "c"]) and kept["w"] == (bytes(whole), []) and kept["e"] == (b"", [])


def test_named_files_in_folders(spark, tmp_path):
    df = spark.createDataFrame([("a/b/1.txt", bytearray("é".encode("utf-16"))), ("a/2.txt", bytearray(b"x\n")), ("3.txt", None)], "name string, data binary")
    assert files.write_named_texts(df, f"file://{tmp_path}/t", "name", "data") == 3
    assert {str(p.relative_to(tmp_path / "t")): p.read_bytes() for p in (tmp_path / "t").rglob("*.txt")} == {"a/b/1.txt": "é".encode("utf-16"), "a/2.txt": b"x\n", "3.txt": b""}
    assert sorted((r.file.rsplit("/", 1)[1], r.text) for r in files.read_valid_texts(spark, str(tmp_path / "t"), "*.txt").collect()) == [("2.txt", "x\n")]  # empty files have no row


def test_markup():
    assert markup.html_text("<body>a<script>x</script><!-- c --><p>b<p>c &lt;</body>") == "abc <"
    assert markup.html_text(None) is None and markup.html_text("") == ""
    doc = markup.parse_html("<h2>t</h2><p>a</p><p>b</p>")
    assert [(r, i, n.get_text()) for r, i, n in markup.text_elements(doc)] == [(0, 0, "a"), (0, 1, "b"), (2, 0, "t")]
    body = markup.parse_html("<div><p>1</p></div><div id='m'><p>1</p><p>2</p></div>")
    assert markup.main_element(body).attrs == {"id": "m"}
    assert markup.title_id(markup.parse_html("<a id='x'></a><b><i id='y'></i></b>")) == "y"
    assert markup.parse_html('<p class="a&amp;b">x<br>y</p>').to_html() == '<p class="a&amp;b">x<br/>y</p>'


def test_json_round_trip(spark, tmp_path):
    data = [{"title": "一", "content": "a\nb"}, {"title": "two", "content": None}]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "v_2.json").write_text(json.dumps(data), encoding="utf-8")
    (tmp_path / "in" / "bad.json").write_text("{", encoding="utf-8")
    got = files.read_json_arrays(spark, str(tmp_path / "in")).orderBy("chapter_idx")
    assert [(r.chapter_idx, r.title, r.content) for r in got.collect() if r.title] == [(0, "一", "a\nb"), (1, "two", None)]
    named = got.filter("title IS NOT NULL").withColumn("file", F.lit("v_2"))
    files.write_json(named, str(tmp_path / "out"), "file", ["chapter_idx"], ["title", "content"])
    text = next((tmp_path / "out" / "file=v_2").glob("*.txt")).read_text(encoding="utf-8")
    assert json.loads(text) == data and "一" in text


def test_texts(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.txt").write_bytes("é\nx".encode())
    (tmp_path / "t" / "b.txt").write_bytes(b"\xff\xfe")
    assert [r.text for r in files.read_valid_texts(spark, str(tmp_path / "t")).collect()] == ["é\nx"]
    df = spark.createDataFrame([("f", 0, "a"), ("f", 1, None), ("f", 2, "b")], "file string, pos int, text string")
    assert files.ordered_text(df, ["file"], ["pos"], "text").first().text == "ab"
    files.write_texts(df, str(tmp_path / "o"), ["file"], ["pos"], "text")
    assert next((tmp_path / "o" / "file=f").glob("*.txt")).read_text() == "ab\n"
    named = spark.createDataFrame([(1, "x/y", "a\nb"), (2, "", None), (3, "é", "")], "i int, title string, text string").withColumn("name", files.text_name(F.col("i"), F.col("title")))
    for _ in range(2):
        assert files.write_named_texts(named, str(tmp_path / "n"), "name", "text") == 3
    assert {p.name: p.read_bytes() for p in (tmp_path / "n").iterdir()} == {"1.x_y.txt": b"a\nb", "2..txt": b"", "3.é.txt": b""}
    assert sorted(r.text for r in files.read_texts(spark, str(tmp_path / "n")).collect()) == ["a\nb"]
    (tmp_path / "n" / "c.json").write_text('[\n {"title": "t",\n  "content": "x"}\n]')
    assert [(r.title, r.content) for r in files.read_json_arrays(spark, str(tmp_path / "n")).collect()] == [("t", "x")]
    assert files.write_named_texts(named.limit(0), str(tmp_path / "none"), "name", "text") == 0
    ocr = {"input_path": "p", "rec_texts": ["a"], "rec_scores": [0.5], "rec_polys": [[[0.0, 1.0]]]}
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "o.json").write_text(json.dumps(ocr))
    assert files.read_json_objects(spark, str(tmp_path / "j")).first().rec_texts == ["a"]


def test_streams(spark, tmp_path):
    rows = [(1, "a\nb", "2024-01-01 00:00:00"), (2, "a\nb", "2024-01-01 00:01:00"), (3, "c", "2024-01-01 00:02:00")]
    df = spark.createDataFrame(rows, "doc_id long, text string, at string").withColumn("at", F.to_timestamp("at"))
    df.write.parquet(f"{tmp_path}/in")
    docs = ingest.document_stream(spark, f"{tmp_path}/in", "doc_id long, text string, at timestamp")
    ingest.append_parquet(ingest.segmented(ingest.without_repeats(docs, "text", "at"), "doc_id", "text"), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert sorted(r.piece for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a\n", "b", "c"]


@pytest.mark.parametrize("side_by_side", [True, False])
@pytest.mark.parametrize("separator", ["", " é\n"])
def test_one_file_for_each_name_in_order(spark, tmp_path, side_by_side, separator):
    rng = random.Random(7)
    made = [("a" if rng.random() < 0.8 else rng.choice("bc"), i // 3, i % 3, rng.choice(["", None, "tü", "x" * 500])) for i in range(600)] + [("only", 0, 0, None)]
    rng.shuffle(made)
    df = spark.createDataFrame(made, "name string, i int, j int, text string").repartition(3)
    got = files.write_joined(df, f"file://{tmp_path}/out", "name", ["i", "j"], "text", separator, side_by_side).collect()
    expected = {n: separator.join(t or "" for m, _, _, t in sorted(made, key=lambda r: r[:3]) if m == n).encode() for n in ("a", "b", "c", "only")}
    assert {r.name: (tmp_path / "out" / r.name).read_bytes() for r in got} == expected
    assert {r.name: r.n_bytes for r in got} == {n: len(t) for n, t in expected.items()}
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["a", "b", "c", "only"]
    assert {r.name: r.md5 for r in files.file_digests(files.write_joined(df, f"file://{tmp_path}/more", "name", ["i", "j"], "text", separator)).collect()} == {n: hashlib.md5(t).hexdigest() for n, t in expected.items()}
    assert files.write_joined(df.limit(0), f"file://{tmp_path}/none", "name", ["i", "j"], "text").count() == 0


def test_tree_of_files_is_found_and_read_by_tasks(spark, tmp_path):
    root = tmp_path / "tree"
    texts = {
        "a/1.json": b'{"x": 1}\r\n', "a/b c/2%+#?.json": "\u9577\u3000".encode(), "a/b c/\u9577\u3000\u00e9[{^`|}\"<>~.json": b"x", "3.json": b"\xff\xfe", "a/b=c/_part=1.json": b"k",
        "empty.json": b"", "_hidden.json": b"h", ".hidden.json": b"h", "_folder/4.json": b"h", "a/5.json._COPYING_": b"h", "_metadata.json": b"m", "_metadata/8.json": b"n", "a/6.txt": b"t", "a/7.json.gz": b"g",
    }
    for name, data in texts.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data)
    (root / "linked").symlink_to(root / "a")
    reader = spark.read.text(f"file://{root}", wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    expected = reader.select(F.input_file_name().alias("file"), F.col("value").cast("binary").alias("data")).collect()
    tree = files.read_texts(spark, f"file://{root}", "*.json")
    rows = tree.select("file", F.col("text").cast("binary").alias("data")).collect()
    assert len(rows) == 10 and sorted((r.file, bytes(r.data)) for r in rows) == sorted((r.file, bytes(r.data)) for r in expected)
    assert tree.inputFiles() == []  # the driver holds no names, Spark's reader all of them


def test_trees_without_a_scheme_are_read_by_tasks(spark, tmp_path):
    """A shared folder may be set as a plain path; Spark's reader would hold every name of the files there on the driver."""
    (tmp_path / "t").mkdir()
    for i in range(3):
        (tmp_path / "t" / f"{i}.json").write_text(json.dumps({"input_path": str(i), "rec_texts": ["a"]}))
    for root in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        tree = files.read_json_objects(spark, root)
        assert tree.inputFiles() == []
        assert sorted(r.file for r in tree.collect()) == [f"file://{tmp_path}/t/{i}.json" for i in range(3)]
