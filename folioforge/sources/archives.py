"""EPUB, CBZ and nested zip archives, as bytes in and rows out.

The archive comes from Spark's binaryFile source, so it can lie in any store
that Spark reads. A table function opens it in memory; one archive is what a
task holds.
"""

from __future__ import annotations

import io
import posixpath
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.sources.markup import body_of, collapse, main_element, parse_html, replace_lines, split_by_ids, title_id

IMAGES = (".webp", ".png", ".jpg", ".jpeg")
#: What a file raises that is no archive or no EPUB, and what a damaged or locked member does.
BROKEN = (zipfile.BadZipFile, KeyError, StopIteration)
DAMAGED = (zipfile.BadZipFile, zlib.error, EOFError, RuntimeError, NotImplementedError)


def binary_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(path, content) of the files below path whose names match."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path", "content")


class Epub:
    """An EPUB's package document: its pages in spine order and its table of contents."""

    def __init__(self, data: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(data))
        self.names = self.zip.namelist()
        container = parse_html(self.read("META-INF/container.xml"))
        self.root = next(n.attrs["full-path"] for n in container.find_all("rootfile") if n.attrs.get("full-path"))
        self.opf = parse_html(self.read(self.root))
        self.items = {n.attrs.get("id"): n for n in self.opf.find_all("item")}

    def read(self, name: str) -> str:
        return self.zip.read(name).decode("utf-8", "replace")

    def member(self, href: str) -> str | None:
        """The member that an href of the package names; else the first whose name holds it."""
        href = href.split("#")[0]
        exact = posixpath.normpath(posixpath.join(posixpath.dirname(self.root), href))
        return exact if exact in self.names else next((n for n in self.names if href in n), None)

    def spine(self) -> list[str]:
        hrefs = [self.items[n.attrs.get("idref")].attrs.get("href", "") for n in self.opf.find_all("itemref") if n.attrs.get("idref") in self.items]
        return [m for h in hrefs if (m := self.member(h))]

    def manifest(self) -> list[str]:
        """Documents in order of the manifest."""
        hrefs = [n.attrs.get("href", "") for n in self.opf.find_all("item") if "html" in n.attrs.get("media-type", "html")]
        return [m for h in hrefs if (m := self.member(h))]

    def toc_member(self) -> str | None:
        """The guide's contents page, else the manifest item named toc, ncx or nav."""
        guide = self.opf.find("guide")
        if guide is not None:
            for r in guide.find_all("reference"):
                if r.attrs.get("type") == "toc":
                    return self.member(r.attrs.get("href", ""))
        for word in ("toc", "ncx", "nav"):
            found = [n for i, n in self.items.items() if i and word in i]
            if found:
                return self.member(found[-1].attrs.get("href", ""))
        return None

    def toc(self) -> list[tuple[str, str, str | None]]:
        """(title, page, id or None) of each link of the contents page; titles may repeat."""
        name = self.toc_member()
        if name is None:
            return []
        page = parse_html(self.read(name))
        links = [(a.get_text(), a.attrs["href"]) for a in body_of(page).find_all("a") if a.attrs.get("href")]
        if not links:  # a navigation map
            for p in page.find_all("navpoint"):
                label, content = p.find("navlabel"), p.find("content")
                if content is not None:
                    links.append((label.get_text().strip() if label else "", content.attrs.get("src", "")))
        return [(t, h.partition("#")[0], h.partition("#")[2] or None) for t, h in links]


def _with_contents(chapters: list[tuple[str, str]]) -> list[tuple[str, str]]:
    return [("contents", "\n".join(t for t, _ in chapters)), *chapters]


def epub_chapters(data: bytes) -> list[tuple[str, str]]:
    """(title, text): chapters cut at the ids, or else the pages, that the contents page links to; first a list of titles."""
    book = Epub(data)
    toc, pages = book.toc(), book.spine()
    ids = [i for _, _, i in toc if i]
    if ids:
        texts: dict[str, str] = {}
        last = None
        for name in pages:
            before, parts = split_by_ids(body_of(parse_html(book.read(name))), ids)
            if last is not None:
                texts[last] += f"\n{before}\n"
            for i, t in parts:
                texts[i] = texts.get(i, "") + t
                last = i
        found = [(t, collapse(texts.get(i, ""))) for t, _, i in toc if i]
        return _with_contents([c for c in found if c[1]])
    chapters: list[list[str]] = []
    todo = list(toc)
    for name in pages:
        if todo and todo[0][1] and todo[0][1] in name:
            chapters.append([todo.pop(0)[0], ""])
        if chapters:
            chapters[-1][1] += f"\n{body_of(parse_html(book.read(name))).get_text()}\n"
    return _with_contents([(t, collapse(c)) for t, c in chapters])


def epub_fragments(data: bytes) -> list[tuple[str, str]]:
    """Chapters from fragments of each page's main element: a child with an id that the contents link to begins one.

    Fragments before a title's page are skipped, untitled ones go to the title
    before them, and a title's text ends where another title begins.
    """
    book = Epub(data)
    pages = book.manifest()
    titles = []
    for t, href, i in book.toc():
        at = next((k for k, n in enumerate(pages) if href in n), None)
        if at is not None:
            titles.append((t, i, at))
    if not any(i for _, i, _ in titles):
        return epub_chapters(data)
    known = {i for _, i, _ in titles if i}
    fragments: list[tuple[int, str, str]] = []
    for k, name in enumerate(pages):
        now, text = "", ""
        for child in main_element(body_of(parse_html(book.read(name)))).children:
            found = title_id(child)
            if found:
                fragments.append((k, now, text))
                now, text = found if found in known else "", ""
            text += f"\n{child.get_text()}\n"
        fragments.append((k, now, text))
    fragments = [f for f in fragments if f[2].strip("\n") or f[1]]
    out, at = [], 0
    for title, own, page in titles:
        text = ""
        while at < len(fragments):
            k, i, t = fragments[at]
            if k >= page:
                if i not in ("", own):
                    break
                text += t
            at += 1
        out.append((title, collapse(text)))
    return _with_contents(out)


def epub_pages(data: bytes) -> list[tuple[str, str]]:
    """One chapter for each document in order, titled by the contents entries in order."""
    book = Epub(data)
    return [(t, collapse(body_of(parse_html(book.read(n))).get_text())) for (t, _, _), n in zip(book.toc(), book.manifest())]


FLAVOURS = {"toc": epub_chapters, "fragments": epub_fragments, "pages": epub_pages}


def chapters(files: DataFrame, flavour: str = "toc") -> DataFrame:
    """(file, chapter_idx, title, content) of EPUBs given as (path, content); a file that is no EPUB has no rows."""
    extract = FLAVOURS[flavour]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, data in zip(batch["path"], batch["content"]):
                try:
                    rows = extract(bytes(data))
                except (*BROKEN, *DAMAGED):
                    rows = []
                if rows:
                    yield pd.DataFrame({"file": [path] * len(rows), "chapter_idx": range(len(rows)), "title": [t for t, _ in rows], "content": [c for _, c in rows]})

    return files.select("path", "content").mapInPandas(run, "file string, chapter_idx int, title string, content string")


def epub_documents(files: DataFrame, order: str = "spine") -> DataFrame:
    """(file, idx, member, html) of EPUBs in order of the spine or the manifest; a file that is no whole EPUB has no rows."""

    def run(batches):
        for batch in batches:
            for path, data in zip(batch["path"], batch["content"]):
                try:
                    book = Epub(bytes(data))
                    names = book.spine() if order == "spine" else book.manifest()
                    pages = [book.read(n) for n in names]
                except (*BROKEN, *DAMAGED):
                    continue
                if names:
                    yield pd.DataFrame({"file": [path] * len(names), "idx": range(len(names)), "member": names, "html": pages})

    return files.select("path", "content").mapInPandas(run, "file string, idx int, member string, html string")


def archive_members(files: DataFrame, suffixes: tuple[str, ...] = IMAGES, nested: bool = False) -> DataFrame:
    """(file, member, content) of zip archives, of archives within archives if nested; suffixes are case-sensitive.

    A file that is no archive has no rows; members that are damaged or locked are left out, the others kept.
    """

    def members(data: bytes, deep: bool, prefix: str = ""):
        try:
            z = zipfile.ZipFile(io.BytesIO(data))
        except zipfile.BadZipFile:
            return
        for name in z.namelist():
            if not deep and not name.endswith(suffixes):
                continue
            try:
                content = z.read(name)
            except DAMAGED:
                continue
            if not deep:
                yield prefix + name, content
            elif zipfile.is_zipfile(io.BytesIO(content)):
                yield from members(content, False, f"{name}/")

    def run(batches):
        for batch in batches:
            for path, data in zip(batch["path"], batch["content"]):
                for name, content in members(bytes(data), nested):
                    yield pd.DataFrame({"file": [path], "member": [name], "content": [content]})

    return files.select("path", "content").mapInPandas(run, "file string, member string, content binary")


def image_size(data: bytes) -> tuple[int, int] | None:
    """(width, height) from the header of a PNG, JPEG, GIF or WebP image."""
    if data[:8] == b"\x89PNG\r\n\x1a\n":
        return struct.unpack(">II", data[16:24])
    if data[:6] in (b"GIF87a", b"GIF89a"):
        return struct.unpack("<HH", data[6:10])
    if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
        kind = data[12:16]
        if kind == b"VP8X":
            return int.from_bytes(data[24:27], "little") + 1, int.from_bytes(data[27:30], "little") + 1
        if kind == b"VP8L":
            bits = int.from_bytes(data[21:25], "little")
            return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
        if kind == b"VP8 ":
            w, h = struct.unpack("<HH", data[26:30])
            return w & 0x3FFF, h & 0x3FFF
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 <= len(data) and data[at] == 0xFF:
            marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
            if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", data[at + 5 : at + 9])
                return w, h
            at += 2 + size
    return None


def with_image_size(df: DataFrame, content: str = "content") -> DataFrame:
    """Adds width and height, null for what is no known image."""

    @F.pandas_udf("width int, height int")
    def size(data: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([image_size(bytes(d)) or (None, None) for d in data], columns=["width", "height"], dtype="Int32")

    return df.withColumn("__size", size(F.col(content))).select("*", "__size.width", "__size.height").drop("__size")


def rewrite_epub(data: bytes, pairs: list[tuple[str, str]], most_difference: int | None = None) -> tuple[bytes, list[str]]:
    """(the archive with translations in place of source lines, lines found nowhere).

    mimetype comes first and is stored; members that are no documents are copied.
    """
    book = Epub(data)
    names = list(dict.fromkeys(book.spine()))
    docs = {n: parse_html(book.read(n)) for n in names}
    missed = replace_lines(list(docs.values()), pairs, most_difference)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for n in sorted(book.names, key=lambda n: n != "mimetype"):
            kind = zipfile.ZIP_STORED if n == "mimetype" else zipfile.ZIP_DEFLATED
            z.writestr(n, docs[n].to_html() if n in docs else book.zip.read(n), kind)
    return out.getvalue(), missed


def rewrite_epubs(files: DataFrame, lines: DataFrame, most_difference: int | None = 1) -> DataFrame:
    """(path, content, missed): EPUBs (path, content) rewritten with lines (path, pos, source, target).

    A file that is no whole EPUB stays as it is and misses all of its lines.
    """
    pairs = lines.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("pos", "source", "target"))).alias("pairs"))
    joined = files.select("path", "content").join(pairs, "path", "left")

    def run(batches):
        for batch in batches:
            rows = []
            for path, data, found in zip(batch["path"], batch["content"], batch["pairs"]):
                own = [] if found is None else [(p["source"], p["target"]) for p in found]
                try:
                    rows.append((path, *rewrite_epub(bytes(data), own, most_difference)))
                except (*BROKEN, *DAMAGED):
                    rows.append((path, bytes(data), [source for source, _ in own]))
            yield pd.DataFrame(rows, columns=["path", "content", "missed"])

    return joined.mapInPandas(run, "path string, content binary, missed array<string>")


def convert_images(df: DataFrame, convert) -> DataFrame:
    """content through `convert`, a function from bytes to bytes of an imaging library that the caller has."""

    @F.pandas_udf("binary")
    def run(data: pd.Series) -> pd.Series:
        return data.map(lambda d: convert(bytes(d)))

    return df.withColumn("content", run("content"))


