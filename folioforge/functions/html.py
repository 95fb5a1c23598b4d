"""Text of HTML pages as Spark expressions.

Markup goes by patterns and character references by lookup, so pages stay in
the JVM. For chapters, ids and rewriting, which need elements, see
`folioforge.sources.markup`.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What is no text, taken from left to right, so that a comment in a script is script and a script in a comment comment.
NO_TEXT = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<template\b.*?</template\s*>|<![^>]*>|<\?[^>]*>"
BODY = r"(?is)<body\b[^>]*>(.*?)(?:</body\s*>|\z)"
TAG = r"""</?[A-Za-z](?:[^'">]++|"[^"]*+"|'[^']*+')*+>"""
#: Stands where markup was, so that no reference spans it; a code point that is never a character.
GAP = "\ufdd0"
#: Names that count without a semicolon, the longest first.
BARE = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
#: Numbers from 128 to 159 stand for characters of code page 1252 where it has them.
CODE_PAGE = {i: c for i in range(0x80, 0xA0) if (c := bytes([i]).decode("cp1252", "ignore"))}
#: Numbers that stand for nothing, beside the last two of each plane.
NOTHING = ((0x1, 0x8), (0xB, 0xB), (0xE, 0x1F), (0x7F, 0x9F), (0xFDD0, 0xFDEF))


def _literal_map(pairs: dict) -> Column:
    return F.create_map(*(F.lit(x) for pair in pairs.items() for x in pair))


def _character(n: Column) -> Column:
    """The text that a number in a reference stands for."""
    nothing = F.lit(False)
    for low, high in NOTHING:
        nothing = nothing | n.between(low, high)
    replaced = (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF)
    code = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    known = F.try_element_at(_literal_map(CODE_PAGE), n.cast("int"))
    return F.when(replaced, "�").when(known.isNotNull(), known).when(n == 0xD, "\r").when(nothing | ((n % 0x10000) >= 0xFFFE), "").otherwise(code)


def unescape(text: Column) -> Column:
    """Character references resolved; what is none stays."""
    pieces = F.regexp_extract_all(text, F.lit(rf"&#[xX][0-9a-fA-F]+;?|&#[0-9]+;?|&[A-Za-z][A-Za-z0-9]*;|&(?:{BARE})|[^&]++|&"), F.lit(0))
    names = _literal_map({"&" + n: c for n, c in html5.items()})

    def resolved(piece: Column) -> Column:
        digits = lambda pattern: F.regexp_extract(piece, pattern, 1)
        hex_, ten = digits("^&#[xX]0*([0-9a-fA-F]*)"), digits("^&#0*([0-9]*)")
        number = lambda d, base: F.when(F.length(d) > 8, F.lit(0x110000)).otherwise(F.coalesce(F.conv(d, base, 10).cast("long"), F.lit(0)))
        bare = F.regexp_extract(piece, f"^&(?:{BARE})", 0)
        by_name = F.coalesce(F.try_element_at(names, piece), F.when(bare != "", F.concat(F.try_element_at(names, bare), F.substr(piece, F.length(bare) + 1))), piece)
        number = F.when(piece.rlike("^&#[xX]"), number(hex_, 16)).otherwise(number(ten, 10))
        return F.when(~piece.startswith("&") | (piece == "&"), piece).when(piece.startswith("&#"), _character(number)).otherwise(by_name)

    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, resolved), "")).otherwise(text)


def html_text(html: Column) -> Column:
    """The text of a page's body, or of all of it if it has none, without scripts, styles, templates and comments; null stays null.

    Comments, scripts and tags that are not closed may leave other text than a parser would. U+FDD0, which is no character, goes.
    """
    kept = F.regexp_replace(html, NO_TEXT, GAP)
    body = F.when(kept.rlike(BODY), F.regexp_extract(kept, BODY, 1)).otherwise(kept)
    return F.replace(unescape(F.regexp_replace(body, TAG, GAP)), F.lit(GAP), F.lit(""))
