"""Scalar text functions and predicates as Spark SQL expressions."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

ELLIPSIS = "..."
#: Texts of a batch that are Python objects at once.
TEXTS_AT_ONCE = 64


def truncate_middle(text: Column, length: int, ellipsis: str = ELLIPSIS) -> Column:
    """At most `length` code points, the middle replaced by the ellipsis."""
    if length < len(ellipsis):
        raise ValueError("the ellipsis is longer than the result")
    front = (length - len(ellipsis)) // 2
    back = length - len(ellipsis) - front
    return F.when(F.length(text) <= length, text).otherwise(F.concat(F.left(text, F.lit(front)), F.lit(ellipsis), F.right(text, F.lit(back))))


def collapse_newlines(text: Column) -> Column:
    """Outer white space of any script stripped, runs of newlines made one."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)^\s+|\s+\z", ""), r"\n+", "\n")


def strip_newlines(text: Column) -> Column:
    return F.btrim(text, F.lit("\n"))


def stripped_lines(text: Column) -> Column:
    """Lines of the text without its outer newlines; the empty text is one empty line."""
    return F.split(strip_newlines(text), "\n", -1)


def strip_suffix(name: Column, suffix: str, compat: bool = False) -> Column:
    """name without the suffix. With compat, without any trailing characters that occur in it."""
    if compat:
        return F.rtrim(name, F.lit(suffix))
    return F.when(F.endswith(name, F.lit(suffix)), F.left(name, F.length(name) - len(suffix))).otherwise(name)


def snippet(text: Column, keyword: Column, reach: int = 8) -> Column:
    """Up to `reach` characters before the first hit and `reach` from its start on; null without a hit."""
    at = F.instr(text, keyword) - 1
    first = F.greatest(at - reach, F.lit(0))
    return F.when(at >= 0, F.substring(text, first + 1, at + reach - first))


def only_newlines(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit("")) == ""


def only_numbers(text: Column) -> Column:
    """The number that the digits, the leading minus and the first point of a text spell; null if there is none."""
    kept = F.regexp_replace(text, r"[^0-9.\-]", "")
    signed = F.regexp_replace(kept, r"(?<=.)-", "")
    whole = F.regexp_replace(signed, r"^([^.]*\.)", "$1\u0000")
    head, tail = F.substring_index(whole, "\0", 1), F.when(F.contains(whole, F.lit("\0")), F.replace(F.substring_index(whole, "\0", -1), F.lit("."), F.lit("")))
    number = F.concat(head, F.coalesce(tail, F.lit("")))
    return F.when(number.isin("", ".", "-", "-."), None).otherwise(F.regexp_replace(number, r"\.$", ".0").try_cast("double"))


def is_document_name(name: Column) -> Column:
    """Whether a name holds a number other than zero, or toc."""
    return (F.coalesce(only_numbers(name), F.lit(0.0)) != 0) | F.contains(name, F.lit("toc"))


def contains_any(text: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return out


def line_count_differs(a: Column, b: Column) -> Column:
    return F.size(stripped_lines(a)) != F.size(stripped_lines(b))


def normalise_spaces(text: Column) -> Column:
    """Ideographic spaces become ordinary ones."""
    return F.translate(text, "　", " ")


def last_answer(response: Column, default: str = "True_NoAnswer") -> Column:
    """What the last well-formed answer tag says."""
    return F.coalesce(F.try_element_at(F.regexp_extract_all(response, F.lit(r"<answer>\n(True|False)\n</answer>"), F.lit(1)), F.lit(-1)), F.lit(default))


def flagged_response(answer: Column, response: Column) -> Column:
    """The response where the answer flags it, else empty."""
    return F.when(F.contains(answer, F.lit("True")), response).otherwise("")


def convert_characters(text: Column, pairs: dict[str, str], phrases: dict[str, str] | None = None) -> Column:
    """Script conversion by a character map, or by phrases and, for what is between them, the map.

    Phrases are taken from left to right, at each place the longest one, and are
    not converted again. A table of thousands is one automaton, which reads a text
    once, in Arrow batches; without phrases the conversion stays an expression.
    """
    phrases = {old: new for old, new in (phrases or {}).items() if old}
    if not phrases:
        return F.translate(text, "".join(pairs), "".join(pairs.values()))

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        single = {ord(a): b for a, b in pairs.items()}
        automaton = ahocorasick.Automaton()
        for old in phrases:
            automaton.add_word(old, len(old))
        automaton.make_automaton()

        def convert(t: str | None) -> str | None:
            if not t:
                return t
            longest: dict[int, int] = {}
            for end, n in automaton.iter(t):
                longest[end - n + 1] = max(n, longest.get(end - n + 1, 0))
            out, at = [], 0
            for start in sorted(longest):
                if start >= at:
                    out += [t[at:start].translate(single), phrases[t[start : start + longest[start]]]]
                    at = start + longest[start]
            return "".join([*out, t[at:].translate(single)])

        # a batch stays in Arrow; some texts at a time are Python objects
        for texts in batches:
            parts = (texts.slice(i, TEXTS_AT_ONCE) for i in range(0, len(texts), TEXTS_AT_ONCE))
            yield pa.concat_arrays([pa.array([], pa.string()), *(pa.array([convert(t) for t in part.to_pylist()], pa.string()) for part in parts)])
        pa.default_memory_pool().release_unused()

    return run(text)


def has_convertible(text: Column, pairs: dict[str, str], phrases: dict[str, str] | None = None) -> Column:
    return convert_characters(text, pairs, phrases) != text


def glossary_line(source: Column, target: Column, info: Column, compat: bool = False) -> Column:
    """`source->target`, with ` #info` if there is any. With compat, entries without info are empty."""
    line = F.concat(source, F.lit("->"), target)
    return F.when(F.coalesce(info, F.lit("")) != "", F.concat(line, F.lit(" #"), info)).otherwise("" if compat else line)


def fill_template(template: str, **slots: Column) -> Column:
    """A prompt from a template with {name} slots; slot texts are not searched for further slots."""
    import re

    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[F.lit(p) if i % 2 == 0 else F.coalesce(slots[p], F.lit("")) if p in slots else F.lit("{" + p + "}") for i, p in enumerate(parts)])


def token_count(text: Column) -> Column:
    """The built-in tokenizer: runs of ASCII letters and digits, or any other single character that is not white space; 1 at least."""
    return F.greatest(F.size(F.regexp_extract_all(text, F.lit(r"[A-Za-z0-9]+|[^A-Za-z0-9 \t\n\r\f]"), F.lit(0))), F.lit(1))
