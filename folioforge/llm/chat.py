"""Operator 7 [native]: chat formatting with a grammar round trip.

A turn is rendered as

    <s> mark role [INST] text [/INST] </s>

without the blanks. A deterministic lexer cuts the output at the control
strings; the grammar asks for the four of a turn in this order and nothing
else. Every turn is first written as it is (mark `=`), parsed back and compared
with the source; a turn that does not come back is written anew with its control
characters escaped (mark `~`). The conversation is parsed and compared again as
a whole. Escaped texts hold no `<` and no `[`, so nothing in them can be taken
for a control string, and the second form always comes back.

Only DataFrame functions are used. Edge cases: null roles and texts are empty;
null turns come first; rows with the same turn follow in the order of role and
text; a null conv_id is a conversation of its own; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The control strings in the order of the grammar.
CONTROL = ("<s>", "[INST]", "[/INST]", "</s>")
RAW, ESCAPED = "=", "~"
LEXER = r"(<s>|\[INST\]|\[/INST\]|</s>)"


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("~"), F.lit("~0")), F.lit("<"), F.lit("~1")), F.lit("["), F.lit("~2"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("~2"), F.lit("[")), F.lit("~1"), F.lit("<")), F.lit("~0"), F.lit("~"))


def render_turn(role: Column, text: Column, mark: str) -> Column:
    a, b, c, d = map(F.lit, CONTROL)
    return F.concat(a, F.lit(mark), role, b, text, c, d)


def read_turn(rendered: Column) -> tuple[Column, Column, Column]:
    """(whether the four control strings stand there in order and nothing else is cut, role, text) of one rendered turn."""
    tokens, parts = F.regexp_extract_all(rendered, F.lit(LEXER), F.lit(1)), F.split(rendered, LEXER, -1)
    outer = (F.get(parts, F.lit(0)) == "") & (F.get(parts, F.lit(4)) == "")
    head, text = F.get(parts, F.lit(1)), F.get(parts, F.lit(2))
    role = F.substring(head, F.lit(2), F.length(head))
    escaped = F.left(head, F.lit(1)) == ESCAPED
    ok = F.coalesce((tokens == F.array(*map(F.lit, CONTROL))) & outer & F.left(head, F.lit(1)).isin(RAW, ESCAPED), F.lit(False))
    return ok, F.when(escaped, unescape(role)).otherwise(role), F.when(escaped, unescape(text)).otherwise(text)


def parse(formatted: Column) -> Column:
    """Array of (ok, role, text) read from a rendering, cut behind each end of a turn; what is left over is not ok."""
    pieces = F.split(formatted, "(?<=</s>)", -1)

    def turn(piece):
        ok, role, text = read_turn(piece)
        return F.struct(ok.alias("ok"), role.alias("role"), text.alias("text"))

    return F.transform(F.filter(pieces, lambda p: p != ""), turn)


def format_conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: formatted, the turns read back from it, and whether they equal the source.

    Turns are concatenated, so what one reads back as does not depend on the
    others: each is first tried by itself, and the whole is read again in the
    end. loss_text is what the loss mask covers: the texts of assistant turns as
    they were read back.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = df.select(F.col(conv_col).alias(conv_col), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    ok, read_role, read_text = read_turn(render_turn(F.col("role"), F.col("text"), RAW))
    same = ok & (read_role == F.col("role")) & (read_text == F.col("text"))
    escaped = render_turn(escape(F.col("role")), escape(F.col("text")), ESCAPED)
    tried = rows.withColumn("rendered", F.when(same, render_turn(F.col("role"), F.col("text"), RAW)).otherwise(escaped))
    convs = tried.groupBy(conv_col).agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "rendered"))).alias("source"))
    done = convs.withColumn("formatted", F.array_join(F.transform("source", lambda t: t["rendered"]), ""))
    back = done.withColumn("turns", parse(F.col("formatted")))
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    pairs = lambda c: F.transform(c, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    identical = F.forall("turns", lambda t: t["ok"]) & (pairs("turns") == pairs("source"))
    return back.select(conv_col, "formatted", pairs("turns").alias("turns"), loss.alias("loss_text"), identical.alias("identical"))


def digests(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Counts and digests of what format_conversations read back, and whether that equals the source."""
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return formatted.select(
        conv_col,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "identical",
    )
