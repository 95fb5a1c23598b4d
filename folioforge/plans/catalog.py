"""The registered queries over the driver tables, each with its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.functions import geometry as geo
from folioforge.functions import html
from folioforge.functions import segmentation as seg
from folioforge.functions import text as tx
from folioforge.functions import vectors as vec
from folioforge.operators import align, boxes, chunking, examine, glossary, models, ngrams, repeats, windows
from folioforge.operators import corpus_stats as cs
from folioforge.sources import files, markup

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Registers a query and, where SQL can say it, its oracle."""

    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return keep


LINES_SQL = r"""(SELECT doc_id, lang, unnest(p) AS piece, unnest(range(len(p))) AS pos
 FROM (SELECT doc_id, lang, regexp_extract_all(text, '[^\n]*[\n]+|[^\n]+') AS p FROM documents))"""


@query(
    "line_stats",
    f"""SELECT lang, count(*)::BIGINT AS n_lines, sum(length(piece))::BIGINT AS total_chars,
 round(avg(length(piece)), 6) AS mean_chars, median(length(piece))::DOUBLE AS median_chars
 FROM {LINES_SQL} GROUP BY lang""",
)
def line_stats(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("lang", F.explode(seg.segment(F.col("text"))).alias("piece"))
    n = F.length("piece")
    return lines.groupBy("lang").agg(
        F.count("*").alias("n_lines"),
        F.sum(n).alias("total_chars"),
        F.round(F.avg(n), 6).alias("mean_chars"),
        F.median(n).alias("median_chars"),
    )


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


# --- segmentation ---------------------------------------------------------------------------------------------------

def _cascade_sql(keep_newline: bool) -> str:
    extra = r"\n" if keep_newline else ""
    pieces = r"regexp_extract_all(text, '[^\n]*[\n]+|[^\n]+')"
    for level in ("」』）)", "。.！!？?；;", "，,：:、"):
        s = extra + level.replace(".", r"\.").replace("?", r"\?").replace(")", r"\)")
        pieces = f"flatten(list_transform({pieces}, lambda s: CASE WHEN length(s) <= 256 THEN [s] ELSE regexp_extract_all(s, '[^{s}]*[{s}]+|[^{s}]+') END))"
    return f"flatten(list_transform({pieces}, lambda s: CASE WHEN length(s) <= 256 THEN [s] ELSE list_transform(range(1, length(s) + 1, 256), lambda k: substring(s, k, 256)) END))"


def _unnest_sql(array: str) -> str:
    return f"SELECT doc_id, unnest(p) AS piece, unnest(range(len(p)))::INTEGER AS pos FROM (SELECT doc_id, {array} AS p FROM documents)"


def _pieces(spark, sf_dir, pieces):
    return _documents(spark, sf_dir).select("doc_id", F.posexplode(pieces).alias("pos", "piece"))


@query("segment_lines", _unnest_sql(r"regexp_extract_all(text, '[^\n]*[\n]+|[^\n]+')"))
def segment_lines(spark, sf_dir):
    return _pieces(spark, sf_dir, seg.segment(F.col("text")))


@query("segment_cascade", _unnest_sql(_cascade_sql(True)))
def segment_cascade(spark, sf_dir):
    return _pieces(spark, sf_dir, seg.segment_cascade(F.col("text")))


@query("segment_cascade_nonl", _unnest_sql(_cascade_sql(False)))
def segment_cascade_nonl(spark, sf_dir):
    return _pieces(spark, sf_dir, seg.segment_cascade(F.col("text"), keep_newline=False))


@query("hard_slice_256", _unnest_sql("list_transform(range(1, length(text) + 1, 256), lambda k: substring(text, k, 256))"))
def hard_slice_256(spark, sf_dir):
    return _pieces(spark, sf_dir, seg.hard_slices(F.col("text")))


# --- scalar functions -----------------------------------------------------------------------------------------------


def _on_documents(name: str, out: str, column, sql: str):
    @query(name, f"SELECT doc_id, {sql} AS {out} FROM documents")
    def run(spark, sf_dir):
        return _documents(spark, sf_dir).select("doc_id", column(F.col("text")).alias(out))


def _on_urls(name: str, out: str, column, sql: str):
    @query(name, f"SELECT page_id, {sql} AS {out} FROM pages")
    def run(spark, sf_dir):
        return table(spark, sf_dir, "pages").select("page_id", column(F.col("url")).alias(out))


_on_documents("truncate_middle_32", "short", lambda c: tx.truncate_middle(c, 32), "CASE WHEN length(text) <= 32 THEN text ELSE left(text, 14) || '...' || right(text, 15) END")
_on_documents("collapse_newlines", "clean", lambda c: tx.collapse_newlines(c), r"regexp_replace(regexp_replace(text, '^[ \t\n\r\f\v]+|[ \t\n\r\f\v]+$', '', 'g'), '\n+', chr(10), 'g')")
_on_documents("text_replace", "replaced", lambda c: F.replace(c, F.lit("the"), F.lit("THE")), "replace(text, 'the', 'THE')")
_on_documents("space_normalise", "spaced", lambda c: tx.normalise_spaces(F.translate(c, " ", "　")), "translate(translate(text, ' ', '　'), '　', ' ')")
_on_urls("strip_charset", "stem", lambda c: tx.strip_suffix(c, ".html", compat=True), "rtrim(url, '.html')")
_on_urls("strip_suffix", "stem", lambda c: tx.strip_suffix(c, ".html"), "CASE WHEN ends_with(url, '.html') THEN left(url, length(url) - 5) ELSE url END")

NUMBER_SQL = r"""(SELECT page_id, url, regexp_replace(k, '^(.)(.*)$', '\1') || replace(regexp_replace(k, '^(.)(.*)$', '\2'), '-', '') AS s
  FROM (SELECT page_id, url, regexp_replace(url, '[^0-9.\-]', '', 'g') AS k FROM pages))"""
NUMBER_SQL = f"""(SELECT page_id, url, CASE WHEN n IN ('', '.', '-', '-.') THEN NULL ELSE TRY_CAST(n AS DOUBLE) END AS num FROM
 (SELECT page_id, url, CASE WHEN strpos(s, '.') = 0 THEN s ELSE left(s, strpos(s, '.')) || replace(substring(s, strpos(s, '.') + 1), '.', '') END AS n FROM {NUMBER_SQL}))"""


@query("only_numbers", f"SELECT page_id, num FROM {NUMBER_SQL}")
def only_numbers(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tx.only_numbers(F.col("url")).alias("num"))


@query("doc_name_filter", f"SELECT page_id, url FROM {NUMBER_SQL} WHERE coalesce(num, 0) <> 0 OR contains(url, 'toc')")
def doc_name_filter(spark, sf_dir):
    return table(spark, sf_dir, "pages").filter(tx.is_document_name(F.col("url"))).select("page_id", "url")


# An inline character map that stands for a script conversion table.
CHARS = {"é": "e", "è": "e", "ü": "u", "ö": "o", "ä": "a", "ß": "s", "ñ": "n", "ó": "o"}
CHARS_SQL = f"translate(text, '{''.join(CHARS)}', '{''.join(CHARS.values())}')"


PHRASES = {"an": "<1>", "and": "<2>"}


@query("phrase_convert", "SELECT doc_id, md5(" + CHARS_SQL.replace("(text,", "(replace(replace(text, 'and', '<2>'), 'an', '<1>'),") + ") AS converted_md5 FROM documents")
def phrase_convert(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", F.md5(tx.convert_characters(F.col("text"), CHARS, PHRASES).cast("binary")).alias("converted_md5"))


@query(
    "char_map_convert",
    f"SELECT doc_id, md5({CHARS_SQL}) AS converted_md5, {CHARS_SQL} <> text AS has_convertible FROM documents",
)
def char_map_convert(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", F.md5(tx.convert_characters(F.col("text"), CHARS).cast("binary")).alias("converted_md5"), tx.has_convertible(F.col("text"), CHARS).alias("has_convertible"))


@query(
    "convertible_duplicates",
    f"SELECT count(*)::BIGINT AS n FROM (SELECT text, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents) WHERE k > 1 AND {CHARS_SQL} <> text",
)
def convertible_duplicates(spark, sf_dir):
    later = cs.later_occurrences(_documents(spark, sf_dir), F.col("text"), "doc_id")
    return later.filter(tx.has_convertible(F.col("text"), CHARS)).agg(F.count("*").alias("n"))


LINES_OF = r"string_split(text, chr(10))"


@query(
    "convertible_stats",
    f"""SELECT sum(len(l))::BIGINT AS n_texts, sum(len(list_filter(l, lambda x: {CHARS_SQL.replace("text", "x")} <> x)))::BIGINT AS n_matching,
 count(*) FILTER (len(list_filter(l, lambda x: {CHARS_SQL.replace("text", "x")} <> x)) > 0)::BIGINT AS n_items FROM (SELECT {LINES_OF} AS l FROM documents)""",
)
def convertible_stats(spark, sf_dir):
    docs = _documents(spark, sf_dir).select("doc_id", F.split("text", "\n", -1).alias("lines"))
    return cs.match_stats(docs, "doc_id", "lines", lambda t: tx.has_convertible(t, CHARS))


@query(
    "convertible_first10",
    f"""SELECT doc_id, (i - 1)::INTEGER AS place, line AS text FROM (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, {LINES_OF} AS l FROM documents))
 WHERE {CHARS_SQL.replace("text", "line")} <> line ORDER BY doc_id, place LIMIT 10""",
)
def convertible_first10(spark, sf_dir):
    docs = _documents(spark, sf_dir).select("doc_id", F.split("text", "\n", -1).alias("lines"))
    return cs.first_matches(docs, "doc_id", "lines", lambda t: tx.has_convertible(t, CHARS))


# --- statistics, duplicates, keywords -------------------------------------------------------------------------------


def _lines(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", "lang", F.posexplode(seg.segment(F.col("text"))).alias("pos", "piece")).withColumn("n", F.length("piece"))


@query(
    "chunk_extremes",
    f"""SELECT lang, hi.n AS max_n, hi.pos AS max_pos, hi.doc_id AS max_doc_id, hi.head AS max_head, lo.n AS min_n, lo.pos AS min_pos, lo.doc_id AS min_doc_id, lo.head AS min_head
 FROM (SELECT lang, max(s) AS hi, min(s) AS lo FROM (SELECT lang, {{'n': length(piece)::INTEGER, 'pos': pos::INTEGER, 'doc_id': doc_id, 'head': left(piece, 16)}} AS s FROM {LINES_SQL}) GROUP BY lang)""",
)
def chunk_extremes(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    return cs.extremes(lines, ["lang"], "n", ["pos", "doc_id"], {"head": F.left("piece", F.lit(16))})


@query(
    "chunk_mode",
    f"""SELECT lang, mode, n FROM (SELECT lang, mode, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, first) AS k FROM
 (SELECT lang, length(piece)::INTEGER AS mode, count(*)::BIGINT AS n, min({{'d': doc_id, 'p': pos}}) AS first FROM {LINES_SQL} GROUP BY lang, length(piece))) WHERE k = 1""",
)
def chunk_mode(spark, sf_dir):
    return cs.first_mode(_lines(spark, sf_dir), ["lang"], "n", ["doc_id", "pos"])


@query("exact_duplicates", "SELECT md5(text) AS text_md5, doc_id, n::BIGINT AS n FROM (SELECT text, doc_id, count(*) OVER (PARTITION BY text) AS n FROM documents) WHERE n > 1")
def exact_duplicates(spark, sf_dir):
    return cs.exact_duplicates(_documents(spark, sf_dir), F.col("text"), "doc_id").withColumnRenamed("item", "doc_id")


@query("duplicate_stats", "SELECT count(*)::BIGINT AS n_groups, coalesce(sum(n), 0)::BIGINT AS n_rows FROM (SELECT count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1)")
def duplicate_stats(spark, sf_dir):
    return cs.duplicate_stats(_documents(spark, sf_dir), F.col("text"))


@query("second_occurrence", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents) WHERE k > 1")
def second_occurrence(spark, sf_dir):
    return cs.later_occurrences(_documents(spark, sf_dir), F.col("text"), "doc_id").select("doc_id")


@query("distinct_chars", "SELECT ch, count(*)::BIGINT AS n FROM (SELECT unnest(regexp_extract_all(text, '(?s).')) AS ch FROM documents) GROUP BY ch")
def distinct_chars(spark, sf_dir):
    return cs.distinct_characters(_documents(spark, sf_dir), "text")


# Words of the driver's documents that stand for the drop keywords.
KEYWORDS = ["MIT License", "Apache", "License", "GNU General", "CC BY", "!!", "***", "$$$", "http", "@"]
KEYWORDS_SQL = "(SELECT unnest([" + ", ".join(f"'{k}'" for k in KEYWORDS) + "]) AS keyword)"
HITS_SQL = f"""(SELECT doc_id, keyword, substring(text, greatest(i - 8, 0) + 1, i + 8 - greatest(i - 8, 0)) AS snippet
 FROM (SELECT doc_id, text, keyword, strpos(text, keyword) - 1 AS i FROM documents, {KEYWORDS_SQL}) WHERE i >= 0)"""
PRIORITY_SQL = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length(keyword) DESC, keyword DESC) AS k FROM {HITS_SQL}) WHERE k = 1)"


def _hits(spark, sf_dir):
    return cs.keyword_hits(_documents(spark, sf_dir), "doc_id", "text", KEYWORDS)


@query("keyword_hits", f"SELECT doc_id, keyword FROM {HITS_SQL}")
def keyword_hits(spark, sf_dir):
    return _hits(spark, sf_dir).select("doc_id", "keyword")


@query("keyword_snippets", f"SELECT doc_id, keyword, snippet, doc_id || '___' || snippet AS rendered FROM {HITS_SQL}")
def keyword_snippets(spark, sf_dir):
    return _hits(spark, sf_dir).withColumn("rendered", F.concat_ws("___", F.col("doc_id").cast("string"), "snippet"))


@query("keyword_priority_dedup", f"SELECT doc_id, keyword, snippet FROM {PRIORITY_SQL}")
def keyword_priority_dedup(spark, sf_dir):
    return cs.keyword_priority(_hits(spark, sf_dir), "doc_id")


@query(
    "keyword_counts",
    f"""WITH c AS (SELECT keyword, count(p.doc_id)::BIGINT AS n FROM (SELECT DISTINCT keyword FROM {HITS_SQL}) k LEFT JOIN {PRIORITY_SQL} p USING (keyword) GROUP BY keyword)
 SELECT * FROM c UNION ALL SELECT 'total', coalesce(sum(n), 0)::BIGINT FROM c""",
)
def keyword_counts(spark, sf_dir):
    return cs.keyword_counts(_hits(spark, sf_dir), "doc_id")


DROP_SQL = "[" + ", ".join(f"'{k}'" for k in dict.fromkeys(cs.DROP_KEYWORDS)) + "]"
MARKED_SQL = f"(SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || k[doc_id % len(k) + 1] ELSE text END AS text FROM documents, (SELECT {DROP_SQL} AS k))"
DROP_HITS_SQL = f"(SELECT doc_id, keyword FROM {MARKED_SQL}, (SELECT unnest({DROP_SQL}) AS keyword) WHERE contains(text, keyword))"


@query(
    "drop_keyword_counts",
    f"""WITH p AS (SELECT doc_id, keyword FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length(keyword) DESC, keyword DESC) AS k FROM {DROP_HITS_SQL}) WHERE k = 1),
 c AS (SELECT keyword, count(p.doc_id)::BIGINT AS n FROM (SELECT DISTINCT keyword FROM {DROP_HITS_SQL}) h LEFT JOIN p USING (keyword) GROUP BY keyword)
 SELECT * FROM c UNION ALL SELECT 'total', coalesce(sum(n), 0)::BIGINT FROM c""",
)
def drop_keyword_counts(spark, sf_dir):
    """Every third document carries one of the drop keywords at its end, as invented prose holds none."""
    words = list(dict.fromkeys(cs.DROP_KEYWORDS))
    mark = F.get(F.array(*map(F.lit, words)), (F.col("doc_id") % len(words)).cast("int"))
    text = F.when(F.col("doc_id") % 3 == 0, F.concat("text", mark)).otherwise(F.col("text"))
    return cs.keyword_counts(cs.keyword_hits(_documents(spark, sf_dir).select("doc_id", text.alias("text")), "doc_id", "text", cs.DROP_KEYWORDS), "doc_id")


@query(
    "low_score_stats",
    """SELECT sum(len(s))::BIGINT AS n_scores, sum(len(list_filter(s, lambda x: x < 0.03)))::BIGINT AS n_low, count(*) FILTER (len(list_filter(s, lambda x: x < 0.03)) > 0)::BIGINT AS n_items
 FROM (SELECT l_orderkey, list(l_discount) AS s FROM lineitem GROUP BY l_orderkey)""",
)
def low_score_stats(spark, sf_dir):
    scores = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_discount").alias("scores"))
    return cs.low_score_stats(scores, "scores", 0.03)


@query(
    "repeated_ngrams",
    """SELECT doc_id, gram, count(*)::BIGINT AS n FROM (SELECT doc_id, ch || lead(ch, 1) OVER w || lead(ch, 2) OVER w || lead(ch, 3) OVER w || lead(ch, 4) OVER w || lead(ch, 5) OVER w AS gram
 FROM (SELECT doc_id, unnest(c) AS ch, unnest(range(len(c))) AS i FROM (SELECT doc_id, regexp_extract_all(text, '(?s).') AS c FROM documents)) WINDOW w AS (PARTITION BY doc_id ORDER BY i))
 WHERE gram IS NOT NULL GROUP BY doc_id, gram HAVING count(*) >= 3""",
)
def repeated_ngrams(spark, sf_dir):
    return cs.ngram_counts(_documents(spark, sf_dir), "doc_id", "text", 6, 3)


@query(
    "repeated_content",
    f"""WITH RECURSIVE t AS MATERIALIZED (SELECT conv_id, turn, text, length(text)::INTEGER AS size FROM conversations),
 w AS (SELECT conv_id, turn, text, size, unnest(range(size))::INTEGER AS x FROM t),
 c AS MATERIALIZED (SELECT *, CASE WHEN x + {repeats.MIN_LEN} > size THEN 1 ELSE (size - length(replace(text, substr(text, x + 1, {repeats.MIN_LEN}), ''))) // {repeats.MIN_LEN} END AS n FROM w),
 f AS (SELECT conv_id, turn, x, n, CASE WHEN n > 1 THEN coalesce(list_filter(range({repeats.MIN_LEN + 1}, least({repeats.MAX_LEN}, size - x) + 1),
 lambda k: (size - length(replace(text, substr(text, x + 1, k), ''))) // k < n)[1], 0) ELSE 0 END AS fall FROM c),
 g AS MATERIALIZED (SELECT conv_id, turn, list(fall ORDER BY x) AS falls, list(n ORDER BY x) AS ns FROM f GROUP BY conv_id, turn),
 r AS (SELECT conv_id, turn, 0::BIGINT AS x, falls FROM g
 UNION ALL SELECT conv_id, turn, x + greatest(falls[x + 1], 1), falls FROM r WHERE x + greatest(falls[x + 1], 1) < len(falls)),
 p AS (SELECT conv_id, turn, CASE WHEN g.falls[x + 1] > 0 THEN substr(text, x + 1, g.falls[x + 1] - 1) ELSE substr(text, x + 1) END AS pattern, ns[x + 1] AS n
 FROM (SELECT conv_id, turn, x FROM r) JOIN g USING (conv_id, turn) JOIN t USING (conv_id, turn) WHERE ns[x + 1] >= {repeats.REPEATS} AND (g.falls[x + 1] > 0 OR size - x < {repeats.MAX_LEN})),
 m AS (SELECT conv_id, turn, pattern, max(n) AS n FROM p GROUP BY conv_id, turn, pattern)
 SELECT pattern, arg_max(n, (turn, conv_id))::INTEGER AS n FROM m GROUP BY pattern""",
)
def repeated_content(spark, sf_dir):
    return repeats.merged_repeats(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")


# --- alignment ------------------------------------------------------------------------------------------------------


def _pairs(spark, sf_dir):
    """Even documents as source, the next ones as target."""
    docs = _documents(spark, sf_dir)
    left = docs.filter("doc_id % 2 = 0").select((F.col("doc_id") / 2).cast("long").alias("pair"), "source", F.col("text").alias("jp"))
    return left.join(docs.filter("doc_id % 2 = 1").select(((F.col("doc_id") - 1) / 2).cast("long").alias("pair"), F.col("text").alias("tw")), "pair")


PAIRS_SQL = "(SELECT a.doc_id // 2 AS pair, a.source, a.text AS jp, b.text AS tw FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1 WHERE a.doc_id % 2 = 0)"
SPLIT_TW = "SELECT pair, unnest(l) AS tw, unnest(range(len(l))) AS i FROM (SELECT pair, string_split(tw, chr(10)) AS l FROM {src})"


@query(
    "align_lines_full_outer",
    f"""SELECT pair, i::INTEGER AS line_idx, coalesce(jp, '') AS jp, coalesce(tw, '') AS tw FROM
 (SELECT pair, unnest(l) AS jp, unnest(range(len(l))) AS i FROM (SELECT pair, string_split(jp, chr(10)) AS l FROM {PAIRS_SQL})) FULL JOIN ({SPLIT_TW.format(src=PAIRS_SQL)}) USING (pair, i)""",
)
def align_lines_full_outer(spark, sf_dir):
    return align.align_lines(_pairs(spark, sf_dir), "pair", "jp", "tw")


def _conversation_chunks(spark, sf_dir):
    """Turns as source chunks, the document of the same number as the target text."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("jp"))
    docs = _documents(spark, sf_dir).select(F.col("doc_id").alias("conv_id"), F.col("text").alias("tw"))
    return turns.join(docs.select("conv_id"), "conv_id"), docs.join(turns.select("conv_id").distinct(), "conv_id")


CHUNKS_SQL = "(SELECT conv_id, turn, c.text AS jp, d.text AS tw FROM conversations c JOIN documents d ON d.doc_id = c.conv_id)"
DOCS_SQL = f"(SELECT DISTINCT conv_id, tw FROM {CHUNKS_SQL})"
FLAT_SQL = f"""(SELECT conv_id, turn, line AS jp, first + p AS i FROM (SELECT conv_id, turn, first, unnest(l) AS line, unnest(range(len(l))) AS p FROM
 (SELECT *, sum(len(l)) OVER (PARTITION BY conv_id ORDER BY turn) - len(l) AS first FROM (SELECT conv_id, turn, string_split(trim(jp, chr(10)), chr(10)) AS l FROM {CHUNKS_SQL}))))"""


@query(
    "align_lines_chunked",
    f"""SELECT conv_id, coalesce(turn, last) AS turn, i::INTEGER AS line_idx, coalesce(jp, '') AS jp, coalesce(tw, '') AS tw FROM {FLAT_SQL}
 FULL JOIN (SELECT conv_id, unnest(l) AS tw, unnest(range(len(l))) AS i FROM (SELECT conv_id, string_split(trim(tw, chr(10)), chr(10)) AS l FROM {DOCS_SQL})) USING (conv_id, i)
 JOIN (SELECT conv_id, max(turn) AS last FROM {CHUNKS_SQL} GROUP BY conv_id) USING (conv_id)""",
)
def align_lines_chunked(spark, sf_dir):
    chunks, docs = _conversation_chunks(spark, sf_dir)
    return align.align_chunked(chunks, docs, "conv_id", "turn", "jp", "tw")


THREE_SQL = f"""(SELECT conv_id, turn, j AS jp, t AS translation, first + p AS i FROM (SELECT conv_id, turn, first, unnest(j[:n]) AS j, unnest(t[:n]) AS t, unnest(range(n)) AS p FROM
 (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn) - n AS first FROM (SELECT *, least(len(j), len(t)) AS n FROM
 (SELECT conv_id, turn, string_split(trim(jp, chr(10)), chr(10)) AS j, string_split(trim(replace(jp, '. ', chr(10)), chr(10)), chr(10)) AS t FROM {CHUNKS_SQL})))))"""


@query(
    "align_three_way",
    f"""SELECT conv_id, coalesce(turn, last) AS turn, i::INTEGER AS line_idx, coalesce(jp, '') AS jp, coalesce(tw, '') AS tw, coalesce(translation, '') AS translation FROM {THREE_SQL}
 FULL JOIN (SELECT conv_id, unnest(l) AS tw, unnest(range(len(l))) AS i FROM (SELECT conv_id, string_split(tw, chr(10)) AS l FROM {DOCS_SQL})) USING (conv_id, i)
 JOIN (SELECT conv_id, max(turn) AS last FROM {CHUNKS_SQL} GROUP BY conv_id) USING (conv_id)""",
)
def align_three_way(spark, sf_dir):
    chunks, docs = _conversation_chunks(spark, sf_dir)
    chunks = chunks.withColumn("translation", F.replace("jp", F.lit(". "), F.lit("\n")))
    return align.align_three(chunks, docs, "conv_id", "turn", "jp", "translation", "tw")


SLICE_SQL = f"""(SELECT conv_id, turn, jp, array_to_string(CASE WHEN turn = last THEN l[first + 1:] ELSE l[first + 1:first + n] END, chr(10)) AS tw FROM
 (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn) - n AS first, max(turn) OVER (PARTITION BY conv_id) AS last FROM
 (SELECT conv_id, turn, jp, string_split(tw, chr(10)) AS l, length(jp) - length(replace(jp, chr(10), '')) + 1 AS n FROM {CHUNKS_SQL})))"""
SAME_SQL = "length(jp) - length(replace(jp, chr(10), '')) = length(tw) - length(replace(tw, chr(10), ''))"


@query("align_slice", f"SELECT conv_id, turn, jp, tw, arg_max({SAME_SQL}, turn) OVER (PARTITION BY conv_id) AS jp_tw_count_alignment FROM {SLICE_SQL}")
def align_slice(spark, sf_dir):
    chunks, docs = _conversation_chunks(spark, sf_dir)
    return align.count_alignment(align.align_slices(chunks, docs, "conv_id", "turn", "jp", "tw"), "conv_id", "turn")


MISMATCH_SQL = "len(string_split(trim(jp, chr(10)), chr(10))) <> len(string_split(trim(tw, chr(10)), chr(10)))"


@query("line_count_mismatch", f"SELECT pair, ends_with(jp, chr(10)) AS ends_newline FROM {PAIRS_SQL} WHERE {MISMATCH_SQL}")
def line_count_mismatch(spark, sf_dir):
    pairs = _pairs(spark, sf_dir).filter(tx.line_count_differs(F.col("jp"), F.col("tw")))
    return pairs.select("pair", F.endswith("jp", F.lit("\n")).alias("ends_newline"))


@query(
    "mismatch_by_source",
    f"""SELECT source, count(*) FILTER ({MISMATCH_SQL})::BIGINT AS n_mismatch, count(*) FILTER (({MISMATCH_SQL}) AND ends_with(jp, chr(10)))::BIGINT AS n_mismatch_newline,
 count(*)::BIGINT AS n_rows FROM {PAIRS_SQL} GROUP BY source""",
)
def mismatch_by_source(spark, sf_dir):
    return align.mismatch_report(_pairs(spark, sf_dir), "source", "jp", "tw")


@query(
    "status_tag",
    f"""SELECT source, bool_and(NOT ({MISMATCH_SQL})) AS passed, CASE WHEN bool_and(NOT ({MISMATCH_SQL})) THEN source ELSE 'not_pass_' || source END AS out_name FROM {PAIRS_SQL} GROUP BY source""",
)
def status_tag(spark, sf_dir):
    return align.file_status(_pairs(spark, sf_dir), "source", ~tx.line_count_differs(F.col("jp"), F.col("tw")))


@query(
    "numeric_suffix_pairing",
    """SELECT rank::INTEGER AS rank, a.name AS name_a, b.name AS name_b FROM
 (SELECT name, row_number() OVER (ORDER BY k, name) AS rank FROM (SELECT DISTINCT 'jp_' || substring(source, 4) || '.json' AS name, TRY_CAST(substring(source, 4) AS BIGINT) AS k FROM documents)) a JOIN
 (SELECT name, row_number() OVER (ORDER BY k, name) AS rank FROM (SELECT DISTINCT 'tw_' || substring(source, 4) || '.json' AS name, TRY_CAST(substring(source, 4) AS BIGINT) AS k FROM documents WHERE source <> 'src3')) b USING (rank)""",
)
def numeric_suffix_pairing(spark, sf_dir):
    names = _documents(spark, sf_dir).select("source").distinct()
    name = lambda side: F.concat(F.lit(side + "_"), F.substring("source", 4, 99), F.lit(".json"))
    return align.pair_by_suffix(names.select(name("jp").alias("name_a")), names.filter("source <> 'src3'").select(name("tw").alias("name_b")), "name_a", "name_b")


@query("archive_anti_copy", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def archive_anti_copy(spark, sf_dir):
    return _documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left_anti").select("doc_id", "source")


# --- windows --------------------------------------------------------------------------------------------------------

TOKENS_SQL = "greatest(len(regexp_extract_all(piece, '[A-Za-z0-9]+|[^A-Za-z0-9 \\t\\n\\r\\f]')), 1)"
SENTENCES_SQL = f"(SELECT doc_id, pos, piece, n, sum(n) OVER (PARTITION BY doc_id ORDER BY pos) - n AS start FROM (SELECT doc_id, pos, piece, {{size}} AS n FROM {LINES_SQL}))"
BY_TOKENS = SENTENCES_SQL.format(size=TOKENS_SQL)
BY_CHARS = SENTENCES_SQL.format(size="length(piece)")


def _sentences(spark, sf_dir):
    return _lines(spark, sf_dir).select("doc_id", "pos", "piece")


@query(
    "context_window_512",
    f"SELECT doc_id, pos::INTEGER AS pos, md5(coalesce(string_agg(piece, '' ORDER BY start) OVER (PARTITION BY doc_id ORDER BY start RANGE BETWEEN 512 PRECEDING AND 1 PRECEDING), '')) AS context_md5 FROM {BY_TOKENS}",
)
def context_window_512(spark, sf_dir):
    out = windows.look_back(_sentences(spark, sf_dir), ["doc_id"], "pos", "piece", tx.token_count(F.col("piece")), 512)
    return out.select("doc_id", "pos", F.md5(F.col("context").cast("binary")).alias("context_md5"))


@query(
    "lookahead_64",
    f"""SELECT doc_id, pos::INTEGER AS pos, md5(array_to_string(list_slice(all_, pos + 1, pos + greatest(k, 1)), '')) AS lookahead_md5 FROM
 (SELECT a.*, list(piece) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS all_,
  (SELECT count(*) FROM {BY_TOKENS} b WHERE b.doc_id = a.doc_id AND b.start >= a.start AND b.start + b.n <= a.start + 64) AS k FROM {BY_TOKENS} a)""",
)
def lookahead_64(spark, sf_dir):
    out = windows.look_ahead(_sentences(spark, sf_dir), ["doc_id"], "pos", "piece", tx.token_count(F.col("piece")), 64)
    return out.select("doc_id", "pos", F.md5(F.col("lookahead").cast("binary")).alias("lookahead_md5"))


@query(
    "char_context_8192",
    f"""SELECT doc_id, pos::INTEGER AS pos, md5((SELECT string_agg(b.piece, '' ORDER BY b.pos) FROM {BY_CHARS} b WHERE b.doc_id = a.doc_id AND (b.pos = a.pos OR (b.pos < a.pos AND b.start >= a.start + a.n - 8192)))) AS context_md5
 FROM {BY_CHARS} a""",
)
def char_context_8192(spark, sf_dir):
    out = windows.char_context(_sentences(spark, sf_dir), ["doc_id"], "pos", "piece", F.length("piece"), 8192)
    return out.select("doc_id", "pos", F.md5(F.col("context").cast("binary")).alias("context_md5"))


@query("forward_mean_3", "SELECT l_orderkey, l_linenumber, round(avg(l_discount) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING), 6) AS forward_mean FROM (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS l_linenumber, l_discount FROM lineitem)")
def forward_mean_3(spark, sf_dir):
    out = windows.forward_mean(_line_items(spark, sf_dir), ["l_orderkey"], "l_linenumber", "l_discount")
    return out.select("l_orderkey", "l_linenumber", F.round("forward_mean", 6).alias("forward_mean"))


def _line_items(spark, sf_dir):
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", F.row_number().over(order).cast("long").alias("l_linenumber"), "l_discount")


@query(
    "argmin_cut",
    "SELECT l_orderkey, m.p AS l_linenumber, m.v AS l_discount FROM (SELECT l_orderkey, min({'v': l_discount, 'p': l_linenumber}) AS m FROM (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS l_linenumber, l_discount FROM lineitem) GROUP BY l_orderkey)",
)
def argmin_cut(spark, sf_dir):
    return windows.argmin(_line_items(spark, sf_dir), ["l_orderkey"], "l_linenumber", "l_discount").select("l_orderkey", "l_linenumber", "l_discount")


@query(
    "proportion_threshold_chunks",
    """SELECT user_id, event_id, sum(CASE WHEN share > m * 2 AND k > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id)::INTEGER AS segment FROM
 (SELECT *, median(share) OVER (PARTITION BY user_id) AS m FROM
 (SELECT user_id, event_id, value / sum(value) OVER (PARTITION BY user_id) AS share, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events))""",
)
def proportion_threshold_chunks(spark, sf_dir):
    shares = windows.proportions(table(spark, sf_dir, "events").select("user_id", "event_id", "value"), ["user_id"], "value", pos="event_id")
    return windows.threshold_cuts(shares, ["user_id"], "event_id", "proportion", 2.0).select("user_id", "event_id", "segment")


@query("perplexity_guard", "SELECT event_id, CASE WHEN value > 90 THEN 1.7976931348623157e308 ELSE round(exp(value / 100), 9) END AS ppl FROM events")
def perplexity_guard(spark, sf_dir):
    loss = F.when(F.col("value") > 90, F.lit(float("nan"))).otherwise(F.col("value") / 100)
    ppl = vec.perplexity(loss)
    return table(spark, sf_dir, "events").select("event_id", F.when(F.isnan(loss), ppl).otherwise(vec.rounded(ppl, 9)).alias("ppl"))


# --- vectors and rules ----------------------------------------------------------------------------------------------


def _triples(spark, sf_dir):
    """Vectors 3k, 3k+1 and 3k+2 as source, target and other."""
    v = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    part = lambda i, name: v.filter(F.col("vec_id") % 3 == i).select(((F.col("vec_id") - i) / 3).cast("long").alias("k"), F.col("embedding").alias(name))
    return part(0, "a").join(part(1, "b"), "k").join(part(2, "c"), "k")


TRIPLES_SQL = "(SELECT a.vec_id // 3 AS k, a.embedding::DOUBLE[] AS a, b.embedding::DOUBLE[] AS b, c.embedding::DOUBLE[] AS c FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 JOIN embeddings c ON c.vec_id = a.vec_id + 2 WHERE a.vec_id % 3 = 0)"
SIM_JP, SIM_TR = "abs(list_cosine_similarity(a, b) - list_cosine_similarity(a, c))", "list_cosine_similarity(b, c)"


@query("cosine_adjacent", "SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cos FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def cosine_adjacent(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    after = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("after"))
    return v.join(after, "vec_id").select("vec_id", F.round(vec.cosine(F.col("embedding"), F.col("after")), 6).alias("cos"))


@query("similarity_gap", f"SELECT k, round({SIM_JP}, 6) AS similarity_to_jp, round({SIM_TR}, 6) AS similarity_translation FROM {TRIPLES_SQL}")
def similarity_gap(spark, sf_dir):
    gap, same = vec.similarity_gap(F.col("a"), F.col("b"), F.col("c"))
    return _triples(spark, sf_dir).select("k", F.round(gap, 6).alias("similarity_to_jp"), F.round(same, 6).alias("similarity_translation"))


def _any_sql(words: list[str]) -> str:
    return "(" + " OR ".join(f"contains(tw, '{w}')" for w in words) + ")"


@query(
    "examine_cascade",
    f"""SELECT k, CASE WHEN {_any_sql(examine.FIRST_WORDS)} OR ({_any_sql(examine.TOP_WORDS)} AND {_any_sql(examine.SECOND_WORDS)}) THEN 'True_匹配'
 WHEN (right(jp, 1) <> right(tw, 1) OR right(tr, 1) <> right(tw, 1)) AND (s > 0.05 OR t < 0.95) THEN 'True_尾字不同' WHEN s > 0.15 OR t < 0.75 THEN 'True_小於' ELSE 'False' END AS examine
 FROM (SELECT k, {SIM_JP} AS s, {SIM_TR} AS t, x.text AS jp, y.text AS tw, z.text AS tr FROM {TRIPLES_SQL} v JOIN documents x ON x.doc_id = v.k * 3 JOIN documents y ON y.doc_id = v.k * 3 + 1 JOIN documents z ON z.doc_id = v.k * 3 + 2)""",
)
def examine_cascade(spark, sf_dir):
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    part = lambda i, name: docs.filter(F.col("doc_id") % 3 == i).select(((F.col("doc_id") - i) / 3).cast("long").alias("k"), F.col("text").alias(name))
    rows = _triples(spark, sf_dir).join(part(0, "jp"), "k").join(part(1, "tw"), "k").join(part(2, "tr"), "k")
    gap, same = vec.similarity_gap(F.col("a"), F.col("b"), F.col("c"))
    rule = examine.examine(F.col("jp"), F.col("tw"), F.col("tr"), gap, same)
    return rows.select("k", rule.alias("examine"))


# --- glossaries, answers, concatenation -----------------------------------------------------------------------------


def _glossary(spark, sf_dir):
    """The first words of benchmark items as entries: a source word, an upper-case target, parts to look for."""
    words = F.split("text", " ")
    item = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("entry"), words.alias("w"))
    return item.select(
        "entry", F.get("w", 1).alias("jp"), F.upper(F.get("w", 2)).alias("tw"), F.when(F.col("entry") % 2 == 0, F.get("w", 3)).otherwise("").alias("info"), F.array(F.get("w", 1), F.get("w", 4)).alias("match")
    )


GLOSSARY_SQL = "(SELECT item_id AS entry, w[2] AS jp, upper(w[3]) AS tw, CASE WHEN item_id % 2 = 0 THEN w[4] ELSE '' END AS info, [w[2], w[5]] AS match FROM (SELECT item_id, string_split(text, ' ') AS w FROM benchmark))"
MATCHES_SQL = f"(SELECT doc_id, g.* FROM documents c JOIN {GLOSSARY_SQL} g ON contains(c.text, g.match[1]) OR contains(c.text, g.match[2]))"
ENTRY_SQL = "jp || '->' || tw || CASE WHEN info <> '' THEN ' #' || info ELSE '' END"


def _glossary_matches(spark, sf_dir):
    return glossary.match_glossary(_documents(spark, sf_dir), "text", _glossary(spark, sf_dir), ["doc_id"])


@query("glossary_match", f"SELECT doc_id, entry FROM {MATCHES_SQL}")
def glossary_match(spark, sf_dir):
    return _glossary_matches(spark, sf_dir).select("doc_id", "entry")


@query("glossary_match_parts", f"SELECT doc_id, entry FROM {MATCHES_SQL}")
def glossary_match_parts(spark, sf_dir):
    """A glossary of several parts."""
    return glossary.match_glossary(_documents(spark, sf_dir), "text", _glossary(spark, sf_dir), ["doc_id"], 500).select("doc_id", "entry")


@query("glossary_prompt", f"SELECT doc_id, string_agg({ENTRY_SQL}, chr(10) ORDER BY entry) AS prompt, count(*)::BIGINT AS n FROM {MATCHES_SQL} GROUP BY doc_id")
def glossary_prompt(spark, sf_dir):
    return glossary.glossary_prompts(_glossary_matches(spark, sf_dir), ["doc_id"])


@query("glossary_prompt_compat", f"SELECT doc_id, string_agg(CASE WHEN info <> '' THEN {ENTRY_SQL} ELSE '' END, chr(10) ORDER BY entry) AS prompt, count(*)::BIGINT AS n FROM {MATCHES_SQL} GROUP BY doc_id")
def glossary_prompt_compat(spark, sf_dir):
    return glossary.glossary_prompts(_glossary_matches(spark, sf_dir), ["doc_id"], compat=True)


@query(
    "glossary_files",
    f"SELECT (row_number() OVER (PARTITION BY jp[1] ORDER BY entry) - 1)::INTEGER AS entry, jp, tw, info, array_to_string(match, '|') AS match FROM {GLOSSARY_SQL}",
)
def glossary_files(spark, sf_dir):
    """A glossary file for each initial, written and read back; entries are numbered within their file."""
    entries = _glossary(spark, sf_dir).withColumn("initial", F.substring("jp", 1, 1))
    name = F.concat(F.hex(F.coalesce("initial", F.lit(""))), F.lit(".json"))
    at = files.shared_folder(spark)
    files.write_named_texts(files.json_arrays(entries, "initial", ["entry"], ["jp", "tw", "info", "match"]).withColumn("name", name), at, "name", "text")
    return files.read_glossary(spark, at).withColumn("match", F.array_join("match", "|"))


@query("glossary_size", f"SELECT (sum(length({ENTRY_SQL})) + count(*) - 1)::BIGINT AS n_chars, count(*)::BIGINT AS n_entries FROM {GLOSSARY_SQL}")
def glossary_size(spark, sf_dir):
    return glossary.glossary_size(_glossary(spark, sf_dir))


def _responses(spark, sf_dir):
    turn = F.col("turn")
    tag = lambda a: F.concat(F.lit("<answer>\n"), F.lit(a), F.lit("\n</answer>"))
    said = F.when(turn % 4 == 0, F.concat(tag("False"), "text", tag("True"))).when(turn % 4 == 1, F.concat("text", tag("False"))).when(turn % 4 == 2, F.col("text")).otherwise(F.concat(F.lit("<answer>True</answer>"), "text"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", said.alias("response"))


def _tag_sql(answer: str) -> str:
    return f"('<answer>' || chr(10) || '{answer}' || chr(10) || '</answer>')"


RESPONSES_SQL = f"""(SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN {_tag_sql("False")} || text || {_tag_sql("True")} WHEN 1 THEN text || {_tag_sql("False")} WHEN 2 THEN text ELSE '<answer>True</answer>' || text END AS response FROM conversations)"""
ANSWERS_SQL = f"(SELECT conv_id, turn, response, coalesce(regexp_extract_all(response, '<answer>\\n(True|False)\\n</answer>', 1)[-1], 'True_NoAnswer') AS unaligned FROM {RESPONSES_SQL})"


@query("answer_extract", f"SELECT conv_id, turn, unaligned FROM {ANSWERS_SQL}")
def answer_extract(spark, sf_dir):
    return _responses(spark, sf_dir).select("conv_id", "turn", tx.last_answer(F.col("response")).alias("unaligned"))


@query("flagged_response", f"SELECT conv_id, turn, md5(CASE WHEN contains(unaligned, 'True') THEN response ELSE '' END) AS kept_md5 FROM {ANSWERS_SQL}")
def flagged_response(spark, sf_dir):
    answered = _responses(spark, sf_dir).withColumn("unaligned", tx.last_answer(F.col("response")))
    return answered.select("conv_id", "turn", F.md5(tx.flagged_response(F.col("unaligned"), F.col("response")).cast("binary")).alias("kept_md5"))


@query("flagged_conversations", f"SELECT conv_id, bool_or(contains(unaligned, 'True')) AS flagged FROM {ANSWERS_SQL} GROUP BY conv_id")
def flagged_conversations(spark, sf_dir):
    answered = _responses(spark, sf_dir).withColumn("unaligned", tx.last_answer(F.col("response")))
    return answered.groupBy("conv_id").agg(F.bool_or(F.contains("unaligned", F.lit("True"))).alias("flagged"))


@query("named_texts", "SELECT conv_id || '.' || role || '.txt' AS name, md5(string_agg(text, '' ORDER BY turn)) AS text_md5 FROM conversations GROUP BY conv_id, role")
def named_texts(spark, sf_dir):
    """One file for each conversation and role, written and read back."""
    texts = files.ordered_text(table(spark, sf_dir, "conversations"), ["conv_id", "role"], ["turn"], "text")
    at = files.shared_folder(spark)
    files.write_named_texts(texts.withColumn("name", files.text_name(F.col("conv_id"), F.col("role"))), at, "name", "text")
    name = F.url_decode(F.element_at(F.split("file", "/"), -1))
    return files.read_texts(spark, at).select(name.alias("name"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query("json_files", "SELECT conv_id, turn, role, md5(text) AS text_md5 FROM conversations")
def json_files(spark, sf_dir):
    """One JSON array for each conversation, written and read back."""
    at = files.shared_folder(spark)
    files.write_json(table(spark, sf_dir, "conversations"), at, "conv_id", ["turn"], ["turn", "role", "text"])
    back = files.read_json_arrays(spark, at, "array<struct<turn:long,role:string,text:string>>", "*.txt")
    return back.select(F.regexp_extract("file", r"file=(-?\d+)/", 1).cast("long").alias("conv_id"), "turn", "role", F.md5(F.col("text").cast("binary")).alias("text_md5"))


OCR_SQL = "(SELECT doc_id, source, string_split(text, chr(10)) AS l, list_transform(string_split(text, chr(10)), lambda x: (length(x) % 100) / 100.0::DOUBLE) AS s FROM documents)"


@query(
    "ocr_files",
    f"""SELECT source || '/' || doc_id || '.png' AS input_path, len(l)::BIGINT AS n_texts, md5(array_to_string(l, chr(10))) AS texts_md5, round(list_sum(s), 6) AS score,
 len(list_filter(s, lambda x: x < 0.8))::BIGINT AS n_low, (20.0 * len(l))::DOUBLE AS bottom FROM {OCR_SQL}""",
)
def ocr_files(spark, sf_dir):
    """A JSON object for each page in a tree of folders, its lines as recognised texts, written and read back."""
    line = F.split("text", "\n", -1)
    score = lambda x: (F.length(x) % 100) / F.lit(100.0)
    box = lambda x, i: F.array(*(F.array((i + dy).cast("double") * 20, F.length(x).cast("double") * dx) for dy, dx in ((0, 0), (0, 1), (1, 1), (1, 0))))
    name = F.concat("source", F.lit("/"), "doc_id")
    page = F.struct(F.concat(name, F.lit(".png")).alias("input_path"), line.alias("rec_texts"), F.transform(line, score).alias("rec_scores"), F.transform(line, box).alias("rec_polys"))
    at = files.shared_folder(spark)
    files.write_named_texts(_documents(spark, sf_dir).select(F.concat(name, F.lit(".json")).alias("name"), F.to_json(page).alias("text")), at, "name", "text")
    back = files.read_json_objects(spark, at)
    bottom = F.array_max(F.flatten(F.transform("rec_polys", lambda p: F.transform(p, lambda q: q[0]))))
    total = F.aggregate("rec_scores", F.lit(0.0), lambda a, x: a + x)
    return back.select(
        "input_path", F.size("rec_texts").cast("long").alias("n_texts"), F.md5(F.array_join("rec_texts", "\n").cast("binary")).alias("texts_md5"), F.round(total, 6).alias("score"),
        F.size(F.filter("rec_scores", lambda x: x < 0.8)).cast("long").alias("n_low"), bottom.alias("bottom"),
    )


@query("valid_texts", "SELECT conv_id, role, md5(string_agg(text, '' ORDER BY turn)) AS text_md5 FROM conversations WHERE role <> 'assistant' GROUP BY conv_id, role")
def valid_texts(spark, sf_dir):
    """A tree of files of which those of one role are no UTF-8; the others are read back."""
    texts = files.ordered_text(table(spark, sf_dir, "conversations"), ["conv_id", "role"], ["turn"], "text")
    data = F.when(F.col("role") == "assistant", F.encode("text", "UTF-16")).otherwise(F.encode("text", "UTF-8"))
    at = files.shared_folder(spark)
    files.write_named_texts(texts.select(F.concat("conv_id", F.lit("/"), "role", F.lit(".txt")).alias("name"), data.alias("data")), at, "name", "data")
    back = files.read_valid_texts(spark, at, "*.txt")
    part = lambda i: F.element_at(F.split("file", "/"), i)
    return back.select(part(-2).cast("long").alias("conv_id"), F.regexp_replace(part(-1), r"\.txt$", "").alias("role"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query("parquet_files", "SELECT source, lang, count(*)::BIGINT AS n, sum(length(text))::BIGINT AS chars FROM documents WHERE lang = 'en' GROUP BY source, lang")
def parquet_files(spark, sf_dir):
    """Documents in folders by language, written and one folder of them read back."""
    at = files.shared_folder(spark)
    files.write_parquet(_documents(spark, sf_dir), at, ["lang"])
    return spark.read.parquet(at).filter("lang = 'en'").groupBy("source", "lang").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@query("ordered_concat", "SELECT conv_id, string_agg(text, '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def ordered_concat(spark, sf_dir):
    return files.ordered_text(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], "text")


@query(
    "contents_chapter",
    "SELECT conv_id, 0 AS chapter_idx, 'contents' AS title, string_agg(role || turn, chr(10) ORDER BY turn) AS content FROM conversations WHERE text <> '' GROUP BY conv_id UNION ALL SELECT conv_id, (turn + 1)::INTEGER, role || turn, text FROM conversations WHERE text <> ''",
)
def contents_chapter(spark, sf_dir):
    chapters = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("int").alias("chapter_idx"), F.concat("role", F.col("turn").cast("string")).alias("title"), F.col("text").alias("content"))
    return files.with_contents(chapters, "conv_id")


@query("prompt_template", "SELECT pair, 'JP: ' || jp || chr(10) || 'TW: {note} ' || tw AS prompt FROM " + PAIRS_SQL)
def prompt_template(spark, sf_dir):
    return _pairs(spark, sf_dir).select("pair", tx.fill_template("JP: {jp}\nTW: {note} {tw}", jp=F.col("jp"), tw=F.col("tw")).alias("prompt"))


REGEN_SQL = f"CASE WHEN {MISMATCH_SQL} THEN list_last(string_split(jp, chr(10))) ELSE tw END"


@query("selective_regen", f"SELECT pair, md5({REGEN_SQL.replace('list_last(string_split(jp, chr(10)))', 'string_split(jp, chr(10))[-1]')}) AS tw_md5 FROM {PAIRS_SQL}")
def selective_regen(spark, sf_dir):
    out = models.regenerate(_pairs(spark, sf_dir), tx.line_count_differs(F.col("jp"), F.col("tw")), F.col("jp"), models.EchoGenerator(), "tw")
    return out.select("pair", F.md5(F.col("tw").cast("binary")).alias("tw_md5"))


# --- geometry -------------------------------------------------------------------------------------------------------


def _boxes(spark, sf_dir):
    """Axis-aligned boxes on a page for each order, from the integers of its lines."""
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    cut = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", number.cast("long").alias("box"))
    x, y, w, h = F.col("l_partkey") % 97, F.col("l_suppkey") % 89, F.col("l_quantity") + 1, F.col("l_partkey") % 13 + 2
    return cut.select("l_orderkey", "box", x.cast("double").alias("x"), y.cast("double").alias("y"), w.cast("double").alias("w"), h.cast("double").alias("h"))


BOXES_SQL = """(SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS box,
 (l_partkey % 97)::DOUBLE AS x, (l_suppkey % 89)::DOUBLE AS y, l_quantity + 1 AS w, (l_partkey % 13 + 2)::DOUBLE AS h FROM lineitem)"""
PAIR_BOXES_SQL = f"(SELECT a.l_orderkey, a.box AS a, b.box AS b, a.x AS ax, a.y AS ay, a.w AS aw, a.h AS ah, b.x AS bx, b.y AS by_, b.w AS bw, b.h AS bh FROM {BOXES_SQL} a JOIN {BOXES_SQL} b ON a.l_orderkey = b.l_orderkey AND a.box < b.box)"


def _quads(spark, sf_dir):
    return _boxes(spark, sf_dir).withColumn("quad", boxes.quad_column(F.col("x"), F.col("y"), F.col("w"), F.col("h")))


def _quad_pairs(spark, sf_dir):
    q = _quads(spark, sf_dir)
    one = lambda p: q.select("l_orderkey", *[F.col(c).alias(p + c) for c in ("box", "x", "y", "w", "h", "quad")])
    return one("a").join(one("b"), "l_orderkey").filter("abox < bbox")


@query("polygon_overlap", f"SELECT l_orderkey, a, b FROM {PAIR_BOXES_SQL} WHERE least(ax + aw - bx, bx + bw - ax) >= 0 AND least(ay + ah - by_, by_ + bh - ay) >= 0")
def polygon_overlap(spark, sf_dir):
    return boxes.overlapping_pairs(_quads(spark, sf_dir), "l_orderkey", "box", "quad")


@query("polygon_gap", f"SELECT l_orderkey, a, b, round(least(ax + aw - bx, bx + bw - ax, ay + ah - by_, by_ + bh - ay), 6) AS gap FROM {PAIR_BOXES_SQL}")
def polygon_gap(spark, sf_dir):
    return _quad_pairs(spark, sf_dir).select("l_orderkey", F.col("abox").alias("a"), F.col("bbox").alias("b"), F.round(geo.overlap_gap(F.col("aquad"), F.col("bquad")), 6).alias("gap"))


ORIENT = "(({b}x - {a}x) * ({c}y - {a}y) - ({b}y - {a}y) * ({c}x - {a}x))"
DIAGONALS_SQL = f"(SELECT l_orderkey, a, b, ax AS px, ay AS py, ax + aw AS qx, ay + ah AS qy, bx AS rx, by_ AS ry, bx + bw AS sx, by_ + bh AS sy FROM {PAIR_BOXES_SQL})"


def _orient_sql(a: str, b: str, c: str) -> str:
    return ORIENT.format(a=a, b=b, c=c)


def _on_sql(a: str, b: str, c: str) -> str:
    return f"({c}x BETWEEN least({a}x, {b}x) AND greatest({a}x, {b}x) AND {c}y BETWEEN least({a}y, {b}y) AND greatest({a}y, {b}y))"


def _diagonals(spark, sf_dir):
    """The diagonals of two boxes as points p-q and r-s."""
    at = lambda k, far: geo.point(F.col(k + "x") + (F.col(k + "w") if far else 0), F.col(k + "y") + (F.col(k + "h") if far else 0))
    return _quad_pairs(spark, sf_dir).select("l_orderkey", F.col("abox").alias("a"), F.col("bbox").alias("b"), at("a", False).alias("p"), at("a", True).alias("q"), at("b", False).alias("r"), at("b", True).alias("s"), "aquad")


@query(
    "segments_intersect",
    f"""SELECT l_orderkey, a, b, (o1 * o2 < 0 AND o3 * o4 < 0) OR (o1 = 0 AND {_on_sql("p", "q", "r")}) OR (o2 = 0 AND {_on_sql("p", "q", "s")}) OR (o3 = 0 AND {_on_sql("r", "s", "p")}) OR (o4 = 0 AND {_on_sql("r", "s", "q")}) AS crosses
 FROM (SELECT *, {_orient_sql("p", "q", "r")} AS o1, {_orient_sql("p", "q", "s")} AS o2, {_orient_sql("r", "s", "p")} AS o3, {_orient_sql("r", "s", "q")} AS o4 FROM {DIAGONALS_SQL})""",
)
def segments_intersect(spark, sf_dir):
    p, q, r, s = map(F.col, "pqrs")
    return _diagonals(spark, sf_dir).select("l_orderkey", "a", "b", geo.segments_intersect(p, q, r, s).alias("crosses"))


@query("orientation", f"SELECT l_orderkey, a, b, {_orient_sql('p', 'q', 'r')} AS turn FROM {DIAGONALS_SQL}")
def orientation(spark, sf_dir):
    return _diagonals(spark, sf_dir).select("l_orderkey", "a", "b", geo.orientation(F.col("p"), F.col("q"), F.col("r")).alias("turn"))


@query("line_intersection", f"""SELECT l_orderkey, a, b, round(px + t * (qx - px), 6) AS x, round(py + t * (qy - py), 6) AS y FROM
 (SELECT *, CASE WHEN d <> 0 THEN ((rx - px) * (sy - ry) - (ry - py) * (sx - rx)) / d END AS t FROM (SELECT *, (qx - px) * (sy - ry) - (qy - py) * (sx - rx) AS d FROM {DIAGONALS_SQL}))""")
def line_intersection(spark, sf_dir):
    at = geo.line_intersection(*map(F.col, "pqrs"))
    return _diagonals(spark, sf_dir).select("l_orderkey", "a", "b", F.round(at["x"], 6).alias("x"), F.round(at["y"], 6).alias("y"))


@query("point_in_polygon", f"SELECT l_orderkey, a, b, bx BETWEEN ax AND ax + aw AND by_ BETWEEN ay AND ay + ah AS inside FROM {PAIR_BOXES_SQL}")
def point_in_polygon(spark, sf_dir):
    return _diagonals(spark, sf_dir).select("l_orderkey", "a", "b", geo.point_in_polygon(F.col("aquad"), F.col("r")).alias("inside"))


@query(
    "point_segment_distance",
    f"""SELECT l_orderkey, a, b, round(sqrt((rx - px - t * (qx - px)) ** 2 + (ry - py - t * (qy - py)) ** 2), 6) AS distance FROM
 (SELECT *, greatest(0, least(1, ((rx - px) * (qx - px) + (ry - py) * (qy - py)) / ((qx - px) ** 2 + (qy - py) ** 2))) AS t FROM {DIAGONALS_SQL})""",
)
def point_segment_distance(spark, sf_dir):
    return _diagonals(spark, sf_dir).select("l_orderkey", "a", "b", F.round(geo.segment_distance(F.col("p"), F.col("q"), F.col("r")), 6).alias("distance"))


@query(
    "box_groups",
    f"""WITH RECURSIVE b AS MATERIALIZED {BOXES_SQL}, o AS MATERIALIZED (SELECT l_orderkey, c.box AS a, d.box AS b FROM b c JOIN b d USING (l_orderkey)
 WHERE least(c.x + c.w - d.x, d.x + d.w - c.x) >= 0 AND least(c.y + c.h - d.y, d.y + d.h - c.y) >= 0),
 r AS (SELECT l_orderkey, box, box AS seen FROM b UNION SELECT r.l_orderkey, r.box, o.b FROM r JOIN o ON o.l_orderkey = r.l_orderkey AND o.a = r.seen)
 SELECT l_orderkey, first AS "group", count(*)::INTEGER AS n_boxes FROM (SELECT l_orderkey, box, min(seen) AS first FROM r GROUP BY l_orderkey, box) GROUP BY l_orderkey, first""",
)
def box_groups(spark, sf_dir):
    sized = _quads(spark, sf_dir).withColumn("width", F.lit(160.0)).withColumn("height", F.lit(120.0))
    return boxes.merge_boxes(sized, "l_orderkey", "box", "quad").select("l_orderkey", "group", "n_boxes")


def _merged_sql() -> str:
    """Corners are settled one after another, then points from the furthest one on move them; lists count from 1."""
    near = "list_transform(range(1, 5), lambda c: list_sort(list_transform(range(1, len(px) + 1), lambda k: {'d': sqrt((cx[c] - px[k]) * (cx[c] - px[k]) + (cy[c] - py[k]) * (cy[c] - py[k])), 'k': k}))[1:2])"
    steps, last = "", "c0"
    for i in range(1, 5):
        j = i % 4 + 1
        first = f"near[{i}][2].d < near[{j}][2].d"
        same = f"len(px) > 1 AND px[q[{i}]] = px[q[{j}]] AND py[q[{i}]] = py[q[{j}]]"
        at = lambda k: f"CASE WHEN {same} AND {first} AND {k} = {i} THEN near[{i}][2].k WHEN {same} AND NOT ({first}) AND {k} = {j} THEN near[{j}][2].k ELSE q[{k}] END"  # noqa: E731, B023
        steps += f"c{i} AS (SELECT * EXCLUDE (q), [{', '.join(at(k) for k in range(1, 5))}] AS q FROM {last}),\n"
        last = f"c{i}"
    t = "greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce(CASE WHEN ex * ex + ey * ey <> 0 THEN (ox * ex + oy * ey) / (ex * ex + ey * ey) END, 0.0::DOUBLE)))"
    inside = lambda op: " AND ".join(f"(qx[{i % 4 + 1}] - qx[{i}]) * (p_y - qy[{i}]) - (qy[{i % 4 + 1}] - qy[{i}]) * (p_x - qx[{i}]) {op} 0" for i in range(1, 5))
    return f"""WITH RECURSIVE b AS MATERIALIZED {BOXES_SQL}, o AS MATERIALIZED (SELECT l_orderkey, c.box AS a, d.box AS b FROM b c JOIN b d USING (l_orderkey)
 WHERE least(c.x + c.w - d.x, d.x + d.w - c.x) >= 0 AND least(c.y + c.h - d.y, d.y + d.h - c.y) >= 0),
 r AS (SELECT l_orderkey, box, box AS seen FROM b UNION SELECT r.l_orderkey, r.box, o.b FROM r JOIN o ON o.l_orderkey = r.l_orderkey AND o.a = r.seen),
 g AS MATERIALIZED (SELECT l_orderkey, g, count(*) AS n_boxes, flatten(list([x, x + w, x + w, x] ORDER BY box)) AS px, flatten(list([y, y, y + h, y + h] ORDER BY box)) AS py,
 [0.0, 160.0, 160.0, 0.0]::DOUBLE[] AS cx, [0.0, 0.0, 120.0, 120.0]::DOUBLE[] AS cy FROM (SELECT l_orderkey, box, min(seen) AS g FROM r GROUP BY l_orderkey, box) JOIN b USING (l_orderkey, box) GROUP BY l_orderkey, g),
 n AS MATERIALIZED (SELECT *, {near} AS near FROM g WHERE n_boxes > 1),
 c0 AS (SELECT *, list_transform(near, lambda x: x[1].k) AS q FROM n),
 {steps} s AS MATERIALIZED (SELECT l_orderkey, g, px, py, list_transform(q, lambda k: px[k]) AS qx, list_transform(q, lambda k: py[k]) AS qy FROM c4),
 e AS (SELECT l_orderkey, g, k, i, px[k] AS p_x, py[k] AS p_y, qx[i + 1] - qx[i] AS ex, qy[i + 1] - qy[i] AS ey, px[k] - qx[i] AS ox, py[k] - qy[i] AS oy FROM
 (SELECT l_orderkey, g, px, py, list_append(qx, qx[1]) AS qx, list_append(qy, qy[1]) AS qy, unnest(range(1, len(px) + 1)) AS k FROM s) CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS i)),
 d AS (SELECT l_orderkey, g, k, i, p_x, p_y, sqrt((ox - t * ex) * (ox - t * ex) + (oy - t * ey) * (oy - t * ey)) AS d FROM (SELECT *, {t} AS t FROM e)),
 w AS MATERIALIZED (SELECT l_orderkey, g, p_x, p_y, i, row_number() OVER (PARTITION BY l_orderkey, g ORDER BY d DESC, k) AS nth FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, g, k ORDER BY d, i) AS own FROM d) WHERE own = 1),
 f AS (SELECT l_orderkey, g, 0::BIGINT AS nth, qx, qy FROM s
 UNION ALL SELECT l_orderkey, g, nth, list_transform([1, 2, 3, 4], lambda z: CASE WHEN z = spot AND NOT within AND t IS NOT NULL THEN ax + t * (bx - ax) ELSE qx[z] END), list_transform([1, 2, 3, 4], lambda z: CASE WHEN z = spot AND NOT within AND t IS NOT NULL THEN ay + t * (by_ - ay) ELSE qy[z] END) FROM
 (SELECT *, CASE WHEN (bx - ax) * (dy - p_y) - (by_ - ay) * (dx - p_x) <> 0 THEN ((p_x - ax) * (dy - p_y) - (p_y - ay) * (dx - p_x)) / ((bx - ax) * (dy - p_y) - (by_ - ay) * (dx - p_x)) END AS t FROM
 (SELECT *, qx[spot] AS ax, qy[spot] AS ay, qx[along] AS bx, qy[along] AS by_, qx[other] AS dx, qy[other] AS dy FROM
 (SELECT *, CASE WHEN nearer THEN i ELSE j END AS spot, CASE WHEN nearer THEN (i + 2) % 4 + 1 ELSE (i + 1) % 4 + 1 END AS along, CASE WHEN nearer THEN j ELSE i END AS other FROM
 (SELECT w.l_orderkey, w.g, w.nth, w.p_x, w.p_y, w.i, w.i % 4 + 1 AS j, f.qx, f.qy, ({inside(">=")}) OR ({inside("<=")}) AS within,
 sqrt((qx[w.i] - p_x) * (qx[w.i] - p_x) + (qy[w.i] - p_y) * (qy[w.i] - p_y)) < sqrt((qx[w.i % 4 + 1] - p_x) * (qx[w.i % 4 + 1] - p_x) + (qy[w.i % 4 + 1] - p_y) * (qy[w.i % 4 + 1] - p_y)) AS nearer
 FROM f JOIN w ON w.l_orderkey = f.l_orderkey AND w.g = f.g AND w.nth = f.nth + 1))))),
 a AS (SELECT l_orderkey, g, n_boxes, px AS qx, py AS qy FROM g WHERE n_boxes = 1 UNION ALL SELECT l_orderkey, g, n_boxes, f.qx, f.qy FROM f JOIN g USING (l_orderkey, g) WHERE n_boxes > 1 AND nth = len(px))
 SELECT l_orderkey, g AS "group", n_boxes::INTEGER AS n_boxes, {", ".join(f"round(q{c}[{i}], 6) + 0.0 AS {c}{i}" for i in range(1, 5) for c in "xy")} FROM a"""


def _corners(merged):
    at = [(vec.rounded(F.get("quad", i - 1)[c], 6) + 0.0).alias(f"{c}{i}") for i in range(1, 5) for c in "xy"]
    return merged.select("l_orderkey", "group", "n_boxes", *at)


@query("merge_bboxes", _merged_sql())
def merge_bboxes(spark, sf_dir):
    sized = _quads(spark, sf_dir).withColumn("width", F.lit(160.0)).withColumn("height", F.lit(120.0))
    return _corners(boxes.merge_boxes(sized, "l_orderkey", "box", "quad"))


@query("merge_bboxes_tiled", _merged_sql())
def merge_bboxes_tiled(spark, sf_dir):
    """All pages as large ones are: copies joined, overlaps (on grids where a page has many polygons), groups, rows of groups."""
    sized = _quads(spark, sf_dir).withColumn("width", F.lit(160.0)).withColumn("height", F.lit(120.0))
    return _corners(boxes.merge_boxes(sized, "l_orderkey", "box", "quad", small_page=0))


# --- markup and chunking --------------------------------------------------------------------------------------------


#: The tables' references are those replaced here, &amp; last; so are ones that a page's end cuts.
HTML_TEXT_SQL = r"""regexp_replace(replace(replace(replace(replace(replace(regexp_replace(
 CASE WHEN regexp_matches(h, '(?is)<body\b') THEN regexp_extract(h, '(?is)<body\b[^>]*>(.*?)(?:</body\s*>|\z)', 1) ELSE h END,
 '(?s)</?[A-Za-z](?:[^''">]|"[^"]*"|''[^'']*'')*>', '', 'g'), '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g')"""
VISIBLE_SQL = r"""(SELECT page_id, regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<template\b.*?</template\s*>|<![^>]*>', '', 'g') AS h FROM pages)"""


@query("html_text", rf"""SELECT page_id, regexp_replace(trim(x, E' \t\n\r\f\x0b'), '\n+', chr(10), 'g') AS text FROM (SELECT page_id, {HTML_TEXT_SQL} AS x FROM {VISIBLE_SQL})""")
def html_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tx.collapse_newlines(html.html_text(F.col("html"))).alias("text"))


@query("html_elements")
def html_elements(spark, sf_dir):
    @F.pandas_udf("array<struct<tag_rank:int,pos:int,text:string>>")
    def elements(html):
        return html.map(lambda h: [] if h is None else [{"tag_rank": r, "pos": i, "text": n.get_text()} for r, i, n in markup.text_elements(markup.parse_html(h))])

    return table(spark, sf_dir, "pages").select("page_id", F.explode(elements("html")).alias("e")).select("page_id", "e.*")


def _scored(spark, sf_dir):
    """Sentences with a score from their place and length, and a loss from their length."""
    rows = _sentences(spark, sf_dir).withColumn("n", F.length("piece"))
    return rows.withColumn("score", (F.col("n") * 7 + F.col("pos") * 13) % 101 / 101.0).withColumn("loss", F.log(F.col("n") + 1.0))


SCORED_SQL = f"(SELECT *, length(piece) AS chars, ((length(piece) * 7 + pos * 13) % 101)::DOUBLE / 101::DOUBLE AS score, ln(length(piece) + 1.0) AS loss FROM {LINES_SQL})"
PIECE_TOKENS_SQL = r"len(regexp_extract_all(piece, '[A-Za-z0-9]+|[^A-Za-z0-9 \t\n\r\f]')) + regexp_matches(piece, '[ \t\n\r\f]\z')::INTEGER"


def _bisect_sql(size: str, budget: int, mean: str) -> str:
    """Sentences lo to hi, counted from 1, are cut before the smallest mean until they fit."""
    return f"""WITH RECURSIVE g AS MATERIALIZED (SELECT doc_id, list(piece ORDER BY pos) AS p, list(score ORDER BY pos) AS s, list({size} ORDER BY pos) AS z FROM {SCORED_SQL} GROUP BY doc_id),
 c AS (SELECT doc_id, 1::BIGINT AS lo, len(p)::BIGINT AS hi FROM g
 UNION ALL SELECT doc_id, unnest([lo, cut]), unnest([cut - 1, hi]) FROM (SELECT doc_id, lo, hi, lo + list_position(m, list_min(m)) AS cut FROM
 (SELECT doc_id, lo, hi, list_transform(range(lo + 1, hi + 1), lambda i: {mean}) AS m FROM c JOIN g USING (doc_id) WHERE hi > lo AND list_sum(z[lo:hi]) > {budget})))
 SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY lo) - 1)::INTEGER AS chunk_idx, array_to_string(p[lo:hi], '') AS chunk FROM c JOIN g USING (doc_id) WHERE hi = lo OR list_sum(z[lo:hi]) <= {budget}"""


@query("bisect_chunks", _bisect_sql("chars", chunking.MAX_CHARS, "CASE WHEN i + 2 <= hi THEN (s[i] + s[i + 1] + s[i + 2]) / 3 WHEN i < hi THEN (s[i] + s[i + 1]) / 2 ELSE s[i] END"))
def bisect_chunks(spark, sf_dir):
    return chunking.bisect_chunks(_scored(spark, sf_dir), ["doc_id"], "pos", "piece", "score")


@query("bisect_chunks_tokens", _bisect_sql(PIECE_TOKENS_SQL, chunking.MAX_TOKENS, "s[i]"))
def bisect_chunks_tokens(spark, sf_dir):
    return chunking.bisect_chunks(_scored(spark, sf_dir), ["doc_id"], "pos", "piece", "score", chunking.MAX_TOKENS, 1, by_tokens=True)


def _bigram_sql(a: str, b: str) -> str:
    """The built-in embedder's hash of two code points."""
    first = f"((({a}::UHUGEINT * 4294967296 + {b}::UHUGEINT) * 11400714819323198485::UHUGEINT) % 18446744073709551616::UHUGEINT)::UBIGINT"
    return f"((xor({first}, {first} >> 29)::UHUGEINT * 13787848793156543929::UHUGEINT) % 18446744073709551616::UHUGEINT)::UBIGINT"


CODES_SQL = "list_transform(regexp_extract_all({text}, '(?s).'), lambda c: unicode(c))"
#: bigrams (k, a, b) of texts (k, t), each with its component and sign, to vectors of 64 sums
VECTOR_SQL = f"""SELECT k, list_transform(range(64), lambda i: coalesce(m[i], 0)::DOUBLE) AS v FROM (SELECT k, map_from_entries(list((bin, v))) AS m FROM
 (SELECT k, bin, sum(sign) AS v FROM {{bigrams}} JOIN (SELECT a, b, ((h >> 32) % 64)::BIGINT AS bin, CASE WHEN h >> 63 = 1 THEN 1 ELSE -1 END AS sign
 FROM (SELECT a, b, {_bigram_sql("a", "b")} AS h FROM (SELECT DISTINCT a, b FROM {{bigrams}}))) USING (a, b) GROUP BY k, bin) GROUP BY k)"""
UNNESTED_SQL = "SELECT k, unnest(c[:len(c) - 1]) AS a, unnest(c[2:]) AS b FROM (SELECT k, {codes} AS c FROM {texts})"
COSINE_SQL = "CASE WHEN list_inner_product({x}, {x}) * list_inner_product({y}, {y}) > 0 THEN list_inner_product({x}, {y}) / sqrt(list_inner_product({x}, {x}) * list_inner_product({y}, {y})) ELSE 0 END"


def _merge_sql(size: str, budget: int, both: bool) -> str:
    """Chunks with sizes s, vectors v, cosines c to the next one and first lines f; x is the left one of the pair that joins next.

    d is what a chunk's start adds to the sum of two vectors: the bigram that leads into it, less the one at the other's end.
    """
    none, zipped = "list_transform(range(64), lambda i: 0::DOUBLE)", "list_transform(list_zip({x}, {y}), lambda z: z[1] {sign} z[2])"
    fits = lambda i: f"s[{i}] + s[{i} + 1] <= {budget}"
    alike = f"CASE WHEN round(c[i - 1], 12) > round(c[i], 12) THEN CASE WHEN {fits('i - 1')} THEN i - 1 END WHEN {fits('i')} THEN i END"
    if both:
        alike = f"CASE WHEN {fits('i')} AND {fits('i - 1')} THEN {alike} WHEN {fits('i')} THEN i WHEN {fits('i - 1')} THEN i - 1 END"
    left = f"CASE WHEN i = 1 THEN CASE WHEN len(s) > 1 AND {fits('1')} THEN 1 END WHEN i = len(s) THEN CASE WHEN {fits('i - 1')} THEN i - 1 END ELSE {alike} END"
    pick = f"list_min(list_transform(range(1, len(s) + 1), lambda i: (s[i] << 40) + (i << 20) + ({left}))) & 1048575 AS x"
    cosine = lambda i: COSINE_SQL.format(x=f"v[{i}]", y=f"v[{i} + 1]")
    joined = zipped.format(x=zipped.format(x="v[x]", y="v[x + 1]", sign="+"), y="d[x + 1]", sign="+")
    return f"""WITH RECURSIVE l AS MATERIALIZED (SELECT doc_id, pos, piece, ({size})::BIGINT AS n, lag(piece[-1]) OVER w AS prev FROM {LINES_SQL} WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
 t AS (SELECT (doc_id, pos, 0) AS k, piece || chr(10) AS t FROM l UNION ALL SELECT (doc_id, pos, 1), prev || piece[1] FROM l WHERE prev IS NOT NULL
 UNION ALL SELECT (doc_id, pos, 2), prev || chr(10) FROM l WHERE prev IS NOT NULL),
 b AS MATERIALIZED ({UNNESTED_SQL.format(codes=CODES_SQL.format(text="t"), texts="t")}), e AS MATERIALIZED ({VECTOR_SQL.format(bigrams="b")}),
 g AS (SELECT doc_id, list(n ORDER BY pos) AS s, list(v ORDER BY pos) AS v, list(d ORDER BY pos) AS d, list(pos ORDER BY pos) AS f FROM
 (SELECT doc_id, pos, n, coalesce(v0.v, {none}) AS v, {zipped.format(x=f"coalesce(v1.v, {none})", y=f"coalesce(v2.v, {none})", sign="-")} AS d FROM l
 {" ".join(f"LEFT JOIN e v{i} ON v{i}.k = (doc_id, pos, {i})" for i in range(3))}) GROUP BY doc_id),
 r(doc_id, s, v, d, f, c, x) USING KEY (doc_id) AS (SELECT *, {pick} FROM (SELECT *, list_transform(range(1, len(s)), lambda i: {cosine("i")}) AS c FROM g)
 UNION SELECT *, {pick} FROM (SELECT doc_id, s, v, d, f, list_concat(list_concat(c[1:greatest(x - 2, 0)], CASE WHEN x > 1 THEN [{cosine("x - 1")}] ELSE [] END),
 list_concat(CASE WHEN x < len(s) THEN [{cosine("x")}] ELSE [] END, c[x + 2:])) AS c FROM
 (SELECT doc_id, list_concat(list_append(s[1:x - 1], s[x] + s[x + 1]), s[x + 2:]) AS s, list_concat(list_append(v[1:x - 1], {joined}), v[x + 2:]) AS v,
 list_concat(d[1:x], d[x + 2:]) AS d, list_concat(f[1:x], f[x + 2:]) AS f, c, x FROM r WHERE x IS NOT NULL))),
 h AS (SELECT doc_id, unnest(f) AS lo, unnest(list_append(f[2:], NULL)) AS hi, unnest(range(len(f)))::INTEGER AS chunk_idx FROM r)
 SELECT doc_id, chunk_idx, string_agg(piece, '' ORDER BY pos) AS chunk FROM h JOIN l USING (doc_id) WHERE pos >= lo AND (hi IS NULL OR pos < hi) GROUP BY doc_id, chunk_idx"""


@query("merge_small_chunks", _merge_sql("length(piece)", chunking.MAX_CHARS, False))
def merge_small_chunks(spark, sf_dir):
    return chunking.merge_small_chunks(_sentences(spark, sf_dir), ["doc_id"], "pos", "piece")


@query("merge_small_chunks_tokens", _merge_sql(PIECE_TOKENS_SQL, chunking.MAX_TOKENS, True))
def merge_small_chunks_tokens(spark, sf_dir):
    return chunking.merge_small_chunks(_sentences(spark, sf_dir), ["doc_id"], "pos", "piece", chunking.MAX_TOKENS, only_if_both=True, by_tokens=True)


def _fold_sql(threshold: float) -> str:
    """A line's own bigrams, the one at its end and the one that leads into it make the vectors of chunks, line by line."""
    none = "list_transform(range(64), lambda i: 0::DOUBLE)"
    vectors = VECTOR_SQL.format(bigrams="b")
    added = "list_transform(list_zip({x}, {y}), lambda z: z[1] + z[2])"
    chunk = added.format(x="f.s", y="n.before")
    return f"""WITH RECURSIVE l AS MATERIALIZED (SELECT doc_id, pos, piece, lag(piece[-1]) OVER w AS prev FROM {LINES_SQL} WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
 t AS (SELECT (doc_id, pos, 0) AS k, piece AS t FROM l UNION ALL SELECT (doc_id, pos, 1), piece[-1] || chr(10) FROM l
 UNION ALL SELECT (doc_id, pos, 2), prev || piece[1] FROM l WHERE prev IS NOT NULL UNION ALL SELECT (doc_id, pos, 3), prev || chr(10) FROM l WHERE prev IS NOT NULL),
 b AS MATERIALIZED ({UNNESTED_SQL.format(codes=CODES_SQL.format(text="t"), texts="t")}), v AS MATERIALIZED ({vectors}),
 n AS MATERIALIZED (SELECT doc_id, pos, own, {added.format(x="own", y="at_end")} AS whole, {added.format(x="own", y="at_start")} AS joined, before FROM
 (SELECT doc_id, pos, {", ".join(f"coalesce(v{i}.v, {none}) AS {n}" for i, n in enumerate(("own", "at_end", "at_start", "before")))} FROM l
 {" ".join(f"LEFT JOIN v v{i} ON v{i}.k = (doc_id, pos, {i})" for i in range(4))})),
 f AS (SELECT doc_id, pos, 0 AS chunk_idx, own AS s FROM n WHERE pos = 0
 UNION ALL SELECT doc_id, pos, CASE WHEN same THEN chunk_idx ELSE chunk_idx + 1 END, CASE WHEN same THEN {added.format(x="s", y="joined")} ELSE own END FROM
 (SELECT n.doc_id, n.pos, f.chunk_idx, f.s, n.own, n.joined, round({COSINE_SQL.format(x=chunk, y="n.whole")}, 12) >= {threshold} AS same FROM f JOIN n ON n.doc_id = f.doc_id AND n.pos = f.pos + 1))
 SELECT doc_id, chunk_idx::INTEGER AS chunk_idx, string_agg(piece, '' ORDER BY pos) AS chunk FROM f JOIN l USING (doc_id, pos) GROUP BY doc_id, chunk_idx"""


@query("semantic_chunks", _fold_sql(0.4))
def semantic_chunks(spark, sf_dir):
    return chunking.semantic_chunks(_sentences(spark, sf_dir), ["doc_id"], "pos", "piece")


@query("semantic_chunks_strict", _fold_sql(0.8))
def semantic_chunks_strict(spark, sf_dir):
    return chunking.semantic_chunks(_sentences(spark, sf_dir), ["doc_id"], "pos", "piece", 0.8)


@query(
    "rechunk_decay",
    f"""WITH RECURSIVE g AS MATERIALIZED (SELECT doc_id, list(piece ORDER BY pos) AS p, list(loss ORDER BY pos) AS l, list(chars ORDER BY pos) AS z FROM {SCORED_SQL} GROUP BY doc_id),
 m AS MATERIALIZED (SELECT *, coalesce(list_aggregate(l[2:], 'median'), 0) AS med FROM g),
 c AS (SELECT doc_id, 1::BIGINT AS lo, len(p)::BIGINT AS hi, -1 AS k FROM g
 UNION ALL SELECT doc_id, unnest(a), unnest(list_append(list_transform(a[2:], lambda x: x - 1), hi)), k + 1 FROM (SELECT doc_id, hi, k,
 list_prepend(lo, list_filter(range(lo + 1, hi + 1), lambda i: l[i] > med * {chunking.THRESHOLD} * pow({chunking.DECAY}, k + 1))) AS a
 FROM c JOIN m USING (doc_id) WHERE k < 0 OR (hi > lo AND list_sum(z[lo:hi]) > {chunking.MAX_SCORED})))
 SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY lo) - 1)::INTEGER AS chunk_idx, array_to_string(p[lo:hi], '') AS chunk FROM c JOIN g USING (doc_id)
 WHERE k >= 0 AND (hi = lo OR list_sum(z[lo:hi]) <= {chunking.MAX_SCORED})""",
)
def rechunk_decay(spark, sf_dir):
    return chunking.rechunk_decay(_scored(spark, sf_dir), ["doc_id"], "pos", "piece", "loss")


DELIMITERS_SQL = "[" + chunking.DELIMITERS.replace("\n", r"\n") + "]"
PIECE_PARTS_SQL = r"regexp_extract_all({piece}, '[ \t\n\r\f]*(?:[A-Za-z0-9]+|[^A-Za-z0-9 \t\n\r\f])|[ \t\n\r\f]+\z')"


def _similarity_sql(back: int, ahead: int, fill: bool) -> str:
    """f sentences lie too far back, e end within what follows; the next one of either side is cut where contexts are filled."""
    end_ = PIECE_PARTS_SQL.format(piece="p[f]")
    cut_back = f"CASE WHEN f > 0 AND {back} - (st[pos + 1] - st[f + 1]) > 0 THEN array_to_string(list_slice({end_}, -({back} - (st[pos + 1] - st[f + 1])), -1), '') ELSE '' END"
    cut_ahead = f"CASE WHEN e < len(p) AND {ahead} - (en[e] - st[pos + 1]) > 0 THEN array_to_string(list_slice({PIECE_PARTS_SQL.format(piece='p[e + 1]')}, 1, {ahead} - (en[e] - st[pos + 1])), '') ELSE '' END"
    if fill:
        cut_back = f"(SELECT CASE WHEN regexp_matches(x, '{DELIMITERS_SQL}') THEN regexp_extract(x, '(?s)^[^{DELIMITERS_SQL[1:]}*{DELIMITERS_SQL}+(.*)$', 1) ELSE x END FROM (SELECT {cut_back} AS x))"
        cut_ahead = f"(SELECT CASE WHEN regexp_matches(x, '{DELIMITERS_SQL}') THEN regexp_extract(x, '(?s)^(.*{DELIMITERS_SQL})', 1) ELSE x END FROM (SELECT {cut_ahead} AS x))"
    else:
        cut_back = cut_ahead = "''"
    return f"""WITH s AS (SELECT doc_id, pos, piece, n, sum(n) OVER (PARTITION BY doc_id ORDER BY pos)::BIGINT AS en FROM (SELECT doc_id, pos, piece, ({PIECE_TOKENS_SQL})::BIGINT AS n FROM {LINES_SQL})),
 g AS MATERIALIZED (SELECT doc_id, list(piece ORDER BY pos) AS p, list(en - n ORDER BY pos) AS st, list(en ORDER BY pos) AS en FROM s GROUP BY doc_id),
 o AS MATERIALIZED (SELECT *, len(list_filter(st, lambda x: x < st[pos + 1] - {back})) AS f, greatest(len(list_filter(en, lambda x: x <= st[pos + 1] + {ahead})), pos + 1) AS e
 FROM (SELECT *, unnest(range(len(p))) AS pos FROM g)),
 c AS MATERIALIZED (SELECT doc_id, pos, p[pos + 1] AS piece, {cut_back} || array_to_string(list_slice(p, f + 1, pos), '') AS x, array_to_string(list_slice(p, pos + 1, e), '') || {cut_ahead} AS y FROM o),
 t AS (SELECT (doc_id, pos, 0) AS k, x || chr(10) AS t FROM c WHERE pos > 0 UNION ALL SELECT (doc_id, pos, 1), y || chr(10) FROM c WHERE pos > 0),
 b AS MATERIALIZED ({UNNESTED_SQL.format(codes=CODES_SQL.format(text="t"), texts="t")}), v AS MATERIALIZED ({VECTOR_SQL.format(bigrams="b")})
 SELECT doc_id, pos::INTEGER AS pos, piece AS sentence, round(CASE WHEN pos = 0 THEN 1.0::DOUBLE WHEN a.v IS NULL OR d.v IS NULL THEN 0 ELSE {COSINE_SQL.format(x="a.v", y="d.v")} END, 6) AS similarity
 FROM c LEFT JOIN v a ON a.k = (doc_id, pos, 0) LEFT JOIN v d ON d.k = (doc_id, pos, 1)"""


def _similarity(spark, sf_dir, fill):
    out = chunking.similarity_distribution(_sentences(spark, sf_dir), ["doc_id"], "pos", "piece", 512, 64, fill)
    return out.withColumn("similarity", F.round("similarity", 6))


@query("similarity_distribution", _similarity_sql(512, 64, False))
def similarity_distribution(spark, sf_dir):
    return _similarity(spark, sf_dir, False)


@query("similarity_distribution_filled", _similarity_sql(512, 64, True))
def similarity_distribution_filled(spark, sf_dir):
    return _similarity(spark, sf_dir, True)


@query(
    "perplexity_distribution",
    f"""WITH g AS MATERIALIZED (SELECT doc_id, pos, piece, string_agg(piece, '') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS whole,
 sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY pos)::BIGINT - length(piece) AS start FROM {LINES_SQL}),
 c AS (SELECT doc_id, pos, piece, regexp_extract_all(piece, '(?s).') AS t, regexp_extract_all(substring(whole, greatest(start - 4096, 0) + 1, least(start, 4096)), '(?s).') AS x FROM g),
 m AS (SELECT *, CASE WHEN len(x) > 0 THEN list_aggregate(x, 'histogram') END AS seen FROM c),
 l AS (SELECT doc_id, pos, piece, CASE WHEN pos = 0 THEN 0::DOUBLE ELSE -list_avg(list_transform(t, lambda ch: ln((coalesce(seen[ch], 0) + 1)::DOUBLE
 / (len(x) + cardinality(seen) + len(list_filter(list_distinct(t), lambda d: seen[d] IS NULL)))))) END AS loss FROM m)
 SELECT doc_id, pos::INTEGER AS pos, piece AS sentence, round(loss, 6) AS loss, round(CASE WHEN pos = 0 THEN 0 ELSE exp(loss) END, 6) AS perplexity FROM l""",
)
def perplexity_distribution(spark, sf_dir):
    out = chunking.perplexity_distribution(_sentences(spark, sf_dir), ["doc_id"], "pos", "piece")
    return out.withColumn("loss", F.round("loss", 6)).withColumn("perplexity", F.round("perplexity", 6))


@query("similarity_distribution_batched", _similarity_sql(512, 64, False))
def similarity_distribution_batched(spark, sf_dir):
    """Distinct contexts of several groups embedded in batches of similar length."""
    out = chunking.batched_similarity_distribution(_sentences(spark, sf_dir), ["doc_id"], "pos", "piece", 512, 64)
    return out.withColumn("similarity", F.round("similarity", 6))


@query("embedded_texts", f"""WITH d AS MATERIALIZED (SELECT DISTINCT coalesce(text, '') AS t FROM conversations), t AS (SELECT t AS k, t || chr(10) AS t FROM d),
 b AS MATERIALIZED ({UNNESTED_SQL.format(codes=CODES_SQL.format(text="t"), texts="t")}), v AS MATERIALIZED ({VECTOR_SQL.format(bigrams="b")})
 SELECT md5(t) AS key, list_position(v, list_max(v))::INTEGER AS largest, round(CASE WHEN list_inner_product(v, v) > 0 THEN list_max(v) / sqrt(list_inner_product(v, v)) ELSE 0 END, 6) AS at_most FROM d LEFT JOIN v ON v.k = d.t""")
def embedded_texts(spark, sf_dir):
    """Every distinct turn once: the place and size of its vector's largest component."""
    vectors = models.embed_texts(table(spark, sf_dir, "conversations"), "text", models.HashedEmbedder())
    return vectors.select("key", F.array_position("vector", F.array_max("vector")).cast("int").alias("largest"), F.round(F.array_max("vector"), 6).alias("at_most"))


@query(
    "perplexity_distribution_tokens",
    f"""WITH s AS (SELECT doc_id, pos, piece, {PIECE_PARTS_SQL.format(piece="piece")} AS t FROM {LINES_SQL}),
 w AS MATERIALIZED (SELECT doc_id, flatten(list(t ORDER BY pos)) AS whole FROM s GROUP BY doc_id),
 o AS (SELECT doc_id, pos, piece, t, sum(len(t)) OVER (PARTITION BY doc_id ORDER BY pos)::BIGINT - len(t) AS st FROM s),
 c AS (SELECT doc_id, pos, piece, t, whole[greatest(st - greatest(4096 - len(t), 0), 0) + 1:st] AS x FROM o JOIN w USING (doc_id)),
 m AS (SELECT *, CASE WHEN len(x) > 0 THEN list_aggregate(x, 'histogram') END AS seen FROM c),
 l AS (SELECT doc_id, pos, piece, CASE WHEN pos = 0 THEN 0::DOUBLE ELSE -list_avg(list_transform(t, lambda k: ln((coalesce(seen[k], 0) + 1)::DOUBLE
 / (len(x) + coalesce(cardinality(seen), 0) + len(list_filter(list_distinct(t), lambda d: seen[d] IS NULL)))))) END AS loss FROM m)
 SELECT doc_id, pos::INTEGER AS pos, piece AS sentence, round(loss, 6) AS loss, round(CASE WHEN pos = 0 THEN 0 ELSE exp(loss) END, 6) AS perplexity FROM l""",
)
def perplexity_distribution_tokens(spark, sf_dir):
    out = chunking.windowed_perplexity(_sentences(spark, sf_dir), ["doc_id"], "pos", "piece")
    return out.withColumn("loss", F.round("loss", 6)).withColumn("perplexity", F.round("perplexity", 6))


@query(
    "ngram_perplexity",
    f"""WITH s AS (SELECT doc_id, pos, regexp_extract_all(piece, '[A-Za-z0-9]+|[^A-Za-z0-9 \t\n\r\f]') AS t FROM {LINES_SQL}),
 f AS (SELECT doc_id, pos, t, coalesce(last_value(t[-1] IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS h FROM s),
 p AS MATERIALIZED (SELECT doc_id, pos, unnest(list_prepend(h, t[:-2])) AS h, unnest(t) AS w FROM f WHERE len(t) > 0),
 words AS (SELECT w, count(*) AS cw FROM p GROUP BY w), heads AS (SELECT h, count(*) AS ch FROM p GROUP BY h), pairs AS (SELECT h, w, count(*) AS c FROM p GROUP BY h, w),
 z AS (SELECT sum(cw) + count(*) + 1 AS z FROM words),
 q AS (SELECT h, w, ln((c + {ngrams.MASS} * (cw + 1) / z) / (ch + {ngrams.MASS})) AS lnp FROM pairs JOIN words USING (w) JOIN heads USING (h) CROSS JOIN z)
 SELECT doc_id, pos::INTEGER AS pos, count(*)::BIGINT AS n_tokens, round(-avg(lnp), 6) AS loss, round(exp(-avg(lnp)), 6) AS perplexity FROM p JOIN q USING (h, w) GROUP BY doc_id, pos""",
)
def ngram_perplexity(spark, sf_dir):
    """Sentences under a bigram model of the whole corpus; those without tokens have no perplexity."""
    sentences = _sentences(spark, sf_dir)
    tokens = ngrams.sentence_tokens(sentences, ["doc_id"], "pos", "piece")
    counted = ngrams.block_pairs(tokens, ["doc_id"], "pos")
    model = ngrams.train(sentences, ["doc_id"], "pos", "piece", tokens, counted)
    out = ngrams.score_sentences(sentences, model, ["doc_id"], "pos", "piece", tokens, counted).filter("n_tokens > 0")
    return out.withColumn("loss", F.round("loss", 6)).withColumn("perplexity", F.round("perplexity", 6))


@query("answers_routed", f"SELECT pair, md5(string_split(jp, chr(10))[-1]) AS answer_md5, length(tw)::INTEGER AS tw_chars FROM {PAIRS_SQL}")
def answers_routed(spark, sf_dir):
    """Answers that come in any order find their rows by request id."""
    pairs = _pairs(spark, sf_dir)
    answers = models.answer_requests(pairs, ["pair"], F.col("jp"), models.SteppedEcho)
    return models.route(pairs, answers, ["pair"]).select("pair", F.md5(F.col("response").cast("binary")).alias("answer_md5"), F.length("tw").alias("tw_chars"))


# --- the smaller rest -----------------------------------------------------------------------------------------------


@query("chapter_zip", "SELECT doc_id, source, quality FROM documents JOIN labels USING (doc_id)")
def chapter_zip(spark, sf_dir):
    return align.zip_chapters(_documents(spark, sf_dir), table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "source", "quality")


@query("only_newline_lines", f"SELECT count(*) FILTER (replace(piece, chr(10), '') = '')::BIGINT AS n_blank, count(*)::BIGINT AS n FROM {LINES_SQL}")
def only_newline_lines(spark, sf_dir):
    return _sentences(spark, sf_dir).agg(F.count_if(tx.only_newlines(F.col("piece"))).alias("n_blank"), F.count("*").alias("n"))


@query(
    "title_forward_fill",
    "SELECT user_id, event_id, last_value(CASE WHEN event_type = 'click' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS title FROM events",
)
def title_forward_fill(spark, sf_dir):
    marked = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_type") == "click", F.col("event_id")).alias("title"))
    return windows.forward_fill(marked, ["user_id"], "event_id", "title")


@query(
    "proportion_median",
    "SELECT user_id, round(median(share), 9) AS median_share FROM (SELECT user_id, value / sum(value) OVER (PARTITION BY user_id) AS share FROM events) GROUP BY user_id",
)
def proportion_median(spark, sf_dir):
    shares = windows.proportions(table(spark, sf_dir, "events").select("user_id", "event_id", "value"), ["user_id"], "value", pos="event_id")
    return shares.groupBy("user_id").agg(vec.rounded(F.median("proportion"), 9).alias("median_share"))


@query("json_arrays", "SELECT conv_id, md5(to_json(list({'turn': turn, 'role': role, 'text': text} ORDER BY turn))) AS json_md5 FROM conversations GROUP BY conv_id")
def json_arrays(spark, sf_dir):
    arrays = files.json_arrays(table(spark, sf_dir, "conversations"), "conv_id", ["turn"], ["turn", "role", "text"])
    return arrays.select("conv_id", F.md5(F.col("text").cast("binary")).alias("json_md5"))


@query("concat_by_role", "SELECT role, md5(string_agg(text, '' ORDER BY conv_id, turn)) AS text_md5 FROM conversations GROUP BY role")
def concat_by_role(spark, sf_dir):
    """One file for each role, written by all tasks, and its digest."""
    joined = files.write_joined(table(spark, sf_dir, "conversations"), files.shared_folder(spark), "role", ["conv_id", "turn"], "text")
    return files.file_digests(joined).select(F.col("name").alias("role"), F.col("md5").alias("text_md5"))


@query("glossary_tokens", f"SELECT (sum(greatest(len(regexp_extract_all({ENTRY_SQL}, '[A-Za-z0-9]+|[^A-Za-z0-9 \\t\\n\\r\\f]')), 1)) + count(*) - 1)::BIGINT AS n_chars, count(*)::BIGINT AS n_entries FROM {GLOSSARY_SQL}")
def glossary_tokens(spark, sf_dir):
    return glossary.glossary_size(_glossary(spark, sf_dir), tx.token_count(F.col("line")))
