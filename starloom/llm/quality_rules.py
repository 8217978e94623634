"""Quality rules, line first, in DataFrame expressions only.

Every line with a word is held against rules of punctuation, navigation and
boilerplate; failing lines are removed. A document that loses too large a share
of its word characters is rejected, and so is one that fails the base rules
(under 50 words, or over half of its words in repeated windows of three).

A null or empty text has no words and is rejected. Rows with equal ids are
judged each on its own; columns other than id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Separators of words, as Java and RE2 read it.
BLANK = r"[ \t\n\x0B\f\r]"
NOT_BLANK = r"[^ \t\n\x0B\f\r]"
SYMBOLS = "#*$%&|<>"
SYMBOL_CLASS = r"[#*$%&|<>]"
#: Line rules: (name, pattern that a failing line matches).
LINE_RULES = (
    # punctuation
    ("exclaimed", r"[!?]{2}[^!?]+[!?]{2}[^!?]+[!?]{2}"),
    ("no_letters", r"\A\P{L}+\z"),
    ("cut_short", r"(?:\.\.\.|…)[ \t\r]*\z"),
    # navigation
    ("menu", r"(?:[|»›•·]|->|::)[^|»›•·]+(?:[|»›•·]|->|::)"),
    ("open_menu", r"[|»›]" + BLANK + r"*\z"),
    ("page_link", r"(?i)\A[ \t]*(?:home|next|previous|menu|log ?in|sign (?:in|up)|subscribe|read more|search|share)[ \t\r.:]*\z"),
    # boilerplate
    ("legal", r"(?i)all rights reserved|terms of (?:use|service)|privacy policy|cookie policy|uses? cookies"
              r"|copyright (?:\(c\)|©)|powered by|licensed under"),
    ("code", r"(?i)javascript|lorem ipsum|[{}]"),
)
#: A line fails with this many symbols and this share of them.
LINE_SYMBOLS, LINE_SYMBOL_SHARE = 3, 0.08
#: A line of this many characters without a lower-case letter shouts.
SHOUT_CHARS = 20
#: Share of a document's word characters that its lines may lose.
MAX_LOST = 0.4
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50


def line_fails(line: Column) -> Column:
    n_symbols = F.length(line) - F.length(F.translate(line, SYMBOLS, ""))
    shouts = (F.length(line) >= SHOUT_CHARS) & line.rlike(r"\p{Lu}") & ~line.rlike(r"\p{Ll}")
    fails = shouts | ((n_symbols >= LINE_SYMBOLS) & (n_symbols > LINE_SYMBOL_SHARE * F.length(line)))
    for _, pattern in LINE_RULES:
        fails = fails | line.rlike(pattern)
    return fails


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, BLANK + "+", ""))


def judged(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """Base figures, ``clean_text`` without failing lines, its loss, and the verdict ``kept``.

    Each select builds arrays that the next one uses more than once, so they
    are computed once per row.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    parts = docs.select(
        F.col(id_column).alias("doc_id"), text.alias("text"),
        F.filter(F.split(text, BLANK + "+"), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_BLANK)).alias("lines"))
    words = F.col("words")
    window = lambda i: F.struct(F.concat_ws(" ", words[i], words[i + 1], words[i + 2]).alias("w"), i.alias("i"))
    sorted_windows = F.when(F.size(words) >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - 3), window)))
    parts = parts.select(
        "doc_id", "text", "lines", F.size(words).cast("long").alias("n_words"),
        F.filter("lines", lambda x: ~line_fails(x)).alias("kept_lines"),
        F.coalesce(sorted_windows, F.array().cast("array<struct<w:string,i:int>>")).alias("windows"))
    # equal windows are neighbours; a window that starts less than three words after the last one covers only what is new
    windows, last = F.col("windows"), F.size("windows") - 1
    equal = lambda a, b: windows[a]["w"] == windows[b]["w"]
    again = F.filter(windows, lambda _, i: F.when(i > 0, equal(i - 1, i)).otherwise(False) | F.when(i < last, equal(i, i + 1)).otherwise(False))
    places = F.sort_array(F.transform(again, lambda x: x["i"]))
    state = lambda at, n: F.struct(at.alias("at"), n.alias("n"))
    covered = F.aggregate(
        places, state(F.lit(-3), F.lit(0).cast("long")),
        lambda s, i: state(i, s["n"] + F.least(F.lit(3), i - s["at"])), lambda s: s["n"])
    figures = parts.select(
        "doc_id", "n_words", word_chars(F.col("text")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("kept_lines")).cast("long").alias("n_bad_lines"),
        F.concat_ws("\n", "kept_lines").alias("clean_text"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    clean_chars = word_chars(F.col("clean_text")).cast("long")
    return figures.select(
        *figures.columns, clean_chars.alias("clean_chars"), failed.alias("base_failed"),
        (~failed & (F.col("word_chars") - clean_chars <= max_lost * F.col("word_chars"))).alias("kept"))


def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def oracle() -> str:
    rules = " OR ".join(f"regexp_matches(x, {_sql_text(p)})" for _, p in LINE_RULES)
    symbols = f"length(x) - length(regexp_replace(x, {_sql_text(SYMBOL_CLASS)}, '', 'g'))"
    return f"""
    WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    word AS (SELECT doc_id, regexp_extract_all(text, {_sql_text(NOT_BLANK + '+')}) AS w FROM docs),
    place AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM word WHERE len(w) >= 3),
    win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM place),
    again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
    cover AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id),
    line AS (SELECT doc_id, x, {rules}
                OR (length(x) >= {SHOUT_CHARS} AND regexp_matches(x, '\\p{{Lu}}') AND NOT regexp_matches(x, '\\p{{Ll}}'))
                OR ({symbols} >= {LINE_SYMBOLS} AND {symbols} > {LINE_SYMBOL_SHARE} * length(x)) AS bad
             FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM docs)
             WHERE regexp_matches(x, {_sql_text(NOT_BLANK)})),
    lines AS (SELECT doc_id, count(*) AS n, count(DISTINCT x) AS d, count(*) FILTER (WHERE bad) AS b,
                  coalesce(sum(length(regexp_replace(x, {_sql_text(BLANK + '+')}, '', 'g'))) FILTER (WHERE NOT bad), 0) AS c
              FROM line GROUP BY doc_id),
    figures AS (
        SELECT d.doc_id, len(w.w)::BIGINT AS n_words,
            length(regexp_replace(d.text, {_sql_text(BLANK + '+')}, '', 'g'))::BIGINT AS word_chars,
            length(regexp_replace(d.text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
            coalesce(l.n - l.d, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
            coalesce(l.n, 0)::BIGINT AS n_lines, coalesce(l.b, 0)::BIGINT AS n_bad_lines, coalesce(l.c, 0)::BIGINT AS clean_chars
        FROM docs d JOIN word w USING (doc_id) LEFT JOIN lines l USING (doc_id) LEFT JOIN cover c USING (doc_id))
    SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed,
        NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words)
            AND word_chars - clean_chars <= {MAX_LOST} * word_chars AS kept
    FROM figures"""
