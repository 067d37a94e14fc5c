"""Quality rules, line first: lines that fail a rule go, then documents that lost too much.

Column expressions only. Lines fail for punctuation (mostly symbols or exclamation, or
shouting), navigation (menus, short lines without an end mark), boilerplate (licence, legal
and cookie notices), or as repeats of an earlier line.

Defined results: a null or empty text has no words and is not kept; repeated rows are judged
each on their own; an empty table gives no rows; all other columns stay, only the output
column replaces one of its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quern.llm.common import documents, let, once

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Separators of menus and breadcrumbs.
MENU = "|»›•·"
#: Notices; a line fails with one for every ``NOTICE_CHARS`` of its characters, or more.
BOILERPLATE = (
    "all rights reserved|licensed under|released under the|is licensed|terms of use|terms of service|"
    "privacy policy|cookie|javascript|lorem ipsum|copyright ©|©|click here|sign up|log in|subscribe"
)
END_MARKS = ".!?…。！？:;\"'”»)"

NOTICE_CHARS = 200
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Largest share of a line's characters.
MAX_SYMBOLS, MAX_MARKS, MAX_UPPER = 0.1, 0.1, 0.6
MAX_LOST = 0.5


def _count(text: Column, characters: str) -> Column:
    """How many of some characters a text has; meant for characters that are few."""
    return F.regexp_count(text, F.lit(f"[{characters}]"))


def _word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed != "", F.split(trimmed, r"[\x20\x09-\x0D]+", -1)).otherwise(F.array().cast("array<string>"))


def repeated_words(listed: Column, window: int = 3) -> Column:
    """How many words of a list lie in a window that occurs twice or more, first ones included.

    Windows are hashed first; only where two hashes agree are the words themselves compared,
    by sorting the windows with their places.
    """

    def of(w: Column) -> Column:
        count = F.greatest(F.size(w) - (window - 1), F.lit(0))

        def following(x: Column, i: Column) -> list[Column]:
            return [x, *[F.get(w, i + k) for k in range(1, window)]]

        heads = F.slice(w, 1, count)
        hashes = F.transform(heads, lambda x, i: F.xxhash64(*following(x, i)))
        ordered = F.sort_array(
            F.transform(heads, lambda x, i: F.struct(F.concat_ws(" ", *following(x, i)).alias("g"), i.alias("p")))
        )

        def covered(s: Column) -> Column:
            twins = F.zip_with(s, F.slice(s, 2, count), lambda a, b: a["g"] == b["g"])

            def places(eq: Column) -> Column:
                marked = F.transform(
                    s,
                    lambda a, j: F.when(
                        F.coalesce(F.get(eq, j), F.lit(False)) | F.coalesce(F.get(eq, j - 1), F.lit(False)), a["p"]
                    ),
                )
                return F.sort_array(F.filter(marked, lambda p: p.isNotNull()))

            return let(let(twins, places), _covered(window))

        return F.when(F.size(F.array_distinct(hashes)) < count, let(ordered, covered)).otherwise(F.lit(0).cast("bigint"))

    return let(listed, of)


def _covered(window: int):
    """Words under windows that begin at sorted places."""

    def total(places: Column) -> Column:
        steps = F.zip_with(
            places, F.slice(places, 2, F.size(places)), lambda a, b: F.least(F.lit(window), F.coalesce(b - a, F.lit(window)))
        )
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda s, x: s + x)

    return total


def good_line(line: Column) -> Column:
    """Whether a line with a word passes the rules on punctuation, navigation and boilerplate."""
    size = F.length(line)
    letters = F.length(F.regexp_replace(line, r"[^\p{L}]+", ""))
    upper = F.regexp_count(line, F.lit(r"\p{Lu}"))
    trimmed = F.btrim(line, F.lit(BLANKS))
    ended = F.lit(END_MARKS).contains(F.right(trimmed, F.lit(1)))
    few = ~trimmed.rlike(r"(?:[ \t][^ \t]*+){4}")  # under five words
    return ~(
        (_count(line, SYMBOLS) > size * MAX_SYMBOLS)
        | (_count(line, "!?") > size * MAX_MARKS)
        | ((upper > 20 * MAX_UPPER) & (letters >= 20) & (upper > letters * MAX_UPPER))  # cheap test first
        | (_count(line, MENU) >= 3)
        | (few & ~ended)
        | (F.regexp_count(F.lower(line), F.lit(BOILERPLATE)) * NOTICE_CHARS > size)
    )


def with_quality(
    docs: DataFrame, text: str = "text", out: str = "quality", max_lost: float = MAX_LOST
) -> DataFrame:
    """Adds the struct ``out``: counts, verdicts and ``clean``, the text of the lines that stay."""
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    def judged(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

        def of_lines(ls: Column) -> Column:
            distinct = F.array_distinct(ls)
            return F.struct(
                (F.size(ls) - F.size(distinct)).cast("bigint").alias("n_dup_lines"),
                F.array_join(F.filter(distinct, good_line), "\n").alias("clean"),
            )

        def of_words(w: Column) -> Column:
            return F.struct(
                F.size(w).cast("bigint").alias("n_words"),
                F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
                repeated_words(w).alias("n_repeat_words"),
            )

        return F.struct(
            let(words(t), of_words).alias("w"),
            let(lines, of_lines).alias("l"),
            _count(t, SYMBOLS).cast("bigint").alias("n_symbols"),
        )

    def verdict(q: Column) -> Column:
        n, chars, repeated = q["w"]["n_words"], q["w"]["word_chars"], q["w"]["n_repeat_words"]
        failed = (n < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n)
        left = _word_chars(q["l"]["clean"])
        return F.struct(
            n.alias("n_words"),
            chars.alias("word_chars"),
            q["n_symbols"].alias("n_symbols"),
            q["l"]["n_dup_lines"].alias("n_dup_lines"),
            repeated.alias("n_repeat_words"),
            failed.alias("base_failed"),
            (~failed & (left >= chars * (1 - max_lost))).alias("kept"),
            left.cast("bigint").alias("clean_chars"),
            q["l"]["clean"].alias("clean"),
        )

    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != out.lower()]
    return docs.select(*kept, once(let(judged(content), verdict)).alias(out))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept clean_chars".split()
    judged = with_quality(documents(spark, sf_dir).select("doc_id", "text"))
    return judged.select("doc_id", *[F.col(f"quality.{f}").alias(f) for f in fields])


def _sql_count(text: str, characters: str) -> str:
    return f"(length({text}) - length(translate({text}, '{characters}', '')))"


_SQL_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_SQL_CHARS = f"length(translate(%s, {_SQL_BLANKS}, ''))"

#: Word and line counts by windows over unnested rows, the rules as above.
OP9_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
      FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d)),
g AS (SELECT doc_id, i, CASE WHEN lead(word, 2) OVER o IS NOT NULL
             THEN concat(word, ' ', lead(word, 1) OVER o, ' ', lead(word, 2) OVER o) END AS g
      FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
c AS (SELECT doc_id, i, g IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g) > 1 AS twice FROM g),
r AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (covered) AS n_repeat_words FROM (
        SELECT doc_id, bool_or(twice) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
               AS covered FROM c) GROUP BY doc_id),
l AS (SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
      WHERE {_SQL_CHARS % 'line'} > 0 GROUP BY doc_id, line),
k AS (SELECT doc_id, sum(n - 1) AS dups, sum({_SQL_CHARS % 'line'}) FILTER (NOT (
        {_sql_count('line', SYMBOLS)} > length(line) * {MAX_SYMBOLS}
        OR {_sql_count('line', '!?')} > length(line) * {MAX_MARKS}
        OR (length(regexp_replace(line, '[^\p{{L}}]+', '', 'g')) >= 20 AND
            length(regexp_replace(line, '[^\p{{Lu}}]+', '', 'g'))
            > length(regexp_replace(line, '[^\p{{L}}]+', '', 'g')) * {MAX_UPPER})
        OR {_sql_count('line', MENU)} >= 3
        OR (length(trim(line, {_SQL_BLANKS})) - length(translate(trim(line, {_SQL_BLANKS}), chr(32) || chr(9), '')) < 4
            AND NOT contains('{END_MARKS.replace("'", "''")}', right(trim(line, {_SQL_BLANKS}), 1)))
        OR len(regexp_extract_all(lower(line), '{BOILERPLATE}')) * {NOTICE_CHARS} > length(line))) AS clean
      FROM l GROUP BY doc_id),
s AS (SELECT d.doc_id, coalesce(r.n_words, 0) AS n_words, {_SQL_CHARS % 'text'} AS word_chars,
             {_sql_count('text', SYMBOLS)} AS n_symbols, coalesce(k.dups, 0)::BIGINT AS n_dup_lines,
             coalesce(r.n_repeat_words, 0) AS n_repeat_words, coalesce(k.clean, 0)::BIGINT AS clean_chars
      FROM d LEFT JOIN r ON r.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM s)
SELECT *, NOT base_failed AND clean_chars >= word_chars * {1 - MAX_LOST} AS kept FROM f
"""
