"""Line-first cleaning: drop lines that look like navigation, boilerplate or broken
text, then reject documents that lose too much.

Everything is a DataFrame expression of one row, so there is no shuffle and a very long
text only costs its own row. Words are ``[^\\x20\\x09-\\x0D]+``.

Defined results: a null or empty text has no words, fails the base rules (fewer than
``MIN_WORDS`` words) and is not kept; repeated rows are judged one by one; an empty table
gives an empty result; columns of the input are kept, but those named like a result are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"
SYMBOL = "[#*$%&|<>]"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A line fails when symbols, or shouted words, exceed this share of its words, in percent.
MAX_LINE_SYMBOL_PERCENT = 30
#: A line with fewer words must end like a sentence.
MIN_OPEN_LINE_WORDS = 4
#: A document must keep this share of the characters of its lines, in percent.
MIN_KEPT_PERCENT = 50

SENTENCE_END = "[.!?:;,…。！？][\"'”’»)\\]]*[\\x20\\x09-\\x0D]*$"
NAVIGATION = "(\\|[^|]*){3}|(»[^»]*){3}|(›[^›]*){3}|(•[^•]*){3}"
SHOUT = "!!"
BOILERPLATE = (
    "(?i)(enable javascript|accept (all )?cookies|cookie policy|privacy policy"
    "|terms of (use|service)|all rights reserved|lorem ipsum|click here to|sign up for our"
    "|subscribe to our|skip to (main )?content|back to top)"
)

RESULTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "base_failed",
    "line_chars",
    "kept_chars",
    "clean_text",
    "kept",
)


def line_fails(line: Column) -> Column:
    """True for a line with words that is navigation, boilerplate, symbols, shouting or
    a fragment without an ending."""
    words = F.regexp_count(line, F.lit(WORD))
    return (
        (F.regexp_count(line, F.lit(SYMBOL)) * 100 > words * MAX_LINE_SYMBOL_PERCENT)
        | (F.regexp_count(line, F.lit(SHOUT)) * 100 > words * MAX_LINE_SYMBOL_PERCENT)
        | line.rlike(NAVIGATION)
        | line.rlike(BOILERPLATE)
        | ((words < MIN_OPEN_LINE_WORDS) & ~line.rlike(SENTENCE_END))
    )


def window_keys(words: Column, n: Column) -> Column:
    """Sorted longs, one for each 3-word window: hash times word count plus position.

    A sort of plain longs brings equal windows together and keeps their places; the hash
    has 62 bits less those of the position.
    """
    kinds = F.floor(F.lit(2**62) / n).cast("long")
    return F.sort_array(
        F.transform(
            F.slice(words, 1, F.greatest(n - 2, F.lit(0)).cast("int")),
            lambda word, at: F.pmod(F.xxhash64(word, F.get(words, at + 1), F.get(words, at + 2)), kinds) * n + at,
        )
    )


def repeated_places(keys: Column, n: Column) -> Column:
    """Start positions of the windows whose neighbour in the sorted keys is equal."""
    rest = F.greatest(F.size(keys) - 1, F.lit(0))
    pairs = F.zip_with(
        F.slice(keys, 1, rest),
        F.slice(keys, 2, rest),
        lambda a, b: F.when(a - a % n == b - b % n, F.array(a % n, b % n)),
    )
    return F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull())))


def judge(docs: DataFrame) -> DataFrame:
    """The input with the columns in ``RESULTS``: base figures, whether they fail, the
    characters of all lines and of those kept, the cleaned text, and the verdict."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words, lines, good, n = F.col("_words"), F.col("_lines"), F.col("_good"), F.col("n_words")
    out = docs.drop(*RESULTS).withColumns(
        {
            "_words": F.filter(F.split(text, SPACE + "+"), lambda w: w != ""),
            "_lines": F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)),
            "word_chars": (F.length(text) - F.regexp_count(text, F.lit(SPACE))).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit(SYMBOL)).cast("long"),
        }
    )
    out = out.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "line_chars": F.length(F.array_join(lines, "\n")).cast("long"),
            "_good": F.filter(lines, lambda x: ~line_fails(x)),
        }
    )
    out = out.withColumn("_keys", F.when(n >= 3, window_keys(words, n)).otherwise(F.array().cast("array<bigint>")))
    out = out.withColumn("_places", repeated_places(F.col("_keys"), n))
    covered = F.array_distinct(F.flatten(F.transform(F.col("_places"), lambda p: F.array(p, p + 1, p + 2))))
    out = out.withColumns(
        {
            "n_repeat_words": F.size(covered).cast("long"),
            "kept_chars": F.length(F.array_join(good, "\n")).cast("long"),
            "clean_text": F.when(F.size(good) == F.size(lines), F.col("text")).otherwise(F.array_join(good, "\n")),
        }
    )
    out = out.withColumn(
        "base_failed", (n < MIN_WORDS) | (F.col("n_repeat_words") * 100 > n * MAX_REPEAT_PERCENT)
    )
    enough = F.col("kept_chars") * 100 >= F.col("line_chars") * MIN_KEPT_PERCENT
    out = out.withColumn("kept", ~F.col("base_failed") & enough)
    # The results leave through a generator, which no filter on them is pushed through: else
    # the filter would take the expressions along, and split the text anew for every word.
    return out.select(
        *(c for c in docs.columns if c not in RESULTS), F.inline(F.array(F.struct(*(F.col(c) for c in RESULTS))))
    )


def clean(docs: DataFrame) -> DataFrame:
    """The documents kept, with the failing lines removed from ``text`` and ``n_chars`` set
    anew; all columns of the input, whatever they are called."""
    out = judge(docs.select("text", F.struct("*").alias("_row"))).where("kept")
    new = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}
    return out.select(*(new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3),
windows AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM places),
twice AS (SELECT doc_id, a, b, c FROM windows GROUP BY ALL HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS k
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows JOIN twice USING (doc_id, a, b, c))
  GROUP BY doc_id),
good AS (
  SELECT doc_id, list_filter(lines, lambda x:
      NOT (len(regexp_extract_all(x, '[#*$%&|<>]')) * 100 > len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) * 30
        OR len(regexp_extract_all(x, '!!')) * 100 > len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) * 30
        OR regexp_matches(x, '(\|[^|]*){3}|(»[^»]*){3}|(›[^›]*){3}|(•[^•]*){3}')
        OR regexp_matches(x, '(?i)(enable javascript|accept (all )?cookies|cookie policy|privacy policy|terms of (use|service)|all rights reserved|lorem ipsum|click here to|sign up for our|subscribe to our|skip to (main )?content|back to top)')
        OR (len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) < 4
            AND NOT regexp_matches(x, '[.!?:;,…。！？]["''”’»)\]]*[\x20\x09-\x0D]*$')))) AS g
  FROM d),
figures AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(k, 0)::BIGINT AS n_repeat_words,
         length(array_to_string(lines, chr(10)))::BIGINT AS line_chars,
         length(array_to_string(g, chr(10)))::BIGINT AS kept_chars
  FROM d JOIN good USING (doc_id) LEFT JOIN covered USING (doc_id)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM figures)
SELECT *, NOT base_failed AND kept_chars * 100 >= line_chars * 50 AS kept FROM based
"""
