"""Operator 7, quality rules: a table of thresholds, compiled into one projection of Spark's own functions.

The projection measures lengths, symbols, stop words, lines and repeated word windows of a text, and compares each
ratio with its bounds. Ratios are compared as whole numbers (numerator times 1000 against the bound times the
denominator), so results do not depend on floating-point rounding.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space between words, characters that count as symbols, and the base limits.
GAP = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
WINDOW = 3
# End of the fixed values.
UPPER, LOWER = r"\p{Lu}", r"\p{Ll}"

#: Common words of English, German, French and Spanish.
STOP_WORDS = sorted(set(
    "the of and to in is that for it with as was on be by this are from at or an have not but what "
    "der die das und den von zu mit ist im für auf nicht eine als auch werden aus dem ein sich es er "
    "le la les et des est dans du une qui pas pour sur plus par avec ce il un en que au de "
    "el los las del se por para con no una su al lo como y".split()
))

#: Characters up to U+00FF, which these languages write with, their few letters beyond, and all that is no letter.
LATIN, NOT_OTHER = r"[\x00-\xFF]+", r"[^\p{L}]|[ŒœẞŸ]"

#: Where a rule applies: texts with at most so many per 1000 (numerator, denominator, most).
LISTED_LANGUAGE = ("n_other_letters", "word_chars", 20)

#: (rule, numerator, denominator, least, most, where): bounds are per 1000 of the denominator; None leaves a side open,
#: or the rule applies to all texts. Stop words are asked of texts that are written in the listed languages' letters.
RULES: list[tuple[str, str, str, int | None, int | None, tuple[str, str, int] | None]] = [
    ("mean_word_length", "word_chars", "n_words", 2_000, 12_000, None),
    ("symbols_per_word", "n_symbols", "n_words", None, 300, None),
    ("stop_words_per_word", "n_stop_words", "n_words", 20, None, LISTED_LANGUAGE),
    ("capital_words_per_word", "n_capital_words", "n_words", None, 500, None),
    ("repeated_lines_per_line", "n_dup_lines", "n_lines", None, 400, None),
]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once, inside an expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words that lie in 3-word windows found twice or more. Windows are compared by a 64-bit hash within a text;
    equal ones meet by sorting, so the work is n log n for any number of repeats."""
    window = lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW)))
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)

    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twins(pairs: Column) -> Column:
            like = lambda x, k: F.coalesce(F.get(pairs, k)["h"] == x["h"], F.lit(False))
            at = F.transform(pairs, lambda x, k: F.when(like(x, k - 1) | like(x, k + 1), x["i"]))
            return F.sort_array(F.filter(at, lambda x: x.isNotNull()))

        reach = lambda at: F.transform(at, lambda x, k: F.least(F.lit(WINDOW), F.get(at, k + 1) - x))
        total = lambda at: F.aggregate(reach(at), F.lit(0), lambda a, x: a + x)
        return let(let(ordered, twins), total)

    counted = let(
        F.transform(starts, window),
        lambda hashes: F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered(hashes)),
    )
    return F.when(F.size(words) > WINDOW, counted).otherwise(F.lit(0)).cast("long")


def measures(text: Column) -> Column:
    """All measures of a text as one struct."""

    def of(text: Column, words: Column, lines: Column) -> Column:
        plain = lambda w: F.lower(F.regexp_replace(w, r"[.,;:!?]+$", ""))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            F.size(F.filter(words, lambda w: plain(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
            F.size(F.filter(words, lambda w: w.rlike(UPPER) & ~w.rlike(LOWER))).cast("long").alias("n_capital_words"),
            F.length(F.regexp_replace(F.regexp_replace(text, LATIN, ""), NOT_OTHER, "")).cast("long").alias("n_other_letters"),
        )

    def split(text: Column) -> Column:
        words = F.array_remove(F.split(text, GAP), "")
        lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD_CHAR))
        return let(words, lambda w: let(lines, lambda x: of(text, w, x)))

    return let(text, split)


def verdict(measure: Callable[[str], Column], rules: list = RULES) -> Column:
    """Whether every rule of the table holds where it applies."""
    holds = F.lit(True)
    for _, above, below, least, most, where in rules:
        elsewhere = measure(where[0]) * 1000 > measure(where[1]) * where[2] if where else F.lit(False)
        if least is not None:
            holds = holds & (elsewhere | (measure(above) * 1000 >= measure(below) * least))
        if most is not None:
            holds = holds & (elsewhere | (measure(above) * 1000 <= measure(below) * most))
    return holds


def quality_rules(docs: DataFrame, rules: list = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures and verdict of every whole text, one row per input row, without user functions or a shuffle.

    Columns: the id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and kept, then the
    further measures n_lines, n_stop_words, n_capital_words and n_other_letters. Stop words are not asked of texts in
    other letters than those of the listed languages (more than 2% of the characters: Cyrillic, Greek, Polish). Null and empty texts have no words and fail; null
    and repeated ids stay rows of their own; other columns are not read, so their names can't clash.
    """
    measured = docs.select(F.col(id_col), measures(F.coalesce(F.col(text_col), F.lit(""))).alias("m"))
    m = lambda name: F.col(f"m.{name}")
    failed = (m("n_words") < MIN_WORDS) | (m("n_repeat_words") * 100 > m("n_words") * MAX_REPEATED_PERCENT)
    base = [m(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    more = [m(x) for x in ("n_lines", "n_stop_words", "n_capital_words", "n_other_letters")]
    return measured.select(id_col, *base, failed.alias("base_failed"), (~failed & verdict(m, rules)).alias("kept"), *more)


def _rules_sql(rules: list) -> str:
    parts = []
    for _, above, below, least, most, where in rules:
        elsewhere = f"{where[0]} * 1000 > {where[1]} * {where[2]}" if where else "false"
        parts += [f"({elsewhere} OR {above} * 1000 >= {below} * {least})"] if least is not None else []
        parts += [f"({elsewhere} OR {above} * 1000 <= {below} * {most})"] if most is not None else []
    return " AND ".join(parts)


#: The same result in DuckDB's SQL, with windows compared by their text.
ORACLE = f"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents),
p AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) >= 3)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM p) WHERE c > 1),
c AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM r) GROUP BY 1),
m AS (SELECT t.doc_id, len(w)::BIGINT AS n_words, length(list_aggregate(w, 'string_agg', ''))::BIGINT AS wc,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    len(l)::BIGINT AS n_lines,
    len(list_filter(w, lambda x: lower(regexp_replace(x, '[.,;:!?]+$', '')) IN ({", ".join(f"'{x}'" for x in STOP_WORDS)})))::BIGINT AS n_stop_words,
    len(list_filter(w, lambda x: regexp_matches(x, '\\p{{Lu}}') AND NOT regexp_matches(x, '\\p{{Ll}}')))::BIGINT AS n_capital_words,
    length(regexp_replace(text, '[\\x00-\\x{{FF}}]|{NOT_OTHER}', '', 'g'))::BIGINT AS n_other_letters
  FROM t LEFT JOIN c ON c.doc_id = t.doc_id),
f AS (SELECT * EXCLUDE (wc), coalesce(wc, 0)::BIGINT AS word_chars,
    (n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEATED_PERCENT}) AS base_failed FROM m)
SELECT *, (NOT base_failed AND {_rules_sql(RULES)}) AS kept FROM f
"""
