"""Line-first quality rules: judge each line, drop the failures, then judge what is left of the document.

Only built-in expressions inside one row: no shuffle, no Python. Defined results: a NULL or empty text has no
words, loses nothing and is not kept; repeated rows are judged alike; other columns pass through; very long texts
are judged whole; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import SPACES, count_spaces, let, one_space, refuse_clash, text_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_KEPT_PERCENT = 50
SYMBOLS = "[#*$%&|<>]"
# A line of prose ends in one of these.
LINE_ENDS = ".!?…\"'”’»)]:;。！？"
# Menus put short items between these.
SEPARATORS = "[|»›•·]"
ITEM_CHARS = 30
# A line this long is a paragraph, however it ends.
PARAGRAPH_CHARS = 300
# Marks that stand after every word in shouted or garbled lines.
MARKS = "[!?#$%&*|~^=<>{}]"
BOILERPLATE = (
    "(java ?script|cookie|lorem ipsum|terms of (use|service)|privacy policy|all rights reserved|click here|"
    "sign (in|up)|log ?(in|out)|subscribe|read more|share this|back to top|skip to)"
)
BOILERPLATE_CHARS = 120
FEW_REPEATS = 24


def has_word(line: Column) -> Column:
    return F.trim(line, F.lit(SPACES)) != ""


def line_passes(line: Column) -> Column:
    """Whether a line with a word ends like prose, is no menu, no stock phrase and not full of marks."""
    ends = F.instr(F.lit(LINE_ENDS), F.substring(F.rtrim(line, F.lit(SPACES)), -1, 1)) > 0
    menu = let(F.regexp_count(line, F.lit(SEPARATORS)), lambda bars: (bars >= 2) & (F.length(line) <= (bars + 1) * ITEM_CHARS))
    stock = (F.length(line) <= BOILERPLATE_CHARS) & F.lower(line).rlike(BOILERPLATE)
    noisy = F.regexp_count(line, F.lit(MARKS)) * 2 > count_spaces(line) + 1
    return (ends | (F.length(line) >= PARAGRAPH_CHARS)) & ~noisy & ~menu & ~stock


def repeat_words(words: Column) -> Column:
    """Words inside three-word windows that the text holds twice or more."""

    def covered(places: Column) -> Column:
        steps = F.zip_with(places, F.slice(places, 2, F.greatest(F.size(places), F.lit(1))), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def repeated(ranked: Column) -> Column:
        same = F.zip_with(ranked, F.slice(ranked, 2, F.size(ranked)), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
        places = let(
            same,
            lambda s: F.filter(
                F.transform(ranked, lambda x, j: F.when(F.get(s, j) | F.coalesce(F.get(s, j - 1), F.lit(False)), x["i"])),
                lambda i: i.isNotNull(),
            ),
        )
        return let(F.sort_array(places), covered)

    def ranked(hashes: Column) -> Column:
        return let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), repeated)

    def found(hashes: Column, twice: Column) -> Column:
        places = F.filter(F.transform(hashes, lambda h, i: F.when(F.array_contains(twice, h), i)), lambda i: i.isNotNull())
        # A few repeated windows are looked up one by one; many are brought together by a sort. Same result.
        return F.when(F.size(twice) == 0, 0).when(F.size(twice) <= FEW_REPEATS, let(places, covered)).otherwise(ranked(hashes))

    def of(hashes: Column) -> Column:
        def twice(s: Column) -> Column:
            return F.array_distinct(F.filter(F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.when(a == b, a)), lambda h: h.isNotNull()))

        return F.when(F.size(hashes) < 2, 0).otherwise(let(let(F.sort_array(hashes), twice), lambda t: found(hashes, t)))

    def hashed(w: Column) -> Column:
        return F.when(
            F.size(w) >= 3,
            F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))),
        ).otherwise(F.array().cast("array<bigint>"))

    return let(let(words, hashed), of)


def judgement(whole: Column) -> Column:
    """The figures, the verdict and the cleaned text of one text as a struct."""

    def chars(rows: Column) -> Column:
        return F.aggregate(rows, F.lit(0), lambda n, line: n + F.length(line))

    def figures(lines: Column, spaced: Column, words: Column) -> Column:
        full = F.filter(lines, has_word)
        passed = F.filter(lines, lambda line: ~has_word(line) | line_passes(line))

        def verdict(full: Column, passed: Column, good: Column, repeats: Column) -> Column:
            n_words = F.size(words).cast("long")
            failed = (n_words < MIN_WORDS) | (repeats * 100 > n_words * MAX_REPEAT_PERCENT)
            return F.struct(
                n_words.alias("n_words"),
                (F.length(spaced) - count_spaces(spaced)).cast("long").alias("word_chars"),
                F.regexp_count(whole, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                (F.size(full) - F.size(F.array_distinct(full))).cast("long").alias("n_dup_lines"),
                repeats.alias("n_repeat_words"),
                failed.alias("base_failed"),
                F.array_join(passed, "\n").alias("clean_text"),
                F.size(full).cast("long").alias("n_lines"),
                (F.size(full) - F.size(good)).cast("long").alias("n_lines_failed"),
                (~failed & (chars(good) * 100 >= chars(full) * MIN_KEPT_PERCENT)).alias("kept"),
            )

        repeats = repeat_words(words).cast("long")
        return let(full, lambda f: let(passed, lambda p: let(F.filter(p, has_word), lambda g: let(repeats, lambda r: verdict(f, p, g, r)))))

    def split(spaced: Column) -> Column:
        words = F.array_remove(F.split(spaced, " "), "")
        return let(F.split(whole, "\n"), lambda lines: let(words, lambda w: figures(lines, spaced, w)))

    return let(one_space(whole), split)


def judge(df: DataFrame, text: str = "text", into: str = "quality") -> DataFrame:
    """``df`` with a struct column ``into``: figures, verdict and the cleaned text.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, clean_text (the lines that
    pass, in order), n_lines, n_lines_failed, kept. A column of that name is refused.
    """
    refuse_clash(df, into)
    return df.withColumn(into, judgement(text_of(df, text)))


def clean(df: DataFrame, text: str = "text") -> DataFrame:
    """The kept documents with their cleaned text; all columns of ``df``, ``n_chars`` counted anew if there."""
    mark = "_quality"
    while mark in df.columns:
        mark += "_"
    # A list of one judgement or none: what is kept and what is read of it come from one evaluation.
    passed = F.filter(F.array(judgement(text_of(df, text))), lambda q: q["kept"])
    kept = df.withColumn(mark, F.explode(F.transform(passed, lambda q: q["clean_text"])))
    out = {text: F.col(mark)}
    if "n_chars" in df.columns:
        out["n_chars"] = F.length(F.col(mark)).cast(df.schema["n_chars"].dataType)
    return kept.withColumns(out).select(*df.columns)
