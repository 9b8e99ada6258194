"""Column pieces shared by the training-data operators: words, shingles, bounded Arrow batches."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
SIMILARITY = 0.8
SPACES = " \t\n\u000b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``, however often that names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_of(df: DataFrame, name: str = "text") -> Column:
    """The text column of ``df`` with NULL read as empty."""
    return F.coalesce(df[name].cast("string"), F.lit(""))


def one_space(text: Column) -> Column:
    """Every white-space character of SPACES as a plain space (``replace`` is far cheaper than ``translate``)."""
    for space in SPACES[1:]:
        text = F.replace(text, F.lit(space), F.lit(" "))
    return text


def space_words(text: Column) -> Column:
    """Runs of characters other than space and U+0009 to U+000D, in order."""
    return F.array_remove(F.split(one_space(text), " "), "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and every other character as it is (``replace`` is far cheaper than ``translate``)."""
    for letter in string.ascii_uppercase:
        text = F.replace(text, F.lit(letter), F.lit(letter.lower()))
    return text


def refuse_clash(df: DataFrame, into: str) -> None:
    """A result is never written over a column of the input, nor beside one of its name."""
    if into.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"the input already has a column {into!r}: name another one for the result")


def count_spaces(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))


def space_word_count(text: Column) -> Column:
    """The number of ``space_words``: counted by the gaps where each gap is one space, else by splitting."""

    def of(t: Column) -> Column:
        plain = (t != "") & ~F.startswith(t, F.lit(" ")) & ~F.endswith(t, F.lit(" ")) & ~F.contains(t, F.lit("  "))
        return F.when(plain, count_spaces(t) + 1).otherwise(F.size(F.array_remove(F.split(t, " "), "")))

    return let(one_space(text), of)


def content_words(text: Column) -> Column:
    """Lower-case runs of letters, marks and digits, in order."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), "")


def shingle_hashes(words: Column, n: int = SHINGLE) -> Column:
    """One 64-bit hash per window of ``n`` words, in order; empty for fewer than ``n`` words."""
    return let(
        words,
        lambda w: F.when(
            F.size(w) >= n,
            F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)])),
        ).otherwise(F.array().cast("array<bigint>")),
    )


def shingle_strings(words: Column, n: int = SHINGLE) -> Column:
    """The windows of ``n`` words themselves, joined by one space."""
    return let(
        words,
        lambda w: F.when(
            F.size(w) >= n,
            F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(n)])),
        ).otherwise(F.array().cast("array<string>")),
    )


# Values a hashed pre-filter tells apart: that many rows of 8 bytes at most are broadcast, however many keys there are.
FILTER_CELLS = 2**20


def may_match(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """Rows of ``df`` whose key may be among the wanted ones: none that is goes missing, and most others leave before a
    shuffle would carry them. The broadcast side has FILTER_CELLS rows at most, by construction."""
    cell = lambda k: F.pmod(F.xxhash64(k), F.lit(FILTER_CELLS)).cast("int")
    cells = wanted.select(cell(wanted_key).alias("_cell")).distinct()
    return df.withColumn("_own_cell", cell(key)).join(F.broadcast(cells), F.col("_own_cell") == F.col("_cell"), "left_semi").drop("_own_cell")


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Whole long texts travel to Python in batches of at most ``rows``, so a batch of the longest texts still fits."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
