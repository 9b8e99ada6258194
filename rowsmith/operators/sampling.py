"""Draws, shuffles and generated rows that come out the same on any cluster layout.

Randomness is a hash of (seed, id), never ``rand``, whose values depend on the partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.operators import ordered


def ticket(seed: str, *ids: Column) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(seed), *[i.cast("string") for i in ids]), 256)


def draw(df: DataFrame, key: str, seed: str, k: int) -> DataFrame:
    """k winners; anyone with the ids and the seed can check them."""
    return df.withColumn("ticket", ticket(seed, F.col(key))).orderBy("ticket", key).limit(k)


def shuffle(df: DataFrame, key: str, seed: str) -> DataFrame:
    """A permutation: ``place`` is each row's position in it."""
    tagged = df.withColumn("ticket", ticket(seed, F.col(key)))
    return ordered.scan(tagged, [], [F.col("ticket"), F.col(key)], position="place")


def pick(n: int, *ids: Column) -> Column:
    """A whole number in [0, n) by hash; the hash's next digits are used where the first
    fall in the short last band, so no number is favoured."""
    digits = F.sha2(F.concat_ws(":", *[i.cast("string") for i in ids]), 256)
    band = (2**60 // n) * n
    result = F.lit(0).cast("long")
    for start in (46, 31, 16, 1):
        h = F.conv(F.substring(digits, start, 15), 16, 10).cast("long")
        result = F.when(h < F.lit(band), h).otherwise(result)
    return result % n


ROUNDS = 4
# After w walks a place is still outside the range with probability under 2**-w.
WALKS = 128


def permuted(place: Column, n: int, *salt: Column) -> Column:
    """The image of ``place`` (0 to n - 1) under a permutation of 0 to n - 1 that the salt chooses.

    A Feistel network over the least power of two that holds n: two halves of its bits, each round xors one with a hash of
    the other. An image outside the range is permuted again until it lies inside, which is a permutation of the range too.
    Nothing is listed or remembered, so k different numbers of a range cost k images, whatever the size of the range.
    """
    if not 0 < n < 2**62:
        raise ValueError("a range has 1 to 2**62 - 1 numbers")
    bits = max(2, (n - 1).bit_length())
    right = bits // 2
    masks = F.array(F.lit((1 << (bits - right)) - 1).cast("long"), F.lit((1 << right) - 1).cast("long"))

    def one(state: Column, round_no: Column) -> Column:
        words = F.concat_ws(":", *[s.cast("string") for s in salt], round_no.cast("string"), state["r"].cast("string"))
        hashed = F.conv(F.substring(F.sha2(words, 256), 1, 12), 16, 10).cast("long")
        # The halves change places, so the one that is mixed has the left size in even rounds, the right size in odd ones.
        mask = F.get(masks, F.pmod(round_no, F.lit(2)))
        return F.struct(state["r"].alias("l"), state["l"].bitwiseXOR(hashed.bitwiseAND(mask)).alias("r"))

    def network(x: Column) -> Column:
        halves = F.struct(F.shiftright(x, right).alias("l"), x.bitwiseAND(F.lit((1 << right) - 1).cast("long")).alias("r"))
        done = lambda s: F.shiftleft(s["l"], right).bitwiseOR(s["r"])
        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), halves, one, done)

    first = network(place.cast("long"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), first, lambda x, _: F.when(x < F.lit(n), x).otherwise(network(x)))


def sample_range(spark: SparkSession, lo: int, hi: int, k: int, repeat: bool, seed: str) -> DataFrame:
    """k whole numbers from lo to hi, with or without repeats: (draw_no, value)."""
    if not repeat and k > hi - lo + 1:
        raise ValueError("cannot draw more different numbers than there are")
    draws = spark.range(1, k + 1).withColumnRenamed("id", "draw_no")
    value = pick(hi - lo + 1, F.lit(seed), F.col("draw_no")) if repeat else permuted(F.col("draw_no") - 1, hi - lo + 1, F.lit(seed))
    return draws.select("draw_no", (value + lo).alias("value"))


def different_per_row(df: DataFrame, key: str, k: int, lo: int, hi: int, seed: str) -> DataFrame:
    """k different numbers from lo to hi for every row: (key, draw_no, value)."""
    if k > hi - lo + 1:
        raise ValueError("cannot draw more different numbers than there are")
    rows = df.select(key, F.explode(F.sequence(F.lit(1).cast("long"), F.lit(k).cast("long"))).alias("draw_no"))
    return rows.withColumn("value", permuted(F.col("draw_no") - 1, hi - lo + 1, F.lit(seed), F.col(key)) + lo)


def draws_per_row(df: DataFrame, key: str, k: int, lo: int, hi: int, seed: str) -> DataFrame:
    """k numbers with repeats for every row."""
    rows = df.select(key, F.explode(F.sequence(F.lit(1), F.lit(k))).alias("draw_no"))
    return rows.withColumn("value", pick(hi - lo + 1, F.lit(seed), F.col(key), F.col("draw_no")) + lo)


def replicated_chars(df: DataFrame, n: int, text: str = "text", sep: str = "\n", number: bool = False) -> int:
    """How many characters ``replicate`` would make, before making any."""
    digits = sum(n - 10 ** (d - 1) + 1 for d in range(1, len(str(n)) + 1))
    extra = (digits + 2 * n if number else 0) + n * len(sep)
    return df.agg(F.sum(F.length(text).cast("long") * n + extra)).first()[0] or 0


def replicate(
    df: DataFrame, n: int, text: str = "text", number: bool = False, max_chars: int | None = None, sep: str = "\n",
    max_copies: int | None = None,
) -> DataFrame:
    """n copies of every row, numbered "1. " on request. Refused when n is not a whole number from 1 on, or the copies
    would pass ``max_copies`` or ``max_chars`` where those are given."""
    if n != int(n) or n < 1 or (max_copies is not None and n > max_copies):
        raise ValueError("copies must be a whole number from 1" + (f" to {max_copies}" if max_copies else ""))
    if max_chars is not None and replicated_chars(df, n, text, sep, number) > max_chars:
        raise ValueError(f"that would make more than {max_chars} characters")
    rows = df.select("*", F.explode(F.sequence(F.lit(1), F.lit(int(n)))).alias("copy_no"))
    if number:
        rows = rows.withColumn(text, F.concat(F.col("copy_no").cast("string"), F.lit(". "), F.col(text)))
    return rows


def repeat_text(text: Column, n: int, sep: str = "\n", number: bool = False, trailing: bool = False) -> Column:
    """The copies joined into one text."""
    item = lambda i: F.concat(i.cast("string"), F.lit(". "), text) if number else text
    joined = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), item), sep)
    return F.concat(joined, F.lit(sep)) if trailing else joined


# Words placeholder text is made of, and its first words.
PLACEHOLDER_WORDS = (
    "amber basin cedar delta ember fjord grove harbour inlet juniper kelp lagoon meadow nectar orchard pebble quarry "
    "ridge summit thicket upland valley willow yarrow zephyr breeze canyon dune estuary fern glacier heath island moss "
    "prairie reef spring tundra wetland"
).split()
OPENER = "Amber basin cedar delta, ember fjord grove harbour"


def _sentence(seed: str, key: Column, no: Column) -> Column:
    """8 to 18 words; one comma after the third word or later when there are more than 11."""
    words = F.array(*[F.lit(w) for w in PLACEHOLDER_WORDS])
    n = pick(11, F.lit(seed), key, no, F.lit("n")) + 8
    comma = pick(1_000_003, F.lit(seed), key, no, F.lit("c")) % F.greatest(n - 6, F.lit(1)) + 3

    def word(i: Column) -> Column:
        w = F.get(words, pick(len(PLACEHOLDER_WORDS), F.lit(seed), key, no, i).cast("int"))
        return F.when((n > 11) & (i == comma), F.concat(w, F.lit(","))).otherwise(w)

    text = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), word), " ")
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, F.lit(2), F.length(text)), F.lit("."))


def placeholder_text(df: DataFrame, key: str, seed: str, unit: str = "paragraph", classic: bool = False) -> DataFrame:
    """One placeholder sentence, or paragraph of 3 to 6 sentences, for every row of ``df``."""
    k = F.col(key)
    if unit == "sentence":
        text = _sentence(seed, k, F.lit(0).cast("long"))
    else:
        n = pick(4, F.lit(seed), k, F.lit("p")) + 3
        text = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda s: _sentence(seed, k, s)), " ")
    if classic:
        text = F.when(k == 0, F.concat(F.lit(OPENER + ". "), text)).otherwise(text)
    return df.select(key, text.alias("text"))


def placeholder_corpus(spark: SparkSession, n: int, seed: str, unit: str = "paragraph", classic: bool = True) -> DataFrame:
    return placeholder_text(spark.range(n), "id", seed, unit, classic)
