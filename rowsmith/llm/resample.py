"""Target-distribution importance resampling: hashed n-gram gains, and an exact cut found by medians of medians.

1. Every text becomes the buckets of its features (runs of 1 to ``max_n`` words, CRC-32 modulo ``buckets``), written once.
2. Corpus and target are counted per bucket: each task adds up one array of ``buckets`` numbers, so at most that many
   rows a task are shuffled, whatever the text. The gains are one array of ``buckets`` whole numbers (80 KB by default),
   the only thing that every task is sent; a text's weight is the sum of the gains at its buckets.
3. The score adds Gumbel noise drawn from ``seed:doc_id``, so the highest scores are a sample without replacement in
   proportion to exp(weight / 1000), and reruns agree.
4. The cutoff, the K-th highest key (score, then smaller id), comes from weighted medians: each partition names the
   median of its keys that are left and how many are left; the median of those, weighted by what is left, has at least a
   quarter of all keys left on either side. One pass counts both sides and names both next medians, one side is
   discarded, and once under half of the written keys are left they are written anew. So the keys are read about
   log(N) times at worst, twice their volume is written at most, and the driver gets one row a partition and pass.
5. Only the winners are sorted, in ranges; every other row stays where it is.

Defined results: a NULL text has no words and weight 0; a NULL id draws as the empty string and comes last among ties;
rows that repeat an id are rows of their own, and of those at the cutoff as many are drawn as are missing; very long
texts count whole; with an empty target or corpus the gains still exist (counts start at one); an empty table gives an
empty table; a result name that the table already has is refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from rowsmith.llm.common import ascii_lower, let, refuse_clash, text_of
from rowsmith.operators import ordered
from rowsmith.session import materialise

WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SEED = 2024
SHARE = 10
MIN_WORDS = 20
SCALE = 1000
NO_ID = 2**63 - 1


def words_of(text: Column) -> Column:
    """Runs of a-z, digits and everything beyond ASCII, once A-Z are in lower case."""
    return F.array_remove(F.split(ascii_lower(text), WORD_GAP), "")


def buckets_of(words: Column, max_n: int, buckets: int) -> Column:
    """The bucket of every run of 1 to ``max_n`` words, repeats included."""

    def place(feature: Column) -> Column:
        return F.pmod(F.crc32(feature.cast("binary")), F.lit(buckets)).cast("int")

    def runs(w: Column, n: int) -> Column:
        none = F.array().cast("array<int>")
        starts = F.sequence(F.lit(0), F.size(w) - n)
        return F.when(F.size(w) >= n, F.transform(starts, lambda i: place(F.concat_ws(" ", *[F.get(w, i + k) for k in range(n)])))).otherwise(none)

    if max_n == 1:
        return F.transform(words, place)
    return let(words, lambda w: F.concat(F.transform(w, place), *[runs(w, n) for n in range(2, max_n + 1)]))


def tally(df: DataFrame, column: str, buckets: int) -> list[int]:
    """How often each bucket occurs; one array a task, then at most ``buckets`` rows for the driver."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, np.int64)
        for batch in batches:
            seen += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=buckets)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["bucket", "n"])

    counted = df.select(column).mapInArrow(add_up, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = [0] * buckets
    for bucket, n in counted.collect():
        found[bucket] = n
    return found


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """floor(1000 ln) of how much more frequent each bucket is in the target, both counts starting at one."""
    s, t, size = np.array(corpus, float), np.array(target, float), float(len(corpus))
    ratio = ((t + 1) * (s.sum() + size)) / ((s + 1) * (t.sum() + size))
    return np.floor(SCALE * np.log(ratio)).astype(np.int64).tolist()


def weigh(df: DataFrame, column: str, gain: list[int], into: str = "weight") -> DataFrame:
    """``df`` with the sum of the gains at the row's buckets."""
    names, kind = df.columns, ST.StructType([*df.schema.fields, ST.StructField(into, ST.LongType())])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket = np.array(gain, np.int64)
        for batch in batches:
            lists = batch.column(names.index(column))
            edges = lists.offsets.to_numpy().astype(np.int64)
            upto = np.concatenate([[0], np.cumsum(by_bucket[lists.flatten().to_numpy(zero_copy_only=False)])])
            edges = edges - edges[0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(upto[edges[1:]] - upto[edges[:-1]])], names=[*names, into])

    return df.mapInArrow(add_up, kind)


def noisy(weight: Column, doc_id: Column, seed: int) -> Column:
    """The weight with Gumbel noise from the first 32 bits of sha256(seed:doc_id)."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    even = (F.conv(F.substring(drawn, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(float(2**32))
    return (weight + F.floor(F.lit(-float(SCALE)) * F.log(-F.log(even)))).cast("long")


def _sides(keys: DataFrame, pivot: tuple[int, int] | None) -> list:
    """Per partition: how many keys are (above, equal to, below) the pivot, and the median key above and below.

    Without a pivot all keys are above. A task holds the keys of its own partition, 16 bytes each.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if not parts:
            return
        score, ident = (np.concatenate(side) for side in zip(*parts))
        above = np.ones(len(score), bool)
        equal = np.zeros(len(score), bool)
        if pivot:
            equal = (score == pivot[0]) & (ident == pivot[1])
            above = (score > pivot[0]) | ((score == pivot[0]) & (ident < pivot[1]))
        row = [int(above.sum()), int(equal.sum()), int((~above & ~equal).sum())]
        for side in (above, ~above & ~equal):
            s, d = score[side], ident[side]
            if not len(s):
                row += [0, 0]
                continue
            middle = len(s) // 2
            # Place of the middle key: by score first, then by id among the equal scores alone.
            at = np.partition(-s, middle)[middle]
            ties = np.sort(d[s == -at])
            row += [int(-at), int(ties[middle - int((s > -at).sum())])]
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in row], names=["above", "equal", "below", "high_score", "high_id", "low_score", "low_id"])

    return keys.mapInArrow(look, "above long, equal long, below long, high_score long, high_id long, low_score long, low_id long").collect()


def weighted_median(medians: list[tuple[int, int, int]]) -> tuple[int, int]:
    """The key (score, id) at which half of the weight is reached; ``medians`` are (score, id, keys left)."""
    medians = sorted((m for m in medians if m[2]), key=lambda m: (-m[0], m[1]))
    half, seen = sum(m[2] for m in medians) / 2, 0
    for score, ident, left in medians:
        seen += left
        if seen >= half:
            break
    return score, ident


def cutoff(keys: DataFrame, wanted: int) -> tuple[int, int] | None:
    """The ``wanted``-th key of ``keys`` (score, id) by falling score and rising id; None if nothing is wanted.

    ``keys`` holds ``wanted`` rows at least.
    """
    if wanted < 1:
        return None
    score, ident = F.col("score"), F.col("id")
    found = _sides(keys, None)
    left = written = sum(r.above for r in found)
    pivot = weighted_median([(r.high_score, r.high_id, r.above) for r in found])
    while True:
        found = _sides(keys, pivot)
        above, equal = sum(r.above for r in found), sum(r.equal for r in found)
        if above < wanted <= above + equal:
            return pivot
        if wanted <= above:
            keys = keys.where((score > pivot[0]) | ((score == pivot[0]) & (ident < pivot[1])))
            left = above
            pivot = weighted_median([(r.high_score, r.high_id, r.above) for r in found])
        else:
            keys = keys.where((score < pivot[0]) | ((score == pivot[0]) & (ident > pivot[1])))
            wanted, left = wanted - above - equal, left - above - equal
            pivot = weighted_median([(r.low_score, r.low_id, r.below) for r in found])
        if left * 2 <= written:
            keys, written = materialise(keys, "keys"), left


def resample(
    df: DataFrame, target: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS, max_n: int = 1, buckets: int = BUCKETS, seed: int = SEED,
    doc_id: str = "doc_id", text: str = "text", target_text: str = "text", keep: tuple[str, ...] = ("doc_id",), into: str = "draw",
) -> DataFrame:
    """The ``keep`` columns of every row of ``df``, and a struct: n_features, weight, score, rank (1 for the highest
    score; NULL if not drawn).

    ``share`` per cent, rounded down, of the rows with at least ``min_words`` words are drawn. What is in ``keep`` is
    written to the scratch folder twice: name the text there only if it is wanted beside its rank.
    """
    carried = df.select(*[F.col(f"`{c}`") for c in keep])
    refuse_clash(carried, into)
    # The row travels as one field, so no column of it can clash with a working column.
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row")
    held = df.select(row, F.col(f"`{doc_id}`").cast("long").alias("_id"), words_of(text_of(df, text)).alias("_w"))
    featured = materialise(held.select("_row", "_id", F.size("_w").alias("_n"), buckets_of(F.col("_w"), max_n, buckets).alias("_b")), "features")
    wanted_like = target.select(buckets_of(words_of(text_of(target, target_text)), max_n, buckets).alias("_b"))
    gain = gains(tally(featured, "_b", buckets), tally(wanted_like, "_b", buckets))
    scored = materialise(
        weigh(featured, "_b", gain, "_weight").select(
            "_row", "_n", F.size("_b").cast("long").alias("_f"), "_weight", noisy(F.col("_weight"), F.col("_id"), seed).alias("score"), F.coalesce("_id", F.lit(NO_ID)).alias("id")
        ),
        "scored",
    )
    able = F.col("_n") >= min_words
    drawn = scored.where(able).count() * share // 100
    cut = cutoff(scored.where(able).select("score", "id"), drawn)

    def told(rows: DataFrame, rank: Column) -> DataFrame:
        found = {"n_features": F.col("_f"), "weight": F.col("_weight"), "score": F.col("score"), "rank": rank}
        return rows.select("_row.*", F.struct(*[c.alias(n) for n, c in found.items()]).alias(into))

    none = F.lit(None).cast("long")
    if cut is None:
        return told(scored, none)
    wins = able & ((F.col("score") > cut[0]) | ((F.col("score") == cut[0]) & (F.col("id") <= cut[1])))
    # Rows that repeat the key of the cutoff are numbered like the others; those beyond ``drawn`` are not drawn.
    winners = scored.where(wins).withColumn("at", F.monotonically_increasing_id())
    ranked = ordered.scan(winners, [], [F.col("score").desc(), F.col("id"), F.col("at")], position="rank")
    return told(ranked, F.when(F.col("rank") <= drawn, F.col("rank"))).unionByName(told(scored.where(~wins), none))
