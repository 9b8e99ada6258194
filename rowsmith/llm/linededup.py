"""Line de-duplication within an edit distance of one, by a deletion-neighbourhood join.

Equal lines are brought together first (partial aggregate on a 128-bit digest). Two different lines within one edit
agree in their first or in their second half, so four hashed half keys per line find the lines that can have a
partner at all; only those emit their neighbourhood: the line itself and every variant with one character deleted, as
hashed keys with the place of the deletion. Equal keys are joined:

* two variants of one length with the deletion in one place: one substitution apart;
* a line and a variant of a longer one: one insertion apart.

The earliest partner is verified by edit distance. A line is dropped if the corpus has an equal line or one within
the bound before it, in order of (doc_id, line number); a NULL id comes first. The groups of one key are bounded by
alphabet and line length, because equal lines are one row by then.

Defined results: NULL and empty texts have no lines; lines without a word are never dropped; lines under MIN_CHARS
characters are only compared for equality; outer white space does not count; a row repeated under its id is the same
document, so its lines are the same lines and not duplicates of each other; very long lines and texts are compared whole;
an empty table has no duplicates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.llm.common import SPACES, may_match, small_batches, text_of
from rowsmith.session import materialise

MIN_CHARS = 20
BASE = 0x9E3779B97F4A7C15


def lines_of(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc, no (from 0, by id), line (trimmed), h of every line with a word."""
    rows = df.select(F.col(doc_id).cast("long").alias("doc"), text_of(df, text).alias("t"))
    split = rows.select("doc", F.posexplode(F.split("t", "\n")).alias("no", "line"))
    trimmed = split.withColumn("line", F.trim("line", F.lit(SPACES))).where("line <> ''")
    return trimmed.withColumn("h", F.unhex(F.md5("line")))


def half_keys(line, length):
    """Keys as the shorter or equal line (own length) and as the longer one (partner's length is one less)."""

    def pair(n):
        left = F.floor(n / 2).cast("int")
        return [
            F.xxhash64(n, F.lit("left"), F.substring(line, F.lit(1), left)),
            F.xxhash64(n, F.lit("right"), F.right(line, n - left)),
        ]

    return [*pair(length), *pair(length - 1)]


def neighbourhood(line: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the line and of its deletion variants, and the place of each deletion (-1: the line itself)."""
    codes = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(np.uint64)
    codes = (codes + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    codes ^= codes >> np.uint64(31)
    powers = np.cumprod(np.full(len(codes), BASE, np.uint64))
    # The hash of a string is the sum of code * BASE^place; what stands after a deletion moves down one power.
    here = np.concatenate([[np.uint64(0)], np.cumsum(codes * powers)])
    moved = np.concatenate([[np.uint64(0)], np.cumsum(codes[1:] * powers[:-1])])
    gone = here[:-1] + (moved[-1] - moved)
    every = np.concatenate([here[-1:], gone])
    every = (every ^ (every >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return every.view(np.int64), np.arange(-1, len(codes), dtype=np.int32)


def duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, line_no, kept_doc_id, kept_line_no, distance (0 or 1) of every line that goes."""
    spark = df.sparkSession
    lines = lines_of(df, doc_id, text)
    length = F.length("line")
    keyed = lines.select("doc", "no", "h", *[F.when(length >= min_chars, k).alias(f"k{i}") for i, k in enumerate(half_keys(F.col("line"), length))])
    first = F.min(F.struct("doc", "no")).alias("first")
    distinct = materialise(keyed.groupBy("h").agg(first, *[F.max(f"k{i}").alias(f"k{i}") for i in range(4)]), "lines")

    # A line's four keys differ from each other, so a key that counts two is of two lines.
    short = distinct.where("k0 is not null").withColumn("s", F.xxhash64("h"))
    halves = short.select("s", F.explode(F.array("k0", "k1", "k2", "k3")).alias("k"))
    shared = halves.groupBy("k").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("k")
    able = halves.join(shared, "k").select("s").distinct()
    wanted = materialise(short.join(able, "s").select("h", "first"), "wanted")
    # The text of each such line, from its first place.
    texts = materialise(
        may_match(lines, F.col("h"), wanted, F.col("h")).join(wanted.withColumnRenamed("h", "wh"), (F.col("h") == F.col("wh")) & F.struct("doc", "no").eqNullSafe(F.col("first")))
        .select("h", "first", "line").dropDuplicates(["h"]),
        "texts",
    )
    small_batches(spark, 1000)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, doc, no = batch.column("h"), batch.column("doc"), batch.column("no")
            at, keys, places, size = [], [], [], 0
            for row, line in enumerate(batch.column("line").to_pylist()):
                key, place = neighbourhood(line)
                at.append(np.full(len(key), row))
                keys.append(key)
                places.append(place)
                size += len(key)
                if size > 200_000 or row == batch.num_rows - 1:
                    take = pa.array(np.concatenate(at))
                    yield pa.RecordBatch.from_arrays(
                        [h.take(take), doc.take(take), no.take(take), pa.array(np.concatenate(keys)), pa.array(np.concatenate(places))],
                        names=["h", "doc", "no", "key", "place"],
                    )
                    at, keys, places, size = [], [], [], 0

    spelled = texts.select("h", F.col("first.doc").alias("doc"), F.col("first.no").alias("no"), "line").mapInArrow(
        emit, "h binary, doc long, no int, key long, place int"
    )
    me = F.struct("doc", "no", "h")
    by_key = Window.partitionBy("key")
    by_place = Window.partitionBy("key", "place")
    whole = F.min(F.when(F.col("place") < 0, me)).over(by_key)
    cut = F.min(F.when(F.col("place") >= 0, me)).over(by_key)
    same_place = F.min(F.when(F.col("place") >= 0, me)).over(by_place)
    near = spelled.withColumn("partner", F.when(F.col("place") < 0, cut).otherwise(F.least(whole, same_place)))
    earliest = near.where(F.col("partner") < me).groupBy("h").agg(F.min("partner").alias("partner"))
    mine, theirs = texts.select("h", "line"), texts.select(F.col("h").alias("ph"), F.col("line").alias("other"))
    proved = (
        earliest.join(mine, "h").join(theirs, F.col("partner.h") == F.col("ph"))
        .where(F.levenshtein("line", "other", 1) == 1)
        .select(F.col("h").alias("nh"), F.struct("partner.doc", "partner.no").alias("partner"))
    )
    fate = distinct.select("h", "first").join(proved, F.col("h") == F.col("nh"), "left").select("h", "first", "partner")
    placed = keyed.select("doc", "no", "h").join(fate, "h")
    goes = F.col("partner").isNotNull() | ~F.struct("doc", "no").eqNullSafe(F.col("first"))
    kept = F.coalesce("partner", "first")
    return placed.where(goes).select(
        F.col("doc").alias(doc_id), F.col("no").cast("long").alias("line_no"), kept["doc"].alias("kept_doc_id"),
        kept["no"].cast("long").alias("kept_line_no"), F.when(F.col("partner").isNotNull(), 1).otherwise(0).cast("long").alias("distance"),
    )


def drop_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``df`` with the duplicate lines cut out of its texts; columns as they were."""
    gone = duplicates(df, doc_id, text, **how).groupBy(F.col(doc_id).alias("_gd")).agg(F.collect_set("line_no").alias("_gone"))
    rows = df.select(F.struct("*").alias("_row"), F.col(doc_id).cast("long").alias("_id"))
    joined = rows.join(gone, F.col("_id").eqNullSafe(F.col("_gd")), "left")
    whole = F.col("_row").getField(text)
    left = F.filter(F.split(whole, "\n"), lambda _, i: ~F.array_contains("_gone", i.cast("long")))
    cut = F.when(F.col("_gone").isNull(), whole).otherwise(F.array_join(left, "\n"))
    return joined.select(F.col("_row").withField(text, cut).alias("_row")).select("_row.*")
