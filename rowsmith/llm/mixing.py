"""Mix sources to target weights by capped water-filling, then draw whole and fractional repetitions.

Sums per source come first (partial aggregates), the level is found over the short table of sources, and the
documents of the fractional repetition are those with the smallest seeded hash: a histogram of hash buckets finds
the bucket in which a source's target ends, and only that bucket's documents are put in order. No source, however
large, is ordered in one task. Defined results: NULL text has size 0; a source whose sizes are all 0 gets target 0;
the NULL source comes last; rows that share an id share their draw, and rows
that are equal in id and size are drawn together; very long texts count whole; an empty table gives an empty table; a column
that has the result's name is refused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.llm.common import refuse_clash
from rowsmith.session import materialise

BUCKETS = 4096


def water_fill(sources: DataFrame, size: str, weight: str, total: Column, most: float) -> DataFrame:
    """Add ``target``: ``least(most * size, level * weight)`` with the level at which targets sum to ``total``.

    ``sources`` has one row per source. Sources are clamped in the order of cap / weight; the excess of the
    clamped ones is shared by weight among the rest, until none is above its cap. Where all caps together fall
    short of ``total`` every source gets its cap.
    """
    cap = F.col(size) * F.lit(most)
    # One row per source: the table of sources is what one task orders here, never the documents.
    by_cap = Window.orderBy(cap / F.col(weight), F.col("_name_order"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(0, Window.unboundedFollowing)
    level = (total - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / F.sum(weight).over(onward)
    ranked = sources.withColumn("_level", level).withColumn("_full", cap <= F.col("_level") * F.col(weight))
    # The first source whose cap is above the level that it meets sets the level for all after it.
    first = F.first(F.when(~F.col("_full"), F.col("_level")), ignorenulls=True).over(
        by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return (
        ranked.withColumn("_final", first)
        .withColumn("target", F.when(F.col("_final").isNull(), cap).otherwise(F.least(cap, F.col("_final") * F.col(weight))))
        .drop("_level", "_full", "_final")
    )


def ticket(seed: int, *keys: Column) -> Column:
    """A seeded 48-bit draw that any engine with md5 can repeat."""
    spelled = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(spelled), 1, 12), 16, 10).cast("long")


def mix(
    df: DataFrame,
    size: Column,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 7,
    doc_id: str = "doc_id",
    source: str = "source",
    into: str = "mix",
) -> DataFrame:
    """``df`` with a struct ``into``: size, source_size, target, repeats (whole and drawn) of every row.

    Sources take ``weights`` in code-point order, NULL last, repeating; together they want ``share`` times all
    sizes, each at most ``most`` times its own size.
    """
    refuse_clash(df, into)
    drawing = F.struct(F.col(source).alias("source"), ticket(seed, F.col(doc_id)).alias("ticket"), F.col(doc_id).alias("id"), size.cast("long").alias("size"))
    # The row travels as one field, so no column of it can clash with one of these.
    rows = df.select(F.struct("*").alias("_row"), drawing.alias("_m"))
    bucket = (F.col("_m.ticket") / F.lit(2**48 // BUCKETS)).cast("int")
    # The figures alone are written once, so the texts are read for them only once.
    slim = materialise(rows.select("_m").withColumn("_bucket", bucket), "mix")
    # At most BUCKETS rows per source leave this aggregate, whatever the source holds.
    histogram = slim.groupBy(F.col("_m.source").alias("_source"), "_bucket").agg(F.sum("_m.size").alias("_sum"))
    sources = histogram.groupBy("_source").agg(F.sum("_sum").alias("_source_size"))
    named = sources.withColumn("_name_order", F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())))
    turn = F.pmod(F.col("_name_order") - 1, F.lit(len(weights)))
    weighted = named.withColumn("_weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    wanted = F.sum("_source_size").over(Window.partitionBy()) * F.lit(share)
    filled = water_fill(weighted.withColumn("_wanted", wanted), "_source_size", "_weight", F.col("_wanted"), most)
    epochs = F.when(F.col("_source_size") > 0, F.col("target") / F.col("_source_size")).otherwise(F.lit(0.0))
    filled = filled.withColumn("_whole", F.floor(epochs).cast("long")).withColumn("_rest", F.col("target") - F.col("_whole") * F.col("_source_size"))

    # Where each source's fractional repetition ends: the bucket, and the words left on entering it.
    along = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        histogram.join(filled.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s")))
        .withColumn("_before", F.coalesce(F.sum("_sum").over(along), F.lit(0)))
        .groupBy("_source", "_source_size", "target", "_whole", "_rest")
        .agg(F.max(F.when(F.col("_before") < F.col("_rest"), F.struct("_bucket", "_before"))).alias("_edge"))
        .select(
            "_source", "_source_size", F.col("target").alias("_target"), "_whole",
            F.coalesce(F.col("_edge._bucket"), F.lit(-1)).alias("_last"),
            (F.col("_rest") - F.coalesce(F.col("_edge._before"), F.lit(0))).alias("_left"),
        )
    )
    # Only rows of the last bucket are ordered: one part in BUCKETS of a source. The last one drawn is the cut.
    order = Window.partitionBy("_m.source").orderBy("_m.ticket", "_m.id", "_m.size")
    running = F.sum("_m.size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_m.size") / 2
    key = F.struct("_m.ticket", "_m.id", "_m.size")
    last = (
        slim.join(edges, F.col("_m.source").eqNullSafe(F.col("_source")) & (F.col("_bucket") == F.col("_last")))
        .withColumn("_drawn", running <= F.col("_left"))
        .where("_drawn")
        .groupBy(F.col("_source").alias("_ls"))
        .agg(F.max(key).alias("_cut"))
    )
    # Written once: its real size tells Catalyst whether the table of sources can be broadcast.
    plan = materialise(edges.join(last, F.col("_source").eqNullSafe(F.col("_ls")), "left").drop("_ls", "_left"), "mix")
    placed = rows.join(plan, F.col("_m.source").eqNullSafe(F.col("_source")), "left")
    drawn = (bucket < F.col("_last")) | F.coalesce((bucket == F.col("_last")) & (key <= F.col("_cut")), F.lit(False))
    return placed.select(
        "_row.*",
        F.struct(
            F.col("_m.size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
            (F.col("_whole") + F.when(drawn, 1).otherwise(0)).alias("repeats"),
        ).alias(into),
    )


def repeat(df: DataFrame, into: str = "mix") -> DataFrame:
    """The mix itself: every row as often as it was drawn, the struct dropped."""
    times = F.col(f"{into}.repeats").cast("int")
    return df.where(times > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).drop("_copy", into)
