"""Running values in key order that survive a key holding most of the rows.

A plain window sends every row of one key to one task. That is right where the caller knows a key to be bounded (an
order, a document, a page) and says so. Else the rows are range-partitioned on (key, order), so a hot key spans many
partitions; each partition computes its own values, and only one carry row per partition border travels between them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from rowsmith.session import materialise

EXACT = (ST.ByteType, ST.ShortType, ST.IntegerType, ST.LongType, ST.DecimalType)


def scan(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    *,
    position: str | None = None,
    previous: dict[str, str] | None = None,
    running: dict[str, str] | None = None,
    last_known: dict[str, str] | None = None,
    next_known: dict[str, str] | None = None,
    first: dict[str, str] | None = None,
    total: dict[str, str] | None = None,
    highest: dict[str, str] | None = None,
    runs: dict[str, tuple[str, Callable[[Column, Column], Column]]] | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Add ordered columns per key. ``order`` must be total (end in a unique column).

    position    name of a 1-based row number
    previous    {new: source}  value of the row before, NULL on the first row
    running     {new: source}  sum of this and all earlier rows
    last_known  {new: source}  latest non-NULL value up to this row
    next_known  {new: source}  earliest non-NULL value from this row on
    first       {new: source}  value of the key's first row
    total       {new: source}  sum over all rows of the key
    highest     {new: source}  largest value of all rows of the key
    runs        {new: (source, breaks)}  1-based number of the run, where ``breaks`` of the value before and this row's
                               value says that a new one begins; NULL says that none does

    ``bounded`` is the caller's word that one task can hold any key. Sums are taken of whole numbers and decimals only:
    floating sums would depend on where the partitions end.
    """
    wanted = {
        "previous": previous or {}, "running": running or {}, "last_known": last_known or {}, "next_known": next_known or {},
        "first": first or {}, "total": total or {}, "highest": highest or {}, "runs": runs or {},
    }
    for source in [*wanted["running"].values(), *wanted["total"].values()]:
        if not isinstance(df.schema[source].dataType, EXACT):
            raise ValueError(f"{source} must be a whole number or a decimal")
    if bounded and keys:
        return _with_windows(df, keys, order, position, **wanted)
    return _split_scan(df, keys, order, position, **wanted)


def _with_windows(df, part_by, order, position, previous, running, last_known, next_known, first, total, highest, runs):
    w = Window.partitionBy(*part_by).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    columns = df.columns
    # Whether a row breaks with the one before; the first row of a key opens the first run.
    breaks = {f"_scan_breaks_{new}": says(F.lag(src).over(w), F.col(src)) for new, (src, says) in runs.items()}
    if breaks:
        at = F.row_number().over(w)
        df = df.select("*", *[F.when((at == 1) | F.coalesce(b, F.lit(False)), 1).otherwise(0).alias(n) for n, b in breaks.items()])
    whole = Window.partitionBy(*part_by)
    added = {}
    if position:
        added[position] = F.row_number().over(w).cast("long")
    for new, src in previous.items():
        added[new] = F.lag(src).over(w)
    for new, src in running.items():
        added[new] = F.sum(src).over(upto)
    for new, src in last_known.items():
        added[new] = F.last(src, ignorenulls=True).over(upto)
    for new, src in first.items():
        added[new] = F.first(src).over(upto)
    for new, src in total.items():
        added[new] = F.sum(src).over(whole)
    for new, src in highest.items():
        added[new] = F.max(src).over(whole)
    for new in runs:
        added[new] = F.sum(f"_scan_breaks_{new}").over(upto)
    if next_known:
        added["_scan_back"] = F.row_number().over(w)
    out = df.select(*columns, *[expr.alias(new) for new, expr in added.items()])
    if not next_known:
        return out
    # From the far end, so that a frame only ever grows.
    back = Window.partitionBy(*part_by).orderBy(F.col("_scan_back").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return out.select("*", *[F.last(src, ignorenulls=True).over(back).alias(new) for new, src in next_known.items()]).drop("_scan_back")


def _split_scan(df, keys, order, position, previous, running, last_known, next_known, first, total, highest, runs):
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = df.columns
    ranged = df.repartitionByRange(n, *[F.col(k) for k in keys], *order).withColumn(
        "_scan_part", F.spark_partition_id()
    )
    local = materialise(
        _with_windows(ranged, ["_scan_part", *keys], order, "_scan_row", previous, running, last_known, next_known, first, total, highest, runs), "scan"
    )

    # A key that spans partitions is the first or the last key of each. Only the rows of those keys are grouped, into two
    # rows a partition at most: that bound is what allows the broadcasts.
    outer = local
    if keys:
        own = F.struct(*keys)
        ends = local.groupBy("_scan_part").agg(F.min(own).alias("_scan_low"), F.max(own).alias("_scan_high"))
        ends = ends.withColumnRenamed("_scan_part", "_scan_p")
        at_end = (F.col("_scan_part") == F.col("_scan_p")) & (own.eqNullSafe(F.col("_scan_low")) | own.eqNullSafe(F.col("_scan_high")))
        outer = local.join(F.broadcast(ends), at_end, "left_semi")
    edge = outer.groupBy("_scan_part", *keys).agg(
        F.count(F.lit(1)).alias("_scan_count"),
        *[F.max_by(src, "_scan_row").alias(f"_scan_tail_{new}") for new, src in previous.items()],
        *[F.max_by(new, "_scan_row").alias(f"_scan_sum_{new}") for new in running],
        *[F.max_by(new, "_scan_row").alias(f"_scan_known_{new}") for new in last_known],
        *[F.max_by(new, "_scan_row").alias(f"_scan_first_{new}") for new in first],
        *[F.max(new).alias(f"_scan_total_{new}") for new in total],
        *[F.max(new).alias(f"_scan_highest_{new}") for new in highest],
        *[F.min_by(new, "_scan_row").alias(f"_scan_next_{new}") for new in next_known],
        *[F.max(new).alias(f"_scan_runs_{new}") for new in runs],
        *[F.min_by(src, "_scan_row").alias(f"_scan_head_{new}") for new, (src, _) in runs.items()],
        *[F.max_by(src, "_scan_row").alias(f"_scan_end_{new}") for new, (src, _) in runs.items()],
    )
    # Without keys there is one edge row per partition, so one group of n rows.
    by_key = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_scan_part")
    before = by_key.rowsBetween(Window.unboundedPreceding, -1)
    every = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # The keys of 2n rows are few: their windows from the far end may count from each row on.
    after = by_key.rowsBetween(1, Window.unboundedFollowing)
    joins_on = {
        new: F.lag(F.lit(1)).over(by_key).isNotNull() & ~F.coalesce(says(F.lag(f"_scan_end_{new}").over(by_key), F.col(f"_scan_head_{new}")), F.lit(False))
        for new, (_, says) in runs.items()
    }
    # A run that goes on over a border was counted on either side of it.
    edge = edge.select("*", *[joined.cast("int").alias(f"_scan_joins_{new}") for new, joined in joins_on.items()])
    upto = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carry = edge.select(
        "_scan_part",
        *keys,
        F.sum("_scan_count").over(before).alias("_scan_before"),
        F.count(F.lit(1)).over(every).alias("_scan_spans"),
        *[F.first(f"_scan_first_{new}").over(every).alias(f"_scan_first_{new}") for new in first],
        *[F.sum(f"_scan_total_{new}").over(every).alias(f"_scan_total_{new}") for new in total],
        *[F.max(f"_scan_highest_{new}").over(every).alias(f"_scan_highest_{new}") for new in highest],
        *[F.lag(f"_scan_tail_{new}").over(by_key).alias(f"_scan_tail_{new}") for new in previous],
        *[F.sum(f"_scan_sum_{new}").over(before).alias(f"_scan_sum_{new}") for new in running],
        *[
            F.last(f"_scan_known_{new}", ignorenulls=True).over(before).alias(f"_scan_known_{new}")
            for new in last_known
        ],
        *[F.first(f"_scan_next_{new}", ignorenulls=True).over(after).alias(f"_scan_next_{new}") for new in next_known],
        *[(F.coalesce(F.sum(f"_scan_runs_{new}").over(before), F.lit(0)) - F.sum(f"_scan_joins_{new}").over(upto)).alias(f"_scan_runs_{new}") for new in runs],
    )
    carry = carry.where("_scan_spans > 1").select(
        *[F.col(c).alias(f"_scan_c_{c}") for c in ["_scan_part", *keys]],
        *[c for c in carry.columns if c not in ("_scan_part", *keys)],
    )
    on = F.lit(True)
    for c in ["_scan_part", *keys]:
        on = on & local[c].eqNullSafe(carry[f"_scan_c_{c}"])
    joined = local.join(F.broadcast(carry), on, "left")

    out = [F.col(c) for c in columns]
    if position:
        out.append((F.col("_scan_row") + F.coalesce("_scan_before", F.lit(0))).cast("long").alias(position))
    came = F.col("_scan_before").isNotNull()
    for new in previous:
        out.append(F.when((F.col("_scan_row") == 1) & came, F.col(f"_scan_tail_{new}")).otherwise(F.col(new)).alias(new))
    for new in running:
        carried = F.col(f"_scan_sum_{new}")
        out.append(
            F.when(carried.isNull(), F.col(new))
            .when(F.col(new).isNull(), carried)
            .otherwise(F.col(new) + carried)
            .alias(new)
        )
    for new in last_known:
        out.append(F.coalesce(F.col(new), F.col(f"_scan_known_{new}")).alias(new))
    for new in next_known:
        out.append(F.coalesce(F.col(new), F.col(f"_scan_next_{new}")).alias(new))
    for new in runs:
        out.append((F.col(new) + F.coalesce(f"_scan_runs_{new}", F.lit(0))).alias(new))
    for new in first:
        out.append(F.when(came, F.col(f"_scan_first_{new}")).otherwise(F.col(new)).alias(new))
    for new in total:
        spans = F.col("_scan_spans").isNotNull()
        out.append(F.when(spans, F.col(f"_scan_total_{new}")).otherwise(F.col(new)).alias(new))
    for new in highest:
        out.append(F.coalesce(F.col(f"_scan_highest_{new}"), F.col(new)).alias(new))
    return joined.select(*out)
