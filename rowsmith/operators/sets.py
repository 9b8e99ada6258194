"""Set comparison of lists held as tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Items in one side only, tagged with the side. One aggregate, no self-join."""
    cols = a.columns
    both = a.withColumn("_a", F.lit(1)).withColumn("_b", F.lit(0)).unionByName(
        b.withColumn("_a", F.lit(0)).withColumn("_b", F.lit(1))
    )
    seen = both.groupBy(*cols).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    return seen.where("_a <> _b").select(*cols, F.when(F.col("_a") == 1, "a").otherwise("b").alias("only_in"))


def missing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Items of ``a`` that ``b`` lacks; no rows when a is a subset of b."""
    return a.distinct().subtract(b)


def verdict(*findings: DataFrame) -> DataFrame:
    """All findings (rule, severity, ...) as counts per rule and severity."""
    slim = [f.select("rule", "severity") for f in findings]
    return reduce(DataFrame.unionByName, slim).groupBy("rule", "severity").agg(F.count(F.lit(1)).alias("n"))


def passed(*findings: DataFrame) -> bool:
    """True when no finding is an error. Looks for one row only."""
    errors = [f.select("severity").where("severity = 'error'").limit(1) for f in findings]
    return reduce(DataFrame.unionByName, errors).isEmpty()


def compare_ordered(wanted: DataFrame, listed: DataFrame, key: str, name: str, place: str) -> DataFrame:
    """Differences between two ordered lists: missing, extra, wrong order, other name.

    Places are compared only where both lists hold the same keys in number and
    kind; otherwise a shift would accuse every later row.
    """
    w = wanted.select(F.col(key), F.col(name).alias("_wn"), F.col(place).alias("_wp"))
    x = listed.select(F.col(key), F.col(name).alias("_ln"), F.col(place).alias("_lp"))
    both = w.join(x, key, "full_outer")
    same_members = both.agg(F.count(F.when(F.col("_wp").isNull() | F.col("_lp").isNull(), 1)) == 0).scalar()
    state = (
        F.when(F.col("_lp").isNull(), "missing")
        .when(F.col("_wp").isNull(), "extra")
        .when(F.col("_wn") != F.col("_ln"), "other name")
        .when(F.col("_same") & (F.col("_wp") != F.col("_lp")), "wrong place")
    )
    return both.withColumn("_same", same_members).select(key, state.alias("state")).where("state is not null")
