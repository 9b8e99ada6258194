"""Catalogue and corpus search, category chips, related items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.operators import ordered
from rowsmith.session import materialise


def keyword_search(
    df: DataFrame, columns: list[str], query: str, category: str | None = None, category_column: str = "category"
) -> DataFrame:
    """Rows whose joined columns hold the query as written (``%`` and ``_`` are letters here).

    A blank query matches all; category "All" or None does not filter.
    """
    needle = query.strip().lower()
    if category not in (None, "All"):
        df = df.where(F.col(category_column) == category)
    if needle:
        df = df.where(F.lower(F.concat_ws(" ", *columns)).contains(needle))
    return df


def popular(df: DataFrame, flag: str, query: str = "", columns: list[str] | None = None) -> DataFrame:
    """The popular rows; with a query, a search over all rows instead."""
    if query.strip():
        return keyword_search(df, columns or [], query)
    return df.where(F.col(flag))


def used_categories(domain: DataFrame, df: DataFrame, category: str, order: str = "ord") -> DataFrame:
    """The declared categories that hold at least one row, in declared order."""
    used = df.select(category).distinct()
    return domain.join(used, category, "left_semi").orderBy(order)


def related(df: DataFrame, key: str, category: str, sort: str, n: int = 3, bounded: bool = False) -> DataFrame:
    """The next ``n`` rows of the same category in A-Z order, walking round at the end.

    A category with fewer than n + 1 rows is topped up from the start of the whole
    A-Z list. Neighbours are found by an equi-join on (category, place), n rows per
    row, so a big category is never paired with itself.
    """
    slim = df.select(key, category, F.lower(sort).alias("_sort"))
    slim = slim.withColumn("_one", F.lit(1).cast("long"))
    # Place and size of the category come from one scan; the wider result is read three times below.
    placed = ordered.scan(slim, [category], [F.col("_sort"), F.col(key)], position="_pos", total={"_size": "_one"}, bounded=bounded)
    if bounded:
        placed = materialise(placed, "related")
    steps = F.when(F.col("_size") > 1, F.sequence(F.lit(1), F.least(F.lit(n), F.col("_size") - 1).cast("int")))
    wanted = placed.select(
        F.col(key).alias("item"), category, F.col("_size"), F.col("_pos").alias("_from"), F.explode(steps).alias("step")
    ).withColumn("_pos", F.pmod(F.col("_from") - 1 + F.col("step"), F.col("_size")) + 1)
    near = wanted.join(placed.select(category, "_pos", F.col(key).alias("related")), [category, "_pos"]).select(
        "item", F.col("step").cast("long").alias("step"), "related"
    )

    # A thin category has at most n rows, so the first 2n rows of the whole list
    # always hold n rows of other categories.
    entry = F.struct("_sort", F.col(key).alias("related"), F.col(category).alias("cat"))
    head = placed.orderBy("_sort", key).limit(2 * n).agg(F.sort_array(F.collect_list(entry)))
    thin = placed.where(F.col("_size") <= n).select(F.col(key).alias("item"), category, "_size", head.scalar().alias("_head"))
    others = F.filter("_head", lambda x: x["cat"] != F.col(category))
    topped = thin.select("item", "_size", F.posexplode(F.slice(others, 1, n)).alias("_i", "_x")).where(
        F.col("_size") + F.col("_i") <= n
    ).select("item", (F.col("_size") + F.col("_i")).cast("long").alias("step"), F.col("_x.related").alias("related"))
    return near.unionByName(topped)
