"""Writers. Nothing is squeezed into one file or through the driver."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.session import materialise
from rowsmith.sources.readers import RATE_HISTORY, flatten


def write_lines(lines: DataFrame, path: str, order: list[Column], line: str = "line") -> None:
    """Text files whose names sort in the order of the lines: a range sort, one file per range."""
    lines.orderBy(*order).select(line).write.mode("error").text(path)


def write_csv(df: DataFrame, path: str, sep: str = ".") -> None:
    """Nested rows flattened to CSV; quotes doubled, line breaks kept inside quotes."""
    flatten(df, sep).write.mode("error").csv(path, header=True, quote='"', escape='"')


def append_rates(rates: DataFrame, path: str) -> None:
    """Add the dates in ``rates`` (rate_date, currency, rate); a date written again is replaced.

    Kept one folder per month, so a year is twelve files and not one per day. Only the
    months that hold a new date are read and rewritten, and writing twice changes nothing.
    """
    spark = rates.sparkSession
    fresh = rates.select("rate_date", "currency", "rate").withColumn("rate_month", F.date_format("rate_date", "yyyy-MM"))
    try:
        kept = spark.read.schema(RATE_HISTORY).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        months, dates = fresh.select("rate_month").distinct(), fresh.select("rate_date").distinct()
        kept = kept.join(months, "rate_month", "left_semi").join(dates, "rate_date", "left_anti")
        # Written aside first: a folder cannot be read and overwritten in one job.
        fresh = materialise(fresh.unionByName(kept), "rates")
    (
        fresh.repartition("rate_month").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("rate_month").parquet(path)
    )


def write_sitemap(urls: DataFrame, path: str) -> None:
    """(loc, changefreq, priority) as XML files of url entries."""
    urls.select("loc", "changefreq", "priority").write.mode("error").xml(path, rowTag="url", rootTag="urlset")


def write_rate_snapshots(snapshots: DataFrame, path: str) -> None:
    """One JSON object per line: (date, base, rates map)."""
    body = F.to_json(F.struct(F.col("date").cast("string").alias("date"), "base", "rates"))
    snapshots.select(body.alias("value")).write.mode("error").text(path)
