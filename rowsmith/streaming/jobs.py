"""Structured Streaming forms of the batch operators.

Event times are cast to TIMESTAMP first: a watermark does not accept the
time-zone-free type the event files are read with.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.functions import text as T
from rowsmith.operators import corpus, lines, lookup
from rowsmith.session import scratch_path


def table_stream(spark: SparkSession, folder: str, name: str, files_per_batch: int = 1000) -> DataFrame:
    """A parquet table as a stream of its files."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{folder}/{name}.parquet*")


class Sink:
    """Where a stream's rows and its progress are kept between runs."""

    def __init__(self, spark: SparkSession, mode: str = "append"):
        self.path, self.mode = scratch_path(spark, "stream"), mode

    def run(self, stream: DataFrame):
        """Everything that is there by now, into a parquet folder; the finished query."""
        query = (
            stream.writeStream.format("parquet").outputMode(self.mode)
            .option("path", f"{self.path}/out").option("checkpointLocation", f"{self.path}/state")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return query

    def merge(self, stream: DataFrame, merge) -> None:
        """Everything that is there by now, each micro-batch and its number handed to ``merge``."""
        query = (
            stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{self.path}/state")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()

    def rows(self, spark: SparkSession, schema) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{self.path}/out")


def drain(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over everything available into a parquet sink and read that."""
    sink = Sink(stream.sparkSession, mode)
    sink.run(stream)
    return sink.rows(stream.sparkSession, stream.schema)


def deliveries(spark: SparkSession, rows: DataFrame, number: Column) -> tuple[DataFrame, Iterator[int]]:
    """A table that arrives in parts: the stream of what has arrived, and an iterator that delivers the next part.

    The table is read once and written by parts, each in as many files as the table has partitions; a part arrives by
    one rename. Parts arrive in the order of their numbers.
    """
    base, (part, incoming) = scratch_path(spark, "parts"), ("part", "in")
    rows.withColumn(part, number.cast("long")).write.partitionBy(part).parquet(f"{base}/held")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    store = hadoop(base).getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(hadoop(f"{base}/{incoming}"))
    held = [f.getPath() for f in store.globStatus(hadoop(f"{base}/held/{part}=*"))]
    by_number = sorted((int(p.getName().split("=")[1]), p) for p in held)

    def arrive() -> Iterator[int]:
        for n, path in by_number:
            store.rename(path, hadoop(f"{base}/{incoming}/{n}"))
            yield n

    return spark.readStream.schema(rows.schema).parquet(f"{base}/{incoming}/*"), arrive()


def event_time(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def doc_stats(docs: DataFrame) -> DataFrame:
    """Statistics of texts as they arrive; the batch function, unchanged."""
    return corpus.doc_stats(docs)


def window_counts(
    events: DataFrame, ts: str, width: str, by: list[str], slide: str | None = None, delay: str = "1 hour"
) -> DataFrame:
    """Events per window and group; rows later than the delay are dropped by a stream."""
    timed = event_time(events, ts).withWatermark(ts, delay)
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    return timed.groupBy(w, *by).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "n"
    )


def sessions(events: DataFrame, by: list[str], ts: str, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Sessions with the number of events, their length and the mean lap between two events."""
    timed = event_time(events, ts).withWatermark(ts, delay)
    length = F.unix_micros(F.max(ts)) - F.unix_micros(F.min(ts))
    return timed.groupBy(F.session_window(ts, gap), *by).agg(
        F.count(F.lit(1)).alias("events"), length.alias("length_us"),
        F.try_divide(length, F.count(F.lit(1)) - 1).alias("mean_lap_us"),
    ).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *by, "events", "length_us", "mean_lap_us")


def dedup_lines(docs: DataFrame, ts: str, horizon: str, ignore_case: bool = True, trim: bool = True) -> DataFrame:
    """The first copy of every line over a stream; a later copy within ``horizon`` of it is dropped.

    Spark forgets a line once the watermark has passed its time and the horizon, so the state holds the lines of about two
    horizons, not all that ever came; a line that comes again after that is kept again.
    """
    timed = event_time(docs, ts).withWatermark(ts, horizon)
    keyed = lines.explode_lines(timed, keep=("doc_id", ts)).withColumn("key", T.line_key("line", ignore_case, trim))
    return keyed.dropDuplicatesWithinWatermark(["key"])


def folders(spark: SparkSession, path: str, kind: str, mark: str = "/_SUCCESS") -> list[int]:
    """Numbers of the finished ``kind=<n>`` folders below ``path``, ascending; of all of them without a mark."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}=*{mark}"))
    named = [f.getPath().getParent() if mark else f.getPath() for f in (found or [])]
    return sorted(int(where.getName().split("=")[1]) for where in named)


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class KeyedStore:
    """One best row per key over all micro-batches, whatever order rows arrive in.

    Each batch is reduced to one row per key and written to its own folder, so only changed keys are written and a
    replayed batch overwrites itself. Every ``compact_every`` batches the folders are merged into the base and go, so no
    more than that many are ever read. The base lies in ``buckets`` of keys: a merge writes the buckets anew that have
    changed, and leaves the others in the base they are in.
    """

    def __init__(
        self, path: str, key: str, order: list[str], values: list[str], newest: bool, compact_every: int = 10, buckets: int = 1
    ):
        self.path, self.key, self.order, self.values = path, key, order, values
        self.newest, self.compact_every, self.buckets = newest, compact_every, buckets

    def _best(self, df: DataFrame) -> DataFrame:
        pick = F.max_by if self.newest else F.min_by
        columns = [c for c in [*self.order, *self.values] if c != self.key]
        best = pick(F.struct(*columns), F.struct(*self.order))
        return df.groupBy(self.key).agg(best.alias("_v")).select(self.key, "_v.*")

    def _write(self, df: DataFrame, folder: str) -> None:
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets))
        df.withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{folder}")

    def _buckets(self, spark: SparkSession, kind: str, numbers: list[int]) -> dict[int, list[tuple[int, str]]]:
        """{bucket: [(number, folder)]} of the finished folders of a kind."""
        found: dict[int, list[tuple[int, str]]] = {}
        for n in numbers:
            for bucket in folders(spark, f"{self.path}/{kind}={n}", "bucket", ""):
                found.setdefault(bucket, []).append((n, f"{self.path}/{kind}={n}/bucket={bucket}"))
        return found

    def _current(self, spark: SparkSession, buckets: set[int] | None = None) -> list[str]:
        """The folders that hold the store: the latest base of each bucket, and the batches since the latest of all."""
        bases = folders(spark, self.path, "base")
        batches = [n for n in folders(spark, self.path, "batch") if not bases or n > bases[-1]]
        base, since = self._buckets(spark, "base", bases), self._buckets(spark, "batch", batches)
        latest = [max(held)[1] for bucket, held in base.items() if buckets is None or bucket in buckets]
        return latest + [path for bucket, held in since.items() if buckets is None or bucket in buckets for _, path in held]

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        columns = list(dict.fromkeys([self.key, *self.order, *self.values]))
        bases = folders(spark, self.path, "base")
        if bases and batch_id <= bases[-1]:
            # Run again after it was merged: the base has these rows.
            return
        self._write(self._best(batch.select(*columns)), f"batch={batch_id}")
        if batch_id and batch_id % self.compact_every == 0:
            batches = [n for n in folders(spark, self.path, "batch") if n <= batch_id]
            touched = set(self._buckets(spark, "batch", batches))
            if not touched:
                return
            old = self._buckets(spark, "base", bases)
            self._write(self._best(spark.read.parquet(*self._current(spark, touched))), f"base={batch_id}")
            for n in batches:
                remove(spark, f"{self.path}/batch={n}")
            for bucket in touched:
                for _, path in old.get(bucket, []):
                    remove(spark, path)
            for n in bases:
                if not folders(spark, f"{self.path}/base={n}", "bucket", ""):
                    remove(spark, f"{self.path}/base={n}")

    def rows(self, spark: SparkSession) -> DataFrame:
        return self._best(spark.read.parquet(*self._current(spark)))


class LatestWins(KeyedStore):
    """Keep the values with the highest sequence number per key."""

    def __init__(self, path: str, key: str, seq: str, values: list[str], compact_every: int = 10, buckets: int = 1):
        super().__init__(path, key, [seq], values, newest=True, compact_every=compact_every, buckets=buckets)

    def latest(self, spark: SparkSession) -> DataFrame:
        return self.rows(spark)


class FirstLines(KeyedStore):
    """Line de-duplication over a stream of documents: the first copy by (time, doc_id, line_no) is kept."""

    def __init__(self, path: str, ts: str, ignore_case: bool = True, trim: bool = True, compact_every: int = 10):
        super().__init__(path, "key", [ts, "doc_id", "line_no"], ["line"], newest=False, compact_every=compact_every)
        self.ts, self.ignore_case, self.trim = ts, ignore_case, trim

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        rows = lines.explode_lines(batch, keep=("doc_id", self.ts))
        super().merge(rows.withColumn("key", T.line_key("line", self.ignore_case, self.trim)), batch_id)


class RatesJoin:
    """Rows converted batch by batch; ``rates`` is called for each, so a running stream sees new rates."""

    def __init__(self, path: str, rates, date: str, amount: str, frm: str, to: str, columns: list[str]):
        self.path, self.rates, self.how, self.columns = path, rates, (date, amount, frm, to), columns

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        out = lookup.convert_asof(batch, *self.how, self.rates())
        out.select(*self.columns).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(*[f"{self.path}/batch={n}" for n in folders(spark, self.path, "batch")])
