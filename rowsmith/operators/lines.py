"""Line operators: split, de-duplicate, sort, number, diff, order checks, runs.

A document is one text cell, so work inside a document is bounded by the cell.
Work across documents never puts one key into one task: counting and keeping
the first copy are aggregates with a map-side part, ordering is a range sort
that ends in a unique column, running values go through ``ordered.scan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.functions import text as T
from rowsmith.operators import ordered


def explode_lines(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    return docs.select(*keep, F.posexplode(T.split_lines(text)).alias("line_no", "line"))


def drop_blank(lines: DataFrame, line: str = "line") -> DataFrame:
    return lines.where(T.has_ink(line))


def dedup(
    lines: DataFrame,
    keep: str = "first",
    ignore_case: bool = True,
    trim: bool = True,
    drop_blank_lines: bool = False,
    by: tuple[str, ...] = ("doc_id",),
    order: tuple[str, ...] = ("doc_id", "line_no"),
) -> DataFrame:
    """Keep the first copy, the last copy, or only lines that occur once.

    ``by`` is the scope: ("doc_id",) inside each document, () over the corpus.
    The line itself comes back unchanged; only its key is trimmed and lower-cased.
    """
    if drop_blank_lines:
        lines = drop_blank(lines)
    carried = [c for c in lines.columns if c not in by]
    keyed = lines.withColumn("_key", T.line_key("line", ignore_case, trim))
    spot = F.struct(*order)
    pick = {"first": F.min_by, "last": F.max_by, "unique": F.min_by}[keep]
    grouped = keyed.groupBy(*by, "_key").agg(
        pick(F.struct(*carried), spot).alias("_row"), F.count(F.lit(1)).alias("copies")
    )
    if keep == "unique":
        grouped = grouped.where("copies = 1")
    return grouped.select(*by, "_row.*", "copies")


def dedup_stats(
    lines: DataFrame, by: tuple[str, ...] = (), ignore_case: bool = True, trim: bool = True
) -> DataFrame:
    """Lines in, kept and removed, without building the kept lines."""
    keyed = lines.groupBy(*by, T.line_key("line", ignore_case, trim).alias("_key")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    return keyed.groupBy(*by).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("lines_in"),
        F.count(F.lit(1)).alias("lines_kept"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
    )


def sort_order(order: str, ignore_case: bool = True, ties: tuple[str, ...] = ("doc_id", "line_no")) -> list[Column]:
    """Sort expressions for one of the orders a line list can be put in.

    Letters go by the Unicode collation, so an accented line stands among its base letters. Ignoring case ignores accents
    too; else accents and case decide between lines of the same letters.
    """
    line = F.col("line")
    az = [F.collate(T.natural_key(line, ignore_case), "UNICODE_CI_AI" if ignore_case else "UNICODE")]
    asc, desc = [F.col(c).asc() for c in ties], [F.col(c).desc() for c in ties]
    number, size = T.first_number(line), F.length(line)
    orders = {
        "az": [k.asc() for k in az] + asc,
        # The exact reverse of az, so equal lines come out last-first as well.
        "za": [k.desc() for k in az] + desc,
        "num-asc": [number.asc_nulls_last()] + asc,
        "num-desc": [number.desc_nulls_last()] + asc,
        "len-asc": [size.asc()] + [k.asc() for k in az] + asc,
        "len-desc": [size.desc()] + [k.asc() for k in az] + asc,
        "reverse": desc,
    }
    return orders[order]


def sort_lines(lines: DataFrame, order: str = "az", ignore_case: bool = True) -> DataFrame:
    """The whole corpus in order: a range sort, so equal lines may span partitions."""
    return lines.orderBy(*sort_order(order, ignore_case))


def rank_lines(
    lines: DataFrame, order: str = "az", ignore_case: bool = True, by: str = "doc_id", ties: tuple[str, ...] = ("doc_id", "line_no")
) -> DataFrame:
    """The place of every line inside its document, or another group that one task can hold (``place`` starts at 1)."""
    w = Window.partitionBy(by).orderBy(*sort_order(order, ignore_case, ties))
    return lines.withColumn("place", F.row_number().over(w).cast("long"))


def top_lines(lines: DataFrame, order: str, k: int, ignore_case: bool = True) -> DataFrame:
    return sort_lines(lines, order, ignore_case).limit(k)


def number_prefix(number: Column, sep: str = ". ", pad: int = 0) -> Column:
    shown = number.cast("string")
    if pad:
        shown = F.when(F.length(shown) < pad, F.lpad(shown, pad, "0")).otherwise(shown)
    return F.concat(shown, F.lit(sep), F.col("line"))


def number_lines(lines: DataFrame, start: int = 1, step: int = 1, sep: str = ". ", pad: int = 0) -> DataFrame:
    number = F.lit(start) + F.lit(step) * F.col("line_no")
    return lines.withColumn("numbered", number_prefix(number, sep, pad))


def number_corpus_lines(
    docs: DataFrame, start: int = 1, step: int = 1, sep: str = ". ", pad: int = 0
) -> DataFrame:
    """One running number over all documents, in doc_id order.

    Only (doc_id, line count) is put in order; the texts are numbered from their
    document's offset where they lie.
    """
    sizes = docs.select("doc_id", F.size(T.split_lines("text")).cast("long").alias("_n"))
    offsets = ordered.scan(sizes, [], [F.col("doc_id")], running={"_upto": "_n"})
    offsets = offsets.select("doc_id", (F.col("_upto") - F.col("_n")).alias("_offset"))
    lines = explode_lines(docs.join(offsets, "doc_id"), keep=("doc_id", "_offset"))
    number = F.lit(start) + F.lit(step) * (F.col("_offset") + F.col("line_no"))
    return lines.withColumn("number", number).withColumn("numbered", number_prefix(number, sep, pad)).drop("_offset")


def _line_counts(old: DataFrame, new: DataFrame, on: tuple[str, ...], text: str) -> DataFrame:
    a = explode_lines(old, text, on).select(*on, "line", F.lit(1).alias("in_old"), F.lit(0).alias("in_new"))
    b = explode_lines(new, text, on).select(*on, "line", F.lit(0).alias("in_old"), F.lit(1).alias("in_new"))
    return a.unionByName(b).groupBy(*on, "line").agg(F.sum("in_old").alias("in_old"), F.sum("in_new").alias("in_new"))


def diff(old: DataFrame, new: DataFrame, on: tuple[str, ...], text: str = "text") -> DataFrame:
    """How many lines are only in the old text, only in the new one, in both, and how
    many differ in white space you cannot see alone. Copies count: a multiset diff.
    """
    per_line = _line_counts(old, new, on, text)
    left, right = F.greatest(F.expr("in_old - in_new"), F.lit(0)), F.greatest(F.expr("in_new - in_old"), F.lit(0))
    per_key = per_line.groupBy(*on, T.normalise_whitespace("line").alias("_k")).agg(
        F.sum(F.least("in_old", "in_new")).alias("_both"), F.sum(left).alias("_left"), F.sum(right).alias("_right")
    )
    return per_key.groupBy(*on).agg(
        F.sum("_both").alias("common"),
        F.sum("_left").alias("only_old"),
        F.sum("_right").alias("only_new"),
        F.sum(F.least("_left", "_right")).alias("invisible_only"),
    )


def diff_lines(old: DataFrame, new: DataFrame, on: tuple[str, ...], text: str = "text") -> DataFrame:
    """The lines themselves: copies in the old and the new text, and a state.

    "looks the same" marks a line missing on the other side where a line that differs
    only in unseen white space stands instead.
    """
    per_line = _line_counts(old, new, on, text).withColumn("_k", T.normalise_whitespace("line"))
    more_old, more_new = F.col("in_old") > F.col("in_new"), F.col("in_new") > F.col("in_old")
    # Look-alikes of one line in one text; as few as its spellings.
    w = Window.partitionBy(*on, "_k")
    alike = (F.max(more_old.cast("int")).over(w) + F.max(more_new.cast("int")).over(w)) == 2
    state = (
        F.when(~more_old & ~more_new, "common").when(alike, "looks the same")
        .when(more_old, "only old").otherwise("only new")
    )
    return per_line.select(*on, "line", "in_old", "in_new", state.alias("state"))


def order_violations(
    df: DataFrame, by: list[str], key: str, sequence: list[str], bounded: bool = False
) -> DataFrame:
    """Rows that come before their predecessor in A-Z order, and the place they belong."""
    keyed = df.withColumn("_key", F.lower(key))
    seen = ordered.scan(
        keyed, by, [F.col(c) for c in sequence], position="place", previous={"_before": "_key"}, bounded=bounded
    )
    wanted = ordered.scan(seen, by, [F.col("_key"), *[F.col(c) for c in sequence]], position="belongs_at", bounded=bounded)
    return wanted.where(F.col("_key") < F.col("_before")).select(
        *df.columns, F.col("_before").alias("previous_key"), "place", "belongs_at"
    )


def streaks(df: DataFrame, by: list[str], order: list[str], value: str, bounded: bool = False) -> DataFrame:
    """Every run of the same outcome: outcome, length and the place it starts."""
    runs = ordered.scan(
        df.select(*by, *order, value), by, [F.col(c) for c in order], position="_pos",
        runs={"_run": (value, lambda was, now: ~was.eqNullSafe(now))}, bounded=bounded,
    )
    return runs.groupBy(*by, "_run", value).agg(
        F.count(F.lit(1)).alias("length"), F.min("_pos").alias("starts_at")
    ).drop("_run")


def longest_streak(df: DataFrame, by: list[str], order: list[str], value: str, bounded: bool = False) -> DataFrame:
    """The longest run per key; the earliest one when several are equally long."""
    runs = streaks(df, by, order, value, bounded)
    best = F.max_by(F.struct(value, "length", "starts_at"), F.struct("length", -F.col("starts_at")))
    return runs.groupBy(*by).agg(best.alias("_best")).select(*by, "_best.*")


def laps(events: DataFrame, by: list[str], ts: str, tie: str, bounded: bool = False) -> DataFrame:
    """Microseconds since the previous event and since the first one, per key."""
    micros = events.select(*by, tie, F.unix_micros(F.col(ts).cast("timestamp")).alias("at_us"))
    out = ordered.scan(
        micros, by, [F.col("at_us"), F.col(tie)], position="lap_no", previous={"_prev": "at_us"},
        first={"_first": "at_us"}, bounded=bounded,
    )
    out = out.withColumn("lap_us", F.coalesce(F.col("at_us") - F.col("_prev"), F.lit(0)))
    return out.select(
        *by, tie, "lap_no", "lap_us", (F.col("at_us") - F.col("_first")).alias("total_us")
    )


def session_laps(
    events: DataFrame, by: list[str], ts: str, tie: str, gap_seconds: int = 1800, bounded: bool = False
) -> DataFrame:
    """Laps grouped into sessions that end after ``gap_seconds`` without an event."""
    gap = gap_seconds * 1_000_000
    timed = events.select(*by, tie, F.unix_micros(F.col(ts).cast("timestamp")).alias("at_us"))
    numbered = ordered.scan(
        timed, by, [F.col("at_us"), F.col(tie)], previous={"_prev": "at_us"}, runs={"session_no": ("at_us", lambda was, now: now - was >= gap)}, bounded=bounded
    )
    lap = F.col("at_us") - F.col("_prev")
    within = F.when(lap < gap, lap)
    return numbered.groupBy(*by, "session_no").agg(
        F.count(F.lit(1)).alias("events"),
        F.coalesce(F.sum(within), F.lit(0)).alias("length_us"),
        F.max(within).alias("longest_lap_us"),
    )


def marker_audit(marks: DataFrame, by: str, seq: str, kind: str, label: str) -> DataFrame:
    """Check that START and END markers nest, file by file.

    ``kind`` is START or END. Findings: an END that closes nothing, a START that
    is never closed, a pair whose labels cross (neither a prefix of the other).
    """
    in_file = Window.partitionBy(by).orderBy(seq)
    so_far = in_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = F.when(F.col(kind) == "START", 1).otherwise(-1)
    walked = marks.withColumn("_sum", F.sum(step).over(so_far))
    walked = walked.withColumn("_low", F.least(F.lit(0), F.min("_sum").over(so_far)))
    walked = walked.withColumn("_low_before", F.coalesce(F.lag("_low").over(in_file), F.lit(0)))
    is_end = F.col(kind) == "END"
    stray = is_end & (F.col("_sum") < F.col("_low_before"))
    walked = walked.withColumn("_stray", stray).withColumn(
        "_level", F.col("_sum") - F.col("_low") + F.when(is_end, 1).otherwise(0)
    )
    at_level = Window.partitionBy(by, "_stray", "_level").orderBy(seq)
    paired = walked.withColumn("_opened", F.lag(label).over(at_level)).withColumn(
        "_next", F.lead(kind).over(at_level)
    )
    same = F.col("_opened").startswith(F.col(label)) | F.col(label).startswith(F.col("_opened"))
    return paired.select(
        by,
        seq,
        F.col(label).alias("label"),
        F.when(F.col("_stray"), "closes nothing")
        .when(is_end & ~same, "crosses")
        .when(~is_end & F.col("_next").isNull(), "never closed")
        .alias("finding"),
    ).where("finding is not null")
