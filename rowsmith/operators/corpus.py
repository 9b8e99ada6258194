"""Counts and summaries over texts, numbers, catalogues and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.functions import text as T
from rowsmith.operators import ordered
from rowsmith.session import materialise


def doc_stats(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    counted = docs.select(
        *keep,
        T.word_count(text).alias("words"),
        F.length(text).cast("long").alias("chars"),
        T.solid_length(text).alias("chars_solid"),
        T.sentence_count(text).alias("sentences"),
        T.paragraph_count(text).alias("paragraphs"),
    )
    return counted.withColumn("reading", T.reading_label(F.col("words")))


def corpus_rollup(docs: DataFrame, by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """Document statistics summed by every prefix of ``by`` plus a grand total."""
    stats = doc_stats(docs, keep=("doc_id", *by))
    return stats.rollup(*by).agg(
        F.grouping_id().cast("long").alias("level"),
        F.count(F.lit(1)).alias("docs"),
        *[F.sum(c).alias(c) for c in ("words", "chars", "chars_solid", "sentences", "paragraphs")],
    )


def top_words(docs: DataFrame, k: int = 5, by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The k commonest words per group; ties go to the word met first.

    With ``by=()`` the ranking is over the corpus and ties are alphabetical. A text that is a group of its own is ranked
    inside its row and never shuffled: only the keys are, to tell those that stand in one row. Where a group has several
    rows, its words are tallied inside the partition first, and the per-group limit is applied before the ranking shuffle.
    """
    if "doc_id" not in by:
        return _top_of_groups(docs, k, by)
    named = docs.select(*by, "text")
    again = materialise(named.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*[F.col(c).alias(f"_of_{c}") for c in by]), "again")
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    alone = named.join(again, same, "left_anti").select(*by, F.posexplode(T.commonest(T.tally_words("text"), k)).alias("_place", "_w"))
    ranked = alone.select(*by, (F.col("_place") + 1).cast("long").alias("place"), F.col("_w.word").alias("word"), F.col("_w.n").alias("n"))
    return ranked.unionByName(_top_of_groups(named.join(again, same, "left_semi"), k, by))


def _top_of_groups(docs: DataFrame, k: int, by: tuple[str, ...]) -> DataFrame:
    """``top_words`` of groups of any number of rows."""
    words = docs.select(*by, *([] if "doc_id" in by else ["doc_id"]), F.posexplode(T.tally_words("text")).alias("_pos", "word"))
    if not by:
        tally = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        return tally.orderBy(F.desc("n"), "word").limit(k)
    # One number per place keeps the tally a hash aggregate; a struct would sort.
    place = F.col("_pos") if "doc_id" in by else F.col("doc_id").cast("decimal(20,0)") * 2**31 + F.col("_pos")
    first = F.min(place)
    tally = words.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("n"), first.alias("_first"))
    w = Window.partitionBy(*by).orderBy(F.desc("n"), "_first")
    return (
        tally.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)
        .select(*by, F.col("place").cast("long").alias("place"), "word", "n")
    )


def char_frequency(docs: DataFrame, unit: str = "char", by: tuple[str, ...] = ()) -> DataFrame:
    """How often each character (or word) occurs and its share of the group, in percent."""
    text = F.col("text")
    pieces = F.split(text, "") if unit == "char" else F.regexp_extract_all(F.lower(text), F.lit(T.TALLY_WORD), F.lit(0))
    tally = (
        docs.select(*by, F.explode(pieces).alias(unit)).where(F.col(unit) != "")
        .groupBy(*by, unit).agg(F.count(F.lit(1)).alias("n"))
    )
    if by:
        joined = tally.join(tally.groupBy(*by).agg(F.sum("n").alias("_total")), list(by))
    else:
        joined = tally.withColumn("_total", tally.agg(F.sum("n")).scalar())
    return joined.withColumn("share_pct", 100.0 * F.col("n") / F.col("_total")).drop("_total")


def numeric_summary(df: DataFrame, value: str, by: list[str], bounded: bool = False) -> DataFrame:
    """count, mean, median, modes, range and both standard deviations per group.

    Equal values are counted first; the median is read off running counts, so a
    group of any size is never gathered. All modes are kept, ascending.
    """
    v = F.col(value).cast("double")
    base = df.select(*by, v.alias("_v")).where("_v is not null and not isnan(_v)")
    moments = base.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg("_v").alias("mean"),
        (F.max("_v") - F.min("_v")).alias("spread"),
        F.stddev_pop("_v").alias("sd_pop"), F.stddev_samp("_v").alias("sd_samp"),
    )
    counts = base.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n"))
    placed = ordered.scan(
        counts, by, [F.col("_v")], running={"_upto": "_n"}, total={"_all": "_n"}, highest={"_peak": "_n"}, bounded=bounded
    )
    # The middle rows are number lo and hi (the same one when the count is odd).
    lo, hi = F.floor((F.col("_all") + 1) / 2), F.floor(F.col("_all") / 2) + 1
    start = F.col("_upto") - F.col("_n")
    holds = lambda place: (start < place) & (place <= F.col("_upto"))
    middle = placed.groupBy(*by).agg(
        ((F.max(F.when(holds(lo), F.col("_v"))) + F.max(F.when(holds(hi), F.col("_v")))) / 2).alias("median"),
        F.count(F.when(F.col("_n") == F.col("_peak"), 1)).alias("n_modes"),
        F.min(F.when(F.col("_n") == F.col("_peak"), F.col("_v"))).alias("lowest_mode"),
        F.max("_peak").alias("mode_count"),
    )
    named = middle.withColumnsRenamed({c: f"_of_{c}" for c in by})
    same = F.lit(True)
    for c in by:
        same = same & moments[c].eqNullSafe(named[f"_of_{c}"])
    return moments.join(named, same).drop(*[f"_of_{c}" for c in by])


def modes(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Every value that is as frequent as the most frequent one."""
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    peak = counts.groupBy(*by).agg(F.max("n").alias("_peak"))
    return counts.join(peak, by).where("n = _peak").drop("_peak")


def pct_of(pct: Column, whole: Column) -> Column:
    return whole * pct / 100


def pct_share(part: Column, whole: Column) -> Column:
    return F.try_divide(part * 100.0, whole)


def pct_change(old: Column, new: Column) -> Column:
    """Change in percent of the size of the old value; NULL from zero."""
    return F.try_divide((new - old) * 100.0, F.abs(old))


def share_of_total(df: DataFrame, value: Column, by: list[str], within: list[str] = []) -> DataFrame:
    """Group totals and their share of the total of ``within`` (or of everything)."""
    totals = df.groupBy(*by).agg(F.sum(value).alias("amount"))
    if within:
        joined = totals.join(totals.groupBy(*within).agg(F.sum("amount").alias("_whole")), within)
    else:
        joined = totals.withColumn("_whole", totals.agg(F.sum("amount")).scalar())
    return joined.withColumn("share_pct", pct_share(F.col("amount").cast("double"), F.col("_whole").cast("double"))).drop("_whole")


def invisible_audit(docs: DataFrame, by: tuple[str, ...] = ("source",)) -> DataFrame:
    """How many of each space look-alike and invisible character, per group."""
    found = (
        docs.where(F.col("text").rlike(T.INVISIBLE))
        .select(*by, F.explode(F.regexp_extract_all("text", F.lit(T.INVISIBLE), F.lit(0))).alias("_ch"))
        .groupBy(*by, "_ch").agg(F.count(F.lit(1)).alias("n"))
    )
    code = F.conv(F.hex(F.encode("_ch", "UTF-16BE")), 16, 10).cast("long")
    return found.select(*by, code.alias("code_point"), F.col("_ch").rlike(T.ZERO_WIDTH).alias("zero_width"), "n")


def unit_price(df: DataFrame, group: str, item: str, price: Column, base_qty: Column) -> DataFrame:
    """Price per base unit with its rank in the group (equal prices share one), the cheapest and the biggest flagged."""
    priced = df.select(group, item, base_qty.alias("base_qty"), F.try_divide(price, base_qty).alias("unit_price"))
    best = priced.groupBy(group).agg(F.min("unit_price").alias("_best"), F.max("base_qty").alias("_most"))
    # Ranks come from the list of different prices, so equal prices are one row of it.
    steps = priced.where("unit_price is not null").groupBy(group, "unit_price").agg(F.count(F.lit(1)).alias("_n"))
    ranked = ordered.scan(steps, [group], [F.col("unit_price")], running={"_upto": "_n"}).select(
        F.col(group).alias("_rg"), F.col("unit_price").alias("_rp"), (F.col("_upto") - F.col("_n") + 1).alias("rank")
    )
    priced = priced.join(ranked, F.col(group).eqNullSafe(F.col("_rg")) & (F.col("unit_price") == F.col("_rp")), "left")
    return priced.join(best, group).select(
        group, item, "unit_price", "rank",
        (F.col("unit_price") == F.col("_best")).alias("cheapest"),
        (F.col("base_qty") == F.col("_most")).alias("biggest"),
    )


def category_counts(df: DataFrame, category: str, planned: DataFrame) -> DataFrame:
    """Rows per category beside the planned number, with a total row (category NULL)."""
    live = df.groupBy(category).agg(F.count(F.lit(1)).alias("live"))
    both = live.join(planned, category, "full_outer").na.fill(0, ["live", "planned"])
    return both.rollup(category).agg(
        F.grouping_id().cast("long").alias("is_total"),
        F.sum("live").alias("live"), F.sum("planned").alias("planned"),
        (F.sum("planned") - F.sum("live")).alias("remaining"),
    )


def host_of(url: str = "url") -> Column:
    return F.regexp_extract(F.col(url), r"^[a-z]+://([^/?#:]+)", 1)


def page_weight(pages: DataFrame) -> DataFrame:
    """Bytes per host before and after comments and gaps between tags are squeezed out."""
    sized = pages.select(
        host_of().alias("host"),
        F.octet_length("html").cast("long").alias("_raw"),
        F.octet_length(T.squeeze_html("html")).cast("long").alias("_small"),
    )
    summed = sized.groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("_raw").alias("raw_bytes"), F.sum("_small").alias("squeezed_bytes")
    )
    return summed.withColumn(
        "saved_pct", F.try_divide(100.0 * (F.col("raw_bytes") - F.col("squeezed_bytes")), F.col("raw_bytes"))
    )


def url_params(pages: DataFrame) -> DataFrame:
    """Query parameters, percent-decoded, counted per host, key and value."""
    query = F.regexp_extract("url", r"\?([^#]*)", 1)
    pair = F.explode(F.split(query, "&")).alias("_pair")
    pairs = pages.select(host_of().alias("host"), pair).where("_pair <> ''")
    parts = F.split("_pair", "=", 2)
    return (
        pairs.select(
            "host",
            F.try_url_decode(parts[0]).alias("param"),
            F.try_url_decode(F.coalesce(F.get(parts, F.lit(1)), F.lit(""))).alias("value"),
        ).groupBy("host", "param", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def json_verdict(df: DataFrame, column: str) -> DataFrame:
    """Adds ``json_ok``: whether the column parses as JSON."""
    return df.withColumn("json_ok", F.try_parse_json(column).isNotNull())


def json_audit(df: DataFrame, column: str, by: tuple[str, ...]) -> DataFrame:
    checked = json_verdict(df, column)
    return checked.groupBy(*by).agg(
        F.count(F.when(F.col("json_ok"), 1)).alias("valid"), F.count(F.when(~F.col("json_ok"), 1)).alias("invalid")
    )


def json_quarantine(df: DataFrame, column: str) -> DataFrame:
    return json_verdict(df, column).where(~F.col("json_ok")).drop("json_ok")


def readability(docs: DataFrame) -> DataFrame:
    """Flesch reading ease and grade level per document."""
    counted = docs.select(
        "doc_id",
        T.word_count("text").alias("words"),
        T.sentence_count("text").alias("sentences"),
        T.syllables("text").alias("syllables"),
    )
    per_sentence = F.try_divide(F.col("words").cast("double"), F.col("sentences").cast("double"))
    per_word = F.try_divide(F.col("syllables").cast("double"), F.col("words").cast("double"))
    return counted.select(
        "*",
        (206.835 - 1.015 * per_sentence - 84.6 * per_word).alias("ease"),
        (0.39 * per_sentence + 11.8 * per_word - 15.59).alias("grade"),
    )


def hardest_sentences(docs: DataFrame, worst: int = 3) -> DataFrame:
    """The ``worst`` sentences with the most words per document; earlier ones win ties."""
    sentences = docs.select("doc_id", F.posexplode(T.sentence_pieces("text")).alias("_pos", "_s"))
    sized = sentences.select("doc_id", "_pos", T.word_count("_s").alias("words"))
    w = Window.partitionBy("doc_id").orderBy(F.desc("words"), "_pos")
    return (
        sized.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= worst)
        .select("doc_id", F.col("_rank").cast("long").alias("place"), F.col("_pos").cast("long").alias("sentence_no"), "words")
    )


# Hashes gathered into one at each level of the tree.
FAN_IN = 256


def set_fingerprint(df: DataFrame, name: Column, text: Column, by: tuple[str, ...] = (), levels: int = 8) -> DataFrame:
    """One SHA-256 for a set of named texts, whatever the row order.

    A tree over the hashes' own digits: rows that share the first ``levels`` hex digits are hashed together, then the
    nodes that share two digits fewer, up to the root. Above the leaves no node has more than FAN_IN children; a leaf
    holds the rows of one of 16^levels prefixes, a handful for billions of uniquely named rows.
    """
    entry = F.concat(name.cast("string"), F.lit(":"), F.sha2(text, 256))
    rows = df.select(*by, F.sha2(entry, 256).alias("_h")).withColumn("_p", F.substring("_h", 1, levels)).withColumn("_n", F.lit(1).cast("long"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_p", "_h"))), lambda s: s["_h"]), "")
    for digits in range(levels, -1, -2):
        rows = rows.groupBy(*by, F.substring("_p", 1, digits).alias("_p2")).agg(F.sha2(joined, 256).alias("_h"), F.sum("_n").alias("_n")).withColumnRenamed("_p2", "_p")
    return rows.select(*by, F.col("_h").alias("fingerprint"), F.col("_n").alias("texts"))


def version_drift(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Names whose text changed while the version stayed the same.

    Both sides: (name, version, hash).
    """
    p, c = previous.alias("p"), current.alias("c")
    return (
        p.join(c, F.col("p.name") == F.col("c.name"))
        .where((F.col("p.hash") != F.col("c.hash")) & (F.col("p.version") == F.col("c.version")))
        .select("c.name", "c.version", F.col("p.hash").alias("old_hash"), F.col("c.hash").alias("new_hash"))
    )
