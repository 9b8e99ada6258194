"""Queries that write given tables in another format to the shared folder and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.functions import text as T
from rowsmith.operators import audit, clean, lines, ordered
from rowsmith.plans.lookups import HISTORY_SQL, rates_history
from rowsmith.plans.registry import query, table
from rowsmith.session import scratch_path
from rowsmith.sources import readers, writers


def _fresh(spark, label: str) -> str:
    return scratch_path(spark, label)


@query("read_csv_table", """SELECT doc_id, lang, md5('"' || text || '", x') AS text_md5 FROM documents""")
def _(spark, sf):
    path = _fresh(spark, "csv")
    quoted = F.concat(F.lit('"'), F.col("text"), F.lit('", x'))
    writers.write_csv(table(spark, sf, "documents").select("doc_id", "lang", quoted.alias("text")), path)
    back = readers.read_csv_table(spark, path, "doc_id BIGINT, lang STRING, text STRING")
    return back.select("doc_id", "lang", F.md5("text").alias("text_md5"))


# A file of text lines, some with a word for a number, a cell too few, a cell too many or a quote that is never closed.
_CSV_LINES = """l AS (SELECT doc_id, CASE WHEN doc_id % 13 = 5 THEN 'word' WHEN doc_id % 7 = 3 THEN 'few' WHEN doc_id % 5 = 2 THEN 'many' WHEN doc_id % 11 = 1 THEN 'quote' ELSE 'good' END AS kind,
  lang, n_chars FROM documents),
w AS (SELECT doc_id, lang, n_chars, kind, CASE kind WHEN 'word' THEN doc_id || ',' || lang || ',n/a' WHEN 'few' THEN doc_id || ',' || lang WHEN 'many' THEN doc_id || ',' || lang || ',' || n_chars || ',x'
  WHEN 'quote' THEN doc_id || ',"' || lang || ',' || n_chars ELSE doc_id || ',"' || lang || ', ""' || doc_id || '""' || '",' || n_chars END AS record FROM l)"""


@query("csv_quarantine", "WITH " + _CSV_LINES + """
SELECT kind = 'good' AS good, CASE WHEN kind = 'good' THEN doc_id END AS doc_id, CASE WHEN kind = 'good' THEN lang || ', "' || doc_id || '"' END AS lang,
  CASE WHEN kind = 'good' THEN n_chars END AS n_chars, CASE WHEN kind <> 'good' THEN record END AS record FROM w""")
def _(spark, sf):
    d, cell = F.col("doc_id"), lambda *parts: F.concat(*[F.lit(p) if p in (",", ',"', ",n/a", ",x", ', ""', '""",') else F.col(p).cast("string") for p in parts])
    line = (
        F.when(d % 13 == 5, cell("doc_id", ",", "lang", ",n/a")).when(d % 7 == 3, cell("doc_id", ",", "lang")).when(d % 5 == 2, cell("doc_id", ",", "lang", ",", "n_chars", ",x"))
        .when(d % 11 == 1, cell("doc_id", ',"', "lang", ",", "n_chars")).otherwise(cell("doc_id", ',"', "lang", ', ""', "doc_id", '""",', "n_chars"))
    )
    path = _fresh(spark, "csv")
    table(spark, sf, "documents").select(line.alias("value")).write.text(path)
    rows, quarantine = readers.read_csv_checked(spark, path, "doc_id BIGINT, lang STRING, n_chars BIGINT", header=False, multi_line=False)
    rows = rows.select(F.lit(True).alias("good"), "doc_id", "lang", "n_chars", F.lit(None).cast("string").alias("record"))
    return rows.unionByName(quarantine.select(F.lit(False).alias("good"), "record"), allowMissingColumns=True)


# One file per brand, each an array of records; sizes are numbers or text, and not every record has every field.
@query("read_json_array", """SELECT p_partkey AS id, p_name AS what_name, CASE WHEN p_partkey % 3 = 0 THEN p_size END AS what_box_size,
  CASE WHEN p_partkey % 2 = 0 THEN '"' || p_size || '"' ELSE CAST(p_size AS VARCHAR) END AS size, CASE WHEN p_partkey % 4 = 1 THEN '["' || p_brand || '",' || p_size || ']' END AS tags FROM part""")
def _(spark, sf):
    p = F.col("p_partkey")
    box = F.when(p % 3 == 0, F.struct(F.col("p_size").alias("size")))
    common = [F.col("p_partkey").alias("id"), F.struct(F.col("p_name").alias("name"), box.alias("box")).alias("what")]
    number = F.to_json(F.struct(*common, F.col("p_size").alias("size")))
    text = F.to_json(F.struct(*common, F.col("p_size").cast("string").alias("size")))
    # The tags hold a text and a number, so they are put in by hand.
    tags = F.concat(F.lit(',"tags":["'), "p_brand", F.lit('",'), F.col("p_size").cast("string"), F.lit("]}"))
    record = F.when(p % 2 == 0, text).otherwise(number)
    record = F.when(p % 4 == 1, F.concat(F.substring(record, F.lit(1), F.length(record) - 1), tags)).otherwise(record)
    path = _fresh(spark, "arrays")
    arrays = table(spark, sf, "part").groupBy("p_brand").agg(F.concat(F.lit("["), F.array_join(F.collect_list(record), ","), F.lit("]")).alias("value"))
    arrays.repartition("p_brand").write.partitionBy("p_brand").text(path)
    return readers.flatten_variant(readers.read_json_array(spark, f"{path}/*/*.txt"), sep="_")


@query("flatten_json", """SELECT c_custkey AS id, c_name AS who_name, n_name AS who_home_nation, n_regionkey AS who_home_region, '["' || c_mktsegment || '","' || n_name || '"]' AS tags
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _(spark, sf):
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    joined = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    home = F.struct(F.col("n_name").alias("nation"), F.col("n_regionkey").alias("region"))
    nested = joined.select(
        F.col("c_custkey").alias("id"), F.struct(F.col("c_name").alias("name"), home.alias("home")).alias("who"),
        F.array("c_mktsegment", "n_name").alias("tags"),
    )
    path = _fresh(spark, "json")
    nested.write.json(path)
    schema = "id BIGINT, who STRUCT<name: STRING, home: STRUCT<nation: STRING, region: BIGINT>>, tags ARRAY<STRING>"
    return readers.flatten(spark.read.schema(schema).json(path), sep="_")


@query("read_catalog", "SELECT 'p-' || CAST(p_partkey AS VARCHAR) AS slug, p_name AS name, p_type AS category, len(string_split(p_name, ' ')) AS n_keywords, p_size >= 40 AS popular FROM part")
def _(spark, sf):
    path = _fresh(spark, "catalog")
    table(spark, sf, "part").select(
        F.concat(F.lit("p-"), F.col("p_partkey").cast("string")).alias("slug"), F.col("p_name").alias("name"), F.col("p_brand").alias("desc"),
        F.col("p_type").alias("category"), F.split("p_name", " ").alias("keywords"), (F.col("p_size") >= 40).alias("popular"),
    ).write.json(path)
    return readers.read_catalog(spark, path).select("slug", "name", "category", F.size("keywords").alias("n_keywords"), "popular")


@query("read_sitemap", "SELECT url || '&a=1' AS loc, 'monthly' AS changefreq, page_id % 10 / 10.0e0 AS priority FROM pages")
def _(spark, sf):
    path = _fresh(spark, "sitemap")
    url = F.concat("url", F.lit("&a=1"))
    writers.write_sitemap(
        table(spark, sf, "pages").select(url.alias("loc"), F.lit("monthly").alias("changefreq"), (F.col("page_id") % 10 / 10.0).alias("priority")), path
    )
    return readers.read_sitemap(spark, path)


def snapshots(spark, sf):
    """The rate history as one snapshot per day, a map of thirty currencies each."""
    per_day = rates_history(spark, sf).groupBy(F.col("rate_date").alias("date")).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("currency", "rate")))).alias("rates")
    )
    per_day = per_day.withColumn("rates", F.map_filter("rates", lambda c, r: c != "EUR"))
    return per_day.select("date", F.lit("EUR").alias("base"), "rates")


@query("read_rates", f"WITH {HISTORY_SQL} SELECT CAST(rate_date AS VARCHAR) AS rate_date, currency, CASE currency WHEN 'EUR' THEN 1 ELSE rate END AS rate FROM hist")
def _(spark, sf):
    path = _fresh(spark, "rates")
    writers.write_rate_snapshots(snapshots(spark, sf), path)
    return readers.read_rates(spark, path, whole=False)


@query("rates_validity", f"""WITH {HISTORY_SQL}, d AS (SELECT DISTINCT rate_date AS date FROM hist),
x AS (SELECT CAST(date AS VARCHAR) AS date, unnest([CASE WHEN month(date) = 2 THEN 'wrong base' END, CASE WHEN month(date) = 3 THEN 'too few currencies' END, CASE WHEN month(date) IN (3, 4) THEN 'no USD' END,
  CASE WHEN month(date) = 3 THEN 'no INR' END, CASE WHEN month(date) = 5 THEN 'a code is not three capitals' END, CASE WHEN month(date) = 6 THEN 'a rate is not above zero' END,
  CASE WHEN month(date) = 7 THEN 'extra fields' END]) AS detail FROM d)
SELECT date, 'rates' AS rule, 'error' AS severity, detail FROM x WHERE detail IS NOT NULL""")
def _(spark, sf):
    month = F.month("date")
    broken = snapshots(spark, sf).withColumn("base", F.when(month == 2, "USD").otherwise(F.col("base")))
    r = F.when(month == 3, F.map_filter("rates", lambda c, v: c < "H")).when(month == 4, F.map_filter("rates", lambda c, v: c != "USD"))
    r = r.when(month == 5, F.transform_keys("rates", lambda c, v: F.when(c == "SEK", "Sek").otherwise(c)))
    r = r.when(month == 6, F.transform_values("rates", lambda c, v: F.when(c == "SEK", 0.0).otherwise(v)))
    broken = broken.withColumn("rates", r.otherwise(F.col("rates")))
    raw = F.to_json(F.struct(F.col("date").cast("string").alias("date"), "base", "rates", F.when(month == 7, "x").alias("note")))
    return audit.rates_findings(broken.withColumn("raw", raw))


# January is written a second time with doubled rates: only its dates change.
@query("upsert_snapshot", f"""WITH {HISTORY_SQL} SELECT CAST(rate_date AS VARCHAR) AS rate_date, currency, CASE WHEN month(rate_date) = 1 THEN rate * 2 ELSE rate END AS rate FROM hist""")
def _(spark, sf):
    path = _fresh(spark, "upsert")
    history = rates_history(spark, sf)
    writers.append_rates(history, path)
    writers.append_rates(history.where(F.month("rate_date") == 1).withColumn("rate", F.col("rate") * 2), path)
    return readers.read_rate_history(spark, path)


# The order is the point: a line's place in its file, after the files whose names come before. Lines that differ in case
# only are ordered by doc_id and line number, so every place is settled.
@query("write_lines", """WITH @LINES@, k AS (SELECT line, @NATURAL@ AS key, doc_id, line_no FROM lines)
SELECT line, CAST(row_number() OVER (ORDER BY key, doc_id, line_no) AS BIGINT) AS place FROM k""")
def _(spark, sf):
    path = _fresh(spark, "lines")
    rows = lines.explode_lines(table(spark, sf, "documents"))
    writers.write_lines(rows, path, [T.natural_key("line"), F.col("doc_id"), F.col("line_no")])
    back = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.split("value", "\n").alias("all"))
    # A file ends in a line break, so the last piece is empty. One count per file goes before.
    held = back.select("file", F.slice("all", 1, F.size("all") - 1).alias("all"), (F.size("all") - 1).cast("long").alias("n"))
    files = ordered.scan(held.select("file", "n"), [], [F.col("file")], running={"upto": "n"})
    placed = held.drop("n").join(files, "file").select((F.col("upto") - F.col("n")).alias("base"), F.posexplode("all").alias("at", "line"))
    return placed.select("line", (F.col("base") + F.col("at") + 1).alias("place"))


@query("read_pages", "SELECT page_id, url, length(html) AS chars, octet_length(encode(html)) AS bytes FROM pages")
def _(spark, sf):
    return readers.read_pages(spark, f"{sf}/pages.parquet").select("page_id", "url", F.length("html").alias("chars"), F.octet_length("html").alias("bytes"))


@query("read_files_binary", "SELECT n_nationkey, CAST(length(n_name) + 1 AS BIGINT) AS length, sha256(n_name || chr(10)) AS digest FROM nation")
def _(spark, sf):
    path = _fresh(spark, "nations")
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("value"))
    nation.repartition("n_nationkey").write.partitionBy("n_nationkey").text(path)
    files = readers.read_files(spark, f"{path}/*/*.txt")
    key = F.regexp_extract("path", "n_nationkey=([0-9]+)", 1).cast("long")
    return files.select(key.alias("n_nationkey"), "length", clean.digest(F.col("content")).alias("digest"))
