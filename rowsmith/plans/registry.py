"""Where the runnable queries register themselves, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from rowsmith.functions import text as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tidy(df: DataFrame) -> DataFrame:
    """One plain type per kind of value, so results compare across engines."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (ST.IntegerType, ST.ShortType, ST.ByteType)):
            c = c.cast("long")
        elif isinstance(kind, ST.DecimalType):
            c = c.cast("double")
        elif isinstance(kind, ST.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (ST.TimestampType, ST.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(field.name))
    return df.select(*out)


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    """Round through eight decimals first, so the last bits of a float sum cannot tip a tie."""
    return df.withColumns({c: F.round(F.col(c).cast("decimal(30,8)"), places).cast("double") for c in columns})


def _round_same_way(sql: str) -> str:
    """Write every round(x, n) of the checking SQL the way ``rounded`` does it."""
    at = sql.find("round(")
    if at < 0:
        return sql
    depth, comma, end = 0, None, at + 5
    for end in range(at + 5, len(sql)):
        depth += (sql[end] == "(") - (sql[end] == ")")
        if depth == 1 and sql[end] == ",":
            comma = end
        if depth == 0:
            break
    if comma is None:
        return sql[: at + 6] + _round_same_way(sql[at + 6 :])
    inner, places = _round_same_way(sql[at + 6 : comma]), sql[comma + 1 : end]
    return f"{sql[:at]}CAST(ROUND(CAST({inner} AS DECIMAL(30,8)),{places}) AS DOUBLE)" + _round_same_way(sql[end + 1 :])


# Shared pieces of the checking SQL; @NAME@ is replaced by the value.
PIECES = {
    "WS": T.WS,
    "NON_WS": T.NON_WS,
    "SPACE_LIKE": T.SPACE_LIKE,
    "ZERO_WIDTH": T.ZERO_WIDTH,
    "INVISIBLE": T.INVISIBLE,
    "STOP": ", ".join(f"'{w}'" for w in T.STOP_WORDS),
    "NUMBER": T.NUMBER,
}
PIECES["LINES"] = """lines AS (
  SELECT doc_id, lang, source, unnest(l) AS line, unnest(range(len(l))) AS line_no
  FROM (SELECT doc_id, lang, source, string_split(text, chr(10)) AS l FROM documents WHERE text <> ''))"""
PIECES["PASTED"] = """pasted AS (
  SELECT doc_id, lang, source, replace(replace(replace(text,
      '. ', CASE WHEN doc_id % 2 = 0 THEN '.' || chr(13) || chr(10) ELSE '.' || chr(10) || chr(10) || chr(10) || '  ' || chr(10) END),
      ', ', ',' || chr(160)), ' de ', chr(9) || chr(8203) || 'de  ') AS text
  FROM documents)"""
PIECES["KEY"] = "lower(regexp_replace(line, '^@WS@+|@WS@+$', '', 'g'))"
PIECES["NATURAL"] = """array_to_string(list_transform(
    string_split(regexp_replace(lower(line), '0*(\\d+)', chr(1) || '\\1' || chr(2), 'g'), chr(1)),
    lambda p: CASE WHEN contains(p, chr(2))
      THEN lpad(CAST(strpos(p, chr(2)) - 1 AS VARCHAR), 10, '0') || replace(p, chr(2), '') ELSE p END), '')"""
PIECES["MARKED_SENTENCES"] = "regexp_replace(text, '[.!?]+(@WS@|$)', chr(10) || '\\1', 'g')"
PIECES["WORDS"] = "len(list_filter(regexp_split_to_array(text, '@WS@+'), lambda p: regexp_matches(p, '[\\p{L}\\p{N}]')))"
PIECES["SENTENCE_LIST"] = "list_filter(regexp_split_to_array(@MARKED_SENTENCES@, '\\n+'), lambda p: regexp_matches(p, '@NON_WS@'))"


def fill(sql: str) -> str:
    while "@" in sql:
        before = sql
        for name, value in PIECES.items():
            sql = sql.replace(f"@{name}@", value)
        if sql == before:
            break
    return _round_same_way(sql)


def query(name: str, sql: str | None = None):
    """Register a (spark, sf_dir) function under ``name`` with its checking SQL."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            # The SQL side reads every time stamp as UTC.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return tidy(fn(spark, sf))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = fill(sql)
        return fn

    return register


def pasted(spark: SparkSession, sf: str) -> DataFrame:
    """The documents as if pasted from a word processor: CRLF or blank runs, NBSP, zero-width, tabs."""
    brk = F.when(F.col("doc_id") % 2 == 0, ".\r\n").otherwise(".\n\n\n  \n")
    text = F.replace(F.col("text"), F.lit(". "), brk)
    text = F.replace(text, F.lit(", "), F.lit(",\u00a0"))
    text = F.replace(text, F.lit(" de "), F.lit("\t\u200bde  "))
    return table(spark, sf, "documents").select("doc_id", "lang", "source", text.alias("text"))
