"""Readers. Schemas are stated; only records of unknown shape are read as VARIANT and looked through once."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from rowsmith.session import materialise

CATALOG = "slug STRING, name STRING, desc STRING, category STRING, keywords ARRAY<STRING>, popular BOOLEAN"
RATES = "date DATE, base STRING, rates MAP<STRING, DOUBLE>"
RATE_HISTORY = "rate_date DATE, currency STRING, rate DOUBLE, rate_month STRING"
SITEMAP = "loc STRING, changefreq STRING, priority DOUBLE"


def read_documents(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """Parquet documents, or text files with one row per file (per line with ``whole=False``)."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    return spark.read.text(path, wholetext=whole).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


def read_csv_table(spark: SparkSession, path: str, schema: str, header: bool = True, multi_line: bool = True) -> DataFrame:
    """CSV whose cells may hold commas, doubled quotes and line breaks; a cell that does not parse is NULL.

    Without line breaks in cells (``multi_line=False``) a large file is read by many tasks.
    """
    return spark.read.schema(schema).csv(path, header=header, multiLine=multi_line, quote='"', escape='"')


def read_csv_checked(spark: SparkSession, path: str, schema: str, header: bool = True, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine): the records that parse, and the others as (file, record).

    A record goes to quarantine if a cell is not of its column's type, if cells are missing or left over, or if a quote is
    never closed; the two tables add up to the records of the files.
    """
    stated = ST.StructType.fromDDL(schema)
    bad = "_corrupt_record"
    while bad in stated.names:
        bad += "_"
    names = [f"`{name}`" for name in stated.names]
    read = spark.read.schema(ST.StructType([*stated.fields, ST.StructField(bad, ST.StringType())])).option("columnNameOfCorruptRecord", bad)
    found = read.csv(path, header=header, multiLine=multi_line, quote='"', escape='"')
    # Written once with all its columns: a parser that is asked for some of them only would not see what is wrong in others.
    found = materialise(found.select(F.struct(*names).alias("row"), F.col("_metadata.file_path").alias("file"), F.col(bad).alias("record")), "csv")
    return found.where("record is null").select("row.*"), found.where("record is not null").select("file", "record")


def read_json_array(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Files holding a JSON array of records (or one record), one row per record.

    Without a schema each record is one VARIANT column ``record``, so records of any shape are read in one pass.
    """
    if schema is not None:
        return spark.read.schema(schema).json(path, multiLine=True)
    whole = spark.read.option("singleVariantColumn", "record").json(path, multiLine=True)
    listed = F.try_variant_get("record", "$", "array<variant>")
    return whole.select(F.explode(F.coalesce(listed, F.array("record"))).alias("record"))


def variant_schema(df: DataFrame, column: str = "record") -> str:
    """The fields of all records together, found in one aggregate; a field of several types is a VARIANT."""
    found = df.agg(F.schema_of_variant_agg(column)).first()[0]
    if not found.startswith("OBJECT<"):
        raise ValueError(f"the records are no objects: {found}")
    # Fixed names: how the schema of a VARIANT says a nested record and a field that is always null.
    return re.sub(r"\bVOID\b", "STRING", re.sub(r"\bOBJECT<", "STRUCT<", found))


def flatten_variant(df: DataFrame, column: str = "record", sep: str = ".", schema: str | None = None) -> DataFrame:
    """VARIANT records as flat columns; fields of several types and arrays as JSON text, missing fields NULL."""
    kind = schema or variant_schema(df, column)
    return flatten(df.select(F.try_variant_get(column, "$", kind).alias("_r")).select("_r.*"), sep)


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested records as flat columns (a.b); arrays, maps and fields of several types as JSON text."""

    def walk(fields, path):
        for field in fields:
            here = [*path, field.name]
            column = F.col(".".join(f"`{p}`" for p in here))
            kind = field.dataType.typeName()
            if kind == "struct":
                yield from walk(field.dataType.fields, here)
            elif kind in ("array", "map", "variant"):
                yield F.to_json(column).alias(sep.join(here))
            else:
                yield column.alias(sep.join(here))

    return df.select(*walk(df.schema.fields, []))


def read_rate_snapshots(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """(date, base, rates): the JSON object of each file, or of each line with ``whole=False``;
    a comment and an assignment may surround it."""
    body = F.regexp_extract("value", r"(?s)(\{.*\})", 1)
    return spark.read.text(path, wholetext=whole).select(F.from_json(body, RATES).alias("r")).select("r.*")


def read_rates(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """(rate_date, currency, rate), with the base itself at 1."""
    snapshots = read_rate_snapshots(spark, path, whole)
    with_base = F.map_concat("rates", F.create_map(F.col("base"), F.lit(1.0)))
    return snapshots.select(F.col("date").alias("rate_date"), F.explode(with_base).alias("currency", "rate"))


def read_rate_history(spark: SparkSession, path: str) -> DataFrame:
    """What ``writers.append_rates`` keeps: (rate_date, currency, rate)."""
    return spark.read.schema(RATE_HISTORY).parquet(path).select("rate_date", "currency", "rate")


def read_catalog(spark: SparkSession, path: str, array_file: bool = False) -> DataFrame:
    """Catalogue rows, one JSON record per line or (``array_file``) one array per file."""
    return spark.read.schema(CATALOG).json(path, multiLine=array_file)


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SITEMAP).option("rowTag", "url").xml(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Parquet pages, or a folder of HTML files; files starting with "_" are templates."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    files = spark.read.text(path, wholetext=True, pathGlobFilter="[!_]*.html")
    return files.select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as bytes: (path, length, content)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", "content")
