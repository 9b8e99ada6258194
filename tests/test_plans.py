"""Physical plans: what must reach the scan and what must not appear."""

import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from rowsmith import dims, session
from rowsmith.operators import clean, corpus, lines, lookup, money
from rowsmith.plans.registry import table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, sf):
    items = table(spark, sf, "lineitem").where("l_quantity >= 48").select("l_partkey")
    text = plan(items)
    assert "GreaterThanOrEqual(l_quantity,48.0)" in text
    assert re.search(r"ReadSchema: struct<l_partkey:bigint,l_quantity:double>", text)


def test_only_needed_columns_are_read(spark, sf):
    text = plan(corpus.top_words(table(spark, sf, "documents"), 5))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_group_limits_come_before_the_shuffle(spark, sf):
    assert "WindowGroupLimit" in plan(corpus.top_words(table(spark, sf, "documents"), 5, ("source",)))
    assert "TakeOrderedAndProject" in plan(corpus.top_words(table(spark, sf, "documents"), 5, ()))


def test_corpus_dedup_combines_before_the_shuffle(spark, sf):
    rows = lines.explode_lines(table(spark, sf, "documents"))
    text = plan(lines.dedup(rows, by=()))
    assert "partial_min_by" in text and "Window" not in text


def test_a_small_lookup_is_broadcast_and_a_big_one_is_not(spark):
    df = spark.createDataFrame([(100.0, "INR", "JPY")], "amount double, f string, t string")
    small = lookup.convert_currency(df, "amount", "f", "t", dims.rates(spark))
    assert plan(small).count("BroadcastHashJoin") == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = lookup.convert_currency(df, "amount", "f", "t", dims.rates(spark))
        assert "BroadcastHashJoin" not in plan(big) and plan(big).count("SortMergeJoin") == 2
        assert big.first().converted == small.first().converted
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_allocation_is_one_shuffle(spark, sf):
    items = table(spark, sf, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("long")).withColumn("amount", F.lit(1000))
    text = plan(money.allocate(items, "amount", "l_quantity", ["l_orderkey"], ["l_linenumber", "l_partkey"]))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("FileScan") == 1


def test_match_starts_need_no_shuffle(spark, sf):
    assert "Exchange" not in plan(clean.regex_matches(table(spark, sf, "documents"), "[0-9]+"))


def test_scratch_goes_with_the_application(spark):
    path = session.scratch_path(spark, "x")
    assert spark.sparkContext.applicationId in path and path != session.scratch_path(spark, "x")


def test_scratch_is_the_shared_folder_when_one_is_named(spark):
    def cluster(folder):
        context = SimpleNamespace(master="yarn", applicationId="app-1")
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=context)

    assert session.scratch_dir(cluster("s3://shared/tmp/")) == "s3://shared/tmp"
    with pytest.raises(ValueError):
        session.scratch_dir(cluster(None))
    assert session.scratch_dir(spark) == session.scratch_dir(spark)
