"""Edge texts, and brute force in plain Python for what SQL cannot say."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from rowsmith.functions import text as T
from rowsmith.operators import clean, corpus, lines, search


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def one(spark, column_of, text):
    return docs(spark, text).select(column_of(F.col("text")).alias("v")).first().v


def split(spark, text):
    return [r.line for r in lines.explode_lines(docs(spark, text)).orderBy("line_no").collect()]


def test_lines(spark):
    assert split(spark, "a\r\nb\rc") == ["a", "b", "c"]
    assert split(spark, "") == []
    assert split(spark, "a\n\n") == ["a", "", ""]


@pytest.mark.parametrize("keep,kept", [("first", ["Apple", "pear"]), ("last", ["APPLE", "pear"]), ("unique", ["pear"])])
def test_dedup(spark, keep, kept):
    rows = lines.explode_lines(docs(spark, "Apple\n apple \nAPPLE\npear"))
    assert [r.line for r in lines.dedup(rows, keep).orderBy("line_no").collect()] == kept


def test_dedup_is_idempotent_and_counts_match(spark):
    rows = lines.explode_lines(docs(spark, "a\nb\nA\nb ", "c\na\n\nc"))
    once = lines.dedup(rows, by=()).drop("copies")
    assert sorted(lines.dedup(once, by=()).drop("copies").collect()) == sorted(once.collect())
    stats = lines.dedup_stats(rows).first()
    assert stats.lines_kept == once.count() and stats.lines_kept + stats.duplicates == stats.lines_in == 8
    strict = lines.dedup_stats(rows, ignore_case=False, trim=False).first()
    assert strict.lines_kept == 6


def test_reserved_words_are_ordinary_lines(spark):
    rows = lines.explode_lines(docs(spark, "constructor\nx"))
    assert lines.dedup(rows).count() == 2


def test_invisible(spark):
    text = "a\u00a0b\u200bc\ufeff"
    assert one(spark, T.normalise_whitespace, text) == "a bc"
    found = corpus.invisible_audit(docs(spark, text).withColumn("source", F.lit("s"))).collect()
    assert sum(r.n for r in found) == 3 and {r.code_point for r in found} == {0xA0, 0x200B, 0xFEFF}
    assert {r.code_point for r in found if r.zero_width} == {0x200B, 0xFEFF}


def test_whitespace_options(spark):
    text = " a\t\tb  \n \n  c"
    assert one(spark, T.normalise_whitespace, text) == "a b\n\nc"
    assert one(spark, lambda c: T.normalise_whitespace(c, blank_lines=True), text) == "a b\nc"
    assert one(spark, lambda c: T.normalise_whitespace(c, drop_all=True), text) == "ab\n\nc"
    assert one(spark, lambda c: T.normalise_whitespace(c, tabs=False, collapse=False, trim_lines=False), text) == text


def test_blank_runs_and_hyphens(spark):
    assert one(spark, T.collapse_blank_runs, "a\n\n\n\nb") == "a\n\nb"
    assert one(spark, T.paragraph_count, "a\n\n\n\nb") == 2
    assert one(spark, lambda c: T.unwrap_lines(c, dehyphen=True), "infor-\nmation\nis\n \nhere") == "information is\n\nhere"
    assert one(spark, lambda c: T.unwrap_lines(c, sep=", ", keep_paragraphs=False), "a\n\n b \nc") == "a, b, c"


def test_natural_sort(spark):
    rows = lines.explode_lines(docs(spark, "item10\nitem2\nItem1\nitem02"))
    az = [r.line for r in lines.sort_lines(rows, "az").collect()]
    assert az == ["Item1", "item2", "item02", "item10"]
    assert [r.line for r in lines.sort_lines(rows, "za").collect()] == az[::-1]


def test_number_sort(spark):
    rows = lines.explode_lines(docs(spark, "no number\n12.5 kg\n-3 C\n1,00,000\n1,000"))
    up = [r.line for r in lines.sort_lines(rows, "num-asc").collect()]
    assert up == ["-3 C", "12.5 kg", "1,000", "1,00,000", "no number"]
    assert [r.line for r in lines.sort_lines(rows, "num-desc").collect()] == ["1,00,000", "1,000", "12.5 kg", "-3 C", "no number"]


def test_counts(spark):
    row = corpus.doc_stats(docs(spark, "A 3.14 b. C! D")).first()
    assert (row.sentences, row.words, row.reading) == (3, 5, "<1m")
    empty = corpus.doc_stats(docs(spark, "")).first()
    assert (empty.words, empty.sentences, empty.paragraphs, empty.reading) == (0, 0, 0, "0m")
    assert one(spark, T.word_count, "-- a - ... b2 —") == 2


def test_word_count_against_python(spark):
    samples = ["x  y", " lead and trail ", "a-b c_d !!", "\u00e9\u00a0\u00e0 東京 ok", "1 2\t3\n4", "...a ..b.. c..."]
    for text in samples:
        pieces = [p for p in re.split(r"[\s\ufeff]+", text) if any(ch.isalnum() for ch in p)]
        assert one(spark, T.word_count, text) == len(pieces), text


def test_top_words(spark):
    rows = corpus.top_words(docs(spark, "The cat, the CAT and dog's dog's ox cat bat"), 2).orderBy("place").collect()
    assert [(r.word, r.n) for r in rows] == [("cat", 3), ("dog's", 2)]


def test_find_and_replace(spark):
    def run(text, *args, **options):
        row = clean.find_replace(docs(spark, text), *args, **options).first()
        return row.text, row.hits

    assert run("cost 5 or 5", "5", "$5") == ("cost $5 or $5", 2)
    assert run("a.b aXb", "a.b", "\\1") == ("\\1 aXb", 1)
    assert run("Cat cat", "cat", "dog", case=True) == ("Cat dog", 1)
    assert run("నా నాది నా", "నా", "మా", word=True) == ("మా నాది మా", 2)
    assert run("ab12", r"([a-z]+)(\d+)", "$2$1", regex=True) == ("12ab", 1)
    assert run("été et", r"\bet\b", "x", regex=True) == ("été x", 1)
    assert run("abc", "", "x") == ("abc", 0)
    assert clean.pattern_problem(spark, "[a") and clean.pattern_problem(spark, "(a+)+$")
    assert clean.pattern_problem(spark, r"(\w+) the") is None


@pytest.mark.parametrize("pattern,groups", [(r"(\w)(\d)?", 2), (r"b*", 0), (r"ab", 0)])
def test_regex_matches_against_python(spark, pattern, groups):
    text = "a1 abb  ab9 xab"
    got = [(r.match_no, r.start, r.match) for r in clean.regex_matches(docs(spark, text), pattern, groups).orderBy("match_no").collect()]
    assert got == [(i, m.start(), m.group(0)) for i, m in enumerate(re.finditer(pattern, text))]
    assert clean.regex_matches(docs(spark, text), pattern, groups, limit=2).count() == 2


def test_case_styles(spark):
    assert one(spark, lambda c: T.recase(c, "snake"), "XMLHttpRequest") == "xml_http_request"
    assert one(spark, lambda c: T.recase(c, "snake"), "don't stop, NASA.") == "dont_stop_nasa"
    assert one(spark, lambda c: T.recase(c, "camel"), "user first-name") == "userFirstName"
    assert one(spark, lambda c: T.recase(c, "title"), "the end  of the\nroad to it of") == "The End  of The\nRoad to It Of"
    assert one(spark, lambda c: T.recase(c, "sentence"), "hELLO. wORLD!\nok") == "Hello. World!\nOk"
    assert one(spark, lambda c: T.recase(c, "alternate"), "Abc d1E") == "aBc D1e"


def test_slugs_are_unique(spark):
    df = spark.createDataFrame([(1, "Hello, World"), (2, "hello world!"), (3, "Ünïcode"), (4, "HELLO-world"), (5, "!!!")], "id int, title string")
    expected = ["hello-world", "hello-world-2", "unicode", "hello-world-3", "untitled"]
    for hot in (10, 0):
        assert [r.slug for r in clean.assign_slugs(df, "title", "id", hot).orderBy("id").collect()] == expected


def test_rewrite_longest_first(spark):
    rules = [("acme", "x"), ("https://acme.org", "https://y.net")]
    row = clean.bulk_rewrite(docs(spark, "see https://acme.org of acme"), rules).first()
    assert (row.text, row.edits, row.changed) == ("see https://y.net of x", 2, True)
    assert not clean.bulk_rewrite(docs(spark, "none"), rules).first().changed


def test_digests(spark):
    row = clean.content_hash(docs(spark, "abc"), algo="SHA-512").first()
    assert row.digest.startswith("ddaf35a193617aba") and not row.weak
    assert clean.content_hash(docs(spark, "abc"), algo="SHA-1", upper=True).first().digest == "A9993E364706816ABA3E25717850C26C9CD0D89D"


def test_diff(spark):
    key = lambda text: spark.createDataFrame([(1, text)], "id int, text string")
    row = lines.diff(key("a\nb\nb\nc d"), key("b\na\nx\nc  d"), ("id",)).first()
    assert (row.common, row.only_old, row.only_new, row.invisible_only) == (2, 2, 2, 1)
    states = {r.line: r.state for r in lines.diff_lines(key("a\nb\nb\nc d"), key("b\na\nx\nc  d"), ("id",)).collect()}
    assert states == {"a": "common", "b": "only old", "x": "only new", "c d": "looks the same", "c  d": "looks the same"}


def test_search_is_literal(spark):
    df = spark.createDataFrame([("100% cotton", "A"), ("100 cotton", "A"), ("100% wool", "B")], "name string, category string")
    assert search.keyword_search(df, ["name"], "100% ").count() == 2
    assert search.keyword_search(df, ["name"], "0_c").count() == 0
    assert search.keyword_search(df, ["name"], "  ", "All").count() == 3
    assert search.keyword_search(df, ["name"], "COTTON", "A").count() == 2


def test_html(spark):
    page = "<p>a &amp;lt; b</p><!-- x --><script>var t='<p>';</script><b>c</b>"
    assert one(spark, T.html_to_text, page) == "a &lt; b c"
    assert one(spark, T.escape_html, "<a href=\"x\">'&") == "&lt;a href=&quot;x&quot;&gt;&#39;&amp;"
    assert one(spark, T.squeeze_html, "<ul> <!-- c --> <li>a b</li>\n</ul>") == "<ul><li>a b</li></ul>"


def test_top_words_of_ids_that_repeat_or_are_null(spark):
    rows = [(1, "cat cat dog"), (1, "ant dog dog cat"), (2, "zebra ant ant zebra bee"), (None, "owl owl bat"), (None, "bat bat"), (3, None), (4, ""), (5, "the ox")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.place): (r.word, r.n) for r in corpus.top_words(df, 2).collect()}
    assert got == {(1, 1): ("cat", 3), (1, 2): ("dog", 3), (2, 1): ("zebra", 2), (2, 2): ("ant", 2), (None, 1): ("bat", 3), (None, 2): ("owl", 2)}


def test_words_of_a_text_of_its_own_are_not_shuffled(spark, sf):
    found = corpus.top_words(spark.read.parquet(f"{sf}/documents.parquet"), 5)
    assert found.count() and found.collect()
    final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # No group has several rows, so the side that tallies by shuffle has no input.
    assert "isFinalPlan=true" in final and "EmptyRelation" in final


def test_commonest_against_python(spark):
    rng = random.Random(8)
    lists = [[rng.choice("abcdefgh") for _ in range(n)] for n in (0, 1, 2, 5, 40, 300)]
    got = spark.createDataFrame([(x,) for x in [*lists, None]], "w array<string>").select(T.commonest(F.col("w"), 3).alias("c")).collect()
    assert got[-1].c is None and [[tuple(x) for x in r.c] for r in got[:-1]] == [collections.Counter(x).most_common(3) for x in lists]
