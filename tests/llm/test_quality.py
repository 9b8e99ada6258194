"""Quality figures against plain Python; line rules; corner cases."""

import random
import re

from pyspark.sql import functions as F

import pytest

from rowsmith.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def figures(text):
    text = text or ""
    words = WORD.findall(text)
    wins = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for i, w in enumerate(wins):
        seen.setdefault(w, []).append(i)
    covered = {i + k for places in seen.values() if len(places) > 1 for i in places for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def result(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    rows = quality.judge(df).select("doc_id", *[f"quality.{n}" for n in names], "quality.kept").orderBy("doc_id").collect()
    return [tuple(r)[1:] for r in rows]


def test_figures_against_python(spark):
    rng = random.Random(8)
    pieces = ["a", "b", "the", "é𝔘", " ", "  ", "\n", "\t", "\r\n", " ", "#", "|x", "%%", "\x0b", "\x1c"]
    texts = ["".join(rng.choice(pieces) + rng.choice(["", " "]) for _ in range(rng.randrange(0, 120))) for _ in range(150)]
    texts += [None, "", " \n ", "a b c a b c", "x " * 40_000, " ".join(rng.choice("abcdefgh") * 2 for _ in range(600)), " ".join(f"w{i}" for i in range(70)) + " w1 w2 w3 w4"]
    assert [r[:6] for r in result(spark, texts)] == [figures(t) for t in texts]


def test_line_rules(spark):
    prose = "The river runs past the old mill and down to the sea."
    lines = [
        (prose, True), ("Home", False), ("Home | About | Contact us", False), ("Read more.", False), ("All Rights Reserved.", False), ("WIN!! BIG!! NOW!!", False),
        ("costs $$$ and&&& more%%% of### it***.", False), ("He said \"no.\"  ", True), ("Quand? ", True), ("word " * 80, True), ("a | b", False),
    ]
    df = spark.createDataFrame(lines, "line string, good boolean")
    assert df.where(quality.line_passes(F.col("line")) != F.col("good")).collect() == []


def test_verdict_and_cleaned_text(spark):
    prose = "\n".join(" ".join(f"{w}{i}" for w in "a line of words that stand in no other line here".split()) + "." for i in range(6))
    menu = "Home | News | Shop | Help | Mail | Maps"
    menus = "".join(f"\nHome{k} | News{k} | Shop{k} | Help{k} | Mail{k} | Maps{k}" for k in range(30))
    rows = [(1, prose + "\n" + menu + "\n\nThe end is near.", 9, "x"), (2, prose + menus, 9, "x"), (3, "short.", 9, "x"), (4, None, 9, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, quality string").withColumn("_quality", F.lit(1))
    kept = quality.clean(df)
    assert kept.columns == df.columns
    assert [(r.doc_id, r.text, r.n_chars, r.quality) for r in kept.collect()] == [(1, prose + "\n\nThe end is near.", len(prose) + 18, "x")]
    assert quality.clean(df.where("false")).count() == 0


def test_no_shuffle_and_no_python(spark):
    df = quality.judge(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_cleaning_judges_a_text_once(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    mark = quality.BOILERPLATE
    plans = [df._jdf.queryExecution().optimizedPlan().toString().count(mark) for df in (quality.judge(docs), quality.clean(docs))]
    assert plans[0] == plans[1] >= 1


def test_a_column_of_the_results_name_is_refused(spark):
    with pytest.raises(ValueError, match="already has a column"):
        quality.judge(spark.createDataFrame([("t", 1)], "text string, quality int"))
