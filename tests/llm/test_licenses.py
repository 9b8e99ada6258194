"""Phrases and template containment against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from rowsmith.llm import licenses, mixing, pii, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def places(ws):
    return sorted(
        (i, label) for label, phrase in licenses.PHRASES.items() for i in range(len(ws)) if tuple(ws[i : i + len(phrase)]) == phrase
    )


def grams(ws):
    return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)}


def brute(text):
    ws = words(text)
    found, mine = places(ws), grams(ws)
    labels, best = {label for _, label in found}, 0.0
    for label, template in licenses.TEMPLATES:
        want = grams(words(template))
        share = len(want & mine) / len(want)
        if share >= 0.8 - 1e-9:
            labels.add(label)
            best = max(best, share)
    starts = [i for i, _ in found]
    return (
        len(ws), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found})),
        ",".join(sorted(labels)), 1.0 if found else best,
    )


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = licenses.scan(df).select("doc_id", "license.*").collect()
    key = lambda r: str(r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(((d, *brute(t)) for d, t in rows), key=key)


def test_against_python(spark):
    rng = random.Random(13)
    filler = ["river", "mit", "license", "Apache", "LICENSE", "general", "Public", "public", "é", "x1", "Kit", "MİT", "-", "license\n"]
    rows = []
    for d in range(80):
        parts = [rng.choice(filler) for _ in range(rng.randrange(0, 40))]
        if d % 3 == 0:
            _, template = rng.choice(licenses.TEMPLATES)
            cut = template.split()
            for _ in range(rng.randrange(0, 3)):
                cut[rng.randrange(len(cut))] = "changed"
            parts += cut
        rows.append((d, " ".join(parts)))
    rows += [(5, None), (5, ""), (None, "Released under the MIT License"), (7, "MIT License mit license"), (7, "MIT License mit license"), (8, "w " * 60_000 + "Apache License")]
    check(spark, rows)


def test_the_table_against_python(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in queries.QUERIES["op3_licenses"](spark, sf).collect())
    assert got == sorted((d, *brute(t)) for d, t in rows)


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "under the mit license", 2, "y")], "doc_id long, text string, need int, tokens string")
    assert licenses.scan(df).columns == [*df.columns, "license"] and licenses.scan(df).count() == 1
    assert licenses.scan(df.where("false")).count() == 0


def test_no_python_in_the_plan(spark, sf):
    plan = queries.QUERIES["op3_licenses"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("made,name", [
    (lambda df: licenses.scan(df), "license"), (lambda df: pii.find_spans(df), "spans"), (lambda df: mixing.mix(df, F.length("text")), "MIX"),
])
def test_a_column_of_the_results_name_is_refused(spark, made, name):
    df = spark.createDataFrame([(1, "t", "s", "x")], f"doc_id long, text string, source string, {name} string")
    with pytest.raises(ValueError, match="already has a column"):
        made(df)
