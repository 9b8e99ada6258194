"""Containment search against all pairs, the sketch bound, corner cases."""

import random
import re

import pytest

from rowsmith.llm import decontaminate, queries


def grams(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(docs, items):
    out = {}
    for i, t in items:
        want = grams(t)
        for d, text in docs:
            share = len(want & grams(text)) / max(1, len(want))
            if want and share >= 0.8 - 1e-9:
                out[d, i] = max(out.get((d, i), 0), share)
    return sorted((d, i, s) for (d, i), s in out.items())


@pytest.mark.parametrize("block", [1_000_000, 40])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_ROWS", block)
    rng = random.Random(23)
    vocab = [f"w{i}" for i in range(900)]
    made = lambda k: [rng.choice(vocab) for _ in range(k)]
    items = [(i, " ".join(made(rng.randrange(3, 60)))) for i in range(30)]
    docs = []
    for d in range(60):
        text = made(rng.randrange(0, 500))
        for i in rng.sample(range(30), 2):
            passage = items[i][1].upper().split()
            for _ in range(rng.randrange(0, 3)):
                passage[rng.randrange(len(passage))] = rng.choice(vocab)
            if rng.random() < 0.6:
                text += passage + made(rng.randrange(0, 50))
        docs.append((d, ", ".join(text)))
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.containment) for r in decontaminate.find(d, i).collect())
    right = brute(docs, items)
    assert got == right and len(right) > 20
    left = {r.doc_id for r in decontaminate.drop_leaks(d, i).collect()}
    assert left == {k for k, _ in docs} - {k for k, _, _ in right}


def test_corner_cases(spark):
    item = "one two three four five six"
    docs = [(1, None), (2, ""), (3, item), (3, item), (None, "x " + item), (4, "z " * 50_000 + item), (5, "one two three four")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "text as item", "1 as need", "2 as hash", "3 as words", "4 as _leaked")
    i = spark.createDataFrame([(1, item), (1, item + " seven"), (2, "one two three four"), (3, None), (None, item.title())], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.containment) for r in decontaminate.find(d, i).collect()), key=str)
    assert got == sorted([(k, m, 1.0) for k in (3, None, 4) for m in (1, None)], key=str)
    kept = decontaminate.drop_leaks(d, i)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 5]
    assert decontaminate.find(d, i.where("false")).count() == 0 and decontaminate.find(d.where("false"), i).count() == 0
    assert decontaminate.drop_leaks(d, i.where("item_id = 3")).count() == 7


def test_a_clean_row_is_not_dropped_for_another_rows_text(spark):
    item = "one two three four five six"
    docs = [(None, "x " + item), (None, "clean and without an id"), (7, item), (7, "clean under a shared id"), (8, None), (8, item)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = sorted(((r.doc_id, r.text) for r in decontaminate.drop_leaks(d, i).collect()), key=str)
    assert kept == sorted([(None, "clean and without an id"), (7, "clean under a shared id"), (8, None)], key=str)


def test_plan(spark, sf):
    plan = queries.QUERIES["op1_decontamination"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
