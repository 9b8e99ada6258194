"""Fill-in-the-middle: against an iterative version, exact round trips, and corner cases."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from rowsmith.llm import fim


def by_steps(doc_id, text, seed=7, share=100, spm_share=50):
    """The contract word for word, unit by unit."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= share:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < spm_share:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def rows():
    rng = random.Random(3)
    alphabet = ["a", "é", "漢", "😀", " ", "\n", "\n\n", "\r\n", "<", "P>", " ", "\x85"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 60))) for _ in range(400)]
    texts += [None, "", "\n", "\n\n\n", "one", "one\n", "has <P> in it\nand more", "<S>", "x<M>", "<P", "tail<\n", ">\n<"]
    out = [(k, t) for k, t in enumerate(texts)]
    return out + [(5, texts[5]), (None, "no id\nat all\n"), (None, "no id\nat all\n"), (10**12, "line\n" * 50_000 + "x" * 3_000_000)]


@pytest.mark.parametrize("share,spm_share", [(100, 50), (40, 0), (0, 50)])
def test_against_steps_and_back(spark, share, spm_share):
    given = rows()
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    made = fim.transform(df, share=share, spm_share=spm_share).withColumn("back", fim.restore(F.col("fim.output"), F.col("fim.form")))
    got = sorted(((r.doc_id, r.text, *r.fim) for r in made.collect()), key=repr)
    assert got == sorted(((d, t, *by_steps(d, t, share=share, spm_share=spm_share)) for d, t in given), key=repr)
    assert made.where(F.col("back") != F.coalesce("text", F.lit(""))).count() == 0


def test_every_repetition_is_kept():
    assert fim.regex.fullmatch(f"({fim.LINES})*+", "a\n\nb").ends(1) == [2, 3, 4]


def test_other_columns_pass_and_a_clash_is_refused(spark):
    df = spark.createDataFrame([("e", 1, "a\nb\n", "f")], "form string, doc_id long, text string, _row string")
    assert fim.transform(df).columns == ["form", "doc_id", "text", "_row", "fim"]
    with pytest.raises(ValueError, match="already has a column"):
        fim.transform(df, into="FORM")
    with pytest.raises(ValueError, match="empty text"):
        fim.transform(df, unit="a*")


def test_empty_table_and_own_units(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert fim.transform(df).count() == 0
    one = spark.createDataFrame([(4, "to be or not"), (5, "?!")], "doc_id long, text string")
    by_word = {r.doc_id: r.fim for r in fim.transform(one, unit=r"\w+ ?").collect()}
    assert by_word[4].n == 4 and by_word[5].form == "plain" and by_word[5].output == "?!"
