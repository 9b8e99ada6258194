"""Line de-duplication against all pairs."""

import random

from rowsmith.llm import linededup


def near(a, b):
    """Whether two different strings are one edit apart."""
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows):
    first, lines = {}, []
    for d, t in rows:
        for no, line in enumerate((t or "").split("\n")):
            line = line.strip(" \t\n\v\f\r")
            if line:
                lines.append((d, no, line))
                first[line] = min(first.get(line, (d, no)), (d, no))
    out = []
    for d, no, line in lines:
        partners = [f for other, f in first.items() if min(len(line), len(other)) >= 20 and f < first[line] and near(line, other)]
        if partners or (d, no) != first[line]:
            out.append((d, no, *(min(partners) if partners else first[line]), int(bool(partners))))
    return sorted(out)


def made(rng):
    alphabet = "abcé𝔘 "
    bases = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(18, 45))) for _ in range(25)]

    def line():
        x = list(rng.choice(bases))
        for _ in range(rng.choice((0, 0, 1, 1, 2))):
            at = rng.randrange(len(x))
            x[at : at + rng.randrange(2)] = rng.choice(("", "z", "y"))
        return "".join(x)

    return [(d, "\n".join(line() for _ in range(rng.randrange(0, 12)))) for d in range(60)]


def test_against_all_pairs(spark):
    for seed in (1, 2):
        rows = made(random.Random(seed))
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = sorted(tuple(r) for r in linededup.duplicates(df).collect())
        right = brute(rows)
        assert got == right and sum(r[4] for r in right) > 20


def test_neighbourhood_hashes_agree_with_the_strings():
    text = "abcabc𝔘é"
    keys, places = linededup.neighbourhood(text)
    spelled = [text] + [text[:i] + text[i + 1 :] for i in range(len(text))]
    again = [linededup.neighbourhood(s)[0][0] for s in spelled]
    assert keys.tolist() == again and places.tolist() == list(range(-1, len(text)))


def test_corner_cases(spark):
    long = "q" * 90_000
    rows = [(1, None), (2, ""), (3, "short\nshort\n \n "), (4, long), (5, long + "q"), (6, "  short "), (None, "Short"), (7, "shart")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as no", "text as line", "2 as h")
    got = sorted(tuple(r) for r in linededup.duplicates(df).collect())
    assert got == [(3, 1, 3, 0, 0), (5, 0, 4, 0, 1), (6, 0, 3, 0, 0)]
    assert linededup.duplicates(df.where("false")).count() == 0
    cut = {r.doc_id: r.text for r in linededup.drop_lines(df).collect()}
    assert linededup.drop_lines(df).columns == df.columns and cut[3] == "short\n \n " and cut[5] == "" and cut[1] is None and cut[7] == "shart"
