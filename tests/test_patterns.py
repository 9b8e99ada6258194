"""The pattern test: known safe and unsafe patterns, and a brute-force count of ways on small alphabets."""

import itertools
import random

import pytest

from rowsmith.functions import patterns
from rowsmith.operators import clean

SAFE = [
    r"(\w+)ing (\w+)", r"[0-9]+", r"(?<letter>[a-z])\1", r"(\w+) (the|les|der)\b", r"(a+b)+", r"(ab|cd)*", r"(a|b)*c", r"\d{1,3}(,\d{3})*(\.\d+)?", r"a.*b.*c",
    r"(?:[a-z]+\s)*x", r"^\s+|\s+$", r"(?i)hello|world", r"[^,]*,[^,]*,[^,]*,y", r"\p{L}+\p{N}+", r"\Qa*b\E+", r"(foo|bar)+?z", r"[\w.+-]+@[\w-]+\.[a-z]{2,6}", r"(x{2,3}y)*",
    r"\x41+b", r"[[a-z]&&[^aeiou]]+q", r"a{3}b{2,}", r"",
]
EXPONENTIAL = [
    r"(a+)+$", r"((a|b)+c?)+$", r"(a*)*b", r"(a|a)*b", r"(a|ab|b)*c", r"(\w+\s?)*x", r"([a-z]+|\w)+!", r"(.*)*x", r"(a?a)+b", r"(?:x+x+)+y", r"(\d+|[0-9]{2})*z", r"(?=(a+)+b)a",
    r"(a{1,2}){5,}b", r"(?i)(a|A)*b", r"((ab)*)*c", r"(é|É|\p{L})+1",
]
POLYNOMIAL = [r"\d*\d*\d*x", r"(.*,)(.*,)(.*,)y", r"a*(b|a)*a*c", r".*.*.*=", r"\s*\w*\s*[\w\s]*\s*;"]


@pytest.mark.parametrize("pattern", SAFE)
def test_safe(pattern):
    assert patterns.slow_on_some_text(pattern) is None


@pytest.mark.parametrize("pattern", EXPONENTIAL)
def test_exponential(pattern):
    assert patterns.slow_on_some_text(pattern) == "exponential"


@pytest.mark.parametrize("pattern", POLYNOMIAL)
def test_polynomial(pattern):
    assert patterns.slow_on_some_text(pattern) == "polynomial"


def ways(automaton, word):
    """How many paths through the positions read the word, by start: the most of any start and end."""
    best = 0
    for start in range(len(automaton.reads)):
        here = {start: 1}
        for c in word:
            step = {}
            for at, n in here.items():
                for nxt in automaton.after.get(at, ()):
                    if c in automaton.reads[nxt]:
                        step[nxt] = step.get(nxt, 0) + n * automaton.ways[at, nxt]
            here = step
        best = max(best, here.get(start, 0))
    return best


def test_random_patterns_against_counted_ways():
    rng = random.Random(11)

    def made(depth):
        if depth == 0:
            return rng.choice(["a", "b", "[ab]"])
        inner = made(depth - 1)
        return rng.choice([inner + made(depth - 1), f"(?:{inner}|{made(depth - 1)})", f"(?:{inner})*", f"(?:{inner})+", f"(?:{inner})?", inner])

    seen = set()
    for _ in range(400):
        pattern = made(3)
        try:
            automaton = patterns.automata(pattern)[0]
        except patterns.NotJudged:
            continue
        if len(automaton.reads) > 7:
            continue
        # Two ways from a position back to itself on one short text are what "exponential" means.
        twice = any(ways(automaton, w) > 1 for n in range(1, 7) for w in itertools.product("ab", repeat=n))
        assert automaton.exponential() == twice, pattern
        seen.add(twice)
    assert seen == {True, False}


def test_refused_patterns_are_findings(spark):
    assert clean.pattern_problem(spark, r"(.*,)(.*,)(.*,)y") == "more than two repetitions behind one another can take the same text"
    assert clean.pattern_problem(spark, r"(a|b|ab)*c") == "a repeated group holds alternatives that can begin alike"
    assert clean.pattern_problem(spark, r"(a+b)+") is None and clean.pattern_problem(spark, "[a") is not None
    with pytest.raises(ValueError, match="same text"):
        clean.regex_matches(spark.createDataFrame([(1, "x")], "doc_id int, text string"), r"\d*\d*\d*x")
