"""Spans against the plain patterns, checksums, context, corner cases."""

import hashlib
import random
import re
import time

from rowsmith.llm import pii, queries

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def digits(s):
    return re.sub(r"[^0-9]", "", s)


def luhn(s):
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(s)))
    return total % 10 == 0


GOOD = {
    "email": lambda s: True,
    "ip": lambda s: all(int(p) <= 255 for p in s.split(".")),
    "card": lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s)),
    "phone": lambda s: 9 <= len(digits(s)) <= 15,
}


def base(text):
    found = [(m.start(), k, m.end()) for k, kind in enumerate(PLAIN) for m in PLAIN[kind].finditer(text) if GOOD[kind](m.group())]
    kinds = list(PLAIN)
    return [(kinds[k], a, b) for a, k, b in sorted(found)]


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(11)
    bits = ["a", "b@", "@", ".", "-", "+", " ", "1", "22", "255.", "256", "4539 1488 0343 6467", "+1 (555) 010-9999", "x.y", "_", "%", "é", "(", ")", "10.0.0.1", "..", "00012", "\n"]
    for _ in range(6000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 18)))
        assert [s[:3] for s in pii.scan(text) if s[0] in pii.BASE_KINDS] == base(text), text


def test_checksummed_kinds_and_context():
    kinds = lambda t: [(s[0], t[s[1] : s[2]]) for s in pii.scan(t) if s[0] in ("iban", "ssn")]
    assert kinds("IBAN: GB82 WEST 1234 5698 7654 32 THE END") == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert kinds("pay DE89370400440532013000.") == [("iban", "DE89370400440532013000")]
    assert kinds("GB83 WEST 1234 5698 7654 32") == [] and kinds("ZZ82 WEST 1234") == []
    assert kinds("ssn 078-05-1120") == [("ssn", "078-05-1120")] and kinds("part 078-05-1120") == []
    score = lambda t: pii.scan(t)[0][3]
    assert score("phone +1 555 010 9999") > score("x +1 555 010 9999")


def test_scans_are_linear():
    texts = ["a" * 200_000, "1" * 200_000, "1." * 100_000, "a." * 100_000 + "@", "@" * 100_000, "+1" + " 2" * 90_000, "AB12" * 50_000, "1 " * 100_000]
    started = time.process_time()
    for text in texts:
        pii.scan(text)
    assert time.process_time() - started < 10


def test_query_columns(spark, sf, tmp_path):
    text = "Mail bob@example.org or call +1 (555) 010-9999; host 10.0.0.300 and 10.0.0.3, card 4539 1488 0343 6467."
    rows = [(1, text, "s"), (1, text, "s"), (2, None, "s"), (None, "", "s"), (3, "x" * 100_000, "s")]
    spark.createDataFrame(rows, "doc_id long, text string, spans string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op2_pii"](spark, str(tmp_path)).orderBy("doc_id").collect()
    spelled = ",".join(f"{k}:{a}:{b}" for k, a, b in base(text))
    assert [tuple(r)[:7] for r in got if r.doc_id == 1] == [(1, 1, 1, 1, 1, hashlib.sha256(spelled.encode()).hexdigest(), spelled)] * 2
    assert [tuple(r)[1:5] for r in got if r.doc_id != 1] == [(0, 0, 0, 0)] * 3
    assert pii.find_spans(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_the_table_against_the_patterns(spark, sf):
    texts = dict(tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    for r in queries.QUERIES["op2_pii"](spark, sf).collect():
        right = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in right).encode()).hexdigest()
        assert r.n_email + r.n_ip + r.n_card + r.n_phone == len(right)
