"""Queries that draw, shuffle, copy and make up rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.operators import sampling
from rowsmith.plans.registry import query, table


@query("seeded_draw", "SELECT c_custkey, sha256('diwali:' || CAST(c_custkey AS VARCHAR)) AS ticket FROM customer ORDER BY ticket, c_custkey LIMIT 10")
def _(spark, sf):
    return sampling.draw(table(spark, sf, "customer").select("c_custkey"), "c_custkey", "diwali", 10)


@query("seeded_shuffle", "SELECT o_orderkey, row_number() OVER (ORDER BY sha256('s7:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS place FROM orders")
def _(spark, sf):
    return sampling.shuffle(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", "s7").select("o_orderkey", "place")


def _walk(start: str, n: int, salt: str, key: str) -> str:
    """The permutation once more, step by step: ``start`` gives (key, i) rows, the result is (key, i, x)."""
    bits = max(2, (n - 1).bit_length())
    right, left = bits // 2, bits - bits // 2
    hashed = f"CAST(('0x' || substr(sha256({salt} || ':' || CAST(round AS VARCHAR) || ':' || CAST(r AS VARCHAR)), 1, 12)) AS BIGINT)"
    value = f"((l << {right}) | r)"
    return f"""s AS ({start}),
walk AS (
  SELECT {key}, i, CAST(0 AS BIGINT) AS round, i >> {right} AS l, i & {(1 << right) - 1} AS r, false AS done FROM s
  UNION ALL
  SELECT {key}, i, round2, CASE WHEN round2 = 0 THEN v >> {right} ELSE l2 END, CASE WHEN round2 = 0 THEN v & {(1 << right) - 1} ELSE r2 END, round2 = 0 AND v < {n}
  FROM (SELECT {key}, i, (round + 1) % 4 AS round2, r AS l2, xor(l, {hashed} & CASE WHEN round % 2 = 0 THEN {(1 << left) - 1} ELSE {(1 << right) - 1} END) AS r2,
    (r << {right}) | xor(l, {hashed} & CASE WHEN round % 2 = 0 THEN {(1 << left) - 1} ELSE {(1 << right) - 1} END) AS v FROM walk WHERE NOT done)),
x AS (SELECT {key}, i, {value} AS x FROM walk WHERE done)"""


_FAR = 10**15


# As many different numbers of a range of 1e15 as there are customers; the range itself is never listed.
@query("sample_range", "WITH RECURSIVE " + _walk("SELECT CAST(0 AS BIGINT) AS k, unnest(range(0, count(*))) AS i FROM customer", _FAR, "'r1'", "k")
       + " SELECT i + 1 AS draw_no, x + 7 AS value FROM x")
def _(spark, sf):
    return sampling.sample_range(spark, 7, 6 + _FAR, table(spark, sf, "customer").count(), False, "r1")


@query("different_per_row", "WITH RECURSIVE " + _walk("SELECT c_custkey AS k, unnest(range(0, 6)) AS i FROM customer", 49, "'lotto:' || CAST(k AS VARCHAR)", "k")
       + " SELECT k AS c_custkey, i + 1 AS draw_no, x + 1 AS value FROM x")
def _(spark, sf):
    return sampling.different_per_row(table(spark, sf, "customer"), "c_custkey", 6, 1, 49, "lotto")


def _pick(n: int, key: str) -> str:
    return f"CAST('0x' || substr(sha256({key}), 1, 15) AS BIGINT) % {n}"


@query("draws_per_row", f"""SELECT c_custkey, d AS draw_no, {_pick(90, "'lotto:' || CAST(c_custkey AS VARCHAR) || ':' || CAST(d AS VARCHAR)")} + 1 AS value FROM customer, range(1, 4) t(d)""")
def _(spark, sf):
    return sampling.draws_per_row(table(spark, sf, "customer"), "c_custkey", 3, 1, 90, "lotto")


@query("replicate_rows", """SELECT doc_id, c AS copy_no, md5(CAST(c AS VARCHAR) || '. ' || text) AS text_md5 FROM documents, range(1, 4) t(c)""")
def _(spark, sf):
    out = sampling.replicate(table(spark, sf, "documents").select("doc_id", "text"), 3, number=True)
    return out.select("doc_id", "copy_no", F.md5("text").alias("text_md5"))


@query("repeat_text", """SELECT item_id, length(t) AS chars, md5(t) AS text_md5 FROM (SELECT item_id, '1. ' || text || ' | 2. ' || text || ' | 3. ' || text || ' | 4. ' || text || ' | ' AS t FROM benchmark)""")
def _(spark, sf):
    t = sampling.repeat_text(F.col("text"), 4, " | ", number=True, trailing=True)
    return table(spark, sf, "benchmark").select("item_id", t.alias("t")).select("item_id", F.length("t").alias("chars"), F.md5("t").alias("text_md5"))


_WORDS = "[" + ", ".join(f"'{w}'" for w in sampling.PLACEHOLDER_WORDS) + "]"


@query("synthetic_corpus", f"""WITH d AS (SELECT doc_id, 'cicero:' || CAST(doc_id AS VARCHAR) || ':' AS k FROM documents),
p AS (SELECT doc_id, k, unnest(range(0, {_pick(4, "k || 'p'")} + 3)) AS no FROM d),
s AS (SELECT doc_id, no, k || CAST(no AS VARCHAR) || ':' AS k FROM p),
n AS (SELECT *, {_pick(11, "k || 'n'")} + 8 AS n, {_pick(1000003, "k || 'c'")} AS c FROM s),
t AS (SELECT doc_id, no, array_to_string(list_transform(range(0, n), lambda i: {_WORDS}[{_pick(len(sampling.PLACEHOLDER_WORDS), "k || CAST(i AS VARCHAR)")} + 1]
  || CASE WHEN n > 11 AND i = c % greatest(n - 6, 1) + 3 THEN ',' ELSE '' END), ' ') AS x FROM n)
SELECT doc_id, CASE WHEN doc_id = 0 THEN '{sampling.OPENER}. ' ELSE '' END || string_agg(upper(x[1]) || x[2:] || '.', ' ' ORDER BY no) AS text FROM t GROUP BY doc_id""")
def _(spark, sf):
    return sampling.placeholder_text(table(spark, sf, "documents"), "doc_id", "cicero", classic=True)
