"""One query per operator over its whole table, with the checking SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.llm import chosenpath, compact, decontaminate, fim, licenses, linededup, mixing, ngramjoin, pii, quality, resample, suffixes, tokens
from rowsmith.llm.common import documents, space_word_count, text_of
from rowsmith.llm.registry import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES"]


OP1_SQL = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{M}\\p{N}]+') AS words FROM documents),
have AS (SELECT DISTINCT doc_id, array_to_string(words[i:i+4], ' ') AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
iw AS (
  SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{M}\\p{N}]+') AS words FROM benchmark),
want AS (SELECT DISTINCT item_id, array_to_string(words[i:i+4], ' ') AS g FROM (SELECT item_id, words, unnest(range(1, len(words) - 3)) AS i FROM iw)),
m AS (SELECT item_id, count(*) AS n_item_shingles FROM want GROUP BY item_id)
SELECT doc_id, item_id, n_item_shingles, count(*) AS n_shared, count(*) / n_item_shingles AS containment
FROM have JOIN want USING (g) JOIN m USING (item_id) GROUP BY doc_id, item_id, n_item_shingles
HAVING count(*) >= ceil(n_item_shingles * 0.8)"""


@query("op1_decontamination", OP1_SQL)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


@query("op2_pii")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find_spans(documents(spark, sf).select("doc_id", "text"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def spelled(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select(
        "doc_id", *[count(kind) for kind in pii.BASE_KINDS], F.sha2(spelled(base), 256).alias("base_sha256"),
        spelled(F.col("spans")).alias("spans"), F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("top_score"),
    )


@query("op3_licenses")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(documents(spark, sf).select("doc_id", "text")).select("doc_id", "license.*")


def _line_rule() -> str:
    """The line rules once more, in SQL."""
    spaces = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    ends = quality.LINE_ENDS.replace("'", "''")

    def count(pattern: str) -> str:
        return f"(length(l) - length(regexp_replace(l, '{pattern}', '', 'g')))"

    return f"""((contains('{ends}', right(rtrim(l, {spaces}), 1)) OR length(l) >= {quality.PARAGRAPH_CHARS})
      AND NOT ({count(quality.SEPARATORS)} >= 2 AND length(l) <= {quality.ITEM_CHARS} * ({count(quality.SEPARATORS)} + 1))
      AND NOT (length(l) <= {quality.BOILERPLATE_CHARS} AND regexp_matches(lower(l), '{quality.BOILERPLATE}'))
      AND NOT ({count(quality.MARKS)} * 2 > length(l) - length(replace(l, ' ', '')) + 1))"""


OP4_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
windows AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(3) AS s(k) GROUP BY r),
j AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    coalesce(list_sum(list_transform(list_filter(lines, lambda l: {_line_rule()}), lambda l: length(l))), 0) AS good,
    coalesce(list_sum(list_transform(lines, lambda l: length(l))), 0) AS whole
  FROM w LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND good * 100 >= whole * {quality.MIN_KEPT_PERCENT} AS kept
FROM j"""


@query("op4_quality", OP4_SQL)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality.judge(documents(spark, sf).select("doc_id", "text")).select("doc_id", *[f"quality.{n}" for n in names])


OP7_SQL = """
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    CAST(('0x' || md5('7:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:12]) AS BIGINT) AS ticket FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM s),
v AS (SELECT *, CAST(CASE (k - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS weight,
  CAST(source_size AS DOUBLE) * 2 AS cap, (SELECT sum(source_size) FROM s) * CAST(1.5 AS DOUBLE) AS wanted FROM n),
l AS (SELECT *, (wanted - coalesce(sum(cap) OVER (ORDER BY cap / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY cap / weight, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM v),
t AS (SELECT source, source_size, least(cap, (SELECT first(level ORDER BY cap / weight, k) FROM l WHERE cap > level * weight) * weight) AS target FROM l),
e AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(size * (whole + CASE WHEN sum(size) OVER (PARTITION BY source ORDER BY ticket, doc_id, size
  ROWS UNBOUNDED PRECEDING) - size / CAST(2 AS DOUBLE) <= target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM e"""


@query("op7_mixing", OP7_SQL)
def op7(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    sized = docs.select("doc_id", "source", space_word_count(text_of(docs)).alias("n"))
    mixed = mixing.mix(sized, F.col("n"))
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", (F.col("mix.size") * F.col("mix.repeats")).alias("taken"))


def public_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op5_tokens")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.read(tokens.write(documents(spark, sf), public_tokenizer(), end_id=0))


@query("op10_ngram_jaccard")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return ngramjoin.join(documents(spark, sf))


OP6_SQL = """
WITH l AS (
  SELECT doc_id, unnest(range(len(s))) AS no, trim(unnest(s), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)),
o AS (SELECT line, min((doc_id, no)) AS f FROM l WHERE line <> '' GROUP BY line),
p AS (
  SELECT a.line, min(b.f) AS partner FROM o a JOIN o b ON length(b.line) BETWEEN length(a.line) - 1 AND length(a.line) + 1 AND b.f < a.f
  WHERE length(a.line) >= 20 AND length(b.line) >= 20 AND levenshtein(a.line, b.line) = 1 GROUP BY a.line)
SELECT doc_id, no AS line_no, coalesce(partner, f)[1] AS kept_doc_id, coalesce(partner, f)[2] AS kept_line_no,
  CAST(CASE WHEN partner IS NULL THEN 0 ELSE 1 END AS BIGINT) AS distance
FROM l JOIN o USING (line) LEFT JOIN p USING (line) WHERE partner IS NOT NULL OR (doc_id, no) <> f"""


@query("op6_line_dedup", OP6_SQL)
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return linededup.duplicates(documents(spark, sf))


@query("op9_suffix_array")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return suffixes.passages(documents(spark, sf))


@query("op8_compact_windows")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return compact.passages(documents(spark, sf))


OP11_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i+3], ' ') AS g
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS inter FROM g a JOIN g b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY u, v),
links AS (
  SELECT u, v FROM shared JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * inter >= 80 * (a.n + b.n - inter)),
reach AS (SELECT doc_id AS u, doc_id AS v FROM w UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(v) AS component_id, w.doc_id = min(v) AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN reach ON u = w.doc_id GROUP BY w.doc_id"""


@query("op11_chosen_path", OP11_SQL)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return chosenpath.components(documents(spark, sf))


@query("op12_resampling")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    drawn = resample.resample(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))
    return drawn.select("doc_id", "draw.*")


OP13_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x,
    regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u FROM documents),
h AS (
  SELECT doc_id, text, u, len(u) AS n, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT *, array_to_string(u[1:lo], '') AS prefix, array_to_string(u[lo + 1:hi], '') AS middle, array_to_string(u[hi + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p"""


@query("op13_fill_in_middle", OP13_SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    cut = fim.transform(documents(spark, sf).select("doc_id", "text"))
    return cut.select(
        "doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars", F.sha2("fim.output", 256).alias("output_sha256"),
        F.sha2(fim.restore(F.col("fim.output"), F.col("fim.form")), 256).alias("restored_sha256"),
    )
