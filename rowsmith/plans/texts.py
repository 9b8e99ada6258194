"""Queries over documents and conversations: lines, words, cleaning, search."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.functions import text as T
from rowsmith.operators import clean, corpus, diffs, lines, rules, search
from rowsmith.plans.registry import pasted, query, rounded, table
from rowsmith.sources import readers


def _docs(spark, sf):
    return table(spark, sf, "documents")


def _lines(spark, sf, *keep):
    return lines.explode_lines(_docs(spark, sf), keep=("doc_id", *keep))


# Reading and splitting ------------------------------------------------------------


@query("read_documents", "SELECT doc_id, lang, source, length(text) AS chars, length(text) = n_chars AS as_stated FROM documents")
def _(spark, sf):
    return readers.read_documents(spark, f"{sf}/documents.parquet").select(
        "doc_id", "lang", "source", F.length("text").alias("chars"), (F.length("text") == F.col("n_chars")).alias("as_stated")
    )


@query("explode_lines", """WITH @PASTED@, t AS (
  SELECT doc_id, string_split(regexp_replace(text, '\\r\\n?', chr(10), 'g'), chr(10)) AS l FROM pasted WHERE text <> '')
SELECT doc_id, unnest(range(len(l))) AS line_no, unnest(l) AS line FROM t""")
def _(spark, sf):
    return lines.explode_lines(pasted(spark, sf))


@query("drop_blank_lines", """WITH @PASTED@, t AS (
  SELECT doc_id, string_split(regexp_replace(text, '\\r\\n?', chr(10), 'g'), chr(10)) AS l FROM pasted WHERE text <> ''),
x AS (SELECT doc_id, unnest(range(len(l))) AS line_no, unnest(l) AS line FROM t)
SELECT doc_id, line_no, line FROM x WHERE regexp_matches(line, '@NON_WS@')""")
def _(spark, sf):
    return lines.drop_blank(lines.explode_lines(pasted(spark, sf)))


@query("collapse_blank_lines", """WITH @PASTED@, t AS (SELECT doc_id, regexp_replace(text, '\\r\\n?', chr(10), 'g') AS b FROM pasted),
u AS (SELECT doc_id, b, regexp_replace(b, '\\n{3,}', chr(10) || chr(10), 'g') AS a FROM t)
SELECT doc_id, length(b) AS chars_before, length(a) AS chars_after, length(b) - length(a) AS chars_saved, md5(a) AS text_md5 FROM u""")
def _(spark, sf):
    out = clean.collapse_blank(pasted(spark, sf))
    return out.select("doc_id", "chars_before", "chars_after", "chars_saved", F.md5("text").alias("text_md5"))


# Duplicates -----------------------------------------------------------------------

_FIRST = """WITH @LINES@, k AS (SELECT *, @KEY@ AS key FROM lines),
r AS (SELECT *, row_number() OVER (PARTITION BY {scope}key ORDER BY doc_id{d}, line_no{d}) AS rn,
  count(*) OVER (PARTITION BY {scope}key) AS copies FROM k)
SELECT doc_id, line_no, line, copies FROM r WHERE {keep}"""


@query("line_dedup_first", _FIRST.format(scope="", d="", keep="rn = 1"))
def _(spark, sf):
    return lines.dedup(_lines(spark, sf), "first", by=())


@query("line_dedup_last", _FIRST.format(scope="", d=" DESC", keep="rn = 1"))
def _(spark, sf):
    return lines.dedup(_lines(spark, sf), "last", by=())


@query("line_unique_only", _FIRST.format(scope="", d="", keep="copies = 1"))
def _(spark, sf):
    return lines.dedup(_lines(spark, sf), "unique", by=())


@query("line_dedup_in_doc", _FIRST.format(scope="doc_id, ", d="", keep="rn = 1"))
def _(spark, sf):
    return lines.dedup(_lines(spark, sf), "first")


_STATS = """WITH @LINES@, k AS (SELECT *, @KEY@ AS key FROM lines)
SELECT {by}count(*) AS lines_in, count(DISTINCT key) AS lines_kept, count(*) - count(DISTINCT key) AS duplicates FROM k {group}"""


@query("dedup_stats", _STATS.format(by="", group=""))
def _(spark, sf):
    return lines.dedup_stats(_lines(spark, sf))


@query("dedup_stats_by_source", _STATS.format(by="source, ", group="GROUP BY source"))
def _(spark, sf):
    return lines.dedup_stats(_lines(spark, sf, "source"), by=("source",))


# Orders ---------------------------------------------------------------------------

_RANK = """WITH @LINES@, n AS (SELECT doc_id, line_no, line, @NATURAL@ AS nk,
  TRY_CAST(replace(regexp_extract(line, '@NUMBER@'), ',', '') AS DOUBLE) AS num, length(line) AS len FROM lines)
SELECT doc_id, line_no, line, row_number() OVER (PARTITION BY doc_id ORDER BY {order}) AS place FROM n"""

_ORDERS = {
    "az": "nk COLLATE icu_noaccent, line_no",
    "za": "nk COLLATE icu_noaccent DESC, line_no DESC",
    "num-asc": "num ASC NULLS LAST, line_no",
    "num-desc": "num DESC NULLS LAST, line_no",
    "len-asc": "len, nk COLLATE icu_noaccent, line_no",
    "len-desc": "len DESC, nk COLLATE icu_noaccent, line_no",
    "reverse": "line_no DESC",
}


def _register_order(order: str, sql_order: str) -> None:
    @query(f"sort_lines_{order.replace('-', '_')}", _RANK.format(order=sql_order))
    def _(spark, sf):
        return lines.rank_lines(_lines(spark, sf), order)


for _name, _sql in _ORDERS.items():
    _register_order(_name, _sql)


@query("top_k_lines", """WITH @LINES@, n AS (SELECT doc_id, line_no, line, @NATURAL@ AS nk FROM lines)
SELECT doc_id, line_no, line FROM n ORDER BY length(line) DESC, nk COLLATE icu_noaccent, doc_id, line_no LIMIT 20""")
def _(spark, sf):
    return lines.top_lines(_lines(spark, sf), "len-desc", 20)


@query("number_lines", """WITH @LINES@, n AS (SELECT doc_id, line_no, line, 10 + 5 * line_no AS num FROM lines)
SELECT doc_id, line_no, CASE WHEN length(CAST(num AS VARCHAR)) < 4 THEN lpad(CAST(num AS VARCHAR), 4, '0') ELSE CAST(num AS VARCHAR) END
  || ') ' || line AS numbered FROM n""")
def _(spark, sf):
    return lines.number_lines(_lines(spark, sf), 10, 5, ") ", 4).select("doc_id", "line_no", "numbered")


@query("number_corpus_lines", """WITH @LINES@
SELECT doc_id, line_no, row_number() OVER (ORDER BY doc_id, line_no) AS number,
  CAST(row_number() OVER (ORDER BY doc_id, line_no) AS VARCHAR) || '. ' || line AS numbered FROM lines""")
def _(spark, sf):
    return lines.number_corpus_lines(_docs(spark, sf)).select("doc_id", "line_no", "number", "numbered")


_TURNS = """pairs AS (
  SELECT conv_id, turn, text AS old, lead(turn) OVER w AS next_turn, lead(text) OVER w AS nxt
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
p AS (SELECT conv_id, turn, old, regexp_replace(nxt || chr(10) || replace(old, ' ', '  '), '\\r\\n?', chr(10), 'g') AS new
  FROM pairs WHERE next_turn = turn + 1),
l AS (SELECT conv_id, turn, unnest(string_split(old, chr(10))) AS line, 1 AS o, 0 AS n FROM p WHERE old <> ''
  UNION ALL SELECT conv_id, turn, unnest(string_split(new, chr(10))), 0, 1 FROM p WHERE new <> ''),
c AS (SELECT conv_id, turn, line, trim(regexp_replace(line, ' {2,}', ' ', 'g')) AS key, sum(o) AS o, sum(n) AS n FROM l GROUP BY ALL)"""


def _turns(spark, sf):
    """Every turn, and the next one followed by this one with doubled spaces, so some lines differ invisibly."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    nxt = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("_next"))
    both = turns.join(nxt, ["conv_id", "turn"]).withColumn(
        "_new", F.concat("_next", F.lit("\n"), F.replace("text", F.lit(" "), F.lit("  ")))
    )
    return both.select("conv_id", "turn", "text"), both.select("conv_id", "turn", F.col("_new").alias("text"))


@query("text_diff", f"""WITH {_TURNS},
k AS (SELECT conv_id, turn, key, sum(least(o, n)) AS b, sum(greatest(o - n, 0)) AS l, sum(greatest(n - o, 0)) AS r FROM c GROUP BY ALL)
SELECT conv_id, turn, CAST(sum(b) AS BIGINT) AS common, CAST(sum(l) AS BIGINT) AS only_old, CAST(sum(r) AS BIGINT) AS only_new,
  CAST(sum(least(l, r)) AS BIGINT) AS invisible_only FROM k GROUP BY ALL""")
def _(spark, sf):
    return lines.diff(*_turns(spark, sf), ("conv_id", "turn"))


@query("text_diff_lines", f"""WITH {_TURNS}, s AS (SELECT *, bool_or(o > n) OVER w AND bool_or(n > o) OVER w AS alike FROM c WINDOW w AS (PARTITION BY conv_id, turn, key))
SELECT conv_id, turn, line, CAST(o AS BIGINT) AS in_old, CAST(n AS BIGINT) AS in_new,
  CASE WHEN o = n THEN 'common' WHEN alike THEN 'looks the same' WHEN o > n THEN 'only old' ELSE 'only new' END AS state FROM s""")
def _(spark, sf):
    return lines.diff_lines(*_turns(spark, sf), ("conv_id", "turn"))


def _edited(spark, sf):
    """Documents and a later version of each: the first line goes to the end, every seventh goes, every eleventh is respaced."""
    docs = _docs(spark, sf).select("doc_id", "text")
    split = T.split_lines("text")
    kept = F.filter(F.transform(split, lambda l, i: F.when(i % 7 == 3, None).when(i % 11 == 5, F.replace(l, F.lit(" "), F.lit("  "))).otherwise(l)), lambda l: l.isNotNull())
    moved = F.when(F.size("l") > 0, F.concat(F.slice("l", 2, F.size("l")), F.slice("l", 1, 1))).otherwise(F.col("l"))
    return docs, docs.select("doc_id", kept.alias("l")).select("doc_id", F.array_join(moved, "\n").alias("text"))


# A patience diff has no SQL form: tests/test_diffs.py holds it against dynamic programming and by applying the hunks.
@query("text_diff_hunks")
def _(spark, sf):
    found = diffs.hunks(*_edited(spark, sf), ("doc_id",))
    return found.withColumns({c: F.array_join(c, "\n") for c in ("removed", "added")})


@query("text_diff_moves")
def _(spark, sf):
    return diffs.moves(diffs.hunks(*_edited(spark, sf), ("doc_id",)), ("doc_id",))


@query("text_diff_patched", """WITH l AS (SELECT doc_id, CASE WHEN text = '' THEN [] ELSE string_split(regexp_replace(text, '\\r\\n?', chr(10), 'g'), chr(10)) END AS l FROM documents),
k AS (SELECT doc_id, list_transform(list_filter(range(len(l)), lambda i: i % 7 <> 3), lambda i: CASE WHEN i % 11 = 5 THEN replace(l[i + 1], ' ', '  ') ELSE l[i + 1] END) AS l FROM l)
SELECT doc_id, md5(array_to_string(list_concat(l[2:], l[1:1]), chr(10))) AS text_md5 FROM k""")
def _(spark, sf):
    old, new = _edited(spark, sf)
    return diffs.patch(old, diffs.hunks(old, new, ("doc_id",)), ("doc_id",)).select("doc_id", F.md5("text").alias("text_md5"))


# Words in the order of their language: with case and accents told apart at the end of the comparison.
@query("sort_words_by_language", """WITH w AS (SELECT lang, unnest(regexp_extract_all(text, '[\\p{L}]+')) AS line FROM documents), d AS (SELECT DISTINCT lang, line FROM w)
SELECT lang, line, row_number() OVER (PARTITION BY lang ORDER BY line COLLATE en, line) AS place FROM d""")
def _(spark, sf):
    words = _docs(spark, sf).select("lang", F.explode(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))).alias("line")).distinct()
    return lines.rank_lines(words, "az", ignore_case=False, by="lang", ties=("line",))


# Counting -------------------------------------------------------------------------

_DOC_STATS = """SELECT doc_id, lang, source, @WORDS@ AS words, length(text) AS chars, length(regexp_replace(text, '@WS@', '', 'g')) AS chars_solid,
  len(@SENTENCE_LIST@) AS sentences,
  len(list_filter(regexp_split_to_array(text, '\\n@WS@*\\n'), lambda p: regexp_matches(p, '@NON_WS@'))) AS paragraphs FROM {src}"""


@query("doc_stats", """WITH @PASTED@, s AS (""" + _DOC_STATS.format(src="pasted") + """)
SELECT doc_id, words, chars, chars_solid, sentences, paragraphs, CASE WHEN words = 0 THEN '0m' WHEN words < 225 THEN '<1m'
  ELSE CAST(CAST(floor(words / 225 + 0.5) AS BIGINT) AS VARCHAR) || 'm' END AS reading FROM s""")
def _(spark, sf):
    return corpus.doc_stats(pasted(spark, sf))


@query("corpus_rollup", "WITH s AS (" + _DOC_STATS.format(src="documents") + """)
SELECT lang, source, CAST(grouping(lang, source) AS BIGINT) AS level, count(*) AS docs, CAST(sum(words) AS BIGINT) AS words,
  CAST(sum(chars) AS BIGINT) AS chars, CAST(sum(chars_solid) AS BIGINT) AS chars_solid, CAST(sum(sentences) AS BIGINT) AS sentences,
  CAST(sum(paragraphs) AS BIGINT) AS paragraphs FROM s GROUP BY ROLLUP (lang, source)""")
def _(spark, sf):
    return corpus.corpus_rollup(_docs(spark, sf))


_TALLY = """WITH w AS (SELECT doc_id, source, unnest(l) AS word, unnest(range(len(l))) AS pos FROM (
  SELECT doc_id, source, list_filter(regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{N}'']+'), lambda x: length(x) >= 3 AND x NOT IN (@STOP@)) AS l FROM documents))"""


@query("top_words_doc", _TALLY + """, t AS (SELECT doc_id, word, count(*) AS n, min(pos) AS p FROM w GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, p) AS place FROM t)
SELECT doc_id, place, word, n FROM r WHERE place <= 5""")
def _(spark, sf):
    return corpus.top_words(_docs(spark, sf), 5)


@query("top_words_corpus", _TALLY + " SELECT word, count(*) AS n FROM w GROUP BY word ORDER BY n DESC, word LIMIT 25")
def _(spark, sf):
    return corpus.top_words(_docs(spark, sf), 25, by=())


@query("top_words_source", _TALLY + """, t AS (SELECT source, word, count(*) AS n, min({'d': doc_id, 'p': pos}) AS p FROM w GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, p) AS place FROM t)
SELECT source, place, word, n FROM r WHERE place <= 5""")
def _(spark, sf):
    return corpus.top_words(_docs(spark, sf), 5, by=("source",))


@query("char_frequency", """WITH c AS (SELECT unnest(string_split(text, '')) AS char FROM documents), t AS (SELECT char, count(*) AS n FROM c WHERE char <> '' GROUP BY char)
SELECT char, n, round(100.0 * n / sum(n) OVER (), 6) AS share_pct FROM t""")
def _(spark, sf):
    return rounded(corpus.char_frequency(_docs(spark, sf)), 6, "share_pct")


@query("word_frequency_by_lang", """WITH c AS (SELECT lang, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{N}'']+')) AS word FROM documents),
t AS (SELECT lang, word, count(*) AS n FROM c WHERE word <> '' GROUP BY ALL)
SELECT lang, word, n, round(100.0 * n / sum(n) OVER (PARTITION BY lang), 6) AS share_pct FROM t""")
def _(spark, sf):
    return rounded(corpus.char_frequency(_docs(spark, sf), "word", ("lang",)), 6, "share_pct")


@query("invisible_audit", """WITH @PASTED@, c AS (SELECT source, unnest(regexp_extract_all(text, '@INVISIBLE@')) AS ch FROM pasted)
SELECT source, CAST(unicode(ch) AS BIGINT) AS code_point, regexp_matches(ch, '@ZERO_WIDTH@') AS zero_width, count(*) AS n FROM c GROUP BY ALL""")
def _(spark, sf):
    return corpus.invisible_audit(pasted(spark, sf))


@query("readability", """WITH s AS (SELECT doc_id, @WORDS@ AS words, len(@SENTENCE_LIST@) AS sentences,
  coalesce(list_sum(list_transform(regexp_extract_all(lower(text), '\\p{L}+'), lambda w: greatest(1, len(regexp_extract_all(w, '[aeiouyàâäéèêëíîïóôöúùûü]+'))))), 0) AS syllables FROM documents)
SELECT doc_id, words, sentences, CAST(syllables AS BIGINT) AS syllables,
  round(206.835 - 1.015 * (words / nullif(sentences, 0)) - 84.6 * (syllables / nullif(words, 0)), 6) AS ease,
  round(0.39 * (words / nullif(sentences, 0)) + 11.8 * (syllables / nullif(words, 0)) - 15.59, 6) AS grade FROM s""")
def _(spark, sf):
    return rounded(corpus.readability(_docs(spark, sf)), 6, "ease", "grade")


@query("hardest_sentences", """WITH s AS (SELECT doc_id, unnest(l) AS text, unnest(range(len(l))) AS sentence_no FROM (SELECT doc_id, @SENTENCE_LIST@ AS l FROM documents)),
w AS (SELECT doc_id, sentence_no, @WORDS@ AS words FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY words DESC, sentence_no) AS place FROM w)
SELECT doc_id, place, sentence_no, words FROM r WHERE place <= 3""")
def _(spark, sf):
    return corpus.hardest_sentences(_docs(spark, sf))


_LEVELS = "".join(
    f""",
t{d} AS (SELECT source, substr(p, 1, {d}) AS p, sha256(string_agg(h, '' ORDER BY p, h)) AS h, sum(n) AS n FROM t{d + 2} GROUP BY source, substr(p, 1, {d}))"""
    for d in (8, 6, 4, 2, 0)
)


@query("set_fingerprint", f"""WITH e AS (SELECT source, sha256(CAST(doc_id AS VARCHAR) || ':' || sha256(text)) AS h FROM documents),
t10 AS (SELECT source, substr(h, 1, 8) AS p, h, 1 AS n FROM e){_LEVELS}
SELECT source, h AS fingerprint, CAST(n AS BIGINT) AS texts FROM t0""")
def _(spark, sf):
    return corpus.set_fingerprint(_docs(spark, sf), F.col("doc_id"), F.col("text"), ("source",))


@query("version_drift", """SELECT CAST(doc_id AS VARCHAR) AS name, CAST(doc_id % 3 AS BIGINT) AS version, sha256(text) AS old_hash, sha256(text || '!') AS new_hash
FROM documents WHERE doc_id % 10 = 0 AND doc_id % 20 <> 0""")
def _(spark, sf):
    d, name = _docs(spark, sf), F.col("doc_id").cast("string").alias("name")
    old = d.select(name, (F.col("doc_id") % 3).alias("version"), F.sha2("text", 256).alias("hash"))
    # Every tenth text changed; every second of those had its version raised as well.
    text = F.when(F.col("doc_id") % 10 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    version = F.col("doc_id") % 3 + F.when(F.col("doc_id") % 20 == 0, 1).otherwise(0)
    return corpus.version_drift(old, d.select(name, version.alias("version"), F.sha2(text, 256).alias("hash")))


# Cleaning -------------------------------------------------------------------------

_WS_SQL = """WITH @PASTED@, a AS (SELECT doc_id, regexp_replace(text, '\\r\\n?', chr(10), 'g') AS b FROM pasted),
t AS (SELECT doc_id, b, regexp_replace(regexp_replace(b, '@ZERO_WIDTH@', '', 'g'), '@SPACE_LIKE@', ' ', 'g') AS x FROM a),
u AS (SELECT doc_id, b, {steps} AS r FROM t)
SELECT doc_id, length(b) AS chars_before, length(r) AS chars_after, length(b) - length(r) AS chars_saved, md5(r) AS text_md5 FROM u"""
_STEPS = "regexp_replace(regexp_replace(replace(x, chr(9), ' '), '[ \\t]{2,}', ' ', 'g'), '(?m)^[ \\t]+|[ \\t]+$', '', 'g')"


def _sized(df):
    return df.select("doc_id", "chars_before", "chars_after", "chars_saved", F.md5("text").alias("text_md5"))


@query("normalise_whitespace", _WS_SQL.replace("{steps}", _STEPS))
def _(spark, sf):
    return _sized(clean.normalise_ws(pasted(spark, sf)))


@query("normalise_whitespace_blank_lines", _WS_SQL.replace(
    "{steps}", f"array_to_string(list_filter(string_split({_STEPS}, chr(10)), lambda l: regexp_matches(l, '@NON_WS@')), chr(10))"))
def _(spark, sf):
    return _sized(clean.normalise_ws(pasted(spark, sf), blank_lines=True))


@query("remove_all_spaces", _WS_SQL.replace("{steps}", "regexp_replace(x, '[ \\t]+', '', 'g')"))
def _(spark, sf):
    return _sized(clean.normalise_ws(pasted(spark, sf), drop_all=True))


_BLOCK = """array_to_string(list_filter(list_transform(string_split({t}, chr(10)),
  lambda l: regexp_replace(l, '^@WS@+|@WS@+$', '', 'g')), lambda l: l <> ''), '{sep}')"""


@query("unwrap_lines", """WITH @PASTED@, a AS (SELECT doc_id, regexp_replace(text, '\\r\\n?', chr(10), 'g') AS b FROM pasted),
p AS (SELECT doc_id, b, array_to_string(list_filter(list_transform(regexp_split_to_array(regexp_replace(b, '(\\w)-\\n(\\w)', '\\1\\2', 'g'), '\\n[ \\t]*\\n+'), lambda q: """
    + _BLOCK.format(t="q", sep=" ") + """), lambda q: q <> ''), chr(10) || chr(10)) AS r FROM a)
SELECT doc_id, length(b) AS chars_before, length(r) AS chars_after, length(b) - length(r) AS chars_saved, md5(r) AS text_md5,
  len(string_split(b, chr(10))) AS lines_before, CASE WHEN r = '' THEN 0 ELSE len(string_split(r, chr(10))) END AS lines_after FROM p""")
def _(spark, sf):
    out = clean.unwrap(pasted(spark, sf), dehyphen=True)
    return out.select(
        "doc_id", "chars_before", "chars_after", "chars_saved", F.md5("text").alias("text_md5"), "lines_before", "lines_after"
    )


@query("unwrap_to_commas", """WITH @PASTED@, a AS (SELECT doc_id, regexp_replace(text, '\\r\\n?', chr(10), 'g') AS b FROM pasted),
p AS (SELECT doc_id, b, """ + _BLOCK.format(t="b", sep=", ") + """ AS r FROM a)
SELECT doc_id, length(b) AS chars_before, length(r) AS chars_after, length(b) - length(r) AS chars_saved, md5(r) AS text_md5 FROM p""")
def _(spark, sf):
    return _sized(clean.unwrap(pasted(spark, sf), sep=", ", keep_paragraphs=False))


@query("find_replace_literal", """SELECT doc_id, len(regexp_extract_all(text, '(?i)the\\.')) AS hits, md5(regexp_replace(text, '(?i)the\\.', '$5.', 'g')) AS text_md5 FROM documents""")
def _(spark, sf):
    return clean.find_replace(_docs(spark, sf), "the.", "$5.").select("doc_id", "hits", F.md5("text").alias("text_md5"))


@query("find_replace_regex", """SELECT doc_id, len(regexp_extract_all(text, '(\\w+) (the|les|der)\\b')) AS hits, md5(regexp_replace(text, '(\\w+) (the|les|der)\\b', '\\2 \\1', 'g')) AS text_md5 FROM documents""")
def _(spark, sf):
    out = clean.find_replace(_docs(spark, sf), r"(\w+) (the|les|der)\b", "$2 $1", regex=True, case=True)
    return out.select("doc_id", "hits", F.md5("text").alias("text_md5"))


# A needle of letters only: mark each maximal word, then the marked needle is the whole word.
@query("find_replace_word", """WITH m AS (SELECT doc_id, text, regexp_replace(text, '([\\p{L}\\p{M}\\p{N}_]+)', chr(1) || '\\1' || chr(2), 'g') AS t FROM documents)
SELECT doc_id, len(regexp_extract_all(t, '(?i)\\x01de\\x02')) AS hits,
  md5(regexp_replace(regexp_replace(t, '(?i)\\x01de\\x02', 'of', 'g'), '[\\x01\\x02]', '', 'g')) AS text_md5 FROM m""")
def _(spark, sf):
    return clean.find_replace(_docs(spark, sf), "de", "of", word=True).select("doc_id", "hits", F.md5("text").alias("text_md5"))


@query("regex_matches", """WITH e AS (SELECT doc_id, regexp_extract_all(text, '(\\w+)ing (\\w+)') AS m, regexp_extract_all(text, '(\\w+)ing (\\w+)', 1) AS a, regexp_extract_all(text, '(\\w+)ing (\\w+)', 2) AS b FROM documents),
x AS (SELECT doc_id, unnest(range(len(m))) AS match_no, unnest(m) AS match, unnest(a) AS group_1, unnest(b) AS group_2 FROM e)
SELECT doc_id, match_no, match, group_1, group_2 FROM x""")
def _(spark, sf):
    return clean.regex_matches(_docs(spark, sf), r"(\w+)ing (\w+)", 2).drop("start")


@query("regex_match_starts", """WITH e AS (SELECT doc_id, string_split(regexp_replace(text, '([0-9]+)', chr(1) || '\\1' || chr(2), 'g'), chr(1)) AS c FROM documents),
x AS (SELECT doc_id, c, unnest(range(2, len(c) + 1)) AS i FROM e)
SELECT doc_id, i - 2 AS match_no, CAST(list_sum(list_transform(c[1:i - 1], lambda p: length(replace(p, chr(2), '')))) AS BIGINT) AS start, string_split(c[i], chr(2))[1] AS match FROM x""")
def _(spark, sf):
    return clean.regex_matches(_docs(spark, sf), r"[0-9]+")


# The checking engine has no back-references: letters doubled, one by one.
_DOUBLED = " UNION ALL ".join(f"SELECT doc_id, '{c}' AS letter, len(regexp_extract_all(text, '{c}{c}')) AS n FROM documents" for c in "abcdefghijklmnopqrstuvwxyz")


@query("regex_back_reference", f"""SELECT doc_id, letter, CAST(n AS BIGINT) AS n FROM ({_DOUBLED}) WHERE n > 0""")
def _(spark, sf):
    found = clean.regex_matches(_docs(spark, sf), r"(?<letter>[a-z])\1")
    return found.groupBy("doc_id", "letter").agg(F.count(F.lit(1)).alias("n"))


@query("regex_any_character", """WITH d AS (SELECT doc_id, replace(text, ' ', chr(57344)) AS t FROM documents), e AS (SELECT doc_id, string_split(t, chr(57344)) AS c FROM d),
x AS (SELECT doc_id, c, unnest(range(1, len(c))) AS i FROM e)
SELECT doc_id, i - 1 AS match_no, CAST(list_sum(list_transform(c[1:i], lambda p: length(p))) + i - 1 AS BIGINT) AS start FROM x""")
def _(spark, sf):
    docs = _docs(spark, sf).withColumn("text", F.replace("text", F.lit(" "), F.lit("\ue000")))
    return clean.regex_matches(docs, "\ue000").drop("match")


@query("find_replace_refused", """SELECT doc_id, CAST(0 AS BIGINT) AS hits, md5(text) AS text_md5, 'a repeated group holds a repetition' AS finding FROM documents""")
def _(spark, sf):
    return clean.find_replace(_docs(spark, sf), "((a|b)+c?)+$", "x", regex=True).select("doc_id", "hits", F.md5("text").alias("text_md5"), "finding")


@query("case_key", """WITH p AS (SELECT replace(p_name, ' ', CASE p_partkey % 3 WHEN 0 THEN '_' WHEN 1 THEN '-' ELSE ' ' END) AS n, p_partkey FROM part),
v AS (SELECT CASE WHEN p_partkey % 2 = 0 THEN upper(n) ELSE n END AS name FROM p),
k AS (SELECT name, array_to_string(list_filter(regexp_split_to_array(lower(replace(regexp_replace(regexp_replace(name, '([A-Z]+)([A-Z][a-z])', '\\1 \\2', 'g'), '([a-z0-9])([A-Z])', '\\1 \\2', 'g'), '''', '')), '[^\\p{L}\\p{M}\\p{N}]+'), lambda w: w <> ''), '_') AS case_key FROM v)
SELECT case_key, count(*) AS n, count(DISTINCT name) AS spellings FROM k GROUP BY case_key""")
def _(spark, sf):
    sep = F.when(F.col("p_partkey") % 3 == 0, "_").when(F.col("p_partkey") % 3 == 1, "-").otherwise(" ")
    name = F.replace(F.col("p_name"), F.lit(" "), sep)
    spelled = table(spark, sf, "part").select(F.when(F.col("p_partkey") % 2 == 0, F.upper(name)).otherwise(name).alias("name"))
    return clean.case_variants(spelled, "name")


@query("case_styles", """WITH w AS (SELECT p_partkey, p_name, string_split(p_name, ' ') AS s FROM part)
SELECT p_partkey, array_to_string(s, '-') AS kebab, array_to_string(list_transform(s, lambda x: upper(x[1]) || x[2:]), ' ') AS title,
  s[1] || array_to_string(list_transform(s[2:], lambda x: upper(x[1]) || x[2:]), '') AS camel, upper(p_name[1]) || p_name[2:] AS sentence FROM w""")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", *[T.recase("p_name", s).alias(s) for s in ("kebab", "title", "camel", "sentence")])


@query("slug_assign", """WITH s AS (SELECT p_partkey, regexp_replace(lower(p_name || ' / ' || p_type), '[^a-z0-9]+', '-', 'g') AS b FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY p_partkey) AS n FROM s)
SELECT p_partkey, b || CASE WHEN n > 1 THEN '-' || CAST(n AS VARCHAR) ELSE '' END AS slug FROM r""")
def _(spark, sf):
    titled = table(spark, sf, "part").select("p_partkey", F.concat_ws(" / ", "p_name", "p_type").alias("title"))
    return clean.assign_slugs(titled, "title", "p_partkey").select("p_partkey", "slug")


# Brands, some with a number behind: their numbers are taken by the brand's own copies otherwise.
@query("slug_assign_clashing", """WITH t AS (SELECT p_partkey, lower(replace(p_brand || CASE WHEN p_partkey % 3 = 0 THEN ' ' || CAST(p_partkey % 11 AS VARCHAR) ELSE '' END, '#', '-')) AS t FROM part),
b AS (SELECT p_partkey, replace(t, ' ', '-') AS b FROM t),
c AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY p_partkey) AS n FROM b),
free AS (SELECT o.b, s.k, row_number() OVER (PARTITION BY o.b ORDER BY s.k) + 1 AS n FROM (SELECT b, max(n) AS most FROM c GROUP BY b) o, range(2, (SELECT max(n) + 20 FROM c)) s(k)
  WHERE s.k <= o.most + 20 AND o.b || '-' || CAST(s.k AS VARCHAR) NOT IN (SELECT b FROM b))
SELECT p_partkey, CASE WHEN c.n = 1 THEN c.b ELSE c.b || '-' || CAST(free.k AS VARCHAR) END AS slug FROM c LEFT JOIN free ON free.b = c.b AND free.n = c.n""")
def _(spark, sf):
    number = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" "), F.col("p_partkey") % 11)).otherwise("")
    titled = table(spark, sf, "part").select("p_partkey", F.concat("p_brand", number).alias("title"))
    return clean.assign_slugs(titled, "title", "p_partkey").select("p_partkey", "slug")


@query("content_hash", "SELECT doc_id, sha1(text) AS sha1, sha256(text) AS sha256, upper(sha256(text)) AS sha256_upper FROM documents")
def _(spark, sf):
    text = F.col("text")
    return _docs(spark, sf).select(
        "doc_id", clean.digest(text, "SHA-1").alias("sha1"), clean.digest(text).alias("sha256"),
        clean.digest(text, upper=True).alias("sha256_upper"),
    )


# The checking engine has no SHA-384 or SHA-512; tests hold these against the published vectors.
@query("content_hash_long")
def _(spark, sf):
    text = F.col("text")
    return _docs(spark, sf).select(
        "doc_id", clean.digest(text, "SHA-384").alias("sha384"), clean.digest(text, "SHA-512").alias("sha512")
    )


@query("content_hash_dups", "SELECT sha256(text) AS digest, count(*) AS copies, min(doc_id) AS first_key FROM documents GROUP BY text HAVING count(*) > 1")
def _(spark, sf):
    return clean.duplicate_groups(_docs(spark, sf), "doc_id")


@query("verify_manifest", """SELECT doc_id AS name, CASE WHEN doc_id % 11 = 0 THEN 'unlisted' WHEN doc_id % 13 = 0 THEN 'missing' WHEN doc_id % 7 = 0 THEN 'changed' ELSE 'ok' END AS state
FROM documents WHERE NOT (doc_id % 11 = 0 AND doc_id % 13 = 0)""")
def _(spark, sf):
    d, i = _docs(spark, sf), F.col("doc_id")
    files = d.where(i % 13 != 0).select(i.alias("name"), clean.digest(F.col("text")).alias("digest"))
    then = F.when(i % 7 == 0, F.concat("text", F.lit(" "))).otherwise(F.col("text"))
    manifest = d.where(i % 11 != 0).select(i.alias("name"), clean.digest(then, upper=True).alias("digest"))
    return clean.verify_manifest(files, manifest)


_RULES = [(" the ", " THE "), (" and the ", " AND THE "), (" les ", " LES "), ("tion", "TION"), (" der", " DER")]


def _rewrite_sql() -> str:
    sql, n = "SELECT doc_id, text AS old, text AS t0, CAST(0 AS BIGINT) AS e0 FROM documents", 0
    for find, repl in clean.longest_first(_RULES):
        sql = (
            f"SELECT doc_id, old, replace(t{n}, '{find}', '{repl}') AS t{n + 1}, "
            f"e{n} + CAST((length(t{n}) - length(replace(t{n}, '{find}', ''))) / {len(find)} AS BIGINT) AS e{n + 1} FROM ({sql})"
        )
        n += 1
    return f"SELECT doc_id, e{n} AS edits, t{n} <> old AS changed, md5(t{n}) AS text_md5 FROM ({sql})"


@query("bulk_rewrite", _rewrite_sql())
def _(spark, sf):
    return clean.bulk_rewrite(_docs(spark, sf), _RULES).select("doc_id", "edits", "changed", F.md5("text").alias("text_md5"))


@query("rules_join", "WITH r(find, replace_by) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in _RULES) + """),
h AS (SELECT doc_id, find, replace_by, CAST((length(text) - length(replace(text, find, ''))) / length(find) AS BIGINT) AS hits FROM documents, r)
SELECT doc_id, find, replace_by, hits FROM h WHERE hits > 0""")
def _(spark, sf):
    return rules.rule_hits(_docs(spark, sf), spark.createDataFrame(_RULES, "find string, replace_by string"))


# Rules read from a table: every longer word of the benchmark, and the first words of every item.
_RULE_TABLE = """w AS (SELECT string_split(text, ' ') AS l FROM benchmark),
r AS (SELECT find, '{' || length(find) || '}' AS replace_by FROM (
  SELECT DISTINCT find FROM (SELECT unnest(l) AS find FROM w UNION ALL SELECT array_to_string(l[1:3], ' ') FROM w) WHERE length(find) > 5))"""


def _rule_table(spark, sf):
    split = F.split("text", " ")
    found = table(spark, sf, "benchmark").select(F.explode(F.concat(split, F.array(F.array_join(F.slice(split, 1, 3), " ")))).alias("find"))
    return found.where(F.length("find") > 5).distinct().withColumn("replace_by", F.format_string("{%d}", F.length("find")))


@query("rules_from_table", "WITH " + _RULE_TABLE + """,
h AS (SELECT doc_id, find, replace_by, CAST((length(text) - length(replace(text, find, ''))) / length(find) AS BIGINT) AS hits FROM documents, r)
SELECT doc_id, find, replace_by, hits FROM h WHERE hits > 0""")
def _(spark, sf):
    return rules.rule_hits(_docs(spark, sf), _rule_table(spark, sf))


# An alternation takes its first alternative that fits: longest first is leftmost-longest.
@query("rewrite_from_table", "WITH " + _RULE_TABLE + """,
p AS (SELECT string_agg(regexp_escape(find), '|' ORDER BY length(find) DESC, find) AS p FROM r),
m AS (SELECT doc_id, text, regexp_extract_all(text, p) AS h, regexp_split_to_array(text, p) AS gaps FROM documents, p),
o AS (SELECT doc_id, text, len(h) AS edits, CASE WHEN len(h) = 0 THEN text ELSE
  array_to_string(list_transform(range(1, len(gaps) + 1), lambda i: gaps[i] || CASE WHEN i <= len(h) THEN '{' || length(h[i]) || '}' ELSE '' END), '') END AS t FROM m)
SELECT doc_id, edits, edits > 0 AS changed, md5(t) AS text_md5 FROM o""")
def _(spark, sf):
    out = rules.apply_rules(_docs(spark, sf), _rule_table(spark, sf))
    return out.select("doc_id", "edits", "changed", F.md5("text").alias("text_md5"))


# Forbidden phrases from a table: every link text that stands in some page, looked for in all of them.
@query("forbidden_phrases", """WITH f AS (SELECT DISTINCT unnest(regexp_extract_all(html, '<a href="([^"]+)"', 1)) AS find FROM pages),
r AS (SELECT find FROM f WHERE length(find) > 4),
h AS (SELECT page_id, find, CAST((length(html) - length(replace(html, find, ''))) / length(find) AS BIGINT) AS hits FROM pages, r)
SELECT page_id, find, hits FROM h WHERE hits > 0""")
def _(spark, sf):
    pages = table(spark, sf, "pages")
    found = pages.select(F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]+)"'), F.lit(1))).alias("find"))
    phrases = found.where(F.length("find") > 4).distinct().withColumn("replace_by", F.lit(""))
    return rules.rule_hits(pages, phrases, "page_id", "html").drop("replace_by")


@query("html_to_text", """WITH t AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g') AS x FROM pages),
u AS (SELECT page_id, replace(replace(replace(replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') AS y FROM t),
v AS (SELECT page_id, trim(regexp_replace(y, '@WS@+', ' ', 'g'), ' ') AS z FROM u)
SELECT page_id, length(z) AS chars, md5(z) AS text_md5 FROM v""")
def _(spark, sf):
    text = T.html_to_text("html")
    return table(spark, sf, "pages").select("page_id", text.alias("t")).select("page_id", F.length("t").alias("chars"), F.md5("t").alias("text_md5"))


# Search ---------------------------------------------------------------------------


@query("keyword_search", "SELECT p_partkey, p_name FROM part WHERE p_type = 'ECONOMY' AND contains(lower(p_name || ' ' || p_brand || ' ' || p_type), 'd#1') OR (p_type = 'ECONOMY' AND contains(lower(concat_ws(' ', p_name, p_brand, p_type)), 'g brand#1'))")
def _(spark, sf):
    part = table(spark, sf, "part")
    found = search.keyword_search(part, ["p_name", "p_brand", "p_type"], "  D#1 ", "ECONOMY", "p_type")
    return found.unionByName(search.keyword_search(part, ["p_name", "p_brand", "p_type"], "G Brand#1", "ECONOMY", "p_type")).select(
        "p_partkey", "p_name").distinct()


@query("keyword_search_documents", "SELECT doc_id, lang FROM documents WHERE contains(lower(concat_ws(' ', text, lang, source)), 'ing the') ORDER BY doc_id")
def _(spark, sf):
    return search.keyword_search(_docs(spark, sf), ["text", "lang", "source"], "ing THE").select("doc_id", "lang").orderBy("doc_id")


@query("popular_filter", "SELECT p_partkey, p_name FROM part WHERE p_size >= 40")
def _(spark, sf):
    part = table(spark, sf, "part").withColumn("popular", F.col("p_size") >= 40)
    return search.popular(part, "popular").select("p_partkey", "p_name")


@query("popular_filter_with_query", "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ring')")
def _(spark, sf):
    part = table(spark, sf, "part").withColumn("popular", F.col("p_size") >= 40)
    return search.popular(part, "popular", "ring", ["p_name"]).select("p_partkey", "p_name")


@query("non_empty_domain", """WITH d AS (SELECT r_regionkey * 5 + i AS ord, 'SMALL' AS a, r_name, i FROM region, range(2) t(i)),
dom AS (SELECT ord, CASE WHEN i = 0 THEN r_name ELSE (SELECT min(p_type) FROM part) END AS category FROM d)
SELECT ord, category FROM dom WHERE category IN (SELECT p_type FROM part)""")
def _(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_type").alias("category"))
    first = part.agg(F.min("category")).scalar()
    domain = table(spark, sf, "region").select("r_regionkey", "r_name", F.explode(F.array(F.lit(0), F.lit(1))).alias("i")).select(
        (F.col("r_regionkey") * 5 + F.col("i")).alias("ord"), F.when(F.col("i") == 0, F.col("r_name")).otherwise(first).alias("category")
    )
    return search.used_categories(domain, part, "category")


_RELATED = """WITH b AS (SELECT {key} AS item, {cat} AS cat, lower({name}) AS s FROM {src}),
p AS (SELECT *, row_number() OVER (PARTITION BY cat ORDER BY s, item) AS pos, count(*) OVER (PARTITION BY cat) AS sz FROM b),
near AS (SELECT a.item, t.step, c.item AS related FROM p a, range(1, 4) t(step), p c WHERE t.step < a.sz AND c.cat = a.cat AND c.pos = (a.pos - 1 + t.step) % a.sz + 1),
far AS (SELECT a.item, a.sz - 1 + row_number() OVER (PARTITION BY a.item ORDER BY c.s, c.item) AS step, c.item AS related FROM p a, p c WHERE a.sz <= 3 AND c.cat <> a.cat)
SELECT item, step, related FROM near UNION ALL SELECT item, step, related FROM far WHERE step <= 3"""


@query("related_items", _RELATED.format(key="p_partkey", cat="p_brand", name="p_name", src="part"))
def _(spark, sf):
    return search.related(table(spark, sf, "part"), "p_partkey", "p_brand", "p_name")


@query("related_items_thin", _RELATED.format(key="s_suppkey", cat="CAST(s_nationkey * 10 + s_suppkey % 3 AS BIGINT)", name="s_name", src="supplier"))
def _(spark, sf):
    rows = table(spark, sf, "supplier").withColumn("shelf", F.col("s_nationkey") * 10 + F.col("s_suppkey") % 3)
    return search.related(rows, "s_suppkey", "shelf", "s_name")
