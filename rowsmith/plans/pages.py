"""Queries over the page corpus: rules, links, weights, and set comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.functions import text as T
from rowsmith.operators import audit, corpus, lines, sets, tags
from rowsmith.plans.registry import PIECES, query, rounded, table

# The driver's pages have a plain head. This view gives most of them the tags the
# rules look at, and leaves some of them wrong, by page number.
PIECES["HOST"] = "regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)"
PIECES["UNESCAPE"] = """replace(replace(replace(replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"""
PIECES["RICH"] = """head AS (SELECT page_id, url, html, regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS h1 FROM pages),
rich AS (SELECT page_id, url, replace(replace(replace(html, '<title>', CASE WHEN page_id % 33 = 0 THEN '<titel>' WHEN page_id % 16 = 0 THEN '<title>' || repeat('long ', 12) ELSE '<title>' END),
  '</footer>', CASE WHEN page_id % 21 = 0 THEN '<h1>Again</h1></footer>' ELSE '</footer>' END), '<meta charset="utf-8">', '<meta charset="utf-8">'
  || CASE WHEN page_id % 3 <> 0 THEN '<link rel="canonical" href="' || url || '">' ELSE '' END
  || CASE WHEN page_id % 4 <> 0 THEN '<meta name="description" content="' || repeat('salt &amp; pepper ', CAST(5 + page_id % 8 AS INTEGER)) || '">' ELSE '' END
  || CASE page_id % 5 WHEN 0 THEN '' WHEN 1 THEN '<script type="application/ld+json">{"@type": "Article", bad</script>'
     ELSE '<script type="application/ld+json">{"@type": "Article", "headline": "' || CASE WHEN page_id % 7 = 0 THEN 'Other' ELSE replace(h1, '&amp;', '&') END || '", "url": "' || url
       || '", "mainEntityOfPage": "' || CASE WHEN page_id % 11 = 0 THEN 'x' ELSE url END || '", "datePublished": "' || CASE WHEN page_id % 13 = 0 THEN '2024' WHEN page_id % 17 = 0 THEN '2025-01-01' ELSE '2024-03-02' END
       || '", "dateModified": "2024-10-03"}</script><script type="application/ld+json">{"@type": "WebSite", "name": "' || substr(replace(h1, '&amp;', '&'), 1, 5) || '", "url": "' || CASE WHEN page_id % 19 = 0 THEN 'y' ELSE url END || '"}</script>' END
  || CASE WHEN page_id % 6 <> 0 THEN '<meta http-equiv="Content-Security-Policy" content="default-src self">' ELSE '' END
  || '<link rel="stylesheet" href="/css/site.css?v=' || CASE WHEN page_id % 50 = 0 THEN '41' ELSE '42' END || '">'
  || CASE WHEN page_id % 10 = 0 THEN '<script src="https://cdn' || CAST(page_id % 3 AS VARCHAR) || '.example.net/x.js"></script><a href="https://ref' || CAST(page_id % 4 AS VARCHAR) || '.example.org/a">a</a>' ELSE '' END
  || CASE WHEN page_id % 9 = 0 THEN '<script>fetch("/x")</script>' ELSE '' END
  || CASE page_id % 4 WHEN 0 THEN '<label for="q">Find</label><input id="q"><input id="z" type="text">' WHEN 1 THEN '<label>Pick <select id="s"></select></label><textarea aria-label="Note"></textarea>' WHEN 2 THEN '<input type="hidden" id="h"><textarea id="t"></textarea>' ELSE '' END
  || '<p>Updated ' || CASE WHEN page_id % 23 = 0 THEN '4' ELSE '3' END || ' October 2024</p>') AS html FROM head)"""


def rich(spark, sf):
    p, i = table(spark, sf, "pages"), F.col("page_id")
    lit = F.lit
    h1 = F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1)
    plain = F.replace(h1, lit("&amp;"), lit("&"))
    url = F.col("url")
    when = lambda cond, *parts: F.when(cond, F.concat(*[x if not isinstance(x, str) else lit(x) for x in parts])).otherwise(lit(""))
    block = F.concat(
        lit('<script type="application/ld+json">{"@type": "Article", "headline": "'), F.when(i % 7 == 0, "Other").otherwise(plain),
        lit('", "url": "'), url, lit('", "mainEntityOfPage": "'), F.when(i % 11 == 0, "x").otherwise(url), lit('", "datePublished": "'),
        F.when(i % 13 == 0, "2024").when(i % 17 == 0, "2025-01-01").otherwise("2024-03-02"),
        lit('", "dateModified": "2024-10-03"}</script><script type="application/ld+json">{"@type": "WebSite", "name": "'),
        F.substring(plain, 1, 5), lit('", "url": "'), F.when(i % 19 == 0, "y").otherwise(url), lit('"}</script>'),
    )
    head = F.concat(
        lit('<meta charset="utf-8">'),
        when(i % 3 != 0, '<link rel="canonical" href="', url, '">'),
        when(i % 4 != 0, '<meta name="description" content="', F.repeat(lit("salt &amp; pepper "), (5 + i % 8).cast("int")), '">'),
        F.when(i % 5 == 0, "").when(i % 5 == 1, '<script type="application/ld+json">{"@type": "Article", bad</script>').otherwise(block),
        when(i % 6 != 0, '<meta http-equiv="Content-Security-Policy" content="default-src self">'),
        lit('<link rel="stylesheet" href="/css/site.css?v='), F.when(i % 50 == 0, "41").otherwise("42"), lit('">'),
        when(i % 10 == 0, '<script src="https://cdn', (i % 3).cast("string"), '.example.net/x.js"></script><a href="https://ref', (i % 4).cast("string"), '.example.org/a">a</a>'),
        when(i % 9 == 0, '<script>fetch("/x")</script>'),
        F.when(i % 4 == 0, '<label for="q">Find</label><input id="q"><input id="z" type="text">')
        .when(i % 4 == 1, '<label>Pick <select id="s"></select></label><textarea aria-label="Note"></textarea>')
        .when(i % 4 == 2, '<input type="hidden" id="h"><textarea id="t"></textarea>').otherwise(""),
        lit("<p>Updated "), F.when(i % 23 == 0, "4").otherwise("3"), lit(" October 2024</p>"),
    )
    title = F.when(i % 33 == 0, "<titel>").when(i % 16 == 0, "<title>" + "long " * 12).otherwise("<title>")
    foot = F.when(i % 21 == 0, "<h1>Again</h1></footer>").otherwise("</footer>")
    html = F.replace(F.replace("html", lit("<title>"), title), lit("</footer>"), foot)
    return p.select("page_id", "url", F.replace(html, lit('<meta charset="utf-8">'), head).alias("html"))


# One rule each --------------------------------------------------------------------

PHRASES = ["example.com", "track(", "TODO-slug"]
NOTICE = ["copy", "footer", "privacy"]


def _rule(name: str, rules, sql: str) -> None:
    @query(name, sql)
    def _(spark, sf):
        return audit.audit(rich(spark, sf), rules)


_SELECT = "SELECT page_id, rule, severity, detail FROM ({}) WHERE detail IS NOT NULL"


def _finding_sql(rule: str, *cases: str, severity: str = "error", source: str = "rich", extra: str = "") -> str:
    rows = " UNION ALL ".join(f"SELECT page_id, '{rule}' AS rule, '{severity}' AS severity, {c} AS detail FROM {source}" for c in cases)
    return f"WITH @RICH@{extra} " + _SELECT.format(rows)


PIECES["H1"] = "regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"
_RAW_TITLE = PIECES["UNESCAPE"].format(x="regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")
_TITLE = "regexp_replace(" + PIECES["UNESCAPE"].format(x="regexp_extract(html, '(?s)<title>(.*?)</title>', 1)") + ", '^@WS@+|@WS@+$', '', 'g')"
_DESC = "regexp_replace(" + PIECES["UNESCAPE"].format(x="""regexp_extract(html, '(?s)<meta name="description" content="(.*?)"', 1)""") + ", '^@WS@+|@WS@+$', '', 'g')"

_MISNAMED = f"(substr(replace(@H1@, '&amp;', '&'), 1, 5) = '' OR NOT starts_with({_RAW_TITLE}, substr(replace(@H1@, '&amp;', '&'), 1, 5)))"

SQL = {
    "placeholder_scan": _finding_sql("placeholder", *[f"CASE WHEN contains(html, '{p}') THEN 'still holds {p}' END" for p in PHRASES]),
    "title_rule": _finding_sql("title", "CASE WHEN NOT regexp_matches(html, '(?s)<title>(.*?)</title>') THEN 'no title' END", f"CASE WHEN length({_TITLE}) > 62 THEN 'length ' || CAST(length({_TITLE}) AS VARCHAR) END"),
    "description_rule": _finding_sql("description", """CASE WHEN NOT contains(html, '<meta name="description" content="') THEN 'no description' END""",
        f"""CASE WHEN contains(html, '<meta name="description" content="') AND length({_DESC}) NOT BETWEEN 110 AND 165 THEN 'length ' || CAST(length({_DESC}) AS VARCHAR) END"""),
    "h1_count": _finding_sql("h1", "CASE WHEN len(regexp_extract_all(html, '<h1>')) <> 1 THEN CAST(len(regexp_extract_all(html, '<h1>')) AS VARCHAR) || ' headings' END"),
    "canonical_rule": _finding_sql("canonical", """CASE WHEN NOT contains(html, 'rel="canonical"') THEN 'no canonical tag' END"""),
    "jsonld_rule": _finding_sql("json_ld", "CASE WHEN len(l) = 0 THEN 'no structured data' END", "CASE WHEN len(list_filter(l, lambda b: NOT json_valid(b))) > 0 THEN 'invalid structured data' END",
        source="ld", extra=""", ld AS (SELECT page_id, regexp_extract_all(html, '(?s)<script type="application/ld\\+json">(.*?)</script>', 1) AS l FROM rich)"""),
    "policy_present": _finding_sql("policy", "CASE WHEN NOT contains(html, 'Content-Security-Policy') THEN 'no Content-Security-Policy' END"),
    "network_calls": _finding_sql("network", "CASE WHEN regexp_matches(html, '\\bfetch\\(|XMLHttpRequest|sendBeacon|new WebSocket|EventSource|importScripts') THEN regexp_extract(html, '\\bfetch\\(|XMLHttpRequest|sendBeacon|new WebSocket|EventSource|importScripts') END"),
    "notice_rule": _finding_sql("notice", "CASE WHEN len(m) > 0 THEN 'lacks ' || array_to_string(m, ', ') END", source="n",
        extra=", n AS (SELECT page_id, list_filter(['copy', 'footer', 'privacy'], lambda p: NOT contains(html, p)) AS m FROM rich)"),
    # The blocks are built above, so what is wrong with each is known by page number.
    "article_consistency": _finding_sql("article", "CASE WHEN page_id % 5 <= 1 THEN '0 articles' END",
        "CASE WHEN page_id % 5 > 1 AND (page_id % 7 = 0 OR " + PIECES["UNESCAPE"].format(x=r"trim(regexp_replace(@H1@, '\s+', ' ', 'g'))")
            + " <> replace(@H1@, '&amp;', '&')) THEN 'headline is not the heading' END",
        "CASE WHEN page_id % 5 > 1 AND (page_id % 11 = 0 OR page_id % 3 = 0) THEN 'url is not the canonical address' END",
        "CASE WHEN page_id % 5 > 1 AND page_id % 13 = 0 THEN 'dates are not YYYY-MM-DD' END",
        "CASE WHEN page_id % 5 > 1 AND page_id % 13 <> 0 AND page_id % 17 = 0 THEN 'modified before published' END",
        "CASE WHEN page_id % 5 > 1 AND page_id % 13 <> 0 AND page_id % 23 = 0 THEN 'modified is not the printed date' END"),
    "site_block_rule": _finding_sql("site_block", "CASE WHEN page_id % 5 <= 1 THEN '0 site blocks' END",
        f"CASE WHEN page_id % 5 > 1 AND {_MISNAMED} THEN 'name does not start the title' END",
        f"CASE WHEN page_id % 5 > 1 AND NOT {_MISNAMED} AND (page_id % 19 = 0 OR page_id % 3 = 0) THEN 'url is not canonical' END"),
    "hostile_markup_pages": _finding_sql("hostile", """CASE WHEN regexp_matches(html, '(?i)<script|<iframe|<[^>]*\\son[a-z]+\\s*=|javascript:') THEN regexp_extract(html, '(?i)<script|<iframe|<[^>]*\\son[a-z]+\\s*=|javascript:') END""", severity="warning"),
}
RULES = {
    "placeholder_scan": [audit.placeholder_rule(PHRASES)],
    "title_rule": [audit.title_rule()],
    "description_rule": [audit.description_rule()],
    "h1_count": [audit.heading_rule],
    "canonical_rule": [audit.canonical_rule],
    "jsonld_rule": [audit.json_ld_rule],
    "policy_present": [audit.policy_rule()],
    "network_calls": [audit.network_rule],
    "notice_rule": [audit.notice_rule(NOTICE)],
    "article_consistency": [audit.article_rule],
    "site_block_rule": [audit.site_block_rule],
    "hostile_markup_pages": [audit.hostile_rule],
}
for _name, _rules in RULES.items():
    _rule(_name, _rules, SQL[_name])


ALL_RULES = [rule for group in RULES.values() for rule in group]


# Every rule above in a single scan, as counts.
_ALL_SQL = " UNION ALL ".join(
    "SELECT rule, severity FROM (" + SQL[n].replace("WITH @RICH@", "WITH @RICH@", 1) + ")" for n in RULES
)


@query("page_audit", f"SELECT rule, severity, count(*) AS n FROM ({_ALL_SQL}) GROUP BY rule, severity")
def _(spark, sf):
    return sets.verdict(audit.audit(rich(spark, sf), ALL_RULES))


# Rules across pages ---------------------------------------------------------------

PIECES["PATHS"] = """known AS (SELECT DISTINCT @HOST@ AS host, CASE WHEN p = '' THEN '/' ELSE regexp_replace(p, '/+$', '') END AS target
  FROM (SELECT url, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS p FROM pages))"""
# Every relative address in these pages is already absolute on its host.
PIECES["LINKS"] = """links AS (SELECT page_id, @HOST@ AS host, unnest(list_concat(regexp_extract_all(html, '(?:href|src)="([^"#?:]+)(?:\\?[^"]*)?"', 1),
  regexp_extract_all(html, 'new (?:Shared)?Worker\\(["'']([^"''#?:]+)', 1))) AS href FROM rich)"""


@query("dead_links", """WITH @RICH@, @PATHS@, @LINKS@ SELECT page_id, host, href FROM links WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.host = links.host AND k.target = href)""")
def _(spark, sf):
    return audit.dead_links(rich(spark, sf))


@query("external_hosts", """WITH @RICH@, h AS (SELECT page_id, unnest(list_distinct(regexp_extract_all(html, 'href="(?:https?:)?//([^/"]+)', 1))) AS host FROM rich)
SELECT host, count(*) AS pages FROM h WHERE host <> 'ref1.example.org' GROUP BY host""")
def _(spark, sf):
    return audit.external_hosts(rich(spark, sf), ["ref1.example.org"])


@query("foreign_scripts", """WITH @RICH@, s AS (SELECT page_id, unnest(regexp_extract_all(html, 'src="((?:https?:)?//[^"]+)"', 1)) AS src FROM rich)
SELECT page_id, src FROM s WHERE src <> 'https://cdn1.example.net/x.js'""")
def _(spark, sf):
    return audit.foreign_scripts(rich(spark, sf), ["https://cdn1.example.net/x.js"])


@query("sitemap_coverage", "SELECT page_id, url FROM pages WHERE page_id % 9 = 0 AND url NOT IN (SELECT url FROM pages WHERE page_id % 9 <> 0)")
def _(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    listing = p.where(F.col("page_id") % 9 != 0).select(F.col("url").alias("loc"))
    return audit.uncovered(p, "url", listing, "loc").select("page_id", "url")


@query("stale_count", """WITH a AS (SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)
SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE n + 1 END AS printed, n FROM a WHERE c_custkey % 10 = 0 OR c_custkey % 7 = 0""")
def _(spark, sf):
    n = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    k = F.col("c_custkey")
    shown = table(spark, sf, "customer").select("c_custkey").join(n, "c_custkey", "left")
    number = F.coalesce(F.col("n"), F.lit(0)) + F.when(k % 10 == 0, 1).otherwise(0)
    text = F.when(k % 7 == 0, "orders to come").otherwise(F.concat(number.cast("string"), F.lit(" orders so far")))
    return audit.stale_counts(shown.select("c_custkey", text.alias("text")), n, "c_custkey", "text", r"(\d+) orders")


@query("tick_consistency", """WITH m AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity > 45)
SELECT p_partkey, p_size % 2 = 0 AS ticked, p_partkey IN (SELECT l_partkey FROM m) AS is_member FROM part WHERE (p_size % 2 = 0) <> (p_partkey IN (SELECT l_partkey FROM m))""")
def _(spark, sf):
    marked = table(spark, sf, "part").select("p_partkey", (F.col("p_size") % 2 == 0).alias("ticked"))
    members = table(spark, sf, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return audit.tick_mismatches(marked, "p_partkey", "ticked", members)


@query("unlabelled_controls", """SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 1 ELSE 1 END AS control_no, CASE WHEN page_id % 4 = 0 THEN 'z' ELSE 't' END AS control_id
FROM pages WHERE page_id % 4 IN (0, 2) AND contains(html, '<meta charset="utf-8">')""")
def _(spark, sf):
    return tags.unlabelled_controls(rich(spark, sf))


# In these pages no tag stands in a script or style, and every attribute is quoted.
@query("tag_stream", """WITH @RICH@, b AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?s)(<(script|style|title)[^>]*>).*?(</(script|style|title)>)', '\\1', 'g') AS t FROM rich),
t AS (SELECT page_id, unnest(regexp_extract_all(t, '<([a-z][a-z0-9]*)[^>]*>')) AS tag FROM b)
SELECT page_id, regexp_extract(tag, '<([a-z0-9]+)', 1) AS name, count(*) AS n, CAST(sum(len(regexp_extract_all(tag, ' [a-z-]+="'))) AS BIGINT) AS attributes,
  CAST(sum(length(regexp_extract(tag, 'href="([^"]*)"', 1))) AS BIGINT) AS href_chars FROM t GROUP BY ALL""")
def _(spark, sf):
    stream = tags.tag_stream(rich(spark, sf)).where("not closing")
    return stream.groupBy("page_id", "name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("attributes")).alias("attributes"), F.sum(F.length(F.coalesce(F.col("attributes")["href"], F.lit("")))).alias("href_chars")
    )


@query("allow_deny_policy", """WITH x AS (SELECT page_id, @HOST@ LIKE 'm.%' AS denied, len(regexp_extract_all(html, 'class="ad"')) AS n FROM pages)
SELECT page_id, denied, n FROM x WHERE (denied AND n > 0) OR (NOT denied AND n <> 1)""")
def _(spark, sf):
    p = table(spark, sf, "pages")
    return audit.ad_policy(p, p.where(corpus.host_of().startswith("m.")), "page_id", 'class="ad"')


@query("guide_links", """WITH @RICH@, @PATHS@, @LINKS@, good AS (SELECT DISTINCT page_id FROM links JOIN known k ON k.host = links.host AND k.target = href)
SELECT page_id, 'links to no registered page' AS finding FROM pages WHERE page_id NOT IN (SELECT page_id FROM good)
UNION ALL SELECT page_id, 'links to another website' FROM rich WHERE regexp_matches(html, 'href="(?:https?:)?//')""")
def _(spark, sf):
    p = rich(spark, sf)
    return audit.guide_link_findings(p, audit.known_paths(p))


@query("version_uniform", """WITH @RICH@, s AS (SELECT page_id, unnest(list_distinct(regexp_extract_all(html, '"[^"]*\\.(?:css|js)\\?v=([0-9]+)"', 1))) AS stamp FROM rich)
SELECT stamp, count(*) AS pages FROM s GROUP BY stamp""")
def _(spark, sf):
    return audit.version_counts(rich(spark, sf))


@query("hostile_markup", """SELECT source, count(*) AS docs, count(*) FILTER (regexp_matches(text, '(?i)<script|<iframe|<[^>]*\\son[a-z]+\\s*=|javascript:')) AS hostile,
  CAST(sum(length(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;')) - length(text)) AS BIGINT) AS escaped_growth
FROM (SELECT source, CASE WHEN doc_id % 6 = 0 THEN text || ' <img src=x onerror=alert(1)>' ELSE text END AS text FROM documents) GROUP BY source""")
def _(spark, sf):
    d = table(spark, sf, "documents")
    text = F.when(F.col("doc_id") % 6 == 0, F.concat("text", F.lit(" <img src=x onerror=alert(1)>"))).otherwise(F.col("text"))
    d = d.select("source", text.alias("text"))
    return d.groupBy("source").agg(
        F.count(F.lit(1)).alias("docs"), F.count(F.when(F.col("text").rlike(audit.HOSTILE), 1)).alias("hostile"),
        F.sum(F.length(T.escape_html("text")) - F.length("text")).alias("escaped_growth"),
    )


@query("page_weight", """WITH s AS (SELECT @HOST@ AS host, octet_length(encode(html)) AS a, octet_length(encode(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '>\\s+<', '><', 'g'))) AS b
  FROM (SELECT url, replace(html, '><', '>  <') AS html FROM pages))
SELECT host, count(*) AS pages, CAST(sum(a) AS BIGINT) AS raw_bytes, CAST(sum(b) AS BIGINT) AS squeezed_bytes, round(100.0e0 * (sum(a) - sum(b)) / sum(a), 6) AS saved_pct FROM s GROUP BY host""")
def _(spark, sf):
    spaced = table(spark, sf, "pages").select("url", F.replace("html", F.lit("><"), F.lit(">  <")).alias("html"))
    return rounded(corpus.page_weight(spaced), 6, "saved_pct")


@query("url_params", """WITH q AS (SELECT @HOST@ AS host, unnest(string_split(regexp_extract(url || CASE WHEN contains(url, '?') OR contains(url, '#') THEN '' ELSE '?q=a%20b%26c&empty' END, '\\?([^#]*)', 1), '&')) AS pair FROM pages)
SELECT host, url_decode(split_part(pair, '=', 1)) AS param, url_decode(CASE WHEN contains(pair, '=') THEN substr(pair, strpos(pair, '=') + 1) ELSE '' END) AS value, count(*) AS n FROM q WHERE pair <> '' GROUP BY ALL""")
def _(spark, sf):
    url = F.col("url")
    more = F.when(url.contains("?") | url.contains("#"), "").otherwise("?q=a%20b%26c&empty")
    return corpus.url_params(table(spark, sf, "pages").select(F.concat(url, more).alias("url")))


# Markers are the page's own tags: an opening tag starts a block, a closing tag ends it.
_MARKS = """m AS (SELECT page_id, unnest(x) AS mark, unnest(range(len(x))) AS seq FROM (SELECT page_id, regexp_extract_all(html, '</?(?:article|h1|ul|li|b|p|div)\\b') AS x FROM pages)),
k AS (SELECT page_id, seq, CASE WHEN mark LIKE '</%' THEN 'END' ELSE 'START' END AS kind, regexp_extract(mark, '[a-z0-9]+') AS label FROM m),
s AS (SELECT *, sum(CASE kind WHEN 'START' THEN 1 ELSE -1 END) OVER (PARTITION BY page_id ORDER BY seq) AS sm FROM k),
l AS (SELECT *, least(0, min(sm) OVER (PARTITION BY page_id ORDER BY seq)) AS low FROM s),
b AS (SELECT *, coalesce(lag(low) OVER (PARTITION BY page_id ORDER BY seq), 0) AS lowb FROM l),
v AS (SELECT *, kind = 'END' AND sm < lowb AS stray, sm - low + CASE kind WHEN 'END' THEN 1 ELSE 0 END AS lvl FROM b),
o AS (SELECT *, lag(label) OVER w AS opened, lead(kind) OVER w AS nxt FROM v WINDOW w AS (PARTITION BY page_id, stray, lvl ORDER BY seq)),
f AS (SELECT page_id, seq, label, CASE WHEN stray THEN 'closes nothing' WHEN kind = 'END' AND NOT (starts_with(opened, label) OR starts_with(label, opened)) THEN 'crosses'
  WHEN kind = 'START' AND nxt IS NULL THEN 'never closed' END AS finding FROM o)"""


@query("marker_balance", f"WITH {_MARKS} SELECT page_id, seq, label, finding FROM f WHERE finding IS NOT NULL")
def _(spark, sf):
    tags = F.regexp_extract_all("html", F.lit(r"</?(?:article|h1|ul|li|b|p|div)\b"), F.lit(0))
    marks = table(spark, sf, "pages").select("page_id", F.posexplode(tags).alias("seq", "_m")).select(
        "page_id", "seq", F.when(F.col("_m").startswith("</"), "END").otherwise("START").alias("kind"),
        F.regexp_extract("_m", "[a-z0-9]+", 0).alias("label"),
    )
    return lines.marker_audit(marks, "page_id", "seq", "kind", "label")


# Sets -----------------------------------------------------------------------------


@query("symmetric_difference", """WITH a AS (SELECT l_partkey AS part FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 40), b AS (SELECT l_partkey AS part FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' AND l_quantity <= 10)
SELECT part, 'a' AS only_in FROM (SELECT part FROM a EXCEPT SELECT part FROM b) UNION ALL SELECT part, 'b' FROM (SELECT part FROM b EXCEPT SELECT part FROM a)""")
def _(spark, sf):
    items = table(spark, sf, "lineitem")
    part = F.col("l_partkey").alias("part")
    a = items.where("l_returnflag = 'R' and l_quantity > 40").select(part)
    return sets.symmetric_difference(a, items.where("l_shipdate >= timestamp_ntz '2000-01-01' and l_quantity <= 10").select(part))


@query("subset_check", "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 48)")
def _(spark, sf):
    sold = table(spark, sf, "lineitem").where("l_quantity >= 48").select(F.col("l_partkey").alias("p_partkey"))
    return sets.missing(table(spark, sf, "part").select("p_partkey"), sold)


@query("union_findings", "SELECT rule, severity, count(*) AS n FROM (SELECT rule, severity FROM (" + SQL["h1_count"] + ") UNION ALL SELECT rule, severity FROM ("
       + SQL["title_rule"] + """) UNION ALL SELECT 'hostile', 'warning' FROM documents WHERE regexp_matches(text, '(?i)<script|<iframe|<[^>]*\\son[a-z]+\\s*=|javascript:')) GROUP BY ALL""")
def _(spark, sf):
    pages = rich(spark, sf)
    docs = audit.audit(table(spark, sf, "documents"), [audit.hostile_rule], "doc_id", "text")
    return sets.verdict(audit.audit(pages, RULES["h1_count"]), audit.audit(pages, RULES["title_rule"]), docs)


_ORDERED = "SELECT p_partkey, CASE WHEN p_partkey % 17 = 0 THEN 'missing' WHEN p_partkey % 19 = 0 THEN 'other name' END AS state FROM part WHERE p_partkey % 17 = 0 OR p_partkey % 19 = 0"


@query("same_list_in_order", _ORDERED)
def _(spark, sf):
    k = F.col("p_partkey")
    wanted = table(spark, sf, "part").select("p_partkey", "p_name", k.alias("place"))
    listed = wanted.where(k % 17 != 0).withColumn("p_name", F.when(k % 19 == 0, F.upper("p_name")).otherwise(F.col("p_name")))
    return sets.compare_ordered(wanted, listed.withColumn("place", -k), "p_partkey", "p_name", "place")


@query("same_list_other_order", "SELECT s_suppkey, 'wrong place' AS state FROM supplier WHERE s_suppkey <> (SELECT max(s_suppkey) FROM supplier) - s_suppkey")
def _(spark, sf):
    s = table(spark, sf, "supplier")
    top = s.agg(F.max("s_suppkey")).scalar()
    wanted = s.select("s_suppkey", "s_name", F.col("s_suppkey").alias("place"))
    return sets.compare_ordered(wanted, s.select("s_suppkey", "s_name", (top - F.col("s_suppkey")).alias("place")), "s_suppkey", "s_name", "place")
