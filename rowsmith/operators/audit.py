"""Rules over a page corpus. Each rule is an expression on one page's markup, so any
number of rules costs one scan; only rules that compare pages with one another shuffle.

A finding is (rule, severity, detail) next to the page's key. A rule is called with the
markup column and a dict of parts: costly pieces several findings need (a title, parsed
structured data) are put there, worked out once per page and shared between rules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.functions import text as T
from rowsmith.operators.corpus import host_of

def finding(rule: str, severity: str, when: Column, detail: Column | str) -> Column:
    shown = F.lit(detail) if isinstance(detail, str) else detail.cast("string")
    row = F.struct(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), shown.alias("detail"))
    return F.when(when, row)


Rule = Callable[[Column, dict[str, Column]], list[Column]]


def part(parts: dict[str, Column], name: str, column: Column) -> Column:
    parts[name] = column
    return F.col(name)


def placeholder_rule(phrases: list[str]) -> Rule:
    return lambda html, parts: [finding("placeholder", "error", html.contains(p), f"still holds {p}") for p in phrases]


def _inside(html: Column, pattern: str) -> tuple[Column, Column]:
    """(is it there, trimmed text with entities decoded) for the first match's group."""
    return html.rlike(pattern), T.js_trim(T.unescape_html(F.regexp_extract(html, pattern, 1)))


def title_rule(longest: int = 62) -> Rule:
    def rule(html: Column, parts: dict[str, Column]) -> list[Column]:
        there, shown = _inside(html, r"(?s)<title>(.*?)</title>")
        there, size = part(parts, "_has_title", there), part(parts, "_title_size", F.length(shown))
        return [
            finding("title", "error", ~there, "no title"),
            finding("title", "error", there & (size > longest), F.concat(F.lit("length "), size.cast("string"))),
        ]

    return rule


def description_rule(shortest: int = 110, longest: int = 165) -> Rule:
    def rule(html: Column, parts: dict[str, Column]) -> list[Column]:
        there, shown = _inside(html, r'(?s)<meta name="description" content="(.*?)"')
        there, size = part(parts, "_has_desc", there), part(parts, "_desc_size", F.length(shown))
        return [
            finding("description", "error", ~there, "no description"),
            finding("description", "error", there & ~size.between(shortest, longest), F.concat(F.lit("length "), size.cast("string"))),
        ]

    return rule


def heading_rule(html: Column, parts: dict[str, Column]) -> list[Column]:
    n = part(parts, "_h1_count", F.regexp_count(html, F.lit("<h1>")))
    return [finding("h1", "error", n != 1, F.concat(n.cast("string"), F.lit(" headings")))]


def canonical_rule(html: Column, parts: dict[str, Column]) -> list[Column]:
    return [finding("canonical", "error", ~html.contains('rel="canonical"'), "no canonical tag")]


JSON_LD = r'(?s)<script type="application/ld\+json">(.*?)</script>'


def json_ld_rule(html: Column, parts: dict[str, Column]) -> list[Column]:
    blocks = part(parts, "_blocks", F.regexp_extract_all(html, F.lit(JSON_LD), F.lit(1)))
    bad = F.exists(blocks, lambda b: F.try_parse_json(b).isNull())
    return [
        finding("json_ld", "error", F.size(blocks) == 0, "no structured data"),
        finding("json_ld", "error", bad, "invalid structured data"),
    ]


def _blocks_of(html: Column, kind: str) -> Column:
    # The structured-data fields the rules compare.
    fields = "`@type` string, headline string, name string, url string, mainEntityOfPage string, datePublished string, dateModified string"
    parsed = F.transform(F.regexp_extract_all(html, F.lit(JSON_LD), F.lit(1)), lambda b: F.from_json(b, fields))
    return F.filter(parsed, lambda a: a["@type"] == kind)


def _canonical(html: Column) -> Column:
    pattern = r'<link rel="canonical" href="([^"]+)"'
    return F.when(html.rlike(pattern), F.regexp_extract(html, pattern, 1))


def article_rule(html: Column, parts: dict[str, Column]) -> list[Column]:
    """Exactly one Article, saying what the page itself says."""
    articles = part(parts, "_articles", _blocks_of(html, "Article"))
    one = F.size(articles) == 1
    a = F.get(articles, F.lit(0))
    there, raw = html.rlike(r"(?s)<h1>(.*?)</h1>"), F.regexp_extract(html, r"(?s)<h1>(.*?)</h1>", 1)
    heading = part(parts, "_heading", F.when(there, T.unescape_html(T.js_trim(F.regexp_replace(raw, r"\s+", " ")))))
    canon = part(parts, "_canonical", _canonical(html))
    iso = r"^\d{4}-\d{2}-\d{2}$"
    day = lambda c: F.when(c.rlike(iso), F.try_to_date(c, "yyyy-MM-dd"))
    published, modified = day(a["datePublished"]), day(a["dateModified"])
    stamp = F.regexp_extract(html, r"Updated (\d{1,2} [A-Z][a-z]+ \d{4})", 1)
    printed = part(parts, "_printed", F.try_to_date(stamp, "d MMMM yyyy"))
    dated = published.isNotNull() & modified.isNotNull()
    return [
        finding("article", "error", ~one, F.concat(F.size(articles).cast("string"), F.lit(" articles"))),
        finding("article", "error", one & ~a["headline"].eqNullSafe(heading), "headline is not the heading"),
        finding(
            "article", "error",
            one & (canon.isNull() | ~a["url"].eqNullSafe(canon) | ~a["mainEntityOfPage"].eqNullSafe(canon)),
            "url is not the canonical address",
        ),
        finding("article", "error", one & ~dated, "dates are not YYYY-MM-DD"),
        finding("article", "error", one & dated & (published > modified), "modified before published"),
        finding("article", "error", one & dated & ~modified.eqNullSafe(printed), "modified is not the printed date"),
    ]


def site_block_rule(html: Column, parts: dict[str, Column]) -> list[Column]:
    """Exactly one WebSite block; its name starts the title, its url is canonical."""
    sites = part(parts, "_sites", _blocks_of(html, "WebSite"))
    canon = part(parts, "_canonical", _canonical(html))
    one = F.size(sites) == 1
    s = F.get(sites, F.lit(0))
    title = T.unescape_html(F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1))
    named = (F.coalesce(s["name"], F.lit("")) != "") & title.startswith(s["name"])
    return [
        finding("site_block", "error", ~one, F.concat(F.size(sites).cast("string"), F.lit(" site blocks"))),
        finding("site_block", "error", one & ~named, "name does not start the title"),
        finding("site_block", "error", one & named & ~s["url"].eqNullSafe(canon), "url is not canonical"),
    ]


def policy_rule(phrase: str = "Content-Security-Policy") -> Rule:
    return lambda html, parts: [finding("policy", "error", ~html.contains(phrase), f"no {phrase}")]


# Calls that leave the page.
NETWORK_CALLS = r"\bfetch\(|XMLHttpRequest|sendBeacon|new WebSocket|EventSource|importScripts"


def network_rule(html: Column, parts: dict[str, Column]) -> list[Column]:
    return [finding("network", "error", html.rlike(NETWORK_CALLS), F.regexp_extract(html, f"({NETWORK_CALLS})", 1))]


def notice_rule(phrases: list[str]) -> Rule:
    def rule(html: Column, parts: dict[str, Column]) -> list[Column]:
        lacking = part(parts, f"_lacking_{len(parts)}", F.array_compact(F.array(*[F.when(~html.contains(p), F.lit(p)) for p in phrases])))
        return [finding("notice", "error", F.size(lacking) > 0, F.concat(F.lit("lacks "), F.array_join(lacking, ", ")))]

    return rule


def version_stamps(html: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(html, F.lit(r'"[^"]*\.(?:css|js)\?v=(\d+)"'), F.lit(1)))


# Markup that can run code.
HOSTILE = r"(?i)<script|<iframe|<[^>]*\son[a-z]+\s*=|javascript:"


def hostile_rule(text: Column, parts: dict[str, Column]) -> list[Column]:
    return [finding("hostile", "warning", text.rlike(HOSTILE), F.regexp_extract(text, f"({HOSTILE})", 1))]


def audit(pages: DataFrame, rules: list[Rule], key: str = "page_id", html: str = "html") -> DataFrame:
    """All rules over all pages in one pass: (key, rule, severity, detail)."""
    parts: dict[str, Column] = {}
    found = [f for rule in rules for f in rule(F.col(html), parts)]
    ready = pages.select(key, html, *[column.alias(name) for name, column in parts.items()])
    return ready.select(key, F.inline(F.array_compact(F.array(*found))))


# Rules that look beyond one page


def page_path(url: Column) -> Column:
    """Path of an address without host, query and fragment."""
    path = F.regexp_extract(url, r"^[a-z]+://[^/?#]+([^?#]*)", 1)
    return F.when(path == "", "/").otherwise(path)


def resolve(base: Column, href: Column) -> Column:
    """An href against the path of the page it stands on, dots folded away."""
    joined = F.when(href.startswith("/"), href).otherwise(F.concat(F.regexp_extract(base, r"^(.*/)", 1), href))
    empty = F.array().cast("array<string>")

    def walk(done: Column, part: Column) -> Column:
        return (
            F.when(part.isin("", "."), done)
            .when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
            .otherwise(F.array_append(done, part))
        )

    return F.concat(F.lit("/"), F.array_join(F.aggregate(F.split(joined, "/"), empty, walk), "/"))


def links(pages: DataFrame) -> DataFrame:
    """Internal links, script files and workers: (page_id, host, href, target path)."""
    plain = F.regexp_extract_all("html", F.lit(r'(?:href|src)="([^"#?:]+)(?:\?[^"]*)?"'), F.lit(1))
    workers = F.regexp_extract_all("html", F.lit(r"""new (?:Shared)?Worker\(["']([^"'#?:]+)"""), F.lit(1))
    hrefs = F.explode(F.concat(plain, workers))
    out = pages.select("page_id", host_of().alias("host"), page_path(F.col("url")).alias("_base"), hrefs.alias("href"))
    out = out.where(~F.col("href").startswith("//"))
    return out.select("page_id", "host", "href", resolve(F.col("_base"), F.col("href")).alias("target"))


def known_paths(pages: DataFrame) -> DataFrame:
    path = page_path(F.col("url"))
    return pages.select(host_of().alias("host"), resolve(path, path).alias("target")).distinct()


def dead_links(pages: DataFrame) -> DataFrame:
    """Links to a path no page of the same host has."""
    return links(pages).join(known_paths(pages), ["host", "target"], "left_anti").select("page_id", "host", "href")


def external_hosts(pages: DataFrame, own: list[str] = []) -> DataFrame:
    """Hosts linked to, and how many pages link there."""
    host = F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(r'href="(?:https?:)?//([^/"]+)'), F.lit(1))))
    out = pages.select("page_id", host.alias("host"))
    if own:
        out = out.where(~F.col("host").isin(own))
    return out.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))


def foreign_scripts(pages: DataFrame, allowed: list[str] = []) -> DataFrame:
    """Files loaded from elsewhere that are not on the allow-list."""
    src = F.explode(F.regexp_extract_all("html", F.lit(r'src="((?:https?:)?//[^"]+)"'), F.lit(1)))
    out = pages.select("page_id", src.alias("src"))
    return out.where(~F.col("src").isin(allowed)) if allowed else out


def uncovered(entities: DataFrame, key: str, listing: DataFrame, loc: str) -> DataFrame:
    """Entities the listing does not name."""
    return entities.join(listing.select(F.col(loc).alias(key)), key, "left_anti")


def stale_counts(shown: DataFrame, actual: DataFrame, key: str, text: str, pattern: str) -> DataFrame:
    """Places where the number printed in ``text`` is not the computed ``n``."""
    printed = F.regexp_extract(text, pattern, 1).try_cast("long")
    both = shown.select(key, printed.alias("printed")).join(actual.select(key, "n"), key, "left")
    return both.withColumn("n", F.coalesce("n", F.lit(0))).where(~F.col("printed").eqNullSafe(F.col("n")))


def tick_mismatches(marked: DataFrame, key: str, flag: str, members: DataFrame) -> DataFrame:
    """Rows whose mark disagrees with whether they are a member."""
    inside = members.select(key).distinct().withColumn("_in", F.lit(True))
    both = marked.select(key, flag).join(inside, key, "left")
    return both.withColumn("is_member", F.coalesce("_in", F.lit(False))).drop("_in").where(F.col(flag) != F.col("is_member"))


def ad_policy(pages: DataFrame, denied: DataFrame, key: str, marker: str) -> DataFrame:
    """Pages on the deny-list must not carry the marker; every other page exactly once."""
    n = F.regexp_count("html", F.lit(marker)).cast("long")
    off = denied.select(key).distinct().withColumn("_denied", F.lit(True))
    both = pages.select(key, n.alias("n")).join(off, key, "left").withColumn("denied", F.coalesce("_denied", F.lit(False)))
    wrong = (F.col("denied") & (F.col("n") > 0)) | (~F.col("denied") & (F.col("n") != 1))
    return both.where(wrong).select(key, "denied", "n")


def guide_link_findings(pages: DataFrame, registered: DataFrame) -> DataFrame:
    """Pages that link to no registered (host, target) path, and pages that name a foreign site."""
    good = links(pages).join(registered, ["host", "target"], "left_semi").select("page_id").distinct()
    lonely = pages.select("page_id").join(good, "page_id", "left_anti").withColumn("finding", F.lit("links to no registered page"))
    foreign = pages.where(F.col("html").rlike(r'href="(?:https?:)?//')).select(
        "page_id", F.lit("links to another website").alias("finding")
    )
    return lonely.unionByName(foreign)


def version_counts(pages: DataFrame) -> DataFrame:
    """Every asset version and the pages that carry it; more than one row is a finding."""
    return pages.select("page_id", F.explode(version_stamps(F.col("html"))).alias("stamp")).groupBy("stamp").agg(
        F.count(F.lit(1)).alias("pages")
    )


def unexpected_fields(raw: Column, known: tuple[str, ...] = ("date", "base", "rates")) -> Column:
    """Top-level fields of a JSON text beyond the known ones."""
    return F.array_except(F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>")), F.array(*[F.lit(k) for k in known]))


def rates_findings(snapshot: DataFrame, fewest: int = 20, needed: tuple[str, ...] = ("USD", "INR")) -> DataFrame:
    """Checks of rate snapshots (date, base, rates map); of the JSON text too where there is a column ``raw``."""
    codes, values = F.map_keys("rates"), F.map_values("rates")
    checks = [
        finding("rates", "error", F.col("date").isNull(), "no valid date"),
        finding("rates", "error", ~F.col("base").eqNullSafe(F.lit("EUR")), "wrong base"),
        finding("rates", "error", F.size(codes) < fewest, "too few currencies"),
        *[finding("rates", "error", ~F.array_contains(codes, c), f"no {c}") for c in needed],
        finding("rates", "error", F.exists(codes, lambda c: ~c.rlike("^[A-Z]{3}$")), "a code is not three capitals"),
        finding("rates", "error", F.exists(values, lambda v: v.isNull() | (v <= 0)), "a rate is not above zero"),
    ]
    if "raw" in snapshot.columns:
        checks.append(finding("rates", "error", F.size(unexpected_fields(F.col("raw"))) > 0, "extra fields"))
    return snapshot.select(F.col("date").cast("string").alias("date"), F.inline(F.array_compact(F.array(*checks))))
