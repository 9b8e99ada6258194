"""Pages as a table of tags: one tokenising pass, then ordinary joins and windows.

Comments are one token and left out; a script, style, title or textarea is one token with its text, so markup inside them is
no tag. Attribute values may be quoted either way, or bare; names are lower-cased, the first of equal names counts, and
entities in values are decoded. A tag whose quotes are never closed is no tag. A NULL page has no tags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.functions import text as T

# Whatever stands inside a tag: quoted parts whole, so that a ">" in them does not end it.
_BODY = r"""(?:[^'">]++|"[^"]*+"|'[^']*+')*+"""
_RAW = "script|style|title|textarea"
TOKEN = rf"(?is)<!--.*?(?:-->|\z)|<({_RAW})(?=[\s/>]){_BODY}>.*?(?:</\1\s*>|\z)|</?[a-z][^\s/>]*+{_BODY}>"
ATTRIBUTE = r"""(?s)([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?"""


def _attributes(head: Column) -> Column:
    pieces = [F.regexp_extract_all(head, F.lit(ATTRIBUTE), F.lit(k)) for k in range(1, 5)]
    names = F.transform(pieces[0], F.lower)
    zipped = F.arrays_zip(names.alias("name"), *[p.alias(f"v{k}") for k, p in enumerate(pieces[1:])])
    first = F.filter(zipped, lambda a, i: F.array_position(names, a["name"]) == i + 1)
    pairs = F.transform(first, lambda a: F.struct(a["name"], T.unescape_html(F.concat(a["v0"], a["v1"], a["v2"]))))
    return F.map_from_entries(pairs)


def tag_stream(pages: DataFrame, key: str = "page_id", html: str = "html", names: tuple[str, ...] | None = None) -> DataFrame:
    """key, tag_no, name, closing, attributes (map), text (what a script, style, title or textarea holds).

    ``names`` keeps those tags only, before their attributes are taken apart; ``tag_no`` still counts every token.
    """
    tokens = F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))
    rows = pages.select(key, F.posexplode(tokens).alias("tag_no", "_t")).where(~F.startswith("_t", F.lit("<!--")))
    rows = rows.withColumn("name", F.lower(F.regexp_extract("_t", r"\A</?([A-Za-z][^\s/>]*)", 1)))
    if names is not None:
        rows = rows.where(F.col("name").isin(list(names)))
    head = F.regexp_extract("_t", rf"(?s)\A</?[A-Za-z][^\s/>]*({_BODY})>", 1)
    raw = F.col("name").isin(_RAW.split("|")) & ~F.startswith("_t", F.lit("</"))
    text = F.when(raw, F.regexp_extract("_t", rf"(?is)\A<[a-z]+{_BODY}>(.*?)(?:</[a-z]+\s*>)?\z", 1))
    rows = rows.withColumns({"closing": F.startswith("_t", F.lit("</")), "_head": head})
    return rows.select(key, F.col("tag_no").cast("long").alias("tag_no"), "name", "closing", _attributes(F.col("_head")).alias("attributes"), text.alias("text"))


def inside(stream: DataFrame, name: str, key: str = "page_id") -> DataFrame:
    """The stream with ``inside``: whether a tag stands in an open element of that name. A page is one task's work."""
    page = Window.partitionBy(key).orderBy("tag_no")
    so_far = page.rowsBetween(Window.unboundedPreceding, -1)
    step = F.when(F.col("name") != name, 0).when(F.col("closing"), -1).otherwise(1)
    opened = stream.withColumn("_opened", F.coalesce(F.sum(step).over(so_far), F.lit(0)))
    # An end without a beginning closes nothing.
    lowest = F.least(F.lit(0), F.min("_opened").over(page.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return opened.withColumn("inside", F.col("_opened") > lowest).drop("_opened")


CONTROLS = ("input", "select", "textarea")


def unlabelled_controls(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Controls that nothing names: no label for them, no aria text, no label around. Hidden ones need no name.

    key, control_no (from 0 among the controls of the page), control_id.
    """
    stream = inside(tag_stream(pages, key, html, ("label", *CONTROLS)), "label", key).where("not closing")
    said = lambda a: F.btrim(F.coalesce(F.col("attributes")[a], F.lit("")), F.lit(T.WS_CHARS))
    pointed = stream.where(F.col("name") == "label").select(key, F.col("attributes")["for"].alias("control_id")).where("control_id <> ''").distinct()
    controls = stream.where(F.col("name") != "label").withColumn("control_no", F.row_number().over(Window.partitionBy(key).orderBy("tag_no")).cast("long") - 1)
    bare = controls.where((F.lower(said("type")) != "hidden") & (said("aria-label") == "") & (said("aria-labelledby") == "") & ~F.col("inside"))
    unnamed = bare.select(key, "control_no", F.coalesce(F.col("attributes")["id"], F.lit("")).alias("control_id"))
    return unnamed.join(pointed, [key, "control_id"], "left_anti").select(key, "control_no", "control_id")
