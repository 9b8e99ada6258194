"""The tag stream: quoting, comments, raw text, labels; entities by name and number."""

import html
import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from rowsmith.functions import text as T
from rowsmith.operators import tags


def pages(spark, *markup):
    return spark.createDataFrame(list(enumerate(markup)), "page_id int, html string")


def stream(spark, markup):
    return [(r.name, r.closing, r.attributes, r.text) for r in tags.tag_stream(pages(spark, markup)).orderBy("tag_no").collect()]


def test_attributes_in_every_quoting(spark):
    got = stream(spark, """<INPUT type=text ID='a>b' value="x &amp; &#39;y&#39;" disabled data-x=1 id="second"/><br/><a href=/p?q=1&amp;r>""")
    assert got == [
        ("input", False, {"type": "text", "id": "a>b", "value": "x & 'y'", "disabled": "", "data-x": "1"}, None),
        ("br", False, {}, None), ("a", False, {"href": "/p?q=1&r"}, None),
    ]


def test_comments_and_raw_text_hold_no_tags(spark):
    got = stream(spark, "<!-- <p> --><script src=x>if (a<b) '<p>'</script><style>p>b{}</style><title>A <b> c</title><textarea id=t><input></textarea><p>1 < 2</p><!-- open <i>")
    assert [(n, c, t) for n, c, _, t in got] == [
        ("script", False, "if (a<b) '<p>'"), ("style", False, "p>b{}"), ("title", False, "A <b> c"), ("textarea", False, "<input>"), ("p", False, None), ("p", True, None),
    ]


def test_a_tag_whose_quote_never_ends_is_none(spark):
    assert [n for n, *_ in stream(spark, "<b>x</b><a href=\"never")] == ["b", "b"]
    assert stream(spark, "") == [] and stream(spark, None) == [] and stream(spark, "a < b > c") == []


class Reader(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        kept = {}
        for name, value in attrs:
            kept.setdefault(name, value or "")
        self.found.append((tag, False, kept))

    def handle_endtag(self, tag):
        if tag not in ("script", "style", "title", "textarea"):
            self.found.append((tag, True, {}))


def test_random_markup_against_a_parser(spark):
    rng = random.Random(3)
    quote = lambda v: rng.choice([f'"{v}"', f"'{v}'"])
    def tag():
        name = rng.choice(["p", "div", "b", "input", "label", "h1"])
        attrs = "".join(f" {rng.choice(['id', 'for', 'CLASS', 'x-y'])}={quote(rng.choice(['a', 'b c', '&lt;&eacute;', '1>0', '']))}" for _ in range(rng.randrange(0, 4)))
        return rng.choice([f"<{name}{attrs}>", f"</{name}>", "<!-- <p id='x'> -->", "<script>var a = '<b>';</script>", "text &amp; more", "<br />"])
    markup = ["".join(tag() for _ in range(rng.randrange(0, 40))) for _ in range(150)]
    rows = tags.tag_stream(pages(spark, *markup)).orderBy("page_id", "tag_no").collect()
    got = {}
    for r in rows:
        got.setdefault(r.page_id, []).append((r.name, r.closing, {} if r.closing else r.attributes))
    for k, m in enumerate(markup):
        reader = Reader()
        reader.feed(m)
        reader.close()
        # The parser reports "<br />" as a beginning and an end.
        want = [f for f in reader.found if f != ("br", True, {})]
        assert got.get(k, []) == want


@pytest.mark.parametrize("markup,unnamed", [
    ("<label for='x'>a</label><input id='x'>", []),
    ("<label for=x>a</label><input id=x>", []),
    ("<input id=x><!-- <label for='x'>a</label> -->", ["x"]),
    ("<!-- <input id=y> --><script>'<input id=z>'</script>", []),
    ("<label>a <span><select id=s></select></span></label><input id=t>", ["t"]),
    ("<label>never closed <input id=u>", []),
    ("</label><input id=v></label><label>b</label><input id=w>", ["v", "w"]),
    ("<input TYPE='Hidden' id=h><textarea aria-label=' n '></textarea><textarea aria-label='  '></textarea>", [""]),
    ("<label>x</label><input>", [""]),
])
def test_unlabelled_controls(spark, markup, unnamed):
    assert [r.control_id for r in tags.unlabelled_controls(pages(spark, markup)).orderBy("control_no").collect()] == unnamed


def test_numbers_count_all_controls(spark):
    rows = tags.unlabelled_controls(pages(spark, "<input id=a aria-label=x><input id=b><input id=c>")).collect()
    assert sorted((r.control_no, r.control_id) for r in rows) == [(1, "b"), (2, "c")]


def test_entities_by_name_and_number(spark):
    cases = ["&amp;lt;", "&#38;amp;", "it&#8217;s", "&#x1F600;&#x1f600;", "a & b &c; &unknown; &", "&lt&gt;", "&eacute;&Eacute;&hellip;", "&#0;&#xD800;&#1114112;", "&;&#;&#x;", "no entity", "", "&nbsp;&#160;"]
    df = spark.createDataFrame([(k, c) for k, c in enumerate(cases)], "k int, t string").select("k", T.unescape_html("t").alias("u"))
    got = {r.k: r.u for r in df.collect()}
    for k, c in enumerate(cases):
        want = {"&lt&gt;": "&lt>", "&#0;&#xD800;&#1114112;": "���"}.get(c, html.unescape(c))
        assert got[k] == want, c
    assert df.select(T.unescape_html(F.lit(None).cast("string"))).first()[0] is None
