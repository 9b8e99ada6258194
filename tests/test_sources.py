import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from rowsmith.operators import audit, clean, lines
from rowsmith.sources import readers, writers


def put(path, text):
    path.write_bytes(text.encode() if isinstance(text, str) else text)
    return str(path)


def test_csv_cells(spark, tmp_path):
    put(tmp_path / "a.csv", 'id,t\n1,"x ""q"" y"\n2,"two\nlines, one cell"\n')
    got = readers.read_csv_table(spark, str(tmp_path / "a.csv"), "id int, t string").collect()
    assert [(r.id, r.t) for r in got] == [(1, 'x "q" y'), (2, "two\nlines, one cell")]


def test_json_array_flattened(spark, tmp_path):
    put(tmp_path / "a.json", '[{"id": 1, "a": {"b": {"c": "x"}, "d": 2}, "l": [1, 2]}, {"id": 2, "a": null}]')
    df = readers.read_json_array(spark, str(tmp_path / "a.json"), "id int, a struct<b: struct<c: string>, d: int>, l array<int>")
    flat = readers.flatten(df)
    assert flat.columns == ["id", "a.b.c", "a.d", "l"]
    assert [tuple(r) for r in flat.orderBy("id").collect()] == [(1, "x", 2, "[1,2]"), (2, None, None, None)]
    writers.write_csv(df, str(tmp_path / "out"))
    back = readers.read_csv_table(spark, str(tmp_path / "out"), "id int, c string, d int, l string")
    assert back.where("id = 1").first().l == "[1,2]"


def test_rates_file(spark, tmp_path):
    codes = {**{f"A{chr(65 + i)}X": 1.5 for i in range(20)}, "USD": 1.1, "INR": 101.9}
    body = ", ".join(f'"{c}": {r}' for c, r in codes.items())
    put(tmp_path / "good", '/* a note */\nwindow.RATES = {"date": "2026-11-27", "base": "EUR", "rates": {' + body + "}};\n")
    rows = {r.currency: (r.rate_date, r.rate) for r in readers.read_rates(spark, str(tmp_path / "good")).collect()}
    assert rows["EUR"] == (dt.date(2026, 11, 27), 1.0) and rows["INR"][1] == 101.9 and len(rows) == 23
    assert audit.rates_findings(readers.read_rate_snapshots(spark, str(tmp_path / "good"))).isEmpty()
    put(tmp_path / "bad", '{"date": "2026-02-30", "base": "USD", "rates": {"usd": 0}}')
    details = {r.detail for r in audit.rates_findings(readers.read_rate_snapshots(spark, str(tmp_path / "bad"))).collect()}
    assert details == {"no valid date", "wrong base", "too few currencies", "no USD", "no INR", "a code is not three capitals", "a rate is not above zero"}


def test_catalog_array(spark, tmp_path):
    put(tmp_path / "c.json", '[{"slug": "a-b", "name": "A", "desc": "d", "category": "Text", "keywords": ["x", "y"], "popular": true}]')
    row = readers.read_catalog(spark, str(tmp_path / "c.json"), array_file=True).first()
    assert (row.slug, row.keywords, row.popular) == ("a-b", ["x", "y"], True)


def test_sitemap(spark, tmp_path):
    put(tmp_path / "s.xml", '<?xml version="1.0"?><urlset><url><loc>http://a/b</loc><changefreq>weekly</changefreq><priority>0.8</priority></url><url><loc>http://a/c</loc></url></urlset>')
    got = readers.read_sitemap(spark, str(tmp_path / "s.xml")).orderBy("loc").collect()
    assert [tuple(r) for r in got] == [("http://a/b", "weekly", 0.8), ("http://a/c", None, None)]


def test_pages_and_templates(spark, tmp_path):
    put(tmp_path / "a.html", "<p>\na</p>")
    put(tmp_path / "_template.html", "x")
    got = readers.read_pages(spark, str(tmp_path)).collect()
    assert [(os.path.basename(r.url), r.html) for r in got] == [("a.html", "<p>\na</p>")]


def test_text_files(spark, tmp_path):
    put(tmp_path / "a.txt", "one\ntwo")
    assert [r.text for r in readers.read_documents(spark, str(tmp_path)).collect()] == ["one\ntwo"]
    assert readers.read_documents(spark, str(tmp_path), whole=False).count() == 2


def test_bytes_and_manifest(spark, tmp_path):
    put(tmp_path / "a.bin", b"abc")
    put(tmp_path / "b.bin", b"\x00\xff")
    files = readers.read_files(spark, str(tmp_path)).select(
        F.regexp_extract("path", "[^/]+$", 0).alias("name"), clean.digest(F.col("content")).alias("digest")
    )
    listed = spark.createDataFrame(
        [("a.bin", "BA7816BF8F01CFEA414140DE5DAE2223B00361A396177A9CB410FF61F20015AD"), ("c.bin", "00")], "name string, digest string"
    )
    assert dict(map(tuple, clean.verify_manifest(files, listed).collect())) == {"a.bin": "ok", "b.bin": "unlisted", "c.bin": "missing"}


def test_lines_written_in_order(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"item{(i * 37) % 500}\nitem{(i * 91) % 500}") for i in range(300)], "doc_id bigint, text string")
    rows = lines.explode_lines(docs)
    out = str(tmp_path / "lines")
    writers.write_lines(rows, out, lines.sort_order("az"))
    written = []
    for name in sorted(f for f in os.listdir(out) if f.startswith("part-")):
        written += open(f"{out}/{name}").read().split("\n")[:-1]
    numbers = [int(x[4:]) for x in written]
    assert len(numbers) == 600 and numbers == sorted(numbers)


def test_rates_appended_once_per_date(spark, tmp_path):
    path = str(tmp_path / "t")
    mk = lambda *rows: spark.createDataFrame([(dt.date(2024, 1, d), c, r) for d, c, r in rows], "rate_date date, currency string, rate double")
    writers.append_rates(mk((1, "USD", 1.0), (2, "USD", 2.0)), path)
    for _ in range(2):
        writers.append_rates(mk((2, "USD", 9.0), (3, "USD", 3.0)), path)
    got = readers.read_rate_history(spark, path).select(F.dayofmonth("rate_date"), "rate").collect()
    assert sorted(map(tuple, got)) == [(1, 1.0), (2, 9.0), (3, 3.0)]


BROKEN = 'id,lang,n\n1,en,3\n2,de,abc\n3,fr\n4,es,5,6\n5,"x ""y"" z",\n6,"two\nlines",7\n7,"never closed,3\n8,en,4\n'


def test_csv_quarantine(spark, tmp_path):
    put(tmp_path / "a.csv", BROKEN)
    rows, held = readers.read_csv_checked(spark, str(tmp_path), "id int, lang string, n int")
    assert sorted(tuple(r) for r in rows.collect()) == [(1, "en", 3), (5, 'x "y" z', None), (6, "two\nlines", 7)]
    # A quote that is never closed takes the rest of its file with it, into one record.
    assert sorted(r.record for r in held.collect()) == ["2,de,abc", "3,fr", "4,es,5,6", '7,"never closed,3\n8,en,4']
    assert {r.file.rsplit("/", 1)[1] for r in held.collect()} == {"a.csv"}


def test_csv_quarantine_line_by_line_adds_up(spark, tmp_path):
    put(tmp_path / "a.csv", BROKEN)
    rows, held = readers.read_csv_checked(spark, str(tmp_path), "id int, lang string, n int", multi_line=False)
    assert rows.count() + held.count() == len(BROKEN.splitlines()) - 1
    assert sorted(r.id for r in rows.collect()) == [1, 5, 8]


def test_json_records_of_mixed_shape(spark, tmp_path):
    put(tmp_path / "a.json", '[{"id":1,"size":3,"box":{"kind":"x","w":1.5}},{"id":2,"size":"12","tags":["a",1],"odd key":true,"n":null},{"id":3,"box":null}]')
    put(tmp_path / "b.json", '[{"id":4,"size":{"a":1}}]')
    put(tmp_path / "c.json", '{"id":5}')
    records = readers.read_json_array(spark, str(tmp_path))
    assert records.count() == 5
    flat = readers.flatten_variant(records)
    assert sorted(flat.columns) == ["box.kind", "box.w", "id", "n", "odd key", "size", "tags"]
    rows = {r.id: r.asDict() for r in flat.collect()}
    assert [rows[k]["size"] for k in range(1, 6)] == ["3", '"12"', None, '{"a":1}', None]
    assert rows[2]["tags"] == '["a",1]' and rows[2]["odd key"] is True and rows[1]["box.kind"] == "x" and float(rows[1]["box.w"]) == 1.5


def test_records_that_are_no_objects(spark, tmp_path):
    put(tmp_path / "a.json", "[1, 2]")
    with pytest.raises(ValueError, match="no objects"):
        readers.flatten_variant(readers.read_json_array(spark, str(tmp_path)))
