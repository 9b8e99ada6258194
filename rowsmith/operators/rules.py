"""Find-and-replace by a table of rules, of any number: (find, replace_by).

No rule is a literal of the plan, and no text meets every rule. Each rule is known by its anchor, the rarest run of up to
GRAM bytes in it; the anchors are equi-joined with the same runs of the texts, so a text meets the rules whose rarest part
it holds. What is met is verified in place, and overlapping hits are settled inside the row: the leftmost one first, at one
place the longest.

1. All runs of the rules are counted over the texts, and each rule takes its rarest.
2. The texts give (text, position, run) for those positions whose run falls into a cell that an anchor has: CELLS bits in
   all, however many rules there are. The exact join on the run follows in Spark, by broadcast or by shuffle as the bytes of
   the anchors ask for.
3. A text's candidates, bounded by its own length, come back to it by the digest of the text, so copies share one list.

A rule with an empty or NULL ``find`` is none; of rules with one ``find`` the smallest ``replace_by`` counts; a NULL
``replace_by`` takes the text out. A NULL text has no hits and stays NULL.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from rowsmith.session import materialise

GRAM = 6
CELLS = 2**20
# Bytes of text looked at in one go.
SLICE = 1 << 21


def rule_table(rules: DataFrame, find: str = "find", replace_by: str = "replace_by") -> DataFrame:
    """rule (number), find, replace_by of every rule that says something, one per ``find``."""
    with_text = rules.select(F.col(find).alias("find"), F.coalesce(F.col(replace_by), F.lit("")).alias("replace_by"))
    return with_text.where("find <> ''").groupBy("find").agg(F.min("replace_by").alias("replace_by"))


def _codes(data: np.ndarray, size: int) -> np.ndarray:
    """One number for the run of ``size`` bytes at every position; runs of different sizes have different numbers."""
    n = len(data) - size + 1
    codes = np.full(max(n, 0), size << 48, np.int64)
    for k in range(size if n > 0 else 0):
        codes |= data[k : k + n].astype(np.int64) << (8 * k)
    return codes


def _cells(codes: np.ndarray) -> np.ndarray:
    mixed = codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(44)).astype(np.int64) & (CELLS - 1)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, row borders) of a text column without NULLs."""
    raw = column.cast(pa.large_binary())
    borders = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[borders[0] : borders[-1]]
    return data, borders - borders[0]


def _rule_runs(known: DataFrame) -> DataFrame:
    """find, code, at for every run of min(GRAM, length) bytes in every rule."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for find in batch.column("find").to_pylist():
                data = np.frombuffer(find.encode(), np.uint8)
                codes = _codes(data, min(GRAM, len(data)))
                yield pa.RecordBatch.from_arrays([pa.array([find] * len(codes)), pa.array(codes), pa.array(np.arange(len(codes)))], names=["find", "code", "at"])

    return known.select("find").mapInArrow(cut, "find string, code long, at long")


def _wanted(codes: DataFrame) -> tuple[bytes, list[int]]:
    """The cells that some code falls into, one bit each, and the run sizes that occur: small whatever the rules are."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(_cells(code)), pa.array(code >> 48)], names=["cell", "size"])

    found = codes.select("code").mapInArrow(place, "cell long, size long").distinct()
    marked, sizes = np.zeros(CELLS, bool), set()
    # At most CELLS x GRAM rows of two numbers, however many rules there are.
    for row in found.toLocalIterator():
        marked[row.cell] = True
        sizes.add(row.size)
    return np.packbits(marked).tobytes(), sorted(sizes)


def _positions(data: np.ndarray, borders: np.ndarray, marked: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, position in the row, code) wherever a run inside one row falls into a marked cell."""
    for start in range(0, len(data), SLICE):
        codes = _codes(data[start : start + SLICE + size - 1], size)
        at = np.flatnonzero(marked[_cells(codes)])
        place = at + start
        row = np.searchsorted(borders, place, "right") - 1
        inside = place + size <= borders[row + 1]
        yield row[inside], (place - borders[row])[inside], codes[at[inside]]


def _run_counts(texts: DataFrame, wanted: tuple[bytes, list[int]]) -> DataFrame:
    """code, n of the runs of the texts that may be a rule's."""
    cells, sizes = wanted

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(np.frombuffer(cells, np.uint8)).astype(bool)
        for batch in batches:
            data, borders = _bytes_of(batch.column(0))
            for size in sizes:
                for _, _, codes in _positions(data, borders, marked, size):
                    each, n = np.unique(codes, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(each), pa.array(n.astype(np.int64))], names=["code", "n"])

    return texts.mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def anchors(known: DataFrame, texts: DataFrame) -> DataFrame:
    """find, replace_by, code, at: the rarest run of every rule over ``texts`` (one column), the first of equally rare."""
    runs = materialise(_rule_runs(known), "rule-runs")
    counted = _run_counts(texts, _wanted(runs))
    rarest = runs.join(counted, "code", "left").groupBy("find").agg(F.min_by(F.struct("code", "at"), F.struct(F.coalesce("n", F.lit(0)), "at")).alias("a"))
    return known.join(rarest.select("find", "a.*"), "find")


def candidates(docs: DataFrame, known: DataFrame, text: str) -> DataFrame:
    """digest, hits: for every text that holds an anchor, the (start, find, replace_by) that may stand there, in bytes."""
    texts = docs.select(F.col(text).alias("t")).where("t <> ''")
    anchored = materialise(anchors(known, texts), "anchors")
    cells, sizes = _wanted(anchored)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(np.frombuffer(cells, np.uint8)).astype(bool)
        for batch in batches:
            data, borders = _bytes_of(batch.column("t"))
            for size in sizes:
                for row, at, codes in _positions(data, borders, marked, size):
                    yield pa.RecordBatch.from_arrays([batch.column("digest").take(pa.array(row)), pa.array(at), pa.array(codes)], names=["digest", "pos", "code"])

    seen = texts.select(F.unhex(F.md5("t")).alias("digest"), "t").mapInArrow(look, "digest binary, pos long, code long")
    met = seen.join(anchored, "code").select("digest", F.struct((F.col("pos") - F.col("at")).alias("start"), "find", "replace_by").alias("hit"))
    return met.where("hit.start >= 0").groupBy("digest").agg(F.collect_set("hit").alias("hits"))


def _settled(text: bytes, hits: list[dict]) -> list[tuple[int, bytes, dict]]:
    """The hits that really stand there, leftmost first and longest first at one place, none over another."""
    real = [(h["start"], find, h) for h in hits if text.startswith(find := h["find"].encode(), h["start"])]
    real.sort(key=lambda hit: (hit[0], -len(hit[1])))
    kept, end = [], 0
    for hit in real:
        if hit[0] >= end:
            kept.append(hit)
            end = hit[0] + len(hit[1])
    return kept


def _met(docs: DataFrame, rules: DataFrame, text: str) -> DataFrame:
    """The rows of ``docs`` as one field beside their text and candidates (NULL without any)."""
    found = materialise(candidates(docs, materialise(rule_table(rules), "rules"), text), "candidates").withColumnRenamed("digest", "own")
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("t"), F.unhex(F.md5(F.col(text))).alias("digest"))
    return rows.join(found, F.col("digest") == F.col("own"), "left").select("row", "t", "hits")


def apply_rules(docs: DataFrame, rules: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the text rewritten in one pass, and edits and changed. What a rule put in is not searched again."""
    names = docs.columns
    if {"edits", "changed"} & set(names):
        raise ValueError("the table already has a column edits or changed")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, edits = [], []
            for whole, hits in zip(batch.column("t"), batch.column("hits")):
                whole, hits = whole.as_py(), hits.as_py()
                kept = _settled(raw := whole.encode(), hits) if hits else []
                if kept:
                    parts, end = [], 0
                    for start, find, hit in kept:
                        parts += [raw[end:start], hit["replace_by"].encode()]
                        end = start + len(find)
                    whole = b"".join([*parts, raw[end:]]).decode()
                made.append(whole)
                edits.append(len(kept))
            row = batch.column("row")
            columns = [pa.array(made, pa.string()) if name == text else row.field(k) for k, name in enumerate(names)]
            changed = pa.array([bool(n) and a != b for n, a, b in zip(edits, made, batch.column("t").to_pylist())])
            yield pa.RecordBatch.from_arrays([*columns, pa.array(edits, pa.int64()), changed], names=[*names, "edits", "changed"])

    kinds = [*docs.schema.fields, ST.StructField("edits", ST.LongType()), ST.StructField("changed", ST.BooleanType())]
    return _met(docs, rules, text).mapInArrow(rewrite, ST.StructType(kinds))


def rule_hits(docs: DataFrame, rules: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, find, replace_by, hits: how often each rule stands in each document as written, each rule by itself."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, (whole, hits) in enumerate(zip(batch.column("t"), batch.column("hits"))):
                raw = whole.as_py().encode()
                by_rule = {}
                for hit in hits.as_py():
                    by_rule.setdefault((hit["find"], hit["replace_by"]), []).append(hit)
                for (find, replace_by), own in by_rule.items():
                    if kept := _settled(raw, own):
                        rows.append((k, find, replace_by, len(kept)))
            at, find, replace_by, n = zip(*rows) if rows else ((), (), (), ())
            named = batch.column("row").field(0).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([named, pa.array(find, pa.string()), pa.array(replace_by, pa.string()), pa.array(n, pa.int64())], names=[key, "find", "replace_by", "hits"])

    met = _met(docs.select(key, text), rules, text).where("hits is not null")
    return met.mapInArrow(count, ST.StructType([docs.schema[key], *[ST.StructField(n, ST.StringType()) for n in ("find", "replace_by")], ST.StructField("hits", ST.LongType())]))
