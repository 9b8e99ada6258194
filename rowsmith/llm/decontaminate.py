"""Benchmark decontamination: short test items found inside long documents, on built-in expressions only.

Items are partitioned by size: an item of ``m`` shingles has the size class floor(log2(m)) and a MinHash sketch of its
``m - need + 1`` smallest shingle hashes, ``need = ceil(threshold * m)``. A document that holds ``need`` shingles of the
item cannot miss all of that sketch, so a probe of the sketches finds every pair at the threshold, whatever the length
of the document; no signature of a long document has to resemble that of a short item. Each class has its own bound on
hash values; document shingles above the largest bound are not even probed. Candidates are verified by exact
containment of the shingles as text.

Sketches are probed by a broadcast join in blocks of at most BLOCK_ROWS rows; a larger benchmark takes more blocks.
Defined results: NULL and empty texts and texts of under five words hold nothing; items of under five words have no
shingle and match nothing; items that share an id are judged one by one and reported by the best; rows that share a
document id are reported under that id, and dropped each for its own text; an empty table of either kind gives no pairs;
very long texts are probed whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import SHINGLE, SIMILARITY, content_words, let, shingle_hashes, shingle_strings, text_of
from rowsmith.session import materialise

BLOCK_ROWS = 1_000_000


def sketches(items: DataFrame, item_id: str, text: str, threshold: float, n: int) -> DataFrame:
    """One row per sketch value: hash, block key, size class, and what verification needs."""
    words = content_words(text_of(items, text))
    sized = items.select(F.col(item_id).alias("item"), F.array_distinct(shingle_strings(words, n)).alias("want"), F.sort_array(F.array_distinct(shingle_hashes(words, n))).alias("hashes"))
    sized = sized.where(F.size("want") > 0).withColumn("need", F.ceil(F.size("want") * F.lit(threshold) - F.lit(1e-9)).cast("int"))
    size_class = F.floor(F.log2(F.size("want"))).cast("int")
    sketch = F.slice("hashes", 1, F.greatest(F.size("hashes") - F.col("need") + 1, F.lit(1)))
    return sized.select("item", "want", "need", size_class.alias("size_class"), F.explode(sketch).alias("hash"))


def _held(docs: DataFrame, items: DataFrame, keys: dict[str, Column], threshold: float, n: int, text: str, item_id: str, item_text: str) -> DataFrame:
    """The keys of a document, item, and the best n_item_shingles, n_shared and containment, for pairs at the threshold."""
    table = materialise(sketches(items, item_id, item_text, threshold, n), "sketches")
    bounds = table.groupBy("size_class").agg(F.max("hash").alias("bound"), F.count(F.lit(1)).alias("rows"))
    rows, bound = bounds.agg(F.sum("rows"), F.max("bound")).first()
    # Without a sketch no hash is low enough.
    rows, bound = rows or 0, -(2**63) if bound is None else bound

    def probed(words: Column) -> Column:
        return F.array_distinct(F.filter(shingle_hashes(words, n), lambda h: h <= bound))

    taken = docs.select(*[c.alias(k) for k, c in keys.items()], content_words(text_of(docs, text)).alias("words"))
    probes = taken.select(*keys, "words", F.explode(let(F.col("words"), probed)).alias("hash"))
    blocks = max(1, -(-rows // BLOCK_ROWS))

    def verified(block: int) -> DataFrame:
        part = table.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block) if blocks > 1 else table
        # At most about BLOCK_ROWS rows by the count above.
        found = probes.join(F.broadcast(part), "hash")
        shared = F.size(F.array_intersect("want", shingle_strings(F.col("words"), n)))
        return found.select(*keys, "item", "need", F.size("want").cast("long").alias("n_item_shingles"), shared.cast("long").alias("n_shared")).where(F.col("n_shared") >= F.col("need"))

    pairs = reduce(DataFrame.unionByName, [verified(b) for b in range(blocks)])
    best = pairs.groupBy(*keys, "item").agg(F.max(F.struct((F.col("n_shared") / F.col("n_item_shingles")).alias("c"), "n_item_shingles", "n_shared")).alias("b"))
    return best.select(*keys, "item", "b.n_item_shingles", "b.n_shared", F.col("b.c").alias("containment"))


def find(
    docs: DataFrame, items: DataFrame, threshold: float = SIMILARITY, n: int = SHINGLE,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """doc_id, item_id, n_item_shingles, n_shared, containment of every pair at or above ``threshold``."""
    held = _held(docs, items, {"doc": docs[doc_id]}, threshold, n, text, item_id, item_text)
    return held.withColumnsRenamed({"doc": doc_id, "item": item_id})


def drop_leaks(
    docs: DataFrame, items: DataFrame, threshold: float = SIMILARITY, n: int = SHINGLE,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``docs`` without those that hold an item; columns as they were.

    A row goes for its own text: clean rows that share the id of a leaking one, or have none as it has none, stay.
    """
    digest = F.md5(text_of(docs, text))
    held = _held(docs, items, {"_leak_id": docs[doc_id], "_leak_digest": digest}, threshold, n, text, item_id, item_text)
    # Written, so that Catalyst knows its size and broadcasts it only if it is small.
    leaked = materialise(held.select("_leak_id", "_leak_digest").distinct(), "leaks")
    same = docs[doc_id].eqNullSafe(leaked["_leak_id"]) & (digest == leaked["_leak_digest"])
    return docs.join(leaked, same, "left_anti")
