"""N-gram Jaccard join by MinHash banding, verified on full n-gram sets.

1. Equal texts become one node (partial aggregate); a text's n-gram set is its distinct five-word shingles.
2. Band and row counts follow from the threshold and the target recall; a shuffle on band hashes finds buckets.
3. Buckets with the same members, whatever their band, are one group. A group is cut into blocks by the number of
   n-grams in it, and each pair of blocks is one unit of work, so no group has to fit one task.
4. Inside a unit a pair is verified where it first meets (its lowest common band) and nowhere else, so its link is
   counted once; links leave the unit as counts per node and one edge to the smallest node of each local component,
   never as pairs.
5. Classes are the connected components of the links.

Defined results: NULL is read as empty; texts of under five words have no n-gram and link to nothing, but equal texts
share a class; rows that share an id keep their own texts; a NULL id stands alone unless its text says otherwise; very
long texts are compared whole; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import SHINGLE, SIMILARITY, content_words, shingle_hashes, small_batches, text_of
from rowsmith.llm.components import connected
from rowsmith.session import materialise

RECALL = 0.999
MOST_HASHES = 256
SEED = 20
# N-grams in one block of a group.
BLOCK_GRAMS = 1_500_000
# From this many owned pairs in a row on, the row is intersected with all others at once.
ROW_PAIRS = 8


def band_plan(threshold: float = SIMILARITY, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows whose bands still reach ``recall`` at the threshold with ``most`` hashes."""
    best = (most, 1)
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


def band_hashes(values: np.ndarray, starts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """For each run of 64-bit shingle hashes, ``bands`` 64-bit keys; runs must not be empty."""
    rng = np.random.default_rng(SEED)
    factors = rng.integers(1, 2**32, bands * rows, dtype=np.uint32) | np.uint32(1)
    shifts = rng.integers(0, 2**32, bands * rows, dtype=np.uint32)
    mixed = values.view(np.uint64)
    x = (mixed ^ (mixed >> np.uint64(32))).astype(np.uint32)
    out = np.empty((len(starts), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(starts), band + 1, np.uint64)
        for row in range(rows):
            k = band * rows + row
            least = np.minimum.reduceat(x * factors[k] + shifts[k], starts).astype(np.uint64)
            key = (key ^ least) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        out[:, band] = key
    return out.view(np.int64)


def signatures(df: DataFrame, bands: int, rows: int, doc_id: str, text: str, n: int) -> DataFrame:
    """doc, h (digest of the text), grams (how many), bands (empty without n-grams)."""
    small_batches(df.sparkSession)
    whole = text_of(df, text)
    base = df.select(F.col(doc_id).cast("long").alias("doc"), F.unhex(F.md5(whole)).alias("h"), F.array_distinct(shingle_hashes(content_words(whole), n)).alias("v"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            values = lists.flatten().to_numpy(zero_copy_only=False)
            edges = lists.offsets.to_numpy().astype(np.int64)
            edges = edges - edges[0]
            sizes = np.diff(edges)
            full = sizes > 0
            keys = np.empty((0, bands), np.int64)
            if full.any():
                # A few texts at a time, so that the working arrays stay in the cache.
                starts, parts, first = edges[:-1][full], [], 0
                ends = edges[1:][full]
                while first < len(starts):
                    last = max(first + 1, int(np.searchsorted(ends, starts[first] + 50_000)))
                    parts.append(band_hashes(values[starts[first] : ends[last - 1]], starts[first:last] - starts[first], bands, rows))
                    first = last
                keys = np.concatenate(parts)
            offsets = np.concatenate([[0], np.cumsum(full * bands)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("h"), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))],
                names=["doc", "h", "grams", "bands"],
            )

    return base.mapInArrow(sign, "doc long, h binary, grams long, bands array<long>")


def _links(sets: list[np.ndarray], meets: np.ndarray, side: np.ndarray, group: int, threshold: float, split: bool) -> Iterator[tuple[int, np.ndarray]]:
    """For each member its later partners in the unit: owned by this group, and at the threshold when verified.

    ``meets`` has the group of each member by band (0: none), ``side`` the block of each member; in a unit of two blocks
    (``split``) only members of different blocks are pairs, even if all that are there lie in one.
    """
    sizes = np.array([len(s) for s in sets])
    lead = int(np.argmax(meets[0] == group))
    ids = postings = bounds = None
    for i in range(len(sets) - 1):
        others = np.arange(i + 1, len(sets))
        if split:
            others = others[side[others] != side[i]]
        low, high = np.minimum(sizes[i], sizes[others]), np.maximum(sizes[i], sizes[others])
        others = others[low >= threshold * high - 1e-9]
        if lead and len(others):
            earlier = meets[i, :lead]
            others = others[~((meets[others, :lead] == earlier) & (earlier != 0)).any(axis=1)]
        if not len(others):
            continue
        if len(others) >= ROW_PAIRS:
            if ids is None:
                # Which members hold each n-gram that two or more hold.
                owner = np.repeat(np.arange(len(sets)), sizes)
                _, ids, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
                order = np.argsort(ids, kind="stable")
                postings, bounds = owner[order], np.concatenate([[0], np.cumsum(counts)])
                at = np.concatenate([[0], np.cumsum(sizes)])
            mine = ids[at[i] : at[i + 1]]
            mine = mine[bounds[mine + 1] - bounds[mine] > 1]
            found = [postings[bounds[g] : bounds[g + 1]] for g in mine.tolist()]
            shared = np.bincount(np.concatenate(found), minlength=len(sets))[others] if found else np.zeros(len(others), int)
        else:
            shared = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for j in others.tolist()])
        both = sizes[i] + sizes[others] - shared
        good = others[shared >= threshold * both - 1e-9]
        if len(good):
            yield i, good


def verify_unit(nodes: np.ndarray, sets: list[np.ndarray], meets: np.ndarray, side: np.ndarray, group: int, threshold: float, split: bool):
    """(node, links, smallest node of the local component) of each member with a link."""
    order = np.argsort(nodes, kind="stable")
    nodes, meets, side, sets = nodes[order], meets[order], side[order], [sets[k] for k in order]
    root, links = np.arange(len(nodes)), np.zeros(len(nodes), np.int64)

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for i, partners in _links(sets, meets, side, group, threshold, split):
        links[i] += len(partners)
        links[partners] += 1
        top = find(i)
        # Members are in node order, so the smaller place is the smaller node.
        for other in {find(int(j)) for j in np.unique(root[partners])}:
            low, high = min(top, other), max(top, other)
            root[high] = low
            top = low
    return [(int(nodes[k]), int(links[k]), int(nodes[find(k)])) for k in np.flatnonzero(links)]


def _joined(df: DataFrame, threshold: float, recall: float, n: int, doc_id: str, text: str, block_grams: int) -> DataFrame:
    """doc, h, rep (id and digest of the first text of the class), n_copies, n_links for every row."""
    bands, rows = band_plan(threshold, recall)
    signed = materialise(signatures(df, bands, rows, doc_id, text, n), "signatures")
    nodes = materialise(
        signed.groupBy("h").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n_copies"), F.max("grams").alias("grams"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    banded = nodes.select("node", "grams", F.posexplode("bands").alias("band", "key"))
    # The sum of member hashes names the member set, so equal sets of different bands are one group.
    buckets = (
        banded.groupBy("band", "key")
        .agg(F.count(F.lit(1)).alias("members"), F.sum("grams").alias("size"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("named"))
        .where("members > 1")
        .select(F.col("band").alias("b"), F.col("key").alias("k"), "size", F.xxhash64("named", "members", "size").alias("group"))
    )
    met = banded.join(buckets, (F.col("band") == F.col("b")) & (F.col("key") == F.col("k")))
    # At most one row per band and node.
    per_node = met.groupBy("node").agg(F.collect_list(F.struct("band", "group", "size")).alias("met"))
    needed = materialise(
        per_node.join(nodes.select("node", "h", "first"), "node").select("node", "h", "first", "met"), "needed"
    )
    whole = text_of(df, text)
    texts = df.select(F.col(doc_id).cast("long").alias("doc"), whole.alias("t"))
    grams = F.array_distinct(shingle_hashes(content_words(F.col("t")), n))
    # Equal texts under one id give equal rows here; the unit drops the second.
    held = (
        texts.join(needed, F.col("doc").eqNullSafe(F.col("first")))
        .where(F.unhex(F.md5("t")) == F.col("h"))
        .select("node", "met", F.sort_array(grams).alias("grams"))
    )
    meets = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.coalesce(F.element_at(F.map_from_entries(F.transform("met", lambda m: F.struct(m["band"], m["group"]))), b.cast("int")), F.lit(0)))
    groups = F.array_distinct(F.transform("met", lambda m: F.struct(m["group"].alias("group"), F.ceil(m["size"] / F.lit(block_grams)).cast("int").alias("blocks"))))
    mine = F.pmod(F.xxhash64("node", F.lit(1)), F.col("g.blocks").cast("long")).cast("int")
    units = (
        held.withColumn("meets", meets).withColumn("g", F.explode(groups)).drop("met").withColumn("side", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g.blocks") - 1)))
        .select(
            F.col("g.group").alias("group"), F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"),
            "side", "node", "meets", "grams",
        )
    )
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = units.repartition(parts, "group", "low", "high").sortWithinPartitions("group", "low", "high")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, {}, []

        def finish():
            if key is not None and len(held) > 1:
                members = list(held.items())
                out.extend(
                    verify_unit(
                        np.array([n for n, _ in members]), [m[2] for _, m in members], np.array([m[1] for _, m in members]),
                        np.array([m[0] for _, m in members]), key[0], threshold, key[1] != key[2],
                    )
                )

        def batch_out() -> pa.RecordBatch:
            cols = list(zip(*out)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["node", "links", "root"])

        for batch in batches:
            named = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("group", "low", "high", "side", "node")]
            meets = batch.column("meets").flatten().to_numpy(zero_copy_only=False).reshape(-1, bands)
            lists = batch.column("grams")
            values, edges = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            edges = edges - edges[0]
            for k in range(batch.num_rows):
                here = (int(named[0][k]), int(named[1][k]), int(named[2][k]))
                if here != key:
                    finish()
                    key, held = here, {}
                held[int(named[4][k])] = (int(named[3][k]), meets[k].copy(), values[edges[k] : edges[k + 1]].copy())
            if len(out) > 10_000:
                yield batch_out()
                out.clear()
        finish()
        yield batch_out()

    linked = materialise(dealt.mapInArrow(verify, "node long, links long, root long"), "links")
    classes = connected(linked.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")).distinct())
    degrees = linked.groupBy("node").agg(F.sum("links").alias("n_links"))
    placed = (
        nodes.select("h", "node", "first", "n_copies").join(classes.withColumnRenamed("u", "node"), "node", "left").join(degrees, "node", "left")
        .select("h", "first", "n_copies", F.coalesce("label", "node").alias("label"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    # The smallest id that is not NULL comes first, then the smaller digest.
    rep = F.struct(F.col("first").isNull().alias("unnamed"), F.col("first").alias("doc"), "h")
    named = placed.groupBy("label").agg(F.min(rep).alias("rep"))
    placed = placed.join(named, "label").select("h", "rep", "n_copies", "n_links")
    return signed.select("doc", "h").join(placed, "h")


def join(
    df: DataFrame, threshold: float = SIMILARITY, recall: float = RECALL, n: int = SHINGLE,
    doc_id: str = "doc_id", text: str = "text", block_grams: int = BLOCK_GRAMS,
) -> DataFrame:
    """One row per row of ``df``: doc_id, class_id (smallest id of the class), n_copies (rows with this very text),
    n_links (different texts at or above the threshold)."""
    rows = _joined(df, threshold, recall, n, doc_id, text, block_grams)
    return rows.select(F.col("doc").alias(doc_id), F.col("rep.doc").alias("class_id"), "n_copies", "n_links")


def keep_first(
    df: DataFrame, threshold: float = SIMILARITY, recall: float = RECALL, n: int = SHINGLE,
    doc_id: str = "doc_id", text: str = "text", block_grams: int = BLOCK_GRAMS,
) -> DataFrame:
    """``df`` with one row of each class; columns as they were. Only rows that repeat id and text are shuffled whole."""
    rows = _joined(df, threshold, recall, n, doc_id, text, block_grams)
    first = F.col("doc").eqNullSafe(F.col("rep.doc")) & (F.col("h") == F.col("rep.h"))
    fate = materialise(rows.groupBy(F.col("doc").alias("_doc"), F.col("h").alias("_h")).agg(F.min(first).alias("_first"), F.count(F.lit(1)).alias("_n")), "fate")
    # The row travels as one field, so no column of it can clash with one of these.
    mark = df.select(F.struct("*").alias("_row"), F.col(doc_id).cast("long").alias("_id"), F.unhex(F.md5(text_of(df, text))).alias("_digest"))
    same = F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_digest") == F.col("_h"))
    # What goes and what repeats are the short lists; every other row stays where it is.
    single = mark.join(fate.where("not _first or _n > 1").select("_doc", "_h"), same, "left_anti")
    repeated = mark.join(fate.where("_first and _n > 1").select("_doc", "_h"), same, "left_semi")
    return single.unionByName(repeated.dropDuplicates(["_id", "_digest"])).select("_row.*")
