"""MinHash near-dedup by a chosen-path set similarity join.

1. Texts with equal word sequences become one record (partial aggregate). A record's set is its distinct shingles; its
   signature is COORDINATES min-hashes of that set.
2. A tree starts with all records at its root. At every node a record is sent to BRANCHES children: the path to the node
   chooses that many coordinates, and the min-hash there (the minwise token) names the child. Records of similarity s
   share a child with probability 1 - (1 - s)^BRANCHES a level, so by the branching process at least the fixed point of
   1 - x = (1 - s x)^BRANCHES of them meet at any depth; the number of independent trees follows from that and the
   target recall.
3. After DEPTH levels a node with few members is compared exhaustively; larger ones branch on until a child keeps most
   of its parent's members (they are alike, more branching cannot part them) or DEEPEST is reached; then they are
   compared too, whatever their size.
4. The first tree goes alone. Its links make components, and from then on only members of different components are
   compared: the other trees drop every node whose members are in one component already, which is what nodes of copies are.
5. A node larger than a block is compared in units of two blocks. In the first tree it is compared inside its blocks and
   with its smallest member only, so a large group of near copies costs a pass over it, not its square. Afterwards the
   members outside the smallest member's component meet all others: their pairs are the ones left to decide.
6. Inside a unit pairs in one component are skipped, and each verified link merges two: a unit gives fewer links than it
   has members, never its pairs. Links are decided on the full sets, in whole numbers.
7. Components are found over the links.

Defined results: a NULL text and one without words have an empty set and are linked with nothing, not even each other; a
text with fewer words than a shingle has one shingle, the whole sequence; rows that share an id are rows of their own with
their own texts; a row with a NULL id links like any other and is never the smallest; where a component has no id at all, its
id is NULL and its rows are kept; very long texts are compared whole; an empty table gives an empty table; other columns do not take part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import ascii_lower, let, may_match, space_words, text_of
from rowsmith.llm.components import connected
from rowsmith.session import materialise

WORDS = 4
PERCENT = 80
RECALL = 0.9999
COORDINATES = 64
BRANCHES = 2
DEPTH = 3
DEEPEST = 7
# Members up to which a node is compared at once, and shingles in one block of a larger one.
SMALL = 64
BLOCK_GRAMS = 1_500_000
SEED = 11
# What a member counts for in a block besides its shingles, so that a block of short texts has few enough members.
MEMBER = 300
# From this many partners on, a member is compared with all of them in one pass.
AT_ONCE = 6


def meeting(similarity: float, branches: int = BRANCHES) -> float:
    """The least probability that a pair of this similarity shares a node at any depth of one tree."""
    x = 1.0
    for _ in range(200):
        x = 1 - (1 - similarity * x) ** branches
    return x


def trees_for(similarity: float, recall: float, branches: int = BRANCHES) -> int:
    """Independent trees until a pair at the threshold is met with the target recall."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - meeting(similarity, branches)) - 1e-9))


def sequence(text: Column) -> Column:
    """The words: runs of anything but space and U+0009 to U+000D, A-Z in lower case."""
    return space_words(ascii_lower(text))


def shingle_set(words: Column, n: int) -> Column:
    """Distinct 64-bit hashes of the windows of ``n`` words; of the whole sequence if it is shorter."""

    def of(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)]))
        few = F.array(F.xxhash64(F.concat_ws(" ", w)))
        return F.when(F.size(w) >= n, F.array_distinct(windows)).when(F.size(w) > 0, few).otherwise(F.array().cast("array<bigint>"))

    return let(words, of)


def records(df: DataFrame, n: int, doc_id: str, text: str) -> DataFrame:
    """doc, h (digest of the word sequence), grams (set size), sig (empty for an empty set) of every row."""
    rng = np.random.default_rng(SEED)
    factors = rng.integers(1, 2**32, COORDINATES, dtype=np.uint32) | np.uint32(1)
    shifts = rng.integers(0, 2**32, COORDINATES, dtype=np.uint32)
    held = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), sequence(text_of(df, text)).alias("w"))
    base = held.select("doc", F.unhex(F.md5(F.concat_ws(" ", "w"))).alias("h"), shingle_set(F.col("w"), n).alias("v"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            values = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            mixed = (values ^ (values >> np.uint64(32))).astype(np.uint32)
            edges = lists.offsets.to_numpy().astype(np.int64)
            edges = edges - edges[0]
            sizes = np.diff(edges)
            full = sizes > 0
            starts, ends = edges[:-1][full], edges[1:][full]
            least = np.empty((len(starts), COORDINATES), np.uint32)
            first = 0
            while first < len(starts):
                # A few texts at a time, so that the working arrays stay in the cache.
                last = max(first + 1, int(np.searchsorted(ends, starts[first] + 50_000)))
                part = mixed[starts[first] : ends[last - 1]]
                for k in range(COORDINATES):
                    least[first:last, k] = np.minimum.reduceat(part * factors[k] + shifts[k], starts[first:last] - starts[first])
                first = last
            offsets = np.concatenate([[0], np.cumsum(full * COORDINATES)]).astype(np.int32)
            sig = pa.ListArray.from_arrays(pa.array(offsets), pa.array(least.ravel().view(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("h"), pa.array(sizes, pa.int64()), sig], names=["doc", "h", "grams", "sig"])

    return base.mapInArrow(sign, "doc long, h binary, grams long, sig array<int>")


def child(path: Column, sig: Column, branch: int) -> Column:
    """The node that a record goes to from ``path``: the path chooses the coordinate, the min-hash there the child.

    An odd stride gives every branch of a node a coordinate of its own.
    """
    chosen = F.pmod(F.xxhash64(path) + F.lit(17 * branch), F.lit(COORDINATES)).cast("int")
    return let(chosen, lambda c: F.xxhash64(path, c, F.get(sig, c)))


def descend(rows: DataFrame, levels: int) -> DataFrame:
    """``rows`` (path, sig, ...) at all nodes ``levels`` below."""
    paths = F.array("path")
    for _ in range(levels):
        below = lambda p: F.array(*[child(p, F.col("sig"), b) for b in range(BRANCHES)])
        paths = F.flatten(F.transform(paths, below))
    return rows.withColumn("path", F.explode(paths))


def open_nodes(rows: DataFrame) -> DataFrame:
    """What is known of the nodes whose members are not all in one component.

    ``group`` names the member set, so equal sets at different places of the trees are compared once.
    """
    named = F.sum(F.xxhash64("node").cast("decimal(20,0)"))
    stats = rows.groupBy("path").agg(
        F.count(F.lit(1)).alias("members"), F.sum(F.col("grams") + MEMBER).alias("size"), named.alias("named"), F.min_by("label", "node").alias("home"),
        F.min("label").alias("least"), F.max("label").alias("most"), F.max("was").alias("parent"),
    )
    stats = stats.where("least <> most")
    return stats.select(F.col("path").alias("at"), "members", "size", "home", "parent", F.xxhash64("named", "members", "size").alias("group"))


def nodes_to_compare(nodes: DataFrame, trees: list[int], tag: str) -> DataFrame:
    """group, node, grams, label, size, home of every member of every node that has to be compared."""
    roots = F.explode(F.array(*[F.xxhash64(F.lit(SEED), F.lit(t)) for t in trees]))
    held = nodes.where("grams > 0")
    rows = descend(held.select("node", "grams", "label", "sig", roots.alias("path")), DEPTH)
    rows = materialise(rows.select("path", "node", "grams", "label", F.lit(0).cast("long").alias("was")), f"{tag}-paths")
    done, depth = [], DEPTH
    while True:
        known = open_nodes(rows)
        met = rows.select("path", "node", "grams", "label").join(known, F.col("path") == F.col("at"))
        met = materialise(met.select("path", "node", "grams", "label", "members", "size", "home", "parent", "group"), f"{tag}-met")
        # Members that branching cannot part: the child kept four fifths of its parent.
        alike = (F.col("parent") > 0) & (F.col("members") * 5 >= F.col("parent") * 4)
        ready = (F.col("members") <= SMALL) | alike
        done.append(met if depth == DEEPEST else met.where(ready))
        large = met.where(~ready)
        if depth == DEEPEST or not large.limit(1).count():
            break
        signed = nodes.select(F.col("node").alias("n"), "sig")
        large = large.join(signed, F.col("node") == F.col("n"))
        below = descend(large.select("path", "node", "grams", "label", "sig", F.col("members").alias("was")), 1)
        rows = materialise(below.select("path", "node", "grams", "label", "was"), f"{tag}-paths")
        depth += 1
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    # A record that reaches equal groups by several paths is one member.
    return found.select("group", "node", "grams", "label", "size", "home").distinct()


def still_open(met: DataFrame, labelled: DataFrame) -> DataFrame:
    """The groups of ``met`` whose members are not in one component under the new labels, with these."""
    now = labelled.select(F.col("node").alias("n"), F.col("label").alias("now"))
    rows = met.join(now, F.col("node") == F.col("n")).select("group", "node", "grams", F.col("now").alias("label"), "size")
    stats = rows.groupBy(F.col("group").alias("g")).agg(F.min_by("label", "node").alias("home"), F.min("label").alias("least"), F.max("label").alias("most"))
    return rows.join(stats.where("least <> most").drop("least", "most"), F.col("group") == F.col("g")).drop("g")


def verify_unit(nodes: np.ndarray, labels: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], split: bool, percent: int) -> list[tuple[int, int]]:
    """Links between members of different components, each verified, that merge all components that have one.

    In a unit of two blocks (``split``) only members of different blocks are pairs.
    """
    comp = np.unique(labels, return_inverse=True)[1]
    sizes = np.array([len(s) for s in sets])
    found, ids, starts, apart = [], None, None, len(np.unique(comp))
    for i in range(len(sets) - 1):
        rest = np.arange(i + 1, len(sets))
        rest = rest[comp[rest] != comp[i]]
        if split:
            rest = rest[sides[rest] != sides[i]]
        low, high = np.minimum(sizes[i], sizes[rest]), np.maximum(sizes[i], sizes[rest])
        rest = rest[100 * low >= percent * high]
        if not len(rest):
            continue
        if len(rest) >= AT_ONCE:
            if ids is None:
                # Small numbers for the shingles, so that one member's set is a row of flags.
                ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
                starts = np.concatenate([[0], np.cumsum(sizes)])
                flags = np.zeros(int(ids.max()) + 1, bool)
            mine = ids[starts[i] : starts[i + 1]]
            flags[mine] = True
            shared = np.array([np.count_nonzero(flags[ids[starts[j] : starts[j + 1]]]) for j in rest.tolist()])
            flags[mine] = False
        else:
            shared = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for j in rest.tolist()])
        good = rest[100 * shared >= percent * (sizes[i] + sizes[rest] - shared)]
        for other in np.unique(comp[good]):
            found.append((int(nodes[i]), int(nodes[good[comp[good] == other][0]])))
            comp[comp == other] = comp[i]
            apart -= 1
        if apart == 1:
            break
    return found


def units_of(met: DataFrame, first_round: bool, block_grams: int) -> DataFrame:
    """group, low, high, side, node, label: a row for every unit a member takes part in."""
    # Groups of one block are one unit; the others are cut by what the members outside the home component hold.
    away = F.col("label") != F.col("home")
    outside = (
        met.where(away & (F.col("size") > block_grams)).groupBy(F.col("group").alias("g")).agg(F.sum(F.col("grams") + MEMBER).alias("out_size"))
    )
    rows = met.join(outside, F.col("group") == F.col("g"), "left").drop("g")
    blocks = lambda grams: F.ceil(grams / F.lit(block_grams)).cast("long")
    split = F.col("size") > block_grams
    drawn = F.xxhash64("node", F.lit(1))
    if first_round:
        # Every block by itself, and the smallest member (whose label is the home) in each of them.
        rows = rows.withColumn("n", F.when(split, blocks(F.col("size"))).otherwise(F.lit(1).cast("long")))
        own = F.array(F.pmod(drawn, F.col("n")))
        rows = rows.withColumn("low", F.explode(F.when(away, own).otherwise(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))))
        return rows.select("group", "low", F.col("low").alias("high"), F.col("low").alias("side"), "node", "label")
    outer = F.when(split, blocks(F.col("out_size"))).otherwise(F.lit(1).cast("long"))
    inner = F.when(split, F.greatest(blocks(F.col("size") - F.col("out_size")), F.lit(1))).otherwise(F.lit(0).cast("long"))
    rows = rows.withColumns({"outer": outer, "inner": inner})
    single = ~split
    # Blocks 0 to outer - 1 hold the members outside, the next ``inner`` ones those of the home component.
    side = F.when(single, F.lit(0).cast("long")).when(away, F.pmod(drawn, F.col("outer"))).otherwise(F.col("outer") + F.pmod(drawn, F.greatest("inner", F.lit(1))))
    last = F.when(single, F.lit(0).cast("long")).when(away, F.col("outer") + F.col("inner") - 1).otherwise(F.col("outer") - 1)
    rows = rows.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return rows.select("group", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "node", "label")


def verified(units: DataFrame, nodes: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """u, v: verified links between records, at most one fewer than members a unit."""
    wanted = units.groupBy("node").agg(F.collect_set(F.struct("group", "low", "high", "side", "label")).alias("units"))
    needed = materialise(wanted.join(nodes.select("node", "h", "first"), "node"), "needed")
    # Most texts meet no other: they leave before any shuffle.
    asked = may_match(texts, F.coalesce("doc", F.lit(-1)), needed, F.coalesce("first", F.lit(-1))).select("doc", sequence(F.col("t")).alias("w"))
    # Known not to be NULL, or a test for that would be computed for every text before the others leave.
    own = F.coalesce(F.unhex(F.md5(F.concat_ws(" ", "w"))), F.lit(b""))
    sets = asked.select("doc", own.alias("own"), shingle_set(F.col("w"), n).alias("grams"))
    held = (
        sets.join(needed, F.col("doc").eqNullSafe(F.col("first")) & (F.col("own") == F.col("h")))
        .select("node", F.explode("units").alias("u"), "grams").select("u.*", "node", "grams")
    )
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = held.repartition(parts, "group", "low", "high").sortWithinPartitions("group", "low", "high")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, {}

        def finish() -> pa.RecordBatch:
            found = []
            if len(members) > 1:
                # Rows that repeat id and words of one record are one member.
                labels, sides, sets = zip(*members.values())
                found = verify_unit(np.array(list(members)), np.array(labels), np.array(sides), list(sets), key[1] != key[2], percent)
            us, vs = zip(*found) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

        for batch in batches:
            group, low, high, side, label, node = (batch.column(c).to_numpy() for c in ("group", "low", "high", "side", "label", "node"))
            lists = batch.column("grams")
            values, edges = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            edges = edges - edges[0]
            for k in range(batch.num_rows):
                here = (group[k], low[k], high[k])
                if here != key:
                    if len(members) > 1:
                        yield finish()
                    key, members = here, {}
                members[int(node[k])] = (label[k], side[k], values[edges[k] : edges[k + 1]].copy())
        yield finish()

    return dealt.mapInArrow(verify, "u long, v long")


def components(
    df: DataFrame, percent: int = PERCENT, words: int = WORDS, recall: float = RECALL, doc_id: str = "doc_id", text: str = "text", block_grams: int = BLOCK_GRAMS
) -> DataFrame:
    """One row per row of ``df``: doc_id, n_shingles, component_id (smallest id reachable over links), kept (it is its
    own; rows without an id in a component without ids are kept as well)."""
    signed = materialise(records(df, words, doc_id, text), "records")
    nodes = materialise(
        signed.groupBy("h").agg(F.min("doc").alias("first"), F.max("grams").alias("grams"), F.first("sig").alias("sig"))
        .withColumn("node", F.monotonically_increasing_id()).withColumn("label", F.col("node")),
        "nodes",
    )
    texts = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), text_of(df, text).alias("t"))
    count = trees_for(percent / 100, recall)

    def compare(met: DataFrame, first_round: bool) -> DataFrame:
        return materialise(verified(units_of(met, first_round, block_grams), nodes, texts, words, percent), "links")

    def relabel(links: DataFrame) -> DataFrame:
        labels = connected(links).withColumnRenamed("u", "node")
        return materialise(nodes.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled")

    first = materialise(nodes_to_compare(nodes, [0], "first"), "members")
    links = compare(first, True)
    labelled = relabel(links)
    rest = nodes_to_compare(labelled, list(range(1, count)), "rest") if count > 1 else None
    # Groups that were only compared inside their blocks come again, now that most of them is one component.
    again = still_open(first.where(F.col("size") > block_grams), labelled)
    met = materialise(again if rest is None else again.unionByName(rest), "members")
    labelled = relabel(links.unionByName(compare(met, False)))
    smallest = labelled.where("grams > 0").groupBy("label").agg(F.min("first").alias("component_id"))
    placed = labelled.select("h", "label").join(smallest, "label", "left").select("h", "component_id")
    told = signed.select("doc", "h", "grams").join(placed, "h")
    component = F.when(F.col("grams") > 0, F.col("component_id")).otherwise(F.col("doc"))
    return told.select(
        F.col("doc").alias(doc_id), F.col("grams").alias("n_shingles"), component.alias("component_id"), F.col("doc").eqNullSafe(component).alias("kept")
    )
