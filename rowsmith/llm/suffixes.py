"""Substring de-duplication by a sparse suffix array over the whole corpus.

1. Suffixes are kept at minimiser positions only: the smallest seed hash (SEED words) of every window, chosen by
   content, so a passage of MIN_WORDS words that stands in two documents keeps the same suffix in both. Where one seed
   comes again and again (a text of one repeated word), every few of its places are kept, and the ends of the run.
2. Suffixes whose seed stands once are dropped (partial aggregate), the rest get CONTEXT words to both sides.
3. They are sorted over the cluster by range partitions, by what follows, then by what precedes, ties by document, so a
   passage that a third of all rows share spreads over many tasks. Neighbours with one seed are compared
   and the match is extended word by word to the left and to the right; the two rows at each partition border are
   compared afterwards.
4. Neighbours may share less of a passage than rows further off, when its halves are frequent. So every
   stretch of exactly MIN_WORDS words around a kept seed is also named by a 64-bit hash and linked to the document of the
   smallest id that has it (that one to the last): each document but the first of a passage has a row under its own id.
5. Matches on one diagonal of a pair that touch are one passage.

A document is an id and a text: it goes by a 64-bit hash of both, and its id is looked up for the result. Words are
compared by 24-bit hashes, seeds and stretches by 64-bit ones. Each passage is linked to a neighbour that
shares it and to the first document of each of its stretches, so copies are chains and stars, not pairs. A passage longer
than CONTEXT words is reported whole where one partner shares all of it, because its stretches lie on one diagonal; else
in overlapping parts that name different partners.

Defined results: NULL and empty texts and texts of under MIN_WORDS words have no passage; repeats inside one document and
rows that repeat id and text are not reported; rows that share an id, or have none, and differ in text are documents of
their own; ``other_id`` is the smaller id, NULL the smallest; very long texts are taken whole; an empty table gives no
passages; other columns do not take part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.llm.common import content_words, text_of
from rowsmith.session import materialise

MIN_WORDS = 50
SEED = 8
CONTEXT = 60
# Bytes a word's hash takes in a context: these rows are what is shuffled most.
BYTES = 3
NO_ID = -(2**63)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours: running minima of blocks from both ends."""
    n = len(x)
    padded = np.concatenate([x, np.full(-n % width, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def minimisers(seeds: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the smallest seed of some window of ``width``; ties all count, so copies agree."""
    if len(seeds) < width:
        return np.empty(0, np.int64)
    least = sliding_min(seeds, width)
    edge = np.full(width - 1, np.iinfo(seeds.dtype).min, seeds.dtype)
    # The largest of the minima of all windows around a place equals its seed only if it is one of those minima.
    highest = -1 - sliding_min(-1 - np.concatenate([edge, least, edge]), width)
    return np.flatnonzero(highest == seeds)


def thinned(places: np.ndarray, seeds: np.ndarray, width: int) -> np.ndarray:
    """``places`` without most of those where the same seed stands close by: a window of ``width`` that held one still does.

    Of places of one seed that follow within half a window, the first, the last and one every quarter of a window stay.
    """
    order = np.lexsort((places, seeds))
    p, s = places[order], seeds[order]
    opens = np.concatenate([[True], (s[1:] != s[:-1]) | (p[1:] - p[:-1] >= width // 2)])
    start = p[np.flatnonzero(opens)][np.cumsum(opens) - 1]
    box = (p - start) // max(1, width // 4)
    stays = opens | np.concatenate([[True], box[1:] != box[:-1]]) | np.concatenate([opens[1:], [True]])
    return np.sort(p[stays])


def document(df: DataFrame, doc_id: str, text: str) -> Column:
    """A document's key: rows of one id and one text are one document."""
    return F.xxhash64(F.col(f"`{doc_id}`").cast("long"), F.md5(text_of(df, text)))


def lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and the borders of each row's list in them."""
    edges = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), edges - edges[0]


def _suffixes(df: DataFrame, doc_id: str, text: str, min_words: int, seed: int) -> DataFrame:
    """doc, seed, pos of every kept suffix."""
    words = F.transform(content_words(text_of(df, text)), lambda w: F.xxhash64(w))
    base = df.select(document(df, doc_id, text).alias("doc"), words.alias("words"))
    width = min_words - seed + 1

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, edges = lists(batch.column("words"))
            rows, seeds, places = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for row in range(batch.num_rows):
                own = stretch_hashes(values[edges[row] : edges[row + 1]], seed)
                at = minimisers(own, width)
                at = thinned(at, own[at], width) if len(at) else at
                rows.append(np.full(len(at), row))
                seeds.append(own[at])
                places.append(at)
            docs = batch.column("doc").take(pa.array(np.concatenate(rows)))
            yield pa.RecordBatch.from_arrays([docs, pa.array(np.concatenate(seeds)), pa.array(np.concatenate(places).astype(np.int32))], names=["doc", "seed", "pos"])

    return base.where(F.size("words") >= seed).mapInArrow(keep, "doc long, seed long, pos int")


def _contexts(df: DataFrame, kept: DataFrame, doc_id: str, text: str, context: int) -> DataFrame:
    """doc, seed, pos, ahead (words from pos on) and back (words before pos, nearest first) as sortable bytes."""
    words = F.transform(content_words(F.col("t")), lambda w: F.xxhash64(w))
    base = df.select(document(df, doc_id, text).alias("own"), text_of(df, text).alias("t"))
    # Rows that repeat id and text bring their places more than once.
    wanted = kept.groupBy("doc").agg(F.collect_set(F.struct("seed", "pos")).alias("at"))
    joined = base.join(wanted, F.col("own") == F.col("doc")).select("doc", F.col("at.seed").alias("seeds"), F.col("at.pos").alias("places"), words.alias("words"))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, edges = lists(batch.column("words"))
            words = words.astype(">i8").view(np.uint8).reshape(-1, 8)[:, 8 - BYTES :]
            seeds, borders = lists(batch.column("seeds"))
            places, _ = lists(batch.column("places"))
            rows = np.repeat(np.arange(batch.num_rows), np.diff(borders))
            ahead, back = [], []
            for row, place in zip(rows.tolist(), places.tolist()):
                start, at, end = edges[row], edges[row] + place, edges[row + 1]
                ahead.append(words[at : min(end, at + context)].tobytes())
                back.append(words[max(start, at - context) : at][::-1].tobytes())
            for first in range(0, len(rows), 5000):
                part = slice(first, first + 5000)
                docs = batch.column("doc").take(pa.array(rows[part]))
                yield pa.RecordBatch.from_arrays(
                    [docs, pa.array(seeds[part]), pa.array(places[part], pa.int32()), pa.array(ahead[part], pa.binary()), pa.array(back[part], pa.binary())],
                    names=["doc", "seed", "pos", "ahead", "back"],
                )

    return joined.mapInArrow(spell, "doc long, seed long, pos int, ahead binary, back binary")


def _matrix(column: pa.Array, context: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of each row, filled up with zeros, and how many there are."""
    raw = column.to_pylist()
    sizes = np.array([len(b) // BYTES for b in raw], np.int64)
    flat = np.frombuffer(b"".join(b.ljust(context * BYTES, b"\0") for b in raw), np.uint8).reshape(len(raw), context, BYTES)
    return flat, sizes


def _equal_run(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    differ = (a != b).any(axis=2)
    run = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])
    return np.minimum(run, np.minimum(na, nb))


FOUND = "edge boolean, doc long, seed long, pos int, ahead binary, back binary, start int, stop int, other long, other_start int"


def _neighbours(context: int, min_words: int, with_edges: bool):
    """Compare sorted rows with the one before and the one after of another document; first and last row leave too."""

    def pairs_of(seed: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = np.arange(len(seed))
        turn = np.concatenate([[True], doc[1:] != doc[:-1]])
        run = np.cumsum(turn) - 1
        starts = np.flatnonzero(turn)
        before = starts[run] - 1
        after = np.append(starts[1:], len(seed))[run]
        left = np.concatenate([before, n])
        right = np.concatenate([n, after])
        good = (left >= 0) & (right < len(seed))
        left, right = left[good], right[good]
        same = seed[left] == seed[right]
        both = np.unique(left[same] * np.int64(len(seed)) + right[same]) if same.any() else np.empty(0, np.int64)
        return both // max(1, len(seed)), both % max(1, len(seed))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, schema = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            # The last rows of one document before the batch go with it, so every neighbour is met.
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            rows = table.to_batches()[0]
            first_batch = schema is None
            schema = batch.schema
            doc = rows.column("doc").to_numpy()
            seed, pos = rows.column("seed").to_numpy(), rows.column("pos").to_numpy().astype(np.int64)
            left, right = pairs_of(seed, doc)
            ahead, n_ahead = _matrix(rows.column("ahead"), context)
            back, n_back = _matrix(rows.column("back"), context)
            after = _equal_run(ahead[left], ahead[right], n_ahead[left], n_ahead[right])
            before = _equal_run(back[left], back[right], n_back[left], n_back[right])
            good = after + before >= min_words
            left, right, after, before = left[good], right[good], after[good], before[good]
            if len(left):
                none = pa.nulls(len(left))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.zeros(len(left), bool)), rows.column("doc").take(pa.array(right)), none.cast(pa.int64()), none.cast(pa.int32()),
                        none.cast(pa.binary()), none.cast(pa.binary()), pa.array((pos[right] - before).astype(np.int32)),
                        pa.array((pos[right] + after).astype(np.int32)), rows.column("doc").take(pa.array(left)), pa.array((pos[left] - before).astype(np.int32)),
                    ],
                    names=[f.split()[0] for f in FOUND.split(", ")],
                )
            if with_edges and first_batch:
                yield edge(rows.slice(0, 1))
            # From the start of the last document but one: its rows still lack the neighbour after them.
            turns = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (seed[1:] != seed[:-1])]))
            held = rows.slice(int(turns[-2] if len(turns) > 1 else turns[-1]))
        if with_edges and held is not None:
            yield edge(held.slice(held.num_rows - 1))

    def edge(row: pa.RecordBatch) -> pa.RecordBatch:
        none = pa.nulls(1)
        return pa.RecordBatch.from_arrays(
            [pa.array([True]), *[row.column(c) for c in ("doc", "seed", "pos", "ahead", "back")], none.cast(pa.int32()), none.cast(pa.int32()), none.cast(pa.int64()), none.cast(pa.int32())],
            names=[f.split()[0] for f in FOUND.split(", ")],
        )

    return compare


def _sorted_matches(rows: DataFrame, context: int, min_words: int) -> DataFrame:
    """Matches of neighbours in the order of what follows."""
    # Ties by place before document: rows of one looping text do not stand together.
    order = ["seed", "ahead", "back", "pos", "doc"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc", "seed", "pos", "ahead", "back")
    found = materialise(ranged.mapInArrow(_neighbours(context, min_words, True), FOUND), "neighbours")
    # Two rows per partition: where one ends and the next begins. They are brought together by a shuffle of just those.
    borders = found.where("edge").select("doc", "seed", "pos", "ahead", "back").repartition(1).sortWithinPartitions(*order)
    met = borders.mapInArrow(_neighbours(context, min_words, False), FOUND)
    columns = ("doc", "start", "stop", "other", "other_start")
    return found.where("not edge").select(*columns).unionByName(met.where("not edge").select(*columns))


def stretch_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit hash per ``width`` neighbouring word hashes: stretches of 1, 2, 4, ... words put together."""

    def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        x = (left * np.uint64(0x9E3779B97F4A7C15) + np.uint64(SEED)) ^ right
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))

    n = len(words) - width + 1
    part, size, out, done = words.view(np.uint64), 1, None, 0
    while True:
        if width & size:
            piece = part[done : done + n]
            out = piece if out is None else joined(out, piece)
            done += size
        if done == width:
            return out.view(np.int64)
        part, size = joined(part[:-size], part[size:]), 2 * size


def _stretches(df: DataFrame, kept: DataFrame, doc_id: str, text: str, min_words: int, seed: int) -> DataFrame:
    """name, id, doc, start of every stretch of ``min_words`` words that holds a kept seed."""
    words = F.transform(content_words(F.col("t")), lambda w: F.xxhash64(w))
    base = df.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NO_ID)).alias("id"), document(df, doc_id, text).alias("own"), text_of(df, text).alias("t"))
    wanted = kept.groupBy("doc").agg(F.collect_set("pos").alias("places"))
    joined = base.join(wanted, F.col("own") == F.col("doc")).select("id", "doc", "places", words.alias("words"))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, edges = lists(batch.column("words"))
            places, borders = lists(batch.column("places"))
            ids, docs = batch.column("id").to_numpy(), batch.column("doc").to_numpy()
            for row in range(batch.num_rows):
                own = words[edges[row] : edges[row + 1]]
                n = len(own) - min_words + 1
                if n < 1:
                    continue
                at = places[borders[row] : borders[row + 1]].astype(np.int64)
                steps = np.zeros(n + 1, np.int64)
                np.add.at(steps, np.clip(at + seed - min_words, 0, n), 1)
                np.add.at(steps, np.clip(at + 1, 0, n), -1)
                starts = np.flatnonzero(np.cumsum(steps[:-1]) > 0)
                if len(starts):
                    names = stretch_hashes(own, min_words)[starts]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names), pa.array(np.full(len(starts), ids[row])), pa.array(np.full(len(starts), docs[row])), pa.array(starts.astype(np.int32))],
                        names=["name", "id", "doc", "start"],
                    )

    return joined.mapInArrow(name, "name long, id long, doc long, start int")


def _equal_stretches(stretches: DataFrame, min_words: int) -> DataFrame:
    """Each stretch that stands in two documents beside the document of the smallest id that has it, in that one beside the last."""
    # One shuffle: these rows are the most of all, and neither written nor joined.
    same = Window.partitionBy("name").orderBy("id", "doc", "start").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = {"low": F.first("doc"), "low_start": F.first("start"), "high": F.last("doc"), "high_start": F.last("start")}
    met = stretches.select("*", *[end.over(same).alias(c) for c, end in ends.items()]).where("low <> high")
    first = F.col("doc") == F.col("low")
    return met.select(
        "doc", "start", (F.col("start") + min_words).cast("int").alias("stop"),
        F.when(first, F.col("high")).otherwise(F.col("low")).alias("other"), F.when(first, F.col("high_start")).otherwise(F.col("low_start")).alias("other_start"),
    )


def merged(matches: DataFrame) -> DataFrame:
    """Touching matches of one pair on one diagonal as one passage; each pair in one direction."""
    turned = matches.select(
        F.least("doc", "other").alias("other"), F.greatest("doc", "other").alias("doc"),
        F.when(F.col("doc") >= F.col("other"), F.col("start")).otherwise(F.col("other_start")).alias("start"),
        F.when(F.col("doc") >= F.col("other"), F.col("other_start")).otherwise(F.col("start")).alias("other_start"),
        (F.col("stop") - F.col("start")).alias("n"),
    )
    placed = turned.withColumn("shift", F.col("start") - F.col("other_start")).withColumn("stop", F.col("start") + F.col("n"))
    pair = Window.partitionBy("doc", "other", "shift").orderBy("start", "stop")
    reach = F.max("stop").over(pair.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("reach") >= F.col("start"), 0).otherwise(1)).over(pair.rowsBetween(Window.unboundedPreceding, 0))
    return (
        placed.withColumn("reach", reach).withColumn("island", island)
        .groupBy("doc", "other", "shift", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    )


def passages(
    df: DataFrame, min_words: int = MIN_WORDS, seed: int = SEED, context: int = CONTEXT, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, start_word, end_word (exclusive), other_id, other_start, n_words of passages of at least ``min_words``
    words that stand in both documents; ``other_id`` is the smaller id."""
    if context < min_words + seed:
        raise ValueError("context must reach over min_words and a seed")
    kept = materialise(_suffixes(df, doc_id, text, min_words, seed), "suffixes")
    often = kept.groupBy("seed").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low <> high").select("seed")
    shared = kept.join(often, "seed")
    matches = _sorted_matches(_contexts(df, shared, doc_id, text, context), context, min_words)
    stretches = _stretches(df, shared, doc_id, text, min_words, seed)
    found = materialise(merged(matches.unionByName(_equal_stretches(stretches, min_words))), "found")
    ids = df.select(document(df, doc_id, text).alias("key"), F.col(f"`{doc_id}`").cast("long").alias("id")).distinct()
    named = found.join(ids.select(F.col("key").alias("doc"), F.col("id").alias("doc_id")), "doc").join(ids.select(F.col("key").alias("other"), F.col("id").alias("other_id")), "other")
    # The smaller id is the other one; NULL is the smallest.
    rank = lambda c: F.coalesce(F.col(c), F.lit(NO_ID))
    turn = rank("doc_id") < rank("other_id")
    other_start = F.col("start") - F.col("shift")
    pick = lambda a, b: F.when(turn, b).otherwise(a)
    n = F.col("stop") - F.col("start")
    begin = pick(F.col("start"), other_start)
    return named.select(
        pick(F.col("doc_id"), F.col("other_id")).alias(doc_id), begin.cast("long").alias("start_word"), (begin + n).cast("long").alias("end_word"),
        pick(F.col("other_id"), F.col("doc_id")).alias("other_id"), pick(other_start, F.col("start")).cast("long").alias("other_start"), n.cast("long").alias("n_words"),
    )
