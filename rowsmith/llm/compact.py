"""Near-duplicate passages by compact windows.

1. Two passages of similarity THRESHOLD share a piece of ``unbroken`` words (25 of 50 at 0.8): each break costs shingles on
   both sides. Under each of HASHES functions (one does) the hashes of SEED_WORDS words form a Cartesian tree: the least one
   in a stretch splits it. Each node is a compact window (l, c, r): every piece inside [l, r] that holds c has the seed at c.
2. Neighbouring pieces with the same seeds under the NEED functions of a band are one run, named by them; all passages that
   hold such a piece go with it. Loops of one word are named by the loop or by their ends. Names are brought together by
   one shuffle, and what stands in one document only leaves there.
3. Each name joins its runs to the one of the smallest id (that one to the last) and to one with the commonest words. What
   a pair shares on one diagonal is a candidate, and is verified on the words: matching shingles are aligned, the stretch of
   MIN_WORDS words or more with the largest surplus over the similarity is cut out, then what is left on both sides, until
   none has a Jaccard similarity of THRESHOLD on its five-word shingles.
   Runs of a name with the same words are joined to the first of them, which stands for them.
4. A run whose shared seed begins in no passage verified with the one of the commonest words meets others of its name, by the
   words around the seed, those most alike first, until it is in one class with the centre; what is in one class already is
   not compared. So runs of a passage that holds their seeds are linked, if by way of others, and the links grow with the runs and
   not with their pairs. A name of many runs is dealt out in blocks of BLOCK; what is left apart in one meets all other blocks.
   Of equal texts the one of the smallest id takes part, the others are linked to it as a whole. Words are verified by
   32-bit hashes.

Not found: passages alike as sets only, whose shared parts repeat in another order and are all shorter than such a piece.
Some passages of repeated lines are not found either where the other side has under MIN_WORDS words.
Defined results: NULL and empty texts and texts of under MIN_WORDS words have no passage; repeats inside one document
and rows that repeat id and text are not reported; rows that share an id, or have none, and differ in text are documents of
their own; ``other_id`` is the smaller id, NULL the smallest; very long texts are taken whole; an empty table has no passages.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.llm.common import SHINGLE, SIMILARITY, content_words, may_match, small_batches, text_of
from rowsmith.llm.suffixes import NO_ID, lists, sliding_min
from rowsmith.session import materialise

MIN_WORDS = 50
# Words of a seed, more than a common line has. Every unbroken stretch keeps its least seed, so one function does.
SEED_WORDS = 16
HASHES = 1
NEED = 1
SEED = 8
# How far two diagonals of one passage may lie apart: words put in or left out.
SLACK = 24
# Runs of a name that are compared in one piece of work.
BLOCK = 2000
# Where two whole numbers share a 64-bit field.
FIELD = 2**32


def identity(df: DataFrame, doc_id: str, text: str) -> list[Column]:
    """id and text of a document, as two whole numbers."""
    return [F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(F.md5(text_of(df, text))).alias("doc")]


def salts(hashes: int) -> np.ndarray:
    return np.random.default_rng(SEED).integers(1, 2**63, hashes, dtype=np.uint64)


def drawn(values: np.ndarray, salt: np.uint64) -> np.ndarray:
    x = (values.view(np.uint64) ^ salt) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def windows(order: np.ndarray, edges: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """l, c, r, by c, of every node of the Cartesian trees of texts laid end to end whose stretch has ``least`` places."""
    if len(order) < least:
        return (np.empty(0, np.int64),) * 3
    # Only the least place of some ``least`` neighbours has such a stretch, and what bounds a stretch has a wider one.
    low = sliding_min(order, least)
    none = np.zeros(least - 1, order.dtype)
    at = np.flatnonzero(~sliding_min(~np.concatenate([none, low, none]), least) == order)
    v, row = order[at], np.searchsorted(edges, at, "right") - 1
    n = len(at)
    # The nearest place before that is no larger, and behind that is smaller: each step skips what was skipped before.
    before, behind = np.arange(-1, n - 1), np.append(np.arange(1, n + 1), n)
    before[np.append(True, row[1:] != row[:-1])] = -1
    behind[:-1][np.append(row[1:] != row[:-1], True)] = n
    go = np.arange(n)
    while len(go := go[(before[go] >= 0) & (v[before[go]] > v[go])]):
        before[go] = before[before[go]]
    go = np.arange(n)
    while len(go := go[(behind[go] < n) & (v[np.minimum(behind[go], n - 1)] >= v[go])]):
        behind[go] = behind[behind[go]]
    l = np.where(before >= 0, at[before] + 1, edges[row])
    r = np.where(behind[:-1] < n, at[np.minimum(behind[:-1], n - 1)] - 1, edges[row + 1] - 1)
    wide = r - l + 1 >= least
    return l[wide], at[wide], r[wide]


def windows_of(order: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """``windows`` of one text."""
    return list(zip(*(x.tolist() for x in windows(order, np.array([0, len(order)]), least))))


def name_runs(values: np.ndarray, edges: np.ndarray, least: int, hashes: int, need: int):
    """(name, row, c, start, stop, hash) for every band of ``need`` functions: the runs of shortest passages, by first places,
    that have the same min-hashes; ``stop`` is the last place, c where the first min-hash lies, the hash that of all shingles."""
    salt = salts(hashes)
    # Sums of values times powers of an odd number: a difference, moved back to the power 0, is the hash of a stretch.
    base = 0x9E3779B97F4A7C15
    power, back = (np.multiply.accumulate(np.append(np.uint64(1), np.full(len(values), x, np.uint64))) for x in (base, pow(base, -1, 2**64)))
    total = np.append(np.uint64(0), np.cumsum(values.view(np.uint64) * power[:-1], dtype=np.uint64))
    for band in range(hashes // need):
        parts = []
        for f in range(band * need, (band + 1) * need):
            order = drawn(values, salt[f])
            l, c, r = windows(order, edges, least)
            parts.append((np.maximum(l, c - least + 1), np.minimum(c, r - least + 1), c, order[c]))
        start = np.sort(np.concatenate([part[0] for part in parts]))
        if not len(start):
            continue
        start = start[np.append(True, start[1:] != start[:-1])]
        own = [np.searchsorted(part[0], start, "right") - 1 for part in parts]
        stop = np.min([part[1][k] for part, k in zip(parts, own)], axis=0)
        stop = np.minimum(stop, np.append(start[1:] - 1, stop[-1]))
        name = np.full(len(start), band + 1, np.uint64)
        for part, k in zip(parts, own):
            name = (name ^ part[3][k]) * np.uint64(0x9E3779B97F4A7C15)
            name ^= name >> np.uint64(29)
        row = np.searchsorted(edges, start, "right") - 1
        # A loop has the same min-hashes again and again: one run.
        at = np.flatnonzero(np.append(True, (name[1:] != name[:-1]) | (row[1:] != row[:-1])))
        last = np.append(at[1:], len(start)) - 1
        row, first, end = row[at], start[at], stop[last]
        held = (total[end + least] - total[first]) * back[first]
        yield name[at].view(np.int64), row, parts[0][2][own[0][at]] - edges[row], first - edges[row], end - edges[row], held.view(np.int64)


def unbroken(least: int, threshold: float) -> int:
    """Words that two passages of ``least`` shingles or more share in one piece at least, if they have the similarity.

    With s shared shingles at most s * (1 - threshold) / threshold others stand in the two of them, and each break between
    two shared pieces, be it a word put in, left out or changed or a part moved, costs 2 * (SHINGLE - 1) or more.
    """
    fewest = max(1, int(np.ceil(2 * least * threshold / (1 + threshold) - 1e-9)))
    pieces = lambda s: int(s * (1 - threshold) / threshold / (2 * (SHINGLE - 1)) + 1e-9) + 1
    return min(-(-s // pieces(s)) for s in range(fewest, 20 * least)) + SHINGLE - 1


def stretch_runs(words: np.ndarray, edges: np.ndarray, least: int, piece: int, seed: int, hashes: int, need: int):
    """(name, row, c, start, stop, hash) of the runs of stretches of ``piece`` words that have the same least seed.

    start and stop are the first places of the first and the last passage of ``least`` words that hold such a stretch (the
    last may reach over the end of the text); the hash is that of all words of these passages.

    A seed of one word again and again names the loops of ``least`` words or more, all of which are alike. A passage with a
    shorter loop is only like one that shares an end of the loop, so each end is a run, named by seed and word beside it.
    """
    base = 0x9E3779B97F4A7C15
    power, back = (np.multiply.accumulate(np.append(np.uint64(1), np.full(len(words), x, np.uint64))) for x in (base, pow(base, -1, 2**64)))
    total = np.append(np.uint64(0), np.cumsum(drawn(words, np.uint64(SEED)) * power[:-1], dtype=np.uint64))
    first = np.arange(max(0, len(words) - seed + 1))
    seeds = (total[first + seed] - total[first]) * back[first]
    # Seeds that reach into the next text leave.
    stays = np.ones(len(words), bool)
    for k in range(1, seed):
        stays[edges[1:] - k] = False
    places = edges - (seed - 1) * np.arange(len(edges))
    opens = np.append(True, words[1:] != words[:-1])
    opens[edges[:-1][np.diff(edges) > 0]] = True
    begin, loop = np.flatnonzero(opens), np.cumsum(opens) - 1
    for name, row, c, start, stop, _ in name_runs(seeds[stays[: len(seeds)]].view(np.int64), places, piece - seed + 1, hashes, need):
        first, behind = begin[loop[edges[row] + c]], np.append(begin[1:], len(words))[loop[edges[row] + c]]
        looped = behind - first >= seed
        stays_ = ~looped | (behind - first >= least)
        parts = [(name[stays_], row[stays_], c[stays_], np.maximum(0, start - (least - piece))[stays_], stop[stays_])]
        for side, at, beside, there in ((1, first - 1, first - 1, first > edges[row]), (2, behind - SHINGLE + 1, behind, behind < edges[row + 1])):
            k = np.flatnonzero(looped & there)
            at = at[k] - edges[row[k]]
            parts.append((name[k] ^ drawn(words[beside[k]], np.uint64(side)).view(np.int64), row[k], at, np.maximum(0, at - (least - SHINGLE)), at))
        name, row, c, start, stop = (np.concatenate(x) for x in zip(*parts))
        low, high = edges[row] + start, np.minimum(edges[row] + stop + least, edges[row + 1])
        yield name, row, c, start, stop, ((total[high] - total[low]) * back[low]).view(np.int64)


def _runs(df: DataFrame, doc_id: str, text: str, least: int, piece: int, seed: int, hashes: int, need: int) -> DataFrame:
    """name, id, doc, c, the first and last place of the passages and the hash of the words of every run."""
    words = F.transform(content_words(text_of(df, text)), lambda w: F.xxhash64(w))
    base = df.select(*identity(df, doc_id, text), words.alias("w")).where(F.size("w") >= least)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, edges = lists(batch.column("w"))
            if not len(words):
                continue
            for names, row, c, start, stop, held in stretch_runs(words, edges, least, piece, seed, hashes, need):
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), batch.column("id").take(take), batch.column("doc").take(take), pa.array(c.astype(np.int32)), pa.array(start * FIELD + stop), pa.array(held)],
                    names=["name", "id", "doc", "c", "run", "held"],
                )

    return base.mapInArrow(name, "name long, id long, doc long, c int, run long, held long")


def best_run(hit: np.ndarray, threshold: float) -> tuple[int, int]:
    """The stretch with the largest surplus of hits over ``threshold``: [start, stop)."""
    total = np.concatenate([[0.0], np.cumsum(np.where(hit, 1 - threshold, -threshold))])
    lowest = np.minimum.accumulate(total)
    stop = int(np.argmax(total - lowest))
    return int(np.flatnonzero(total[: stop + 1] == lowest[stop])[-1]), stop


def aligned(sa: np.ndarray, sb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the longest rising chain of equal shingles; the k-th copy of a shingle meets the k-th one."""

    def copies(x: np.ndarray) -> np.ndarray:
        order = np.argsort(x, kind="stable")
        new = np.concatenate([[True], x[order][1:] != x[order][:-1]])
        out = np.empty(len(x), np.int64)
        out[order] = np.arange(len(x)) - np.flatnonzero(new)[np.cumsum(new) - 1]
        return out

    if not len(sa) or not len(sb):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    mix = lambda x: x + copies(x).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    _, i, j = np.intersect1d(mix(sa), mix(sb), assume_unique=True, return_indices=True)
    order = np.argsort(i)
    i, j = i[order], j[order]
    if (np.diff(j) > 0).all():
        return i, j
    tops, at, before = [], [], np.full(len(j), -1, np.int64)
    for k, place in enumerate(j.tolist()):
        n = bisect_left(tops, place)
        before[k] = at[n - 1] if n else -1
        if n == len(tops):
            tops.append(place)
            at.append(k)
        else:
            tops[n], at[n] = place, k
    chain, k = [], at[-1]
    while k >= 0:
        chain.append(k)
        k = int(before[k])
    return i[chain[::-1]], j[chain[::-1]]


def best_pair(i: np.ndarray, j: np.ndarray, least: int, threshold: float) -> tuple[int, int] | None:
    """First and last match of the stretch with the largest surplus of shared over ``threshold`` x all shingles.

    Both stretches have ``least`` places at least; one that is shorter is filled up with places that are not shared. So
    there is a surplus if and only if some stretch with these matches has the similarity.
    """
    n = len(i)
    if not n:
        return None
    # shared - threshold * (length in a + length in b - shared), as a difference of two prefix sums.
    rise = (1 + threshold) * np.arange(n) - threshold * (i + j)
    full = np.minimum(np.searchsorted(i, i - least + 1, "right"), np.searchsorted(j, j - least + 1, "right")) - 1
    lowest = np.minimum.accumulate(rise)
    gain = np.where(full >= 0, rise - lowest[np.maximum(full, 0)], -np.inf)
    last = int(np.argmax(gain))
    base = 1 + threshold - 2 * threshold
    if gain[last] + base >= -1e-9:
        return int(np.flatnonzero(rise[: full[last] + 1] == lowest[full[last]])[-1]), last
    best, found = -1e-9, None
    # Fewer shared places do not do even for the shortest stretches, and with more of them both stretches were full above.
    for d in range(max(0, int(np.ceil(2 * least * threshold / (1 + threshold) - 1e-9)) - 1), min(n, least)):
        spans = [x[d:] - x[: n - d] + 1 for x in (i, j)]
        score = (1 + threshold) * (d + 1) - threshold * (np.maximum(spans[0], least) + np.maximum(spans[1], least))
        first = int(np.argmax(score))
        if score[first] >= best:
            best, found = score[first], (first, first + d)
    return found


def shingles(words: np.ndarray) -> np.ndarray:
    """64-bit hashes of five-word windows of word hashes."""
    n = len(words) - SHINGLE + 1
    key = np.zeros(max(0, n), np.uint64)
    for k in range(SHINGLE):
        if n > 0:
            key = (key ^ words[k : k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(31)
    return key


def similarity_of(a: np.ndarray, b: np.ndarray) -> float:
    mine, theirs = np.unique(a), np.unique(b)
    shared = len(np.intersect1d(mine, theirs, assume_unique=True))
    return shared / max(1, len(mine) + len(theirs) - shared)


def verified(a: np.ndarray, b: np.ndarray, least: int, threshold: float) -> list[tuple[int, int, int, int, float]]:
    """[start, stop) in both lists of word hashes, in words, and the similarity, of every near-duplicate stretch."""
    return stretches(shingles(a), shingles(b), least, threshold)


def stretches(sa: np.ndarray, sb: np.ndarray, least: int, threshold: float, place: int = -1) -> list[tuple[int, int, int, int, float]]:
    """``verified`` of lists of shingles; with a ``place`` in the first one what does not lead to the stretch that holds it may be left out."""
    open_, out = [(0, len(sa))], []
    if len(sb) < least or len(sa) < least:
        return out
    # Small whole numbers for the shingles: what the other list has is read off a table.
    kinds, key = np.unique(np.concatenate([sa, sb]), return_inverse=True)
    ka, kb, once = key[: len(sa)], key[len(sa) :], np.bincount(key, minlength=len(kinds))
    where = np.full(len(kinds), -1)
    where[kb] = np.arange(len(kb))
    there = where[ka]
    # No shingle stands twice in one list: each has one partner at most.
    plain = once.max() <= 2 and np.count_nonzero(there >= 0) == len(sa) + len(sb) - len(kinds)
    # What is found below has a surplus of shared places over the threshold, on ``least`` places or more.
    hits, fewest = np.append(0, np.cumsum(there >= 0)), threshold * least / (2 - threshold) - 1e-9
    if hits[-1] < least * threshold - 1e-9:
        return out

    def alike(start: int, stop: int, first: int, last: int) -> float:
        if not plain:
            return similarity_of(sa[start:stop], sb[first:last])
        shared = int(np.count_nonzero((there[start:stop] >= first) & (there[start:stop] < last)))
        return shared / max(1, stop - start + last - first - shared)

    while open_:
        low, high = open_.pop()
        # As in ``may_hold``.
        if high - low < least or (hits[low + least : high + 1] - hits[low : high - least + 1]).max() < fewest:
            continue
        if plain and (np.diff((own := there[low:high])[i := np.flatnonzero(own >= 0)]) > 0).all():
            j = own[i]
        else:
            i, j = aligned(sa[low:high], sb)
        pair = best_pair(i, j, least, threshold)
        if pair:
            p, q = pair
            # A run that is too short is filled up behind, and before if the text ends.
            start, stop = int(i[p]) + low, int(i[q]) + low + 1
            first, last = int(j[p]), int(j[q]) + 1
            stop, last = max(stop, min(high, start + least)), max(last, min(len(sb), first + least))
            start, first = min(start, max(low, stop - least)), min(first, max(0, last - least))
            similarity = alike(start, stop, first, last)
        if not pair or similarity < threshold - 1e-9:
            # Without regard to order, for parts that have changed places and for shingles that repeat.
            start, stop = best_run(there[low:high] >= 0, threshold)
            start, stop = start + low, stop + low
            if stop - start < least:
                continue
            own = np.zeros(len(kinds), bool)
            own[ka[start:stop]] = True
            first, last = best_run(own[kb], threshold)
            similarity = alike(start, stop, first, last) if last > first else 0.0
        if similarity >= threshold - 1e-9:
            out.append((start, stop + SHINGLE - 1, first, last + SHINGLE - 1, similarity))
        open_ += [x for x in ((low, start), (stop, high)) if place < 0 or x[0] <= place < x[1]]
    return out


def may_hold(a: np.ndarray, ea: np.ndarray, b: np.ndarray, eb: np.ndarray, least: int, threshold: float) -> np.ndarray:
    """Whether both sides of each pair of word lists, laid end to end, have ``least`` neighbouring shingles with enough that the other has.

    A stretch of ``least`` places or more of which the share ``threshold`` is hit has ``least`` neighbours with
    threshold * least / (2 - threshold) hits: with at most h in any of them, k * least + d places have at most k * h + min(d, h).
    """
    keys, edges = [], []
    for words, borders in ((a, ea), (b, eb)):
        rows = np.repeat(np.arange(len(borders) - 1, dtype=np.uint64), np.diff(borders))
        found = shingles(words)
        key = found ^ (rows[: len(found)] + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        # Those that reach into the next list are like none.
        key[rows[: len(found)] != rows[SHINGLE - 1 :]] = 0
        keys.append(key)
        edges.append(borders)
    fewest, out = threshold * least / (2 - threshold) - 1e-9, np.ones(len(ea) - 1, bool)
    for mine, other, borders in ((keys[0], keys[1], edges[0]), (keys[1], keys[0], edges[1])):
        hits = np.append(0, np.cumsum(np.isin(mine, other) & (mine != 0)))
        most = np.zeros(len(borders) - 1, np.int64)
        if len(mine) >= least:
            at = np.arange(len(mine) - least + 1)
            row = np.searchsorted(borders, at, "right") - 1
            # A stretch that reaches into the next list is none.
            at, row = (x[at + least + SHINGLE - 1 <= borders[row + 1]] for x in (at, row))
            np.maximum.at(most, row, hits[at + least] - hits[at])
        out &= most >= fewest
    return out


def surplus(hits: np.ndarray, there: np.ndarray, seed: int, least: int, gain: float, cost: float) -> np.ndarray:
    """For each row the largest sum, a hit counted as ``gain`` and any other place as -``cost``, of a stretch of ``least``
    places or more that holds the place ``seed`` and only places that are there."""
    step = np.where(there, np.where(hits, gain, -cost), -1e6)
    total = np.concatenate([np.zeros((len(hits), 1)), np.cumsum(step, axis=1)], axis=1)
    lowest = np.minimum.accumulate(total[:, : seed + 1], axis=1)
    stop = np.arange(max(seed + 1, least), total.shape[1])
    return (total[:, stop] - lowest[:, np.minimum(seed, stop - least)]).max(axis=1) if len(stop) else np.full(len(hits), -np.inf)


def joined(
    words: np.ndarray, edges: np.ndarray, at: np.ndarray, who: np.ndarray, label: np.ndarray, side: np.ndarray, least: int, threshold: float
) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links that bring the runs of a name into as few classes as all pairs of them would, and the class of each.

    The words around a run's seed, which begins ``at`` a place in them, lie end to end. ``who`` is its document, later ones
    with larger numbers, ``label`` its class so far. Those of a class other than 0 meet all of other documents, sides and
    classes, those most alike first, until they are in class 0: a pair that is in one class already is not compared.
    """
    n, classes, out = len(edges) - 1, label.copy(), []
    row, found = np.repeat(np.arange(n), np.diff(edges)), shingles(words)
    whole = np.flatnonzero(row[: len(found)] == row[SHINGLE - 1 :])
    if not len(whole):
        return out, classes
    place = (np.arange(len(words)) - edges[row] - at[row])[whole]
    seed, (kinds, key) = -min(0, int(place.min())), np.unique(found[whole], return_inverse=True)
    none = len(kinds)
    # The shingles of each run, those at the seed below one another.
    table = np.full((n, max(0, int(place.max())) + seed + 1), none)
    table[row[whole], place + seed] = key
    there, ranked = table != none, np.sort(table, axis=1)
    repeats = ((ranked[:, 1:] == ranked[:, :-1]) & (ranked[:, 1:] != none)).any(axis=1)
    for i in np.flatnonzero((label > 0) & (side > 0)).tolist():
        held = np.zeros(none + 1, bool)
        held[table[i]] = True
        held[none] = False
        # What is found has the share ``threshold`` of hits on either side, and if no shingle repeats on both together too.
        # Where one does the earlier document's side may be shorter, and hold another copy of the seed.
        others = np.flatnonzero((classes != classes[i]) & (who != who[i]) & (side != side[i]))
        theirs = held[table[others]]
        stays = (theirs.sum(axis=1) >= threshold * least - 1e-9) | repeats[i] | repeats[others]
        others, theirs = others[stays], theirs[stays]
        if not len(others) or classes[i] == 0:
            continue
        first = np.zeros(none + 1, np.int64)
        first[table[i][::-1]] = np.arange(table.shape[1])[::-1]
        mine, (r, c) = np.zeros(theirs.shape, bool), np.nonzero(theirs)
        mine[r, first[table[others[r], c]]] = True
        mine = mine[:, first[table[i]]] & there[i]
        sides = [(mine, np.broadcast_to(there[i], mine.shape)), (theirs, there[others])]
        alike = [surplus(*x, seed, least, 1 - threshold, threshold) >= -1e-6 for x in sides]
        score = sum(surplus(*x, seed, least, (1 - threshold) / 2, threshold) for x in sides)
        again = repeats[i] | repeats[others]
        stays = np.where(again, np.where(who[i] > who[others], *alike), alike[0] & alike[1] & (score >= -1e-6))
        for j in others[stays][np.argsort(-score[stays], kind="stable")].tolist():
            if classes[i] == 0:
                break
            if classes[i] == classes[j]:
                continue
            a, b = (i, j) if who[i] > who[j] else (j, i)
            # Only a pair with repeats may be one by the seed of its second side alone.
            place = int(at[a]) if a == i or not (repeats[a] or repeats[b]) else -1
            lists_ = (found[edges[x] : max(edges[x], edges[x + 1] - SHINGLE + 1)] for x in (a, b))
            for start, stop, low, high, _ in stretches(*lists_, least, threshold, place):
                inside = [start <= at[a] <= stop - SHINGLE, low <= at[b] <= high - SHINGLE]
                if all(inside) or (repeats[a] or repeats[b]) and inside[a != i]:
                    out.append((i, j))
                    classes[classes == max(classes[i], classes[j])] = min(classes[i], classes[j])
                    break
    return out, classes


REGION = "ia int, ja int, ib int, jb int"
PAIR = ["id", "doc", "other_id", "other"]
RUN = ["name", "id", "doc", "c", "run"]


def _words(df: DataFrame, wanted: DataFrame, doc: str, doc_id: str, text: str) -> DataFrame:
    """id, doc and the 32-bit hashes of the words of documents; most that are not ``wanted`` leave before they are split."""
    words = F.transform(content_words(F.col("t")), lambda w: F.shiftright(F.xxhash64(w), 32).cast("int"))
    return may_match(df.select(*identity(df, doc_id, text), text_of(df, text).alias("t")), F.col("doc"), wanted, F.col(doc)).select("id", "doc", words.alias("w"))


def _verified(df: DataFrame, links: DataFrame, doc_id: str, text: str, least: int, threshold: float, label: str) -> DataFrame:
    """Passages of ``links``, pairs of runs (id, doc, c, run and the same of the other one), by the document behind."""
    turn = F.struct("id", "doc") < F.struct(F.col("other_id").alias("id"), F.col("other").alias("doc"))
    pick = lambda a, b, name: F.when(turn, F.col(b)).otherwise(F.col(a)).alias(name)
    sides = [("id", "other_id"), ("doc", "other"), ("c", "other_c"), ("run", "other_run")]
    links = links.select(*[pick(a, b, a) for a, b in sides], *[pick(b, a, b) for a, b in sides])
    low = lambda x: x.bitwiseAND(F.lit(FIELD - 1))
    high = lambda x: F.shiftright(x, 32)
    # Whole numbers only: a hash aggregate, mostly done before the shuffle.
    diagonals = links.groupBy(*PAIR, (F.col("c") - F.col("other_c")).cast("long").alias("shift")).agg(
        F.min(high(F.col("run"))).alias("ia"), F.max(low(F.col("run"))).alias("ja"), F.min(high(F.col("other_run"))).alias("ib"), F.max(low(F.col("other_run"))).alias("jb")
    )
    pairs = diagonals.groupBy(*PAIR).agg(F.collect_list(F.struct("shift", "ia", "ja", "ib", "jb")).alias("d"))

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("d")
            flat, edges = rows.flatten(), rows.offsets.to_numpy().astype(np.int64)
            edges = edges - edges[0]
            table = np.stack([flat.field(k).to_numpy() for k in range(5)], axis=1) if len(flat) else np.empty((0, 5), np.int64)
            at, found = [], []
            for row in range(batch.num_rows):
                own = table[edges[row] : edges[row + 1]]
                own = own[np.argsort(own[:, 0], kind="stable")]
                for part in np.split(own, np.flatnonzero(np.diff(own[:, 0]) > SLACK) + 1):
                    at.append(row)
                    low, high = part.min(axis=0), part.max(axis=0)
                    # Words put in or left out move the ends by SLACK at most.
                    found.append((max(0, low[1] - SLACK), high[2] + least - 1 + SLACK, max(0, low[3] - SLACK), high[4] + least - 1 + SLACK))
            take, regions = pa.array(at, pa.int64()), np.array(found, np.int32).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(take) for c in PAIR], *[pa.array(regions[:, k].copy()) for k in range(4)]], names=[*PAIR, "ia", "ja", "ib", "jb"]
            )

    regions = materialise(pairs.mapInArrow(cover, "id long, doc long, other_id long, other long, " + REGION), f"{label}-regions")
    name = F.xxhash64(*PAIR, "ia", "ja", "ib", "jb")
    pair = F.struct(*PAIR, "ia", "ib").alias("pair")
    sides = regions.select(name.alias("name"), pair, F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("id").alias("in_id"), F.col("doc").alias("in"), F.col("ia").alias("i"), F.col("ja").alias("j")),
        F.struct(F.lit(1).alias("side"), F.col("other_id").alias("in_id"), F.col("other").alias("in"), F.col("ib").alias("i"), F.col("jb").alias("j")),
    )).alias("s")).select("name", "pair", "s.*")
    # Only the words of the stretches travel on; a text is split once, and its stretches are not gathered in one row.
    whole = _words(df, sides, "in", doc_id, text)
    cut = sides.join(whole, (F.col("id") == F.col("in_id")) & (F.col("doc") == F.col("in"))).select(
        "name", "pair", "side", F.slice("w", F.col("i") + 1, F.col("j") - F.col("i") + SHINGLE).alias("w")
    )
    # Two rows per name; equal rows bring more, one of each side is taken.
    both = cut.groupBy("name").agg(
        F.first("pair").alias("pair"), F.max(F.when(F.col("side") == 0, F.col("w"))).alias("a"), F.max(F.when(F.col("side") == 1, F.col("w"))).alias("b")
    ).select("pair.*", F.coalesce("a", F.array().cast("array<int>")).alias("a"), F.coalesce("b", F.array().cast("array<int>")).alias("b"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (a, ea), (b, eb) = lists(batch.column("a")), lists(batch.column("b"))
            ia, ib = (batch.column(c).to_numpy() for c in ("ia", "ib"))
            at, out = [], []
            for k in np.flatnonzero(may_hold(a, ea, b, eb, least, threshold)).tolist():
                for start, stop, first, last, similarity in verified(a[ea[k] : ea[k + 1]], b[eb[k] : eb[k + 1]], least, threshold):
                    at.append(k)
                    out.append((ia[k] + start, ia[k] + stop, ib[k] + first, ib[k] + last, similarity))
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.int64()] * 4 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(pa.array(at, pa.int64())) for c in PAIR], *[pa.array(c, kind) for c, kind in zip(columns, kinds)]],
                names=[*PAIR, "start_word", "end_word", "other_start", "other_end", "similarity"],
            )

    kinds = "id long, doc long, other_id long, other long, start_word long, end_word long, other_start long, other_end long, similarity double"
    return materialise(both.mapInArrow(verify, kinds), label)


def _left(df: DataFrame, met: DataFrame, found: DataFrame, doc_id: str, text: str, least: int, threshold: float) -> DataFrame:
    """Links of the runs that lie in no passage found with their partner, to others of the name that they are like."""
    # The head of a name has met all the others, and runs with the words of another one go with it.
    rows = met.withColumn("pair", F.xxhash64(*PAIR))
    ways = [("id", "doc", "other_id", "other", "start_word", "end_word"), ("other_id", "other", "id", "doc", "other_start", "other_end")]
    one, two = (found.select(F.xxhash64(*way[:4]).alias("pair"), F.col(way[4]).alias("start"), F.col(way[5]).alias("end")) for way in ways)
    inside = one.unionByName(two).groupBy("pair").agg(F.collect_list(F.struct("start", "end")).alias("in"))
    lies = F.exists("in", lambda p: (p["start"] <= F.col("c")) & (F.col("c") + SHINGLE <= p["end"]))
    spots = rows.select("pair", "c").distinct().join(inside, "pair", "left").where(F.col("in").isNull() | ~lies).select("pair", "c")
    spots = materialise(spots, "spots")
    open_ = may_match(rows, F.xxhash64("pair", "c"), spots, F.xxhash64("pair", "c")).join(spots, ["pair", "c"], "left_semi")
    open_ = materialise(open_.select(*RUN).distinct(), "open")
    others = may_match(rows, F.col("name"), open_, F.col("name")).select(*RUN, F.lit(0).alias("open"))
    members = others.unionByName(open_.withColumn("open", F.lit(1))).repartition("name").groupBy(*RUN).agg(F.max("open").alias("open"))
    name = Window.partitionBy("name")
    members = members.withColumn("low", F.min("doc").over(name)).withColumn("high", F.max("doc").over(name)).withColumn("some", F.max("open").over(name))
    # A name of many runs is dealt out in blocks.
    members = members.withColumn("blocks", F.ceil(F.count("*").over(name) / BLOCK).cast("int")).where("low <> high and some = 1")
    members = members.select(*RUN, "open", "blocks", F.pmod(F.xxhash64("id", "doc", "c"), F.col("blocks")).cast("int").alias("block"))
    members = materialise(members, "members")
    label = F.when(F.col("open") == 1, F.xxhash64("id", "doc", "c")).otherwise(0).alias("label")
    first = _joined(df, members.select(*RUN, "blocks", "block", F.lit(0).alias("guests"), F.lit(0).alias("guest"), label), doc_id, text, least, threshold, "joined")
    links = first.where("other is not null")
    apart = first.where("other is null").select(*RUN, "blocks", "block", "label").distinct()
    if not apart.isEmpty():
        # Those of one block that are not like the centre, by way of others, meet all other blocks of the name.
        homes = apart.groupBy("name").agg(F.collect_set("block").alias("homes"))
        hosts = members.join(apart.select(*RUN, "label"), RUN, "left").join(homes, "name").select(*RUN, "blocks", "block", F.explode("homes").alias("guests"), F.lit(0).alias("guest"), F.coalesce("label", F.lit(0).cast("long")).alias("label"))
        guests = apart.select(*RUN, "blocks", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("to"), F.col("block").alias("guests"), F.lit(1).alias("guest"), "label").withColumnRenamed("to", "block")
        links = links.unionByName(_joined(df, hosts.unionByName(guests).where("block <> guests"), doc_id, text, least, threshold, "blocks"))
    # Documents that are linked meet by all runs of which one is open: a passage is verified as a whole.
    links = links.select(*PAIR)
    pairs = links.unionByName(links.select(F.col("other_id").alias("id"), F.col("other").alias("doc"), F.col("id").alias("other_id"), F.col("doc").alias("other"))).distinct()
    key = F.xxhash64("name", "id", "doc")
    from_ = open_.join(pairs, ["id", "doc"])
    to = may_match(others, key, from_, F.xxhash64("name", "other_id", "other"))
    to = to.select("name", *[F.col(a).alias(b) for a, b in (("id", "other_id"), ("doc", "other"), ("c", "other_c"), ("run", "other_run"))])
    return from_.join(to, ["name", "other_id", "other"])


def _joined(df: DataFrame, units: DataFrame, doc_id: str, text: str, least: int, threshold: float, label: str) -> DataFrame:
    """Links (other not NULL) of the runs of each (name, block, guests), and, of a name of many blocks, the runs that are in
    no class with its centre (other NULL) with their class."""
    reach = 2 * (least + SHINGLE - 1)
    start = F.greatest(F.col("c") - reach, F.lit(0))
    words = F.slice("w", start + 1, F.col("c") - start + reach).alias("w")
    cut = units.join(_words(df, units, "doc", doc_id, text), ["id", "doc"]).select(*units.columns, (F.col("c") - start).alias("at"), words)
    unit = ["name", "block", "guests"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = [*RUN, "blocks", "block", "other_id", "other", "label"]

    def link(part: pa.Table, borders: list[int]) -> Iterator[pa.RecordBatch]:
        words, edges = lists(part.column("w").combine_chunks())
        get = {c: part.column(c).to_numpy() for c in (*RUN, "blocks", "block", "guest", "label", "at")}
        take, other, is_link = [], [], []
        for low, high in zip(borders[:-1], borders[1:]):
            rows = slice(low, high)
            who = np.unique(np.stack([get["id"][rows], get["doc"][rows]], axis=1), axis=0, return_inverse=True)[1].reshape(-1)
            # Class 0 stays, the others are numbered.
            given = get["label"][rows]
            known = np.unique(given[given != 0])
            classes = np.where(given == 0, 0, 1 + np.searchsorted(known, given))
            single = not get["guest"][rows].any()
            side = 1 + np.arange(high - low) if single else get["guest"][rows]
            pairs, classes = joined(words[edges[low] : edges[high]], edges[low : high + 1] - edges[low], get["at"][rows], who, classes, side, least, threshold)
            for i, j in pairs:
                take.append(low + i)
                other.append(low + j)
                is_link.append(True)
            if single and get["blocks"][low] > 1:
                for i in np.flatnonzero(classes).tolist():
                    take.append(low + i)
                    other.append(low + int(np.flatnonzero(classes == classes[i])[0]))
                    is_link.append(False)
        take, other, none = np.array(take, np.int64), np.array(other, np.int64), ~np.array(is_link, bool)
        columns = [get[c][take] for c in (*RUN, "blocks", "block")]
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(x, kind) for x, kind in zip(columns, kinds)], pa.array(get["id"][other], kinds[7], mask=none), pa.array(get["doc"][other], kinds[8], mask=none), pa.array(get["label"][other], kinds[9])],
            names=names,
        )

    def link_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            part = pa.concat_tables([rest, part]) if rest is not None else part
            # Rows of the table that repeat id and text bring a run more than once.
            again = np.logical_and.reduce([np.diff(part.column(c).to_numpy()) == 0 for c in (*unit, "id", "doc", "c", "run")])
            part = part.filter(pa.array(np.append(True, ~again)))
            turns = np.logical_or.reduce([np.diff(part.column(c).to_numpy()) != 0 for c in unit])
            borders = [0, *(np.flatnonzero(turns) + 1).tolist()]
            # The last unit may go on in the next batch.
            rest = part.slice(borders[-1])
            if len(borders) > 1:
                yield from link(part.slice(0, borders[-1]).combine_chunks(), borders)
        if rest is not None and rest.num_rows:
            yield from link(rest.combine_chunks(), [0, rest.num_rows])

    dealt = cut.repartition(*unit).sortWithinPartitions(*unit, "id", "doc", "c")
    return materialise(dealt.mapInArrow(link_all, "name long, id long, doc long, c int, run long, blocks int, block int, other_id long, other long, label long"), label)


def _copies(df: DataFrame, doc_id: str, text: str, min_words: int) -> DataFrame:
    """Texts that are equal: each row beside the one of the smallest id."""
    keys = df.select(*identity(df, doc_id, text)).distinct()
    later = keys.withColumn("other_id", F.min("id").over(Window.partitionBy("doc"))).where("id <> other_id")
    key = F.xxhash64("id", "doc")
    texts = may_match(df.select(*identity(df, doc_id, text), text_of(df, text).alias("t")), key, later, key)
    sizes = texts.select("id", "doc", F.size(content_words(F.col("t"))).cast("long").alias("end_word")).where(F.col("end_word") >= min_words)
    zero = F.lit(0).cast("long")
    return later.join(sizes, ["id", "doc"]).select(
        "id", "doc", "other_id", F.col("doc").alias("other"), zero.alias("start_word"), "end_word", zero.alias("other_start"), F.col("end_word").alias("other_end"), F.lit(1.0).alias("similarity")
    )


def passages(
    df: DataFrame, min_words: int = MIN_WORDS, threshold: float = SIMILARITY, hashes: int = HASHES, need: int = NEED,
    doc_id: str = "doc_id", text: str = "text", seed_words: int = SEED_WORDS,
) -> DataFrame:
    """doc_id, start_word, end_word, other_id, other_start, other_end, similarity; ends exclusive, ``other_id`` smaller."""
    small_batches(df.sparkSession)
    least = min_words - SHINGLE + 1
    piece = unbroken(least, threshold)
    runs = _runs(df, doc_id, text, min_words, piece, min(seed_words, piece), hashes, need)
    # One shuffle for both windows. A text's first id stands for its copies, which are linked to it below.
    copies = Window.partitionBy("name", "doc").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = runs.repartition("name").withColumn("first", F.first("id").over(copies)).where("id = first").drop("first")
    place = F.struct("id", "doc", "c", "run")
    name = Window.partitionBy("name")
    bound = runs.withColumn("low", F.min(place).over(name)).withColumn("high", F.max(place).over(name)).where("low.doc <> high.doc")
    # Of runs with the same words the one of the smallest id meets the others of the name; the rest meet that one.
    same = Window.partitionBy("name", "held", F.col("c") - F.shiftright("run", 32)).orderBy("id", "doc", "c").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    alike = Window.partitionBy("name", "held", F.col("c") - F.shiftright("run", 32))
    bound = bound.withColumn("like", F.first(place).over(same)).withColumn("n", F.count("*").over(alike))
    # The words most runs of the name have are what edited copies come from: fewest are unlike them.
    bound = bound.withColumn("most", F.min(F.struct(-F.col("n"), "like")).over(name)["like"])
    is_ = lambda x: (F.col("id") == F.col(f"{x}.id")) & (F.col("doc") == F.col(f"{x}.doc"))
    stands = is_("like") & (F.col("c") == F.col("like.c"))
    head = (is_("most") & (F.col("c") == F.col("most.c"))) | ~stands
    centre = F.when(~is_("most"), F.col("most")).when((F.col("most.id") == F.col("low.id")) & (F.col("most.doc") == F.col("low.doc")), F.col("high")).otherwise(F.col("low"))
    partner = F.when(is_("low"), F.col("high")).when(is_("like"), F.col("low")).otherwise(F.col("like"))
    bound = bound.select("name", "id", "doc", "c", "run", head.alias("head"), partner.alias("p"), centre.alias("m"))
    met = materialise(bound, "met")
    to = lambda x: [F.col(f"{x}.{a}").alias(b) for a, b in (("id", "other_id"), ("doc", "other"), ("c", "other_c"), ("run", "other_run"))]
    own = ["name", "id", "doc", "c", "run", "head"]
    links = met.select(*own, *to("p")).unionByName(met.where("not head and m <> p").select(*own, *to("m")))
    found = _verified(df, links, doc_id, text, least, threshold, "found")
    met = met.where("not head").select(*own, *to("m"))
    found = found.unionByName(_verified(df, _left(df, met, found, doc_id, text, least, threshold), doc_id, text, least, threshold, "rest")).unionByName(_copies(df, doc_id, text, min_words))
    return found.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias(doc_id), "start_word", "end_word",
        F.when(F.col("other_id") != NO_ID, F.col("other_id")).alias("other_id"), "other_start", "other_end", "similarity",
    ).distinct()
