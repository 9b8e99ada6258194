"""Ordered line diff: where lines went out, came in or moved, as hunks that turn the old text into the new one.

Pairs of texts meet by an equi-join on their keys; each pair is compared inside its row, so a pair is bounded by its two
cells and no line is shuffled. The comparison is a patience diff: lines that stand once on either side are anchors, the
longest chain of anchors in the same order on both sides is kept, and what lies between two of them is compared by the
shortest edit script. Lines that the other side lacks take no part in that.

A missing or NULL text has no lines, as an empty one. Line numbers start at 0; a hunk that takes nothing out stands before
``old_start``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from rowsmith.functions import text as T

# Edit steps after which the path that has come furthest is kept as it is, so a pair costs at most about STEPS steps per
# STEPS lines; below that the script between two anchors is a shortest one.
STEPS = 1000
HUNK = "hunk_no long, old_start long, old_count long, new_start long, new_count long, removed array<string>, added array<string>"


def _chain(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of ``pairs`` (rising in the first) that rises in the second."""
    tops, ends, before = [], [], []
    for k, (_, b) in enumerate(pairs):
        at = bisect_left(tops, b)
        before.append(ends[at - 1] if at else -1)
        tops[at : at + 1] = [b]
        ends[at : at + 1] = [k]
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def _shortest(a: list[str], b: list[str]) -> Iterator[tuple[int, int]]:
    """Places of equal lines along a shortest edit script, or along a good one where that takes over STEPS steps."""
    n, m = len(a), len(b)
    reach, trail, end = {1: 0}, [], None
    for d in range(min(n + m, STEPS) + 1):
        trail.append(dict(reach))
        for k in range(-d, d + 1, 2):
            down = k == -d or (k != d and reach.get(k - 1, -1) < reach.get(k + 1, -1))
            x = reach.get(k + 1, 0) if down else reach.get(k - 1, 0) + 1
            y = x - k
            while 0 <= y < m and x < n and a[x] == b[y]:
                x, y = x + 1, y + 1
            reach[k] = x
            if x >= n and y >= m:
                end = k
                break
        if end is not None:
            break
    if end is None:
        inside = [k for k, x in reach.items() if x <= n and 0 <= x - k <= m]
        end = max(inside, key=lambda k: 2 * reach[k] - k)
    x, y = reach[end], reach[end] - end
    stop, found = (x, y), []
    for d in range(len(trail) - 1, -1, -1):
        was, k = trail[d], x - y
        if abs(k) > d or (k - d) % 2:
            continue
        down = k == -d or (k != d and was.get(k - 1, -1) < was.get(k + 1, -1))
        last = k + 1 if down else k - 1
        px = was.get(last, 0)
        py = px - last
        while x > px and y > py and x > 0 and y > 0 and (x, y) != (px + (not down), py + down):
            x, y = x - 1, y - 1
            found.append((x, y))
        if d == 0:
            break
        x, y = px, py
    yield from reversed(found)
    if stop != (n, m) and stop != (0, 0):
        for i, j in _shortest(a[stop[0] :], b[stop[1] :]):
            yield stop[0] + i, stop[1] + j


def matches(old: list[str], new: list[str]) -> list[tuple[int, int]]:
    """(old line, new line) of every line that stays, rising on both sides."""
    found, todo = [], [(0, len(old), 0, len(new))]
    while todo:
        a, z, b, y = todo.pop()
        while a < z and b < y and old[a] == new[b]:
            found.append((a, b))
            a, b = a + 1, b + 1
        while a < z and b < y and old[z - 1] == new[y - 1]:
            z, y = z - 1, y - 1
            found.append((z, y))
        if a == z or b == y:
            continue
        left, right = Counter(old[a:z]), Counter(new[b:y])
        place = {line: j for j, line in enumerate(new[b:y], b) if right[line] == 1}
        anchors = _chain([(i, place[line]) for i, line in enumerate(old[a:z], a) if left[line] == 1 and line in place])
        if anchors:
            found += anchors
            for (i, j), (k, l) in zip([(a - 1, b - 1), *anchors], [*anchors, (z, y)]):
                todo.append((i + 1, k, j + 1, l))
            continue
        mine = [i for i in range(a, z) if old[i] in right]
        theirs = [j for j in range(b, y) if new[j] in left]
        if mine and theirs:
            found += [(mine[i], theirs[j]) for i, j in _shortest([old[i] for i in mine], [new[j] for j in theirs])]
    return sorted(found)


def hunks_of(old: list[str], new: list[str]) -> list[tuple[int, int, int, int]]:
    """(old start, old count, new start, new count) of every stretch that changes."""
    out, i, j = [], 0, 0
    for k, l in [*matches(old, new), (len(old), len(new))]:
        if k > i or l > j:
            out.append((i, k - i, j, l - j))
        i, j = k + 1, l + 1
    return out


def hunks(old: DataFrame, new: DataFrame, on: tuple[str, ...], text: str = "text") -> DataFrame:
    """One row per hunk of every pair: on, hunk_no, old_start, old_count, new_start, new_count, removed, added."""
    side = lambda df, name: df.select(*on, T.split_lines(F.coalesce(F.col(text), F.lit(""))).alias(name))
    empty = F.array().cast("array<string>")
    pairs = side(old, "_old").join(side(new, "_new"), list(on), "full_outer")
    pairs = pairs.select(*on, F.coalesce("_old", empty).alias("_old"), F.coalesce("_new", empty).alias("_new")).where("_old <> _new")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            olds, news = batch.column("_old"), batch.column("_new")
            for row in range(batch.num_rows):
                a, b = olds[row].as_py(), news[row].as_py()
                found = hunks_of(a, b)
                keys = [batch.column(k).take(pa.array([row] * len(found))) for k in range(len(on))]
                numbers = [pa.array(c, pa.int64()) for c in ([h for h, _ in enumerate(found)], *zip(*found))]
                removed = pa.array([a[s : s + n] for s, n, _, _ in found], pa.list_(pa.string()))
                added = pa.array([b[s : s + n] for _, _, s, n in found], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([*keys, *numbers, removed, added], names=names)

    schema = ST.StructType([*pairs.select(*on).schema.fields, *ST.StructType.fromDDL(HUNK).fields])
    names = schema.names
    return pairs.mapInArrow(compare, schema)


def patch(old: DataFrame, found: DataFrame, on: tuple[str, ...], text: str = "text") -> DataFrame:
    """on, text: the old texts with their hunks applied, their line ends unified; a pair without hunks stays as it is."""
    listed = found.groupBy(*on).agg(F.sort_array(F.collect_list(F.struct("hunk_no", "old_start", "old_count", "added"))).alias("_h"))
    whole = old.select(*on, T.split_lines(F.coalesce(F.col(text), F.lit(""))).alias("_l")).join(listed, list(on), "full_outer")
    lines = F.coalesce("_l", F.array().cast("array<string>"))
    hunk = F.coalesce("_h", F.array().cast(listed.schema["_h"].dataType))
    whole = whole.select(*on, lines.alias("_l"), hunk.alias("_h"))

    def end(h: Column) -> Column:
        return (h["old_start"] + h["old_count"]).cast("int")

    def piece(h: Column, i: Column) -> Column:
        """The lines that stay before a hunk, and those it brings."""
        since = F.when(i == 0, F.lit(0)).otherwise(end(F.get("_h", i - 1)))
        return F.concat(F.slice("_l", since + 1, h["old_start"].cast("int") - since), h["added"])

    last = F.when(F.size("_h") == 0, F.lit(0)).otherwise(end(F.get("_h", F.size("_h") - 1)))
    rest = F.slice("_l", last + 1, F.size("_l") - last)
    return whole.select(*on, F.array_join(F.concat(F.flatten(F.transform("_h", piece)), rest), "\n").alias(text))


def moves(found: DataFrame, on: tuple[str, ...]) -> DataFrame:
    """on, line, old_no, new_no: lines that one hunk takes out and another puts in; the n-th of equal ones with the n-th."""

    def side(column: str, start: str, name: str) -> DataFrame:
        rows = found.select(*on, F.col(start).alias("_s"), F.posexplode(column).alias("_i", "line"))
        rows = rows.select(*on, "line", (F.col("_s") + F.col("_i")).alias(name))
        # Equal lines of one text: as many as the text has.
        return rows.groupBy(*on, "line").agg(F.sort_array(F.collect_list(name)).alias(name))

    both = side("removed", "old_start", "old_no").join(side("added", "new_start", "new_no"), [*on, "line"])
    pairs = F.explode(F.slice(F.arrays_zip("old_no", "new_no"), 1, F.least(F.size("old_no"), F.size("new_no")))).alias("_p")
    return both.select(*on, "line", pairs).select(*on, "line", "_p.old_no", "_p.new_no")
