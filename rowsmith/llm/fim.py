"""Fill-in-the-middle transformation by one repeated-capture match a text.

``(unit)*`` is matched against the whole text once by the regex library, which keeps every repetition of a group:
``match.ends(1)`` is the list of the units' ends, so its length is the number of units and two look-ups in it are the two
cuts. A text is cut into prefix, middle and suffix and written as

    psm   <P>prefix<S>suffix<M>middle
    spm   <S>suffix<P>prefix<M>middle
    plain the text itself

Cuts and form are drawn from the SHA-256 digits of ``seed:doc_id``, so reruns and other machines agree. Each row is
worked on by itself: no shuffle, and rows travel to Python in batches that Spark bounds in bytes.

Defined results: a NULL text is empty; an empty text, a text that holds one of the sentinels and a text that the unit
does not cover whole stay plain, with NULL lengths; a NULL id draws as the empty string; rows with equal id and text are
transformed alike; very long texts are cut as any other, never shortened; an empty table gives an empty table; other
columns pass through, and a column that already has the result's name is refused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from rowsmith.llm.common import refuse_clash

LINES = r"[^\n]*\n|[^\n]+"
# What stands before the prefix, the suffix and the middle.
SENTINELS = ("<P>", "<S>", "<M>")
SEED = 7
PARTS = {"n": ST.LongType(), "form": ST.StringType(), "prefix_chars": ST.LongType(), "middle_chars": ST.LongType(), "output": ST.StringType()}
# Characters of output after which a batch is handed back.
FLUSH_CHARS = 16_000_000


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of one document."""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return int(digits[:8], 16), int(digits[8:16], 16), int(digits[16:24], 16), int(digits[24:32], 16)


def cut(
    text: str, numbers: tuple[int, int, int, int], units: regex.Pattern, sentinels: tuple[str, str, str], share: int, spm_share: int
) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, prefix length, middle length, output) of one text; ``units`` matches (unit)*."""
    match = units.fullmatch(text)
    ends = match.ends(1) if match else []
    n = len(ends)
    one, two, fate, order = numbers
    if not n or fate % 100 >= share or any(s in text for s in sentinels):
        return n, "plain", None, None, text
    low, high = sorted((one % (n + 1), two % (n + 1)))
    start = ends[low - 1] if low else 0
    stop = ends[high - 1] if high else 0
    before, after, between = sentinels
    prefix, middle, suffix = text[:start], text[start:stop], text[stop:]
    if order % 100 < spm_share:
        return n, "spm", start, stop - start, f"{after}{suffix}{before}{prefix}{between}{middle}"
    return n, "psm", start, stop - start, f"{before}{prefix}{after}{suffix}{between}{middle}"


def transform(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", into: str = "fim", unit: str = LINES, seed: int = SEED,
    share: int = 100, spm_share: int = 50, sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """``df`` with a struct: n (units), form, prefix_chars, middle_chars, output.

    ``share`` per cent of the texts are cut, ``spm_share`` per cent of those in the order suffix, prefix, middle.
    """
    refuse_clash(df, into)
    if len(set(sentinels)) < 3 or "" in sentinels:
        raise ValueError("three different sentinels are needed")
    if regex.fullmatch(unit, ""):
        raise ValueError(f"the unit {unit!r} must not match the empty text")
    # What one repetition took is never given back, so the time stays linear and no way back is remembered.
    pattern = f"({unit})*+"
    names = df.columns

    def cut_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(pattern)
        for batch in batches:
            ids, texts = batch.column(names.index(doc_id)), batch.column(names.index(text))
            first, chars, rows = 0, 0, []
            for k in range(batch.num_rows):
                rows.append(cut(texts[k].as_py() or "", draws(ids[k].as_py(), seed), units, sentinels, share, spm_share))
                chars += len(rows[-1][4])
                if chars > FLUSH_CHARS or k == batch.num_rows - 1:
                    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                    made = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=list(PARTS))
                    yield pa.RecordBatch.from_arrays([*batch.slice(first, len(rows)).columns, made], names=[*names, into])
                    first, chars, rows = k + 1, 0, []

    added = ST.StructType([ST.StructField(part, kind) for part, kind in PARTS.items()])
    return df.mapInArrow(cut_all, ST.StructType([*df.schema.fields, ST.StructField(into, added)]))


def restore(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The exact text from an output and its form."""
    parts = F.split(output, "|".join(f"\\Q{s}\\E" for s in sentinels))
    return (
        F.when(form == "psm", F.concat(F.get(parts, 1), F.get(parts, 3), F.get(parts, 2)))
        .when(form == "spm", F.concat(F.get(parts, 2), F.get(parts, 3), F.get(parts, 1)))
        .otherwise(output)
    )
