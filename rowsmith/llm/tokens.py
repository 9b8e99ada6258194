"""Token ids as flat unsigned integer files with 64-bit document offsets.

Rows are range-partitioned by id; each partition streams its ids to ``*.bin`` (little-endian, 16 bits where the
vocabulary allows, else 32), the offsets of its documents inside that file to ``*.idx`` and their ids to ``*.ids``
(both 64-bit). One manifest row per partition is committed by Spark's own writer; a task that is run again writes
files of another name, and only those of the attempt that was committed are in the manifest. Where each partition
begins in the whole is a prefix sum over the manifest. Readers map the files into memory where the folder is a
local mount and read byte ranges elsewhere.

Defined results: NULL and empty texts are the end id alone; a NULL id sorts first and reads back as NULL; rows that
share an id stand in the order of their texts; an empty table gives no files; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.llm.common import text_of
from rowsmith.session import materialise, scratch_dir

NO_ID = -(2**63)
# Pieces remembered by a worker: two generations of this many at most, and only short ones.
MEMO_PIECES = 400_000
MEMO_CHARS = 48
# Bytes of text encoded in one go; a longer text is one go by itself.
GO_BYTES = 8_000_000
READ_ROWS = 20_000


class Encoder:
    """Whole texts to id bytes. A text is cut before single spaces inside it, where no token can reach across."""

    # White space next to a space: there a cut before every space would not be safe.
    CLOSE = re.compile(r" \s|\s ")
    CUT = re.compile(r"(?<=\S)(?= \S)")
    # A word of Latin letters and the marks after it: the splitter of byte-level vocabularies makes these two pieces.
    PLAIN = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?\"()|%$#*&-]*)")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.wide = self.tokenizer.get_vocab_size() > 65536
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        splitter = self.tokenizer.pre_tokenizer
        # Only where the file says it splits at byte level by the usual pattern, and no added token is made of what a plain
        # word is made of, may a plain word go straight to the model.
        added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.direct = (
            type(splitter).__name__ == "ByteLevel" and not splitter.add_prefix_space and splitter.use_regex
            and self.tokenizer.normalizer is None and not any(self.PLAIN.fullmatch(content) for content in added)
        )
        # Byte-level vocabularies spell a byte that has no visible Latin-1 character as the next free one from 256 on.
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        unseen = [b for b in range(256) if b not in seen]
        self.spelling = {b: 256 + n for n, b in enumerate(unseen)}
        self.space = chr(self.spelling[32])

    def model_ids(self, piece: str) -> bytes:
        # Of the bytes of an ASCII word only the space has another spelling.
        spelled = piece.replace(" ", self.space) if piece.isascii() else piece.encode().decode("latin-1").translate(self.spelling)
        return self.packed([token.id for token in self.tokenizer.model.tokenize(spelled)])

    def plain(self, piece: str) -> bytes | None:
        """Ids of a plain word, by its two pieces; None if it is not plain."""
        found = self.PLAIN.fullmatch(piece) if self.direct else None
        if not found:
            return None
        word, marks = found.groups()
        return self.short(word) + self.short(marks) if marks else self.model_ids(word)

    def short(self, part: str) -> bytes:
        ids = self.recall(part)
        if ids is None:
            ids = self.memo[part] = self.model_ids(part)
        return ids

    def recall(self, piece: str) -> bytes | None:
        ids = self.memo.get(piece)
        if ids is None and (ids := self.older.get(piece)) is not None:
            # What is met again outlives the generation it came from.
            self.memo[piece] = ids
        return ids

    def packed(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype="<u4").tobytes() if self.wide else array("H", ids).tobytes()

    def ids_of(self, pieces: list[str]) -> list[bytes]:
        """The ids of different pieces."""
        if len(self.memo) > MEMO_PIECES:
            self.older, self.memo = self.memo, {}
        found = [self.recall(piece) for piece in pieces]
        rest = []
        for k, piece in enumerate(pieces):
            if found[k] is None and (plain := self.plain(piece)) is not None:
                found[k] = plain
                if len(piece) <= MEMO_CHARS:
                    self.memo[piece] = plain
            elif found[k] is None:
                rest.append(k)
        for k, coded in zip(rest, self.tokenizer.encode_batch_fast([pieces[k] for k in rest], add_special_tokens=False)):
            found[k] = self.packed(coded.ids)
            if len(pieces[k]) <= MEMO_CHARS:
                self.memo[pieces[k]] = found[k]
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        end = self.packed([0])
        ids, counts = self.encode_column(pa.array(texts, pa.string()), end)
        ends = np.cumsum(counts)
        return [ids[last - n : last - 1].tobytes() for last, n in zip(ends.tolist(), counts.tolist())]

    def encode_column(self, texts: pa.Array, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each text); each text ends in ``end``.

        The texts are cut at their spaces and the different pieces numbered at once; only a piece that is new goes through
        Python, and the ids of the others are gathered by number.
        """
        whole = texts.to_pylist()
        near = [bool(self.CLOSE.search(text)) for text in whole]
        # Such a text is cut with care and stands as one piece here.
        plain = pa.array(["" if close else text for text, close in zip(whole, near)], pa.large_string()) if any(near) else texts.cast(pa.large_string())
        cut = pc.split_pattern(plain, " ")
        starts = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        coded = cut.flatten().dictionary_encode()
        codes, later = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), [" " + piece for piece in coded.dictionary.to_pylist()]
        heads = [self.CUT.split(text) if close else [text.split(" ", 1)[0]] for text, close in zip(whole, near)]
        different = list({piece for head in heads for piece in head})
        known = dict(zip(different, self.ids_of(different)))
        entries = self.ids_of(later) + [b"".join([known[piece] for piece in head]) for head in heads] + [end]
        # One entry a piece; the first of a text has its own, and one more ends it.
        n, docs = len(later), len(whole)
        codes[starts[:-1]] = n + np.arange(docs)
        places = np.arange(len(codes)) + np.repeat(np.arange(docs), np.diff(starts))
        order = np.full(len(codes) + docs, n + docs, np.int64)
        order[places] = codes
        width = len(end)
        flat = np.frombuffer(b"".join(entries), "<u4" if self.wide else "<u2")
        sizes = np.array([len(e) for e in entries], np.int64) // width
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        taken = sizes[order]
        ends = np.cumsum(taken)
        ids = flat[np.arange(ends[-1]) + np.repeat(first[order] - (ends - taken), taken)]
        return ids, np.diff(np.concatenate([[0], ends[starts[1:] + np.arange(docs)]]))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker: what it remembers serves all its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def goes(texts: pa.Array) -> Iterator[pa.Array]:
    """A column in slices of GO_BYTES of text, one text at least."""
    upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        before = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, before + GO_BYTES, "right")))
        yield texts.slice(first, last - first)
        first = last


def write(df: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 0, files: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``df`` in ascending order of ``doc_id``; the manifest: part, base, n_docs, n_tokens, wide, path.

    ``tokenizer`` is a file every executor can read. ``folder`` defaults to a new one in the shared scratch folder,
    ``files`` to the number of shuffle partitions.
    """
    spark = df.sparkSession
    folder = folder or f"{scratch_dir(spark)}/tokens-{uuid.uuid4().hex}"
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, coder = TaskContext.get(), encoder(tokenizer)
        end = coder.packed([end_id])
        width = len(end)
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}"
        store, root = pafs.FileSystem.from_uri(folder)
        n_docs = at = 0
        streams = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if streams is None:
                store.create_dir(root)
                streams = {kind: store.open_output_stream(f"{root}/{name}.{kind}") for kind in ("bin", "idx", "ids")}
                streams["idx"].write(np.zeros(1, "<i8").tobytes())
            for part in goes(batch.column("text")):
                ids, counts = coder.encode_column(part, end)
                ends = at + np.cumsum(counts, dtype="<i8")
                at, n_docs = int(ends[-1]), n_docs + len(counts)
                streams["bin"].write(ids.tobytes())
                streams["idx"].write(ends.astype("<i8").tobytes())
            streams["ids"].write(np.array([NO_ID if i is None else i for i in batch.column("id").to_pylist()], "<i8").tobytes())
        if streams:
            for stream in streams.values():
                stream.close()
            row = {"part": [context.partitionId()], "n_docs": [n_docs], "n_tokens": [at], "wide": [width == 4], "path": [f"{folder}/{name}"]}
            yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("part", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("wide", pa.bool_()), ("path", pa.string())]))

    rows = df.select(F.col(doc_id).cast("long").alias("id"), text_of(df, text).alias("text"))
    ordered = rows.repartitionByRange(files, "id").sortWithinPartitions("id", "text")
    parts = materialise(ordered.mapInArrow(encode, "part int, n_docs long, n_tokens long, wide boolean, path string"), "tokens")
    # One row per file: the prefix sum over them is all that one task orders.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _open(store: pafs.FileSystem, path: str, dtype: str):
    """The file as an array: mapped where it is local, else a reader of byte ranges."""
    if isinstance(store, pafs.LocalFileSystem):
        mapped = np.memmap(path, dtype=dtype, mode="r")
        return lambda first, last: mapped[first:last]
    file, width = store.open_input_file(path), np.dtype(dtype).itemsize
    return lambda first, last: np.frombuffer(file.read_at((last - first) * width, first * width), dtype=dtype)


def read(manifest: DataFrame) -> DataFrame:
    """doc_id, start (in the whole), n_tokens, ids_crc32 of every document, from the files."""

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            store, path = pafs.FileSystem.from_uri(row["path"])
            tokens = _open(store, f"{path}.bin", "<u4" if row["wide"] else "<u2")
            offsets, ids = _open(store, f"{path}.idx", "<i8"), _open(store, f"{path}.ids", "<i8")
            for first in range(0, row["n_docs"], READ_ROWS):
                last = min(first + READ_ROWS, row["n_docs"])
                edges, doc_ids = np.array(offsets(first, last + 1)), np.array(ids(first, last))
                sums = [zlib.crc32(tokens(a, b).astype("<u4").tobytes()) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64(), mask=doc_ids == NO_ID), pa.array(edges[:-1] + row["base"], pa.int64()),
                        pa.array(np.diff(edges), pa.int64()), pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    parts = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return manifest.repartition(parts).mapInArrow(load, "doc_id long, start long, n_tokens long, ids_crc32 long")
