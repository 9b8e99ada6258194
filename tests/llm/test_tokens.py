"""Token files: equal to the library, exact round trip, offsets, corner cases."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rowsmith.llm import queries, tokens


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.public_tokenizer())


def expected(library, rows):
    out, at = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_pieces_give_the_ids_of_whole_texts(library):
    rng = random.Random(19)
    bits = ["a", "b", " ", "  ", "\n", "\t", "'s", "1", "é", " ", "\x1c", "\x85", ".", "!!", "<|endoftext|>", "​", "漢", "word", "Straße", "it's", " ", "...", "don't", "_"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 25))) for _ in range(4000)]
    coder = tokens.Encoder(queries.public_tokenizer())
    mine = [np.frombuffer(b, "<u2").tolist() for b in coder.encode(texts)]
    assert mine == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_round_trip_and_offsets(spark, library, tmp_path):
    rows = [(7, "seven words"), (3, None), (3, ""), (5, "x " * 20_000), (1, "one"), (1, "one"), (None, "no id"), (9, "<|endoftext|> end")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "'p' as path")
    manifest = tokens.write(df, queries.public_tokenizer(), folder=f"file://{tmp_path}/t", files=3)
    got = sorted((tuple(r) for r in tokens.read(manifest).collect()), key=lambda r: r[1])
    assert got == expected(library, rows)
    parts = manifest.orderBy("part").collect()
    assert [p.base for p in parts] == [sum(q.n_tokens for q in parts[:k]) for k in range(len(parts))]
    # The files are flat: 16-bit ids, 64-bit offsets.
    for p in parts:
        path = p.path.removeprefix("file://")
        assert np.memmap(f"{path}.bin", "<u2", "r").size == p.n_tokens
        edges = np.memmap(f"{path}.idx", "<i8", "r")
        assert len(edges) == p.n_docs + 1 and edges[0] == 0 and edges[-1] == p.n_tokens


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.read(tokens.write(empty, queries.public_tokenizer())).count() == 0


def test_the_table(spark, sf, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in queries.QUERIES["op5_tokens"](spark, sf).collect()), key=lambda r: r[1])
    assert got == expected(library, rows)


def test_a_small_memo_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_PIECES", 5)
    monkeypatch.setattr(tokens, "GO_BYTES", 40)
    rng = random.Random(5)
    texts = ["", "one"] + [" ".join(rng.choice(["alpha", "beta,", "gamma", "x  y", "Delta.\n", "été", "a" * 60]) for _ in range(rng.randrange(0, 30))) for _ in range(300)]
    coder, end, got = tokens.Encoder(queries.public_tokenizer()), b"\0\0", []
    for part in tokens.goes(pa.array(texts)):
        ids, counts = coder.encode_column(part, end)
        got += [row.tolist() for row in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [e.ids + [0] for e in library.encode_batch(texts, add_special_tokens=False)]
    assert len(coder.memo) + len(coder.older) < 300


def test_words_go_straight_to_the_model_only_where_the_file_allows(tmp_path):
    import json

    made = json.load(open(queries.public_tokenizer()))
    assert tokens.Encoder(queries.public_tokenizer()).direct
    for change in ({"pre_tokenizer": made["pre_tokenizer"] | {"use_regex": False}}, {"pre_tokenizer": made["pre_tokenizer"] | {"add_prefix_space": True}}, {"normalizer": {"type": "NFC"}}):
        path = tmp_path / "t.json"
        path.write_text(json.dumps(made | change))
        assert not tokens.Encoder(str(path)).direct
