"""The pipeline, stage by stage, against plain Python."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from rowsmith.llm import queries
from tests.llm import test_decontaminate, test_mixing, test_ngramjoin, test_quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    tables = [spark.read.parquet(f"{sf}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], sf).write.parquet(f"{folder}/{k}")
        tables.append(spark.read.parquet(f"{folder}/{k}"))
    return tables


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns(stages):
    assert all(df.columns == COLUMNS for df in stages[:5])


def test_rules(stages):
    before, after = dict(rows(stages[0])), dict(rows(stages[1]))
    assert after and not any(test_quality.figures(before[d])[5] for d in after)
    for d, text in after.items():
        # Lines go, nothing else changes.
        lines = iter(before[d].split("\n"))
        assert all(line in lines for line in text.split("\n"))


def test_near_duplicates(stages):
    before, after = rows(stages[1]), rows(stages[2])
    right = {c for _, c, _, _ in test_ngramjoin.brute(before)}
    assert sorted(d for d, _ in after) == sorted(right)


def test_leaks(spark, sf, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    leaked = {d for d, _, _ in test_decontaminate.brute(rows(stages[2]), items)}
    assert sorted(rows(stages[3])) == sorted(r for r in rows(stages[2]) if r[0] not in leaked)


def test_mixture(stages):
    size = lambda t: len(test_quality.WORD.findall(t or ""))
    sizes, taken = {}, {}
    for r in stages[3].collect():
        sizes[r.source] = sizes.get(r.source, 0) + size(r.text)
    for r in stages[4].collect():
        taken[r.source] = taken.get(r.source, 0) + size(r.text)
    largest = max(size(t) for _, t in rows(stages[3]))
    for source, target in test_mixing.targets(sizes).items():
        assert abs(taken.get(source, 0) - target) <= largest / 2 + 1e-6


def test_token_files(stages):
    library, at, right = Tokenizer.from_file(queries.public_tokenizer()), 0, []
    for d, t in sorted(rows(stages[4])):
        ids = library.encode(t, add_special_tokens=False).ids + [0]
        right.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted((tuple(r) for r in stages[5].collect()), key=lambda r: r[1]) == right


def test_run_gives_the_last_stage(spark, sf, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == sorted(map(tuple, stages[5].collect()))


def test_an_empty_table_goes_through_all_stages(spark, sf, tmp_path):
    spark.read.parquet(f"{sf}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
