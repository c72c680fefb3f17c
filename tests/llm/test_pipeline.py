"""The pipeline's stages on planted cases, each judged on its own input."""

import corpus_pipeline
import pytest

import __spark_entry__
from parcelframe.session import stored
from tests.llm.helpers import frame


@pytest.fixture(scope="module")
def steps(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    found = [("", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, data), f"test-{name}")
        found.append((name, docs))
    return found


def test_columns_and_names(steps):
    names = [n for n, _ in steps[1:]]
    assert names == ["language", "lines", "near_duplicates", "benchmark_leaks", "sequences"]
    assert all(df.columns == steps[0][1].columns for _, df in steps[:-1])


def test_stages_take_effect(steps, spark, data):
    counts = [df.count() for _, df in steps]
    assert counts[1] == counts[2] >= counts[3] >= counts[4] > 0.7 * counts[0]
    kept, packed = steps[4][1], steps[5][1]
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in packed.collect()}
    benchmark = [r.text for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    texts = [r.text for r in kept.collect()]
    assert len(texts) == len(set(texts))
    assert not any(b in t for b in benchmark for t in texts)


def test_registered():
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert sum(name.startswith("op") and name[2].isdigit() for name in __spark_entry__.queries()) == 13


def test_stages_on_an_empty_table(spark, data):
    empty = frame(spark, []).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, data).count() == 0
