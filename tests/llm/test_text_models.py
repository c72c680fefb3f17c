"""Language identification and quality: held-out accuracy, and the rows without usable text."""

import math
import zlib

import numpy as np
import pytest
import regex
import zstandard
from pyspark.sql import functions as F

from parcelframe.llm import langid, quality
from parcelframe.llm.common import bounded_sample, held_out
from parcelframe.llm.queries import QUERIES
from tests.llm.helpers import awkward, frame


@pytest.fixture(scope="module")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return langid.train(docs.filter(~held_out(F.col("doc_id"))))


def test_held_out_is_the_remainder_of_crc32(docs):
    for row in docs.select("doc_id", held_out(F.col("doc_id")).alias("h")).collect():
        assert row.h == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)


def test_language_of_held_out_documents(spark, data, docs):
    found = QUERIES["op8_language_id"](spark, data).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(found) > 30
    assert sum(r.lang_pred == r.lang for r in found) >= 0.97 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_unseen_words_fall_back_to_ngrams(model):
    assert model("Zwischenbemerkungsschreibungen und Verpflichtungserklärungen")[0] == "de"
    assert model.word_scores("qqqq") is not None


def test_scores_equal_sums_over_words(model):
    for _, text in awkward():
        words = regex.findall(r"\p{L}[\p{L}\p{M}]*", (text or "").lower())
        sums = [sum(model.word_scores(w)[i] for w in words) for i in range(len(model.langs))]
        lang, score = model(text)
        if not words:
            assert (lang, score) == ("und", 0.0)
            continue
        odds = [math.exp(max(-700, (s - max(sums)) / math.sqrt(len(words)))) for s in sums]
        assert lang == model.langs[sums.index(max(sums))] and score == pytest.approx(1 / sum(odds))


def test_forgetting_changes_no_prediction(model):
    small = langid.LanguageModel(model.langs, model.totals, model.terms, room=3)
    texts = [t for _, t in awkward()]
    assert [small(t) for t in texts] == [model(t) for t in texts]


def test_awkward_texts_have_a_language_or_none(spark, model):
    rows = langid.identify(frame(spark, awkward()), model).collect()
    assert len(rows) == len(awkward())
    got = {r.doc_id: (r.lang_pred, r.score) for r in rows if r.doc_id in (1, 2, 3, 11, 12, 13, 14)}
    assert got == {k: ("und", 0.0) for k in (1, 2, 3, 11, 12, 13, 14)}
    assert langid.identify(frame(spark, []), model).count() == 0
    kept = langid.keep_identified(frame(spark, awkward()), model)
    assert kept.columns == frame(spark, []).columns
    assert not {1, 2, 3, 11, 12, 13, 14} & {r.doc_id for r in kept.collect()}


def test_no_training_rows_give_no_language(spark):
    empty = langid.train(frame(spark, [(1, None), (None, "a b")]))
    assert empty("some text") == ("und", 0.0)


def test_sample_is_bounded_and_stable(spark):
    ids = spark.range(20_000)
    first = {r.id for r in bounded_sample(ids, F.col("id"), 1000).collect()}
    assert 800 < len(first) < 1200
    assert first == {r.id for r in bounded_sample(ids.repartition(7), F.col("id"), 1000).collect()}
    assert bounded_sample(ids, F.col("id"), 20_000).count() == 20_000


def test_quality_of_held_out_documents(spark):
    data = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{data}/labels.parquet")
    found = QUERIES["op3_compression_quality"](spark, data).join(labels, "doc_id").filter("held_out").collect()
    good, bad = [r.predicted for r in found if r.quality == 1], [r.predicted for r in found if r.quality == 0]
    assert len(good) > 50 and len(bad) > 5
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.4 * len(bad)
    assert all(r.predicted == (r.score >= 0.7) for r in found)


def test_dictionaries_are_trained_and_scores_recomputed(spark):
    """A trained dictionary of each class, of one size; the score is the logistic sum of both sizes' difference and share."""
    data = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{data}/labels.parquet"))
    assert model.trained and len(model.good) == len(model.bad) >= 1024
    tools = [zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False) for d in (model.good, model.bad)]
    rows = {r.doc_id: r for r in quality.score_quality(docs, model).collect()}
    for doc in docs.limit(50).collect():
        raw = doc.text.encode()
        good, bad = (len(t.compress(raw)) for t in tools)
        x = np.array([(good - bad) / (good + bad), math.log((good + 8) / (len(raw) + 8)), 1]) @ model.weights
        assert rows[doc.doc_id].score == pytest.approx(1 / (1 + math.exp(-x)))


def test_small_classes_give_all_their_bytes():
    assert quality.dictionaries([b"abc"] * 3, [b"x" * 9000] * 90, 1 << 18) == (b"abc\nabc\nabc", b"\n".join([b"x" * 9000] * 90), False)


def test_quality_of_awkward_texts(spark, data, docs):
    model = quality.train(docs, spark.read.parquet(f"{data}/labels.parquet"))
    rows = quality.score_quality(frame(spark, awkward()), model).collect()
    assert len(rows) == len(awkward()) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert quality.score_quality(frame(spark, []), model).count() == 0


def test_contradicting_and_missing_labels_are_not_used(spark):
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (4, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(frame(spark, awkward()), labels)
    assert {r.score for r in quality.score_quality(frame(spark, awkward()), model).collect()} == {0.5}
