"""Text quality by compression: which of two dictionaries, of good or of bad text, packs a text smaller.

The calibration reads the normalised difference of the two sizes and, for text that repeats itself and so packs
well with either, the packed size per byte.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, field, replace

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelframe.llm.common import bounded_sample, pick, text_udf, worker_own


@dataclass
class CompressionModel:
    """Two dictionaries, their compression level and the calibration of the size difference."""

    good: bytes
    bad: bytes
    level: int = 3
    weights: tuple[float, float, float] = (0.0, 0.0, 0.0)
    trained: bool = False
    _tools: tuple | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_tools": None}

    def features(self, text: str | None) -> tuple[float, float]:
        """Size with the good dictionary less size with the bad one over their sum, and the log of the first per byte.

        Both are 0 for null and empty texts.
        """
        if not text:
            return 0.0, 0.0
        if self._tools is None:
            self._tools = tuple(
                zstandard.ZstdCompressor(
                    level=self.level,
                    dict_data=self._dictionary(d),
                    write_checksum=False,
                    write_content_size=False,
                    write_dict_id=False,
                )
                for d in (self.good, self.bad)
            )
        data = text.encode()
        good, bad = (len(tool.compress(data)) for tool in self._tools)
        return (good - bad) / (good + bad), math.log((good + 8) / (len(data) + 8))

    def _dictionary(self, data: bytes) -> zstandard.ZstdCompressionDict:
        made = zstandard.ZstdCompressionDict(data)
        made.precompute_compress(level=self.level)
        return made

    def __call__(self, text: str | None) -> float:
        (a, b), (u, v, w) = self.features(text), self.weights
        x = u * a + v * b + w
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def dictionaries(good: list[bytes], bad: list[bytes], size: int) -> tuple[bytes, bytes, bool]:
    """A dictionary of each class, both made in one way and of one size, and whether they were trained.

    The size is what the smaller class can fill eight times over, ``size`` at most. Classes too small for the trainer, which
    says so by an error, give all their bytes as they are, again both of them.
    """
    room = min(size, *(sum(map(len, samples)) // 8 for samples in (good, bad)))
    if min(len(good), len(bad)) >= 8 and room >= 1024:
        try:
            made = [zstandard.train_dictionary(room, samples, k=128, d=8, level=3).as_bytes() for samples in (good, bad)]
            return made[0], made[1], True
        except zstandard.ZstdError:
            pass
    return b"\n".join(good), b"\n".join(bad), False


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps on centred, scaled features, with a slight pull to zero."""
    mean, spread = x.mean(0), np.maximum(x.std(0), 1e-9)
    a = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    w = np.zeros(3)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -500, 500)))
        slope = a.T @ (p - y) + 1e-2 * w
        step = np.clip(np.linalg.solve((a.T * (p * (1 - p))) @ a + 1e-2 * np.eye(3), slope), -3, 3)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    u = w[:2] / spread
    return float(u[0]), float(u[1]), float(w[2] - u @ mean)


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column | None = None,
    *,
    sample: int = 20_000,
    dictionary_size: int = 256 << 10,
    level: int = 3,
) -> CompressionModel:
    """Learns from at most about ``sample`` labelled documents, chosen by the id's hash; classes keep their shares.

    ``docs`` has doc_id and text, ``labels`` doc_id and quality; ``usable`` is a condition on doc_id. Ids whose
    labels contradict each other, and null labels, ids and texts, are not used. Half of the documents give the
    dictionaries, the other half the calibration, both as whole texts. If a class has no document every text scores 0.5.
    """
    spark = docs.sparkSession
    known = labels.select("doc_id", "quality").filter("doc_id is not null and quality in (0, 1)")
    if usable is not None:
        known = known.filter(usable)
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).filter("quality = most").drop("most")
    # At most about ``sample`` short rows, whatever the input: small enough for every task.
    picked = F.broadcast(bounded_sample(known, F.col("doc_id"), sample))
    texts = pick(docs, doc_id="doc_id", text="text").filter("text is not null").join(picked, "doc_id")
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 0
    texts = texts.withColumn("half", half).persist()
    try:
        found = texts.filter("half").select("doc_id", "quality", "text").orderBy("doc_id", "text").toArrow()
        samples: dict[int, list[bytes]] = {0: [], 1: []}
        for quality, text in zip(found["quality"].to_pylist(), found["text"].to_pylist(), strict=True):
            samples[quality].append(text.encode())
        if not samples[0] or not samples[1]:
            return CompressionModel(b"", b"", level)
        good, bad, trained = dictionaries(samples[1], samples[0], dictionary_size)
        model = CompressionModel(good, bad, level, trained=trained)
        rest = texts.filter("not half").select("quality", feature_column(spark, model, F.col("text")).alias("found"))
        scored = rest.select("quality", "found.difference", "found.ratio").toArrow()
        if scored.num_rows:
            x = np.column_stack([scored["difference"].to_numpy(), scored["ratio"].to_numpy()])
            model.weights = _calibrate(x, scored["quality"].to_numpy().astype(float))
        return model
    finally:
        texts.unpersist()


def _on_worker(spark, model: CompressionModel):
    """A function that gives a worker's own copy of the model, with its compressors set up once."""
    shared, key = spark.sparkContext.broadcast(model), str(uuid.uuid4())

    return lambda: worker_own(key, lambda: replace(shared.value, _tools=None))


def feature_column(spark, model: CompressionModel, text: Column) -> Column:
    own = _on_worker(spark, model)
    return text_udf(lambda value: own().features(value), "difference double,ratio double")(text)


def score_column(spark, model: CompressionModel, text: Column) -> Column:
    own = _on_worker(spark, model)
    return text_udf(lambda value: (own()(value),), "score double")(text)


def score_quality(docs: DataFrame, model: CompressionModel, *, least: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and predicted (1 if the score is ``least`` or more) of every whole text.

    Null and empty texts have features 0 and get the score of these; very long texts are compressed whole. Repeated rows are
    scored each, null ids stay null, an empty table gives no rows, and other columns are left out.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    found = rows.select("doc_id", score_column(docs.sparkSession, model, F.col("text")).alias("found")).select("doc_id", "found.score")
    return found.withColumn("predicted", (F.col("score") >= least).cast("int"))
