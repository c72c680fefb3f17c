"""Language identification: word frequencies first, then shorter and shorter character n-grams for unseen words."""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from copy import copy
from dataclasses import dataclass, field

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelframe.llm.common import Memo, bounded_sample, map_arrow, pick, text_udf, worker_own

#: A word begins with a letter; letters and combining marks follow. No word spans white space.
WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
LONGEST = 4


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word with its two ends marked; none if the word is too short."""
    marked = f"^{word}$"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind 0 are words, kind n the n-grams; summed per batch before anything is shuffled."""
    for batch in batches:
        tokens: dict[str, Counter] = {}
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            tokens.setdefault(lang, Counter()).update((text or "").lower().split())
        found: Counter = Counter()
        for lang, counts in tokens.items():
            words: Counter = Counter()
            for token, n in counts.items():
                for word in WORDS.findall(token):
                    words[word] += n
            for word, n in words.items():
                found[lang, 0, word] += n
                for size in range(1, LONGEST + 1):
                    for g in grams(word, size):
                        found[lang, size, g] += n
        keys = list(found)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.int32()),
                pa.array([k[2] for k in keys], pa.string()),
                pa.array(list(found.values()), pa.int64()),
            ],
            names=["lang", "kind", "term", "n"],
        )


@dataclass
class LanguageModel:
    """Log frequencies per language of words and n-grams; plain data that can be broadcast or stored."""

    langs: list[str]
    totals: list[dict[int, int]]
    terms: list[dict[str, list[int]]]
    penalty: float = 0.4
    room: int = 200_000
    _memo: Memo | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_memo": None}

    def word_scores(self, word: str) -> tuple[float, ...]:
        """Log probability of the word in each language.

        A known word uses its counts (half a count where a language lacks it). An unseen word uses the longest
        n-grams of which any is known, with a penalty for each step back.
        """
        if (seen := self.terms[0].get(word)) is not None:
            return tuple(math.log((n + 0.5) / (t[0] + 0.5 * len(self.terms[0]))) for n, t in zip(seen, self.totals, strict=True))
        for size in range(LONGEST, 0, -1):
            known = [self.terms[size][g] for g in grams(word, size) if g in self.terms[size]]
            if known:
                back, room = math.log(self.penalty) * (LONGEST - size + 1), 0.5 * len(self.terms[size])
                return tuple(
                    back + sum(math.log((n[i] + 0.5) / (t[size] + room)) for n in known) / len(known)
                    for i, t in enumerate(self.totals)
                )
        return (0.0,) * len(self.langs)

    def __call__(self, text: str | None) -> tuple[str, float]:
        """The language and its score (0 to 1); ``und`` and 0 for null and for texts without a letter."""
        words = WORDS.findall(text.lower()) if text else []
        if not words or not self.langs:
            return "und", 0.0
        if self._memo is None:
            self._memo = Memo(self.word_scores, self.room)
        memo, sums = self._memo, [0.0] * len(self.langs)
        for word, n in Counter(words).items():
            for i, score in enumerate(memo[word]):
                sums[i] += n * score
        top = max(sums)
        # Words of a text are not independent: the square root of their number keeps long texts from certainty.
        odds = [math.exp(max(-700.0, (s - top) / math.sqrt(len(words)))) for s in sums]
        best = sums.index(top)
        return self.langs[best], odds[best] / sum(odds)


def train(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = 20_000, least: int = 2
) -> LanguageModel:
    """Learns from the whole texts of at most about ``sample`` labelled documents, chosen by the id's hash.

    The bound on documents bounds the model. Terms seen fewer than ``least`` times in all are left to the n-grams;
    rows without language, id or text are not used. Ties between languages go to the first in alphabetical order.
    """
    rows = pick(docs, doc_id=id_col, text=text_col, lang=lang_col).filter("lang is not null and text is not null and doc_id is not null")
    chosen = bounded_sample(rows.select("doc_id", "lang", "text"), F.col("doc_id"), sample)
    counted = (
        map_arrow(chosen.select("lang", "text"), _counts, "lang string, kind int, term string, n long")
        .groupBy("kind", "term")
        .agg(F.sum("n").alias("all"), F.collect_list(F.struct("lang", "n")).alias("by"))
        .filter((F.col("all") >= least) | (F.col("kind") > 0))
        .select("kind", "term", F.expr("map_from_entries(transform(array_distinct(by.lang), l -> struct(l, aggregate(filter(by, x -> x.lang = l), 0L, (a, x) -> a + x.n)))) as by"))
    )
    found = counted.toArrow()
    langs = sorted({lang for by in found["by"].to_pylist() for lang, _ in by})
    place = {lang: i for i, lang in enumerate(langs)}
    terms: list[dict[str, list[int]]] = [{} for _ in range(LONGEST + 1)]
    totals = [dict.fromkeys(range(LONGEST + 1), 0) for _ in langs]
    for kind, term, by in zip(found["kind"].to_pylist(), found["term"].to_pylist(), found["by"].to_pylist(), strict=True):
        row = terms[kind][term] = [0] * len(langs)
        for lang, n in by:
            row[place[lang]] = n
            totals[place[lang]][kind] += n
    return LanguageModel(langs, totals, terms)


def language_columns(spark, model: LanguageModel, text):
    """A struct column (lang_pred, score) for a text column; ``und`` with score 0 for null or letterless text."""
    shared, key = spark.sparkContext.broadcast(model), str(uuid.uuid4())

    def predict(value):
        return worker_own(key, lambda: copy(shared.value))(value)

    return text_udf(predict, "lang_pred string, score double")(text)


def identify(docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every whole text, very long ones included.

    Null texts and texts without a letter are ``und`` with score 0. Repeated rows are answered each, null ids stay null, an
    empty table gives no rows, and other columns are left out. Ties go to the first language in alphabetical order.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    return rows.select("doc_id", language_columns(docs.sparkSession, model, F.col("text")).alias("found")).select("doc_id", "found.*")


def keep_identified(docs: DataFrame, model: LanguageModel, *, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows, with all their columns, whose language is known with a score of ``least`` or more.

    Null texts and texts without a letter go; null ids, repeated rows and very long texts are judged like any other row. An
    empty table stays empty, and names of other columns do not matter.
    """
    mark = f"found_{uuid.uuid4().hex[:8]}"
    found = docs.withColumn(mark, language_columns(docs.sparkSession, model, docs[text_col]))
    return found.filter((F.col(mark)["lang_pred"] != "und") & (F.col(mark)["score"] >= least)).drop(mark)
