"""Token counts and packing against the tokenizer library and a plain check of every rule."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from parcelframe.llm import decontaminate, packing, tokencount
from parcelframe.llm.common import Remembered
from tests.llm.helpers import awkward, frame, prose

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LIBRARY = {path: Tokenizer.from_file(path) for path in (BYTES, WORDS)}


def ids(path, text):
    return LIBRARY[path].encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def counter():
    return tokencount.MergeCounter(open(BYTES).read(), room=50)


@pytest.fixture(scope="module")
def encoder():
    return packing.WordEncoder(open(WORDS).read(), room=60)


PARTS = ["a", "the", " ", "  ", "\n", "\t", "\x1c", "　", "é", "ß", "Σ", "12", "3", "'s", "'ll", "!!", "***", "🙂", "<|endoftext|>", "<|startoftext|>", "̃", "word", "Ünder"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25))
def test_any_text_has_the_library_s_tokens(parts):
    text = "".join(parts)
    assert _COUNTER(text) == len(ids(BYTES, text))
    assert [x.tolist() for x in _ENCODER([text, "", text])] == [ids(WORDS, text), [], ids(WORDS, text)]


_COUNTER = tokencount.MergeCounter(open(BYTES).read(), room=50)
_ENCODER = packing.WordEncoder(open(WORDS).read(), room=60)


def test_long_words_and_forgetting(counter, encoder):
    texts = ["ab" * 4000, prose(1, 900), prose(2, 900), "\n" * 500 + "x", prose(1, 900)]
    assert [counter(t) for t in texts] == [len(ids(BYTES, t)) for t in texts]
    assert [x.tolist() for x in encoder(texts)] == [ids(WORDS, t) for t in texts]


def test_columns_and_words_give_the_library_s_tokens():
    """Texts that Arrow splits, texts of the same characters that are split word by word, and both among each other."""
    latin = [chr(c) for c in range(0x21, 0x250)]
    texts = [f"{c} a{c}b{c.upper()} {c}{c}'s\v{c}1{c}" for c in latin] + ["it's''s can't'll 'dx 12a3 ab,cd.\x0bEf\x0c  g-", "", " \t", "<|endoftext|>", "a\x00b"]
    texts += [t + " \u0416\u3042" for t in texts] + ["\u0130x's \u0130", "x\xa0y 's"]
    for room in (60, 100_000):
        for some in (texts, texts[::-1], []):
            encoder = packing.WordEncoder(open(WORDS).read(), room=room)
            assert [x.tolist() for x in encoder(pa.array(some, pa.string()))] == [ids(WORDS, t) for t in some]
            assert [x.tolist() for k in range(0, len(some), 7) for x in encoder(some[k : k + 7])] == [ids(WORDS, t) for t in some]


def test_parts_of_columns_are_remembered_once():
    encoder = packing.WordEncoder(open(WORDS).read(), room=100_000)
    list(encoder(["one, (two) Three! one's"] * 3))
    assert sorted(encoder.words) == ["", "!", "'s", "(", ")", ",", "one", "three", "two"]


def test_words_met_again_outlive_the_others():
    encoder, words, free = packing.WordEncoder(open(WORDS).read(), room=400), decontaminate.Words(room=400), decontaminate.Words()
    for k in range(30):
        texts = [f"Often said: new{'abcdefghij'[k % 10] * (i + 1)}{'klm'[k // 10]} 1{k},{i} often" for i in range(40)]
        assert [x.tolist() for x in encoder(texts)] == [ids(WORDS, t) for t in texts]
        assert all(np.array_equal(a, b) for a, b in zip(words(texts), free(texts), strict=True))
        assert max(len(encoder.words), len(words.words)) <= 400
    assert len(free.words) > 400


def test_words_met_again_are_learned_once():
    known, learned = Remembered(100, np.int64), Counter()

    def learn(words):
        learned.update(words)
        known._add(words, np.full(len(words), 2), np.repeat([len(w) for w in words], 2))

    for k in range(50):
        words = ["often", *[f"{k}x{'y' * i}" for i in range(30)], "often"]
        place, sizes = known.places(known.numbers(words, learn))
        assert known.values[0].rows[place].tolist() == [len(w) for w in words for _ in range(2)] and sizes.tolist() == [2] * len(words)
    assert set(learned.values()) == {1} and len(known.words) <= 100


def test_counts_of_awkward_rows(spark):
    rows = tokencount.count_tokens(frame(spark, awkward()), BYTES).collect()
    want = Counter((k, len((t or "").encode()), len(ids(BYTES, t)), len(ids(BYTES, t)) > 1024) for k, t in awkward())
    assert Counter(map(tuple, rows)) == want
    assert tokencount.count_tokens(frame(spark, []), BYTES).count() == 0


def check_packing(rows, texts, capacity):
    got = defaultdict(list)
    for r in rows:
        got[r.sequence_id].append((r.offset, r.length))
    for places in got.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    want = Counter()
    for key, text in texts:
        own = [*ids(WORDS, text), 1]
        for number, start in enumerate(range(0, len(own), capacity)):
            piece = own[start : start + capacity]
            want[key, number, start, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    return len(got), -(-sum(k[3] * n for k, n in want.items()) // capacity)


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing_of_awkward_rows(spark, capacity):
    rows = packing.pack(frame(spark, awkward()), WORDS, capacity=capacity).collect()
    check_packing(rows, awkward(), capacity)


def test_packing_is_close_to_the_least_number(spark):
    texts = [(k, prose(k, 5 + k * 7 % 160)) for k in range(300)]
    used, least = check_packing(packing.pack(frame(spark, texts), WORDS, capacity=512).collect(), texts, 512)
    assert used <= least + 2


def test_nothing_to_pack(spark):
    assert packing.pack(frame(spark, []), WORDS).count() == 0


def test_plans_place_every_document_once():
    rng = random.Random(3)
    for _ in range(100):
        sizes = {rng.randint(1, 100): rng.randint(1, 40) for _ in range(rng.randint(1, 40))}
        plan = packing.best_plan(sizes, 100)
        filled, ranks = Counter(), defaultdict(list)
        for length, rank, n, first in plan.rows:
            ranks[length] += range(rank, rank + n)
            for k in range(n):
                filled[first + k] += length
        assert {s: sorted(r) for s, r in ranks.items()} == {s: list(range(n)) for s, n in sizes.items()}
        assert max(filled.values()) <= 100 and sorted(filled) == list(range(plan.sequences))


def test_fillings_hold_the_largest_size_and_are_fullest():
    assert packing.best_filling([60, 50, 40, 30], [1, 9, 9, 9], 100) == [1, 0, 1, 0]
    assert packing.best_filling([60, 50, 40, 30], [0, 2, 1, 3], 100) == [0, 2, 0, 0]
