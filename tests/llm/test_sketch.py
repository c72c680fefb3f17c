"""Sketches against sets of paragraphs, the edited texts by their definition, and the absence of Python in the plan."""

import hashlib
import re
import string
from collections import Counter

from parcelframe.llm import sketch
from tests.llm.helpers import awkward, frame, prose

ENDS = re.compile("(?<=[" + re.escape(string.punctuation.replace(",", "")) + r"])[ \t\n\x0b\f\r]+|\n")


def paragraphs(text):
    return {p for p in ENDS.split(text) if p}


def likeness(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check(spark, rows):
    got = sketch.fingerprints(frame(spark, rows)).collect()
    distinct = {}
    for k, t in rows:
        distinct[k, t or ""] = distinct.get((k, t or ""), 0) + 1
    assert len(got) == len(rows)
    return got


def test_likeness_is_that_of_the_paragraph_sets(spark):
    texts = [(k, prose(k, 20 + 13 * k % 300)) for k in range(30)] + [(40, prose(1, 3000)), (41, prose(1, 3000)), (42, ""), (43, None), (44, "x")]
    got = {r.doc_id: r for r in check(spark, texts)}
    for i, (k, text) in enumerate(texts):
        text, after = text or "", texts[(i + 1) % len(texts)][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        r = got[k]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(r.near_edited - likeness(text, edited)) < 1e-9
        assert abs(r.near_next - likeness(text, after)) < 1e-9
    prints = {}
    for k, text in texts:
        assert prints.setdefault(text or "", got[k].fingerprint) == got[k].fingerprint
    assert len({r.fingerprint for r in got.values()}) == len(prints)
    assert got[40].near_next == 1 and got[42].near_next == 1


def test_awkward_rows(spark):
    got = check(spark, awkward())
    assert Counter(r.doc_id for r in got) == Counter(k for k, _ in awkward())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert len({tuple(r) for r in got if r.doc_id == 5}) == 1


def test_single_and_no_documents(spark):
    text = prose(4, 50)
    row = sketch.fingerprints(frame(spark, [(3, text)])).first()
    cut = len(text) // 4
    assert row.edited_sha256 == hashlib.sha256((text[: len(text) - cut] + text[:cut]).encode()).hexdigest()
    assert row.near_next == 1
    assert sketch.fingerprints(frame(spark, [])).count() == 0


def test_no_python_runs_in_the_plan(spark):
    plan = sketch.fingerprints(frame(spark, [(1, prose(1, 60)), (2, prose(2, 60))]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
