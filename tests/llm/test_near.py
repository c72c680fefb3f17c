"""SimHash groups against all pairs, components against union-find, and the bit-sliced kernel against bit counts."""

import re
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from parcelframe.llm import near, simhash
from parcelframe.llm.components import components
from tests.llm.helpers import awkward, frame, prose


def plain_fingerprint(text, size=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def union(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def clustered(seed, n):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, max(1, n // 12), dtype=np.uint64)
    return [int(rng.choice(base)) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 6), replace=False)) for _ in range(n)]


@pytest.mark.parametrize(("n", "radius"), [(1, 3), (2, 3), (300, 3), (700, 2), (130, 6), (200, 0)])
def test_kernel_finds_exactly_the_close_pairs_of_a_bucket(n, radius):
    values = np.array(clustered(n, n), np.uint64)
    bucket = np.sort(np.random.default_rng(1).integers(0, 4, n))
    stop = np.searchsorted(bucket, bucket, side="right")
    got = [(int(i), int(j)) for a, b in simhash.close_pairs(values, stop, radius) for i, j in zip(a, b, strict=True)]
    want = {(i, j) for i in range(n) for j in range(i + 1, n) if bucket[i] == bucket[j] and (int(values[i]) ^ int(values[j])).bit_count() <= radius}
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("largest", [2048, 30])
def test_edges_connect_what_all_pairs_connect(spark, largest):
    values = sorted(set(clustered(8, 500)))
    prints = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    near = [(signed(a), signed(b)) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b).bit_count() <= 3]
    got = [tuple(r) for r in simhash.near_edges(prints, 3, largest).collect()]
    nodes = [signed(v) for v in values]
    assert union(nodes, got) == union(nodes, near)
    assert len(got) < 10 * len(nodes)


def test_dense_cluster_gives_few_edges(spark):
    values = [1 << i | 1 << j for i in range(64) for j in range(i)] + [1 << i for i in range(64)] + [0]
    prints = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    got = [tuple(r) for r in simhash.near_edges(prints, 3, 400).collect()]
    assert set(union([signed(v) for v in values], got).values()) == {min(map(signed, values))}


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001 + i) for i in range(300)] + [(5000, 5000), (7001, 7000), (7000, 7001), (-5, 6000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    nodes = {n for e in edges for n in e} - {5000}
    assert got == union(nodes, [e for e in edges if e[0] != e[1]])
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0


def texts():
    base = prose(11, 400)
    words = base.split(" ")
    near = [" ".join([*words[:k], "changed", *words[k + 1 :]]) for k in range(0, 60, 3)]
    return [*awkward(), (20, base), (21, base), (22, base.upper()), *((30 + k, t) for k, t in enumerate(near))]


def test_groups_equal_all_pairs(spark):
    rows = simhash.group_near(frame(spark, texts())).collect()
    prints = [(k, plain_fingerprint(t)) for k, t in texts()]
    distinct = sorted({f for _, f in prints})
    root = union(distinct, [(a, b) for i, a in enumerate(distinct) for b in distinct[i + 1 :] if (a ^ b).bit_count() <= 3])
    low = {}
    for k, f in prints:
        if k is not None:
            low[root[f]] = min(k, low.get(root[f], k))
    want = Counter((k, f"{f:016x}", low.get(root[f])) for k, f in prints)
    assert Counter(map(tuple, rows)) == want
    assert simhash.group_near(frame(spark, [])).count() == 0


def test_stage_links_exactly_the_similar_documents(spark, data):
    rng = np.random.default_rng(3)
    docs = texts()
    for k, edits in enumerate([1, 2, 3, 3, 4, 4, 5, 6, 8, 12] * 3):
        words = prose(200 + k, 200).split(" ")
        docs.append((1000 + 2 * k, " ".join(words)))
        for at in rng.choice(len(words), edits, replace=False):
            words[at] = "edited"
        docs.append((1001 + 2 * k, " ".join(words)))

    def shingled(text):
        words = (text or "").encode().lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = [(k, shingled(t)) for k, t in docs if k is not None]
    near = [(i, j) for i, (_, a) in enumerate(sets) for j, (_, b) in enumerate(sets[:i]) if len(a & b) >= 0.8 * len(a | b)]
    root = union(range(len(sets)), near)
    low = {}
    for i, (k, _) in enumerate(sets):
        low[root[i]] = min(k, low.get(root[i], k))
    first = {}
    for i, (k, _) in enumerate(sets):
        first[k] = min(low[root[i]], first.get(k, k))
    kept = Counter(r.doc_id for r in corpus_pipeline.near_duplicates(spark, frame(spark, docs), data).collect())
    assert kept == Counter(k for k, _ in docs if k is None or first[k] == k)
    assert len([k for k in kept if k and k >= 1000]) < 60


@pytest.mark.parametrize("largest, levels", [(2048, 4), (5, 4), (5, 0)])
def test_buckets_of_any_size_link_the_same(spark, monkeypatch, largest, levels):
    """One family of copies with more and more edits, whose buckets are compared whole, dealt out again, or cut into pieces."""
    monkeypatch.setattr(near, "LEVELS", levels)
    base = prose(5, 300).split(" ")
    texts = {k: " ".join([*(f"w{k}x{i}" for i in range(4 * k)), *base[4 * k :]]) for k in range(40)}
    texts |= {100 + k: " ".join([*base[:150], f"only{k}", *base[151:]]) for k in range(30)}
    sets = {k: set(near.shingles(t).tolist()) for k, t in texts.items()}
    alike = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    found = [near.shingles(t) for t in texts.values()]
    rows = [(k, k, near.fingerprint(x), len(x), bytearray(near.signature(x).tobytes())) for k, x in zip(texts, found, strict=True)]
    table = spark.createDataFrame(rows, "seal long, low long, fp long, n long, sig binary").selectExpr("*", "xxhash64(low, seal) as mark")
    docs = spark.createDataFrame(list(texts.items()), "seal long, text string").selectExpr("xxhash64(seal, seal) as mark", "seal", "text")
    got = [tuple(r) for r in near.similar_edges(docs, table, least=0.8, size=5, largest=largest).collect()]
    assert alike and union(texts, got) == union(texts, alike)


def test_linked_counts_what_is_near():
    base = np.arange(1, 400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    sets = [np.sort(np.r_[base[k:], np.arange(k, dtype=np.uint64) + np.uint64(1 << 40 | k << 20)]) for k in range(0, 390, 10)]
    sets = [*sets, *sets[:7]]
    prints = np.array([near.fingerprint(s) for s in sets])
    stop = np.array([39] * 39 + [46] * 7)
    alike = lambda a, b: len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b))
    want = [(i, j) for i in range(46) for j in range(i + 1, stop[i]) if alike(sets[i], sets[j])]
    got = near.linked(prints, sets, stop, 0.8, 64)
    assert union(range(46), got) == union(range(46), want) and len(got) < 46


def test_near_ids_and_clashing_names(spark):
    rows = [(3, prose(5, 80), 1, 2), (2, prose(5, 80), 3, 4), (None, prose(5, 80), 5, 6), (9, None, 7, 8)]
    docs = spark.createDataFrame(rows, "`doc.id` int, text string, gone long, __gone long")
    kept = near.keep_one(docs, id_col="doc.id")
    assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, docs.filter("gone <> 1").collect()))
    with pytest.raises(TypeError, match="whole numbers"):
        near.keep_one(docs.selectExpr("string(gone) as doc_id", "text"))


def test_pairs_whose_fingerprints_are_far_apart_are_linked(spark):
    """Of four and five shingles, four in common: some such pairs differ in more bits than the radius allows."""
    rows = []
    for k in (23609, 24456, 32514, 33652):
        words = [f"w{k}x{i}" for i in range(9)]
        a, b = (" ".join(words[:n]) for n in (8, 9))
        assert ((near.fingerprint(near.shingles(a)) ^ near.fingerprint(near.shingles(b))) & simhash.ALL).bit_count() > near.RADIUS
        rows += [(2 * k, a), (2 * k + 1, b)]
    kept = near.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [k for k, _ in rows if k % 2 == 0]


@pytest.mark.parametrize("largest, often", [(2048, 2), (5, 2), (5, 1000)])
def test_pairs_that_fingerprints_miss_are_found_by_prefixes(spark, monkeypatch, largest, often):
    """With a radius of 0 nearly all links are left to the prefixes, whatever the order of the shingles and the size of buckets."""
    monkeypatch.setattr(near, "RADIUS", 0)
    monkeypatch.setattr(near, "ONE_OF", 1)
    monkeypatch.setattr(near, "OFTEN", often)
    base = prose(5, 300).split(" ")
    texts = {k: " ".join([*(f"w{k}x{i}" for i in range(6 * k)), *base[6 * k :]]) for k in range(40)}
    texts |= {100 + k: " ".join([*base[:150], f"only{k}", *base[151:]]) for k in range(20)}
    texts |= {200 + k: " ".join(prose(k, 9 + k // 5).split()[: 8 + k % 2]) for k in range(20)} | {300: "one", 301: "ONE two", 302: "", 303: " ", 304: "a " * 400}
    texts |= {400 + k: " ".join([*(f"v{k}x{i}" for i in range(30)), *base[:260]]) for k in range(9)}
    sets = {k: set(near.shingles(t).tolist()) for k, t in texts.items()}
    alike = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    found = [near.shingles(t) for t in texts.values()]
    rows = [(k, k, near.fingerprint(x), len(x), bytearray(near.signature(x).tobytes())) for k, x in zip(texts, found, strict=True)]
    table = spark.createDataFrame(rows, "seal long, low long, fp long, n long, sig binary").selectExpr("*", "xxhash64(low, seal) as mark")
    docs = spark.createDataFrame(list(texts.items()), "seal long, text string").selectExpr("xxhash64(seal, seal) as mark", "seal", "text")
    got = [tuple(r) for r in near.similar_edges(docs, table, least=0.8, size=5, largest=largest).collect()]
    assert alike and union(texts, got) == union(texts, alike)


def test_possible_pairs_lose_no_similar_one():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    sets = [np.unique(np.r_[rng.choice(base, rng.integers(150, 300), replace=False), rng.integers(0, 1 << 63, rng.integers(0, 40), dtype=np.uint64)]) for _ in range(120)]
    alike = {(i, j) for i in range(120) for j in range(i + 1, 120) if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))}
    met = set()
    for key in np.unique(np.concatenate(sets)):
        held = [(i, at) for i, s in enumerate(sets) for at in np.flatnonzero(near.prefix(s, 0.8) == key)]
        i, pos = (np.array([h[c] for h in held], int) for c in (0, 1))
        counts = np.array([np.frombuffer(near.parts(sets[k]), np.uint8) for k in i]).reshape(-1, near.PARTS)
        a, b = near.possible(np.array([len(sets[k]) for k in i]), pos, i, counts, np.ones(len(i), bool), 0.8) if len(i) else ([], [])
        met |= {(int(i[x]), int(i[y])) for x, y in zip(a, b, strict=True)}
    assert alike and alike <= met and len(met) < 120 * 119 / 2
    assert near.parts(np.arange(300, dtype=np.uint64) << np.uint64(32)) == b""
