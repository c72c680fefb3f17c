"""Exact search, vector codes and the conversation trie against brute force."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelframe.llm import codes, topk, trie
from parcelframe.llm.vectors import exact_dot, limb_bits, squares

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<float>, label int, score double, segment long, vector string, salt int, `query.id` int"


def vectors(spark, rows):
    return spark.createDataFrame([(k, e, label, 0.5, 7, "x", 1, 2) for k, e, label in rows], VECTORS)


def plain(rows, scale):
    """Usable rows as Python integers, padded to one length."""
    kept = [(k, [int(np.floor(scale * float(np.float32(x)))) for x in e], label) for k, e, label in rows if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    size = max((len(e) for _, e, _ in kept), default=0)
    return [(k, e + [0] * (size - len(e)), label) for k, e, label in kept]


def random_rows(seed, n, dim, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, spread, (5, dim))
    at = rng.integers(0, 5, n)
    return [(int(k), [float(np.float32(x)) for x in centres[a] + rng.normal(0, spread / 3, dim)], int(a) if a else None) for k, a in enumerate(at)]


def awkward_vectors():
    one = [0.5, -0.25, 0.125, 1.0, 0.0, -1.0, 0.75, 0.3] * 2
    return [
        (0, one, 1), (100, one, 1), (100, one, 1), (200, None, 1), (300, [NAN] * 16, 1), (400, [INF] + one[1:], 2), (500, [None] + one[1:], 2),
        (600, [], None), (700, one[:5], None), (None, one, 3), (1, [-x for x in one], 3), (2, [3e7] * 16, 2), (3, one, None), (-100, one, 4),
    ]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 61), st.integers(0, 61), st.integers(1, 6), st.integers(0, 9), st.integers(0, 2**32))
def test_dot_products_are_exact(a_bits, b_bits, n, length, seed):
    rng = np.random.default_rng(seed)
    a = rng.integers(-(1 << a_bits), (1 << a_bits) + 1, (n, length))
    b = rng.integers(-(1 << b_bits), (1 << b_bits) + 1, (3, length))
    assert (exact_dot(a, b) == a.astype(object) @ b.T.astype(object)).all()
    assert squares(a).tolist() == [sum(x * x for x in row) for row in a.tolist()]


@pytest.mark.parametrize("length", [1, 2, 5, 64])
def test_dot_products_at_the_ends_of_limbs(length):
    width = limb_bits(length)
    ends = [x for bits in (1, 10, width, 2 * width) if bits < 62 for x in ((1 << bits) - 1, 1 << bits, -(1 << bits), 1 - (1 << bits))]
    a = np.array([[x] * length for x in ends], np.int64)
    for rows in (a, *a[:, None]):
        assert (exact_dot(rows, a) == rows.astype(object) @ a.T.astype(object)).all()


def search_by_hand(rows, every, k, scale):
    best = {}
    for i, e, _ in plain(rows, scale):
        if i is not None:
            best[i] = min(best.get(i, e), e)
    found = set()
    for q, e in best.items():
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(e, o, strict=True)), i) for i, o in best.items() if i != q)
            found |= {(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)}
    return found


@pytest.mark.parametrize("rows, every, k", [
    (awkward_vectors(), 100, 10), (awkward_vectors(), 1, 2), (random_rows(1, 700, 6), 20, 10), ([(k, [1.0, 2.0], None) for k in range(300)], 50, 10), ([], 100, 10), ([(5, None, 1)], 100, 10),
])
def test_search(spark, monkeypatch, rows, every, k):
    found = topk.top_k(vectors(spark, rows), every=every, k=k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == sorted(search_by_hand(rows, every, k, 1024))


def test_blocks_are_pruned_and_ties_kept():
    """Blocks below the bar are not scored; one whose bound equals it is if it holds a smaller id."""
    rows = np.array([[9, 0]] * 4 + [[1, 0]] * 4 + [[9, 0]] * 4, np.int64)
    ids = np.array([10, 11, 12, 13, 20, 21, 22, 23, 1, 2, 3, 4], np.int64)
    starts = np.array([0, 4, 8, 12])
    segment = {"ids": ids, "rows": rows, "starts": starts, "high": np.maximum.reduceat(rows, starts[:-1], 0), "low": np.minimum.reduceat(rows, starts[:-1], 0), "first": np.minimum.reduceat(ids, starts[:-1])}
    best = topk.Best(1, 4)
    assert topk.search(np.array([99]), np.array([[1, 0]]), segment, best) == 1
    assert best.id.tolist() == [[1, 2, 3, 4]] and best.score.tolist() == [[9] * 4]
    best = topk.Best(1, 6)
    assert topk.search(np.array([99]), np.array([[1, 0]]), segment, best) == 2
    assert best.id.tolist() == [[1, 2, 3, 4, 10, 11]]


@pytest.mark.parametrize("spread", [0, 1, 300])
def test_queries_meet_in_blocks(monkeypatch, spread):
    """Vectors without any order, of which bounds leave out nothing, take few products, and scores and ties are right."""
    rng = np.random.default_rng(spread)
    rows, ids = rng.integers(-spread, spread + 1, (64 * 64, 48)), rng.permutation(64 * 64)
    segment, found = topk._segment(ids[:2048], rows[:2048], 50, 10)
    other, _ = topk._segment(ids[2048:], rows[2048:], 50, 10)
    products, clamped = [], topk._clamped
    monkeypatch.setattr(topk, "_clamped", lambda scores: products.append(scores.shape) or clamped(scores))
    n = len(segment["query_ids"])
    best = topk.Best(n, 10, segment["floor"], segment["last"])
    scored = topk.search(segment["query_ids"], segment["queries"], other, best)
    assert len(products) < 4 * len(other["first"]) and (spread < 300 or scored == n * len(other["first"]))
    best.add(np.arange(n), np.array([x["score"] for x in found.to_pylist()]).reshape(n, 10), np.array([x["vec_id"] for x in found.to_pylist()]).reshape(n, 10))
    scores = segment["queries"] @ rows.T
    for q, own, mine, score in zip(segment["query_ids"], scores, best.id, best.score, strict=True):
        order = np.lexsort((ids, -own))
        order = order[ids[order] != q][:10]
        assert mine.tolist() == ids[order].tolist() and score.tolist() == own[order].tolist()


def test_queries_of_large_integers():
    """A few huge vectors among small ones: scores beyond a long become the nearest long, ties go to smaller ids."""
    rng = np.random.default_rng(4)
    rows, ids = rng.integers(-500, 501, (600, 8)), rng.permutation(600)
    for q, bits in ((0, 61), (20, 40), (40, 27), (7, 61)):
        rows[ids == q] = rng.integers(-(1 << bits), 1 << bits, 8)
    home, _ = topk._segment(ids[:300], rows[:300], 20, 10)
    both = np.concatenate([home["queries"], rows[300:][ids[300:] % 20 == 0]]), np.concatenate([home["query_ids"], ids[300:][ids[300:] % 20 == 0]])
    best = topk.Best(len(both[1]), 10)
    for part in (home, topk._segment(ids[300:], rows[300:], 20, 10)[0]):
        topk.search(both[1], both[0], part, best)
    for q, own, mine, score in zip(both[1].tolist(), both[0].tolist(), best.id.tolist(), best.score.tolist(), strict=True):
        scores = ((max(topk.LEAST, min(topk.MOST, sum(x * y for x, y in zip(own, o, strict=True)))), i) for i, o in zip(ids.tolist(), rows.tolist(), strict=True) if i != q)
        want = sorted(scores, key=lambda x: (-x[0], x[1]))[:10]
        assert list(zip(score, mine, strict=True)) == want


def test_many_small_segments(spark, monkeypatch):
    """Segments of a few rows, made on the driver, give what one large segment gives."""
    rows = plain(random_rows(3, 90, 5), 1024)
    ids, values = np.array([k for k, *_ in rows]), np.array([e for _, e, _ in rows])
    monkeypatch.setattr(topk, "BLOCK", 3)
    pieces = [topk._segment(ids[k : k + 10], values[k : k + 10], 7, 4)[0] for k in range(0, 90, 10)]
    for home in pieces:
        whole = topk.Best(len(home["query_ids"]), 4)
        for other in pieces:
            best = topk.Best(len(home["query_ids"]), 4, home["floor"], home["last"])
            topk.search(home["query_ids"], home["queries"], other, best)
            whole.add(np.arange(len(best.id)), best.score, best.id)
        want = search_by_hand([(k, [x / 1024 for x in e], None) for k, e, _ in rows], 7, 4, 1024)
        for q, own in zip(home["query_ids"].tolist(), whole.id.tolist(), strict=True):
            missing = {i for a, _, i, _ in want if a == q} - set(own)
            assert not missing or missing <= set(home["ids"].tolist())


def codes_by_hand(rows, parts, entries, rounds):
    rows = plain(rows, 256)
    size = -(-max(1, max((len(e) for _, e, _ in rows), default=0)) // parts)
    rows = [(k, e + [0] * (size * parts - len(e)), label) for k, e, label in rows]
    best = {}
    for k, e, _ in rows:
        if k is not None:
            best[k] = min(best.get(k, e), e)
    if not best:
        return set(), ""
    cut = lambda e, p: e[p * size : (p + 1) * size]
    books = [[cut(best[k], p) for k in sorted(best)[:entries]] for p in range(parts)]
    nearest = lambda v, book: min((sum((x - y) ** 2 for x, y in zip(v, b, strict=True)), n) for n, b in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            mine = defaultdict(list)
            for _, e, _ in rows:
                mine[nearest(cut(e, p), book)[1]].append(cut(e, p))
            books[p] = [[sum(c) // len(c) for c in zip(*mine[n], strict=True)] if n in mine else b for n, b in enumerate(book)]
    done, sums = [], defaultdict(int)
    for k, e, label in rows:
        near = [nearest(cut(e, p), books[p]) for p in range(parts)]
        error = sum(d for d, _ in near)
        done.append((k, "".join(f"{n:02x}" for _, n in near), error, label))
        sums[label] += error
    sha = hashlib.sha256(",".join(str(x) for book in books for b in book for x in b).encode()).hexdigest()
    return sorted((str(k), c, e, sums[label]) for k, c, e, label in done), sha


@pytest.mark.parametrize("rows, entries", [
    (awkward_vectors(), 64), (random_rows(5, 300, 32), 64), (random_rows(6, 80, 21, 2000.0), 5), ([(k, [0.1] * 16, 1) for k in range(90)], 64), ([], 64), ([(None, [1.0], 1)], 64),
])
def test_codes(spark, rows, entries):
    got = codes.compress(vectors(spark, rows), entries=entries)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    got = got.collect()
    want, sha = codes_by_hand(rows, 16, entries, 2)
    assert sorted((str(r.vec_id), r.code, r.error, r.label_error) for r in got) == sorted(want)
    assert {r.codebooks_sha256 for r in got} <= {sha}


def test_codes_of_huge_components(spark):
    """Sums of squares beyond a long are null, and nearest entries are still right."""
    rows = [(1, [1e16] * 16, 1), (2, [-1e16] * 16, 1), (3, [9e15] * 16, 1), (4, [1.0] * 16, 2), (5, [1e30] * 16, 2)]
    got = {r.vec_id: r for r in codes.compress(vectors(spark, rows), entries=2, rounds=0).collect()}
    assert {k: r.code[:2] for k, r in got.items()} == {1: "00", 2: "01", 3: "00", 4: "00", }  # 1e30 takes no part
    assert got[3].error is None and got[1].error == 0 and got[1].label_error is None


def trie_by_hand(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", hashlib.md5(f"{len(r or '')}:{r or ''}{x or ''}".encode()).digest(), x or ""))
    own = {c: [(a[2], a[4]) for a in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - int(np.fmod(c, 5)), [])[:h] + v[h:]
    members, kids, leaves, saved = defaultdict(list), defaultdict(set), defaultdict(int), defaultdict(int)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
            if d:
                kids[tuple(v[: d - 1])].add(tuple(v[:d]))
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
            leaves[p[:d]] += not kids[p]
    ends = lambda p, m: hashlib.sha256(",".join(map(str, sorted(c for c in m if len(built[c]) == len(p)))).encode()).hexdigest()
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], ends(p, m)) for p, m in members.items())


def talk(spark, rows):
    data = [(c, t, r, x, 1, b"x", 2) for c, t, r, x in rows]
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string, depth int, path binary, chunk int")


def awkward_talk():
    same = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t}") for c in range(40, 160) for t in range(3)]
    long = [(7, t, "user", f"é{t}") for t in range(400)]
    return [
        *same, *long, (8, None, None, None), (8, None, None, None), (8, 1, "user", ""), (9, 2, "b", "x"), (9, 2, "a", "y"), (9, 1, None, "z"),
        (None, 0, "user", "nobody"), (-3, 0, "user", "minus"), (-7, 0, "user", "minus"), (3, 0, "user", "turn 0"), (3, 1, "assistant", "turn 1"), (5, 0, "us", "erturn"), (6, 0, "user", "turn"),
    ]


@pytest.mark.parametrize("members", [4096, 1, 3])
def test_trie(spark, members):
    rows = awkward_talk()
    built = trie.borrowed_heads(trie.turn_lists(talk(spark, rows)))
    got = trie.prefix_trie(built, members=members, most=1000)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    key = lambda r: tuple(-(10**9) if x is None else x for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(trie_by_hand(rows), key=key)


def test_trie_of_nothing(spark):
    assert trie.conversation_trie(talk(spark, [])).count() == 0
    assert trie.conversation_trie(talk(spark, [(None, 1, "user", "x")])).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=5), min_size=1, max_size=12))
def test_intervals_in_a_chunk(sequences):
    paths = sorted(b"".join(bytes([x]) * trie.WIDTH for x in s) for s in sequences)
    sizes = [np.array([p[k] + 1 for k in range(0, len(p), trie.WIDTH)], np.int64) for p in paths]
    c = trie.Chunk(list(range(len(paths))), paths, sizes, None, None)
    got = {paths[i][: d * trie.WIDTH]: (int(n), int(m), int(k), int(x), int(s - t)) for i, d, n, m, k, x, s, t in zip(c.row, c.depth, c.n, c.least, c.children, c.leaves, c.spent, c.distinct, strict=True)}
    every = {p[:k] for p in paths for k in range(0, len(p) + 1, trie.WIDTH)}
    count = {p: sum(q.startswith(p) for q in paths) for p in every}
    want = {}
    for p in every:
        below = [q for q in every if q.startswith(p)]
        kids = sum(len(q) == len(p) + trie.WIDTH for q in below)
        leaves = sum(not any(o.startswith(q) and o != q for o in every) for q in below)
        first = min(k for k, q in enumerate(paths) if q.startswith(p))
        want[p] = (count[p], first, kids, leaves, sum((count[q] - 1) * (q[-1] + 1) for q in below if q))
    assert got == want
    assert len(c.row) == len(every)
