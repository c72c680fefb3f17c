"""Exact top-k search by inner product, with blocks of documents that are left out once they cannot matter.

Vectors are ordered by the nearest of a few pivots and then by id; ranges of that order are blocks, and runs of blocks are
segments. A block keeps its vectors (the forward index) and, for each component, its largest and smallest value. For a query the
sum over its components of the larger possible product bounds every score of the block. Blocks are scored in the
order of their bounds until the next bound falls below the k-th best score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelframe.llm.common import Memo, bounded_sample, map_arrow, pick
from parcelframe.llm.vectors import Cut, exact_dot, integers, limb_bits, longest, usable
from parcelframe.session import package_on_workers, stored

BLOCK, BLOCKS = 64, 64
#: Segments whose queries travel together, and segments whose bounds are looked at together.
TOGETHER, SUMMARIES, SPREAD = 16, 1024, 32
#: Queries that should meet in a block: fewer cost less than the call for the block does.
MEET = 64
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _clamped(scores: np.ndarray) -> np.ndarray:
    """Scores as longs; one that no long holds becomes the largest or smallest long."""
    return scores if scores.dtype == np.int64 else np.clip(scores, LEAST, MOST).astype(np.int64)


def bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For each query and block the sum of the larger products with the block's extremes: no score in it is higher."""
    return _clamped(exact_dot(np.maximum(queries, 0), high) + exact_dot(np.minimum(queries, 0), low))


class Best:
    """The best k (score, smaller id) of each query so far; unused places have the smallest score and no id."""

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None, last: np.ndarray | None = None):
        self.score, self.id = np.full((n, k), LEAST), np.full((n, k), MOST)
        #: What a new row must beat already: the k-th best (score, id) known from elsewhere.
        self.floor = np.full(n, LEAST) if floor is None else floor
        self.last = np.full(n, MOST) if last is None else last

    def bar(self, rows) -> tuple[np.ndarray, np.ndarray]:
        score, last = self.score[rows, -1], self.id[rows, -1]
        own = (score > self.floor[rows]) | ((score == self.floor[rows]) & (last < self.last[rows]))
        return np.where(own, score, self.floor[rows]), np.where(own, last, self.last[rows])

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores (rows x documents) of documents not seen before; LEAST with id MOST stands for none."""
        score = np.concatenate([self.score[rows], scores], 1)
        own = np.concatenate([self.id[rows], ids], 1)
        order = np.lexsort((own, ~score), axis=1)[:, : self.score.shape[1]]
        self.score[rows], self.id[rows] = np.take_along_axis(score, order, 1), np.take_along_axis(own, order, 1)

    def merge(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Single documents not seen before, each with the row it is for."""
        order = np.lexsort((ids, ~scores, rows))
        rows, scores, ids = rows[order], scores[order], ids[order]
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        sizes = np.diff(first, append=len(rows))
        number, place = np.repeat(np.arange(len(first)), sizes), np.arange(len(rows)) - np.repeat(first, sizes)
        some = place < self.score.shape[1]
        table = np.full((2, len(first), self.score.shape[1]), [[[LEAST]], [[MOST]]])
        table[:, number[some], place[some]] = scores[some], ids[some]
        self.add(rows[first], *table)


def search(query_ids: np.ndarray, queries: np.ndarray, segment: dict, best: Best) -> int:
    """Scores the segment's blocks for all queries, each in its own order of bounds, and stops each at its bar.

    In every step each open query takes as many blocks as it has taken so far, of those that its bar leaves open, and more
    if the queries touch most blocks anyway but few meet in one. Those of a block are scored together, and only scores that
    reach the bar are looked at further. Returns the number of (query, block) pairs scored.
    """
    starts = segment["starts"]
    bound = bounds(queries, segment["high"], segment["low"])
    order = np.lexsort((np.broadcast_to(segment["first"], bound.shape), ~bound), axis=1)
    cuts = Memo(lambda b: Cut(segment["rows"][starts[b] : starts[b + 1]]), len(starts))
    # Queries of large integers take more products, so they are scored apart from the others.
    large = np.abs(queries).max(1) >> limb_bits(queries.shape[1]) > 0
    asked = [Cut(np.where((large == x)[:, None], queries, 0)) for x in (False, True)]
    live, taken, scored = np.arange(len(queries)), 0, 0
    while taken < bound.shape[1]:
        step = max(1, taken)
        if taken and 2 * step * len(live) >= bound.shape[1]:
            step = max(step, MEET * bound.shape[1] // len(live))
        block = order[live, taken : taken + step]
        taken += block.shape[1]
        top, (bar, last) = np.take_along_axis(bound[live], block, 1), best.bar(live)
        # A block whose bound is just the k-th score may still hold a smaller id.
        open_ = (top > bar[:, None]) | ((top == bar[:, None]) & (segment["first"][block] < last[:, None]))
        # Bounds only fall, but a later block of the same bound may start with no smaller id: these come in order of ids.
        some = open_.any(1)
        at, block = np.nonzero(open_)[0], block[open_]
        if not len(at):
            break
        meet = 2 * block + large[live[at]]
        by = np.argsort(meet, kind="stable")
        found, ends = [], np.flatnonzero(np.diff(meet[by], append=-1)) + 1
        for mine in np.split(by, ends[:-1]):
            b, rows = block[mine[0]], at[mine]
            ids = segment["ids"][starts[b] : starts[b + 1]]
            scores = _clamped(asked[meet[mine[0]] % 2].dot(cuts[b], live[rows]))
            i, j = np.divmod(np.flatnonzero(scores >= bar[rows, None]), len(ids))
            found.append((rows[i], scores[i, j], ids[j]))
        row, score, ids = map(np.concatenate, zip(*found, strict=True))
        better = ((score > bar[row]) | (ids < last[row])) & (ids != query_ids[live[row]])
        best.merge(live[row[better]], score[better], ids[better])
        scored += len(at)
        live = live[some]
    return scored


def _pivot(pivots, scale: int, dim: int):
    """Adds the number of the pivot with the largest inner product less half its square, that is, the nearest one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pivots.value.astype(np.float64)
        half = (table * table).sum(1) / 2
        for batch in batches:
            near = (integers(batch["vector"], scale, dim).astype(np.float64) @ table.T - half).argmax(1)
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["vector"], pa.array(near.astype(np.int32))], names=["vec_id", "vector", "pivot"])

    return run


_PARTS = ("ids", "rows", "starts", "high", "low", "first", "best_high", "best_low", "query_ids", "queries", "floor", "last")
_FOUND = "query_id long, vec_id long, score long"
_SEGMENT = "segment long, together long, " + ", ".join(f"{name} binary" for name in _PARTS) + f", found array<struct<{_FOUND.replace(' ', ':').replace(',:', ', ')}>>"
_TRIPLE = pa.struct([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _packed(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a, np.int64).tobytes()


def _longs(data: bytes, dim: int | None = None) -> np.ndarray:
    flat = np.frombuffer(data, np.int64)
    return flat if dim is None else flat.reshape(-1, dim)


def _triples(query_ids: np.ndarray, best: Best) -> pa.StructArray:
    some = best.id != MOST
    return pa.StructArray.from_arrays([pa.array(query_ids[np.nonzero(some)[0]]), pa.array(best.id[some]), pa.array(best.score[some])], fields=list(_TRIPLE))


def _segment(ids: np.ndarray, rows: np.ndarray, every: int, k: int) -> tuple[dict, pa.StructArray]:
    """A segment's parts, and what its own queries find in it."""
    starts = np.append(np.arange(0, len(ids), BLOCK), len(ids))
    parts = {
        "ids": ids, "rows": rows, "starts": starts, "high": np.maximum.reduceat(rows, starts[:-1], 0), "low": np.minimum.reduceat(rows, starts[:-1], 0),
        "first": np.minimum.reduceat(ids, starts[:-1]), "best_high": rows.max(0), "best_low": rows.min(0),
    }
    asks = ids % every == 0
    best = Best(int(asks.sum()), k)
    search(ids[asks], rows[asks], parts, best)
    parts |= {"query_ids": ids[asks], "queries": rows[asks], "floor": best.score[:, -1], "last": best.id[:, -1]}
    return parts, _triples(ids[asks], best)


def _segments(scale: int, dim: int, every: int, k: int):
    """Cuts each partition's ordered rows into segments of at most BLOCKS blocks of BLOCK vectors."""

    def made(number: int, ids: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        task = TaskContext.get().partitionId() << 32
        parts, found = _segment(ids, rows, every, k)
        columns = [pa.array([task + number]), pa.array([task + number // TOGETHER]), *[pa.array([_packed(parts[n])], pa.binary()) for n in _PARTS]]
        columns.append(pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), found))
        return pa.RecordBatch.from_arrays(columns, names=["segment", "together", *_PARTS, "found"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, size = 0, BLOCK * BLOCKS
        ids, rows = np.empty(0, np.int64), np.empty((0, dim), np.int64)
        for batch in batches:
            ids = np.r_[ids, batch["vec_id"].to_numpy()]
            rows = np.r_[rows, integers(batch["vector"], scale, dim)]
            while len(ids) >= size:
                yield made(n, ids[:size], rows[:size])
                n, ids, rows = n + 1, ids[size:], rows[size:]
        if len(ids):
            yield made(n, ids, rows)

    return run


def _asked(lists: list[dict], dim: int) -> tuple:
    """(home segment, id, vector, floor, last) of all queries of a group."""
    home = np.concatenate([np.full(len(x["query_ids"]) // 8, x["segment"]) for x in lists])
    ids, floor, last = (np.concatenate([_longs(x[n]) for x in lists]) for n in ("query_ids", "floor", "last"))
    return home, ids, np.concatenate([_longs(x["queries"], dim) for x in lists]), floor, last


def _wanted(dim: int):
    """(together, segment) of the segments in which any query of the group may find something."""

    def run(table: pa.Table) -> pa.Table:
        row = table.to_pylist()[0]
        home, _, queries, floor, _ = _asked(row["queries"], dim)
        high, low = (_longs(b"".join(s[n] for s in row["summaries"]), dim) for n in ("best_high", "best_low"))
        number = np.array([s["segment"] for s in row["summaries"]], np.int64)
        hope = (bounds(queries, high, low) >= floor[:, None]) & (home[:, None] != number)
        number = number[hope.any(0)]
        return pa.table({"together": pa.array(np.full(len(number), row["together"]), pa.int64()), "segment": pa.array(number, pa.int64())})

    return run


def _elsewhere(k: int, dim: int):
    """A group's queries searched in a segment, without those at home in it."""

    def run(table: pa.Table) -> pa.Table:
        row = table.to_pylist()[0]
        home, ids, queries, floor, last = _asked(row["queries"], dim)
        away = home != row["segment"]
        segment = {n: _longs(row[n], dim if n in ("rows", "high", "low") else None) for n in ("ids", "rows", "starts", "high", "low", "first")}
        best = Best(int(away.sum()), k, floor[away], last[away])
        search(ids[away], queries[away], segment, best)
        return pa.Table.from_struct_array(_triples(ids[away], best))

    return run


def index(rows: DataFrame, *, scale: int, dim: int, every: int, k: int, pivots: int = 64) -> DataFrame:
    """The index: every row (vec_id, vector) in segments along the order of pivots and ids, with what its own queries find in it.

    Pivots are a bounded sample and only shape the order; results do not depend on them.
    """
    spark = rows.sparkSession
    picked = bounded_sample(rows, F.col("vec_id"), pivots * 4).orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).select("vector").toArrow()
    table = np.concatenate([integers(part, scale, dim) for part in picked["vector"].chunks] or [np.zeros((1, dim), np.int64)])
    shared = spark.sparkContext.broadcast(table)
    near = map_arrow(rows, _pivot(shared, scale, dim), f"vec_id long, vector {rows.schema['vector'].dataType.simpleString()}, pivot int")
    dealt = near.repartitionByRange("pivot", "vec_id").sortWithinPartitions("pivot", "vec_id").select("vec_id", "vector")
    return stored(map_arrow(dealt, _segments(scale, dim, every, k), _SEGMENT), "segments")


def top_k(
    rows: DataFrame, *, every: int = 100, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id and score: for each row whose id ``every`` divides, the ``k`` other rows of highest score.

    The score is the inner product of the vectors' integers floor(scale * component); ties go to the smaller id. A query
    is first searched in its own segment, whose vectors are like it; the k-th score found there is the bar that
    other segments, and then blocks, must reach. Queries travel in groups to the segments that any of them may need: a stated
    set of queries against all rows, in blocks. Each call of the search has one group and one segment, both bounded.

    Vectors that are null, hold null or non-finite components, or any beyond 2**62 after scaling, take no part, nor do rows without
    an id; shorter vectors count as if zeros followed. Of several rows of one id the smallest vector is used. A score
    that no long holds becomes the nearest long. Empty tables give no rows.
    """
    kept = pick(rows, vec_id=id_col, vector=vector_col).select(F.col("vec_id").cast("long").alias("vec_id"), "vector")
    kept = kept.filter(F.col("vec_id").isNotNull() & usable(F.col("vector"), scale))
    kept = stored(kept.groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors")
    dim = max(1, longest(kept, "vector"))
    made = index(kept, scale=scale, dim=dim, every=every, k=k)
    asks = made.filter(F.octet_length("query_ids") > 0).groupBy("together")
    groups = stored(asks.agg(F.collect_list(F.struct("segment", "query_ids", "queries", "floor", "last")).alias("queries")), "query-groups")
    # Bounds of whole segments first. Summaries are dealt into stretches of about SUMMARIES, and each of these into copies for SPREAD
    # sets of groups, so that no task has all groups.
    stretches = made.count() // SUMMARIES + 1
    summary = F.collect_list(F.struct("segment", "best_high", "best_low")).alias("summaries")
    summaries = made.groupBy(F.pmod(F.xxhash64("segment"), F.lit(stretches)).alias("stretch")).agg(summary)
    summaries = summaries.withColumn("dealt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))))
    asked = groups.withColumn("dealt", F.pmod(F.xxhash64("together"), F.lit(SPREAD)))
    asked = asked.withColumn("stretch", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(stretches - 1).cast("long"))))
    both = asked.join(summaries, ["stretch", "dealt"]).groupBy("stretch", "dealt", "together")
    wanted = stored(_one_by_one(both, _wanted(dim), "together long, segment long"), "wanted")
    there = made.select("segment", "ids", "rows", "starts", "high", "low", "first")
    pairs = wanted.join(groups, "together").join(there, "segment").groupBy("segment", "together")
    away = _one_by_one(pairs, _elsewhere(k, dim), _FOUND)
    near = made.select(F.inline("found"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = near.unionByName(away).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _one_by_one(groups, fn, schema: str) -> DataFrame:
    """``fn`` of one row at a time: rows of some megabytes would not fit a batch of thousands."""
    package_on_workers()
    return groups.applyInArrow(fn, schema)
