"""Near-duplicate documents by SimHash; fingerprints are compared in bit-sliced form."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelframe.llm.common import map_arrow, pick, text_udf
from parcelframe.llm.components import components
from parcelframe.session import stored

SEED = 42
ALL = (1 << 64) - 1
STEP = 1 << 14
FREE = 12


def fingerprint(text: str | None, size: int = 3) -> int:
    """The 64-bit fingerprint as a signed number; 0 for a text without words.

    Words are split at ASCII white space and only A-Z are lower-cased. Shingles are hashed in blocks, so the memory
    for a very long text is its words and one block of hashes.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= size:
        total, starts, stops = 1, [0], [len(joined)]
    else:
        total = len(words) - size + 1
        starts, stops = [0, *(ends[: total - 1] + 1).tolist()], ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for k in range(0, total, STEP):
        found = [digest(joined[a:b], SEED) for a, b in zip(starts[k : k + STEP], stops[k : k + STEP], strict=True)]
        bits = np.unpackbits(np.array(found, np.uint64).view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(0, dtype=np.int64)
    value = int(np.packbits(ones * 2 > total, bitorder="little").view(np.uint64)[0])
    return value - (1 << 64) if value >> 63 else value


def masks(radius: int) -> list[int]:
    """Bit masks of which at least one is untouched whenever at most ``radius`` bits differ: two of radius + 2 blocks."""
    cuts = [round(i * 64 / (radius + 2)) for i in range(radius + 3)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [a | b for a, b in combinations(blocks, 2)]


@lru_cache(maxsize=1 << 16)
def finer(mask: int, radius: int) -> list[int]:
    """The mask with one of radius + 1 parts of its free bits added; one part must be free of differences."""
    free = [i for i in range(64) if not mask >> i & 1]
    cuts = [round(i * len(free) / (radius + 1)) for i in range(radius + 2)]
    return [mask | sum(1 << i for i in free[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def close_pairs(values: np.ndarray, stop: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of one bucket whose values differ in at most ``radius`` bits, one lag j - i at a time.

    ``values`` (uint64) are ordered by bucket and ``stop[i]`` is the end of the bucket of row i. Bit planes are
    stored vertically, 64 rows to a word. For each lag the planes are compared with themselves moved by the lag,
    and the distances of 64 rows at once are counted in carry-save bit counters. Words whose rows have all passed
    the radius, or have no partner in their bucket, are abandoned.
    """
    n = len(values)
    if n < 2:
        return
    width = -(-n // 64)
    bits = np.zeros((width * 64, 64), np.uint8)
    bits[:n] = np.unpackbits(values.view(np.uint8), bitorder="little").reshape(n, 64)
    planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)
    planes = planes[np.argsort(np.abs(planes_share(bits, n)))]  # the most telling planes first
    counters = max(1, radius.bit_length())
    begin = (1 << counters) - 1 - radius  # so that the counters overflow at radius + 1
    rows = np.arange(n)
    for lag in range(1, int((stop - rows).max())):
        alive = np.zeros(width * 64, np.uint8)
        alive[:n] = rows + lag < stop
        alive = np.packbits(alive, bitorder="little").view(np.uint64)
        live = np.flatnonzero(alive)
        mine, other = planes[:, live], _shifted_words(planes, live, lag)
        within = alive[live]
        count = [np.full(len(live), ALL if begin >> c & 1 else 0, np.uint64) for c in range(counters)]
        for k in range(64):
            carry = mine[k] ^ other[k]
            for c in range(counters):
                count[c], carry = count[c] ^ carry, count[c] & carry
            within = within & ~carry
            if k % 8 == 7:
                keep = within != 0
                if not keep.all():
                    live, within, mine, other = live[keep], within[keep], mine[:, keep], other[:, keep]
                    count = [x[keep] for x in count]
                    if not len(live):
                        break
        if len(live):
            hit = np.unpackbits(within.view(np.uint8), bitorder="little").reshape(-1, 64)
            word, bit = np.nonzero(hit)
            first = live[word] * 64 + bit
            yield first, first + lag


def planes_share(bits: np.ndarray, n: int) -> np.ndarray:
    """How far each bit's share of ones is from one half."""
    return bits[:n].mean(0) - 0.5


def _shifted_words(planes: np.ndarray, live: np.ndarray, lag: int) -> np.ndarray:
    """Only the ``live`` words of the planes moved down by ``lag`` rows."""
    whole, part = divmod(lag, 64)
    padded = planes.shape[1]
    low = np.where(live + whole < padded, planes[:, np.minimum(live + whole, padded - 1)], np.uint64(0))
    if not part:
        return low
    high = np.where(live + whole + 1 < padded, planes[:, np.minimum(live + whole + 1, padded - 1)], np.uint64(0))
    return (low >> np.uint64(part)) | (high << np.uint64(64 - part))


class _Links:
    """Keeps a forest of the linked rows, so that a dense bucket gives one edge per row and not one per pair."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while True:
            x, y = root[a], root[b]
            low = np.minimum(x, y)
            if (x == y).all():
                return
            np.minimum.at(root, x, low)
            np.minimum.at(root, y, low)
            while (root[root] != root).any():
                root[:] = root[root]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        child = np.flatnonzero(self.root != np.arange(len(self.root)))
        return child, self.root[child]


def _compare(radius: int, rows_at_once: int = 1 << 16):
    """Turns rows (mask, value, fp) that are ordered by bucket into edges, some whole buckets at a time."""

    def edges(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        new = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
        sizes = np.diff(np.r_[new, len(fps)])
        many = np.repeat(sizes > 1, sizes)
        fps, sizes = fps[many], sizes[sizes > 1]
        links = _Links(len(fps))
        stop = np.repeat(np.cumsum(sizes), sizes)
        for a, b in close_pairs(fps.view(np.uint64), stop, radius):
            links.add(a, b)
        a, b = links.edges()
        return pa.RecordBatch.from_arrays([pa.array(fps[a]), pa.array(fps[b])], names=["src", "dst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty((0, 2), np.int64), np.empty(0, np.int64)
        for batch in batches:
            keys = np.r_[keys, np.column_stack([batch["mask"].to_numpy(), batch["value"].to_numpy()])]
            fps = np.r_[fps, batch["fp"].to_numpy()]
            if len(fps) < rows_at_once:
                continue
            begin = len(keys) - int(np.argmax((keys != keys[-1]).any(1)[::-1])) if (keys != keys[-1]).any() else 0
            if begin:  # the last bucket may go on in the next batch
                yield edges(keys[:begin], fps[:begin])
                keys, fps = keys[begin:], fps[begin:]
        if len(fps):
            yield edges(keys, fps)

    return run


def near_edges(prints: DataFrame, radius: int = 3, largest: int = 2048) -> DataFrame:
    """Edges (src, dst) that connect all distinct fingerprints ``fp`` with ``radius`` or fewer differing bits.

    Two such fingerprints agree on at least one mask of two blocks; rows meet by (mask, masked value). A bucket of
    more than ``largest`` fingerprints is not gathered: its rows are dealt out again with a part of their free bits
    added to the mask, which again must agree in at least one way, until the buckets are small. As fingerprints are
    distinct, a bucket with FREE or fewer free bits has at most 2 ** FREE rows and is not dealt out further. Within a bucket the edges form a spanning forest, so
    their number is below that of the rows.
    """
    level = [_signed(m) for m in masks(radius)]
    rows = prints.select("fp", F.explode(F.array(*[F.lit(m) for m in level])).alias("mask"))
    rows = rows.select("mask", F.col("mask").bitwiseAND(F.col("fp")).alias("value"), "fp")
    found = None
    while True:
        sizes = rows.groupBy("mask", "value").count()
        wide = F.bit_count(F.bitwise_not("mask")) > FREE
        hot = stored(sizes.filter((F.col("count") > largest) & wide).select("mask", "value"), "hot-buckets")
        crowded = not hot.isEmpty()
        calm = rows.join(hot, ["mask", "value"], "left_anti") if crowded else rows
        dealt = calm.repartition("mask", "value").sortWithinPartitions("mask", "value")
        edges = map_arrow(dealt, _compare(radius), "src long, dst long")
        found = edges if found is None else found.unionByName(edges)
        if not crowded:
            return found.distinct()
        rows = rows.join(hot, ["mask", "value"], "left_semi").select("mask", "fp")
        rows = map_arrow(rows, _dealt_again(radius), "mask long, value long, fp long").distinct()
        rows = stored(rows, "hot-rows")


def _dealt_again(radius: int):
    """Each row under all finer masks of its mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask, fp = batch["mask"].to_numpy(), batch["fp"].to_numpy()
            for own in np.unique(mask):
                mine = fp[mask == own]
                for fine in map(_signed, finer(int(own) & ALL, radius)):
                    fine = np.full(len(mine), fine, np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(fine), pa.array(fine & mine), pa.array(mine)], names=["mask", "value", "fp"])

    return run


def fingerprint_column(text: Column, size: int = 3) -> Column:
    return text_udf(lambda value: (fingerprint(value, size),), "fp long")(text)["fp"]


def group_near(docs: DataFrame, *, radius: int = 3, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest id reachable over near fingerprints.

    Equal texts meet as one fingerprint before anything is compared, so a group of copies costs one row. Null and
    empty texts have fingerprint zero and are linked like any other; repeated rows are answered each; a null id
    stays null and never names a component unless the component has no other id.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    rows = stored(rows.select("doc_id", fingerprint_column(F.col("text"), size).alias("fp")), "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    groups = components(near_edges(prints.select("fp"), radius)).withColumnRenamed("node", "fp")
    named = prints.join(groups, "fp", "left").select("fp", "low", F.coalesce("component", "fp").alias("component"))
    lows = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(lows, "component").select("fp", "component_id")
    joined = rows.join(named, "fp")
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
