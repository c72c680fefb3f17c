"""The prefix trie of conversations, from sorted turn sequences and range minima of their common prefixes.

Sequences of turn digests are sorted and cut into chunks. Within a chunk the lengths of the common prefixes of neighbours go
into a sparse table. Each candidate prefix finds how far its interval reaches to the left and to the right by two binary
searches of its own on range minima. Whatever a node needs then comes from prefix sums over its interval. Nodes that cross the ends of a chunk are added up over
the chunks they reach.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelframe.llm.common import map_arrow, pick
from parcelframe.session import package_on_workers, stored

#: Bytes of a turn's digest; conversations and turns of a chunk at most, one conversation at least.
WIDTH, MEMBERS, TURNS = 16, 4096, 100_000
NOTHING = hashlib.sha256(b"").hexdigest()


def turn_lists(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id and turns, the array of (digest, bytes) of a conversation's turns in order.

    Turns are in order of their number (null first), then of role and text digest. Null roles and texts are empty. Rows without a
    conversation take no part, repeated rows are turns each. A turn is 16 bytes of digest here, whatever its
    text; a conversation's turns come together in one row, as its nodes are a chain.
    """
    found = pick(rows, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col).filter("conv_id is not null")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)))
    turn = F.struct("turn", role.alias("role"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    found = found.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return found.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["bytes"].alias("bytes"))).alias("turns"))


def borrowed_heads(turns: DataFrame, *, every: int = 5, most: int = 9) -> DataFrame:
    """Each conversation with its first h turns replaced by those of conversation c - c % every, h being crc32(c) % most.

    Fewer than h turns there are taken all, none if that conversation is absent; ``%`` has the sign of c.
    """
    c, h = F.col("conv_id"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    # At most ``every`` conversations ask for one head, and a head is short.
    heads = turns.filter(c % every == 0).select(c.alias("donor"), F.slice("turns", 1, most).alias("head"))
    joined = turns.withColumn("donor", c - c % every).join(heads, "donor", "left")
    own = F.slice(F.col("turns"), h + 1, F.greatest(F.lit(1), F.size("turns")))
    none = F.array().cast(turns.schema["turns"].dataType)
    head = F.when(h > 0, F.slice(F.coalesce("head", none), F.lit(1), F.greatest(F.lit(1), h))).otherwise(none)
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


class Minima:
    """Range minima in constant time: level k has the minimum of each stretch of 2**k values."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while len(self.levels[-1]) > 1 << (len(self.levels) - 1):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minima of the stretches from first to last, both included."""
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][first[at]], self.levels[k][last[at] - (1 << k) + 1])
        return out


def _extent(minima: Minima, at: np.ndarray, depth: np.ndarray, n: int, right: bool) -> np.ndarray:
    """How far each (row, depth) reaches: the last row whose prefixes towards ``at`` have ``depth`` turns in common.

    A binary search per candidate: the reach is tried in halves, each a range minimum of the common prefixes between.
    """
    low, high = (at.copy(), np.full(len(at), n - 1)) if right else (np.zeros(len(at), np.int64), at.copy())
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_] + right) // 2
        first, last = (at[open_] + 1, middle) if right else (middle + 1, at[open_])
        holds = minima.least(first, last) >= depth[open_]
        if right:
            low[open_] = np.where(holds, middle, low[open_])
            high[open_] = np.where(holds, high[open_], middle - 1)
        else:
            high[open_] = np.where(holds, middle, high[open_])
            low[open_] = np.where(holds, low[open_], middle + 1)


def shared_turns(a: bytes, b: bytes) -> int:
    """How many turns two sequences begin with in common."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * WIDTH] == b[: middle * WIDTH]:
            low = middle
        else:
            high = middle - 1
    return low


class Chunk:
    """The nodes of sorted sequences (paths), with the paths just before and after the chunk, if any."""

    def __init__(self, ids: list[int], paths: list[bytes], sizes: list[np.ndarray], before: bytes | None, after: bytes | None):
        n = len(ids)
        self.ids, self.paths = np.array(ids, np.int64), paths
        length = np.array([len(p) // WIDTH for p in paths], np.int64)
        common = np.array([-1 if before is None else shared_turns(before, paths[0]), *(shared_turns(a, b) for a, b in pairwise(paths))], np.int64)
        self.next = -1 if after is None else shared_turns(paths[-1], after)
        # Candidates: every prefix that begins at a row, and those that come in from the chunk before.
        first_depth = np.minimum(common + 1, length + 1)
        first_depth[0] = 0
        counts = length + 1 - first_depth
        self.row = np.repeat(np.arange(n), counts)
        self.depth = np.arange(len(self.row)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first_depth, counts)
        minima = Minima(common)
        self.left = _extent(minima, self.row, self.depth, n, right=False)
        self.right = _extent(minima, self.row, self.depth, n, right=True)
        self.comes_in = (self.left == 0) & (common[0] >= self.depth)
        self.goes_out = (self.right == n - 1) & (self.next >= self.depth)
        self.n = self.right - self.left + 1
        self.least = Minima(self.ids).least(self.left, self.right)
        # Bytes of the first d turns of row i are at begin[i] + d.
        begin = np.cumsum(length + 1) - length - 1
        upto = np.concatenate([np.r_[0, np.cumsum(s)] for s in sizes]).astype(np.int64)
        whole = upto[begin + length]
        before_depth = np.maximum(self.depth - 1, 0)
        # Bytes that the members have from this depth on, and the bytes of the distinct nodes there.
        sums = np.r_[0, np.cumsum(whole)]
        at_depth = upto[begin[self.left] + before_depth]
        self.spent = sums[self.right + 1] - sums[self.left] - self.n * at_depth
        new = whole - upto[begin + np.maximum(common, 0)]
        sums = np.r_[0, np.cumsum(new)]
        start = np.maximum(common[self.left], before_depth)
        self.distinct = sums[self.right + 1] - sums[self.left + 1] + whole[self.left] - upto[begin[self.left] + np.maximum(start, 0)]
        leaf = np.r_[0, np.cumsum(np.r_[common[1:], self.next] < length)]
        self.leaves = leaf[self.right + 1] - leaf[self.left]
        # A child begins where exactly this depth is shared and the row goes on, or at the interval's own first row.
        goes_on = np.flatnonzero(length > common)
        keys = np.sort(np.maximum(common[goes_on], 0) * n + goes_on)
        children = np.searchsorted(keys, self.depth * n + self.right, "right") - np.searchsorted(keys, self.depth * n + self.left, "right")
        # At the first row of an interval a child is new unless it came in as well.
        opens = (length[self.left] > self.depth) & (common[self.left] <= self.depth)
        self.children = children + opens
        self.length = length

    def ending(self, k: int) -> str:
        """The ids of the members that end at the node, in order, joined by commas: they come first in its interval."""
        first, last = self.left[k], self.right[k]
        stop = first + int(np.searchsorted(self.length[first : last + 1] > self.depth[k], True))
        return ",".join(map(str, self.ids[first:stop].tolist()))

    def names(self, which: np.ndarray) -> list[bytes]:
        """A digest of the prefix of each of the nodes, which are in order of rows and depths."""
        found, row, told, depth = [], -1, None, 0
        for i, d in zip(self.row[which].tolist(), self.depth[which].tolist(), strict=True):
            if i != row:
                row, told, depth = i, hashlib.md5(), 0
            told.update(self.paths[i][depth * WIDTH : d * WIDTH])
            depth = d
            found.append(d.to_bytes(4, "big") + told.copy().digest())
        return found

    def parents(self) -> np.ndarray:
        """The place of each node's parent among the candidates, -1 for the root.

        The parent of a row's first new node is a node of the row before: the candidate whose interval has this row at depth less one.
        """
        order = np.full(len(self.row), -1)
        last: list[int] = []
        for k, (row, depth) in enumerate(zip(self.row.tolist(), self.depth.tolist(), strict=True)):
            if depth:
                order[k] = last[depth - 1]
            del last[depth:]
            last.append(k)
        return order


def _chunk_of(row: dict) -> Chunk:
    cut = np.frombuffer(row["sizes"], np.int64)
    paths = row["paths"]
    ends = np.cumsum([len(p) // WIDTH for p in paths])
    return Chunk(np.frombuffer(row["ids"], np.int64), paths, np.split(cut, ends[:-1]), row["before"], row["after"])


_CHUNK = "chunk long, ids binary, paths array<binary>, sizes binary, first binary, last binary"
_OPEN = "name binary, chunk long, n long, least long, spent long, distinct long, leaves long, children long, ending string"
_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_KINDS = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<binary>": pa.list_(pa.binary())}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def _cut(members: int, most: int):
    """Ordered rows (path, conv_id, sizes) into rows of one chunk each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId() << 32, 0
        ids, paths, sizes, turns = [], [], [], 0

        def chunk() -> pa.RecordBatch:
            row = [task + n, np.array(ids, np.int64).tobytes(), paths, np.concatenate(sizes).astype(np.int64).tobytes(), paths[0], paths[-1]]
            return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(row, _schema(_CHUNK).types, strict=True)], schema=_schema(_CHUNK))

        for batch in batches:
            flat, at = batch["sizes"].flatten().to_numpy(), batch["sizes"].offsets.to_numpy()
            at = at - at[0]
            for k, (path, conv) in enumerate(zip(batch["path"].to_pylist(), batch["conv_id"].to_pylist(), strict=True)):
                own = len(path) // WIDTH
                if ids and (len(ids) >= members or turns + own > most):
                    yield chunk()
                    ids, paths, sizes, turns, n = [], [], [], 0, n + 1
                ids.append(conv)
                paths.append(path)
                sizes.append(flat[at[k] : at[k + 1]].copy())
                turns += own
        if ids:
            yield chunk()

    return run


def _open_nodes(table: pa.Table) -> pa.Table:
    """What a chunk adds to the nodes that it shares with its neighbours."""
    row = table.to_pylist()[0]
    c = _chunk_of(row)
    which = np.flatnonzero(c.comes_in | c.goes_out)
    columns = [c.names(which), np.full(len(which), row["chunk"]), *(getattr(c, n)[which] for n in ("n", "least", "spent", "distinct", "leaves", "children"))]
    columns.append([c.ending(k) for k in which])
    return pa.table([pa.array(x, kind) for x, kind in zip(columns, _schema(_OPEN).types, strict=True)], schema=_schema(_OPEN))


def _nodes(table: pa.Table) -> pa.Table:
    """The nodes that begin in a chunk; those that reach other chunks have their sums from ``shared``."""
    row = table.to_pylist()[0]
    c = _chunk_of(row)
    values = {n: getattr(c, n).copy() for n in ("n", "least", "spent", "distinct", "leaves", "children")}
    ends = {}
    shared = {x["name"]: x for x in row["shared"] or ()}
    which = np.flatnonzero(c.comes_in | c.goes_out)
    for k, name in zip(which.tolist(), c.names(which), strict=True):
        for n, column in values.items():
            column[k] = shared[name][n]
        ends[k] = shared[name]["ends"]
    parent = c.parents()
    own = np.flatnonzero(~c.comes_in)
    named = np.where(parent[own] >= 0, values["least"][parent[own]], 0)
    columns = [
        values["least"][own], c.depth[own], pa.array(named, mask=parent[own] < 0), values["n"][own], values["children"][own], values["leaves"][own],
        values["spent"][own] - values["distinct"][own],
        [ends[k] if k in ends else hashlib.sha256(c.ending(k).encode()).hexdigest() for k in own.tolist()],
    ]
    return pa.table([x if isinstance(x, pa.Array) else pa.array(x, kind) for x, kind in zip(columns, _schema(_NODE).types, strict=True)], schema=_schema(_NODE))


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (name, ending) in order of names and chunks into one digest per name, a part at a time."""
    now, told = None, hashlib.sha256()
    for batch in batches:
        names, found = [], []
        for name, ending in zip(batch["name"].to_pylist(), batch["ending"].to_pylist(), strict=True):
            if name != now:
                if now is not None:
                    names.append(now)
                    found.append(told.hexdigest())
                now, told = name, hashlib.sha256(ending.encode())
            else:
                told.update(b"," + ending.encode())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(found, pa.string())], names=["name", "ends"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([told.hexdigest()])], names=["name", "ends"])


def prefix_trie(turns: DataFrame, *, members: int = MEMBERS, most: int = TURNS) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, array of digest and bytes; see ``turn_lists``).

    conv_id (the smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves and
    saved_tokens of the subtree, ends_sha256 of the ids of the members that end at the node. Conversations without turns are members
    of the root, which is there unless ``turns`` has no row. Conversations that are alike, however many, spread over
    chunks in order of their ids. The chunks are read twice: first for what they add to the nodes they share with neighbours,
    a chain of at most the turns of two conversations for each, then for all nodes with these sums known.
    """
    path = F.coalesce(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""), F.lit(""))
    rows = turns.select("conv_id", F.unhex(path).alias("path"), F.transform("turns", lambda t: t["bytes"]).alias("sizes"))
    rows = stored(rows, "paths").repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    chunks = stored(map_arrow(rows.select("path", "conv_id", "sizes"), _cut(members, most), _CHUNK), "chunks")
    # One row per chunk: their ends tell each chunk what lies before and after it.
    along = Window.orderBy("chunk")
    ends = chunks.select("chunk", F.lag("last").over(along).alias("before"), F.lead("first").over(along).alias("after"))
    chunks = stored(chunks.drop("first", "last").join(ends, "chunk"), "chunks")
    package_on_workers()
    parts = stored(chunks.groupBy("chunk").applyInArrow(_open_nodes, _OPEN), "open-nodes")
    ending = parts.filter("ending <> ''").repartition("name").sortWithinPartitions("name", "chunk").select("name", "ending")
    ended = map_arrow(ending, _digested, "name binary, ends string")
    added = [F.min(n).alias(n) if n == "least" else F.sum(n).alias(n) for n in ("n", "least", "spent", "distinct", "leaves", "children")]
    sums = parts.groupBy("name").agg(*added).join(ended, "name", "left").withColumn("ends", F.coalesce("ends", F.lit(NOTHING)))
    shared = parts.select("name", "chunk").join(stored(sums, "shared-nodes"), "name").groupBy("chunk").agg(
        F.collect_list(F.struct("name", "n", "least", "spent", "distinct", "leaves", "children", "ends")).alias("shared")
    )
    return chunks.join(shared, "chunk", "left").groupBy("chunk").applyInArrow(_nodes, _NODE)


def conversation_trie(rows: DataFrame, **columns: str) -> DataFrame:
    """The trie of all conversations of ``rows`` (conv_id, turn, role, text), each with its borrowed head."""
    return prefix_trie(borrowed_heads(turn_lists(rows, **columns)))
