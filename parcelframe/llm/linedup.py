"""Removes passages that a document shares with an earlier one: pairwise alignment of lines by patience diff."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelframe.llm.common import col, map_arrow, pick, spare_name, whole_ids
from parcelframe.session import stored


def anchors(hashes: list[int], words: list[int], least: int) -> list[int]:
    """A hash for each shortest run of whole lines that begins at a line and has ``least`` words or more.

    A common block with so many words begins with such a run, so two documents share a block if, and only if, they
    share an anchor. A single short line that many documents have is never an anchor: runs are rare by construction.
    """
    found, stop, total = [], 0, 0
    for start in range(len(hashes)):
        while stop < len(hashes) and total < least:
            total += words[stop]
            stop += 1
        if total < least:
            break
        run = hashes[start:stop]
        found.append(run[0] if len(run) == 1 else xxhash.xxh64_intdigest(b"".join(h.to_bytes(8, "little", signed=True) for h in run)) - (1 << 63))
        total -= words[start]
    return found


def line_table(text: str | None) -> tuple[list[int], list[int], list[int]]:
    """Hashes, word counts and line numbers of the lines that are not blank; outer white space is left out."""
    hashes, words, numbers = [], [], []
    for number, line in enumerate((text or "").split("\n")):
        n = len(line.split())
        if n:
            hashes.append(xxhash.xxh64_intdigest(line.strip().encode()) - (1 << 63))
            words.append(n)
            numbers.append(number)
    return hashes, words, numbers


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, ordered by their first part, whose second parts increase (patience sorting)."""
    tops: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        back.append(ends[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(j)
            ends.append(k)
        else:
            tops[pile], ends[pile] = j, k
    found, k = [], ends[-1] if ends else -1
    while k >= 0:
        found.append(pairs[k])
        k = back[k]
    return found[::-1]


def _matches(a: list, b: list) -> dict[int, int]:
    """Aligned lines (place in b: place in a): patience anchors, each extended while the neighbours agree."""
    in_a, in_b = Counter(a), Counter(b)
    place_a = {x: i for i, x in enumerate(a) if in_a[x] == 1}
    unique = [(place_a[x], j) for j, x in enumerate(b) if in_b[x] == 1 and x in place_a]
    kept = _increasing(sorted(unique))
    found: dict[int, int] = {}
    for i, j in kept:
        for step in (-1, 1):
            x, y = (i, j) if step < 0 else (i + 1, j + 1)
            while 0 <= x < len(a) and 0 <= y < len(b) and a[x] == b[y] and y not in found:
                found[y] = x
                x, y = x + step, y + step
    return found


def _numbered(lines: list) -> list:
    seen: Counter = Counter()
    found = []
    for x in lines:
        seen[x] += 1
        found.append((x, seen[x]))
    return found


def common_blocks(earlier: list[int], later: list[int], words: list[int], least: int) -> set[int]:
    """Places in ``later`` of blocks of ``least`` words or more that ``earlier`` has as well.

    The alignment is repeated on what is left, so moved and repeated passages are found as well; a line without a
    unique partner is told apart by its occurrence. Blocks are adjacent in both documents. An alignment may choose
    short lines that cross a passage; the passages it never reaches are looked up as runs of ``earlier``.
    """
    gone: set[int] = set()
    while True:
        left: list = [(-1, j) if j in gone else x for j, x in enumerate(later)]
        new: set[int] = set()
        for a, b in ((earlier, left), (_numbered(earlier), _numbered(left))):
            match = _matches(a, b)
            block: list[int] = []
            for j in [*sorted(match), None]:
                if block and (j is None or j != block[-1] + 1 or match[j] != match[block[-1]] + 1):
                    if sum(words[x] for x in block) >= least:
                        new.update(block)
                    block = []
                if j is not None:
                    block.append(j)
            if new:
                break
        if not new:
            return gone if len(gone) == len(later) else gone | _shared_runs(earlier, later, words, least)
        gone |= new


def _shared_runs(earlier: list[int], later: list[int], words: list[int], least: int) -> set[int]:
    """Places in ``later`` of every run of ``least`` words or more that stands in ``earlier``, whatever crosses it.

    A suffix automaton of ``earlier`` gives the longest common run that ends at each place, in linear time.
    """
    follow: list[dict[int, int]] = [{}]
    link, long = [-1], [0]
    last = 0
    for x in earlier:
        state, new = last, len(follow)
        follow.append({})
        long.append(long[last] + 1)
        link.append(0)
        while state >= 0 and x not in follow[state]:
            follow[state][x] = new
            state = link[state]
        if state >= 0:
            other = follow[state][x]
            if long[other] != long[state] + 1:
                copy = len(follow)
                follow.append(dict(follow[other]))
                long.append(long[state] + 1)
                link.append(link[other])
                link[other] = copy
                while state >= 0 and follow[state].get(x) == other:
                    follow[state][x] = copy
                    state = link[state]
                other = copy
            link[new] = other
        last = new
    before = [0, *accumulate(words)]
    found: set[int] = set()
    state = length = 0
    for j, x in enumerate(later):
        while state and x not in follow[state]:
            state = link[state]
            length = long[state]
        if x in follow[state]:
            state, length = follow[state][x], length + 1
        if length and before[j + 1] - before[j + 1 - length] >= least:
            found.update(range(j + 1 - length, j + 1))
    return found


#: Sets of later documents that an owner of shared passages is copied to at most.
SALTS = 64
_LINES = pa.schema([("doc_id", pa.int64()), ("seal", pa.int64()), ("hashes", pa.list_(pa.int64())), ("words", pa.list_(pa.int32())), ("numbers", pa.list_(pa.int32())), ("anchors", pa.list_(pa.int64()))])


def _tabulate(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for k in range(0, big.num_rows, 512):
                batch = big.slice(k, 512)
                made = [line_table(t) for t in batch["text"].to_pylist()]
                arrays = [[m[i] for m in made] for i in range(3)] + [[anchors(m[0], m[1], least) for m in made]]
                columns = [pa.array(x, kind) for x, kind in zip(arrays, _LINES.types[2:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["seal"], *columns], schema=_LINES)

    return run


def _align(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for k in range(0, big.num_rows, 256):
                batch = big.slice(k, 256)
                kept = []
                for doc, seal, a, b, words, numbers in zip(*(batch[n].to_pylist() for n in ("doc_id", "seal", "earlier", "hashes", "words", "numbers")), strict=True):
                    places = sorted(common_blocks(a, b, words, least))
                    # Blank lines between two deleted lines go with them.
                    lines = {numbers[p] for p in places}
                    for p, q in zip(places, places[1:], strict=False):
                        if q == p + 1:
                            lines.update(range(numbers[p] + 1, numbers[q]))
                    if lines:
                        kept.append((doc, seal, sorted(lines)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in kept], pa.int64()), pa.array([r[1] for r in kept], pa.int64()), pa.array([r[2] for r in kept], pa.list_(pa.int32()))],
                    names=["doc_id", "seal", "lines"],
                )

    return run


def shared_lines(docs: DataFrame, *, least: int = 25, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, seal, lines): the numbers of the lines to delete from each document that loses some.

    Of the documents with an anchor the one with the smallest (doc_id, seal) owns it, and each other one is paired
    with the owner: a passage in n documents makes n - 1 pairs however many they are, and none is missed, as the
    owner's copy stays. ``seal`` is the text's hash; it tells documents of one id apart. Rows that agree in both are
    one document. Rows without id take no part, nor do null and empty texts; very long texts are like any other. An empty table
    gives no rows. Ids must be whole numbers.
    """
    whole_ids(docs, id_col)
    rows = pick(docs, doc_id=id_col, text=text_col).filter("doc_id is not null and text is not null")
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("seal"), "text")
    table = stored(map_arrow(rows, _tabulate(least), "doc_id long, seal long, hashes array<long>, words array<int>, numbers array<int>, anchors array<long>"), "lines")
    held = table.select(F.struct("doc_id", "seal").alias("doc"), F.explode(F.array_distinct("anchors")).alias("anchor"))
    owners = held.groupBy("anchor").agg(F.min("doc").alias("owner"), F.max("doc").alias("last")).filter("owner <> last")
    pairs = held.join(owners, "anchor").filter("doc <> owner").select("doc", "owner").distinct()
    pairs = stored(pairs.select("doc.*", F.col("owner.doc_id").alias("own_id"), F.col("owner.seal").alias("own_seal")), "pairs")
    lines = table.dropDuplicates(["doc_id", "seal"])
    # An owner's lines go to as many tasks as its later documents are dealt over by their salt, one copy for each salt in use.
    owner, salt = ["own_id", "own_seal"], F.pmod(F.xxhash64("doc_id", "seal"), F.lit(SALTS)).alias("salt")
    pairs = pairs.select("*", salt)
    first = lines.select(F.col("doc_id").alias("own_id"), F.col("seal").alias("own_seal"), F.col("hashes").alias("earlier"))
    first = first.join(pairs.select(*owner, "salt").distinct(), owner)
    both = pairs.join(first, [*owner, "salt"]).join(lines.drop("anchors"), ["doc_id", "seal"])
    found = map_arrow(both.select("doc_id", "seal", "earlier", "hashes", "words", "numbers"), _align(least), "doc_id long, seal long, lines array<int>")
    return found.groupBy("doc_id", "seal").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("lines")))).alias("lines"))


def remove_shared(docs: DataFrame, *, least: int = 25, id_col: str = "doc_id", text_col: str = "text", lines_col: str | None = None) -> DataFrame:
    """All rows and columns, the text without the aligned blocks that an earlier document has.

    A block is a run of whole lines with ``least`` words or more in all; shorter common lines stay. Null ids and
    texts pass unchanged, exact repetitions of a row change alike, and a text of which nothing is left is empty.
    ``lines_col`` names an added column with the numbers of the deleted lines (null if none). Very long texts and ties are as in
    ``shared_lines``; an empty table stays empty, and names of other columns do not matter. Ids must be whole numbers.
    """
    found = stored(shared_lines(docs, least=least, id_col=id_col, text_col=text_col), "deletions")
    own_id, own_seal, lines = (spare_name(docs, n) for n in ("own_id", "own_seal", "gone_lines"))
    found = found.select(F.col("doc_id").alias(own_id), F.col("seal").alias(own_seal), F.col("lines").alias(lines))
    text, doc = col(text_col), col(id_col)
    # By sorting at every size: a plan that broadcasts few deletions and shuffles texts for many is hard to foresee.
    joined = docs.join(found.hint("merge"), (doc.cast("long") == F.col(own_id)) & (F.xxhash64(text) == F.col(own_seal)), "left")
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda _, i: ~F.array_contains(F.col(lines), i)), "\n")
    cut = [F.when(F.col(lines).isNull(), text).otherwise(kept).alias(c) if c == text_col else col(c) for c in docs.columns]
    return joined.select(*cut, *([F.col(lines).alias(lines_col)] if lines_col else []))
