"""Packs tokenized documents into fixed-length sequences by linear grouping and best fit.

Only histograms of lengths (at most one entry per possible length) and the plan made from them reach the driver.
A plan speaks of ranks within a length, so documents find their places in Spark by their ranks.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parcelframe.llm.common import Remembered, map_arrow, pick, worker_own
from parcelframe.session import stored

#: The vocabulary's split pattern.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Words of these characters are in composed form already, and lower-casing them does not depend on their neighbours.
PLAIN = re.compile("[\x21-\x7e\u00a1-\u024f]+\\Z")
#: Texts of these characters alone are cut into parts as a column: lower-casing changes no number of characters here.
SIMPLE = "\\A[\\x09-\\x0d\\x20-\\x7e\u00a1-\u012f\u0131-\u024f]*\\z"
#: The parts of SPLIT other than letters, which are what stands between them.
BETWEEN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{N}|[^\x09-\x0d\x20\p{L}\p{N}]+"


class WordEncoder(Remembered):
    """Token ids of texts as the vocabulary's own library gives them, with remembered words and parts of words.

    The vocabulary drops white space and never joins across it, so a text's ids are those of its words one after
    another, and a word's ids those of the parts it is split into. Every part's last token, and no other, ends a
    word; so unknown parts are encoded together and told apart by these tokens. Columns of simple texts are split by Arrow,
    other texts word by word. ``room`` bounds what is remembered.
    """

    def __init__(self, vocabulary: str, room: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_str(vocabulary)
        names = self.library.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(names.values()) + 1, bool)
        self.ends[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # Special strings, and separators beyond plain white space: such texts are encoded as a whole.
        separators = "[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
        self.odd = re.compile("|".join([separators, *map(re.escape, self.specials)]))
        super().__init__(room, "<u4")
        self._learn_whole([""])

    def _forget(self) -> None:
        super()._forget()
        if "" not in self.words:
            self._learn_whole([""])

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")

    def _learn_parts(self, parts: list[str]) -> None:
        for k in range(0, len(parts), 8192):
            some = parts[k : k + 8192]
            ids = np.array(self.library.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(some) and cuts[-1] == len(ids):
                self._add(some, np.diff(cuts, prepend=0), ids)
            else:
                self._learn_whole(some)

    def _learn_whole(self, words: list[str]) -> None:
        found = [self.whole(w) for w in words]
        if found:
            self._add(words, np.array([len(x) for x in found]), np.concatenate(found))

    def _learn_words(self, words: list[str]) -> None:
        """Words of which some have several parts and some are better left to the library."""
        split = {w: SPLIT.findall(w.lower()) for w in words if PLAIN.match(w)}
        self._learn_parts(list({p for parts in split.values() for p in parts if p not in self.words}))
        rest = [w for w in words if w not in self.words]
        self._learn_whole([w for w in rest if w not in split])
        for word in rest:
            if word in split:
                place, sizes = self.places(np.array([self.words[p] for p in split[word]]))
                self._add([word], np.array([sizes.sum()]), self.values[0].rows[place])

    def _coded(self, lists: pa.Array, learn) -> tuple[np.ndarray, np.ndarray]:
        """The ids of lists of words, and where those of each list begin and stop. Equal words are looked up once."""
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        found = self.numbers(coded.dictionary.to_pylist(), learn)
        place, sizes = self.places(found[codes])
        stops = np.r_[0, np.cumsum(sizes)]
        return self.values[0].rows[place], stops[lists.offsets.to_numpy() - lists.offsets[0].as_py()]

    def __call__(self, texts: list[str] | pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        simple = pc.match_substring_regex(texts, SIMPLE)
        for special in self.specials:
            simple = pc.and_not(simple, pc.match_substring(texts, special))
        others = texts.filter(pc.invert(simple)).to_pylist()
        odd = [bool(self.odd.search(t)) for t in others]
        parts = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(texts.filter(simple)), BETWEEN, r" \0 "))
        words = pc.ascii_split_whitespace(pa.array(["" if o else t for t, o in zip(others, odd, strict=True)], pa.large_string()))
        ids, stops = self._coded(parts, self._learn_parts)
        other_ids, other_stops = self._coded(words, self._learn_words)
        at = other_at = 0
        for is_simple in simple.to_pylist():
            if is_simple:
                yield ids[stops[at] : stops[at + 1]]
                at += 1
            else:
                yield self.whole(others[other_at]) if odd[other_at] else other_ids[other_stops[other_at] : other_stops[other_at + 1]]
                other_at += 1


def pieces(
    docs: DataFrame, vocabulary: str, *, capacity: int = 4096, end: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and the end id, cut at ``capacity``.

    A null or empty text is its end id alone; repeated rows are repeated pieces; a null id stays null.
    """
    with open(vocabulary, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    key, tail = str(uuid.uuid4()), np.array([end], "<u4")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_own(key, lambda: WordEncoder(shared.value))
        for big in batches:
            for k in range(0, big.num_rows, 512):
                batch = big.slice(k, 512)
                texts = batch["text"].fill_null("")
                rows = []
                for doc, ids in zip(batch["doc_id"].to_pylist(), encode(texts), strict=True):
                    ids = np.r_[ids, tail]
                    for number, at in enumerate(range(0, len(ids), capacity)):
                        own = ids[at : at + capacity]
                        rows.append((doc, number, at, len(own), zlib.crc32(own.tobytes())))
                kinds = (batch.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64())
                columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = pick(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


@dataclass
class Run:
    """``count`` sequences with consecutive numbers from ``first`` and ``room`` tokens left in each."""

    room: int
    first: int
    count: int


@dataclass
class Plan:
    """rows: (length, rank of the first document, number of documents, number of the first sequence)."""

    rows: list[tuple[int, int, int, int]]
    sequences: int


def groups_of(sizes: dict[int, int], number: int) -> list[list[int]]:
    """The lengths, longest first, in at most ``number`` groups of about equal numbers of documents.

    A length that fills a group by itself is a group, so no group holds fewer lengths than it must.
    """
    each = -(-sum(sizes.values()) // number)
    found: list[list[int]] = []
    held = each
    for length in sorted(sizes, reverse=True):
        if held >= each:
            found.append([])
            held = 0
        found[-1].append(length)
        held += sizes[length]
    return found


def best_filling(sizes: list[int], stock: list[int], capacity: int) -> list[int]:
    """How many of each rounded size to put into one sequence: the fullest filling that holds the largest size.

    An exact subset sum over the sizes in stock; reach[c] has the last size used to fill exactly c.
    """
    first = next(i for i, n in enumerate(stock) if n)
    reach = [-1] * (capacity + 1)
    reach[sizes[first]] = first
    used: list[dict[int, int]] = [{} for _ in range(capacity + 1)]
    used[sizes[first]] = {first: 1}
    filled = [sizes[first]]
    for i in range(first, len(sizes)):
        if not stock[i]:
            continue
        size = sizes[i]
        new = []
        for base in filled:
            already, c = used[base].get(i, 0), base
            for k in range(1, min(stock[i] - already, (capacity - base) // size) + 1):
                c = base + k * size
                if reach[c] < 0:
                    reach[c] = i
                    used[c] = {**used[base], i: already + k}
                    new.append(c)
        filled += new
        if reach[capacity] >= 0:
            break
    chosen = used[max(filled)]
    return [chosen.get(i, 0) for i in range(len(sizes))]


def best_plan(sizes: dict[int, int], capacity: int) -> Plan:
    """The plan with the fewest sequences over a few numbers of groups and limits of smallness.

    Each costs well under a second whatever the number of documents, as it works on the histogram alone.
    """
    least = -(-sum(s * n for s, n in sizes.items()) // capacity)
    best = None
    for groups in (12, 16, 24, 8, 48):
        for small in (capacity // 4, capacity // 8):
            plan = make_plan(sizes, capacity, groups=groups, small=small)
            if best is None or plan.sequences < best.sequences:
                best = plan
            if best.sequences == least:
                return best
    return best


def make_plan(sizes: dict[int, int], capacity: int, *, groups: int, small: int) -> Plan:
    """Places of all documents, from the number of documents of each length (1 to ``capacity``).

    Lengths above ``small`` are rounded up to the longest of their group and
    packed by the fullest fillings of the rounded sizes, each used as often as the stock allows. The documents then
    take the places of their group in order of length, and the small ones fill what is left, longest first, each
    into the fullest sequence with room for it, or a new sequence where there is none.
    """
    rows: list[tuple[int, int, int, int]] = []
    large = {s: n for s, n in sizes.items() if s > small}
    runs: list[Run] = []
    sequences = 0
    if large:
        members = groups_of(large, groups)
        rounded = [max(g) for g in members]
        stock = [sum(large[s] for s in g) for g in members]
        # What a group still has, longest first: [length, next rank, number left].
        left = [[[s, 0, large[s]] for s in sorted(g, reverse=True)] for g in members]
        while any(stock):
            filling = best_filling(rounded, stock, capacity)
            times = min(n // k for n, k in zip(stock, filling, strict=True) if k)
            fresh = [Run(capacity, sequences, times)]
            sequences += times
            for i, k in enumerate(filling):
                stock[i] -= k * times
                for _ in range(k):
                    fresh = _serve(left[i], fresh, rows)
            runs += fresh
    tiny = sorted(((s, n) for s, n in sizes.items() if s <= small), reverse=True)
    sequences = _best_fit(tiny, runs, capacity, sequences, rows)
    return Plan(rows, sequences)


def _serve(left: list[list[int]], runs: list[Run], rows: list) -> list[Run]:
    """Gives each sequence of the runs the next document of a group; a run is cut where the length changes."""
    served = []
    for run in runs:
        first, count = run.first, run.count
        while count:
            length, rank, n = left[0]
            take = min(n, count)
            rows.append((length, rank, take, first))
            served.append(Run(run.room - length, first, take))
            left[0][1:] = [rank + take, n - take]
            if n == take:
                left.pop(0)
            first, count = first + take, count - take
    return served


def _best_fit(tiny: list[tuple[int, int]], runs: list[Run], capacity: int, sequences: int, rows: list) -> int:
    """Best fit, longest first, of runs of equal documents into runs of sequences with equal room."""
    rooms = sorted({r.room for r in runs})
    by_room: dict[int, list[Run]] = {}
    for run in runs:
        by_room.setdefault(run.room, []).append(run)

    def put_back(run: Run) -> None:
        if run.room not in by_room:
            by_room[run.room] = []
            insort(rooms, run.room)
        by_room[run.room].append(run)

    for length, n in tiny:
        rank = 0
        while rank < n:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                new = -(-(n - rank) // (capacity // length))
                put_back(Run(capacity, sequences, new))
                sequences += new
                continue
            room = rooms[at]
            run = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                rooms.pop(at)
            # As many documents as fit go into each of these sequences before the next ones are touched.
            deep = min(room // length, -(-(n - rank) // run.count)) or 1
            for _ in range(deep):
                take = min(run.count, n - rank)
                rows.append((length, rank, take, run.first))
                rank += take
                if take < run.count:
                    put_back(Run(run.room, run.first + take, run.count - take))
                run = Run(run.room - length, run.first, take)
                if rank == n:
                    break
            if run.room:
                put_back(run)
    return sequences


def ranked(rows: DataFrame) -> DataFrame:
    """Adds the rank (from 0) of each row within its length, by id and piece; no length meets in one task.

    Rows are dealt out by ranges of (length, id, piece), counted per range and length, and numbered within both.
    They are stored first: ranges are found by a pass of their own, which would encode every text twice.
    """
    order = ["length", "doc_id", "piece", "start", "ids_crc32"]
    dealt = stored(stored(rows, "pieces").repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "dealt-pieces")
    counts = dealt.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "part").orderBy(*order[1:])) - 1
    return dealt.withColumn("own", own).join(counts, ["length", "part"]).select(*rows.columns, (F.col("before") + F.col("own")).alias("rank"))


def place(rows: DataFrame, capacity: int = 4096) -> DataFrame:
    """Adds sequence_id and offset to pieces; offsets follow each other without gaps from 0 in each sequence."""
    spark = rows.sparkSession
    numbered = stored(ranked(rows), "ranked")
    # One row per length, at most ``capacity`` rows.
    sizes = {r["length"]: r["n"] for r in numbered.groupBy("length").agg(F.count("*").alias("n")).toLocalIterator()}
    plan = best_plan(sizes, capacity)
    names = rows.columns
    by_length: dict[int, list[tuple[int, int]]] = {}
    for length, rank, _, first in plan.rows:
        by_length.setdefault(length, []).append((rank, first))
    # Bounded like the plan: the number of runs depends on the number of lengths, not on that of documents.
    shared = spark.sparkContext.broadcast(
        {length: tuple(np.array(x, np.int64) for x in zip(*sorted(found), strict=True)) for length, found in by_length.items()}
    )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            lengths, ranks = batch["length"].to_numpy(), batch["rank"].to_numpy()
            found = np.zeros(len(ranks), np.int64)
            for length in np.unique(lengths):
                mine = lengths == length
                starts, firsts = table[int(length)]
                at = np.searchsorted(starts, ranks[mine], side="right") - 1
                found[mine] = firsts[at] + ranks[mine] - starts[at]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in names], pa.array(found)], names=[*names, "sequence_id"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", sequence_id long"
    placed = map_arrow(numbered, look_up, schema)
    earlier = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "piece", "start", "ids_crc32").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0)))


def pack(docs: DataFrame, vocabulary: str, *, capacity: int = 4096, end: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id and offset."""
    return place(pieces(docs, vocabulary, capacity=capacity, end=end, id_col=id_col, text_col=text_col), capacity)
