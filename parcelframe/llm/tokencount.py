"""Token counts by byte-pair merging with a heap over a linked list; no token identifiers are made."""

from __future__ import annotations

import heapq
import json
import uuid

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelframe.llm.common import Memo, pick, text_udf, worker_own

#: The split pattern of the byte-level vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes stand for themselves."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class MergeCounter:
    """Counts the tokens of a text under a byte-level merge list.

    A word's symbols form a linked list and its adjacent pairs a heap by (rank, position). The lowest pair is
    popped and merged until none is left; the count is the number of first symbols minus the number of merges.
    """

    def __init__(self, vocabulary: str, room: int = 400_000):
        data = json.loads(vocabulary)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in data["model"]["merges"]]
        names: dict[str, int] = {}
        number = lambda s: names.setdefault(s, len(names))
        self.letters = [number(x) for x in byte_letters()]
        self.pairs = {(number(a), number(b)): (rank, number(a + b)) for rank, (a, b) in enumerate(merges)}
        self.special = [t["content"] for t in data["added_tokens"]]
        self.stop = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.split = regex.compile(SPLIT)
        self.words = Memo(self.word, room)
        self.units = Memo(self.unit, room)

    def word(self, word: str) -> int:
        data = word.encode()
        n = len(data)
        if n < 2:
            return n
        symbols = [self.letters[b] for b in data]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = self.pairs
        heap = []
        for i in range(n - 1):
            found = pairs.get((symbols[i], symbols[i + 1]))
            if found:
                heap.append((found[0], i, found[1]))
        heapq.heapify(heap)
        left = n
        while heap:
            rank, i, merged = heapq.heappop(heap)
            j = after[i]
            if symbols[i] < 0 or j >= n:
                continue
            found = pairs.get((symbols[i], symbols[j]))
            if not found or found[0] != rank:
                continue  # one of the two symbols has changed since this entry was made
            symbols[i], symbols[j] = merged, -1
            k = after[i] = after[j]
            left -= 1
            if k < n:
                before[k] = i
                if found := pairs.get((merged, symbols[k])):
                    heapq.heappush(heap, (found[0], i, found[1]))
            if (p := before[i]) >= 0 and (found := pairs.get((symbols[p], merged))):
                heapq.heappush(heap, (found[0], p, found[1]))
        return left

    def unit(self, text: str) -> int:
        words = self.words
        return sum([words[w] for w in self.split.findall(text)])

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        if self.stop and self.stop.search(text):
            parts = self.stop.split(text)
            return len(parts) - 1 + sum(self(p) for p in parts)
        # A blank binds to the word after it, so single blanks are safe places to cut; runs of blanks are not.
        if "  " in text:
            return self.unit(text)
        first, *rest = text.split(" ")
        units = self.units
        return self.unit(first) + sum([units[" " + u] for u in rest])


def count_tokens(
    docs: DataFrame, vocabulary: str, *, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every whole text.

    ``vocabulary`` is the path of a byte-level merge file; its content (a few megabytes, whatever the input) is
    broadcast, so executors need no such file. Null and empty texts have 0 bytes and 0 tokens; repeated rows are
    counted each; a null id stays null. Special strings inside a text count as one token each.
    """
    with open(vocabulary, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    key = str(uuid.uuid4())

    def count(text):
        return (worker_own(key, lambda: MergeCounter(shared.value))(text),)

    text = F.coalesce(F.col("text"), F.lit(""))
    counted = pick(docs, doc_id=id_col, text=text_col).select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text_udf(count, "n_tokens long")("text").alias("found")
    )
    return counted.select("doc_id", "n_bytes", "found.n_tokens", (F.col("found.n_tokens") > limit).alias("over_limit"))
