"""Vector codes: each part of a vector is replaced by the number of its nearest entry in that part's codebook.

Everything is exact integer arithmetic, so codes, ties and codebooks are the same however the rows are dealt out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelframe.llm.common import map_arrow, pick
from parcelframe.llm.vectors import exact_dot, fits, integers, longest, squares, usable

SALTS = 32
_LOW = 31


@dataclass
class Codebooks:
    """``entries`` has the shape (parts, entries, components of a part)."""

    entries: np.ndarray
    scale: int

    @property
    def dim(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def sha256(self) -> str:
        """Of all decimal components by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()

    def assign(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the nearest entry of each part, ties to the lower one; the squared distances summed over the parts)."""
        parts, _, size = self.entries.shape
        nearest, errors = [], 0
        for p in range(parts):
            own, book = rows[:, p * size : (p + 1) * size], self.entries[p]
            ends = [abs(int(x)) for a in (own, book) if a.size for x in (a.min(), a.max())]
            least, far = squares(book), squares(own)
            if not fits(4 * size, *[max(ends, default=0)] * 2):
                least, far = least.astype(object), far.astype(object)
            # The row's own square is the same for all entries.
            rest = least - 2 * exact_dot(own, book)
            at = rest.argmin(1)
            nearest.append(at)
            errors = errors + (far + rest[np.arange(len(own)), at]).astype(object)
        return np.array(nearest).T, errors


def _sums(books, step: int = 4096):
    """Rows (cell, n, high, low): of each component of each entry, the number of its parts and their sum in two limbs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book: Codebooks = books.value
        parts, entries, size = book.entries.shape
        count = np.zeros(parts * entries, np.int64)
        high, low = np.zeros((parts * entries, size), np.int64), np.zeros((parts * entries, size), np.int64)
        for batch in batches:
            for k in range(0, batch.num_rows, step):
                rows = integers(batch.column(0).slice(k, step), book.scale, book.dim)
                at = (book.assign(rows)[0] + np.arange(parts) * entries).reshape(-1)
                cut = rows.reshape(-1, size)
                count += np.bincount(at, minlength=len(count))
                np.add.at(high, at, cut >> _LOW)
                np.add.at(low, at, cut & ((1 << _LOW) - 1))
        used = np.flatnonzero(count)
        cells = (used[:, None] * size + np.arange(size)).reshape(-1)
        columns = [cells, np.repeat(count[used], size), high[used].reshape(-1), low[used].reshape(-1)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cell", "n", "high", "low"])

    return run


def _codes(books, step: int = 4096):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book: Codebooks = books.value
        for big in batches:
            for k in range(0, big.num_rows, step):
                batch = big.slice(k, step)
                at, error = book.assign(integers(batch["vector"], book.scale, book.dim))
                code = [x.tobytes().hex() for x in at.astype(np.uint8)]
                error = [x if x < 1 << 63 else None for x in map(int, error)]
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"], batch["label"], pa.array(code, pa.string()), pa.array(error, pa.int64())],
                    names=["vec_id", "label", "code", "error"],
                )

    return run


def _kept(rows: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    found = pick(rows, vec_id=id_col, vector=vector_col, label=label_col)
    return found.select(F.col("vec_id").cast("long").alias("vec_id"), "vector", "label").filter(usable(F.col("vector"), scale))


def _seeds(kept: DataFrame, entries: int) -> list:
    """The vectors of the smallest ids, ascending; of several vectors of an id the smallest one.

    Each job takes ``entries`` rows, so repeated rows cost more jobs and never more memory.
    """
    found: dict[int, list] = {}
    rest = kept.filter("vec_id is not null").select("vec_id", "vector")
    while len(found) < entries:
        rows = rest.orderBy("vec_id", "vector").limit(entries).collect()
        for row in rows:
            if len(found) < entries:
                found.setdefault(row["vec_id"], row["vector"])
        if len(rows) < entries:
            break
        rest = kept.filter(F.col("vec_id") > rows[-1]["vec_id"]).select("vec_id", "vector")
    return list(found.values())


def train(
    rows: DataFrame, *, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> Codebooks | None:
    """Codebooks after some rounds of assigning all vectors and moving each entry to the floor of its parts' mean.

    They start as the parts of the vectors of the smallest ids. Each task adds up its rows' parts per entry, so a round shuffles
    and brings to the driver at most entries x components sums. An entry without parts stays. Rows without an id are
    learned from but start no entry. Vectors of fewer components than the longest count as if zeros followed, and
    so does a length that ``parts`` does not divide. None without a vector that has an id.
    """
    spark = rows.sparkSession
    kept = _kept(rows, scale, id_col, vector_col, label_col)
    seeds = _seeds(kept, entries)
    if not seeds:
        return None
    dim = -(-max(1, longest(kept, "vector")) // parts) * parts
    first = integers(pa.array(seeds, pa.list_(pa.float64())), scale, dim)
    book = Codebooks(first.reshape(len(seeds), parts, dim // parts).swapaxes(0, 1).copy(), scale)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(book)
        cells = map_arrow(kept.select("vector"), _sums(shared), "cell long, n long, high long, low long")
        moved = book.entries.reshape(-1).copy()
        for row in cells.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).collect():
            moved[row["cell"]] = ((row["high"] << _LOW) + row["low"]) // row["n"]
        book = Codebooks(moved.reshape(book.entries.shape), scale)
        shared.unpersist()
    return book


def encode(
    rows: DataFrame, book: Codebooks | None, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """vec_id, label, code (two hex digits for each part) and error, the squared distance to the code's entries.

    Vectors that are null, hold null or non-finite components, or any beyond 2**62 after scaling, are left out. Repeated
    rows are coded each; an error that no long holds is null. Without codebooks there are no rows.
    """
    if book is None:
        book, rows = Codebooks(np.zeros((1, 1, 1), np.int64), 1), rows.limit(0)
    kept = _kept(rows, book.scale, id_col, vector_col, label_col)
    kind = kept.schema["label"].dataType.simpleString()
    return map_arrow(kept, _codes(rows.sparkSession.sparkContext.broadcast(book)), f"vec_id long, label {kind}, code string, error long")


def compress(
    rows: DataFrame, *, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of all usable vectors, with codebooks learned from them all.

    ``label_error`` adds up the errors of equal labels, null labels together; it is null if a part of it or the sum fits no long.
    Sums are made per label and salt first and joined back on both, so a label of a third of all rows is many tasks' work.
    """
    names = {"id_col": id_col, "vector_col": vector_col, "label_col": label_col}
    book = train(rows, parts=parts, entries=entries, rounds=rounds, scale=scale, **names)
    found = encode(rows, book, **names).withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)))
    total = F.when(F.count("error") == F.count("*"), F.try_sum("error")).alias("label_error")
    sums = found.groupBy("label").agg(total).withColumnRenamed("label", "own")
    sums = sums.withColumn("own_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    joined = found.join(sums, F.col("label").eqNullSafe(F.col("own")) & (F.col("salt") == F.col("own_salt")), "left")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(book.sha256() if book else None).cast("string").alias("codebooks_sha256"))
