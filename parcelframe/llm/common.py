"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelframe.session import package_on_workers


def col(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def pick(df: DataFrame, **names: str) -> DataFrame:
    """The named input columns under the names the operators use; every other column is left out."""
    return df.select(*[col(source).alias(target) for target, source in names.items()])


def spare_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its letters' case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def whole_ids(df: DataFrame, name: str) -> None:
    """Raises a TypeError unless the ids are whole numbers, which the operators compare as longs."""
    kind = df.select(col(name)).schema[0].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"column {name} must hold whole numbers, not {kind.simpleString()}")


def held_out(key: Column) -> Column:
    """True where crc32 of the key's text is 2 modulo 4; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def bounded_sample(df: DataFrame, key: Column, limit: int) -> DataFrame:
    """All rows, or about ``limit`` of them chosen by the key's hash when there are more.

    The choice depends on the key alone, so a recomputed partition chooses the same rows.
    """
    total = df.count()
    if total <= limit:
        return df
    return df.filter(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < F.lit(int((1 << 30) * limit / total)))


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    package_on_workers()
    return df.mapInArrow(fn, schema)


def texts_udf(fn: Callable[[list[str | None]], tuple], result: str, step: int = 512):
    """A column function that calls ``fn`` for some texts of an Arrow batch at a time; it gives a list for each field.

    It is marked as not deterministic only so that a filter on its result is not evaluated a second time.
    """
    package_on_workers()
    kind = _struct(result)

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            parts = [fn(batch.slice(k, step).to_pylist()) for k in range(0, len(batch), step)]
            columns = [pa.array([x for part in parts for x in part[i]], field.type) for i, field in enumerate(kind)]
            yield pa.StructArray.from_arrays(columns, fields=list(kind))

    run.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, result).asNondeterministic()


def text_udf(fn: Callable[[str | None], tuple], result: str):
    """A column function that calls ``fn`` for each text, Arrow batch by Arrow batch."""
    fields = len(_struct(result))

    def run(texts: list[str | None]) -> tuple:
        found = [fn(x) for x in texts]
        return tuple([row[i] for row in found] for i in range(fields))

    return texts_udf(run, result)


_ARROW = {"string": pa.string(), "double": pa.float64(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}


def _struct(ddl: str) -> pa.StructType:
    return pa.struct([pa.field(name, _ARROW[kind]) for name, kind in (part.split() for part in ddl.split(","))])


_OWN: dict[str, object] = {}


def worker_own(key: str, make: Callable[[], object]):
    """What a Python worker makes once for the tasks of one operator call; the next call's takes its place.

    So a worker that lives through many calls holds the tables of one of them only.
    """
    if key not in _OWN:
        _OWN.clear()
        pa.default_memory_pool().release_unused()
        _OWN[key] = make()
    return _OWN[key]


class Memo(dict):
    """A dictionary that computes what it lacks and forgets everything once it is full.

    ``fn`` must be a pure function, so forgetting changes the time only.
    """

    def __init__(self, fn: Callable, room: int):
        super().__init__()
        self.fn, self.room = fn, room

    def __missing__(self, key):
        if len(self) >= self.room:
            self.clear()
        value = self[key] = self.fn(key)
        return value


class Grown:
    """A table to which rows are added at its end; room doubles, so adding costs no copy of what is there each time."""

    def __init__(self, kind, width: tuple = ()):
        self.rows, self.n = np.empty((1024, *width), kind), 0

    def add(self, rows) -> None:
        rows = np.asarray(rows, self.rows.dtype).reshape(-1, *self.rows.shape[1:])
        while self.n + len(rows) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
        self.rows[self.n : self.n + len(rows)] = rows
        self.n += len(rows)


class Remembered:
    """Values of words, those of a word one after another, for about ``room`` words at most.

    Most words of a corpus are met once. When there is no more room, those that were met again stay, in half of the room at
    most, and the others go; what is forgotten is learned again, so this changes the time only.
    """

    def __init__(self, room: int, *kinds):
        self.room, self.kinds = room, kinds
        self._empty()

    def _empty(self) -> None:
        self.words: dict[str, int] = {}
        self.values = [Grown(kind) for kind in self.kinds]
        self.stops, self.again = Grown(np.int64), Grown(bool)
        self.stops.add([0])

    def _add(self, words: list[str], sizes: np.ndarray, *values) -> None:
        self.stops.add(self.stops.rows[self.stops.n - 1] + np.cumsum(sizes))
        for table, rows in zip(self.values, values, strict=True):
            table.add(rows)
        self.again.add(np.zeros(len(words), bool))
        self.words.update(zip(words, range(len(self.words), len(self.words) + len(words)), strict=True))

    def _forget(self) -> None:
        kept = np.flatnonzero(self.again.rows[: len(self.words)])[: self.room // 2]
        place, sizes = self.places(kept)
        words, values = list(self.words), [table.rows[place] for table in self.values]
        words = [words[i] for i in kept.tolist()]
        self._empty()
        self._add(words, sizes, *values)

    def places(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the values of words lie, and how many each has."""
        starts = self.stops.rows[numbers]
        sizes = self.stops.rows[numbers + 1] - starts
        ends = np.cumsum(sizes)
        return np.repeat(starts - ends + sizes, sizes) + np.arange(sizes.sum()), sizes

    def numbers(self, words: list[str], learn: Callable[[list[str]], None]) -> np.ndarray:
        """The number of each word, which holds until the next call; ``learn`` adds those that are not known."""
        found = np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, len(words))
        unknown = found < 0
        self.again.rows[found[~unknown]] = True
        if unknown.any():
            fresh = set(words).difference(self.words)
            if len(self.words) + len(fresh) > self.room:
                self._forget()
                fresh = set(words).difference(self.words)
            learn(list(fresh))
            found = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        return found
