"""Finds benchmark items in documents, also re-parameterised ones, by windows of a typed template.

Numbers, names and units are replaced by typed placeholders. Windows of the template are joined by hash, and for the
windows that meet the values behind the placeholders (slots) must be replaced consistently.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelframe.llm.common import Remembered, col, map_arrow, pick, spare_name, whole_ids, worker_own
from parcelframe.session import stored

WORDS = 5
#: Units and currency marks that become one placeholder.
UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg t lb oz ml cl l gal s sec secs second seconds min mins minute minutes h hr hrs hour hours day "
    "days week weeks month months year years mph kph km/h m/s pct percent % ° °c °f c f k € $ £ ¥ eur usd gbp jpy cent cents euro "
    "euros dollar dollars pound pounds meter meters metre metres kilometer kilometers kilometre kilometres mile miles foot feet "
    "inch inches gram grams kilogram kilograms liter liters litre litres w kw kwh v a hz mb gb tb kb".split()
)
_NUMBER = re.compile(r"[+-]?\d+(?:[.,:/]\d+)*\Z")
_GLUED = re.compile(r"(?<=\d)(?=[^\W\d_]|[%°€$£¥])|(?<=[€$£¥])(?=\d)")
#: Scripts written without blanks: each character counts as a word.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_DIGIT = re.compile(r"\d")
_EDGES = "\"'`.,;:!?()[]{}<>*#&|~_«»“”‘’…-–—"
PLAIN, CAPITAL, NUMBER, UNIT, EMPTY = 0, 1, 2, 3, 4
ENDS, BEFORE, AFTER = 8, 16, 32
_U = np.uint64
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], _U)
BITS = 23
#: Numbers in words; neighbours are one number, as in "twenty five".
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen".split()
)
_TYPED = UNITS | NUMBER_WORDS


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode())


_PLACE = np.array([0, _hash("<name>"), _hash("<number>"), _hash("<unit>")], _U)


def token(word: str) -> tuple[int, int]:
    """(hash of the bare lower-case word, its kind and whether a sentence ends after it or a mark is before or after it)."""
    bare = word.strip(_EDGES)
    said = ENDS if word.rstrip("\"')]}»”’")[-1:] in (".", "!", "?", ":") else 0
    if not bare:
        return _hash(word), said | BEFORE | AFTER | (UNIT if word in UNITS else EMPTY)
    said |= (BEFORE if word[0] != bare[0] else 0) | (AFTER if word[-1] != bare[-1] else 0)
    if _NUMBER.match(bare):
        return _hash(bare.lower()), said | NUMBER
    return _bare(bare, said)


def _bare(word: str, said: int) -> tuple[int, int]:
    low = word.lower()
    if low in NUMBER_WORDS:
        kind = NUMBER
    elif low in UNITS and (low == word or not word[0].isupper()):
        kind = UNIT
    else:
        kind = CAPITAL if word[0].isupper() else PLAIN
    return xxhash.xxh64_intdigest(low.encode()), said | kind


def pieces(word: str) -> list[str]:
    """A word between blanks as its parts: numbers apart from glued units, characters of scripts without blanks each."""
    if word.isascii() and word.isalpha():
        return [word]
    if _DIGIT.search(word):
        word = _GLUED.sub(" ", word)
    if not word.isascii() and _UNSPACED.search(word):
        word = _UNSPACED.sub(r" \g<0> ", word)
    return word.split()


class Words(Remembered):
    """Tokens of the words of many texts at once; words are remembered up to ``room``."""

    def __init__(self, room: int = 300_000):
        super().__init__(room, _U, np.int8)

    def _learn(self, words: list[str]) -> None:
        """Adds the tokens of new words. Most are letters with a mark at the end at most, which need no closer look."""
        raw, said, count, digest = [], [], [], xxhash.xxh64_intdigest
        for word in words:
            mark = word[-1]
            bare = word[:-1] if mark in ".,:;!?" else word
            if bare.isalpha() and (word.isascii() or not _UNSPACED.search(word)):
                low = bare.lower()
                kind = _bare(bare, 0)[1] if low in _TYPED else CAPITAL if bare[0].isupper() else PLAIN
                raw.append(digest(low))
                said.append(kind if bare is word else kind | AFTER if mark in ",;" else kind | AFTER | ENDS)
                count.append(1)
                continue
            parts = [token(part) for part in pieces(word)]
            raw += [x for x, _ in parts]
            said += [x for _, x in parts]
            count.append(len(parts))
        self._add(words, np.array(count), np.array(raw, _U), said)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, raw word hash, kind, whether a mark parts the word from the one before) of all words of the texts.

        Words without letters or digits are left out. A capitalised word is a name unless a sentence begins with it.
        """
        split = [t.split() for t in texts]
        flat = [w for words in split for w in words]
        text = np.repeat(np.arange(len(texts)), [len(words) for words in split])
        if not flat:
            return text, np.empty(0, _U), np.empty(0, np.int8), np.empty(0, bool)
        place, count = self.places(self.numbers(flat, self._learn))
        text = np.repeat(text, count)
        raw, said = (table.rows[place] for table in self.values)
        kind = said & 7
        new = np.r_[True, text[1:] != text[:-1]]
        begins = new | np.r_[True, said[:-1] & ENDS != 0]
        apart = new | (said & BEFORE != 0) | np.r_[True, said[:-1] & AFTER != 0]
        # What ends a sentence may be a mark of its own before the word.
        solid = kind != EMPTY
        text, raw, kind, begins, apart = text[solid], raw[solid], kind[solid], begins[solid], apart[solid]
        return text, raw, np.where((kind == CAPITAL) & begins, PLAIN, kind), apart


def _joined(text: np.ndarray, raw: np.ndarray, kind: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of names and runs of number parts as one slot each; ``apart`` marks words that go on with no run."""
    if not len(kind):
        return text, raw, kind
    goes_on = np.r_[False, (kind[1:] == kind[:-1]) & ((kind[1:] == CAPITAL) | (kind[1:] == NUMBER)) & (text[1:] == text[:-1])] & ~apart
    if not goes_on.any():
        return text, raw, kind
    starts = np.flatnonzero(~goes_on)
    offset = (np.arange(len(raw)) - starts[np.cumsum(~goes_on) - 1]).astype(_U)
    mixed = (raw ^ (offset * _FACTORS[0])) * _FACTORS[1]
    mixed ^= mixed >> _U(29)
    return text[starts], np.add.reduceat(np.where(goes_on, mixed, raw), starts), kind[starts]


def template(text: np.ndarray, raw: np.ndarray, kind: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, window hash) of the template's windows, those that cross two texts included, and (raw hash, kind) of its slots.

    Neighbouring names, and parts of a number, are one slot if no mark parts them: its value is the hash of the run.
    A window with fewer than two plain words says too little without its values, so they enter its hash. A name's value is odd,
    any other even.
    """
    text, raw, kind = _joined(text, raw, kind, apart)
    raw = np.where(kind == CAPITAL, raw | _U(1), raw & ~_U(1))
    window = _rolled(np.where(kind == PLAIN, raw, _PLACE[kind]), WORDS, 0)
    if len(window):
        plain = np.cumsum(np.r_[0, kind == PLAIN])
        window = np.where(plain[WORDS:] - plain[:-WORDS] < 2, _rolled(raw, WORDS, WORDS + 1), window)
    return text, window, raw, kind


def _rolled(code: np.ndarray, size: int, salt: int) -> np.ndarray:
    """A hash for each window of ``size`` codes."""
    n = max(0, len(code) - size + 1)
    window = np.full(n, salt, _U)
    for k in range(size):
        x = code[k : k + n] * _FACTORS[k]
        window = (window ^ (x ^ (x >> _U(29)))) * _U(0xBF58476D1CE4E5B9)
    return window ^ (window >> _U(32))


def _signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


def _windows(id_name: str, bitmap=None, sizes: tuple[int, ...] | None = None):
    """Rows (id, path, hash, at, slots, of): one per window, those that cannot meet left out if a bitmap is given.

    Path 0 is the template: ``slots`` has the raw hash of each slot of the window and 0 for plain words. Path n stands for
    windows of n raw lower-case words, without slots: n is in ``sizes``, or without them WORDS or the words of a shorter text.
    ``of`` counts the text's windows on the path. All texts of a slice are one array of words; windows that cross texts are masked.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_own("template", Words)
        bits = bitmap.value if bitmap is not None else None
        for big in batches:
            for k in range(0, big.num_rows, 256):
                batch = big.slice(k, 256)
                text, raw, kind, apart = words(batch["text"].to_pylist())
                length = np.bincount(text, minlength=batch.num_rows)
                paths = []
                own, window, values, kinds = template(text, raw, kind, apart)
                paths.append((0, WORDS, own, window, np.where(kinds == PLAIN, _U(0), values), np.ones(batch.num_rows, bool)))
                for n in sizes if sizes is not None else range(1, WORDS + 1):
                    used = np.ones(batch.num_rows, bool) if sizes is not None else np.minimum(length, WORDS) == n
                    if used.any():
                        paths.append((n, n, text, _rolled(raw, n, n), None, used))
                for path, n, own, window, slots, used in paths:
                    good = used[own[: len(window)]] & (own[: len(window)] == own[n - 1 :][: len(window)])
                    if bits is not None:
                        good &= (bits[(window >> _U(64 - BITS + 3)).astype(np.int64)] >> ((window >> _U(64 - BITS)) & _U(7)).astype(np.uint8)) & 1 == 1
                    at = np.flatnonzero(good)
                    if not len(at):
                        continue
                    first = np.searchsorted(own, np.arange(batch.num_rows))
                    count = np.maximum(np.bincount(own, minlength=batch.num_rows) - n + 1, 0)
                    met = slots[at[:, None] + np.arange(WORDS)] if slots is not None else np.zeros((len(at), WORDS), _U)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch["id"].take(pa.array(own[at])),
                            pa.array(np.full(len(at), path, np.int32)),
                            pa.array(_signed(window[at])),
                            pa.array((at - first[own[at]]).astype(np.int32)),
                            pa.ListArray.from_arrays(pa.array(np.arange(0, WORDS * len(at) + 1, WORDS, dtype=np.int32)), pa.array(_signed(met).reshape(-1))),
                            pa.array(count[own[at]].astype(np.int32)),
                        ],
                        names=[id_name, "path", "hash", "at", "slots", "of"],
                    )

    return run


def windows(texts: DataFrame, id_name: str, bitmap=None, sizes: tuple[int, ...] | None = None) -> DataFrame:
    rows = texts.filter("id is not null and text is not null")
    return map_arrow(rows, _windows(id_name, bitmap, sizes), f"{id_name} long, path int, hash long, at int, slots array<long>, of int")


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, *, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, matched, windows, share, consistency, kind) of the items found in documents.

    An item is found if ``least`` or more of its template windows occur together in the document and, for the windows
    that meet there, ``least`` or more of its slot values are replaced by one value each. ``kind`` is "exact" if all
    matched slots keep their values (or there are none), else "changed"; of several copies the most alike counts.
    Beside the template, windows of five raw words are compared without regard to case, so copies in other capitals and
    items in capitals are found too; an item of fewer words is found as a whole. In scripts without blanks each
    character is a word, and numbers may be written in words. Only items without any letter, digit or unit are never found. Null ids
    and texts take no part, empty texts have no windows, and very long ones are read whole. Repeated rows
    of a document count as one document of that id, and likewise for items. Ids must be whole numbers. Without documents or items there
    are no rows; names of other columns do not matter.
    """
    spark = docs.sparkSession
    whole_ids(docs, id_col)
    whole_ids(benchmark, item_col)
    items = pick(benchmark, id=item_col, text=item_text_col).withColumn("id", F.col("id").cast("long"))
    known = stored(windows(items, "item_id"), "item-windows")
    # A bit for each window hash of the benchmark: 1 MB whatever its size. It only spares the join most windows.
    byte = F.shiftrightunsigned("hash", 64 - BITS + 3)
    bit = f"shiftleft(1, cast(shiftrightunsigned(hash, {64 - BITS}) & 7L as int))"
    bits = np.zeros(1 << (BITS - 3), np.uint8)
    for row in known.groupBy(byte.alias("byte")).agg(F.bit_or(F.expr(bit)).alias("bits")).toLocalIterator():
        bits[row["byte"]] = row["bits"]
    bitmap = spark.sparkContext.broadcast(bits)
    texts = pick(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    sizes = tuple(sorted(r["path"] for r in known.filter("path > 0").select("path").distinct().collect()))
    seen = windows(texts, "doc_id", bitmap, sizes)
    own = known.select("item_id", "path", "hash", F.col("at").alias("item_at"), F.col("slots").alias("item_slots"), F.col("of").alias("windows"))
    met = stored(seen.select("doc_id", "hash", "at", "slots").join(own, "hash").drop("hash"), "met-windows")
    counted = met.groupBy("doc_id", "item_id", "path").agg(F.count_distinct("item_at").alias("n"), F.max("windows").alias("of"))
    near = counted.filter(F.col("n") >= F.lit(least) * F.col("of")).select("doc_id", "item_id", "path")
    found = _aligned(met.join(near, ["doc_id", "item_id", "path"], "left_semi"))
    found = found.filter((F.col("share") >= least) & (F.col("consistency") >= least))
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("kept", "consistency", "share", "matched", "windows")).alias("best"))
    kind = F.when(F.col("best.kept"), "exact").otherwise("changed").alias("kind")
    return best.select("doc_id", "item_id", "best.matched", "best.windows", "best.share", "best.consistency", kind)


def _aligned(met: DataFrame) -> DataFrame:
    """Each place where most of an item may stand in a document, with what its slots say.

    Windows that meet are told apart by their diagonal, the place in the document less that in the item. Stretches of
    about the item's length, in two grids half a stretch apart, hold the diagonals of every copy, which differ by less
    than half a stretch, and not those of two copies. In a stretch the diagonal with most windows leads; those near
    it belong to the copy, one for each place of the item.
    """
    place = ["doc_id", "item_id", "path", "grid", "stretch"]
    long = F.greatest(F.lit(8), F.col("windows"))
    rows = met.withColumn("diagonal", F.col("at") - F.col("item_at")).withColumn("grid", F.explode(F.array(F.lit(0), F.lit(1))))
    rows = rows.withColumn("stretch", F.floor((F.col("diagonal") + F.col("grid") * long / 2) / long))
    on = rows.groupBy(*place, "diagonal").agg(F.count_distinct("item_at").alias("n"))
    leads = on.groupBy(*place).agg(F.max_by("diagonal", F.struct("n", -F.col("diagonal"))).alias("lead"))
    off = F.abs(F.col("diagonal") - F.col("lead"))
    rows = rows.join(leads, place).filter(off <= long / 4)
    one = rows.groupBy(*place, "item_at").agg(
        F.min_by(F.struct("item_slots", "slots"), F.struct(off, "diagonal")).alias("slot"), F.max("windows").alias("windows")
    )
    copies = one.groupBy(*place).agg(F.count("*").alias("matched"), F.max("windows").alias("windows"))
    pairs = one.select(*place, F.explode(F.arrays_zip(F.col("slot.item_slots").alias("mine"), F.col("slot.slots").alias("theirs"))).alias("s"))
    values = pairs.select(*place, F.col("s.mine").alias("mine"), F.col("s.theirs").alias("theirs")).filter("mine <> 0").groupBy(*place, "mine")
    values = values.agg(
        (F.min("theirs") == F.max("theirs")).alias("one"), F.bool_and(F.col("theirs") == F.col("mine")).alias("same"), F.min("theirs").alias("other")
    )
    # Two persons do not become one, while two numbers may: names (odd) have a partner each.
    name = (F.col("mine") % 2 != 0) & (F.col("other") % 2 != 0)
    apart = F.count_distinct(F.when(name, F.col("other"))) / F.count(F.when(name, F.col("mine")))
    values = values.groupBy(*place).agg(
        F.least(F.avg(F.col("one").cast("double")), F.when(F.count(F.when(name, F.col("mine"))) > 0, apart).otherwise(1.0)).alias("consistency"),
        F.bool_and("same").alias("kept"),
    )
    told = copies.join(values, place, "left")
    share = F.col("matched") / F.col("windows")
    # Raw windows that meet say nothing of the values in those that do not.
    kept = F.coalesce("kept", F.lit(True)) & ((F.col("path") == 0) | (share == 1))
    return told.select("doc_id", "item_id", "matched", "windows", share.alias("share"), F.coalesce("consistency", F.lit(1.0)).alias("consistency"), kept.alias("kept"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, of the documents in which no benchmark item is found.

    Rows without an id stay, whatever their text; repeated rows of an id stay or go together, as do all texts of one id. Null, empty
    and very long texts are as in ``find_leaks``; an empty table stays empty, and names of other columns do not matter.
    """
    name = spare_name(docs, "leak")
    found = find_leaks(docs, benchmark, least=least, id_col=id_col, text_col=text_col).select(F.col("doc_id").alias(name)).distinct()
    # By sorting at every size: broadcasting few ids and shuffling texts for many is a plan that is hard to foresee.
    return docs.join(stored(found, "leaks").hint("merge"), col(id_col).cast("long") == F.col(name), "left_anti")
