"""Document fingerprints as invertible Bloom lookup sketches; DataFrame functions only.

A text's paragraphs are hashed to digests. A sketch has three tables of cells; each digest is added to one cell of each
table: its sign to the cell's count, itself and a check to the cell's two xor sums. Sketches subtract cell by cell, equal
digests cancel, and peeling takes single digests out of cells until the difference is empty. What cannot be peeled is
tried again with a larger sketch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelframe.llm.common import pick
from parcelframe.session import stored

TABLES = 3
#: Cells per table of the stored fingerprint.
WIDTH = 4
#: Paragraphs end at line ends and, so that a long line has several, at white space after a mark other than a comma.
PARAGRAPH_ENDS = r"(?<=[\p{Punct}&&[^,]])\s+|\n"


def digests(text: Column) -> Column:
    """The distinct digests of a text's paragraphs; an empty array for an empty text."""
    parts = F.filter(F.split(text, PARAGRAPH_ENDS), lambda x: x != "")
    return F.array_distinct(F.transform(parts, lambda x: F.xxhash64(x)))


def _check(key: Column) -> Column:
    return F.hash(key, F.lit("check")).cast("long").bitwiseAND(F.lit(0xFFFFFFFF))


def _cell(key: Column, table: int, width: Column, attempt: int) -> Column:
    return (F.lit(table) * width + F.pmod(F.xxhash64(key, F.lit(table), F.lit(attempt)), width)).cast("int")


def _xor(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))


def sketch(keys: Column) -> Column:
    """The small sketch as an array of (n, key, check), table by table; adding is the same in any order."""

    def one(table: int, place: int) -> Column:
        own = F.filter(keys, lambda x: F.pmod(F.xxhash64(x, F.lit(table), F.lit(0)), F.lit(WIDTH)) == place)
        return F.struct(F.size(own).cast("long").alias("n"), _xor(own).alias("key"), _xor(F.transform(own, _check)).alias("check"))

    return F.array(*[one(t, i) for t in range(TABLES) for i in range(WIDTH)])


def fingerprint(cells: Column) -> Column:
    """The sketch as text: count, xor of digests and xor of checks of each cell."""
    return F.array_join(F.transform(cells, lambda c: F.concat_ws(":", c["n"].cast("string"), F.hex(c["key"]), F.hex(c["check"]))), "/")


def _difference(pairs: DataFrame) -> DataFrame:
    """Cells of sketch a less sketch b, those that are empty left out; attempt 0."""
    cells = F.zip_with("a", "b", lambda x, y: F.struct((x["n"] - y["n"]).alias("n"), x["key"].bitwiseXOR(y["key"]).alias("key"), x["check"].bitwiseXOR(y["check"]).alias("check")))
    rows = pairs.select("pair", F.lit(WIDTH).cast("long").alias("width"), F.posexplode(cells).alias("cell", "c"))
    return rows.select("pair", "width", "cell", "c.n", "c.key", "c.check").filter("n <> 0 or key <> 0 or check <> 0")


def _sum(cells: DataFrame) -> DataFrame:
    """Adds up the rows of a cell. The rows of a pair lie in one partition already, so this moves nothing."""
    added = cells.groupBy("pair", "width", "cell").agg(F.sum("n").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("check").alias("check"))
    return added.filter("n <> 0 or key <> 0 or check <> 0")


def _larger(pairs: DataFrame, attempt: int) -> DataFrame:
    """Cells of the difference of larger sketches, made again from the digests: room for all of them to differ."""
    signed = F.concat(F.transform("a", lambda x: F.struct(x.alias("key"), F.lit(1).cast("long").alias("n"))), F.transform("b", lambda x: F.struct(x.alias("key"), F.lit(-1).cast("long").alias("n"))))
    room = (F.size("a") + F.size("b")) * F.lit(0.5 * 1.3 ** (attempt - 1)) + 3
    rows = pairs.select("pair", room.cast("long").alias("width"), F.explode(signed).alias("s")).select("pair", "width", "s.key", "s.n")
    each = F.explode(F.array(*[_cell(F.col("key"), t, F.col("width"), attempt) for t in range(TABLES)])).alias("cell")
    return _sum(rows.select("pair", "width", each, "n", "key", _check(F.col("key")).alias("check")))


#: Cells below 0 count what was peeled: -1 digests of the first text, -2 of the second. Their key and check are 1.
def _peel(cells: DataFrame, table: int, attempt: int) -> DataFrame:
    """Takes out every digest that is alone in a cell of one table.

    A digest has one cell in each table, so none is taken out twice at a time.
    """
    at, n, key, width = F.col("cell"), F.col("n"), F.col("key"), F.col("width")
    single = (at >= table * width) & (at < (table + 1) * width) & (F.abs(n) == 1) & (F.col("check") == _check(key))
    single = single & (at == _cell(key, table, width, attempt))
    row = lambda cell, n, key, check: F.struct(cell.cast("int").alias("cell"), n.cast("long").alias("n"), key.cast("long").alias("key"), check.cast("long").alias("check"))
    taken = [row(_cell(key, t, width, attempt), -n, key, F.col("check")) for t in range(TABLES) if t != table]
    taken.append(row(F.when(n > 0, -1).otherwise(-2), F.lit(1), F.lit(0), F.lit(0)))
    rows = F.when(single, F.array(*taken)).otherwise(F.array(row(at, n, key, F.col("check"))))
    return _sum(cells.select("pair", "width", F.explode(rows).alias("r")).select("pair", "width", "r.*"))


def _peeled(cells: DataFrame, attempt: int, sweeps: int) -> DataFrame:
    """(pair, only_a, only_b, left): the digests recovered of each side and the cells that could not be emptied."""
    for _ in range(sweeps):
        cells = reduce(lambda c, t: _peel(c, t, attempt), range(TABLES), cells)
    count = lambda cell: F.coalesce(F.sum(F.when(F.col("cell") == cell, F.col("n"))), F.lit(0))
    return cells.groupBy("pair").agg(count(-1).alias("only_a"), count(-2).alias("only_b"), F.sum((F.col("cell") >= 0).cast("int")).alias("left"))


def recovered(pairs: DataFrame, *, small: str = "sketches", sweeps: int = 3, most: int = 12) -> DataFrame:
    """(pair, only_a, only_b): how many paragraph digests each text of a pair has that the other has not.

    ``pairs`` has pair (a unique number), a_keys and b_keys (digests), a and b (small sketches). First the small
    sketches are subtracted and peeled. For pairs with cells left the sketches are made again, with room for all
    their digests and other hash functions, and larger each time. Only failed pairs and only their digests are read
    again; a pair's rows stay in one partition from its digests to its counts.
    """
    pairs = pairs.repartition("pair")
    done = stored(_peeled(_difference(pairs.select("pair", "a", "b")), 0, 2), f"peeled-{small}")
    found = [done.filter("left = 0")]
    failed = done.filter("left > 0").select("pair")
    open_pairs = pairs.select("pair", F.col("a_keys").alias("a"), F.col("b_keys").alias("b"))
    for attempt in range(1, most + 1):
        if failed.isEmpty():
            break
        again = open_pairs.join(failed, "pair", "left_semi").repartition("pair")
        done = stored(_peeled(_larger(again, attempt), attempt, sweeps + attempt), f"peeled-{small}")
        found.append(done.filter("left = 0"))
        failed = done.filter("left > 0").select("pair")
    else:
        raise RuntimeError(f"sketches could not be peeled after {most} attempts")
    return reduce(DataFrame.unionByName, found).select("pair", "only_a", "only_b")


def _likeness(a: Column, b: Column, only_a: Column, only_b: Column) -> Column:
    """Common over all digests; 1 for two texts without any. Common and all follow from sizes and differences."""
    common = (a + b - only_a - only_b) / 2
    every = common + only_a + only_b
    return F.when(every == 0, 1.0).otherwise(common / every)


KEY = ["nil", "id", "seal"]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = pick(docs, doc_id=id_col, text=text_col)
    text = F.coalesce("text", F.lit(""))
    return rows.select(F.col("doc_id").isNotNull().alias("nil"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("id"), F.xxhash64(text).alias("seal"), text.alias("text"))


def _following(rows: DataFrame) -> DataFrame:
    """(nil, id, seal, n, copies, pos, next_*): the documents in order, each with the one after it.

    Short rows are dealt out by ranges; a range's last document takes the first one of the next range, and the last
    of all takes the first of all.
    """
    order = rows.groupBy(*KEY).agg(F.max(F.char_length("text")).alias("n"), F.count("*").alias("copies"))
    # Stored first, as the ranges are found by a pass of their own.
    order = stored(stored(order, "order").repartitionByRange(*KEY).withColumn("part", F.spark_partition_id()), "order")
    within = Window.partitionBy("part").orderBy(*KEY)
    pos = F.shiftleft(F.col("part").cast("long"), 40) + F.row_number().over(within)
    order = order.withColumn("pos", pos)
    firsts = order.groupBy("part").agg(F.min(F.struct(*KEY, "pos")).alias("first"))
    # One row per range: their number is that of the partitions, not of the documents.
    parts = Window.orderBy("part")
    firsts = firsts.select("part", F.coalesce(F.lead("first").over(parts), F.first("first").over(parts)).alias("after"))
    within_next = F.lead(F.struct(*KEY, "pos")).over(within)
    linked = order.withColumn("own_next", within_next).join(firsts, "part")
    follower = F.coalesce("own_next", "after")
    return stored(linked.select(*KEY, "n", "copies", "pos", follower.alias("follower")), "order")


def edited_texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, text, edited, pos, next_pos, copies: the last quarter replaced by the next text's beginning.

    Documents are ordered by id, then by text hash; null ids come first, null texts are empty. Rows that agree in id
    and text are one document with ``copies`` rows. The next of the last is the first, of a single one itself.
    """
    rows = _keyed(docs, id_col, text_col)
    order = _following(rows)
    if not order.filter("copies > 1").isEmpty():
        rows = rows.dropDuplicates(KEY)
    cut = F.floor(F.col("n") / 4).cast("int")
    own = order.select(*KEY, "n", "copies", "pos", F.col("follower.pos").alias("next_pos"))
    # What each document lends to the one before it.
    lends = order.select(*[F.col(f"follower.{k}").alias(k) for k in KEY], *[F.col(k).alias(f"to_{k}") for k in KEY], cut.alias("wanted"))
    lent = rows.join(lends, KEY).select(*[F.col(f"to_{k}").alias(k) for k in KEY], F.substring(F.col("text"), F.lit(1), F.col("wanted")).alias("lent"))
    joined = rows.join(own, KEY).join(lent, KEY)
    kept = F.substring(F.col("text"), F.lit(1), F.col("n") - cut)
    # Both joins read the same columns of the texts, so that these are shuffled once.
    return joined.select(F.when(F.col("nil"), F.col("id")).alias("doc_id"), F.col("n").cast("long").alias("n_chars"), "text", F.concat(kept, F.col("lent")).alias("edited"), "pos", "next_pos", "copies")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every whole text.

    A likeness is the share of distinct paragraph digests that both texts have, worked out from the digests that
    peeling recovers. Texts without paragraphs are like each other (1) and unlike all others (0). Order, null and
    repeated rows are as in ``edited_texts``; every row is answered.
    """
    texts = edited_texts(docs, id_col=id_col, text_col=text_col)
    made = texts.select("doc_id", "n_chars", "pos", "next_pos", "copies", F.sha2("edited", 256).alias("edited_sha256"), digests(F.col("text")).alias("keys"), digests(F.col("edited")).alias("edited_keys"))
    made = cells = stored(made.withColumns({"cells": sketch(F.col("keys")), "edited_cells": sketch(F.col("edited_keys"))}), "sketches")
    edited = cells.select(F.col("pos").alias("pair"), F.col("keys").alias("a_keys"), F.col("edited_keys").alias("b_keys"), F.col("cells").alias("a"), F.col("edited_cells").alias("b"))
    after = cells.select(F.col("pos").alias("next_pos"), F.col("keys").alias("b_keys"), F.col("cells").alias("b"))
    follow = cells.select(F.col("pos").alias("pair"), "next_pos", F.col("keys").alias("a_keys"), F.col("cells").alias("a")).join(after, "next_pos")
    follow = follow.select("pair", "a_keys", "b_keys", "a", "b")
    sizes = after.select("next_pos", F.size("b_keys").alias("next_size"))
    shown = cells.select("pos", fingerprint(F.col("cells")).alias("fingerprint"), fingerprint(F.col("edited_cells")).alias("edited_fingerprint"))
    found = made.select("doc_id", "n_chars", "edited_sha256", "pos", "next_pos", "copies", F.size("keys").alias("size"), F.size("edited_keys").alias("edited_size"))
    found = found.join(shown, "pos").join(sizes, "next_pos")
    for name, pairs, other in (("near_edited", edited, "edited_size"), ("near_next", follow, "next_size")):
        # A pair without any cell left after subtracting has no row here: its texts have the same digests.
        result = recovered(pairs, small=name.replace("_", "-")).withColumnRenamed("pair", "pos")
        found = found.join(result, "pos", "left").fillna(0, ["only_a", "only_b"])
        found = found.withColumn(name, _likeness(F.col("size"), F.col(other), F.col("only_a"), F.col("only_b"))).drop("only_a", "only_b")
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return found.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
