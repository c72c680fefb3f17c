"""Chat transcripts that a deterministic parser reads back to exactly the turns they were made of."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelframe.llm.common import map_arrow, pick

#: The marks of the template. A turn is: <s>[INST]role[/INST]text</s>
OPEN, CLOSE, HEAD, BODY, ESCAPE = "<s>", "</s>", "[INST]", "[/INST]", "\\"
_MARKS = re.compile(r"</?s>|\[/?INST\]")
_CONFLICTS = re.compile(r"\\|</?s>|\[/?INST\]")
_TOKENS = re.compile(r"\\(\\|</?s>|\[/?INST\])|(</?s>|\[/?INST\])")


class ParseError(ValueError):
    """The text does not follow the grammar."""


def escape(text: str) -> str:
    """Puts the escape sign before every mark and every escape sign."""
    return _CONFLICTS.sub(lambda m: ESCAPE + m[0], text)


class Parser:
    """Reads transcripts turn by turn: transcript := turn*, turn := <s> [INST] role [/INST] text </s>.

    An escape sign before a mark or another escape sign makes that one plain text; any other is itself plain text.
    """

    _NEXT = {OPEN: (0, 1), HEAD: (1, 2), BODY: (2, 3), CLOSE: (3, 0)}

    def turns(self, transcript: str) -> Iterator[tuple[str, str]]:
        state, at, parts, role = 0, 0, [], ""
        for m in _TOKENS.finditer(transcript):
            plain = transcript[at : m.start()]
            at = m.end()
            if state in (2, 3):
                parts.append(plain)
            elif plain:
                raise ParseError(f"text outside of a turn at {m.start()}")
            if m[1] is not None:
                if state not in (2, 3):
                    raise ParseError(f"escaped text outside of a turn at {m.start()}")
                parts.append(m[1])
                continue
            wanted, state_after = self._NEXT[m[2]]
            if state != wanted:
                raise ParseError(f"{m[2]} is out of place at {m.start()}")
            if state == 2:
                role, parts = "".join(parts), []
            elif state == 3:
                yield role, "".join(parts)
                parts = []
            state = state_after
        if state or at != len(transcript):
            raise ParseError("the transcript ends within a turn")


PARSER = Parser()


def render(role: str, text: str) -> tuple[str, int]:
    """A turn's part of the transcript, and how much had to be escaped: 0 nothing, 1 the text, 2 the role as well.

    The turn is rendered, parsed again and compared with its source; what conflicts is escaped until both agree.
    """
    for level, (r, t) in enumerate(((role, text), (role, escape(text)), (escape(role), escape(text)))):
        made = f"{OPEN}{HEAD}{r}{BODY}{t}{CLOSE}"
        # A plain text cannot conflict without a mark or an escape sign in it.
        if level == 0 and ESCAPE not in made and len(_MARKS.findall(made)) == 4:
            return made, level
        try:
            if list(PARSER.turns(made)) == [(role, text)]:
                return made, level
        except ParseError:
            pass
    raise AssertionError("the escaped form is read back for any text")


def format_turns(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, formatted, level, loss_from, loss_to): each turn's part of its transcript.

    A transcript is its turns' parts in order (turn, then role, then text for equal turns; null turns first) with
    nothing between. Code points loss_from to loss_to of an assistant's part are under the loss mask: its text as
    escaped; other parts have both 0. Null roles and texts are empty; rows keep their null conversation and turn;
    repeated rows are turns of their own. No conversation is gathered: each row is formatted by itself.
    """
    rows = pick(turns, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    rows = rows.withColumns({"role": F.coalesce("role", F.lit("")), "text": F.coalesce("text", F.lit(""))})
    names = ["conv_id", "turn", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for k in range(0, big.num_rows, 1024):
                batch = big.slice(k, 1024)
                made, level, start, stop = [], [], [], []
                for role, text in zip(batch["role"].to_pylist(), batch["text"].to_pylist(), strict=True):
                    part, how = render(role, text)
                    made.append(part)
                    level.append(how)
                    shown = len(escape(role)) if how == 2 else len(role)
                    at = len(OPEN) + len(HEAD) + shown + len(BODY)
                    under = role == "assistant"
                    start.append(at if under else 0)
                    stop.append(len(part) - len(CLOSE) if under else 0)
                columns = [*[batch[n] for n in names], pa.array(made, pa.string()), pa.array(level, pa.int32()), pa.array(start, pa.int64()), pa.array(stop, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "formatted", "level", "loss_from", "loss_to"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"{n} {kinds[n]}" for n in names) + ", formatted string, level int, loss_from long, loss_to long"
    return map_arrow(rows, run, schema)


class _Digest:
    """What is read back of one conversation; texts are added and forgotten."""

    def __init__(self):
        self.turns, self.loss, self.n, self.loss_chars, self.chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

    def add(self, part: str, start: int, stop: int) -> None:
        self.chars += len(part)
        for role, text in PARSER.turns(part):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        if stop > start:
            masked = _TOKENS.sub(lambda m: m[1], part[start:stop])
            self.loss_chars += len(masked)
            self.loss.update(masked.encode())

    def row(self, conv) -> tuple:
        return conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, from the formatted parts alone.

    The parts are ordered by conversation and turn within each partition and pass one by one, so a conversation of
    any length is read with the memory of one part. A digest needs its turns in order, hence in one task.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def batch_of(rows: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
        kinds = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, done, conv_type = None, None, [], pa.int64()
        for big in batches:
            conv_type = big.schema.field("conv_id").type
            for k in range(0, big.num_rows, 1024):
                batch = big.slice(k, 1024)
                for conv, part, start, stop in zip(*(batch[n].to_pylist() for n in ("conv_id", "formatted", "loss_from", "loss_to")), strict=True):
                    if digest is None or conv != now:
                        if digest is not None:
                            done.append(digest.row(now))
                        now, digest = conv, _Digest()
                    digest.add(part, start, stop)
                if len(done) >= 1024:
                    yield batch_of(done, conv_type)
                    done = []
        if digest is not None:
            done.append(digest.row(now))
        yield batch_of(done, conv_type)

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return map_arrow(ordered.select("conv_id", "formatted", "loss_from", "loss_to"), run, schema)
