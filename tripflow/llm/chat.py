"""Chat formatting: a finite-state machine over roles and a declarative template.

``format_conversations`` turns rows (conv_id, turn, role, text) into text
segments with a loss flag each. Turns of a conversation are sorted by Spark
within the partition that holds the conversation and then streamed, so memory
is bounded by one turn and never by a conversation.

Defined results: a null text is empty, a null role is the empty role; turns are
ordered by turn (null first), ties by role, then text; repeated rows are
repeated turns; rows without conv_id form one conversation with a null id, in one
task whose sort spills and which holds one turn at a time; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    """Marks around a turn's text, and whether the text is learned from."""

    begin: str
    end: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks by role; ``other`` serves every role without marks of its own and
    writes the role between ``begin`` and ``named``. No mark may be a prefix of
    another begin mark or overlap itself."""

    turns: dict[str, Turn]
    other: Turn = Turn("[TURN]", "[/TURN]")
    named: str = "[ROLE]"
    escape: str = "\\"

    def marks(self) -> list[str]:
        found = [self.other.begin, self.other.end, self.named]
        for turn in self.turns.values():
            found += [turn.begin, turn.end]
        return sorted({mark.strip() for mark in found})


INSTRUCT = Template(
    {
        "system": Turn("<<SYS>>\n", "\n<</SYS>>\n"),
        "user": Turn("[INST] ", " [/INST]"),
        "assistant": Turn("<s> ", " </s>\n", loss=True),
    }
)

#: Next state by (state, role); a pair that is not listed is a violation.
ORDER = {
    ("start", "system"): "system",
    ("start", "user"): "user",
    ("system", "user"): "user",
    ("user", "assistant"): "assistant",
    ("assistant", "user"): "user",
}
ACCEPTED = ("assistant",)
VIOLATION = "violation"

SEGMENTS = "conv_id long, turn_no long, segment int, text string, loss boolean, state string"
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, valid boolean"
)


def _arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[k]) for n, k in (part.split() for part in ddl.split(", "))])


def escaper(template: Template):
    """Text with every mark and escape character preceded by the escape character."""
    special = re.compile("|".join(map(re.escape, [template.escape, *template.marks()])))
    return lambda text: special.sub(lambda found: template.escape + found[0], text)


def unescaper(template: Template):
    escaped = re.compile(re.escape(template.escape) + "(.)", re.DOTALL)
    return lambda text: escaped.sub(lambda found: found[1], text)


def turn_reader(template: Template):
    """Reads the first turn of a formatted text: (role, text, characters read), or None
    if its end is yet to come. Only the marks tell where a turn ends."""
    unescape = unescaper(template)
    escaped = re.escape(template.escape) + "."

    def until(text: str, start: int, mark: str) -> int:
        for found in re.compile(f"{escaped}|{re.escape(mark)}", re.DOTALL).finditer(text, start):
            if found[0] == mark:
                return found.start()
        return -1

    def read(text: str) -> tuple[str, str, int] | None:
        for role, turn in template.turns.items():
            if text.startswith(turn.begin):
                start = len(turn.begin)
                end = until(text, start, turn.end)
                return None if end < 0 else (role, unescape(text[start:end]), end + len(turn.end))
        if not text.startswith(template.other.begin):
            return None
        start = len(template.other.begin)
        middle = until(text, start, template.named)
        after = middle + len(template.named)
        end = until(text, after, template.other.end) if middle >= 0 else -1
        if end < 0:
            return None
        return unescape(text[start:middle]), unescape(text[after:end]), end + len(template.other.end)

    return read


def _ordered(conversations: DataFrame) -> DataFrame:
    """Whole conversations in one partition each, turns in order. The sort spills."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_conversations(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Segments in order: per turn the begin mark (0), the escaped text (1), the end mark (2).

    ``loss`` is true on the texts to learn from, never on marks. ``state`` is the
    machine's state after the turn; once ``violation``, it stays so.
    """

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escape, schema = escaper(template), _arrow_schema(SEGMENTS)
        current, number, state = object(), 0, "start"
        for batch in batches:
            out = []
            for conv, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                if conv != current:
                    current, number, state = conv, 0, "start"
                state = ORDER.get((state, role), VIOLATION)
                turn = template.turns.get(role)
                begin = turn.begin if turn else template.other.begin + escape(role) + template.named
                end = (turn or template.other).end
                loss = turn.loss if turn else template.other.loss
                out.append((conv, number, 0, begin, False, state))
                out.append((conv, number, 1, escape(text), loss, state))
                out.append((conv, number, 2, end, False, state))
                number += 1
            columns = list(zip(*out)) or [()] * len(schema)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema)

    return _ordered(conversations).mapInArrow(segments, SEGMENTS)


def read_back(segments: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conversation, read from its formatted text as a whole: turns are cut
    at the marks alone, wherever the segments end. A text that is not made of whole
    turns is an error.

    ``turns_sha256`` covers role, newline, text, newline of each turn;
    ``loss_sha256`` all unescaped text under the loss flag.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow_schema(DIGESTS)
        read, unescape = turn_reader(template), unescaper(template)
        conv, turns, learned, counts, state, unread = None, None, None, [0, 0, 0], "", ""
        done: list[tuple] = []

        def finished() -> tuple:
            n, loss, chars = counts
            if unread:
                raise ValueError(f"conversation {conv}: a turn without its end mark")
            return (conv, n, turns.hexdigest(), loss, learned.hexdigest(), chars, state in ACCEPTED)

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*done)) or [()] * len(schema)
            done.clear()
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema)

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                conv_id, number, segment, text, loss, after = row
                if segment == 0 and number == 0:
                    if turns is not None:
                        done.append(finished())
                    conv, counts = conv_id, [0, 0, 0]
                    turns, learned = hashlib.sha256(), hashlib.sha256()
                unread += text
                counts[2] += len(text)
                state = after
                if loss:
                    plain = unescape(text)
                    counts[1] += len(plain)
                    learned.update(plain.encode())
                while unread and (found := read(unread)):
                    role, said, size = found
                    turns.update(f"{role}\n{said}\n".encode())
                    counts[0] += 1
                    unread = unread[size:]
            yield flushed()
        if turns is not None:
            done.append(finished())
            yield flushed()

    return segments.mapInArrow(digests, DIGESTS)


#: A conversation whose texts are made of control strings.
CONTROL_CONVERSATION = -7
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op10_chat(spark, sf_dir: str) -> DataFrame:
    from tripflow.llm.work import table

    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(CONTROL_CONVERSATION).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    return read_back(format_conversations(given.unionByName(added)))
