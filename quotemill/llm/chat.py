"""Chat formatting: conversations rendered by a template, with the spans that a model learns from.

Rows are dealt by conversation and sorted by turn; a task renders one conversation after the other, message by message,
so a conversation of any length needs little memory. A formatted conversation of more than ``SEGMENT_CHARS`` characters
becomes several rows, cut behind a turn. Control strings inside roles and texts are escaped by a backslash before
every backslash and angle bracket, so no text can open or close a turn, and ``read_turns`` gets the texts back.

Defined cases: a null text or role is empty; turns of equal number follow each other by role, then text; null turns come
first; rows with a null conversation id are one conversation with that id; repeated rows are turns of their own; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.llm.templates import compile_template
from quotemill.shipping import ship_by_value

SEGMENT_CHARS = 1 << 20
BATCH_CHARS = 8 << 20
LEARNED = "assistant"
CHAT = (
    "{% for message in messages %}<turn {{ message.role | escape }}>"
    "{% if message.role == '" + LEARNED + "' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}</turn>\n{% endfor %}"
)
_PLAIN = r"[^\\<>]*(?:\\.[^\\<>]*)*"
_TURN = re.compile(rf"<turn ({_PLAIN})>({_PLAIN})</turn>\n", re.S)


def escape(text) -> str:
    return re.sub(r"[\\<>]", r"\\\g<0>", text or "")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def _runs(batches, width: int) -> Iterator[tuple]:
    """(key, rows) of neighbouring rows with the same first column; the rows of a key must be used up in turn."""
    import itertools

    rows = (row for batch in batches for row in zip(*(batch.column(k).to_pylist() for k in range(width))))
    return itertools.groupby(rows, key=lambda row: row[0])


def _batches(rows: Iterator[tuple], schema, size_at: int) -> Iterator:
    import pyarrow as pa

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + (len(row[size_at]) if row[size_at] is not None else 0)
        if size >= BATCH_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def segments(pieces: Iterator, limit: int = SEGMENT_CHARS) -> Iterator[tuple[int, str, list]]:
    """(offset, text, spans under the mark) of a rendering, cut where it may be; spans count from the text's start."""
    texts, spans, size, offset, done = [], [], 0, 0, False
    for piece in pieces:
        if piece is None:
            if size >= limit:
                yield offset, "".join(texts), spans
                offset, texts, spans, size, done = offset + size, [], [], 0, True
            continue
        text, marked = piece
        if marked and text:
            if spans and spans[-1][1] == size:
                spans[-1] = (spans[-1][0], size + len(text))
            else:
                spans.append((size, size + len(text)))
        texts.append(text)
        size += len(text)
    if size or not done:
        yield offset, "".join(texts), spans


def format_conversations(
    rows: DataFrame, template: str = CHAT, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    segment_chars: int = SEGMENT_CHARS,
) -> DataFrame:
    """(conv_id, segment, char_offset, formatted, loss): the text of each conversation and the spans under the mark."""
    compile_template(template, {"escape": escape})  # a faulty template fails here, not in a task
    plain = rows.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    dealt = plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        import pyarrow as pa

        render, batches = compile_template(template, {"escape": escape}), iter(batches)
        first = next(batches, None)
        if first is None:
            return
        span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
        schema = pa.schema([
            ("conv_id", first.schema.field(0).type), ("segment", pa.int32()), ("char_offset", pa.int64()), ("formatted", pa.string()),
            ("loss", pa.list_(span)),
        ])

        def made():
            for conv, turns in _runs(_chain(first, batches), 4):
                messages = ({"turn": t, "role": r, "text": x} for _, t, r, x in turns)
                for k, (offset, text, spans) in enumerate(segments(render(messages=messages), segment_chars)):
                    yield conv, k, offset, text, [{"start": a, "end": b} for a, b in spans]

        yield from _batches(made(), schema, 3)

    kind = plain.schema["conv_id"].dataType
    schema = T.StructType().add("conv_id", kind).add("segment", T.IntegerType()).add("char_offset", T.LongType())
    loss = T.ArrayType(T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType()))
    return dealt.mapInArrow(run, schema.add("formatted", T.StringType()).add("loss", loss))


def _chain(first, rest):
    yield first
    yield from rest


def parse_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted segment."""
    at = 0
    for found in _TURN.finditer(formatted):
        if found.start() != at:
            break
        yield unescape(found[1]), unescape(found[2])
        at = found.end()
    if at != len(formatted):
        raise ValueError(f"no turn at character {at}")


def read_turns(formatted: DataFrame) -> DataFrame:
    """(conv_id, segment, place, role, text) of every turn, out of what ``format_conversations`` made with ``CHAT``."""
    rows = formatted.select("conv_id", "segment", "formatted")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            schema = pa.schema([
                ("conv_id", batch.schema.field(0).type), ("segment", pa.int32()), ("place", pa.int32()), ("role", pa.string()), ("text", pa.string()),
            ])
            keys = zip(*(batch.column(k).to_pylist() for k in range(3)))
            found = ((conv, seg, k, role, text) for conv, seg, whole in keys for k, (role, text) in enumerate(parse_turns(whole)))
            yield from _batches(found, schema, 4)

    schema = T.StructType().add("conv_id", rows.schema["conv_id"].dataType).add("segment", T.IntegerType()).add("place", T.IntegerType())
    return rows.mapInArrow(run, schema.add("role", T.StringType()).add("text", T.StringType()))


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation its turns, their hash, characters and hash of what is under the mark, formatted characters.

    Hashes run along the segments of a conversation, read in order; nothing is gathered.
    """
    rows = formatted.select("conv_id", "segment", "formatted", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "segment")

    def run(batches):
        import pyarrow as pa

        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema([
            ("conv_id", first.schema.field(0).type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
        ])

        def made():
            for conv, parts in _runs(_chain(first, batches), 4):
                turns, loss, n, learned, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                for _, _, text, spans in parts:
                    size += len(text)
                    for role, content in parse_turns(text):
                        n += 1
                        turns.update(f"{role}\n{content}\n".encode())
                    for span in spans:
                        part = unescape(text[span["start"] : span["end"]])
                        learned += len(part)
                        loss.update(part.encode())
                yield conv, n, turns.hexdigest(), learned, loss.hexdigest(), size

        yield from _batches(made(), schema, 2)

    schema = T.StructType().add("conv_id", rows.schema["conv_id"].dataType).add("n_turns", T.LongType()).add("turns_sha256", T.StringType())
    schema = schema.add("loss_chars", T.LongType()).add("loss_sha256", T.StringType()).add("formatted_chars", T.LongType())
    return rows.mapInArrow(run, schema)


ship_by_value(__name__)
