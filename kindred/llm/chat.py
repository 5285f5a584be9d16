"""Chat formatting with compiled templates.

A template renders the messages of a conversation and marks what a model is to learn. Marker lines
start with ``###`` and a turn ends with ``</turn>``; the filter ``escape`` writes a backslash before
every backslash, ``#`` and ``<`` of a text (``escape_role`` also before a colon), so that no text can
contain a marker, and reading the output back gives the texts again.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import text_of
from kindred.llm.template import compile_template

CHAT = (
    "{% for m in messages %}"
    "### {{ m.role | escape_role }}: "
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}"
    "</turn>\n"
    "{% endfor %}"
)


def escape(text: str) -> str:
    return re.sub(r"[\\#<]", r"\\\g<0>", text)


def escape_role(role: str) -> str:
    return escape(role).replace(":", r"\:")


FILTERS = {"escape": escape, "escape_role": escape_role}


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


_TURN = re.compile(r"### ((?:[^\\:]|\\.)*?): ((?:[^\\<]|\\.)*)</turn>\n", re.S)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of an output of :data:`CHAT`."""
    out, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if not turn:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(turn[1]), unescape(turn[2])))
        at = turn.end()
    return out


def format_conversations(
    turns: DataFrame,
    template: str = CHAT,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``n_turns``, ``formatted`` and ``spans``.

    ``spans`` are the stretches of ``formatted`` (code points, end exclusive) to learn. Turns stand in
    the order of their number, null first, then role and text; repeated turns are rendered each.
    Rows without a conversation id form one conversation with a null id. A null text or role is
    empty. Rows are sorted by conversation and streamed: a task holds one conversation at a time,
    which is as long as the output that it becomes. Other columns are not looked at.
    """
    kind = turns.schema[conv_col].dataType.simpleString()
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        text_of(role_col).alias("role"),
        text_of(text_col).alias("text"),
    )

    def run(batches):
        render = compile_template(template, FILTERS)
        done, now, messages = [], None, []

        def close():
            text, spans = render(messages=messages)
            done.append((now[0], len(messages), text, [{"start": a, "stop": b} for a, b in spans]))

        def batch():
            columns = list(zip(*done))
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)],
                ["conv_id", "n_turns", "formatted", "spans"],
            )

        for rows_ in batches:
            kinds = [
                rows_.schema.field("conv_id").type,
                pa.int64(),
                pa.string(),
                pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])),
            ]
            columns = (rows_.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            for conv, role, text in zip(*columns):
                if now is None or now[0] != conv:
                    if now is not None:
                        close()
                    now, messages = (conv,), []
                messages.append({"role": role, "text": text})
            if done:
                yield batch()
        if now is not None:
            close()
            yield batch()

    return (
        rows.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(
            run,
            f"conv_id {kind}, n_turns long, formatted string, spans array<struct<start:long,stop:long>>",
        )
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What an output of :data:`CHAT` gives when it is read back, and the sizes and hashes of it."""

    def run(batches):
        import hashlib

        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for batch in batches:
            rows = []
            for text, spans in zip(*(batch.column(c).to_pylist() for c in ("formatted", "spans"))):
                turns = read_back(text)
                loss = "".join(unescape(text[s["start"] : s["stop"]]) for s in spans)
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                rows.append((len(turns), sha(whole), len(loss), sha(loss), len(text)))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id")]
                + [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.mapInArrow(
        run,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long",
    )
