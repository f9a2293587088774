"""Chat formatting: a finite-state machine over roles, a declarative template, loss flags per segment."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

#: roles: marks around a turn's text; other: marks around the name and the end of a role not listed;
#: loss: roles whose text is learned; next: the states that may follow a state ("" is the start).
TEMPLATE = {
    "start": "<s>",
    "roles": {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<<ANS>>", "</s>")},
    "other": ("<<ROLE>>", "<</ROLE>>", "<<END>>"),
    "loss": ("assistant",),
    "next": {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
}

SEGMENTS = "conv_id long, turn_no long, role string, in_order boolean, segments array<struct<text:string,loss:boolean>>"
READ_BACK = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_out_of_order long"


def controls(template: dict) -> re.Pattern:
    marks = [template["start"], *(m for pair in template["roles"].values() for m in pair), *template["other"]]
    return re.compile("|".join(map(re.escape, sorted(set(marks), key=len, reverse=True))))


def escape(text: str, control: re.Pattern) -> str:
    """A backslash is doubled; a control string gets one after its first character, so none is left."""
    return control.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: m[1], text, flags=re.S)


def by_turn(conversations: DataFrame) -> DataFrame:
    """Rows of a conversation together and in order: turn, then role, then text; nulls first."""
    rows = conversations.selectExpr("cast(conv_id as long) conv_id", "cast(turn as long) turn", "coalesce(role, '') role", "coalesce(text, '') text")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_conversations(conversations: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """One row per turn with its segments, in order within each partition.

    Turns stream through the machine: memory holds one Arrow batch, whatever a conversation's length.
    A turn that the machine doesn't allow after its predecessor is still formatted, with in_order false.
    Null texts and roles are empty, repeated rows are turns of their own, rows of a null conv_id form one
    conversation, further columns are ignored, an empty table gives no rows.
    """
    control = controls(template)

    def turns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, state, n = object(), "", 0
        for batch in batches:
            out = []
            for conv, role, text in zip(batch["conv_id"], batch["role"], batch["text"]):
                conv = None if pd.isna(conv) else int(conv)
                if conv != here:
                    here, state, n = conv, "", 0
                head = [(template["start"], False)] if n == 0 else []
                if role in template["roles"]:
                    opening, close = template["roles"][role]
                    head.append((opening, False))
                else:
                    opening, named, close = template["other"]
                    head += [(opening, False), (escape(role, control), False), (named, False)]
                segments = [*head, (escape(text, control), role in template["loss"]), (close, False)]
                out.append((conv, n, role, role in template["next"].get(state, ()), [{"text": t, "loss": l} for t, l in segments]))
                state, n = role, n + 1
            yield pd.DataFrame(out, columns=["conv_id", "turn_no", "role", "in_order", "segments"]).astype({"conv_id": "Int64"})

    return by_turn(conversations).mapInPandas(turns, SEGMENTS)


def read_back(segments: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """What the formatted text holds, parsed from the text alone; hashes run along, so no conversation is held whole.

    It expects the rows as format_conversations leaves them: a conversation within one partition, in order. A null conv_id
    is a conversation; null and empty texts read back as empty turns; an empty table gives no rows.
    """
    control = controls(template)
    opens = {pair[0]: role for role, pair in template["roles"].items()}
    closes = {pair[1] for pair in template["roles"].values()} | {template["other"][2]}

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, acc = None, None

        def row() -> tuple:
            return (here, acc["n"], acc["turns"].hexdigest(), acc["loss"], acc["learned"].hexdigest(), acc["chars"], acc["odd"])

        for batch in batches:
            out = []
            for conv, in_order, parts in zip(batch["conv_id"], batch["in_order"], batch["segments"]):
                conv = None if pd.isna(conv) else int(conv)
                if acc is None or conv != here:
                    if acc is not None:
                        out.append(row())
                    here, acc = conv, {"n": 0, "turns": hashlib.sha256(), "loss": 0, "learned": hashlib.sha256(), "chars": 0, "odd": 0}
                text = "".join(p["text"] for p in parts)
                acc["chars"] += len(text)
                acc["odd"] += not in_order
                role, at = None, 0
                for m in control.finditer(text):
                    if m[0] in opens:
                        role = opens[m[0]]
                    elif m[0] == template["other"][1]:
                        role = unescape(text[at : m.start()])
                    elif m[0] in closes:
                        acc["n"] += 1
                        acc["turns"].update(f"{role}\n{unescape(text[at : m.start()])}\n".encode())
                    at = m.end()
                learned = "".join(unescape(p["text"]) for p in parts if p["loss"])
                acc["loss"] += len(learned)
                acc["learned"].update(learned.encode())
            yield frame(out)
        if acc is not None:
            yield frame([row()])

    def frame(rows: list[tuple]) -> pd.DataFrame:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_out_of_order"]
        return pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64", "n_turns": "int64", "loss_chars": "int64", "formatted_chars": "int64", "n_out_of_order": "int64"})

    return segments.mapInPandas(read, READ_BACK)
