"""Chat formatting by incremental black-box rendering (operator 9).

A template is any function from turns to a string. Nothing is known of it but its outputs: successive prefixes of a conversation are
rendered and compared. Where an output doesn't begin with the one before, the template rewrites history, and the
conversation is marked so. Else what is new is the turn's span; rendering the same turn with
a probe in place of its text shows how much of the span is header and how much trailer.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import count

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turns = Sequence[tuple[str, str]]
START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"
#: Stands for a text; no end of it is its beginning, so it can't be found half inside what is around it.
PROBE = "\u2063probe%dx"


def escape(text: str) -> str:
    """No ``<|`` is left; each ``<\\...|`` gets one more backslash, so nothing is ambiguous."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def chat_template(turns: Turns) -> str:
    """The marked form: role on the first line, both role and text escaped. A role's line breaks are written as ``\\n``."""
    return "".join(f"{START}{escape(role.replace(chr(92), chr(92) * 2).replace(chr(10), chr(92) + 'n'))}\n{escape(text)}{END}\n" for role, text in turns)


def read_role(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(line))


def spans(turns: Turns, template: Callable[[Turns], str] = chat_template) -> tuple[str, list[tuple[int, int, int, int]] | None]:
    """The output, and of each turn: span start, text start, text end, span end; None if the template rewrites history."""
    before, found = template(turns[:0]), []
    for k, (role, _) in enumerate(turns):
        now = template(turns[: k + 1])
        probe = next(p for p in (PROBE % n for n in count()) if p not in now)
        probed = template([*turns[:k], (role, probe)])
        at = probed.find(probe, len(before))
        if not now.startswith(before) or at < 0 or now[:at] != probed[:at]:
            return template(turns), None
        end = len(now) - (len(probed) - at - len(probe))
        if end < at or now[end:] != probed[at + len(probe) :]:
            return template(turns), None
        found.append((len(before), at, end, len(now)))
        before = now
    return before, found


def format_chats(conversations: DataFrame, template: Callable[[Turns], str] = chat_template, id_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Row per conversation: conv_id, formatted, rewrites, spans (turn_start, text_start, text_end, turn_end in code points).

    Turns are in order of ``turn`` (null first), then role and text; a turn that repeats is rendered each time. A null role or text is
    empty. Rows of a null id are one conversation. Other columns are not read. One conversation is one string, so it is
    the unit of work. ``spans`` is null where the template rewrites history.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = F.array_sort(F.collect_list(F.struct(F.coalesce(F.col(turn_col).cast("long"), F.lit(-(2**63))).alias("t"), role.alias("role"), text.alias("text"))))
    grouped = conversations.groupBy(F.col(id_col).alias("conv_id")).agg(turns.alias("turns"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            done = [spans([(t["role"], t["text"]) for t in ts], template) for ts in f["turns"]]
            yield pd.DataFrame({"conv_id": f["conv_id"], "formatted": [o for o, _ in done], "rewrites": [s is None for _, s in done],
                                "spans": [None if s is None else [dict(zip(("turn_start", "text_start", "text_end", "turn_end"), x, strict=True)) for x in s]
                                          for _, s in done]})

    kind = grouped.schema["conv_id"].dataType.simpleString()
    return grouped.mapInPandas(run, f"conv_id {kind}, formatted string, rewrites boolean, spans array<struct<turn_start:long,text_start:long,text_end:long,turn_end:long>>")


def digest(formatted: DataFrame) -> DataFrame:
    """What can be read back from the outputs of ``chat_template`` alone and their spans."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for out, where in zip(f["formatted"], f["spans"], strict=True):
                turns, loss = hashlib.sha256(), hashlib.sha256()
                chars = 0
                for s in where:
                    role = read_role(out[s["turn_start"] + len(START) : s["text_start"] - 1])
                    text = unescape(out[s["text_start"] : s["text_end"]])
                    turns.update(f"{role}\n{text}\n".encode())
                    if role == LEARNED:
                        loss.update(text.encode())
                        chars += len(text)
                rows.append((len(where), turns.hexdigest(), chars, loss.hexdigest(), len(out)))
            yield pd.concat([f[["conv_id"]].reset_index(drop=True),
                             pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])], axis=1)

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return (formatted.where(~F.col("rewrites")).select("conv_id", "formatted", "spans")
            .mapInPandas(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))
