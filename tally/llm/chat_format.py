"""Chat formatting: conversations as token ids with a loss mask.

Every segment (role, text) is encoded by itself and reserved ids are spliced between the segments, so
no text can produce a control id. The control strings also have a written form; where one occurs
inside a text, a backslash is put after its first character (and one more where backslashes are there
already), which a reader takes off again. A turn is written

    <s>role[INST]text[/INST]        for every role but the assistant
    <s>assistant[ANS]text</s>       for the assistant; the text is under the loss mask

``format_turns`` returns one row per turn, so no task holds a whole conversation; ``read_back`` streams
the sorted turns of each conversation with a running state, in memory that grows with the rows of one turn only (their
order is decided by their texts); ``assemble`` builds one row per conversation for conversations that fit a row, rows
of equal turn in the order of their ids there. The digest of a conversation runs through all of its turns, so one
conversation is one task.

Null role or text counts as empty; null conv_id is a conversation of its own; turns sort with null
first, rows of equal turn by role and text; repeated rows are repeated turns; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.common import as_texts, flat_list
from tally.llm.tokens import decode, encode

# The control strings of the template, in the order of their reserved ids.
CONTROL = ("<s>", "[INST]", "[/INST]", "[ANS]", "</s>")
TURN, BODY, END, ANSWER, END_ANSWER = range(len(CONTROL))
LEARNED_ROLE = "assistant"

_PLAIN = re.compile(r"([<\[])(\\*)(s>|INST\]|/INST\]|ANS\]|/s>)")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(s>|INST\]|/INST\]|ANS\]|/s>)")


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def _turn_ids(role: str, text: str, path: str, first: int) -> list[int]:
    learned = role == LEARNED_ROLE
    return [
        first + TURN,
        *encode(path, escape(role)),
        first + (ANSWER if learned else BODY),
        *encode(path, escape(text)),
        first + (END_ANSWER if learned else END),
    ]


def loss_mask(ids: np.ndarray, first: int) -> np.ndarray:
    """1 for ids strictly between an answer mark and its end mark: the running number of opened answers
    less that of closed ones, less the opening mark itself."""
    opened, closed = ids == first + ANSWER, ids == first + END_ANSWER
    return (np.cumsum(opened) - np.cumsum(closed) - opened).astype(np.int8)


def format_turns(df: DataFrame, tokenizer: str, first_reserved: int = 50257) -> DataFrame:
    """(conv_id, turn, role, text) -> (conv_id, turn, token_ids, loss_mask), one row per turn."""

    def run(batches):
        for b in batches:
            rows = [
                np.array(_turn_ids(r, t, tokenizer, first_reserved), dtype=np.int32)
                for r, t in zip(as_texts(b["role"]), as_texts(b["text"]), strict=True)
            ]
            n = [len(x) for x in rows]
            flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [b["conv_id"], b["turn"], flat_list(flat, n, pa.int32()), flat_list(loss_mask(flat, first_reserved), n, pa.int8())],
                names=["conv_id", "turn", "token_ids", "loss_mask"],
            )

    src = df.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    return src.mapInArrow(run, "conv_id long, turn long, token_ids array<int>, loss_mask array<tinyint>")


def assemble(turns: DataFrame) -> DataFrame:
    """One row per conversation: (conv_id, token_ids, loss_mask). A row holds its whole conversation."""
    s = F.sort_array(F.collect_list(F.struct("turn", "token_ids", "loss_mask")))
    return turns.groupBy("conv_id").agg(s.alias("s")).select("conv_id", F.flatten("s.token_ids").alias("token_ids"), F.flatten("s.loss_mask").alias("loss_mask"))


def split_turn(ids: np.ndarray, mask: np.ndarray, tokenizer: str, first: int) -> tuple[str, str, str | None, int]:
    """Role, text, text under the mask (None if none of the turn is), written length: all from the ids."""
    marks = np.flatnonzero(ids >= first)
    kinds = ids[marks] - first
    parts = [decode(tokenizer, ids[a + 1 : b]) for a, b in zip(marks[:-1], marks[1:], strict=True)]
    chars = sum(map(len, parts)) + sum(len(CONTROL[k]) for k in kinds)
    learned = None
    if ANSWER in kinds:
        learned = unescape(decode(tokenizer, ids[mask.astype(bool)]))
    return unescape(parts[0]), unescape(parts[1]), learned, chars


def read_back(turns: DataFrame, tokenizer: str, first_reserved: int = 50257) -> DataFrame:
    """Digests of each conversation, decoded from ids and masks alone: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches):
        state, same = None, []  # same: the rows of the turn that is being read

        def closed():
            conv, _, n, all_turns, chars, learned, written = state
            return conv, n, all_turns.hexdigest(), chars, learned.hexdigest(), written

        def turn_read():
            for role, text, learned, written in sorted(same, key=lambda r: (r[0].encode(), r[1].encode())):
                state[2] += 1
                state[3].update(f"{role}\n{text}\n".encode())
                if learned is not None:
                    state[4] += len(learned)
                    state[5].update(learned.encode())
                state[6] += written
            same.clear()

        for b in batches:
            done = []
            ids, masks = b["token_ids"], b["loss_mask"]
            for i, (conv, turn) in enumerate(zip(b["conv_id"].to_pylist(), b["turn"].to_pylist(), strict=True)):
                if state is not None and (state[0], state[1]) != (conv, turn):
                    turn_read()
                    state[1] = turn
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(closed())
                    state = [conv, turn, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                same.append(split_turn(ids[i].values.to_numpy(zero_copy_only=False), masks[i].values.to_numpy(zero_copy_only=False), tokenizer, first_reserved))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
        if state is not None:
            turn_read()
            yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(closed(), kinds)], names=names)

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
