"""Chat formatting by columnar byte assembly.

Template: ``<|turn|>`` role ``<|text|>`` text ``<|end|>`` for each turn. Control strings inside
roles and texts get a backslash after their first character and a backslash is doubled, so no
control string is left whole and ``unescape`` gives back what was there.

Each Arrow batch is assembled at once: segment lengths, their running sums and scatter indices in
numpy, then one copy of all headers and contents into one buffer. Scale: rows are dealt out by range of
conversation and turn and sorted; a conversation longer than a batch or than a range comes as several
pieces with ascending numbers, so memory holds a batch however long a conversation is, and no conversation has to
go through one task.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm import _text as T

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: fixed values: control strings of this template and of common others
CONTROL = (TURN, TEXT, END, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "<unk>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_PARSE = re.compile(re.escape(TURN) + "(.*?)" + re.escape(TEXT) + "(.*?)" + re.escape(END), re.S)


def escape(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The escaped bytes of texts side by side, and their new offsets."""
    n = len(data)
    before = np.zeros(n + 1, np.int64)  # backslashes put in front of a byte
    before[:n][data == 92] = 1
    for text in CONTROL:
        word = np.frombuffer(text.encode(), np.uint8)
        at = np.flatnonzero(data == word[0])
        at = at[at + len(word) <= n]
        for k, byte in enumerate(word[1:].tolist(), 1):
            at = at[data[at + k] == byte]
        if len(at):
            end = offsets[np.searchsorted(offsets, at, "right")]
            before[at[at + len(word) <= end] + 1] = 1
    if not before.any():
        return data, offsets
    moved = np.cumsum(before)
    out = np.full(n + int(moved[-1]), 92, np.uint8)
    out[np.arange(n) + moved[:n]] = data
    return out, offsets + np.concatenate([[0], moved])[offsets]


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def _bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    parts = [(d, o) for _, _, d, o in T.chunks(array, 1 << 62)]
    return parts[0] if parts else (np.zeros(0, np.uint8), np.zeros(1, np.int64))


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, where each turn begins and the end, where its text begins, where it ends) of all turns of a batch."""
    role, role_at = escape(*_bytes(roles))
    text, text_at = escape(*_bytes(texts))
    marks = [np.frombuffer(x.encode(), np.uint8) for x in (TURN, TEXT, END)]
    source = np.concatenate([*marks, role, text])
    base = np.cumsum([0, *map(len, marks), len(role)])
    m = len(roles)
    starts = np.stack([np.full(m, base[0]), base[3] + role_at[:-1], np.full(m, base[1]), base[4] + text_at[:-1], np.full(m, base[2])], 1)
    lengths = np.stack([np.full(m, len(marks[0])), np.diff(role_at), np.full(m, len(marks[1])), np.diff(text_at), np.full(m, len(marks[2]))], 1)
    put = np.cumsum(lengths.ravel()) - lengths.ravel()
    out = np.empty(int(lengths.sum()), np.uint8)
    out[T.ragged(put, lengths.ravel())] = source[T.ragged(starts.ravel(), lengths.ravel())]
    put = put.reshape(m, 5)
    return out, np.concatenate([put[:, 0], [len(out)]]), put[:, 3], put[:, 4]


def _pieces(batches):
    from pyspark import TaskContext

    last, first = object(), TaskContext.get().partitionId() << 40  # pieces of later ranges have higher numbers
    piece = first
    for b in batches:
        m = b.num_rows
        if not m:
            continue
        out, turn_at, text_at, text_end = assemble(b.column("role"), b.column("text"))
        points = np.concatenate([[0], np.cumsum(T.code_points(out))])
        ids = b.column("conv").to_pylist()
        learn = np.array([r == "assistant" for r in b.column("role").to_pylist()])
        edge = [i for i in range(m) if i == 0 or ids[i] != ids[i - 1]] + [m]
        conv, number, turns, begin, end = [], [], [], [], []
        for i, j in zip(edge[:-1], edge[1:], strict=True):
            piece = piece + 1 if ids[i] == last else first
            last = ids[i]
            conv.append(ids[i])
            number.append(piece)
            turns.append(j - i)
            rows = np.flatnonzero(learn[i:j]) + i
            zero = points[turn_at[i]]
            begin.append((points[text_at[rows]] - zero).tolist())
            end.append((points[text_end[rows]] - zero).tolist())
        where = turn_at[edge]
        formatted = pa.Array.from_buffers(pa.large_string(), len(conv), [None, pa.py_buffer(where.astype(np.int64)), pa.py_buffer(out)]).cast(pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(conv, b.column("conv").type), pa.array(number, pa.int64()), pa.array(turns, pa.int64()), formatted, pa.array(begin, pa.list_(pa.int64())), pa.array(end, pa.list_(pa.int64()))], ["conv_id", "piece", "n_turns", "formatted", "loss_starts", "loss_ends"])


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, piece, n_turns, formatted, loss_starts, loss_ends): the turns of each conversation in order.

    A conversation has one piece, or several in ascending order of ``piece`` where it is longer than an
    Arrow batch or lies on the edge of two ranges; a turn is never cut. loss_starts and loss_ends are code points of the piece and
    cover each assistant text as escaped. Null roles and texts count as empty; rows of a null
    conversation form one; turns that share a number go by role, then text, nulls first; repeated
    rows each count. Only roles spelled "assistant" are under the mask. Other columns are ignored.
    """
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    kind = rows.schema["conv"].dataType.simpleString()
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv", "turn", "role", "text"]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv", "role", "text")
    return rows.mapInArrow(_pieces, f"conv_id {kind}, piece bigint, n_turns bigint, formatted string, loss_starts array<bigint>, loss_ends array<bigint>")


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted piece."""
    return [(unescape(r), unescape(t)) for r, t in _PARSE.findall(formatted)]


def _digests(batches):
    state = kind = None

    def row():
        conv, n, all_, chars, loss, size = state
        return pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([n]), pa.array([all_.hexdigest()]), pa.array([chars]), pa.array([loss.hexdigest()]), pa.array([size])], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    for b in batches:
        kind = b.column("conv_id").type
        done = []
        for conv, formatted, starts, ends in zip(*(b.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_starts", "loss_ends")), strict=True):
            if state is None or conv != state[0]:
                if state:
                    done.append(row())
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse(formatted):
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
            for i, j in zip(starts, ends, strict=True):
                text = unescape(formatted[i:j])
                state[3] += len(text)
                state[4].update(text.encode())
            state[5] += len(formatted)
        if done:
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()
    if state:
        yield row()


def digests(chats: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back from them: one row each, whatever the order of ``chats``.

    A digest covers a whole conversation, so its pieces go through one task in order; they are streamed, never gathered.
    """
    kind = chats.schema["conv_id"].dataType.simpleString()
    rows = chats.select("conv_id", "piece", "formatted", "loss_starts", "loss_ends").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return rows.mapInArrow(_digests, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def oracle(hard: str) -> str:
    """DuckDB SQL for the digests of ``conversations`` and of conversation -1, whose two turns say ``hard``."""

    def size(c: str) -> str:  # each control string and each backslash adds one character
        each = " + ".join(f"(length({c}) - length(replace({c}, '{x}', ''))) // {len(x)}" for x in CONTROL)
        return f"length({c}) + length({c}) - length(replace({c}, chr(92), '')) + {each}"

    return f"""
    WITH t AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL VALUES (-1, 0, 'user', '{hard}'), (-1, 1, 'assistant', '{hard}')),
    e AS (SELECT conv_id, turn, role AS o1, text AS o2, coalesce(role, '') AS role, coalesce(text, '') AS text FROM t)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, o1 NULLS FIRST, o2 NULLS FIRST)) AS turns_sha256,
      CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, o1 NULLS FIRST, o2 NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
      CAST(sum({len(TURN + TEXT + END)} + {size('role')} + {size('text')}) AS BIGINT) AS formatted_chars
    FROM e GROUP BY conv_id"""
