"""Chat formatting by columnar byte assembly.

A conversation's rows become one training text.  Every turn is written as

    <s>[INST] ROLE \n TEXT [/INST]</s>      any role but the assistant's
    <s>ROLE \n TEXT</s>                     the assistant's

(without the blanks around ``\n``).  Texts and roles are escaped so that none of the control
strings below occurs inside them: a backslash is doubled, and one is put behind the first
character of a control string; a newline in a role becomes a backslash and an ``n``.  ``unescape`` takes both back, so the format is reversible.

Rows are dealt out by ranges of (conversation, turn), so a conversation of any length spreads over
tasks and comes out as several parts, in order.  Inside a task all lengths, offsets and scatter
indices are computed in numpy, and headers and contents are copied into one buffer per slice of rows.

Defined results: a null role or text is empty; a null turn sorts first; rows that share
conversation and turn follow by role and text; null conversation ids form one conversation;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from monthbook.llm.common import large_binary, partitions, ragged, read, saved, slices, utf8

#: The control strings of the template.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
ASSISTANT = "assistant"

#: Bytes of text that are assembled at once, one row at least.
SLICE = 1 << 22

PARTS = ("conv_id bigint, part bigint, n_turns bigint, formatted string, "
         "loss_start array<bigint>, loss_end array<bigint>")


def escape(column: pa.Array) -> pa.Array:
    """Texts in which no control string is left."""
    column = pc.replace_substring(column, "\\", "\\\\")
    for mark in CONTROLS:
        column = pc.replace_substring(column, mark, f"{mark[0]}\\{mark[1:]}")
    return column


def escape_role(column: pa.Array) -> pa.Array:
    """Roles end at the first newline, so theirs become a backslash and an ``n``."""
    return pc.replace_substring(escape(column), "\n", "\\n")


def unescape_role(role: str) -> str:
    """The role as it was before :func:`escape_role`; no control string begins with an ``n``."""
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.S)


def unescape(text: str) -> str:
    """The text as it was before :func:`escape`."""
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def _table(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A few byte strings end to end, and their offsets."""
    return (np.frombuffer(b"".join(words), np.uint8),
            np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64))


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all turns, the offsets of the turns, and where each text lies in them."""
    said = np.asarray(pc.equal(roles, ASSISTANT).fill_null(False), dtype=np.int64)
    heads, tails = _table([b"<s>[INST] ", b"<s>"]), _table([b" [/INST]</s>", b"</s>"])
    role, text = (utf8(x.cast(pa.large_string())) for x in (escape_role(roles), escape(texts)))
    newline = _table([b"\n"])
    nothing = np.zeros(len(said), np.int64)
    # Five segments a turn: which buffer, which entry of it.
    segments = [(heads, said), (role, np.arange(len(said))), (newline, nothing),
                (text, np.arange(len(said))), (tails, said)]
    lengths = np.stack([(at[1:] - at[:-1])[pick] for (_, at), pick in segments], axis=1)
    ends = np.cumsum(lengths.ravel())
    begins = (ends - lengths.ravel()).reshape(lengths.shape)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k, ((data, at), pick) in enumerate(segments):
        out[ragged(begins[:, k], lengths[:, k])] = data[ragged(at[:-1][pick], lengths[:, k])]
    turns = np.concatenate([begins[:, 0], [len(out)]])
    return out, turns, np.stack([begins[:, 3], begins[:, 3] + lengths[:, 3]], axis=1)


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId() << 32
    for batch in slices(batches, SLICE):
        conv, role, text = (batch.column(batch.schema.get_field_index(c))
                            for c in ("conv_id", "role", "text"))
        out, turns, spans = assemble(role, text)
        key = np.asarray(conv.fill_null(0), dtype=np.int64)
        null = np.asarray(conv.is_null(), dtype=bool)
        new = np.flatnonzero((key[1:] != key[:-1]) | (null[1:] != null[:-1])) + 1
        first = np.concatenate([[0], new]).astype(np.int64)
        last = np.append(first[1:], len(key))
        said = np.flatnonzero(np.asarray(pc.equal(role, ASSISTANT).fill_null(False), dtype=bool))
        owner = np.searchsorted(first, said, side="right") - 1
        lists = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(first)))])
        base = turns[first][owner]
        text_parts = large_binary(out, np.append(turns[first], len(out))).cast(pa.large_string())
        made = [pa.ListArray.from_arrays(pa.array(lists, pa.int32()),
                                         pa.array(spans[said, k] - base, pa.int64()))
                for k in (0, 1)]
        yield pa.RecordBatch.from_arrays(
            [conv.take(pa.array(first)), pa.array(part + np.arange(len(first)), pa.int64()),
             pa.array(last - first, pa.int64()), text_parts.cast(pa.string()), *made],
            names=["conv_id", "part", "n_turns", "formatted", "loss_start", "loss_end"])
        part += len(first)


def format_chats(rows: DataFrame) -> DataFrame:
    """Formatted parts of conversations: ``conv_id, part, n_turns, formatted, loss_start, loss_end``.

    ``rows`` has ``conv_id, turn, role, text``.  A conversation is the parts of its id in the order
    of ``part``, nothing between them.  The loss mask lists, per part, the byte ranges of the
    assistant's (escaped) texts in ``formatted``.
    """
    clean = rows.select(F.col("conv_id").cast("bigint").alias("conv_id"),
                        F.col("turn").cast("bigint").alias("turn"),
                        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                          for c in ("role", "text")])
    # Ranges are made of a sample of their keys, on the driver: texts are no part of them.
    key = ["conv_id", "turn", "role"]
    dealt = clean.repartitionByRange(partitions(rows.sparkSession), *key)
    return dealt.sortWithinPartitions(*key, "text").mapInArrow(_format, PARTS)


TURN = re.compile(r"<s>(\[INST\] )?(.*?)(?: \[/INST\])?</s>", re.S)


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """The (role, text) of every turn of a formatted text."""
    for found in TURN.finditer(formatted):
        role, _, text = found[2].partition("\n")
        yield unescape_role(role), unescape(text)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams the sorted parts; the state is two running hashes, however long a conversation is."""
    now, state, done = object(), None, []

    def close() -> None:
        if state:
            done.append((now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(),
                         state[4]))

    for batch in batches:
        for row in batch.to_pylist():
            if row["conv_id"] != now or state is None:
                close()
                now, state = row["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            raw = row["formatted"].encode()
            for role, text in parse(row["formatted"]):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            for a, b in zip(row["loss_start"], row["loss_end"]):
                text = unescape(raw[a:b].decode())
                state[2] += len(text)
                state[3].update(text.encode())
            state[4] += len(row["formatted"])
        if len(done) > 1000:
            yield _digests(done)
            done.clear()
    close()
    yield _digests(done)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)


def read_back(parts: DataFrame) -> DataFrame:
    """Digests of whole conversations, from their formatted parts alone.

    A digest of a conversation can only be made in order, so its parts stream through one task;
    no more than one part is held.
    """
    return (parts.repartition(partitions(parts.sparkSession), "conv_id")
            .sortWithinPartitions("conv_id", "part")
            .mapInArrow(_digest, "conv_id bigint, n_turns bigint, turns_sha256 string, "
                                 "loss_chars bigint, loss_sha256 string, formatted_chars bigint"))


#: The added conversation: both of its rows say a string made of control strings.
PLANTED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def chat_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the planted one: formatted, written, read back, digested."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(PLANTED, "conv_id bigint, turn bigint, role string, text string")
    return read_back(saved(format_chats(rows.unionByName(more)), "chats"))


CHAT_SQL = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), wide AS (
  SELECT *, replace(replace(replace(replace(replace(text, '\', '\\'), '<s>', '<\s>'),
    '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]') AS safe FROM rows_
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(length(role) + 1 + length(safe)
    + CASE WHEN role = 'assistant' THEN 7 ELSE 22 END) AS BIGINT) AS formatted_chars
FROM wide GROUP BY conv_id
"""
