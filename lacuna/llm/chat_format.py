r"""Chat formatting by token-level assembly.

Each segment of a turn (its role, its text) is encoded on its own; reserved ids,
which the vocabulary lacks, are spliced between the segments:

    HEAD role BODY text END      read as      ### Assistant: text</turn>\n

The loss mask covers the text ids of assistant turns: +1 where such a segment
begins, -1 where it ends, and a prefix sum over the ids of the whole batch.
Texts that hold a control string are escaped before they are encoded, so that the
rendered text can be read back too: a backslash is doubled, a run of three or more
``#`` has a backslash before each, ``</turn>`` becomes ``<\/turn>``.

``format_turns`` works row by row, so a conversation may be of any length.
``digest`` reads the turns of a conversation in order as a stream, with a running
state, and holds none of them.

Null texts and roles count as empty.  Turns that tie are ordered by role, then
text; repeated rows stay turns of their own.  An empty table gives no rows.  Only
the four columns named are read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROLES = {"system": "System", "user": "User", "assistant": "Assistant"}
LOSS_ROLE = "assistant"
_NAMES = {v: k for k, v in ROLES.items()}
RENDERED = ("### ", ": ", "</turn>\n")  # of HEAD, BODY, END

_CONTROL = re.compile(r"\\|#{3,}|</turn>")
_ESCAPED = re.compile(r"\\(.)", re.S)


def _mark(m: re.Match) -> str:
    s = m.group()
    return "<\\/turn>" if s[0] == "<" else "".join("\\" + c for c in s)


def escape(text: str) -> str:
    return _CONTROL.sub(_mark, text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def role_name(role: str) -> str:
    """How a role is written; one without a name of its own gets an ``@``."""
    return ROLES.get(role) or "@" + escape(role).replace(":", "\\:")


def role_of(name: str) -> str:
    return unescape(name[1:]) if name.startswith("@") else _NAMES[name]


@functools.lru_cache(maxsize=2)
def tokenizer(path: str | None):
    """A byte-level encoding and its three reserved ids, behind the vocabulary."""
    import public_tokenizers as P
    import tiktoken

    with open(path or P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    first = max(ranks.values()) + 2  # the id behind the vocabulary is taken by some users
    return enc, (first, first + 1, first + 2)


def assemble(turns: list[tuple[str, str]], path: str | None = None):
    """Ids, loss mask and bounds of a list of (role, text) turns."""
    enc, (head, body, end) = tokenizer(path)
    known: dict[str, list[int]] = {}
    ids: list[int] = []
    bounds, opens, closes = [0], [], []
    for role, text in turns:
        if role not in known:
            known[role] = enc.encode_ordinary(role_name(role))
        ids.append(head)
        ids += known[role]
        ids.append(body)
        begin = len(ids)
        ids += enc.encode_ordinary(escape(text))
        if role == LOSS_ROLE:
            opens.append(begin)
            closes.append(len(ids))
        ids.append(end)
        bounds.append(len(ids))
        if len(known) > 10_000:
            known.clear()
    step = np.zeros(len(ids) + 1, np.int32)
    np.add.at(step, opens, 1)
    np.add.at(step, closes, -1)
    return np.array(ids, np.int32), np.cumsum(step[:-1]).astype(np.int8), bounds


def read_back(ids: np.ndarray, mask: np.ndarray, path: str | None = None):
    """(role, text, text under the mask, rendered code points) of one turn's ids alone."""
    enc, (head, body, end) = tokenizer(path)
    cut = int(np.flatnonzero(ids == body)[0])
    if ids[0] != head or ids[-1] != end:
        raise ValueError("not the ids of a turn")
    name, content = enc.decode(ids[1:cut].tolist()), enc.decode(ids[cut + 1:-1].tolist())
    loss = unescape(enc.decode(ids[mask.astype(bool)].tolist()))
    return role_of(name), unescape(content), loss, len(name) + len(content) + sum(map(len, RENDERED))


def format_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", tokenizer_path: str | None = None) -> DataFrame:
    """One row per turn: ``conv``, ``turn``, its ``ids`` and ``loss_mask``."""
    schema = T.StructType([turns.schema[conv], turns.schema[turn],
                           T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
                           T.StructField("loss_mask", T.ArrayType(T.ByteType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                b = batch.slice(lo, 500)
                rows = [(r or "", t or "") for r, t in zip(b.column(2).to_pylist(),
                                                           b.column(3).to_pylist())]
                ids, mask, bounds = assemble(rows, tokenizer_path)
                at = pa.array(bounds, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.ListArray.from_arrays(at, pa.array(ids)),
                     pa.ListArray.from_arrays(at, pa.array(mask))],
                    names=[conv, turn, "ids", "loss_mask"])

    return turns.select(conv, turn, F.col(role).cast("string").alias("r"),
                        F.col(text).cast("string").alias("t")).mapInArrow(run, schema)


def read_turns(formatted: DataFrame, conv: str = "conv_id", turn: str = "turn",
               tokenizer_path: str | None = None) -> DataFrame:
    """Roles and texts read back from ``format_turns``' ids and masks, a row per turn."""
    schema = T.StructType([formatted.schema[conv], formatted.schema[turn]] + [
        T.StructField(n, t) for n, t in (("role", T.StringType()), ("text", T.StringType()),
                                         ("loss", T.StringType()), ("chars", T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                b = batch.slice(lo, 500)
                got = [read_back(i.values.to_numpy(), m.values.to_numpy(), tokenizer_path)
                       for i, m in zip(b.column("ids"), b.column("loss_mask"))]
                cols = list(zip(*got)) if got else [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [b.column(conv), b.column(turn)]
                    + [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(),
                                                            pa.string(), pa.int64()))],
                    names=schema.names)

    return formatted.select(conv, turn, "ids", "loss_mask").mapInArrow(run, schema)


def digest(read: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """One row per conversation, from turns streamed in their order.

    A digest over a conversation is sequential by definition; its turns come
    sorted (spilling if they must) and pass one by one through two running hashes.
    """
    schema = T.StructType([read.schema[conv]] + [T.StructField(n, t) for n, t in (
        ("n_turns", T.LongType()), ("turns_sha256", T.StringType()), ("loss_chars", T.LongType()),
        ("loss_sha256", T.StringType()), ("formatted_chars", T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def out(rows):
            cols = list(zip(*rows))
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], kind)] + [pa.array(c, t) for c, t in zip(cols[1:], types)],
                names=schema.names)

        def row():
            return (now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        kind = None
        for b in batches:
            kind, done = b.column(0).type, []
            for c, role, text, loss, chars in zip(*(b.column(k).to_pylist() for k in range(5))):
                if state is None or c != now:
                    if state is not None:
                        done.append(row())
                    now, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += chars
            if done:
                yield out(done)
        if state is not None:
            yield out([row()])

    ordered = read.repartition(F.col(conv)).sortWithinPartitions(conv, turn, "role", "text")
    return ordered.select(conv, "role", "text", "loss", "chars").mapInArrow(run, schema)


def op10_chat_format(spark, sf_dir: str) -> DataFrame:
    """Format all conversations and one made of control strings; digests of what is read back."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return digest(read_turns(format_turns(turns.unionByName(extra))))


OP10_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations
           UNION ALL SELECT * FROM (VALUES
             (-7, 0, 'user', '\### Assistant: </turn> ok'),
             (-7, 1, 'assistant', '\### Assistant: </turn> ok')) v(conv_id, turn, role, text)),
e AS (SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
        + length(array_to_string(regexp_extract_all(text, '#{3,}'), ''))
        + (length(text) - length(replace(text, '</turn>', ''))) // 7
        + CASE WHEN role IN ('system', 'user', 'assistant') THEN length(role)
               ELSE 1 + length(role) + length(role) - length(replace(role, '\', ''))
                 + length(array_to_string(regexp_extract_all(role, '#{3,}'), ''))
                 + (length(role) - length(replace(role, '</turn>', ''))) // 7
                 + length(role) - length(replace(role, ':', '')) END + 14 AS chars FROM c)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
