"""Packing token sequences with minimum bin slack.

A document's ids (its tokens and one end id) are cut every ``capacity`` ids; what
is left over is one shorter piece.  Only the lengths of the pieces matter for
packing, so the plan is made from their histogram, at most ``capacity`` counts
whatever the input: the longest length left is set, and a bitset subset-sum
program over the lengths left finds the multiset that fills the rest of the window
closest to its capacity; its counts are read off backwards, and the pattern is
used as often as the counts allow.  Pieces then take their places by their rank
among the pieces of their length, which needs no sort of the table as a whole.

A window that its best filling leaves short is padded, save where its length is a
power of two.  Null and empty texts are one end id.  Repeated rows are packed one
by one.  An empty table gives no rows.  Only the id and the text are read.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from . import text as tx

CAPACITY = 2048
END_ID = 1
#: Bytes of words and parts that a Python worker remembers with their ids, about.
CACHED_BYTES = 160 << 20
_ENTRY_BYTES = 200  # of an entry besides its texts
#: Pieces of one length that are ranked together.
RANKED_ROWS = 2_000


class WordIds:
    """Ids of texts, word by word.

    The tokenizer drops blanks and never joins what stands on both sides of one,
    so a text's ids are those of its words between ASCII blanks, one after the
    other.  A word of plain Latin letters and signs is cut into parts by the
    tokenizer's own pattern, and each new part goes through its model; any other
    word goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            steps = json.load(f)["pre_tokenizer"]["pretokenizers"]
        whole = Tokenizer.from_file(path)
        self.encode, self.model = whole.encode_batch_fast, whole.model.tokenize
        self.split = regex.compile(steps[0]["pattern"]["Regex"]).findall
        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        # beyond these, normal forms and letter cases take the tokenizer's own rules;
        # "<|" may begin a special token
        self.other = regex.compile("[\x00-\x20\x7f-\u00a0\u0130\u0300-\U0010ffff]|<\\|").search
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.held = 0

    def _ids(self, part: str) -> bytes:
        level = part if part.isascii() else self.as_bytes(part)[0][0]
        return array("I", [t.id for t in self.model(level)]).tobytes()

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            ids = self.parts[part] = self._ids(part)
            self.held += len(part) + len(ids) + _ENTRY_BYTES
        return ids

    def _forget(self) -> None:
        """Drop the newer half of all entries once they take too much; frequent ones came early."""
        if self.held <= CACHED_BYTES:
            return
        for cache in (self.known, self.parts):
            for k in list(itertools.islice(reversed(cache), len(cache) // 2)):
                del cache[k]
        self.held = sum(len(k) + len(v) + _ENTRY_BYTES for c in (self.known, self.parts) for k, v in c.items())

    def _learn(self, words: list[bytes]) -> None:
        known, rest = self.known, []
        for w in words:
            s = w.decode()
            if self.other(s):
                rest.append(w)
                continue
            s = s.lower()
            if s.isalpha():  # a part of its own: kept as a word, in lower case too
                low = s.encode()
                if low not in known:
                    known[low] = self._ids(s)
                    self.held += len(low) + len(known[low]) + _ENTRY_BYTES
                if low == w:
                    continue
                known[w] = known[low]
            else:
                known[w] = b"".join(map(self._part, self.split(s)))
            self.held += len(w) + len(known[w]) + _ENTRY_BYTES
        for lo in range(0, len(rest), 20_000):
            part = rest[lo:lo + 20_000]
            got = self.encode([w.decode() for w in part], add_special_tokens=False)
            known.update((w, array("I", e.ids).tobytes()) for w, e in zip(part, got))
            self.held += sum(len(w) + 4 * len(e.ids) + _ENTRY_BYTES for w, e in zip(part, got))

    def of(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [(t or "").encode().split() for t in texts]
        self._forget()
        self._learn(list(set().union(*split).difference(self.known)))
        ids = self.known.__getitem__
        out = [b"".join(map(ids, words)) for words in split]
        if sys.byteorder == "big":
            out = [np.frombuffer(x, ">u4").astype("<u4").tobytes() for x in out]
        return out


@functools.lru_cache(maxsize=1)
def word_ids(path: str | None) -> WordIds:
    import public_tokenizers

    return WordIds(path or public_tokenizers.path("word_bpe_49k.json"))


def pieces(docs: DataFrame, key: str = "doc_id", column: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID, tokenizer_path: str | None = None,
           with_ids: bool = False) -> DataFrame:
    """The pieces of every document; ``with_ids`` adds their ids as bytes."""
    fields = [docs.schema[key]] + [T.StructField(n, T.LongType()) for n in
                                   ("start", "length", "ids_crc32", "doc_tokens")]
    schema = T.StructType(fields + [T.StructField("ids", T.BinaryType())] * with_ids)
    last = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(tokenizer_path)
        for b in tx.slices(batches, "__text"):
            row, start, length, crc, total, ids = [], [], [], [], [], []
            for k, data in enumerate(encode.of(b.column("__text").to_pylist())):
                data = memoryview(data + last)
                for at in range(0, len(data), 4 * capacity):
                    part = data[at:at + 4 * capacity]
                    row.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(len(data) // 4)
                    if with_ids:
                        ids.append(bytes(part))
            cols = [b.column(0).take(pa.array(row, pa.int64()))]
            cols += [pa.array(c, pa.int64()) for c in (start, length, crc, total)]
            yield pa.RecordBatch.from_arrays(
                cols + [pa.array(ids, pa.binary())] * with_ids, names=schema.names)

    return docs.select(F.col(key), F.col(column).cast("string").alias("__text")).mapInArrow(run, schema)


def best_filling(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of ``counts``' lengths with the largest sum up to ``room``.

    Bit s of the bitset is set when some choice sums to s.  Each length enters in
    bundles of 1, 2, 4 ... pieces (the last bundle holds the remainder), so that
    any number of them can be chosen; the bitset before each bundle is kept, and
    the choice is read off backwards.
    """
    bits, limit, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in counts if x <= room and counts[x]), reverse=True):
        left, bundle = min(counts[length], room // length), 1
        while left:
            n = min(bundle, left)
            steps.append((bits, length, n))
            bits |= (bits << (length * n)) & limit
            left -= n
            bundle *= 2
        if bits >> room & 1:
            break
    total, chosen = bits.bit_length() - 1, {}
    for before, length, n in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + n
            total -= length * n
    return chosen


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Places for the pieces: rows ``length, first rank, pieces a sequence,
    first sequence, first offset``, ordered by length and rank."""
    left = {k: v for k, v in counts.items() if v}
    used = dict.fromkeys(left, 0)
    rows, sequence = [], 0
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = best_filling(left, capacity - longest)
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[k] // n for k, n in chosen.items())
        offset = 0
        for length, n in sorted(chosen.items(), reverse=True):
            rows.append((length, used[length], n, sequence, offset))
            offset += length * n
            used[length] += n * times
            left[length] -= n * times
            if not left[length]:
                del left[length]
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def ranked(cut: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """``rank`` of each piece among those of its length.

    A length's pieces are dealt to groups by hash, about ``RANKED_ROWS`` each, so
    a length that most pieces have is ranked by many tasks; a group begins where
    the groups before it end.
    """
    groups = max(1, -(-max(sizes.values(), default=1) // RANKED_ROWS))
    dealt = cut.withColumn("__g", F.pmod(F.xxhash64(*cut.columns), F.lit(groups)))
    own = Window.partitionBy("length", "__g").orderBy(*[c for c in cut.columns if c != "ids"])
    if groups == 1:
        return dealt.withColumn("rank", (F.row_number().over(own) - 1).cast("long")).drop("__g")
    starts = dealt.groupBy("length", "__g").count().select(
        F.col("length").alias("__l"), F.col("__g").alias("__h"),
        (F.sum("count").over(Window.partitionBy("length").orderBy("__g")) - F.col("count"))
        .alias("__first"))
    return (dealt.withColumn("__r", F.row_number().over(own) - 1)
            .join(starts, (F.col("length") == F.col("__l")) & (F.col("__g") == F.col("__h")))
            .withColumn("rank", F.col("__first") + F.col("__r"))
            .drop("__g", "__r", "__l", "__h", "__first"))


def place(rows: DataFrame, places: np.ndarray) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to ranked pieces.

    The plan goes along with the tasks: its size is bounded by the capacity.
    """
    names = [c for c in rows.columns if c != "rank"]
    schema = T.StructType([rows.schema[c] for c in names]
                          + [T.StructField(n, T.LongType()) for n in ("sequence_id", "offset")])
    order = places[:, 0] << 44 | places[:, 1] if len(places) else np.zeros(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = b.column("rank").to_numpy(zero_copy_only=False).astype(np.int64)
            at = places[np.searchsorted(order, length << 44 | rank, side="right") - 1]
            turn, slot = np.divmod(rank - at[:, 1], at[:, 2])
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in names] + [pa.array(at[:, 3] + turn, pa.int64()),
                                                pa.array(at[:, 4] + slot * length, pa.int64())],
                names=schema.names)

    return rows.mapInArrow(run, schema)


def pack(docs: DataFrame, key: str = "doc_id", column: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID, tokenizer_path: str | None = None,
         with_ids: bool = False) -> DataFrame:
    """Every piece with its sequence and its offset there.

    The texts are encoded once: the pieces are checkpointed before their lengths
    are counted.
    """
    cut = cut_lineage(pieces(docs, key, column, capacity, end_id, tokenizer_path, with_ids))
    sizes = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    return place(ranked(cut, sizes), plan(sizes, capacity))


def op6_packing(spark, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 2048 ids."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
