r"""Token counts by finite-state tokenizer compilation.

A byte-level BPE tokenizer is compiled to deterministic transducers whose transitions
carry how many tokens they emit:

* The *cutter* reads character classes and cuts a text into the pieces that merges
  never cross.  It has 13 states and looks ahead by cutting one character late.
* The *counter* reads the bytes of a piece.  A prefix of the piece ends in one certain
  token; its number of tokens is that of the text before this token, plus one.  So a
  state needs, for each suffix of what was read that may still grow into a token, only
  the last token before it and how many tokens that is short of the present count.  Which
  token follows another is settled by whether their merge trees, put side by side, would
  merge over the seam; last tokens that the same few longer tokens can follow are one
  context.  A transition emits the change of the count, which may be
  negative where a longer token replaces several.

Texts are cut into chunks of fixed size.  The cutter's chunks become maps of all its
states, run side by side, and the maps compose by a parallel prefix scan (each text begins
with a map that forgets the state before it); every chunk then knows its entry state
and cuts.  The counter starts afresh at each cut, so there its maps are constants; a
piece longer than a chunk is a chain of chunks, each run from the start state side
by side, whose map sends any other entry state along its own path until that meets the
path already run (at the end of the chunk at the latest), from where on counts agree.

The cutter's tables and the vocabulary's merge trees are compiled before texts are
read; the counter's states are compiled when first reached and kept in a table, which
is emptied when it has over ``STATES`` states.  Results do not depend on it.

Special tokens found in texts count as one token each and divide the text, as the
library does by default.  A null text counts as empty and has no tokens.  Repeated rows
are rows of their own; an empty table gives no rows.  Only the columns named are read.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import slices

CHUNK = 64        # characters of the cutter's chunks, bytes of the counter's
STATES = 1 << 17  # of the counter that are kept from block to block; a row of 1 KB each
BLOCK = 1 << 15   # bytes that the counter reads between looks at its table
FEW = 8           # tokens that may still grow, up to which contexts are told apart by them alone
LIMIT = 1024      # tokens of the query's flag

# --- The cutter -------------------------------------------------------------------
#: Character classes: others, letters, numbers, white space, the space, the apostrophe, and
#: the letters that end or begin a contraction ('s 't 'm 'd 're 've 'll).
OTHER, LETTER, NUMBER, WHITE, SPACE, QUOTE, SUFFIX, R_OR_V, L, E = range(10)
#: States, by the open piece: none, letters, numbers, others, a quote, a quote and r or v, a
#: quote and l, a contraction, one space, one other blank, blanks ending in a space or not.
NONE, LETTERS, NUMBERS, OTHERS, QUOTED, QUOTED_RV, QUOTED_L, SHORT, GAP, BLANK, GAPS, BLANKS = range(12)
CUTTER = 12
#: Marks on a transition: cut before this character, cut before the last one.
HERE, BEFORE = 1, 2
_OPENS = {OTHER: OTHERS, LETTER: LETTERS, NUMBER: NUMBERS, WHITE: BLANK, SPACE: GAP, QUOTE: QUOTED,
          SUFFIX: LETTERS, R_OR_V: LETTERS, L: LETTERS, E: LETTERS}
_LETTERS = (LETTER, SUFFIX, R_OR_V, L, E)


def _cutter_step(state: int, c: int) -> tuple[int, int]:
    """Next state and marks."""
    opened = (_OPENS[c], HERE)
    if state == NONE:
        return _OPENS[c], 0
    if state in (LETTERS, NUMBERS, OTHERS):
        same = {LETTERS: _LETTERS, NUMBERS: (NUMBER,), OTHERS: (OTHER, QUOTE)}[state]
        return (state, 0) if c in same else opened
    if state == QUOTED:
        after = {SUFFIX: SHORT, R_OR_V: QUOTED_RV, L: QUOTED_L, OTHER: OTHERS, QUOTE: OTHERS}
        return (after[c], 0) if c in after else opened
    if state in (QUOTED_RV, QUOTED_L):
        if c == (E if state == QUOTED_RV else L):
            return SHORT, 0
        to, marks = _cutter_step(LETTERS, c)
        return to, marks | BEFORE
    if state in (GAP, BLANK, GAPS, BLANKS) and c in (SPACE, WHITE):
        return (GAPS if c == SPACE else BLANKS), 0
    if state in (GAP, GAPS):
        joined = {OTHER: OTHERS, QUOTE: OTHERS, NUMBER: NUMBERS}.get(c, LETTERS)
        return joined, BEFORE if state == GAPS else 0
    return opened if state != BLANKS else (opened[0], HERE | BEFORE)


@functools.cache
def _cutter() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Next states and marks by class and state, and the class of each code point."""
    step = [[_cutter_step(s, c) for s in range(CUTTER)] for c in range(10)]
    to = np.array([[x[0] for x in row] for row in step], np.uint8)
    marks = np.array([[x[1] for x in row] for row in step], np.uint8)
    classes = np.full(0x110000, OTHER, np.uint8)
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, points):
            lo, hi = ord(points[m.start()]), ord(points[m.end() - 1])
            classes[lo:hi + 1] = kind
    for letters, kind in (("stmd", SUFFIX), ("rv", R_OR_V), ("l", L), ("e", E), (" ", SPACE), ("'", QUOTE)):
        classes[[ord(x) for x in letters]] = kind
    return to, marks, classes


def scan(maps: np.ndarray) -> np.ndarray:
    """Composition of each row's map after all maps of the rows before it."""
    maps, step = maps.copy(), 1
    while step < len(maps):
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step], 1)
        step *= 2
    return maps


def _points(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and where each begins."""
    at = np.flatnonzero((raw & 0xC0) != 0x80)
    b = np.concatenate([raw, np.zeros(3, np.uint8)])
    lead = b[at]
    point = lead.astype(np.int32)
    for least, bits, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        k = np.flatnonzero(lead >= least)
        if not len(k):
            break
        value = (lead[k] & bits).astype(np.int32)
        for j in range(1, more + 1):
            value = value << 6 | (b[at[k] + j] & 0x3F)
        point[k] = value
    return point, at


def cuts(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where pieces begin in the bytes of texts that begin at ``bounds`` (their end is last).

    Texts without bytes have no piece.
    """
    to, marks, classes = _cutter()
    point, at = _points(raw)
    kind = np.concatenate([classes[point], np.zeros(CHUNK, np.uint8)])
    first = np.unique(np.searchsorted(at, bounds))         # of each text that has any; the end
    size = np.diff(first)
    chunks = -(-size // CHUNK)
    head = np.cumsum(chunks) - chunks                      # the first chunk of each text
    begin = np.repeat(first[:-1] - head * CHUNK, chunks) + np.arange(chunks.sum()) * CHUNK
    left = np.minimum(np.repeat(first[1:], chunks) - begin, CHUNK)
    state = np.tile(np.arange(CUTTER, dtype=np.uint8), (len(begin), 1))
    state[head] = NONE                                     # a text forgets what was before it
    for k in range(CHUNK):
        live = np.flatnonzero(left > k)
        if not len(live):
            break
        c = kind[begin[live] + k]
        state[live] = to[c[:, None], state[live]]
    leave = scan(state)[:, NONE]
    now = np.concatenate([[NONE], leave[:-1]]).astype(np.uint8)
    now[head] = NONE
    cut = np.zeros(len(at) + 1, bool)
    for k in range(CHUNK):
        live = np.flatnonzero(left > k)
        if not len(live):
            break
        here = begin[live] + k
        c = kind[here]
        m = marks[c, now[live]]
        cut[here[m & HERE > 0]] = True
        cut[here[m & BEFORE > 0] - 1] = True
        now[live] = to[c, now[live]]
    last = leave[head + chunks - 1] if len(head) else leave
    cut[first[1:][(last == QUOTED_RV) | (last == QUOTED_L)] - 1] = True
    cut[first[:-1]] = True
    return at[np.flatnonzero(cut[:len(at)])]


# --- The counter ------------------------------------------------------------------
class Vocabulary:
    """Tokens of a byte-level BPE file with their merge trees, as a trie over bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cutting = spec["model"], spec["pre_tokenizer"] or {}
        if (model["type"], cutting.get("type"), cutting.get("use_regex"), cutting.get("add_prefix_space"),
                spec["normalizer"], model.get("ignore_merges")) != (
                "BPE", "ByteLevel", True, False, None, False) or model.get("dropout"):
            raise ValueError("only plain byte-level BPE is compiled")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take their surroundings are not compiled")
        self.specials = [t["content"] for t in spec["added_tokens"]]
        letters = self._alphabet()
        self.bytes = {t: bytes(letters[c] for c in t) for t in model["vocab"] if set(t) <= letters.keys()}
        rank, parts = {}, {}
        for k, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            rank[a, b] = k
            if parts.setdefault(a + b, (a, b)) != (a, b):
                raise ValueError("a token has two merges")
        names = sorted(self.bytes, key=model["vocab"].get)
        number = {t: i for i, t in enumerate(names)}
        #: Merge ranks by pair of numbers; per token its left and right spine, bottom-up, as
        #: (token, rank of the merge that takes it up).
        self.rank = {(number[a], number[b]): k for (a, b), k in rank.items()}
        self.left = [self._spine(t, parts, rank, number, 0) for t in names]
        self.right = [self._spine(t, parts, rank, number, 1) for t in names]
        self.child: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for t in names:
            if t not in parts or self.follows(number[parts[t][0]], number[parts[t][1]], rank[parts[t]]):
                node = 0
                for byte in self.bytes[t]:
                    if byte not in self.child[node]:
                        self.child[node][byte] = len(self.child)
                        self.child.append({})
                        self.token.append(-1)
                    node = self.child[node][byte]
                self.token[node] = number[t]
        if max(map(len, self.bytes.values())) > 128:
            raise ValueError("a token is too long for a transition's count")
        #: Tokens longer than a node's bytes that begin with them, if they are few.
        self.longer: list[list[int] | None] = [None] * len(self.child)
        for node in range(len(self.child) - 1, -1, -1):  # children come after their parent
            below = [(self.longer[k], [self.token[k]] if self.token[k] >= 0 else [])
                     for k in self.child[node].values()]
            if all(more is not None for more, _ in below) and sum(
                    len(more) + len(own) for more, own in below) <= FEW:
                self.longer[node] = [t for more, own in below for t in own + more]

    @staticmethod
    def _alphabet() -> dict[str, int]:
        """Byte of each character of the file: printable ones as they are, the rest from 256 on."""
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in plain]
        return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}

    @staticmethod
    def _spine(t, parts, rank, number, side):
        spine, over = [], 1 << 30
        while True:
            spine.append((number[t], over))
            if t not in parts:
                return spine[::-1]
            over = rank[parts[t]]
            t = parts[t][side]

    def follows(self, a: int, b: int, before: int = 1 << 30) -> bool:
        """Whether no merge of a rank under ``before`` joins tokens over the seam of a and b."""
        x, y = self.right[a], self.left[b]
        i = j = 0
        while True:
            (s, up), (t, over) = x[i], y[j]
            r = self.rank.get((s, t), before)
            if r < before and r < up and r <= over:
                return False
            if up <= over:
                if i + 1 == len(x):
                    return True
                i += 1
            elif j + 1 == len(y):
                return True
            else:
                j += 1


class Counter:
    """The counting transducer over bytes, compiled as it is reached."""

    def __init__(self, vocabulary: Vocabulary, states: int = STATES):
        self.v, self.most = vocabulary, states
        #: next state << 8 | emitted + 128; a byte read adds one state at most
        self.table = np.full((states + BLOCK, 256), -1, np.int32)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.contexts: dict[tuple[int, int], int | None] = {}
        self.alike: dict[tuple[int, tuple], int] = {}
        self.clear()

    def clear(self) -> None:
        """Forget all states but the start."""
        if getattr(self, "keys", None):
            self.table[:len(self.keys)] = -1
        #: A state: (trie node, last token before it, its count less the present one), longest first.
        self.keys = [((0, -1, 0),)]
        self.number = {self.keys[0]: 0}
        for known in (self.pairs, self.contexts, self.alike):
            known.clear()

    def _fits(self, a: int, b: int) -> bool:
        if a < 0:
            return True
        got = self.pairs.get((a, b))
        if got is None:
            got = self.pairs[a, b] = self.v.follows(a, b)
        return got

    def _context(self, node: int, before: int) -> int | None:
        """A token that stands for all after which the same tokens below the node fit; None if none does."""
        few = self.v.longer[node]
        if few is None:
            return before
        if (node, before) not in self.contexts:
            fit = tuple(self._fits(before, t) for t in few)
            self.contexts[node, before] = self.alike.setdefault((node, fit), before) if any(fit) else None
        return self.contexts[node, before]

    def compile(self, state: int, byte: int) -> int:
        """The table's entry for a transition."""
        v, grown, last, count = self.v, [], None, 0
        for node, before, less in self.keys[state]:
            to = v.child[node].get(byte)
            if to is None:
                continue
            if last is None and v.token[to] >= 0 and self._fits(before, v.token[to]):
                last, count = v.token[to], less + 1
            if (context := self._context(to, before)) is not None:
                grown.append((to, context, less))
        key = (*((to, before, less - count) for to, before, less in grown), (0, last, 0))
        n = self.number.get(key)
        if n is None:
            n = self.number[key] = len(self.keys)
            self.keys.append(key)
        entry = n << 8 | (count + 128)
        self.table[state, byte] = entry
        return entry

    def make_room(self, state: int = 0) -> int:
        """Empty the table if it is full, but for one state; its number."""
        if len(self.keys) <= self.most:
            return state
        held = self.keys[state]
        self.clear()
        if held not in self.number:
            self.number[held] = len(self.keys)
            self.keys.append(held)
        return self.number[held]

    def run(self, raw: np.ndarray, begin: np.ndarray, left: np.ndarray, paths: bool = False):
        """State and count after each stretch of at most ``CHUNK`` bytes, run side by side
        from the start; with ``paths`` also the state and count after each byte."""
        state, count = np.zeros(len(begin), np.int32), np.zeros(len(begin), np.int64)
        order = np.argsort(-left, kind="stable")
        begin, left = begin[order], left[order]
        path = np.zeros((2, CHUNK, len(begin)), np.int32) if paths else None
        flat = self.table.reshape(-1)
        for k in range(int(left[0]) if len(left) else 0):
            n = int(np.searchsorted(-left, -k))
            at = state[:n].astype(np.int64) * 256 + raw[begin[:n] + k]
            entry = flat[at]
            if (entry < 0).any():
                for x in np.unique(at[entry < 0]).tolist():
                    self.compile(x >> 8, x & 255)
                entry = flat[at]
            state[:n] = entry >> 8
            count[:n] += (entry & 255) - 128
            if paths:
                path[0, k], path[1, k] = state, count
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return state[back], count[back], path[:, :, back] if paths else None

    def chain(self, raw: np.ndarray, begin: int, end: int) -> int:
        """Tokens of one piece, chunk by chunk."""
        total, state, flat = 0, 0, self.table.reshape(-1)
        for lo in range(begin, end, BLOCK // 2):  # once from the start, once more at most
            state = self.make_room(state)
            at = np.arange(lo, min(end, lo + BLOCK // 2), CHUNK)
            left = np.minimum(end - at, CHUNK)
            states, counts, path = self.run(raw, at, left, paths=True)
            for c, (b, size) in enumerate(zip(at.tolist(), left.tolist())):
                if state == 0:
                    total, state = total + int(counts[c]), int(states[c])
                    continue
                for k, byte in enumerate(raw[b:b + size].tolist()):
                    entry = int(flat[state << 8 | byte])
                    if entry < 0:
                        entry = self.compile(state, byte)
                    total, state = total + (entry & 255) - 128, entry >> 8
                    if state == path[0, k, c]:  # from here on the paths agree
                        total, state = total + int(counts[c] - path[1, k, c]), int(states[c])
                        break
        return total

    def count(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each piece."""
        out = np.zeros(len(starts), np.int64)
        size = ends - starts
        short = np.flatnonzero(size <= CHUNK)
        block = np.cumsum(size[short]) // (BLOCK - CHUNK)
        for some in np.split(short, np.flatnonzero(np.diff(block)) + 1):
            self.make_room()
            out[some] = self.run(raw, starts[some], size[some])[1]
        for p in np.flatnonzero(size > CHUNK).tolist():
            out[p] = self.chain(raw, int(starts[p]), int(ends[p]))
        return out


@functools.lru_cache(2)
def compiled(path: str, states: int = STATES) -> Counter:
    return Counter(Vocabulary(path), states)


def count_tokens(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and tokens of each text."""
    counter = compiled(path)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    lo, hi = int(offsets[0]), int(offsets[-1])
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8, hi - lo, lo) if hi > lo else np.zeros(0, np.uint8)
    bounds = offsets - lo
    # Special strings divide texts and count once each.
    found = _special_spans(raw, bounds, tuple(counter.v.specials))
    total = np.zeros(len(raw) + 1, np.int64)
    starts = cuts(raw, np.unique(np.concatenate([bounds, found.reshape(-1)])))
    ends = np.concatenate([starts[1:], [len(raw)]])
    ends = ends[:len(starts)]
    special = np.isin(starts, found[:, 0])
    inside = np.zeros(len(raw) + 1, np.int32)
    np.add.at(inside, found[:, 0], 1)
    np.add.at(inside, found[:, 1], -1)
    part = (np.cumsum(inside)[starts] > 0) & ~special
    plain = ~special & ~part
    total[starts[special]] = 1
    total[starts[plain]] = counter.count(raw, starts[plain], ends[plain])
    total = np.concatenate([[0], np.cumsum(total[:-1])])
    return np.diff(bounds), total[bounds[1:]] - total[bounds[:-1]]


def _special_spans(raw: np.ndarray, bounds: np.ndarray, specials: tuple[str, ...]) -> np.ndarray:
    """[begin, end) of special strings, leftmost first; none goes over a text's end."""
    if not specials:
        return np.zeros((0, 2), np.int64)
    pattern = re.compile(b"|".join(re.escape(s.encode()) for s in specials))
    spans = np.array([m.span() for m in pattern.finditer(raw)], np.int64).reshape(-1, 2)
    if not len(spans):
        return spans
    crossing = np.searchsorted(bounds, spans[:, 0], "right") != np.searchsorted(bounds, spans[:, 1], "left")
    if crossing.any():  # the string arose where two texts meet: look text by text
        spans = np.array([(a + m.start(), a + m.end()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())
                          for m in pattern.finditer(raw[a:b].tobytes())], np.int64).reshape(-1, 2)
    return spans


def token_counts(docs: DataFrame, path: str, doc: str = "doc_id", text: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """Per row of ``docs``: its id, bytes, tokens and whether these exceed ``limit``."""
    schema = T.StructType([docs.schema[doc]] + [T.StructField(n, t) for n, t in (
        ("n_bytes", T.LongType()), ("n_tokens", T.LongType()), ("over_limit", T.BooleanType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "x"):
            size, tokens = count_tokens(b.column("x"), path)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size), pa.array(tokens), pa.array(tokens > limit)],
                names=schema.names)

    return docs.select(doc, F.col(text).cast("string").alias("x")).mapInArrow(run, schema)


def op11_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of all documents as byte_bpe_50k.json gives them."""
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
