r"""Repair of conversation structure by weighted CYK interval parsing.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles: an optional
system turn, then user and assistant in turn.  Edits of a turn are Keep (0; a
truncated turn that stays adds 5), Rerole to user or assistant (1) and Delete (2;
the only edit of blank and duplicate turns); an empty user or assistant turn may be
Inserted anywhere (5).  The cheapest edits win, ties by the least string of their
initials (the *audit*).

The grammar is in Chomsky normal form.  Its nonterminals are the shapes of what a
span of turns becomes: nothing, a system turn, or an alternation by its first and
last role, with or without a system turn before.  A cell has the least
(cost, audit) per shape.  Cells of single turns are closed under insertions at both
ends; a chart is then filled bottom-up by span length, each cell from all splits of
its span.  Shapes join without looking inside, so a chart's whole span is again an
item: charts over ``SPAN`` turns, then over ``SPAN`` such items and so on, as long as a
conversation is.  Two audits of one span and cost are never prefixes of one
another (more insertions cost more), so least parts make least wholes.

Turns are dealt by ranges of (conversation, turn): a conversation of any length is
parsed in slices, a cell table per slice, and only those tables meet.  Turns are
ordered by turn (nulls first), role and the digest of their text.  The digest of
the repaired conversation is sequential by definition: its turns pass sorted
through one task as a stream, after its audit, and none is held.

Conversations whose id is null are one conversation.  A null text is blank; a null
or empty role has no initial, so it cannot be kept; repeated rows are turns of their
own (and duplicates).  An empty table gives no rows.  Only the four columns named
are read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SPAN = 8        # items of a chart
SPACE = " \t\n\v\f\r"

#: Shapes: (system turn first?, first role, last role); () is a span that became nothing.
NOTHING, SYSTEM = (), ("s", "", "")
SHAPES = [NOTHING, SYSTEM] + [(s, a, b) for s in ("", "s") for a in "ua" for b in "ua"
                              if not (s and a == "a")]
WHOLE = [SHAPES.index(x) for x in (NOTHING, ("", "u", "a"), ("s", "u", "a"))]


def _joined(x: tuple, y: tuple) -> tuple | None:
    """The shape of one after the other, if there is one."""
    if not x or not y:
        return x or y
    if y[0] or (x[2] == y[1] or (x == SYSTEM and y[1] != "u")):
        return None
    return (x[0], x[1] or y[1], y[2])


RULES = [(i, j, SHAPES.index(z)) for i, x in enumerate(SHAPES) for j, y in enumerate(SHAPES)
         if (z := _joined(x, y)) in SHAPES]


def _best(cell: list, shape: int, cost: int, audit: str) -> None:
    if cell[shape] is None or (cost, audit) < cell[shape]:
        cell[shape] = (cost, audit)


def join_cells(parts: list[tuple]) -> tuple:
    """The cell of a span from (left cell, right cell) of each of its splits."""
    out = [None] * len(SHAPES)
    for left, right in parts:
        for i, j, z in RULES:
            if (x := left[i]) is not None and (y := right[j]) is not None:
                cost = x[0] + y[0]
                if out[z] is None or cost <= out[z][0]:
                    _best(out, z, cost, x[1] + y[1])
    return tuple(out)


def _inserted() -> tuple:
    """The cell of no turns: nothing, or inserted alternations."""
    cell = [None] * len(SHAPES)
    _best(cell, 0, 0, "")
    for first, last, k in (("u", "u", 1), ("a", "a", 1), ("u", "a", 2), ("a", "u", 2)):
        _best(cell, SHAPES.index(("", first, last)), INSERT * k, "I" * k)
    return tuple(cell)


EMPTY = _inserted()


@functools.cache
def turn_cell(kind: str) -> tuple:
    """Cell of one turn: its role's initial (``-``: none), in upper case (``_``) if it is
    truncated; ``x``: it must go."""
    cell = [None] * len(SHAPES)
    _best(cell, 0, DELETE, "D")
    if kind != "x":
        more = TRUNCATED * (kind in "SUA_")
        for role in "ua":
            at = SHAPES.index(("", role, role))
            _best(cell, at, REROLE + more, "R")
            if kind.lower() == role:
                _best(cell, at, more, "K")
        if kind.lower() == "s":
            _best(cell, SHAPES.index(SYSTEM), more, "K")
    alone = tuple(cell)
    left = join_cells([(EMPTY, alone)])
    return join_cells([(left, EMPTY)])


def chart(items: list[tuple]) -> tuple:
    """The cell of all items, over all spans by length."""
    n = len(items)
    cells = {(i, i + 1): c for i, c in enumerate(items)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            j = i + length
            cells[i, j] = join_cells([(cells[i, k], cells[k, j]) for k in range(i + 1, j)])
    return cells[0, n]


@functools.lru_cache(1 << 14)
def _turns_chart(kinds: str) -> tuple:
    return chart([turn_cell(k) for k in kinds])


def cells_of(items: list[tuple]) -> tuple:
    """One cell for a sequence of items, charts upon charts."""
    while len(items) > 1:
        items = [chart(items[i:i + SPAN]) for i in range(0, len(items), SPAN)]
    return items[0] if items else EMPTY


def parse(kinds: str) -> tuple:
    """The cell of a sequence of turns (see ``turn_cell``)."""
    return cells_of([_turns_chart(kinds[i:i + SPAN]) for i in range(0, len(kinds), SPAN)])


def cheapest(cell: tuple) -> tuple[int, str, bool]:
    """Cost and audit of the best whole conversation, and whether it has a system turn."""
    (cost, audit), shape = min((cell[w], w) for w in WHOLE if cell[w] is not None)
    return cost, audit, SHAPES[shape][:1] == ("s",)


def with_faults(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", dropped: str | None = None) -> DataFrame:
    """One narrow row per distinct (conv, turn, role, text): its copies, kind and first fault.

    ``dropped`` names a boolean column of rows that only make their conversation known.
    """
    said = F.coalesce(F.col(text), F.lit(""))
    ink = F.rtrim(said, F.lit(SPACE))
    gone = F.col(dropped) if dropped else F.lit(False)
    narrow = turns.select(
        F.col(conv).alias("c"), F.when(~gone, F.col(turn)).alias("t"),
        F.when(~gone, F.col(role)).alias("r"),
        F.when(~gone, F.unhex(F.sha2(said, 256))).alias("h"), gone.alias("gone"),
        (ink == "").alias("blank"), (~F.right(ink, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    rows = narrow.groupBy("c", "t", "r", "h", "gone").agg(
        F.count(F.lit(1)).alias("copies"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    first = rows.where("NOT gone").groupBy("c", "r", "h").agg(
        F.min(F.struct(F.col("t").isNotNull().alias("known"), "t")).alias("f")).select(
        F.col("c").alias("c1"), F.col("f.t").alias("t1"), F.col("r").alias("r1"), F.col("h").alias("h1"))
    same = [rows[a].eqNullSafe(first[f"{a}1"]) for a in "ctrh"]
    return (rows.join(first, same, "left")
            .withColumn("again", F.col("h1").isNull() & ~F.col("gone")).drop("c1", "t1", "r1", "h1"))


_CELL = "cost array<long>, audit array<string>"
_SLICE = ("part int, n long, blank long, duplicate long, truncated long, illegal long, "
          "first string, last string, lo long, hi long, turns long, " + _CELL)
_LEGAL = {"su", "ua", "au"}


class _Slice:
    """The turns of one conversation that one task has, as they stream past in order."""

    def __init__(self):
        self.kinds, self.faults = [], [0, 0, 0]
        self.n = self.illegal = self.turns = 0
        self.first = self.last = self.lo = self.hi = None

    def add(self, turn, role, blank, again, cut):
        initial = (role or "-")[0]
        self.n += 1
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in _LEGAL
        self.last = initial
        if turn is not None:
            self.turns += turn != self.hi
            self.lo, self.hi = turn if self.lo is None else self.lo, turn
        fault = 0 if blank else 1 if again else 2 if cut else None
        if fault is not None:
            self.faults[fault] += 1
        known = initial if initial in "sua" else "-"
        self.kinds.append("x" if fault in (0, 1) else
                          known.upper().replace("-", "_") if fault == 2 else known)

    def row(self, conv, part):
        cell = parse("".join(self.kinds))
        return (conv, part, self.n, *self.faults, self.illegal, self.first, self.last, self.lo,
                self.hi, self.turns, [None if x is None else x[0] for x in cell],
                [None if x is None else x[1] for x in cell])


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema
    wanted = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), wanted)], schema=wanted)


def slices(rows: DataFrame) -> DataFrame:
    """Per conversation and range of turns, its counts and its cell."""
    schema = T.StructType(
        [T.StructField("c", rows.schema["c"].dataType)]
        + T._parse_datatype_string(_SLICE).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, state, done = TaskContext.get().partitionId(), None, None, []
        for b in batches:
            for c, t, r, gone, blank, cut, again, copy in zip(*(x.to_pylist() for x in b.columns)):
                if state is None or c != now:
                    if state is not None:
                        done.append(state.row(now, part))
                    now, state = c, _Slice()
                if not gone:
                    state.add(t, r, blank, again or copy > 1, cut)
            if done:
                yield _batch(done, schema)
                done = []
        if state is not None:
            yield _batch([state.row(now, part)], schema)

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies")
    keys = ["c", "t", "r", "h", "copy"]
    ordered = each.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    return ordered.select("c", "t", "r", "gone", "blank", "cut", "again", "copy").mapInArrow(run, schema)


def repairs(rows: DataFrame) -> DataFrame:
    """Per conversation its counts, cost, audit and whether a system turn stays first."""
    parts = slices(rows)
    schema = T.StructType([parts.schema["c"]] + T._parse_datatype_string(
        "n long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
        "audit string, system boolean").fields)

    def whole(c, found):
        found = sorted(found, key=lambda s: s["part"])
        some = [s for s in found if s["n"]]
        illegal = sum(s["illegal"] for s in some) + sum(
            a["last"] + b["first"] not in _LEGAL for a, b in zip(some, some[1:]))
        timed = [s for s in some if s["lo"] is not None]
        turns = sum(s["turns"] for s in timed) - sum(
            a["hi"] == b["lo"] for a, b in zip(timed, timed[1:]))
        gaps = timed[-1]["hi"] - timed[0]["lo"] + 1 - turns if timed else 0
        cost, audit, system = cheapest(cells_of(
            [tuple(None if x is None else (x, a) for x, a in zip(s["cost"], s["audit"]))
             for s in some]))
        return (c, sum(s["n"] for s in some), gaps, *(sum(s[k] for s in some) for k in (
            "blank", "duplicate", "truncated")), illegal, cost, audit, system)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                b = batch.slice(at, 1000)
                yield _batch([whole(c, s) for c, s in zip(b.column(0).to_pylist(),
                                                          b.column(1).to_pylist())], schema)

    together = parts.groupBy("c").agg(F.collect_list(F.struct(
        *[x for x in parts.columns if x != "c"])).alias("s"))
    return together.mapInArrow(run, schema)


class _Repair:
    """A conversation's repaired lines, hashed as its turns stream past."""

    def __init__(self, audit: str, system: bool):
        self.audit, self.at, self.out, self.skip = audit, 0, 0, int(system)
        self.sha = hashlib.sha256()

    def role(self) -> str:
        return "assistant" if (self.out - self.skip) % 2 else "user"

    def line(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.out else ''}{role}:{text}".encode())
        self.out += 1

    def inserts(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.line(self.role(), "")
            self.at += 1

    def add(self, role, text) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self.line((role or "") if edit == "K" else self.role(), text or "")


def repaired_digests(found: DataFrame, turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                     role: str = "role", text: str = "text") -> DataFrame:
    """``found`` of ``repairs`` with the digest of each repaired conversation.

    The audit of a conversation comes first, then its turns in the order of the parse.
    """
    h = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    heads = found.select("c", F.lit(0).alias("o"), F.lit(None).cast("long").alias("t"),
                         F.lit(None).cast("string").alias("r"), F.lit(None).cast("binary").alias("h"),
                         F.lit(None).cast("string").alias("x"), F.struct(
                             *[k for k in found.columns if k != "c"]).alias("found"))
    rows = turns.select(F.col(conv).alias("c"), F.lit(1).alias("o"),
                        F.col(turn).cast("long").alias("t"), F.col(role).alias("r"), h.alias("h"),
                        F.col(text).alias("x"),
                        F.lit(None).cast(heads.schema["found"].dataType).alias("found"))
    keys = ["o", "t", "r", "h"]
    ordered = heads.unionByName(rows).repartition("c").sortWithinPartitions("c", *keys)
    schema = T.StructType(found.schema.fields + [T.StructField("repaired_sha256", T.StringType())])
    names = [k for k in found.columns if k != "c"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, head, state, done = None, None, None, []

        def row():
            state.inserts()
            return (now, *(head[k] for k in names), state.sha.hexdigest())

        for b in batches:
            for c, o, r, x, f in zip(*(b.column(k).to_pylist() for k in ("c", "o", "r", "x", "found"))):
                if o == 0:
                    if state is not None:
                        done.append(row())
                    now, head, state = c, f, _Repair(f["audit"], f["system"])
                else:
                    state.add(r, x)
            if done:
                yield _batch(done, schema)
                done = []
        if state is not None:
            yield _batch([row()], schema)

    return ordered.mapInArrow(run, schema)


def damage(turns: DataFrame) -> DataFrame:
    """Faults planted by a hash of conversation and turn; ``dropped`` rows are marked."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    what = turns.select("conv_id", "turn", "role", "text",
                        (F.crc32(key.cast("binary")) % 20).cast("int").alias("__what"))
    return what.select(
        "conv_id", "turn",
        F.when(F.col("__what") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("__what") == 1, F.lit(""))
        .when(F.col("__what") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("__what") == 0).alias("dropped"),
        F.explode(F.when(F.col("__what") == 3, F.array(F.lit(1), F.lit(2)))
                  .otherwise(F.array(F.lit(1)))).alias("__copy")).drop("__copy")


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """Damage all conversations, parse them, and return counts, cost, audit and digest."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    hurt = damage(turns)
    found = repairs(with_faults(hurt, dropped="dropped"))
    out = repaired_digests(found, hurt.where("NOT dropped"))
    return out.select(F.col("c").alias("conv_id"), "gaps", "blank", "duplicate", "truncated",
                      "illegal", "cost", "audit", "repaired_sha256")
