"""Conversation repair against enumeration, a left-to-right form and plain Python."""

import hashlib
import itertools
import random
import zlib

import pytest

from lacuna.llm import turn_repair as R


def enumerated(kinds):
    """Least (cost, audit) over all edits with at most two insertions in each gap."""
    best = None
    choices = [["x"] if k == "x" else ["K", "Ru", "Ra", "x"] for k in kinds]
    gaps = [()] + [(a,) for a in "ua"] + [(a, b) for a in "ua" for b in "ua"]
    for edits in itertools.product(*choices):
        for ins in itertools.product(gaps, repeat=len(kinds) + 1):
            cost, audit, out = 0, "", ""
            for k in range(len(kinds) + 1):
                cost, audit, out = cost + 5 * len(ins[k]), audit + "I" * len(ins[k]), out + "".join(ins[k])
                if k == len(kinds):
                    break
                e = edits[k]
                if e == "x":
                    cost, audit = cost + 2, audit + "D"
                    continue
                cost += 5 * (kinds[k] in "SUA_") + (e != "K")
                audit += e[0]
                out += kinds[k].lower() if e == "K" else e[1]
            rest = out[1:] if out[:1] == "s" and len(out) > 1 else out
            if rest == "ua" * (len(rest) // 2) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def left_to_right(kinds):
    """Least (cost, audit) by states of the automaton: 0 start, 1 after s, 2 after u, 3 after a."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def closed(cells):
        for _ in range(3):
            for q, (c, a) in list(cells.items()):
                for r in "ua":
                    if (q, r) in step:
                        to, new = step[q, r], (c + 5, a + "I")
                        cells[to] = min(cells.get(to, new), new)
        return cells

    cells = closed({0: (0, "")})
    for k in kinds:
        new = {}

        def put(q, v):
            new[q] = min(new.get(q, v), v)

        more = 5 * (k in "SUA_")
        for q, (c, a) in cells.items():
            put(q, (c + 2, a + "D"))
            if k != "x":
                for r in "ua":
                    if (q, r) in step:
                        put(step[q, r], (c + 1 + more, a + "R"))
                if (q, k.lower()) in step:
                    put(step[q, k.lower()], (c + more, a + "K"))
        cells = closed(new)
    return min(v for q, v in cells.items() if q in (0, 3))


@pytest.mark.parametrize("n", [0, 1, 2])
def test_equals_enumeration(n):
    for kinds in itertools.product("suaSUA-_x", repeat=n):
        assert R.cheapest(R.parse("".join(kinds)))[:2] == enumerated(kinds), kinds


def test_equals_left_to_right():
    rng = random.Random(5)
    for n in [3, 4, 5, 7, 8, 9, 15, 16, 17, 40, 64, 65, 130, 513]:
        for _ in range(12):
            kinds = "".join(rng.choices("suaSUA-_x", [1, 5, 5, 1, 2, 2, 1, 1, 2], k=n))
            assert R.cheapest(R.parse(kinds))[:2] == left_to_right(kinds), kinds


def brute(rows):
    """The query's rows from (conv_id, turn, role, text), by plain Python."""
    out = {}
    for c, t, r, x in rows:
        kept = out.setdefault(c, [])
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        what = zlib.crc32(key.encode()) % 20
        if what == 0:
            continue
        x = "" if what == 1 else "".join(k for k in x if k not in ".!?") if what == 2 and x else x
        kept += [(t, "user" if what == 4 else r, x)] * (2 if what == 3 else 1)
    found = []
    for c, kept in out.items():
        digest = lambda x: hashlib.sha256((x or "").encode()).digest()
        kept.sort(key=lambda k: (k[0] is not None, k[0] or 0, k[1] is not None, k[1] or "", digest(k[2])))
        seen, kinds, faults, initials = set(), "", [0, 0, 0], []
        for _, r, x in kept:
            ink = (x or "").strip(" \t\n\v\f\r")
            first = (r or "-")[0]
            initials.append(first)
            known = first if first in "sua" else "-"
            if not ink:
                faults[0] += 1
                kinds += "x"
            elif (r, x) in seen:
                faults[1] += 1
                kinds += "x"
            elif ink[-1] not in ".!?":
                faults[2] += 1
                kinds += "_" if known == "-" else known.upper()
            else:
                kinds += known
            seen.add((r, x))
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = left_to_right(kinds)
        lines, at = [], 0
        for e in audit:
            skip = bool(lines) and lines[0][0].startswith("s")
            role = "assistant" if (len(lines) - skip) % 2 else "user"
            if e == "I":
                lines.append((role, ""))
                continue
            _, r, x = kept[at]
            at += 1
            if e != "D":
                lines.append((r if e == "K" else role, x))
        text = "\n".join(f"{r}:{x}" for r, x in lines)
        found.append((c, gaps, *faults, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(found, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
           "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert of(R.op12_conversation_repair(spark, sf_small)) == brute(rows)


def test_odd_conversations(spark, as_table):
    rng = random.Random(9)
    texts = [None, "", " \t\n", "Well.", "Well.  \n", "no end", "Why?", "è!\u0085", "Well.", "so. " * 9000]
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "tool", "User"]
    rows = [(rng.choice([1, 2, 3, None]), rng.choice([None, *range(-3, 9)]), rng.choice(roles),
             rng.choice(texts)) for _ in range(120)]
    rows += [(7, k, "user" if k % 2 == 0 else "assistant", f"Line {k}.") for k in range(700)]
    rows += [(8, 3, "user", "Hi.")] * 30 + [(9, None, "system", "Alone.")]
    rows += [(c, 0, "system", "Dropped.") for c in range(100, 160)]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows],
                               SCHEMA + ", c string, cost string").repartition(5)
    assert of(R.op12_conversation_repair(spark, as_table(conversations=df))) == brute(rows)


def test_empty_table(spark, as_table):
    folder = as_table(conversations=spark.createDataFrame([], SCHEMA))
    assert R.op12_conversation_repair(spark, folder).count() == 0
