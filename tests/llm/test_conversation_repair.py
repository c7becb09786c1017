"""Conversation repair against all edits tried."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from stellate.llm import conversation_repair as cr
from stellate.llm.conversation_repair import Chunks, damaged, repair_conversations, with_digest

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
RIGHT = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for c, t, r, x in rows:
        known = lambda v: " " if v is None else str(v)
        fault = zlib.crc32(f"{known(c)}:{known(t)}".encode()) % 20
        r, x = known(r), known(x)
        if fault == 0:
            continue
        x = "" if fault == 1 else re.sub("[.!?]", "", x) if fault == 2 else x
        r = "user" if fault == 4 else r
        out += [(c, t, r, x)] * (2 if fault == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, r, x in rows:
        end = x.rstrip(SPACE)[-1:]
        out.append("blank" if not end else "duplicate" if (r, x) in seen else "truncated" if end not in ".!?" else "")
        seen.add((r, x))
    return out


def cheapest(rows):
    """The least (cost, audit) over all edits, found from the end; with it the
    repaired turns.  States are the letters that the rest must begin with."""
    found = faults(rows)
    n = len(rows)

    def step(state, initial):            # state: "" start, "s", "u", "a"
        want = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        return initial if initial and initial in want else None

    best = {}
    for i in range(n, -1, -1):
        for _ in range(3):               # insertions refer to the same place
            for state in ("", "s", "u", "a"):
                ways = []
                if i == n and state in ("", "a"):
                    ways.append((0, "", ()))
                for role in ("user", "assistant"):
                    to = step(state, role[0])
                    if to and (i, to) in best:
                        c, a, t = best[i, to]
                        ways.append((c + 3, "I" + a, ((role, ""), *t)))
                if i < n:
                    r, x = rows[i][2], rows[i][3]
                    if (i + 1, state) in best:
                        c, a, t = best[i + 1, state]
                        ways.append((c + 4, "D" + a, t))
                    if found[i] not in ("blank", "duplicate"):
                        more = 3 if found[i] == "truncated" else 0
                        for letter, price, role in (("K", 0, r), ("R", 3, "user"), ("R", 3, "assistant")):
                            to = step(state, role[:1])
                            if to and (i + 1, to) in best:
                                c, a, t = best[i + 1, to]
                                ways.append((c + price + more, letter + a, ((role, x), *t)))
                if ways:
                    best[i, state] = min(ways + ([best[i, state]] if (i, state) in best else []))
    return best[0, ""]


def expected(rows):
    out = {}
    for c in {r[0] for r in rows}:
        mine = sorted((r for r in damage(rows) if r[0] == c),
                      key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        found = faults(mine)
        cost, audit, turns = cheapest(mine) if mine else (0, "", ())
        numbers = [r[1] for r in mine if r[1] is not None]
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(mine, mine[1:])]
        out[c] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
                  *(found.count(f) for f in ("blank", "duplicate", "truncated")),
                  sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                  hashlib.sha256("\n".join(f"{r}:{x}" for r, x in turns).encode()).hexdigest())
        assert RIGHT.fullmatch("".join(r[:1] for r, _ in turns))
    return out


def result(df):
    cols = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    return {r["conv"]: tuple(r[c] for c in cols) for r in df.collect()}


def make_rows(seed, n, most=9):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "unknown", "User"]
    texts = ["Yes.", "No!", "why", "a b. ", " \t", "", None, "Hm?\n", "ça va.", "x" * 50, "Ja.", "Nein"]
    rows = []
    for c in range(n):
        for t in range(rng.randrange(most)):
            turn = None if rng.random() < 0.05 else rng.choice([t, t, t, t + 5, -1])
            rows.append((None if c == 3 else c, turn, rng.choice(roles[:rng.choice([3, 5, 10])]),
                         rng.choice(texts) if rng.random() < 0.7 else f"Text {t}{rng.choice('.!?x')}"))
    return rows


def test_against_all_edits(spark):
    rows = make_rows(1, 300)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(with_digest(repair_conversations(damaged(df)))) == {
        k: v for k, v in expected(rows).items() if any(r[0] == k for r in damage(rows))}


@pytest.mark.parametrize("chunk", [1, 3])
def test_chunks_change_nothing(spark, chunk):
    """Conversations of up to 40 turns cut into chunks of one and three."""
    rows = damage(make_rows(2, 40, 40))
    want = {k: v for k, v in expected_undamaged(rows).items()}
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert result(with_digest(repair_conversations(df, chunk=chunk))) == want


def expected_undamaged(rows):
    global damage
    kept, damage = damage, lambda r: r
    try:
        return expected(rows)
    finally:
        damage = kept


def test_least_audit_by_exhaustion():
    """The solver against every edit sequence, over all short conversations."""
    codes = [chr(65 + 3 * k + s) for k in range(4) for s in range(3)]
    for size in (0, 1, 2):
        for code in map("".join, itertools.product(codes, repeat=size)):
            ways = {}
            letters = [("K", "R", "D")] * size
            for pick in itertools.product(*letters):
                for ins in itertools.product(("", "I", "II"), repeat=size + 1):
                    roles, cost, ok, audit = [""], 0, True, ""
                    for i in range(size + 1):
                        audit += ins[i]
                        cost += 3 * len(ins[i])
                        roles = [r + "?" * len(ins[i]) for r in roles]
                        if i == size:
                            break
                        kind, state = divmod(ord(code[i]) - 65, 3)
                        audit += pick[i]
                        if pick[i] == "D":
                            cost += 4
                        else:
                            ok &= state != 2
                            cost += 3 * (state == 1) + 3 * (pick[i] == "R")
                            roles = [r + ("?" if pick[i] == "R" else "suao"[kind]) for r in roles]
                    fits = ok and any(len(roles[0]) == len(p) and all(a == b or (a == "?" and b in "ua")
                                                                      for a, b in zip(roles[0], p))
                                      for p in ("", "ua", "uaua", "uauaua", "uauauaua", "sua", "suaua", "suauaua"))
                    if fits:
                        ways[cost, audit] = True
            found = Chunks([code], cr.DONE[None, :], np.array([True])).audits()[0][0]
            assert found[:2] == min(ways), code


def test_empty_extra_columns_and_one_long_conversation(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert result(with_digest(repair_conversations(damaged(empty)))) == {}
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", f"t{t}.") for t in range(9000)] + [(8, 0, "user", None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS idx", "2 AS conv", "3 AS chunk", "4 AS __fault")
    fixed = repair_conversations(df)
    found = result(with_digest(fixed))
    assert found[7][5:7] == (0, "K" * 9000) and found[8][5:7] == (4, "D")
    assert found[7][7] == hashlib.sha256("\n".join(f"{r[2]}:{r[3]}" for r in rows[:-1]).encode()).hexdigest()
    assert fixed.turns.where("conv = 7").count() == 9000
