"""Cheapest repair of the structure of conversations, ties by the least audit.

A conversation should be an optional system turn and then pairs of a user's and
an assistant's turn.  Its turns are read in order (turn numbers, nulls first;
turns of one number by role, then text).  A turn's first fault counts:

* blank: its text has no character but white space;
* duplicate: the same role and text stood earlier in the conversation;
* truncated: its last such character is none of ``.!?``.

The edits, one letter each in the audit: ``K`` keep (0), ``R`` give the turn the
role user or assistant (3), ``D`` delete (4; blank and duplicate turns must go),
``I`` insert an empty turn of user or assistant (3).  A truncated turn that stays
adds 3.  Of the cheapest edits those with the least audit in ASCII order are
taken.

Method.  A node is a place between two turns and what the roles kept so far allow
next (four states).  The cost from each node to the end is found by dynamic
programming from the last turn; the arcs that keep to it are the optimal ones.
A state takes just one role of user and assistant, so a node has at most one
optimal arc a letter, and the least path of a given length ends in one node.
The nodes are ranked by prefix doubling: by their least letter, then by the
first 2, 4, 8, ... letters of their least path, each round pairing a node's rank
with the rank of the node that its pointer leads to, and doubling the pointers.
The ranks choose the arc of every node, and an audit is read off at all its
places at once through the doubled pointers.

Long conversations are cut into chunks of ``CHUNK`` turns, each a row of one
character a turn.  Where there are several, a chunk is first summed up as the
least costs between its states (a 4 x 4 matrix); the matrices of a conversation,
a 4,096th of its turns, give each chunk the cost of what follows it.  So no task
holds more than a chunk of texts, and the hash of a repaired conversation is made
turn by turn.  Duplicates are found by an aggregate on conversation, role and the
text's SHA-256, joined back on the turn's place.

Defined results: null role or text: one blank; rows without a conversation id are
one conversation; a null turn number comes first and is left out of ``gaps``;
rows that repeat are turns of their own; an empty table gives empty results.
Texts are read whole, and columns other than the four named are left out.  SQL
has no form for the choice of edits: the tests compare with all edits tried.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.llm.common import WORD_RE, col, fresh, ship, stored
from stellate.llm.conversations import CHUNK, hashed_in_order, ordered_turns, same

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: What may follow: the start; after a system turn; after a user's; after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after the one role of user and assistant that a state takes.
NEXT = np.array([USER, USER, ASSISTANT, USER])
FAR = np.int64(1) << 60
LETTERS = "\0DIKR"
#: Classes of first letters of a role, and the state that keeping such a turn leads to (-1: none).
CLASSES = "sua"
KEPT = np.array([[SYSTEM, -1, -1, -1], [USER, USER, -1, USER], [-1, -1, ASSISTANT, -1], [-1, -1, -1, -1]])
#: A turn's character: 'A' + 3 x class + (0 sound, 1 truncated, 2 must go).
SOUND, CUT, GONE = range(3)


@dataclass
class Repair:
    """``report``: one row a conversation; ``turns``: the repaired turns with
    their order (chunk, step), edit, role and text."""

    report: DataFrame
    turns: DataFrame


def _closed(v: np.ndarray) -> np.ndarray:
    """Least costs when turns may be inserted first; columns are states."""
    out = v.copy()
    out[..., USER] = np.minimum(v[..., USER], INSERT + v[..., ASSISTANT])
    for s in (START, SYSTEM, ASSISTANT):
        out[..., s] = np.minimum(v[..., s], INSERT + out[..., USER])
    return np.minimum(out, FAR)


def _back(code: np.ndarray, after: np.ndarray):
    """Least costs before a turn from those after it, without insertions, and
    the costs of each edit: (n, 4), and keep, rerole, delete of (n, 4)."""
    kind, state = code // 3, code % 3
    stay = np.where(state == CUT, TRUNCATED, 0)[:, None]
    gone = (state == GONE)[:, None]
    target = KEPT[kind]
    keep = np.where((target >= 0) & ~gone, np.take_along_axis(after, np.maximum(target, 0), 1) + stay + KEEP, FAR)
    rerole = np.where(gone, FAR, after[:, NEXT] + stay + REROLE)
    delete = after + DELETE
    best = np.minimum(np.minimum(keep, rerole), np.minimum(delete, FAR))
    return best, keep, rerole, delete


class Chunks:
    """Chunks of turns, solved side by side.  ``codes``: their characters;
    ``tail``: costs of what follows a chunk (n, 4); ``final``: whether a chunk is
    its conversation's last, where turns may be inserted at the end too."""

    def __init__(self, codes: list[str], tail: np.ndarray, final: np.ndarray):
        self.size = np.array([len(c) for c in codes], dtype=np.int64)
        # Longest first: the chunks that still have turns are a head of the array.
        self.order = np.argsort(-self.size, kind="stable")
        self.first = np.zeros(len(codes), dtype=np.int64)
        np.cumsum(self.size[:-1] + 1, out=self.first[1:])
        self.code = np.zeros(int((self.size + 1).sum()), dtype=np.int64)
        flat = np.frombuffer("".join(codes).encode("ascii"), np.uint8).astype(np.int64) - ord("A")
        inside = np.ones(len(self.code), dtype=bool)
        inside[self.first + self.size] = False
        self.code[inside] = flat
        self.inside, self.final = inside, final
        self.cost = np.full((len(self.code), 4), FAR)
        self.cost[self.first + self.size] = np.where(final[:, None], _closed(tail), tail)
        longest = int(self.size.max(initial=0))
        by_size = -self.size[self.order]
        for step in range(1, longest + 1):
            n = np.searchsorted(by_size, -step, side="right")
            at = self.first[self.order[:n]] + self.size[self.order[:n]] - step
            self.cost[at] = _closed(_back(self.code[at], self.cost[at + 1])[0])

    def audits(self):
        """For every chunk and state that it is entered in: (cost, audit, state
        at its end), None where there is no way."""
        n = len(self.code) * 4
        place, state = np.divmod(np.arange(n), 4)
        cost = self.cost.ravel()
        targets = np.full((len(LETTERS), n), -1, dtype=np.int64)
        inside = self.inside[place]
        after = np.full((len(self.code), 4), FAR)
        after[:-1] = self.cost[1:]
        _, keep, rerole, delete = _back(self.code, after)
        there = inside & (cost < FAR)
        kept = KEPT[self.code // 3].ravel()
        for letter, price, to in ((1, delete, state), (3, keep, kept), (4, rerole, NEXT[state])):
            on = there & (price.ravel() == cost)
            targets[letter, on] = (place[on] + 1) * 4 + to[on]
        may = inside.copy()
        ends = (self.first + self.size)[self.final]
        may[(ends[:, None] * 4 + np.arange(4)).ravel()] = True
        on = may & (cost < FAR) & (cost[place * 4 + NEXT[state]] + INSERT == cost)
        targets[2, on] = place[on] * 4 + NEXT[state[on]]
        return self._ranked(targets, cost)

    def _ranked(self, targets: np.ndarray, cost: np.ndarray):
        n = targets.shape[1]
        has = targets >= 0
        least = np.where(has.any(0), has.argmax(0), 0)      # the least letter; 0 at an end
        here = np.arange(n)
        # Prefix doubling: rank by 1, 2, 4, ... letters of the least path.
        rank, jump, steps = least.copy(), np.where(least > 0, targets[least, here], here), (least > 0).astype(np.int64)
        while True:
            on = jump[jump]
            if np.array_equal(on, jump):
                break
            pair = rank * (int(rank.max()) + 1) + rank[jump]
            rank = np.unique(pair, return_inverse=True)[1]
            steps = steps + steps[jump]
            jump = on
        # The ranks choose each node's arc: the least letter, then the least rest.
        span = int(rank.max(initial=0)) + 1
        worth = np.where(has, np.arange(len(LETTERS))[:, None] * span + rank[np.maximum(targets, 0)], len(LETTERS) * span)
        arc = worth.argmin(0)
        double = [np.where(least > 0, targets[arc, here], here)]
        letter = np.where(least > 0, arc, 0)
        starts = (self.first[:, None] * 4 + np.arange(4)).ravel()
        length = steps[starts]
        while (1 << len(double)) <= int(length.max(initial=0)):
            double.append(double[-1][double[-1]])
        node = np.repeat(starts, length)
        offset = np.arange(len(node)) - np.repeat(np.cumsum(length) - length, length)
        for k, pointer in enumerate(double):
            move = (offset >> k) & 1 == 1
            node[move] = pointer[node[move]]
        text = np.array([ord(c) for c in LETTERS], dtype=np.uint8)[letter[node]].tobytes().decode("ascii")
        bounds = np.r_[0, np.cumsum(length)]
        found = []
        for i, s in enumerate(starts):
            found.append(None if cost[s] >= FAR else
                         (int(cost[s]), text[bounds[i]:bounds[i + 1]], int(jump[s] % 4)))
        return [found[i:i + 4] for i in range(0, len(found), 4)]


#: The costs after a whole conversation: it may end at its start or after an assistant's turn.
DONE = np.array([0, FAR, FAR, 0])


def _matrices(batches):
    """Chunk -> least costs from each state before it to each state after it."""
    for batch in batches:
        codes = batch.column(2).to_pylist()
        columns = []
        for state in range(4):
            tail = np.full((len(codes), 4), FAR)
            tail[:, state] = 0
            # Turns may not be inserted at the end: they belong to the next chunk.
            chunks = Chunks(codes, tail, np.zeros(len(codes), dtype=bool))
            columns.append(chunks.cost[chunks.first])
        matrix = np.stack(columns, 2).reshape(len(codes), 16)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(list(matrix), pa.list_(pa.int64()))],
            names=["conv", "chunk", "m"])


def _tails(table: pa.Table) -> pa.Table:
    """The costs of what follows each chunk of one conversation."""
    table = table.sort_by("chunk")
    matrices = np.array(table.column("m").to_pylist(), dtype=np.int64).reshape(-1, 4, 4)
    tails, now = [], _closed(DONE)
    for k in range(len(matrices) - 1, -1, -1):
        tails.append(DONE if k == len(matrices) - 1 else now)
        end = _closed(DONE) if k == len(matrices) - 1 else now
        now = np.minimum((matrices[k] + end[None, :]).min(1), FAR)
    tails.reverse()
    return pa.table({"conv": table.column("conv"), "chunk": table.column("chunk"),
                     "tail": pa.array([list(map(int, t)) for t in tails], pa.list_(pa.int64()))})


def _audits(batches):
    """(conv, chunk, codes, tail or null, last) -> the audit of each chunk for
    each state that it may be entered in."""
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = batch.column(2).to_pylist()
        tail = np.array([DONE if t is None else t for t in batch.column(3).to_pylist()], dtype=np.int64)
        final = batch.column(4).to_numpy(zero_copy_only=False).astype(bool)
        rows, states, costs, audits, ends = [], [], [], [], []
        number = batch.column(1).to_pylist()
        for i, ways in enumerate(Chunks(codes, tail, final).audits()):
            for state, way in enumerate(ways):
                if way is not None and (state == START or number[i] > 0):
                    rows.append(i), states.append(state)
                    costs.append(way[0]), audits.append(way[1]), ends.append(way[2])
        at = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), batch.column(2).take(at),
             pa.array(states, pa.int32()), pa.array(costs, pa.int64()), pa.array(audits, pa.string()),
             pa.array(ends, pa.int32())],
            names=["conv", "chunk", "codes", "state", "cost", "audit", "end"])


def _chain(table: pa.Table) -> pa.Table:
    """The chunks' audits that follow each other from the start."""
    table = table.sort_by([("chunk", "ascending"), ("state", "ascending")])
    chunk, state, end = (table.column(n).to_pylist() for n in ("chunk", "state", "end"))
    now, taken = START, []
    for i in range(len(chunk)):
        if state[i] == now and (not taken or chunk[i] > chunk[taken[-1]]):
            taken.append(i)
            now = end[i]
    return table.take(pa.array(taken, pa.int64()))


def _edits(batches, size: int):
    """Audits -> one row an edit that leaves a turn: its place among the turns
    (null: inserted), its step in the audit, and a new role."""
    names = {USER: "user", ASSISTANT: "assistant"}
    for batch in batches:
        rows, idx, step, edit, role = [], [], [], [], []
        chunk, codes, state, audit = (batch.column(i).to_pylist() for i in (1, 2, 3, 5))
        for i in range(batch.num_rows):
            now, at = state[i], 0
            for j, letter in enumerate(audit[i]):
                if letter != "D":
                    to = int(NEXT[now])
                    if letter == "K":
                        to = int(KEPT[(ord(codes[i][at]) - 65) // 3][now])
                    rows.append(i), step.append(j), edit.append(letter)
                    idx.append(None if letter == "I" else chunk[i] * size + at)
                    role.append(None if letter == "K" else names[to])
                    now = to
                at += letter != "I"
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows, pa.int64())), batch.column(1).take(pa.array(rows, pa.int64())),
             pa.array(step, pa.int32()), pa.array(idx, pa.int64()), pa.array(edit, pa.string()),
             pa.array(role, pa.string())], names=["conv", "chunk", "step", "idx", "edit", "role"])


def _arrow(schema: T.StructType, conv: T.DataType):
    return T.StructType([T.StructField("conv", conv), *schema.fields])


def repair_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", chunk: int = CHUNK) -> Repair:
    """Report and repaired turns of all conversations.

    ``report``: conv, turns, gaps, blank, duplicate, truncated, illegal, cost,
    audit.  ``gaps`` counts the numbers missing between a conversation's least
    and greatest turn, ``illegal`` the neighbours whose roles don't begin with
    ``su``, ``ua`` or ``au``.  ``turns``: conv, chunk, step, edit, role, text, in
    the order of (chunk, step).
    """
    spark = rows.sparkSession
    ship(spark)
    kind = rows.schema[conv].dataType
    clean = rows.select(col(conv).alias("conv"), col(turn).alias("turn"),
                        F.coalesce(col(role).cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(col(text).cast("string"), F.lit(" ")).alias("text"))
    last = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    turns = ordered_turns(
        clean, "conv", ["turn", "role", "text"],
        {"turn": F.col("turn"), "role": F.col("role"), "text": F.col("text"),
         "sha": F.unhex(F.sha2("text", 256)), "blank": ~F.col("text").rlike(WORD_RE),
         "cut": ~last.isin(".", "!", "?")}, "repair-turns")
    turns = stored(turns, "repair-order")[0]
    # A turn is a duplicate unless it is the first of its role and text.
    firsts = turns.groupBy("conv", "role", "sha").agg(F.min("idx").alias("idx")).select("conv", "idx").alias("f")
    head = F.substring("t.role", 1, 1)
    kinds = F.when(head == "s", 0).when(head == "u", 1).when(head == "a", 2).otherwise(3)
    faulty = (turns.select("conv", "idx", "turn", "role", "blank", "cut").alias("t")
              .join(firsts, same("t", "f", ["conv", "idx"]), "left")
              .select("t.conv", "t.idx", "t.turn", kinds.alias("kind"), F.col("t.blank").alias("blank"),
                      (~F.col("t.blank") & F.col("f.idx").isNull()).alias("duplicate"),
                      (~F.col("t.blank") & F.col("f.idx").isNotNull() & F.col("t.cut")).alias("truncated")))
    state = F.when(F.col("blank") | F.col("duplicate"), GONE).when(F.col("truncated"), CUT).otherwise(SOUND)
    coded = faulty.withColumn("code", F.char(F.lit(ord("A")) + F.col("kind") * 3 + state)) \
        .withColumn("chunk", F.floor(F.col("idx") / chunk).cast("long"))
    in_order = F.array_sort(F.collect_list(F.struct("idx", "code", "turn")))
    chunks = (coded.groupBy("conv", "chunk")
              .agg(in_order.alias("r"), F.count_if("blank").alias("blank"),
                   F.count_if("duplicate").alias("duplicate"), F.count_if("truncated").alias("truncated"))
              .select("conv", "chunk", F.array_join("r.code", "").alias("codes"), "blank", "duplicate", "truncated",
                      F.size("r").alias("n")))
    chunks = stored(chunks, "repair-chunks")[0]

    many = chunks.where("chunk > 0").select("conv").distinct().alias("m")
    long_ones = chunks.alias("c").join(many, same("c", "m", ["conv"]), "left_semi")
    matrices = long_ones.select("conv", "chunk", "codes").mapInArrow(
        _matrices, _arrow(T.StructType.fromDDL("chunk long, m array<long>"), kind))
    tails = matrices.groupBy("conv").applyInArrow(
        _tails, _arrow(T.StructType.fromDDL("chunk long, tail array<long>"), kind))
    lasts = chunks.groupBy("conv").agg(F.max("chunk").alias("chunk")).alias("l")
    asked = (chunks.alias("c").join(lasts, same("c", "l", ["conv", "chunk"]), "left")
             .join(tails.alias("t"), same("c", "t", ["conv", "chunk"]), "left")
             .select("c.conv", "c.chunk", "c.codes", "t.tail", F.col("l.chunk").isNotNull().alias("last")))
    found = stored(asked.mapInArrow(_audits, _arrow(T.StructType.fromDDL(
        "chunk long, codes string, state int, cost long, audit string, end int"), kind)), "repair-audits")[0]
    short = found.alias("c").join(many, same("c", "m", ["conv"]), "left_anti")
    chained = found.alias("c").join(many, same("c", "m", ["conv"]), "left_semi").groupBy("conv").applyInArrow(
        _chain, found.schema)
    audits = stored(short.unionByName(chained), "repair-chosen")[0]

    edits = audits.mapInArrow(partial(_edits, size=chunk), _arrow(T.StructType.fromDDL(
        "chunk long, step int, idx long, edit string, role string"), kind))
    edits = stored(edits, "repair-edits")[0]
    kept = (edits.where("idx IS NOT NULL").alias("e").join(turns.alias("t"), same("e", "t", ["conv", "idx"]))
            .select("e.conv", "e.chunk", "e.step", "e.edit", F.coalesce("e.role", "t.role").alias("role"), "t.text"))
    inserted = edits.where("idx IS NULL").select("conv", "chunk", "step", "edit", "role", F.lit("").alias("text"))

    report = _report(rows.select(col(conv).alias("conv")).distinct(), faulty, chunks, audits)
    return Repair(report, kept.unionByName(inserted))


def _report(convs: DataFrame, faulty: DataFrame, chunks: DataFrame, audits: DataFrame) -> DataFrame:
    # Neighbours: within a chunk from its characters, and the last and first of chunks side by side.
    kinds = F.transform(F.split("codes", ""), lambda c: F.floor((F.ascii(c) - ord("A")) / 3))
    legal = (1, 12, 21)                  # su, ua, au
    pairs = F.transform(F.sequence(F.lit(1), F.col("n") - 1), lambda i: F.element_at("k", i) * 10 + F.element_at("k", i + 1))
    inner = F.when(F.col("n") > 1, F.size(F.filter(pairs, lambda p: ~p.isin(*legal)))).otherwise(0)
    edged = chunks.withColumn("k", kinds).select(
        "conv", "chunk", "blank", "duplicate", "truncated", "n", inner.alias("illegal"),
        F.element_at("k", 1).alias("head"), F.element_at("k", F.col("n")).alias("tail"))
    heads = edged.where("chunk > 0").select("conv", (F.col("chunk") - 1).alias("chunk"), F.col("head").alias("after"))
    seam = F.when(F.col("h.after").isNotNull() & ~(F.col("c.tail") * 10 + F.col("h.after")).isin(*legal), 1).otherwise(0)
    sums = (edged.alias("c").join(heads.alias("h"), same("c", "h", ["conv", "chunk"]), "left")
            .select("c.conv", "blank", "duplicate", "truncated", "n", (F.col("illegal") + seam).alias("illegal"))
            .groupBy("conv").agg(*[F.sum(c).cast("long").alias(c) for c in
                                   ("n", "blank", "duplicate", "truncated", "illegal")]).alias("s"))
    numbers = (faulty.where("turn IS NOT NULL").groupBy("conv", "turn").agg(F.lit(1).alias("one"))
               .groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).cast("long").alias("gaps"))
               .alias("g"))
    whole = (audits.groupBy("conv").agg(F.min(F.struct("chunk", "cost")).alias("first"),
                                        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "audit"))),
                                                                 lambda x: x["audit"]), "").alias("audit"))
             .select("conv", F.col("first.cost").alias("cost"), "audit").alias("a"))
    zero = F.lit(0).cast("long")
    return (convs.alias("v").join(sums, same("v", "s", ["conv"]), "left").join(numbers, same("v", "g", ["conv"]), "left")
            .join(whole, same("v", "a", ["conv"]), "left")
            .select("v.conv", F.coalesce("s.n", zero).alias("turns"), F.coalesce("g.gaps", zero).alias("gaps"),
                    *[F.coalesce(f"s.{c}", zero).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
                    F.coalesce("a.cost", zero).alias("cost"), F.coalesce("a.audit", F.lit("")).alias("audit")))


def with_digest(repair: Repair) -> DataFrame:
    """The report with ``repaired_sha256``: the SHA-256 of the repaired turns as
    ``role:text``, joined by line feeds."""
    return digest_report(repair, repair.report.select(F.col("conv").alias("conv")))


def digest_report(repair: Repair, convs: DataFrame) -> DataFrame:
    """``with_digest`` with a row for each of ``convs`` (one column), those
    without any turn included."""
    pieces = repair.turns.select("conv", "chunk", "step", F.concat_ws(":", "role", "text").alias("piece"))
    hashes = hashed_in_order(pieces, "conv", ["chunk", "step"], "piece", "\n", "sha").alias("h")
    numbers = [F.coalesce(f"r.{c}", F.lit(0).cast("long")).alias(c)
               for c in ("turns", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (convs.toDF("conv").alias("v").join(repair.report.alias("r"), same("v", "r", ["conv"]), "left")
            .join(hashes, same("v", "h", ["conv"]), "left")
            .select("v.conv", *numbers, F.coalesce("r.audit", F.lit("")).alias("audit"),
                    F.coalesce("h.sha", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")))


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """Turns with faults dealt by crc32(``conv:turn``) % 20 (nulls: one blank):
    0 the turn is dropped, 1 its text emptied, 2 its ``.!?`` removed, 3 it comes
    twice, 4 its role is user."""
    name = fresh("__fault", rows.columns)

    def known(c: str) -> Column:
        return F.coalesce(col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(known(conv), F.lit(":"), known(turn)).cast("binary")) % 20
    body = F.when(col(name) == 1, F.lit("")).when(col(name) == 2, F.regexp_replace(known(text), "[.!?]", "")) \
        .otherwise(known(text))
    out = rows.withColumn(name, fault).where(col(name) != 0).select(
        col(conv), col(turn), F.when(col(name) == 4, F.lit("user")).otherwise(known(role)).alias(role),
        body.alias(text), F.explode(F.sequence(F.lit(1), F.when(col(name) == 3, 2).otherwise(1))).alias(name))
    return out.drop(name)
