"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target number of words.  A document of a source whose
target is r times its size is wanted r times on average: floor(r) copies are
certain, and the fraction left over is its inclusion probability p in a sample
of fixed size.  Pareto order sampling ranks documents by

    (u / (1 - u)) / (p / (1 - p)),   u a random number fixed by the id,

and takes the smallest until the words still wanted are reached.  A document
that is larger than what is still wanted is set aside, and those behind it go
on, until none fits; then the smallest one left is taken as well if that brings
the words nearer to those wanted.  An optional importance column makes p differ
inside a source as well.

The ranking is never sorted in one place.  The rank key is turned into an
integer; an aggregate of words per source and leading key bits finds the slice
where the wanted words are reached, and only that slice is looked at with more
bits, until one key is left.  A slice holds at most 2**STEP sums a source, so a
source with a third of all rows costs no more than any other.

Defined cases: a null text has size 0; a null source is a source of its own,
ordered last; sources of size 0 have target 0; rows that share id and source
are one unit, taken or left together; a null id is a unit per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stellate.llm.common import WORD_RE, col, fresh, stored

KEY_BITS, STEP = 48, 16  # three looks of sixteen bits settle a key


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def targets(sources: DataFrame, *, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3,
            share: float = 1.0) -> DataFrame:
    """Targets of a table (source, source_size), one row a source.

    Sources in code point order, null last, take ``weights`` in turn and split
    ``share`` of all words; a target stops at ``max_repeat`` times its source,
    and what is over is shared again by weight until none is above.  The level
    is raised on the aggregate of sources alone; only two sums a round reach
    the driver."""
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    place = (F.row_number().over(order) - 1) % len(weights)
    table = stored(sources.select(
        "source", "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int")).alias("w"),
        (F.col("source_size") * max_repeat).cast("double").alias("most")), "mix-sources")[0]
    total = (table.agg(F.sum("source_size")).first()[0] or 0) * share
    level, known = 0.0, -1
    while True:
        full = F.col("most") <= F.col("w") * level
        row = table.agg(F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("w"))),
                        F.count_if(full)).first()
        if row[2] == known or not row[1]:
            break
        known = row[2]
        level = max(0.0, (total - (row[0] or 0.0)) / row[1])
    target = F.least(F.col("most"), F.col("w") * F.lit(level)) if total else F.lit(0.0)
    return table.select("source", "source_size", target.alias("target"))


def _key(ident: Column, source: Column, p: Column, seed: int) -> Column:
    """The Pareto rank of a row as an integer below 2**KEY_BITS."""
    h = F.xxhash64(F.lit(seed), ident, source)
    u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / float(1 << 53)
    odds = (u / (1 - u)) / (p / (1 - p))
    return F.least((odds / (1 + odds) * float(1 << KEY_BITS)).cast("long"),
                   F.lit((1 << KEY_BITS) - 1))


def _reached(units: DataFrame, wanted: DataFrame) -> DataFrame:
    """(source, cut, gap): units below key ``cut`` stay within ``wanted``
    (source, words) and leave ``gap`` words; the one at ``cut`` doesn't.
    ``units``: source, key, size, one row a key."""
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # At the start nothing is settled: prefix 0 of length 0, no words so far.
    state = wanted.select("source", "words", F.lit(0).cast("long").alias("prefix"),
                          F.lit(0).cast("long").alias("so_far"))
    for used in range(STEP, KEY_BITS + 1, STEP):
        s = state.select(F.col("source").alias("s"), "words", "prefix", "so_far")
        part = (units.join(s, units["source"].eqNullSafe(s["s"])
                           & (F.shiftright("key", KEY_BITS - used + STEP) == F.col("prefix")))
                .groupBy("source", "words", "so_far",
                         F.shiftright("key", KEY_BITS - used).alias("slice"))
                .agg(F.sum("size").alias("size")))
        part = part.withColumn("start", F.col("so_far") + F.coalesce(F.sum("size").over(before), F.lit(0)))
        # The slice in which the wanted words are reached, or the last one.
        inside = part.filter(F.col("start") < F.col("words"))
        state = stored(inside.groupBy("source").agg(
            F.max_by(F.struct("words", "slice", "start", "size"), "slice").alias("x"))
            .select("source", "x.words", F.col("x.slice").alias("prefix"),
                    F.col("x.start").alias("so_far"), "x.size"), "mix-cut")[0]
    # One key is left, in which the words are reached.
    gap = F.col("words") - F.col("so_far")
    fits = F.col("size") <= gap
    return state.select("source", (F.col("prefix") + fits.cast("long")).alias("cut"),
                        F.when(fits, gap - F.col("size")).otherwise(gap).alias("gap"))


def _behind(units: DataFrame, cuts: DataFrame) -> DataFrame:
    """(source, key, size, cut, gap) of units at or behind their source's cut."""
    c = cuts.withColumnRenamed("source", "s")
    return units.join(c, units["source"].eqNullSafe(c["s"]) & (F.col("key") >= F.col("cut"))).drop("s")


def thresholds(units: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(source, cut) and (source, key): units below key ``cut`` are taken, and
    those of the keys listed, so that the words taken come near ``wanted``
    (source, words).  ``units``: source, key, size, one row a key."""
    cuts = first = _reached(units, wanted)
    left, more = units, None
    while True:
        # Behind the unit that doesn't fit, those that do.
        left = stored(_behind(left, cuts).filter("size <= gap").select("source", "key", "size"), "mix-left")[0]
        if left.isEmpty():
            break
        cuts = _reached(left, cuts.select("source", F.col("gap").alias("words")))
        c = cuts.select(F.col("source").alias("s"), "cut")
        taken = (left.join(c, left["source"].eqNullSafe(c["s"]) & (F.col("key") < F.col("cut")))
                 .select("source", "key", "size"))
        more = taken if more is None else more.unionByName(taken)
    if more is None:
        more = units.limit(0)
    more = stored(more, "mix-more")[0]
    # Nothing left fits: the smallest one, if that is nearer than none.
    m = more.groupBy("source").agg(F.sum("size").alias("got")).withColumnRenamed("source", "s")
    gaps = first.join(m, first["source"].eqNullSafe(m["s"]), "left").select(
        "source", "cut", (F.col("gap") - F.coalesce("got", F.lit(0))).alias("gap"))
    t = more.select(F.col("source").alias("s"), F.col("key").alias("k"))
    rest = _behind(units, gaps)
    last = (rest.join(t, rest["source"].eqNullSafe(t["s"]) & (F.col("key") == F.col("k")), "left_anti")
            .groupBy("source", "gap").agg(F.min(F.struct("size", "key")).alias("x"))
            .filter(F.col("x.size") - F.col("gap") < F.col("gap")).select("source", "x.key"))
    return first.select("source", "cut"), stored(more.select("source", "key").unionByName(last), "mix-more")[0]


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", importance: str | None = None,
                weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3, share: float = 1.0,
                seed: int = 42, carry: list[str] | None = None,
                names: tuple[str, ...] = ("size", "source_size", "target", "copies", "taken")) -> DataFrame:
    """One row per row of ``docs``: the columns in ``carry`` (all by default)
    and five new ones named by ``names``: words, words of the source, the
    source's target, copies that the mix takes, and words it takes."""
    carry = list(docs.columns if carry is None else carry)
    light = set(carry) <= {id_col, source_col}
    weight = F.lit(1.0) if importance is None else \
        F.greatest(F.coalesce(col(importance).cast("double"), F.lit(0.0)), F.lit(0.0))
    base = docs.select(col(id_col).alias("_id"), col(source_col).alias("source"),
                       word_count(col(text_col)).alias("size"), weight.alias("weight"))
    sized = stored(base, "mix-sizes")[0]
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"),
                                       F.sum(F.col("size") * F.col("weight")).alias("mass"))
    plan = targets(sums, weights=weights, max_repeat=max_repeat, share=share)
    plan = plan.join(sums.select(F.col("source").alias("s"), "mass"),
                     F.col("source").eqNullSafe(F.col("s"))).drop("s")

    def expected(df: DataFrame) -> DataFrame:
        """Copies wanted on average, split into certain ones and p."""
        e = F.when(F.col("mass") > 0, F.least(F.col("target") * F.col("weight") / F.col("mass"),
                                              F.lit(float(max_repeat)))).otherwise(0.0)
        return (df.withColumn("certain", F.floor(e).cast("long"))
                .withColumn("p", e - F.floor(e))
                .withColumn("key", F.when(F.col("p") > 0, _key(F.col("_id"), F.col("source"), F.col("p"), seed))))

    def with_plan(df: DataFrame, table: DataFrame) -> DataFrame:
        t = table.withColumnRenamed("source", "s")
        return df.join(t, df["source"].eqNullSafe(t["s"]), "left").drop("s")

    plan = stored(plan, "mix-targets")[0]
    units = expected(with_plan(sized, plan))
    wanted = (units.groupBy("source", "target").agg(F.sum(F.col("certain") * F.col("size")).alias("sure"))
              .select("source", (F.col("target") - F.col("sure")).alias("words"))
              .filter("words > 0"))
    # Rows that share a key are taken or left together.
    keys = stored(units.filter("p > 0 AND size > 0").groupBy("source", "key").agg(F.sum("size").alias("size")),
                  "mix-keys")[0]
    cuts, more = thresholds(keys, wanted)
    plan = stored(with_plan(plan, cuts), "mix-plan")[0]

    if light:  # sizes are at hand; no second look at the texts
        rows, back = sized, {id_col: "_id", source_col: "source"}
    else:
        clash = {c: f"_c{i}" for i, c in enumerate(carry)}
        rows = docs.select(col(id_col).alias("_id"), col(source_col).alias("source"),
                           word_count(col(text_col)).alias("size"), weight.alias("weight"),
                           *[col(c).alias(n) for c, n in clash.items()])
        back = clash
    rows = expected(with_plan(rows, plan))
    more = more.select(F.col("source").alias("s"), F.col("key").alias("k"), F.lit(True).alias("more"))
    # A row without a key meets none; so that such rows don't meet in one task, each has one below 0.
    key = F.coalesce("key", -1 - F.shiftrightunsigned(F.xxhash64("_id", "size"), 1))
    rows = rows.join(more, rows["source"].eqNullSafe(more["s"]) & (key == more["k"]), "left")
    copies = F.when(F.col("size") > 0, F.col("certain") + F.when(
        (F.col("key") < F.col("cut")) | F.col("more"), F.lit(1)).otherwise(F.lit(0))).otherwise(F.lit(0)).cast("long")
    new = (F.col("size"), F.col("source_size"), F.col("target"), copies, copies * F.col("size"))
    return rows.select(*[F.col(back[c]).alias(c) for c in carry],
                       *[c.alias(n) for c, n in zip(new, names)])


def sample_mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix has them: left out, once, or repeated."""
    names = [fresh(n, docs.columns) for n in ("_size", "_source_size", "_target", "_copies", "_taken")]
    copies = names[3]
    mixed = mix_sources(docs, names=tuple(names), **options).filter(F.col(copies) > 0)
    again = fresh("_again", docs.columns)
    return (mixed.withColumn(again, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
            .select(*[col(c) for c in docs.columns]))
