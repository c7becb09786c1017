"""Data profiles: null counts, summaries, exact descriptions, samples, top-n."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.operators.keys import number_rows

DESCRIBE_PROBS = (0.25, 0.5, 0.75)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row, one BIGINT per column: how many values are null (one scan)."""
    cols = list(columns or df.columns)
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])


def null_counts_long(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_null) rows — the same single aggregate, unpivoted."""
    cols = list(columns or df.columns)
    wide = null_counts(df, cols)
    return wide.unpivot([], [F.col(f"`{c}`") for c in cols], "column", "n_null")


SUMMARY_STATS = ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")
# Text that Spark's string -> double cast accepts; other text is skipped
# without attempting (and failing) the cast row by row.
_NUMERIC_TEXT = (r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[dDfF]?"
                 r"|(?i:inf|infinity))\s*$|^\s*(?i:nan)\s*$")


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def summary(df: DataFrame, *statistics: str, accuracy: int = 10000) -> DataFrame:
    """Column summary in ``DataFrame.summary`` layout: one row per statistic
    (count, mean, stddev, min, approximate quartiles, max), one text column
    per input column, strings included (mean/stddev/quantiles over the
    values that parse as numbers, min/max lexicographic).

    All statistics of all columns come from a single aggregate pass (partial
    per task, one small final merge), reshaped with ``inline``.  The plan is
    built from SQL text in two calls, which keeps building a summary of a
    wide table cheap.  The rank of a quartile is off by at most a share of
    ``1 / accuracy`` of the rows (none at all if there are fewer rows).
    """
    stats = tuple(statistics) or SUMMARY_STATS
    pcts = [s for s in stats if s.endswith("%")]
    fracs = ", ".join(repr(float(s[:-1]) / 100.0) for s in pcts)
    numeric_text = _sql_text(_NUMERIC_TEXT)
    aggs, parsed, cells = [], [], {s: [] for s in stats}
    for i, f in enumerate(df.schema.fields):
        c = "`" + f.name.replace("`", "``") + "`"
        parsed.append(c)
        if isinstance(f.dataType, T.NumericType):
            num = c  # quantiles keep the column's own type, as DataFrame.summary does
        elif isinstance(f.dataType, T.StringType):
            num = f"`__{i}_num`"  # parsed once a row, whatever number of statistics it feeds
            parsed.append(f"CASE WHEN {c} RLIKE {numeric_text} THEN try_cast({c} AS DOUBLE) END AS {num}")
        else:
            num = None
        for s in stats:
            name = f"__{i}_{s}"
            if s == "count":
                aggs.append(f"count({c}) AS `{name}`")
            elif s in ("min", "max"):
                aggs.append(f"{s}({c}) AS `{name}`")
            elif s.endswith("%"):
                continue
            elif s not in ("mean", "stddev"):
                raise ValueError(f"unknown statistic {s!r}")
            elif num is None:
                aggs.append(f"CAST(NULL AS STRING) AS `{name}`")
            else:
                fn = "avg" if s == "mean" else "stddev_samp"
                aggs.append(f"{fn}({num}) AS `{name}`")
            cells[s].append(f"CAST(`{name}` AS STRING)")
        if pcts:
            qname = f"__{i}_q"
            if num is None:
                aggs.append(f"CAST(NULL AS ARRAY<STRING>) AS `{qname}`")
            else:
                aggs.append(f"percentile_approx({num}, array({fracs}), {accuracy}) AS `{qname}`")
            for k, s in enumerate(pcts):
                cells[s].append(f"CAST(element_at(`{qname}`, {k + 1}) AS STRING)")
    names = [_sql_text(f.name) for f in df.schema.fields]
    rows = ", ".join(
        f"named_struct('summary', {_sql_text(s)}, "
        + ", ".join(f"{n}, {cell}" for n, cell in zip(names, cells[s])) + ")"
        for s in stats)
    return df.selectExpr(*parsed).selectExpr(*aggs).selectExpr(f"inline(array({rows}))")


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType)]


def _long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"),
                               F.col(f"`{c}`").cast("double").alias("v")) for c in cols])
    return (df.select(F.inline(pairs))
            .where(F.col("v").isNotNull()))


#: Bins of a histogram are at most about this many a column or interval.
_BINS = 1 << 16
#: An interval with at most this many rows is looked at by its values.
_FEW = 1 << 12
_NAN = 200_000


def _coarse_bin(v: Column) -> Column:
    """A bin that grows with the value: sign, exponent and four bits more.
    ``log`` never falls where its argument grows, so bins keep the order of the
    values; infinities have bins of their own, NaN the last one."""
    def size(x: Column) -> Column:
        return F.floor(F.least(F.log2(x), F.lit(2000.0)) * 16).cast("int") + 100_000

    return (F.when(F.isnan(v), _NAN).when(v == 0, 0).when(v > 0, size(v)).otherwise(-size(-v)))


def _bins_at(bins: DataFrame, wanted: DataFrame, by: Sequence[str]) -> list:
    """The bins that hold the wanted ranks: (column, rank, start, n, low, high).
    ``bins``: (by..., bin, n, low, high, base), base being the rows before the
    interval; bounded by ``_BINS`` rows an interval."""
    before = Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = bins.withColumn("start", F.sum("n").over(before) - F.col("n") + F.col("base")).alias("b")
    hit = (F.col("w.column") == F.col("b.column")) & (F.col("w.rank") >= F.col("b.start")) & (
        F.col("w.rank") < F.col("b.start") + F.col("b.n"))
    return cum.join(F.broadcast(wanted.alias("w")), hit).select(
        "b.column", "w.rank", "b.start", "b.n", "b.low", "b.high").collect()  # one row a wanted rank


def _values_at(df: DataFrame, ranks: dict[str, Sequence[int]]) -> dict[tuple[str, int], float]:
    """The values at the given 0-based ranks of each column (nulls left out).

    Histograms refine the ordered bits of the value: the first has a bin for
    each sign, exponent and four bits of the fraction; the bins that hold a
    wanted rank are cut into 65,536 equal ones, again and again, until a bin
    holds one value, or so few rows that their values are counted themselves.
    Each round is one aggregate over the source with a map-side part; four or
    five rounds tell any two doubles apart.  Values are never ranged or copied;
    a round's histograms stay in Spark, and only the bins wanted are collected.
    """
    spark = df.sparkSession
    values = _long_values(df, list(ranks))
    todo = [(c, r) for c, rs in ranks.items() for r in sorted(set(rs))]
    found: dict[tuple[str, int], float] = {}
    told = [F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")]
    bins = values.groupBy("column", _coarse_bin(F.col("v")).alias("bin")).agg(*told).withColumn("base", F.lit(0))
    by = ["column"]
    while todo:
        hits = _bins_at(bins, spark.createDataFrame(todo, "column string, rank long"), by)
        spans = {}
        for h in hits:
            if h["low"] == h["high"] or h["high"] != h["high"]:   # one value, or NaN
                found[h["column"], h["rank"]] = h["low"]
            else:
                spans[h["column"], h["low"], h["high"]] = (h["start"], h["n"])
        todo = [k for k in todo if k not in found]
        if not todo:
            break
        held = spark.createDataFrame([(c, lo, hi, start, n <= _FEW) for (c, lo, hi), (start, n) in spans.items()],
                                     "column string, lo double, hi double, base long, few boolean").alias("s")
        inside = values.alias("x").join(F.broadcast(held), (F.col("x.column") == F.col("s.column")) &
                                        F.col("x.v").between(F.col("s.lo"), F.col("s.hi")))
        part = F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * (_BINS - 1)).cast("double")
        bins = (inside.select("s.column", "lo", "base", F.when(F.col("few"), F.col("v")).otherwise(part).alias("bin"), "v")
                .groupBy("column", "lo", "base", "bin").agg(*told))
        by = ["column", "lo"]
    return found


def exact_quantiles(df: DataFrame, columns: Sequence[str],
                    probs: Sequence[float] = DESCRIBE_PROBS,
                    num_partitions: int | None = None, *,
                    counts: dict[str, int] | None = None) -> dict[tuple[str, float], float]:
    """Exact linear-interpolated quantiles of several columns, by rank selection
    (``_values_at``).  ``counts``: the columns' numbers of values, if known.
    ``num_partitions`` has no effect any more, as no values are ranged."""
    if counts is None:
        row = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"__{i}") for i, c in enumerate(columns)]).first()
        counts = {c: row[i] for i, c in enumerate(columns)}
    places = {c: [((n - 1) * q, math.floor((n - 1) * q)) for q in probs] for c, n in counts.items() if n}
    ranks = {c: [r for _, lo in p for r in (lo, min(lo + 1, counts[c] - 1))] for c, p in places.items()}
    found = _values_at(df, ranks)
    out = {}
    for c, p in places.items():
        for q, (h, lo) in zip(probs, p):
            a, b = found[c, lo], found[c, min(lo + 1, counts[c] - 1)]
            out[c, q] = a if a == b or h == lo else a + (b - a) * (h - lo)
    return out


def describe(df: DataFrame, columns: Sequence[str] | None = None,
             probs: Sequence[float] = DESCRIBE_PROBS) -> DataFrame:
    """Per numeric column: count, mean, std (sample), min, exact quartiles, max.

    Layout: one row per column (column, count, mean, std, min, p25, p50, p75,
    max).  One aggregate gives the moments of all columns, three to five more
    the quartiles; give a written table if the source is dear to compute.
    """
    cols = list(columns or _numeric(df))
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(f"`{c}`").cast("double")
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"mean{i}"), F.stddev_samp(v).alias(f"std{i}"),
                 F.min(v).alias(f"min{i}"), F.max(v).alias(f"max{i}")]
    row = df.agg(*aggs).first()
    quant = exact_quantiles(df, cols, probs, counts={c: row[f"n{i}"] for i, c in enumerate(cols)})
    names = ["p" + str(int(round(q * 100))) for q in probs]
    out = [(c, row[f"n{i}"], row[f"mean{i}"], row[f"std{i}"], row[f"min{i}"], *[quant.get((c, q)) for q in probs],
            row[f"max{i}"]) for i, c in enumerate(cols)]
    schema = ("column string, count long, mean double, std double, min double, "
              + ", ".join(f"{n} double" for n in names) + ", max double")
    return df.sparkSession.createDataFrame(out, schema)


#: Up to this many rows a sample is the first n of an order, merged in one task.
ONE_TASK_ROWS = 10_000


def sample_rows(df: DataFrame, n: int, key: Sequence[str], seed: int = 42,
                one_task: int = ONE_TASK_ROWS) -> DataFrame:
    """``n`` random rows (or all when fewer): those with the smallest md5 of
    the seed and the ``key`` columns as text, ties by the key.  The sample
    doesn't depend on how the rows are partitioned.

    A small sample is a bounded top-k, so no task holds more than ``n`` rows.
    For a large one the n-th md5 is found by counts (``_nth_digest``) and the
    rows up to it are filtered where they lie: no task gathers the sample.
    """
    cols = [F.col(f"`{c}`") for c in key]
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    digest = F.md5(text.cast("binary"))
    if n <= one_task:
        return df.orderBy(digest, *cols).limit(n)
    bound, left = _nth_digest(df.select(digest.alias("d")), n)
    if bound is None:
        return df
    below = df.where(digest < bound)
    # Rows of the bound's slice: at most ``one_task`` of them, or rows of one md5.
    edge = df.where(F.substring(digest, 1, len(bound)) == bound)
    if left <= one_task:
        return below.unionByName(edge.orderBy(digest, *cols).limit(left))
    place = "__place"
    return below.unionByName(number_rows(edge, place).where(F.col(place) <= left).drop(place))


def _nth_digest(digests: DataFrame, n: int) -> tuple[str | None, int]:
    """A prefix such that fewer than ``n`` digests are below it and at least
    ``n`` below or in its slice, and how many of the slice are wanted; None if
    there are no more than ``n``.  Counts per slice of four hexadecimal digits
    more (at most 65,536 rows a round, summed in Spark) narrow it down until the
    slice is small or one digest."""
    prefix, left = "", n
    while True:
        width = len(prefix) + 4
        inside = digests.where(F.col("d").startswith(prefix)) if prefix else digests
        counts = inside.groupBy(F.substring("d", 1, width).alias("s")).agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.orderBy("s").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        row = counts.withColumn("upto", upto).where(F.col("upto") >= left).orderBy("s").first()
        if row is None:
            return None, 0
        prefix, left = row["s"], left - (row["upto"] - row["n"])
        if row["n"] <= ONE_TASK_ROWS or len(prefix) == 32:
            return prefix, left


def top_n(df: DataFrame, order_by: Sequence, n: int) -> DataFrame:
    """First ``n`` rows in ``order_by`` order (per-task top-k, then merge)."""
    return df.orderBy(*order_by).limit(n)
