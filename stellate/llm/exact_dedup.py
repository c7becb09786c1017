"""Exact de-duplication by distributed MSD radix partitioning.

Documents are split by the leading bytes of their normalised text, then by
more of them, until each group is a single document or its texts have ended.
A round looks at the first ``width`` bytes: an aggregate counts each prefix
(partial counts first, so a prefix that a third of all rows share reaches the
shuffle as one row a task), and one join takes the counts back to the rows.
Rows whose prefix nobody shares are finished; rows whose shared prefix is the
whole text are copies of each other; the rest goes to the next round, which
looks at ``growth`` times as many bytes.  Equality is that of the bytes
themselves; no digest takes part.

The number of rounds is the logarithm of the longest shared prefix.  The rows
of a round are written to the shared checkpoint folder, so each round starts
from files and only documents with a partner are ever moved twice.

Defined cases: a null text is an empty text; a null id ranks behind all
others; of rows that share text and smallest id exactly one stays; an empty
table gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import SPACE_RE, col, fresh, stored


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one blank."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RE, " ")


def exact_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                     carry: list[str] | None = None, digest: str | None = None,
                     width: int = 64, growth: int = 8,
                     names: tuple[str, str, str] = ("keep_id", "group_size", "kept")) -> DataFrame:
    """One row per row of ``docs``: the columns in ``carry`` (all by default)
    and three new ones named by ``names``: the smallest id among the rows with
    the same normalised text, their number, and whether this row is the one
    that stays.  ``digest`` names a column for the sha-256 of the normalised
    text (an output only)."""
    spark = docs.sparkSession
    carry = list(docs.columns if carry is None else carry)
    taken = carry + list(names) + ([digest] if digest else [])
    ident, body, tag, count, first = (fresh(n, taken) for n in ("_id", "_body", "_tag", "_n", "_first"))
    rows = docs.select(col(id_col).alias(ident), normalised(col(text_col)).alias(body),
                       *[col(c) for c in carry])
    if digest:
        rows = rows.withColumn(digest, F.sha2(F.col(body).cast("binary"), 256))
    out = carry + ([digest] if digest else [])
    done = []
    while True:
        # Tags tell equal rows of one id apart; they are fixed by the files.
        tagged = tag in rows.columns
        prefix = F.substring(F.col(body).cast("binary"), 1, width)
        ended = F.octet_length(F.col(body)) < width
        pick = F.struct(F.col(ident).isNull().alias("none"), F.col(ident).alias("id"),
                        (F.col(tag) if tagged else F.lit(None).cast("long")).alias("tag"))
        # Read back from files and merged at every size, both sides come from
        # shuffles of their own, so Spark can split a prefix that many rows share.
        groups = stored(rows.groupBy(prefix.alias("_prefix"))
                        .agg(F.count(F.lit(1)).alias(count), F.min(pick).alias(first))
                        .filter(F.col(count) > 1), "prefixes")[0].hint("merge")
        joined = rows.join(groups, prefix == F.col("_prefix"), "left")
        alone = F.col(count).isNull()
        # In the first round rows have no tag yet, so ended groups wait too.
        over = (alone | ended) if tagged else alone
        result = joined.select(
            F.when(~over, F.col(body)).alias(body), F.col(ident),
            *[col(c) for c in out],
            *([F.col(tag)] if tagged else [F.monotonically_increasing_id().alias(tag)]),
            over.alias("_over"),
            F.when(alone, F.col(ident)).otherwise(F.col(first)["id"]).alias(names[0]),
            F.when(alone, F.lit(1).cast("long")).otherwise(F.col(count)).alias(names[1]),
            (alone | (F.col(first)["tag"] == F.col(tag)) if tagged else alone).alias(names[2]))
        table = stored(result, "radix")[0]
        done.append(table.filter("_over").select(*[col(c) for c in out], *names))
        rows = table.filter("NOT _over").select(ident, body, *[col(c) for c in out], tag)
        if rows.isEmpty():
            break
        width *= growth
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole


def drop_exact_duplicates(docs: DataFrame, *, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that repeat the text of a row that stays."""
    names = tuple(fresh(n, docs.columns) for n in ("_keep_id", "_group_size", "_kept"))
    marked = exact_duplicates(docs, id_col=id_col, text_col=text_col, names=names)
    return marked.filter(F.col(names[2])).select(*[col(c) for c in docs.columns])
