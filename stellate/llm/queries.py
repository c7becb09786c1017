"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.llm import (
    conversation_repair, exact_dedup, html_text, impact_index, langid, licenses, mixing, mixing_lm, packing, prefix_trie,
    quality, simhash, token_files,
)
from stellate.llm.common import held_out, learnable, table
from stellate.llm.tokens import tokenizer_source
from stellate.session import scratch_path

#: The tokenizer of the queries; operators take any byte-level BPE as text.
TOKENIZER = "byte_bpe_50k.json"


def production_tokenizer() -> str:
    import public_tokenizers

    return tokenizer_source(public_tokenizers.path(TOKENIZER))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix_sources(docs, carry=["doc_id"]).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm-token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, production_tokenizer())
    return token_files.read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    ident = F.col("doc_id")
    return mixing_lm.score_texts(table(spark, sf_dir, "documents"), learn=learnable(ident, 7, 2),
                                 held_out=held_out(ident, 7, 2))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.learn_languages(docs, where=learnable(F.col("doc_id"), 4, 2))
    return langid.label_languages(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), production_tokenizer()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.exact_duplicates(docs, carry=["doc_id"], digest="text_sha256")


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact_index.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, trees).select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.with_length(html_text.extract_text(pages)).select("page_id", "url", "text", "n_chars")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    damaged = conversation_repair.damaged(turns)
    return conversation_repair.digest_report(
        conversation_repair.repair_conversations(damaged), turns.select("conv_id").distinct()).select(
        F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        "repaired_sha256")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    convs = rows.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv")).distinct()
    trie = prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.numbered_turns(rows), convs), convs)
    nodes = trie.nodes.alias("v").join(prefix_trie.ends_digest(trie).alias("e"), F.col("v.digest") == F.col("e.digest"),
                                       "left")
    return nodes.select(
        F.col("v.conv").alias("conv_id"), "v.depth", F.col("v.parent_conv").alias("parent_conv_id"), "v.n_convs",
        "v.n_children", "v.n_leaves", F.col("v.weight").alias("saved_tokens"),
        F.coalesce("e.ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_simhash": op2_simhash,
    "op3_token_files": op3_token_files,
    "op4_license_scan": op4_license_scan,
    "op5_lm_score": op5_lm_score,
    "op6_language_id": op6_language_id,
    "op7_packing": op7_packing,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_top_k": op9_top_k,
    "op10_quality": op10_quality,
    "op11_html_text": op11_html_text,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_prefix_trie": op13_prefix_trie,
}

def _license_sql() -> str:
    """The scan as a join of units and templates on their sizes."""
    def texts(values):
        return "[" + ", ".join(f"'{v}'" for v in values) + "]::VARCHAR[]"

    telling = licenses.flat_telling(licenses.TEMPLATES)
    rows = ", ".join(f"({k}, '{name}', {texts(grams)}, {texts(telling[k])})"
                     for k, (name, grams) in enumerate(licenses.flat_templates(licenses.TEMPLATES)))
    space = r"[\x20\x09-\x0D]+"
    return rf"""
        WITH t(k, license, b, tell) AS (VALUES {rows}),
        l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
        m AS (SELECT doc_id, regexp_replace(regexp_replace(text, '([.!?;:]){space}', '\1' || chr(1), 'g'), '{space}', ' ', 'g')
                     AS m FROM documents WHERE text IS NOT NULL),
        p AS (SELECT doc_id, string_split(m, chr(1)) AS p FROM m),
        q AS (SELECT doc_id, unnest(p) AS s, unnest(range(len(p))) AS pos FROM p),
        s AS (SELECT doc_id, s, min(pos) AS pos FROM q
              WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.doc_id = q.doc_id AND list_contains(l.l, q.s)) GROUP BY doc_id, s),
        u AS (SELECT doc_id, 0 AS unit, text AS body FROM documents WHERE contains(text, chr(10))
              UNION ALL SELECT doc_id, CAST(unnest(range(1, len(l) + 1)) AS INTEGER), unnest(l) FROM l
              UNION ALL SELECT doc_id, CAST(-row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS INTEGER), s FROM s),
        w AS (SELECT doc_id, unit, string_split(trim(regexp_replace(lower(body), '[^0-9a-z]+', ' ', 'g')), ' ') AS w
              FROM u),
        g AS (SELECT doc_id, unit, list_sort(list_distinct(list_filter(w, lambda x: list_contains(
                     {texts(licenses.TELLING)}, x)))) AS tell,
                     list_distinct(CASE WHEN len(w) < 2 THEN w
                  ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END) AS a FROM w WHERE w <> ['']),
        d AS (SELECT doc_id, unit, license, k, 2.0 * len(list_intersect(a, b)) / (len(a) + len(b)) AS dice
              FROM g JOIN t ON g.tell = t.tell
                           AND len(a) BETWEEN {licenses.THRESHOLD} * len(b) / (2 - {licenses.THRESHOLD}) - 1e-6
                                      AND (2 - {licenses.THRESHOLD}) * len(b) / {licenses.THRESHOLD} + 1e-6),
        r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, unit ORDER BY dice DESC, k) AS n FROM d
              WHERE dice >= {licenses.THRESHOLD})
        SELECT doc_id, unit, license, CAST(dice AS DOUBLE) AS dice FROM r WHERE n = 1"""


ORACLE_SQL: dict[str, str] = {
    "op4_license_scan": _license_sql(),
    "op9_top_k": r"""
        WITH v AS (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS x
                   FROM embeddings
                   WHERE embedding IS NOT NULL
                     AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        p AS (SELECT q.vec_id AS query_id, c.vec_id,
                     CAST(list_inner_product(CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op8_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
                   FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(body) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY body)""",
}
