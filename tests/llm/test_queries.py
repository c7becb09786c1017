"""The registered queries on the small tables: whole results, and SQL where
there is some."""

import math

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from stellate.llm.queries import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = [n for n in queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in queries() and set(ORACLE_SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    df = QUERIES[name](spark, DIR)
    found = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in found.description]
    assert sorted(cols) == sorted(df.columns)
    tidy = lambda v: round(v, 9) if isinstance(v, float) else v
    want = sorted(str(tuple(map(tidy, r))) for r in found.fetchall())
    assert sorted(str(tuple(map(tidy, r))) for r in df.select(*cols).collect()) == want


def test_pages_and_conversations(spark):
    pages = spark.read.parquet(f"{DIR}/pages.parquet")
    rows = QUERIES["op11_html_text"](spark, DIR)
    assert rows.columns == ["page_id", "url", "text", "n_chars"] and rows.count() == pages.count()
    convs = spark.read.parquet(f"{DIR}/conversations.parquet").select("conv_id").distinct().count()
    found = QUERIES["op12_conversation_repair"](spark, DIR).collect()
    assert len(found) == len({r.conv_id for r in found}) == convs
    nodes = QUERIES["op13_prefix_trie"](spark, DIR)
    root = nodes.where("depth = 0").collect()
    assert len(root) == 1 and root[0].n_convs == convs and root[0].parent_conv_id is None
    assert nodes.where("n_children = 0").count() == root[0].n_leaves
    assert {"saved_tokens", "ends_sha256"} <= set(nodes.columns)


@pytest.mark.parametrize("name,cols", [
    ("op1_mix_sources", "doc_id size source_size target taken"),
    ("op2_simhash", "doc_id fingerprint component_id"),
    ("op3_token_files", "doc_id start n_tokens ids_crc32"),
    ("op5_lm_score", "doc_id held_out n_tokens n_known train_tokens base_score score"),
    ("op6_language_id", "doc_id held_out lang_pred score"),
    ("op10_quality", "doc_id held_out score predicted")])
def test_one_row_a_document(spark, name, cols):
    docs = {r.doc_id for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id").collect()}
    df = QUERIES[name](spark, DIR)
    assert set(cols.split()) <= set(df.columns)
    rows = df.collect()
    assert len(rows) == len(docs) and {r.doc_id for r in rows} == docs
    assert not any(v is None or (isinstance(v, float) and math.isnan(v)) for r in rows for v in r)
