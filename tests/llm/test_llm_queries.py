"""The registered training-data queries: SQL where there is one, and the pipeline's stages."""

import os

import pytest

import corpus_pipeline
from tracewater.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_there_is_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_sql(spark, key):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    want = con.execute(SQL[key])
    columns = [c[0] for c in want.description]
    df = QUERIES[key](spark, SF_DIR)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(repr, want.fetchall()))


def test_pipeline_keeps_columns_and_repeats_nothing_near(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(150)
    docs = docs.unionByName(docs.limit(3)).selectExpr("*", "1 AS score", "2 AS place")
    n = [docs.count()]
    for name, apply in corpus_pipeline.STAGES[:-1]:
        out = apply(spark, docs, SF_DIR)
        assert out.columns == docs.columns
        rows = out.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        n.append(len(rows))
        if name == "near_duplicates":
            assert len({r.doc_id for r in rows}) == len(rows)
    assert n[0] > n[1] > n[2] >= n[3] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert "ids" in last.columns and last.count() == n[4]


def test_stages_take_odd_columns_nulls_and_long_texts(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60)
    odd = spark.createDataFrame([(None, None), (None, ""), (990001, None), (990002, ""), (990002, ""), (990003, "word " * 60_000)], "doc_id long, text string")
    docs = docs.unionByName(odd.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang", "CAST(NULL AS string) AS source", "length(text) AS n_chars").to(docs.schema))
    docs = docs.selectExpr("*", "'x' AS `a.b`", "map('k', doc_id) AS m", "1.5 AS score", "2 AS n_removed")
    for name, apply in corpus_pipeline.STAGES:
        if name != "quality":  # its fit needs labelled texts, which the other tests have
            out = apply(spark, docs, SF_DIR)
            assert out.columns[: len(docs.columns)] == docs.columns
            assert out.count() > 0
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = corpus_pipeline.quality.score(docs, corpus_pipeline.quality.fit(docs, labels))
    assert set(scored.columns) == set(docs.columns) and scored.count() == docs.count()


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, apply in corpus_pipeline.STAGES[:-1]:
        assert apply(spark, docs, SF_DIR).count() == 0
