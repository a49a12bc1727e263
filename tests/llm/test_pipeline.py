"""The corpus pipeline's stages and the registered queries against their SQL and brute force."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from lilt.llm import language, queries
from lilt.llm.oracles import ORACLES
from tests.llm.test_operators import brute_components

SF = "/root/testdata/sf0.001"


def test_registered():
    assert {f"op{n}" for n in range(1, 11)} == {q.split("_")[0] for q in queries.QUERIES}
    assert set(ORACLES) <= set(queries.QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = db.sql(ORACLES[name])
    columns = sorted(want.columns)
    rows = sorted(map(repr, want.project(", ".join(columns)).fetchall()))
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    assert sorted(repr(tuple(r)) for r in got.select(*columns).collect()) == rows


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(9001, None, None, None, None), (9002, "", "en", "src1", 0), (9003, "The and of " * 4000, "en", "src2", 44000), (9004, "12 34 ##", "en", "src3", 8)]
    current = docs.union(docs.limit(5)).union(spark.createDataFrame(odd, docs.schema))
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, current, SF)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns, name
        out.write.parquet(f"{tmp_path}/{i}")
        before, current = current, spark.read.parquet(f"{tmp_path}/{i}")
        n, m = before.count(), current.count()
        if name == "language_id":
            assert {r.doc_id for r in current.collect()}.isdisjoint({9001, 9002, 9004}) and n - m <= 0.02 * n + 3
        elif name == "line_dedup":
            assert n == m
        elif name == "jaccard_join":
            components = brute_components([(r.doc_id, r.text) for r in before.collect()], 5, 80)
            assert {r.doc_id for r in current.collect()} == {i for i, (_, c) in components.items() if i == c}
        elif name == "mix_sources":
            assert current.groupBy("doc_id").count().where("count > 6").count() == 0
        else:
            assert n == m and current.where(~F.col("restored")).count() == 0


def test_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_lang_is_no_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs)
    plain = language.identify(docs, model).select("doc_id", "lang_pred", "score")
    swapped = language.identify(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")), model).select("doc_id", "lang_pred", "score")
    assert plain.exceptAll(swapped).count() == 0
