import re

import corpus_pipeline
import edge

from footfall.llm import language, secretscan
from footfall.llm.oracle import oracle_sql
from footfall.llm.queries import queries

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns
            ids = {r.doc_id for r in after.select("doc_id").collect()}
            assert ids <= {r.doc_id for r in docs.select("doc_id").collect()} and ids
        if name == "secret scans":
            assert all(r.secrets == [] for r in secretscan.find_secrets(after).collect())
        docs = after
    assert {"doc_id", "n_tokens", "token_ids", "decoded"} <= set(docs.columns)


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert len(rows) == len({r.doc_id for r in rows}) > 100
    assert all(r.n_tokens == len(r.token_ids) == len(r.decoded.split()) for r in rows)


def test_names_and_sql():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in queries()]
    assert numbers == list(range(1, 14))
    assert set(oracle_sql()) <= set(queries())
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_on_edges(spark):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, edge.empty(spark), SF).count() == 0
        stage(spark, edge.documents(spark), SF).collect()
    assert language.keep_known(edge.documents(spark)).count() > 0
