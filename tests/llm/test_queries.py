"""The registered queries: SQL where there is some, and the pipeline stage by stage."""

import duckdb
import pytest

import corpus_pipeline
from verlog.llm import queries
from verlog.sources.testdata import TABLES, table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    seen = docs
    counts = []
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, seen, SF)
        assert out.columns == docs.columns
        seen = corpus_pipeline.stage(out, "test")
        ids = {r[0] for r in seen.select("doc_id").collect()}
        assert ids <= {r[0] for r in docs.select("doc_id").collect()}
        counts.append(len(ids))
    assert counts == sorted(counts, reverse=True)
    last = corpus_pipeline.STAGES[-1][1](spark, seen, SF)
    assert last.count() == seen.count()
    run = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, last.collect()))
