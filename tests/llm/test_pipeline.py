"""The pipeline against its operators' brute-force rules on the small documents, and the queries' SQL twins."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from spark_marts.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_ten_queries_and_the_pipeline_are_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(ORACLE[name])
    cols = sorted(want.columns)
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == cols
    rows = want.project(", ".join(f'"{c}"' for c in cols)).fetchall()
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(rows)


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows, sizes = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.materialize(stage(spark, rows, SF), name)
        assert out.dtypes == docs.dtypes, name
        assert out.select("doc_id").subtract(rows.select("doc_id")).count() == 0
        rows = out
        sizes.append(rows.count())
    assert sizes[1] < sizes[0] and sizes[2] == sizes[1] and sizes[3] <= sizes[2] and sizes[4] < sizes[3]
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, SF)
    whole = packed.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert len(whole) == sizes[4] and all(r["sum(length)"] == r["max(doc_tokens)"] for r in whole)
