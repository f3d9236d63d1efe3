"""The registered queries against SQL where there is any; all of them run and keep their rows."""

import pytest
from compare import connect, mismatch

from orbitlake.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    with connect(SF_DIR) as con:
        want = con.execute(SQL[name]).df()
    assert mismatch(QUERIES[name](spark, SF_DIR).toPandas(), want) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, name):
    table, each = {"op6": ("embeddings", 1), "op11": ("embeddings", 4)}.get(
        name.split("_")[0], ("documents", 1)
    )
    rows = spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    assert QUERIES[name](spark, SF_DIR).count() == each * rows


def test_pipeline_on_awkward_documents(spark, tmp_path):
    import brute

    import corpus_pipeline

    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    docs = brute.awkward(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    result = corpus_pipeline.run(spark, str(tmp_path))
    ids = {r["doc_id"] for r in docs.collect()}
    rows = result.collect()
    assert rows and {r["doc_id"] for r in rows} <= ids
    assert result.columns[: len(docs.columns)] == docs.columns
