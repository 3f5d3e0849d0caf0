"""The registered queries: SQL where there is some, and the pipeline's stages on odd rows."""

import duckdb
import pytest

import corpus_pipeline
from retail_marts.llm import catalog
from retail_marts.llm.common import TABLES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = catalog.QUERIES[name](spark, SF).toPandas(), con.sql(catalog.ORACLE[name]).df()
    rows = lambda d: sorted(map(repr, d[sorted(d.columns)].astype(str).itertuples(index=False, name=None)))
    assert rows(got) == rows(want)


def test_names_cover_the_operators():
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {q.split("_")[0] for q in catalog.QUERIES}


def test_stages_take_empty_and_odd_tables(spark):
    odd = spark.createDataFrame([(1, None, "en", "a", 0, "x"), (None, "some text 12", None, None, 5, "x"), (2, "", "en", "a", 0, None), (3, "few words here", "en", "a", 14, "x"),
                                 (3, "few words here", "en", "a", 14, "x")], "doc_id long, text string, lang string, source string, n_chars long, hits string")
    for name, stage in corpus_pipeline.STAGES:
        for df in (odd, odd.limit(0)):
            out = stage(spark, df, SF)
            assert out.columns[:6] == odd.columns, name
            assert out.count() <= 5 * 4
    assert corpus_pipeline.near_duplicates(spark, odd, SF).where("doc_id = 3").count() == 1
