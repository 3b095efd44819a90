"""The pipeline stage by stage, and the registered queries with SQL."""

import sys

import pytest
from oracle import compare, connect
from odd_rows import docs, empty, small  # noqa: F401
from pyspark.sql import functions as F

from conftest import ROOT
from tillsight.llm.queries import ORACLES, QUERIES

sys.path.insert(0, ROOT)
import corpus_pipeline as pipeline  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, small, name):
    assert compare(QUERIES[name](spark, small), connect(small), ORACLES[name]) is None


def test_every_query_is_registered():
    import __spark_entry__ as entry

    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    seen = [docs.count()]
    kept = docs
    for name, stage in pipeline.STAGES[:-1]:
        kept = stage(spark, kept, small)
        assert kept.schema == docs.schema, name
        seen.append(kept.count())
    assert seen == sorted(seen, reverse=True) and seen[2] < seen[1] and seen[4] == seen[3] > 0
    assert kept.filter("n_chars <> length(text)").count() == 0
    assert pipeline.STAGES[-1][1](spark, kept, small).count() == seen[-1]


def test_stages_leave_odd_rows_whole(spark, small, docs, empty):
    for name, stage in pipeline.STAGES[:-1]:
        got = stage(spark, docs, small)
        assert got.columns == docs.columns, name
        assert {0, 1, 2, 3} <= {r.doc_id for r in got.select("doc_id").collect()}, name
        assert stage(spark, empty, small).count() == 0, name


def test_one_of_each_group_stays(spark, small, docs):
    from tillsight.llm.near_duplicates import near_duplicates

    got = pipeline.drop_near_duplicates(spark, docs, small)
    found = near_duplicates(docs)
    groups = found.filter("n_shingles > 0 AND component_id IS NOT NULL").select("component_id").distinct().count()
    assert got.filter(F.length(F.trim(F.regexp_replace("text", "[\\n\\t]", ""))) > 0).filter("doc_id IS NOT NULL").count() == groups


def test_redaction(spark, small):
    rows = [(1, "mail a@b.co now"), (2, "é +1 (555) 200-1000, 1.2.3.4"), (3, None), (4, "clean")]
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], "doc_id long, text string, n_chars int")
    got = {r.doc_id: (r.text, r.n_chars) for r in pipeline.redact_private(spark, docs, small).collect()}
    assert got == {1: ("mail [EMAIL] now", 16), 2: ("é [PHONE], [IP]", 15), 3: (None, 0), 4: ("clean", 5)}
