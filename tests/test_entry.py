from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check_queries  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from feedloom.plans.oracles import ORACLES  # noqa: E402
from feedloom.plans.queries import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"

needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) <= set(entry.oracle_sql())
    assert set(QUERIES) <= set(entry.queries())


@needs_data
def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "id" and df.limit(1).count() == 1


@needs_data
@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name):
    assert check_queries.compare(spark, FOLDER, name).startswith("equal")


@needs_data
def test_parse_plan_has_no_shuffle(spark):
    from feedloom.plans import capture
    from feedloom.plans.ingest import parse_pages
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    parsed = parse_pages(capture.faulty_pages(docs, F.lit(0)), "2026-01-01")
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    # One function for the texts of a post, one for the context of modules.
    assert plan.count("ArrowEvalPython [") == 2
    assert "BatchEvalPython" not in plan


@needs_data
def test_profile_plan_parses_once(spark):
    plan = QUERIES["users_upsert"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.lower().count("parse_json") + plan.lower().count("parsejson") == 1
