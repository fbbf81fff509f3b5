"""Plans stay distributed: no pairing of everything with everything, pruned scans."""

import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
BATCH = sorted(q for q in QUERIES if not q.startswith(("stream_", "sink_", "score_", "rag", "pipeline")) and not re.match(r"op\d+_", q))


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_product(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "InPandas" not in plan


def test_scan_reads_only_what_is_needed(spark):
    plan = QUERIES["semantic_entropy"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan


def test_redaction_has_one_exchange_at_most(spark):
    plan = QUERIES["redact_mask"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 1  # only the spread of a small file
