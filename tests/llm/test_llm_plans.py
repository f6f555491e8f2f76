"""Plan shapes of the corpus queries."""

from __future__ import annotations

import pytest

from spokecast.llm.registered import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_or_nested_loop_join(spark, sf_dir, name):
    text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text


def test_sharding_stays_out_of_python(spark, sf_dir):
    text = QUERIES["op4_sharding"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "InArrow" not in text and "InPandas" not in text and "Python" not in text
