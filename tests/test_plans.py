"""Physical-plan properties: pushdown, pruning, shuffle reuse, no Python in the plans."""

import io
from contextlib import redirect_stdout

import pytest

from kestrel.plans import documents, mileage, relational, scalars
from kestrel.plans.registry import QUERIES, load_all

load_all()


def _explain(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_day_filter_reaches_the_scan(spark, sf_dir):
    plan = _explain(QUERIES["filter_day"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan


def test_flagship_reads_only_needed_columns_and_reuses_its_shuffle(spark, sf_dir):
    df = QUERIES["vehicle_mileage"](spark, sf_dir)
    plan = _explain(df)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan   # no value/props/type
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


BATCH_QUERIES = sorted(n for n, f in QUERIES.items()
                       if f.__wrapped__.__module__ in {m.__name__ for m in (mileage, relational, scalars, documents)})


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_no_python_evaluation_in_plans(spark, sf_dir, name):
    plan = _explain(QUERIES[name](spark, sf_dir))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in plan
