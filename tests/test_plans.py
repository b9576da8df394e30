"""Plan checks over every registered query."""

import pytest

from tidepool.plans import ORACLES, QUERIES

STREAMING = {"audit_stream", "audit_stream_history", "audit_stream_keyed", "audit_stream_keyed_history"}
# markup is walked, and the bytes of image files are made pixels, in Arrow batches
PYTHON_OK_PREFIXES = ("extract_", "site_rules", "crawl_expand", "image_scan")


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    out = {}
    for name, fn in QUERIES.items():
        if name in STREAMING:
            continue
        out[name] = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    return out


def test_no_cartesian_or_row_udf(plans):
    for name, p in plans.items():
        assert "CartesianProduct" not in p, name
        assert "BroadcastNestedLoopJoin" not in p, name
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_python_only_in_pages_and_image_files(plans):
    for name, p in plans.items():
        if "MapInPandas" in p or "PythonMapInArrow" in p:
            assert name.startswith(PYTHON_OK_PREFIXES), name


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLES)
