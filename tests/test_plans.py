"""What the plans must and must not contain."""

import contextlib
import io
import re

import pytest

from matchloom.plans.catalog import QUERIES
from tests.test_oracle import SF

# Write or stream before they return, so their last plan is only a read.
WRITERS = {
    "gold_table", "land_by_event_date", "path_ds_load", "replace_partition", "stream_gold",
    "stream_rejected", "stream_dedup", "stream_ingest_new", "stream_gold_window",
}
LAZY = sorted(n for n in QUERIES if n not in WRITERS and not n.startswith("ml_"))


def plan(spark, name):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        QUERIES[name](spark, SF).explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_row_udf(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "PythonUDF"):
        assert bad not in text
    assert ("MapInArrow" in text) == (name == "shap_fixed_trees")
    assert ("ArrowEvalPython" in text) == (name == "role_by_rules")


NARROW = [
    "frame_time", "parse_json_events", "variant_get", "scan_one_day", "feature_columns",
    "position_label", "train_test_split", "shap_fixed_trees", "normalize_host", "mask_secrets",
]


@pytest.mark.parametrize("name", NARROW)
def test_row_operators_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(spark, name)


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("scan_one_day", "GreaterThanOrEqual(o_orderdate"),
        ("drop_incomplete", "IsNotNull(o_totalprice)"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan(spark, name)


def test_dropping_nulls_makes_an_inner_join(spark):
    text = plan(spark, "drop_incomplete")
    assert "Join type: Inner" in text and "LeftOuter" not in text


def test_scans_read_needed_columns_only(spark):
    schemas = re.findall(r"ReadSchema: struct<(.*)>", plan(spark, "recent_match_ids"))
    assert schemas == ["l_orderkey:bigint,l_suppkey:bigint,l_shipdate:timestamp_ntz"]


def test_rank_filters_before_the_shuffle(spark):
    text = plan(spark, "recent_match_ids")
    assert "row_number(), 5, Final" in text and "row_number(), 5, Partial" in text or text.count("WindowGroupLimit") >= 2
