"""Registered queries: contract, and a spread of them against their SQL."""

import os

import pytest

import __spark_entry__ as entry_point
from checks import compare

SMALL = "/root/testdata/sf0.001"
SPREAD = [
    "flagship_naive_error_by_segment", "s3_parse_hourly_payload", "s8_read_predictions", "p8_recent_actuals", "j3_overlay_cells",
    "j12_row_to_origin", "j14_a2_station_weighted_mean", "u4_matched_hours", "a7_metrics_by_segment", "a11_t3_range_violations",
    "a16_served_performance", "w1_lag_set", "w4_rolling_row_mape", "w5_latest_per_target", "w6_axis_breaks", "f8_lead_time",
    "c3_merge_trailing_pull", "c7_validation_report", "c15_rolling_origins", "c25_choose_reference", "c26_two_sample_whole_table",
    "c29_retrain_due", "c32_promotion_decision", "m3_quantile_band", "x2_revised_hourly_stream",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")


def test_contract():
    names = entry_point.queries()
    assert set(entry_point.oracle_sql()) <= set(names)
    assert len(names) > 150


def test_entry_has_rows(spark):
    assert not entry_point.entry(spark).isEmpty()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SMALL)


@pytest.mark.parametrize("name", SPREAD)
def test_query_equals_its_sql(spark, con, name):
    problem, _, _ = compare.check(spark, con, SMALL, name)
    assert problem is None
