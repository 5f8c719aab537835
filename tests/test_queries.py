"""Registered queries against DuckDB on the smallest data set.

A part of the queries by default; all of them with ALL_QUERIES=1.
"""

import os
from pathlib import Path

import compare
import pytest

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
QUICK = [
    "scan_parquet", "csv_roundtrip", "json_roundtrip", "filter_codes_prefix", "patient_info",
    "code_to_group", "crosswalk_codes", "outlier_bounds_observations", "disease_patients",
    "index_date_control", "control_cohort", "sample_exact", "clean_labs",
    "numeric_window_just_before", "rule_labels", "performance", "prevalence_lift",
    "demographics_continuous", "significance_select", "build_lab_conf",
    "build_code_conf", "clean_treatments", "clean_observations", "clean_measurements", "clean_notes",
    "outlier_bounds_stage",
]
NAMES = sorted(set(driver.queries()) - set(driver.LLM_QUERIES)) if os.environ.get("ALL_QUERIES") else QUICK

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    with compare.connect(FOLDER) as connection:
        yield connection


def test_every_query_has_its_sql():
    assert set(driver.queries()) - set(driver.LLM_QUERIES) == set(driver.oracle_sql()) - set(driver.LLM_SQL)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    result = driver.queries()[name](spark, FOLDER)
    assert compare.difference(result, duck, driver.oracle_sql()[name]) is None


def test_entry_has_one_row_per_screened_patient(spark):
    result = driver.entry(spark)
    assert result.count() == result.select("PTID").distinct().count() > 0
