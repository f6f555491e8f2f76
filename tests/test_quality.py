"""Checks, their tolerance and the monitor."""

from __future__ import annotations

import datetime as dt

import pytest

from spokecast.operators import quality, suites
from spokecast.operators.quality import Check


def outcome(df, check, **tables):
    return quality.run_suite(df, (check,), "t", tables).first()


@pytest.mark.parametrize(("outside", "success"), [(1, True), (2, False)])
def test_between_with_tolerance(spark, outside, success):
    df = spark.createDataFrame([(5.0,)] * (100 - outside) + [(999.0,)] * outside + [(None,)] * 5, "x double")
    row = outcome(df, Check("between", "x", low=1, high=10, mostly=0.99))
    assert (row.evaluated, row.unexpected, row.success) == (100, outside, success)


def test_unique_ignores_nulls_but_combinations_do_not(spark):
    df = spark.createDataFrame([(1, None), (None, None), (None, None), (2, 3), (2, 3)], "a int, b int")
    row = outcome(df, Check("unique", "a"))
    assert (row.evaluated, row.unexpected) == (3, 2)
    assert outcome(df, Check("unique_combination", columns=("a", "b"))).unexpected == 4


def test_pair_with_one_side_missing_fails(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (2.0, 2.0), (3.0, 1.0)], "a double, b double")
    row = outcome(df, Check("pair_greater", "a", other="b", or_equal=True))
    assert (row.evaluated, row.unexpected) == (3, 1)
    assert outcome(df, Check("pair_greater", "a", other="b")).unexpected == 2


def test_missing_column_fails(spark):
    row = outcome(spark.range(1), Check("not_null", "nothing"))
    assert (row.evaluated, row.success) == (0, False)


def test_relationship(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,)], "k int")
    row = outcome(child, Check("relationship", "k", parent="p"), p=parent)
    assert (row.evaluated, row.unexpected, row.success) == (3, 2, False)


def test_warn_severity_does_not_fail_a_source(spark):
    df = spark.createDataFrame([("x",)], "c string")
    results = quality.run_suite(df, (Check("in_set", "c", values=("y",), severity="warn"),), "s")
    assert quality.with_status(results).first().status == "warn"
    assert quality.source_records(results).first().status == "pass"


@pytest.mark.parametrize(("staged", "success"), [(99, True), (98, False)])
def test_row_loss(spark, staged, success):
    row = quality.row_loss(spark.range(100), spark.range(staged), "id").first()
    assert (row.records_lost, row.success) == (100 - staged, success)


def test_freshness_limits(spark):
    today = dt.date(2024, 3, 31)
    tables = {
        f"age{n}": (spark.createDataFrame([(today - dt.timedelta(days=n),)], "d date"), "d") for n in (10, 11, 15, 16)
    }
    tables["none"] = (spark.createDataFrame([], "d date"), "d")
    rows = {r.source: (r.status, r.check_status) for r in quality.freshness(tables, "2024-03-31").collect()}
    assert rows == {
        "age10": ("OK (10d)", "pass"),
        "age11": ("WARN (11d)", "warn"),
        "age15": ("WARN (15d)", "warn"),
        "age16": ("STALE (16d)", "error"),
        "none": ("NO DATA", "error"),
    }


def test_declared_checks():
    assert [len(s) for s in suites.RAW_SUITES.values()] == [14, 8, 4, 5]
    assert sum(len(s) for s in (*suites.SOURCE_KEYS.values(), *suites.MODEL_SUITES.values())) == 149
    assert len(suites.FACTOR_NAMES) == 17 and len(suites.AREAS) == 10


def test_monitor_reads_the_newest_run(spark, tmp_path):
    path = str(tmp_path / "results")
    good = quality.run_suite(spark.range(3), (Check("row_count", low=1),), "a")
    bad = quality.run_suite(spark.range(0), (Check("row_count", low=1),), "b")
    quality.append_results(quality.stamp_run(quality.source_records(bad), "old", "2024-01-01 00:00:00"), path)
    newest = quality.source_records(good).unionByName(quality.source_records(bad))
    quality.append_results(quality.stamp_run(newest, "new", "2024-01-02 00:00:00"), path)
    latest = quality.latest_run(quality.stored_results(spark, path))
    assert {r.run_id for r in latest.collect()} == {"new"}
    kpis = quality.run_kpis(latest).first()
    assert (kpis.total_tests, kpis.passed, kpis.failed, kpis.pass_rate) == (2, 1, 1, 50.0)
    assert quality.failed_tests(latest).first().details == "Failed 1 expectations"


def test_key_checks_of_a_table_share_one_scan(spark):
    rows = [(1, "a", None), (1, "b", 5), (2, None, 5), (None, None, None), (None, None, None), (3, "a", 7)]
    df = spark.createDataFrame(rows, "x int, y string, z int")
    checks = (
        quality.Check("unique", "x"),
        quality.Check("unique", "z"),
        quality.Check("unique_combination", columns=("x", "y")),
        quality.Check("unique_combination", columns=("z", "y", "x")),
        quality.Check("unique_combination", columns=("y", "x", "z")),
        quality.Check("not_null", "y"),
    )
    found = quality.run_suite(df, checks, "t")
    got = {r.check_no: (r.evaluated, r.unexpected, r.success) for r in found.collect()}
    assert got == {1: (4, 2, False), 2: (3, 2, False), 3: (6, 2, False), 4: (6, 2, False), 5: (6, 2, False), 6: (6, 3, False)}
    text = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.count("Scan ExistingRDD") + text.count("LocalTableScan") == 2  # rows once, all keys once
    empty = quality.run_suite(df.where("false"), checks, "t").collect()
    assert {(r.evaluated, r.unexpected, r.success) for r in empty} == {(0, 0, True)}
