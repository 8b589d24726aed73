"""Rows that readers of the daily measures need, ranks in one pass, results that are read after their stage."""

import datetime as dt
import os
import re

import pytest
from helpers import bag, plan
from pyspark.sql import functions as F

from tallygrid.checks import marts
from tallygrid.operators.horizons import month_horizon, trailing_horizon
from tallygrid.operators.overlaps import months_touched, touches
from tallygrid.operators.ranking import latest_in_buckets, ranks_in_buckets, with_dense_ranks
from tallygrid.params import MonthRange
from tallygrid.plans import accruals, billing, run as runs
from tallygrid.session import Staging, fresh_path
from tallygrid.sources.testtables import TEST_RUN, billing_sources

BOTH = accruals.both_horizons(TEST_RUN)


@pytest.fixture(scope="module")
def src(spark, small):
    return billing_sources(spark, small)


@pytest.fixture(scope="module")
def stage(spark):
    return Staging(spark, fresh_path(spark, "stage"))


@pytest.fixture(scope="module")
def lines(src, stage):
    return runs.staged_lines(src, TEST_RUN, stage)


@pytest.fixture(scope="module")
def core(spark, src, lines):
    return runs.staged_core(src, lines, Staging(spark, fresh_path(spark, "stage")))


def test_a_period_touches_the_months_it_has_rows_in(spark):
    days = [None, *(dt.date(2000, m, d) for m in (1, 3, 4, 6, 7) for d in (1, 30))]
    periods = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate((a, b) for a in days for b in days)], "id int, a date, b date")
    months = MonthRange(dt.date(2000, 3, 1), dt.date(2000, 6, 1))
    a, b = F.col("a"), F.col("b")
    want = {r.id for r in months_touched(periods, months, a, b).collect()}
    got = periods.select("id", touches(months, a, b).alias("t")).collect()
    assert {r.id for r in got if r.t} == want and not [r for r in got if r.t is None] and 0 < len(want) < len(got)


def test_ranks_in_one_pass(spark):
    rows = spark.range(600).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("k"),
        *[F.when(F.col("id") % n > 0, F.date_add(F.lit(dt.date(2000, 1, 1)), (F.col("id") % n).cast("int"))).alias(c) for c, n in (("a", 11), ("b", 13))],
    )
    ranks = {"a": "ra", "b": "rb"}
    got = ranks_in_buckets(rows, "k", ranks)
    assert bag(got) == bag(with_dense_ranks(rows, "k", ranks)) and "Join" not in plan(got)


def test_ranked_bills_read_the_core_once(src, lines, core, stage):
    got = runs.ranked_core(src, lines, stage)
    assert bag(got) == bag(billing.ranked_bills(core))
    above = plan(got).split("== Physical Plan ==")[1].split("Union")[0]
    assert "Join" not in above and len(re.findall("Exchange hashpartitioning", above)) == 1


def test_rows_in_reach_serve_every_reader(src, lines, core):
    reach = billing.Reach(BOTH, latest=True)
    some = billing.invoice_core_from_posted(src, lines.posted, lines.buckets, reach)
    key = "seq_product_item_id", "bill_sdt", "bill_edt"
    touching = touches(BOTH, F.col("bill_sdt"), F.col("bill_edt"))
    latest = bag(latest_in_buckets(core, *key))
    assert bag(latest_in_buckets(some, *key)) == latest
    assert bag(some.filter(touching)) == bag(core.filter(touching))
    kept = bag(some)
    assert not kept - bag(core) and kept.total() < core.count()
    assert not core.filter(~touching).isEmpty() and not latest_in_buckets(core, *key).filter(~touching).isEmpty()


def test_horizons_from_rows_in_reach(src, lines, core):
    horizon, season = month_horizon(src.dim_date, TEST_RUN), trailing_horizon(src.dim_date, TEST_RUN)
    for months, read in (
        (TEST_RUN.accrual_range, lambda rows: accruals.actuals(rows, horizon, TEST_RUN)),
        (BOTH, lambda rows: accruals.seasonal_profile(rows, season, TEST_RUN)),
    ):
        some = billing.invoice_core_from_posted(src, lines.posted, lines.buckets, billing.Reach(months))
        assert bag(read(some)) == bag(read(core))


def test_a_run_stages_rows_in_reach(spark, src, core, lines):
    stage = Staging(spark, fresh_path(spark, "stage"))
    run = runs.accrual_run(src, TEST_RUN, stage)
    written = spark.read.parquet(f"{stage.root}/invoice_core")
    assert written.count() < core.count() == run.core.count()
    whole = Staging(spark, fresh_path(spark, "stage"))
    assert bag(runs.accrual_run(src, TEST_RUN, whole, whole_core=True).detail) == bag(run.detail)
    assert spark.read.parquet(f"{whole.root}/invoice_core").count() == core.count()


def test_monthly_rows_are_dealt_once(src, lines, stage):
    months = billing.invoice_core_from_posted(src, lines.posted, lines.buckets, billing.Reach(BOTH))
    monthly = stage(accruals.monthly_core(months, TEST_RUN), "monthly_core", parts="mth_sdt")
    shown = plan(accruals.monthly_profile(monthly, trailing_horizon(src.dim_date, TEST_RUN))).split("== Physical Plan ==")[1]
    assert len([k for k in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", shown) if "seq_product_item_id" in k]) == 1


def test_a_result_is_read_after_its_stage_is_left(spark):
    seen = []

    def build(stage):
        seen.append(stage)
        return stage(spark.range(100).select("id", (F.col("id") % 7).alias("k")), "rows", "k")

    frame = marts.left(spark, build)
    assert not [t for t in seen[0].tables if spark.catalog.tableExists(t)]
    assert os.path.exists(seen[0].root.removeprefix("file:"))
    for _ in range(2):
        assert frame.groupBy("k").count().agg(F.sum("count")).first()[0] == 100
