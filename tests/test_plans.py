"""Models: equivalent forms, inputs by table or file, the example graphs."""

import dataclasses
import datetime as dt
import os

import pytest
from helpers import bag, plan
from pyspark.sql import functions as F

from tallygrid.functions import discounts
from tallygrid.operators.horizons import month_horizon, trailing_horizon
from tallygrid.operators import quality
from tallygrid.operators.profiles import segment_profile
from tallygrid.operators.ranking import latest_by_maxima, latest_with_ties
from tallygrid.plans import accounts, accruals, billing, examples, results
from tallygrid.plans.run import accrual_run, stored_run
from tallygrid.session import Staging, fresh_path, inline
from tallygrid.sinks.runlog import RunLog
from tallygrid.sources.tables import BillingSources, schema_of
from tallygrid.sources.testtables import TEST_RUN, billing_sources


@pytest.fixture(scope="module")
def src(spark, small):
    return billing_sources(spark, small)


@pytest.fixture(scope="module")
def run(spark, src):
    return accrual_run(src, TEST_RUN, Staging(spark, fresh_path(spark, "stage")))


def test_adapter_has_the_declared_schemas(src):
    for name in BillingSources.names():
        declared = {f.name: f.dataType.simpleString() for f in schema_of(name)}
        actual = {f.name: f.dataType.simpleString() for f in getattr(src, name).schema}
        assert set(declared) == set(actual), name
        loose = {k for k in declared if declared[k] != actual[k]}
        assert not {k for k in loose if {declared[k], actual[k]} != {"int", "bigint"}}, name


def test_one_pass_core_equals_the_model_chain(src, run):
    lines = billing.bill_lines(src, run.posted)
    registry = billing.registry(src, lines)
    chain = billing.invoice_core(
        billing.invoice_volume(registry), billing.invoice_revenue(registry), billing.adjustment_discounts(src, run.posted)
    )
    assert bag(chain) == bag(run.core)


def test_distincts_left_out_would_not_drop_rows(run):
    for frame in (run.core, run.actual, run.imputed, run.never_billed):
        assert frame.count() == frame.distinct().count()


def test_segment_keys_join_like_the_hash(src, run):
    keys = ["mth_no", "market_sub_region", "fuel_type", "market_region", "customer_segment"]
    months = accounts.never_billed_months(run.never_billed, month_horizon(src.dim_date, TEST_RUN), TEST_RUN)
    by_hash = months.join(run.profile.select("record_hash", "measure_code", "trans_description"), "record_hash")
    by_keys = months.join(run.profile.select(*keys, "measure_code", "trans_description"), keys)
    columns = ["seq_product_item_id", "mth_sdt", "measure_code", "trans_description"]
    assert bag(by_hash, columns) == bag(by_keys, columns)


def test_a_repeated_lookup_row_counts_for_its_own_kind_only(src, run):
    def sums(changed):
        rows = billing.discount_groups(changed, run.posted).groupBy("measure_name").agg(F.sum("discount_amount").alias("n"))
        return {r.measure_name: r.n for r in rows.collect()}

    def twice(table):
        frame = getattr(src, table)
        return dataclasses.replace(src, **{table: frame.unionByName(frame.filter("adh_active_flag = 1"))})

    plain, types, on_time = sums(src), sums(twice("adjustmenttype")), sums(twice("adjustment"))
    guaranteed, eligible, paid = (kind[0] for kind in (discounts.GUARANTEED, discounts.ELIGIBLE, discounts.PAID))
    assert set(plain) == {guaranteed, eligible, paid}
    assert (types[eligible], types[paid], types[guaranteed]) == (plain[eligible], plain[paid], 2 * plain[guaranteed])
    assert (on_time[eligible], on_time[guaranteed]) == (plain[eligible], plain[guaranteed])
    assert abs(on_time[paid]) > abs(plain[paid])


def test_only_declared_line_columns_are_read(src, run):
    wide = src.invoicelineitem.withColumns({"due_date": F.lit("x"), "noise": F.lit(1)})
    posted = billing.posted_lines(dataclasses.replace(src, invoicelineitem=wide), run.accounts, TEST_RUN)
    assert posted.columns == run.posted.columns and bag(posted) == bag(run.posted)


def test_latest_bills_by_maxima_equal_those_by_rank(run):
    ranked = latest_with_ties(billing.ranked_bills(run.core), "bill_sdt_rnk", "bill_edt_rnk")
    latest = latest_by_maxima(run.core, "seq_product_item_id", "bill_sdt", "bill_edt")
    assert bag(latest) == bag(ranked.drop("bill_sdt_rnk", "bill_edt_rnk"))
    assert "Window" not in plan(latest)


def test_stored_run(spark, src, run, tmp_path):
    stage = Staging(spark, fresh_path(spark, "stage"))
    log = RunLog(spark, f"{tmp_path}/log", TEST_RUN.run_id)
    stored = stored_run(src, TEST_RUN, stage, log, f"{tmp_path}/detail", f"{tmp_path}/summary")
    columns = sorted(run.detail.columns)
    assert bag(stored.detail.select(*columns)) == bag(run.detail.select(*columns))
    assert stored.summary.count() == results.accrual_summary(run.detail, TEST_RUN).count()
    written = ("active_accounts", "posted_lines", "invoice_core", "seasonal_profile", "never_billed_months", "detail", "summary")
    assert {(r.model, r.state) for r in log.rows().collect()} == {(m, s) for m in written for s in ("start", "end")}
    counted = {r.model: r.value for r in log.counts().filter("measure = 'n_rows'").collect()}
    assert counted["detail"] == stored.detail.count() and counted["invoice_core"] == run.core.count()
    assert not os.path.exists(stage.root.removeprefix("file:"))


def test_summary_rows_without_a_measure_name_stay(spark, run):
    totals = results.accrual_summary(run.detail, TEST_RUN).drop("run_id").limit(1).withColumn("measure_name", F.lit(None).cast("string"))
    assert results.with_service_counts(totals, TEST_RUN).filter("measure_name IS NULL").count() == 1


def test_lazy_run_equals_staged_run(src, run):
    assert bag(accrual_run(src, TEST_RUN, inline).detail) == bag(run.detail)


def test_never_billed_accounts_have_no_registry_line(run, src):
    lines = billing.bill_lines(src, run.posted).select("seq_product_item_id").distinct()
    assert run.never_billed.join(lines, "seq_product_item_id").isEmpty()


def test_summary_adds_a_count_row_per_billing_days_row(run):
    summary = results.accrual_summary(run.detail, TEST_RUN)
    days = summary.filter("measure_code LIKE 'DAY%'").count()
    counts = summary.filter("measure_code = 'SERVICES'")
    assert counts.count() == days > 0
    assert counts.filter("measure_value <> service_count").isEmpty()
    assert results.summary_extract(summary, 7).count() == 7


def test_detail_totals_survive_the_summary(run):
    detail = run.detail.agg(F.sum("measure_value")).first()[0]
    kept = results.accrual_summary(run.detail, TEST_RUN).filter("measure_code <> 'SERVICES'")
    assert kept.agg(F.sum("measure_value")).first()[0] == detail


def test_actual_days_never_exceed_the_month(run):
    assert run.actual.filter("total_days < 1 OR total_days > 31").isEmpty()


def test_plans_avoid_products_and_python(src):
    for frame in (accrual_run(src, TEST_RUN, inline).detail,):
        text = plan(frame)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        assert "PythonUDF" not in text and "MapInPandas" not in text


def test_sources_from_files_and_tables(spark, src, run, tmp_path):
    for name in BillingSources.names():
        frame = getattr(src, name)
        typed = frame.select(*[F.col(f.name).cast(f.dataType) for f in schema_of(name)])
        typed.write.parquet(f"{tmp_path}/{name}")
        spark.read.parquet(f"{tmp_path}/{name}").createOrReplaceTempView(f"billing_{name}")
    files = BillingSources.from_files(spark, str(tmp_path))
    active = accounts.active_accounts(files, TEST_RUN)
    assert bag(active) == bag(run.accounts)
    for name in BillingSources.names():
        spark.sql(f"CREATE TABLE IF NOT EXISTS t_{name} USING parquet LOCATION '{tmp_path}/{name}'")
    spark.sql("CREATE DATABASE IF NOT EXISTS billing_src")
    for name in BillingSources.names():
        spark.sql(f"CREATE TABLE IF NOT EXISTS billing_src.{name} USING parquet LOCATION '{tmp_path}/{name}'")
    tables = BillingSources.from_tables(spark, "billing_src", "billing_src.dim_date")
    assert bag(accounts.active_accounts(tables, TEST_RUN)) == bag(run.accounts)


def test_hot_segment_profile_counts_accounts_once(spark):
    rows = spark.range(3000).select(
        *[F.lit("x").alias(c) for c in ("fuel_type", "market_region", "market_segment", "customer_segment", "market_sub_region")],
        F.lit(1).alias("mth_no"),
        (F.col("id") % 3).alias("kind"),
        (F.col("id") % 50).alias("seq_product_item_id"),
        F.lit(2).cast("decimal(28,15)").alias("daily_amt"),
    )
    got = segment_profile(rows, ("daily_amt",), ("kind",)).select("kind", "account_number_count", "record_count").collect()
    assert sorted(tuple(r) for r in got) == [(0, 50, 50), (1, 50, 50), (2, 50, 50)]


def test_position_graph_on_literals(spark):
    models = examples.position_graph(examples.position_leaves(spark))
    ids = sorted(r[0] or "" for r in models["positions"].collect())
    assert ids == ["", *[f"1_{n}" for n in range(2, 10)]]
    assert quality.passes(quality.unique(models["positions"], "id"))
    assert not quality.passes(quality.not_null(models["positions"], "id"))
    outside = quality.accepted_values(models["position_5"], "id", examples.ACCEPTED_POSITIONS)
    assert [r[0] for r in outside.collect()] == ["1_9"]
    assert models["positions"].filter("id = '1_1'").count() == 0


def test_example_chain(spark):
    chain = examples.example_chain(examples.literal_rows(spark, [1, None], "int"))
    assert [chain[k].count() for k in ("first", "second", "third", "fourth")] == [2, 1, 1, 1]
    assert not quality.passes(quality.not_null(chain["first"], "id"))


def test_trailing_horizon_feeds_the_profile(src, run):
    months = {r[0] for r in trailing_horizon(src.dim_date, TEST_RUN).select("mth_no").distinct().collect()}
    assert {r[0] for r in run.profile.select("mth_no").distinct().collect()} <= months
    assert TEST_RUN.seasonal_range.first == dt.date(1999, 7, 1)
