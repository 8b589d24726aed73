"""The accrual models on the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.checks.mart_sql import number, with_ctes
from tallygrid.checks.shape import shown
from tallygrid.operators.horizons import month_horizon, trailing_horizon
from tallygrid.params import MonthRange
from tallygrid.plans import accounts, accruals, billing, results
from tallygrid.plans.run import AccrualRun, accrual_run, ranked_core, staged_lines, stored_run
from tallygrid.session import Staging, fit_partitions, fresh_path, prepare, shuffles_freed
from tallygrid.sinks.runlog import RunLog
from tallygrid.sinks.tables import row_count
from tallygrid.sources.tables import BillingSources
from tallygrid.sources.testtables import TEST_RUN, billing_sources, table

Query = Callable[[SparkSession, str], DataFrame]


def sources(spark: SparkSession, sf_dir: str) -> BillingSources:
    fit_partitions(prepare(spark), *(table(spark, sf_dir, name) for name in ("customer", "orders", "lineitem")))
    return billing_sources(spark, sf_dir)


def staging(spark: SparkSession) -> Staging:
    return Staging(spark, fresh_path(spark, "stage"))


def finished(spark: SparkSession, build: Callable[[Staging], DataFrame]) -> DataFrame:
    """What ``build`` makes of staged frames, stored as it is shown, so that the staged frames can go."""
    with staging(spark) as stage:
        frame, path = shown(build(stage)), fresh_path(spark, "result")
        with shuffles_freed(spark):
            frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def left(spark: SparkSession, build: Callable[[Staging], DataFrame]) -> DataFrame:
    """What ``build`` makes of staged frames, for large results: they are not stored before they are read."""
    stage = staging(spark)
    frame = shown(build(stage))
    stage.leave()
    return frame


def _finished(spark: SparkSession, sf_dir: str, build: Callable[[BillingSources, Staging], DataFrame]) -> DataFrame:
    src = sources(spark, sf_dir)  # before the stage is made, whose buckets follow the partitions fitted there
    return finished(spark, lambda stage: build(src, stage))


def _left(spark: SparkSession, sf_dir: str, build: Callable[[BillingSources, Staging], DataFrame]) -> DataFrame:
    src = sources(spark, sf_dir)
    return left(spark, lambda stage: build(src, stage))


def _model(build: Callable[[BillingSources], DataFrame]) -> Query:
    return lambda spark, sf_dir: shown(build(sources(spark, sf_dir)))


def _result(pick: Callable[[AccrualRun], DataFrame], end: Callable[..., DataFrame] = _finished) -> Query:
    return lambda spark, sf_dir: end(spark, sf_dir, lambda src, stage: pick(accrual_run(src, TEST_RUN, stage)))


def _staged(build: Callable[[BillingSources, Staging], DataFrame], end: Callable[..., DataFrame] = _finished) -> Query:
    return lambda spark, sf_dir: end(spark, sf_dir, build)


def _active(src: BillingSources) -> DataFrame:
    return accounts.active_accounts(src, TEST_RUN)


def _posted(src: BillingSources) -> DataFrame:
    return billing.posted_lines(src, _active(src), TEST_RUN)


def _registry(src: BillingSources) -> DataFrame:
    return billing.registry(src, billing.bill_lines(src, _posted(src)))


def _never_billed(src: BillingSources, stage: Staging) -> DataFrame:
    lines = staged_lines(src, TEST_RUN, stage)
    return accounts.never_billed_accounts(lines.accounts, billing.bill_lines(src, lines.posted))


def _core(src: BillingSources, stage: Staging) -> DataFrame:
    return ranked_core(src, staged_lines(src, TEST_RUN, stage), stage)


def _reached(src: BillingSources, stage: Staging, months: MonthRange) -> DataFrame:
    """Daily measures that touch ``months``; read once, so not staged."""
    lines = staged_lines(src, TEST_RUN, stage)
    return billing.invoice_core_from_posted(src, lines.posted, lines.buckets, billing.Reach(months))


def _actuals(src: BillingSources, stage: Staging) -> DataFrame:
    core = _reached(src, stage, TEST_RUN.accrual_range)
    return accruals.actuals(core, month_horizon(src.dim_date, TEST_RUN), TEST_RUN)


def _monthly(src: BillingSources, stage: Staging) -> DataFrame:
    core = _reached(src, stage, accruals.both_horizons(TEST_RUN))
    return stage(accruals.monthly_core(core, TEST_RUN), "monthly_core", parts="mth_sdt")


def _monthly_profile(src: BillingSources, stage: Staging) -> DataFrame:
    return accruals.monthly_profile(_monthly(src, stage), trailing_horizon(src.dim_date, TEST_RUN))


def _monthly_actuals(src: BillingSources, stage: Staging) -> DataFrame:
    return accruals.monthly_actuals(_monthly(src, stage), month_horizon(src.dim_date, TEST_RUN))


def _never_billed_months(src: BillingSources, stage: Staging) -> DataFrame:
    return accounts.never_billed_months(_never_billed(src, stage), month_horizon(src.dim_date, TEST_RUN), TEST_RUN)


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of a stored run, with the rows of each model it wrote."""
    log = RunLog(spark, fresh_path(spark, "audit"), TEST_RUN.run_id)
    paths = [fresh_path(spark, name) for name in ("detail", "summary")]
    src = sources(spark, sf_dir)
    stored_run(src, TEST_RUN, staging(spark), log, *paths)
    rows = log.counts().filter("measure = 'n_rows'").select("model", F.col("value").alias("n_rows"))
    stamped = log.rows().filter(F.col("time").isNotNull())
    return stamped.join(rows, "model").select("log_identifier", "model", "state", "n_rows")


def _observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the writes of a stored run counted: rows, and rows without a required value."""
    log = RunLog(spark, fresh_path(spark, "audit"), TEST_RUN.run_id)
    paths = [fresh_path(spark, name) for name in ("detail", "summary")]
    src = sources(spark, sf_dir)
    stored_run(src, TEST_RUN, staging(spark), log, *paths)
    return log.counts().filter("model IN ('detail', 'summary')").select("model", "measure", "value")


def _extract_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract stored as a table, counted, read through its view by another session, and logged without a time."""
    name, path = f"python_test_{uuid.uuid4().hex}", fresh_path(spark, "extract")

    def build(src: BillingSources, stage: Staging) -> DataFrame:
        run = accrual_run(src, TEST_RUN, stage)
        log = RunLog(spark, fresh_path(spark, "audit"), "test")
        extract = results.stored_extract(results.accrual_summary(run.detail, TEST_RUN), log, name, f"{name}_view", path)
        seen = spark.newSession().table(f"{name}_view").count()
        untimed = log.rows().filter("time IS NULL AND state = 'end'").agg(F.count(F.lit(1)).alias("untimed_rows"))
        return untimed.select(F.lit(extract.counted).cast("long").alias("counted_before"), F.lit(seen).cast("long").alias("view_rows"), "untimed_rows")

    return _finished(spark, sf_dir, build)


def _extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows the extract keeps is free; how many, and that all are rows of the summary, is not."""

    def build(src: BillingSources, stage: Staging) -> DataFrame:
        run = accrual_run(src, TEST_RUN, stage)
        summary = stage(results.accrual_summary(run.detail, TEST_RUN), "summary")
        extract = stage(results.summary_extract(summary), "extract")
        strange = extract.exceptAll(summary).agg(F.count(F.lit(1)).alias("not_in_summary"))
        return row_count(extract).withColumnRenamed("row_count", "kept_rows").crossJoin(strange)  # two frames of one row

    return _finished(spark, sf_dir, build)


QUERIES: dict[str, Query] = {
    "mart_active_accounts": _model(_active),
    "mart_accrual_horizon": _model(lambda src: month_horizon(src.dim_date, TEST_RUN)),
    "mart_seasonality_horizon": _model(lambda src: trailing_horizon(src.dim_date, TEST_RUN)),
    "mart_registry": _model(_registry),
    "mart_invoice_volume": _model(lambda src: billing.invoice_volume(_registry(src))),
    "mart_invoice_revenue": _model(lambda src: billing.invoice_revenue(_registry(src))),
    "mart_discounts": _model(lambda src: billing.adjustment_discounts(src, _posted(src))),
    "mart_invoice_core": _staged(_core, _left),
    "mart_seasonal_profile": _result(lambda run: run.profile),
    "mart_never_billed_accounts": _staged(_never_billed),
    "mart_never_billed_months": _staged(_never_billed_months),
    "mart_actuals": _staged(_actuals, _left),
    "monthly_profile": _staged(_monthly_profile),
    "monthly_actuals": _staged(_monthly_actuals, _left),
    "mart_accrual_existing": _result(lambda run: run.existing, _left),
    "mart_accrual_never_billed": _result(lambda run: run.imputed, _left),
    "mart_detail": _result(lambda run: run.detail, _left),
    "mart_summary": _result(lambda run: results.accrual_summary(run.detail, TEST_RUN)),
    "python_model_limit": _extract,
    "python_model_view": _extract_view,
    "audit_log": _audit,
    "observed_counts": _observed,
}

_DAYS = ("bill_sdt", "bill_edt", "mth_sdt", "mth_edt", "service_sdt", "service_edt")
_DAILY = ("daily_amt", "daily_unit_quantity", "daily_unit_quantity_zr", "daily_disc_amt", "daily_ppd_amt", "daily_elig_ppd_amt")


def _show(table: str, days: tuple[str, ...] = (), scaled: dict[str, int] | None = None, money: tuple[str, ...] = ()) -> str:
    parts = [f"CAST({c} AS VARCHAR) AS {c}" for c in days]
    parts += [f"{number(c, digits)} AS {c}" for c, digits in (scaled or {}).items()]
    parts += [f"CAST({c} AS DOUBLE) AS {c}" for c in money]
    chosen = f"* REPLACE ({', '.join(parts)})" if parts else "*"
    return with_ctes(f"SELECT {chosen} FROM {table}")


_LINE_DAYS = ("service_sdt", "service_edt", "bill_sdt", "bill_edt", "in_mth_days")
_MONTHLY = {c: 15 for c in _DAILY} | {"measure": 20}

SQL: dict[str, str] = {
    "mart_active_accounts": _show("active", ("creation_date", "service_sdt", "service_edt")),
    "mart_accrual_horizon": _show("horizon", ("mth_sdt", "mth_edt")),
    "mart_seasonality_horizon": _show("season", ("mth_sdt", "mth_edt")),
    "mart_registry": _show(
        "registry",
        ("service_sdt", "service_edt", "start_date", "end_date", "due_date", "posted_date"),
        money=("net_amount", "quantity", "multiplier", "rate", "loss_factor", "discount_net", "discount_amount", "allocated_amount"),
    ),
    "mart_invoice_volume": _show(
        "volume", _LINE_DAYS, {"daily_unit_quantity": 15, "daily_unit_quantity_zr": 15}, ("net_amount",)
    ),
    "mart_invoice_revenue": _show("revenue", _LINE_DAYS, {"daily_amt": 15}, ("net_amount",)),
    "mart_discounts": with_ctes(
        "SELECT * EXCLUDE (discount7) REPLACE ("
        + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in (*_LINE_DAYS, "invoice_date"))
        + "".join(f", {number(c, 15)} AS {c}" for c in _DAILY[3:])
        + f"), {number('CAST(discount7 AS HUGEINT)', 7)} AS discount_amount FROM discount"
    ),
    "mart_invoice_core": _show("core", _DAYS[:2] + _DAYS[4:], {c: 15 for c in _DAILY}),
    "mart_seasonal_profile": _show("profile", (), {f"avg_{c}": 5 for c in _DAILY}),
    "mart_never_billed_accounts": _show("unbilled", ("service_sdt", "service_edt")),
    "mart_never_billed_months": _show("unbilled_month", ("mth_sdt", "mth_edt", "service_sdt", "service_edt")),
    "mart_actuals": _show("actual", _DAYS, _MONTHLY),
    "mart_accrual_existing": _show("existing", _DAYS, _MONTHLY),
    "mart_accrual_never_billed": _show("imputed", _DAYS[2:], _MONTHLY),
    "mart_detail": _show("detail", ("month_start_date",), {"measure_value": 20}),
    "mart_summary": _show("summary", ("month_start_date",), {"measure_value": 20}),
    "audit_log": with_ctes(
        f"""SELECT '{TEST_RUN.run_id}' AS log_identifier, model, state, n_rows
        FROM (SELECT 'detail' AS model, count(*) AS n_rows FROM detail UNION ALL SELECT 'summary', count(*) FROM summary
              UNION ALL SELECT 'active_accounts', count(*) FROM active UNION ALL SELECT 'posted_lines', count(*) FROM posted
              UNION ALL SELECT 'invoice_core', count(*) FROM core UNION ALL SELECT 'seasonal_profile', count(*) FROM profile
              UNION ALL SELECT 'never_billed_months', count(*) FROM unbilled_month),
             (VALUES ('start'), ('end')) AS states(state)"""
    ),
    "observed_counts": with_ctes(
        """SELECT 'detail' AS model, unnest(['n_rows', 'missing_service_id', 'missing_month_start_date', 'missing_record_type', 'missing_measure_value']) AS measure,
                  unnest([count(*), count(*) - count(service_id), count(*) - count(month_start_date), count(*) - count(record_type), count(*) - count(measure_value)]) AS value
        FROM detail
        UNION ALL
        SELECT 'summary', unnest(['n_rows', 'missing_month_start_date', 'missing_record_type', 'missing_measure_value']),
               unnest([count(*), count(*) - count(month_start_date), count(*) - count(record_type), count(*) - count(measure_value)])
        FROM summary"""
    ),
    "python_model_view": with_ctes("SELECT least(500, count(*)) AS counted_before, least(500, count(*)) AS view_rows, 1 AS untimed_rows FROM summary"),
    "python_model_limit": with_ctes("SELECT least(500, count(*)) AS kept_rows, 0 AS not_in_summary FROM summary"),
}
# The same rows from measures stored by month.
SQL |= {"monthly_profile": SQL["mart_seasonal_profile"], "monthly_actuals": SQL["mart_actuals"]}
