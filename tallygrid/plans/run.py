"""The whole accrual as one call."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.operators.horizons import month_horizon, trailing_horizon
from tallygrid.operators.scd import scd2_current
from tallygrid.operators.skew import fits_buckets
from tallygrid.params import RunParams
from tallygrid.plans import accounts, accruals, billing, contracts, results
from tallygrid.session import Staging
from tallygrid.sinks.runlog import RunLog
from tallygrid.sinks.observed import Watch, is_missing, refused
from tallygrid.sinks.tables import analyze_columns, registered, replace_run
from tallygrid.sources.tables import BillingSources

Stage = Callable[..., DataFrame]


@dataclass(frozen=True)
class AccrualRun:
    accounts: DataFrame
    posted: DataFrame
    core: DataFrame
    profile: DataFrame
    never_billed: DataFrame
    actual: DataFrame
    existing: DataFrame
    imputed: DataFrame
    detail: DataFrame


@dataclass(frozen=True)
class StagedLines:
    accounts: DataFrame
    posted: DataFrame
    buckets: int | None


def staged_lines(src: BillingSources, params: RunParams, stage: Stage) -> StagedLines:
    """Active accounts and posted lines, in buckets by account where the stage offers them and no account is too hot."""
    buckets = run_buckets(src, stage)
    by_id, by_item = ("account_id", "seq_product_item_id") if buckets else (None, None)
    active = stage(dealt(accounts.active_accounts(src, params), buckets, "account_id"), "active_accounts", by_id)
    posted = stage(billing.posted_lines(src, active, params, buckets), "posted_lines", by_item)
    return StagedLines(active, posted, buckets)


def staged_core(src: BillingSources, lines: StagedLines, stage: Stage, reach: billing.Reach | None = None) -> DataFrame:
    by = "seq_product_item_id" if lines.buckets else None
    return stage(billing.invoice_core_from_posted(src, lines.posted, lines.buckets, reach), "invoice_core", by)


def ranked_core(src: BillingSources, lines: StagedLines, stage: Stage) -> DataFrame:
    """The daily measures with the ranks of their bills. Where accounts are bounded they are read once, so not staged."""
    if lines.buckets:
        return billing.ranked_bills(billing.invoice_core_from_posted(src, lines.posted, lines.buckets), bounded=True)
    return billing.ranked_bills(staged_core(src, lines, stage))


def run_buckets(src: BillingSources, stage: Stage) -> int | None:
    """Buckets the stage offers, or None where it offers none or an account has more lines than a bucket should hold."""
    buckets = getattr(stage, "buckets", None)
    lines = scd2_current(src.invoicelineitem, "account_id", "billable").filter(F.col("billable") == 1)
    return buckets if buckets and fits_buckets(lines, "account_id") else None


def dealt(frame: DataFrame, buckets: int | None, key: str) -> DataFrame:
    return frame.repartition(buckets, key) if buckets else frame


def accrual_run(src: BillingSources, params: RunParams, stage: Stage, whole_core: bool = False) -> AccrualRun:
    """Build every model of a run.

    ``stage`` is called for the frames with several readers: active accounts,
    posted lines, daily measures, the seasonal profile and the months without a bill. A
    :class:`tallygrid.session.Staging` writes them once. Without that the plan
    repeats them for each reader, which only small tests should do.

    All but the profile are staged in buckets by account, so after the lines are
    dealt once by account nothing that is joined, ranked, made distinct or summed
    per account is exchanged again. If an account has too many lines for a
    bucket they are staged plainly, and the same joins exchange and split it.

    From buckets only the daily measures that the models read are staged: those
    that touch the run's horizons and the latest of an account. ``core`` of the
    run then is the plan of all of them. With ``whole_core`` all are staged.
    """
    lines = staged_lines(src, params, stage)
    active, posted = lines.accounts, lines.posted
    if whole_core or not lines.buckets:
        whole = core = staged_core(src, lines, stage)
    else:
        reach = billing.Reach(accruals.both_horizons(params), latest=True)
        core = staged_core(src, lines, stage, reach)
        whole = billing.invoice_core_from_posted(src, posted, lines.buckets)
    horizon = month_horizon(src.dim_date, params)
    profile = stage(
        accruals.seasonal_profile(core, trailing_horizon(src.dim_date, params), params), "seasonal_profile"
    )
    unbilled = accounts.never_billed_accounts(active, billing.bill_lines(src, posted))
    actual = accruals.actuals(core, horizon, params)
    existing = accruals.existing_accruals(core, profile, horizon, params, bool(lines.buckets))
    months = stage(accounts.never_billed_months(unbilled, horizon, params), "never_billed_months")
    imputed = accruals.never_billed_accruals(months, profile)
    detail = results.accrual_detail([actual, existing, imputed], params)
    return AccrualRun(active, posted, whole, profile, unbilled, actual, existing, imputed, detail)


@dataclass(frozen=True)
class StoredRun:
    detail: DataFrame
    summary: DataFrame


class LoggedStage:
    """A stage that logs each frame it writes, with its rows as the write counted them."""

    def __init__(self, stage: Staging, log: RunLog) -> None:
        self.stage, self.log, self.buckets = stage, log, stage.buckets

    def __call__(self, frame: DataFrame, name: str, *args: str | None, **options: str | None) -> DataFrame:
        watch = Watch()
        return self.log.around(name, lambda: self.stage(watch(frame), name, *args, **options), watch)


#: Tests of the results, counted as they are written: the columns that every row must have.
REQUIRED = ("service_id", "month_start_date", "record_type", "measure_value")


def stored_run(
    src: BillingSources, params: RunParams, stage: Staging, log: RunLog, detail_path: str, summary_path: str,
    tables: tuple[str, str] | None = None, strict: bool = False,
) -> StoredRun:
    """A run with its tables: log rows around each model that is written, the results stored per request id, the summary read from the stored detail.

    Both results are brought to their declared types first. The rows of every
    written model, and the results' rows that lack a required value, are counted
    by the write and logged; so all daily measures are written. If ``strict``, such a row makes the write fail, and
    the stored run stays as it was. With ``tables`` the stored results become
    catalog tables of those names, with statistics of their columns. The staged
    frames go when the results are stored.
    """
    column = "unbilled_accrual_run_audit_id"

    def stored(model: str, build: Callable[[], DataFrame], path: str, name: str | None) -> DataFrame:
        schema = contracts.schema_of_model(model)
        required = [c for c in REQUIRED if c in schema.names]
        watch = Watch({f"missing_{c}": is_missing(c) for c in required})

        def write() -> DataFrame:
            result = contracts.conformed(build(), schema)
            for c in required if strict else []:
                result = refused(result, is_missing(c), f"{model}: {c} is missing", c)
            return replace_run(result, path, column, params.request_id, watch=watch)

        frame = log.around(model, write, watch)
        if name:
            registered(frame.sparkSession, name, path, frame.schema, column)
            analyze_columns(frame.sparkSession, name)
        return frame

    names = tables or (None, None)
    with stage:
        detail = stored("detail", lambda: accrual_run(src, params, LoggedStage(stage, log), whole_core=True).detail, detail_path, names[0])
        summary = stored("summary", lambda: results.accrual_summary(detail.drop("run_id"), params), summary_path, names[1])
    return StoredRun(detail, summary)
