"""Accounts in service, and accounts that were never billed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.functions.calendar import service_end, service_start
from tallygrid.functions.keys import segment_hash
from tallygrid.operators.overlaps import overlap_explode
from tallygrid.operators.scd import scd2_current
from tallygrid.params import RunParams
from tallygrid.sources.tables import BillingSources


def _named(table: DataFrame, key: str, name: str, column: str = "name") -> DataFrame:
    return scd2_current(table, F.col("id").alias(key), F.col(column).alias(name))


def active_accounts(src: BillingSources, params: RunParams) -> DataFrame:
    """Accounts whose service touches the run, with region, segment and status names."""
    period_end, month_start = F.lit(params.period_end), F.lit(params.month_start)
    accounts = (
        scd2_current(src.account)
        .filter(F.col("commence_date").isNotNull() & (F.col("commence_date") <= period_end))
        .filter(service_end(F.col("closed_date")) >= month_start)
        .filter(F.to_date("creation_date") <= period_end)
        .select(
            F.col("id").alias("account_id"),
            "service_type_id",
            "journal_segment_id",
            "curr_status_sid",
            "creation_date",
            service_start(F.col("commence_date")).alias("service_sdt"),
            service_end(F.col("closed_date")).alias("service_edt"),
        )
    )
    status = scd2_current(src.eventtype, F.col("id").alias("curr_status_sid"), "status_group_id").join(
        _named(src.statusgroup, "status_group_id", "status_name"), "status_group_id"
    )
    sites = (
        scd2_current(src.accountutility, "account_id", "utility_id")
        .join(
            scd2_current(src.utility, F.col("id").alias("utility_id"), "utility_network_id", "jurisdiction_id"),
            "utility_id",
        )
        .join(_named(src.utilitynetwork, "utility_network_id", "market_sub_region", "description"), "utility_network_id")
        .join(_named(src.jurisdiction, "jurisdiction_id", "market_region"), "jurisdiction_id")
    )
    return (
        accounts.join(_named(src.servicetype, "service_type_id", "fuel_type"), "service_type_id")
        .join(_named(src.journalaccountsegment, "journal_segment_id", "customer_type"), "journal_segment_id")
        .join(status, "curr_status_sid")
        .join(sites, "account_id")
        .select(
            "account_id",
            "fuel_type",
            "market_region",
            "market_sub_region",
            "customer_type",
            "creation_date",
            "service_sdt",
            "service_edt",
            F.upper("status_name").alias("account_status"),
        )
        .distinct()
    )


def never_billed_accounts(accounts: DataFrame, billed: DataFrame) -> DataFrame:
    """Active accounts without a registry line.

    ``billed`` is any frame with ``seq_product_item_id``. Its ids are made
    distinct before the join, so a heavily billed account counts once.
    """
    ids = billed.select(F.col("seq_product_item_id").alias("account_id")).distinct()
    return (
        accounts.join(ids, "account_id", "left_anti")
        .filter(F.col("service_sdt") <= F.col("service_edt"))
        .select(
            F.col("account_id").alias("seq_product_item_id"),
            "service_sdt",
            "service_edt",
            "fuel_type",
            "market_region",
            "market_sub_region",
            F.col("customer_type").alias("customer_segment"),
            F.month("service_sdt").alias("mth_no"),
        )
        .distinct()
    )


def never_billed_months(never_billed: DataFrame, horizon: DataFrame, params: RunParams) -> DataFrame:
    """Months in service per never-billed account, keyed by segment."""
    monthly = overlap_explode(
        never_billed.drop("mth_no"), horizon, params.accrual_range, F.col("service_sdt"), F.col("service_edt")
    )
    return monthly.select(
        "mth_no",
        "mth_sdt",
        "mth_edt",
        "seq_product_item_id",
        "fuel_type",
        "market_region",
        "market_sub_region",
        "service_sdt",
        "service_edt",
        "customer_segment",
        segment_hash(F.col("mth_no")).alias("record_hash"),
    )
