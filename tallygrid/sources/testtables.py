"""Billing sources derived from the order and customer test tables.

The rules are listed in FIXTURES.md. Each source is a row-wise projection of a
whole table, so its size follows the table it comes from.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.operators.horizons import day_calendar
from tallygrid.params import RunParams
from tallygrid.sources.literals import CHARGE_TEMPLATES, LOOKUPS, values_sql
from tallygrid.sources.tables import BillingSources

TEST_RUN = RunParams(
    month_start=dt.date(2000, 7, 1),
    period_end=dt.date(2001, 6, 30),
    as_of=dt.date(2001, 12, 15),
    run_id="test-run",
)

MONEY = "decimal(18,4)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(key: str, step: int, rest: int = 0) -> Column:
    return F.col(key) % step == rest


def _accounts(customer: DataFrame) -> DataFrame:
    start = F.date_add(F.lit(dt.date(1995, 1, 1)), ((F.col("c_custkey") * 37) % 2300).cast("int"))
    segments = F.array(*[F.lit(s) for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")])
    versions = F.when(_every("c_custkey", 20, 19), F.array(F.lit(1), F.lit(0))).otherwise(F.array(F.lit(1)))
    flagged = customer.select("*", F.explode(versions).alias("adh_active_flag"), start.alias("start"))
    begun = F.when(F.col("adh_active_flag") == 1, F.col("start")).otherwise(F.date_sub("start", 365))
    return flagged.select(
        F.col("c_custkey").alias("id"),
        (1 + F.col("c_custkey") % 2).cast("int").alias("service_type_id"),
        F.array_position(segments, F.col("c_mktsegment")).cast("int").alias("journal_segment_id"),
        F.when(_every("c_custkey", 10), F.date_add("start", 900)).alias("closed_date"),
        F.when(~_every("c_custkey", 97), begun).alias("commence_date"),
        begun.cast("timestamp").alias("creation_date"),
        (1 + F.col("c_custkey") % 3).cast("int").alias("curr_status_sid"),
        "adh_active_flag",
    )


def _meters(customer: DataFrame) -> DataFrame:
    """One meter per account, two for every fiftieth."""
    ids = F.when(
        _every("c_custkey", 50), F.array(F.col("c_custkey"), F.col("c_custkey") + 1_000_000_000_000)
    ).otherwise(F.array(F.col("c_custkey")))
    return customer.select("c_custkey", "c_nationkey", F.explode(ids).alias("meter"))


def _account_utility(customer: DataFrame) -> DataFrame:
    return _meters(customer).select(
        F.col("meter").alias("id"),
        F.col("c_custkey").alias("account_id"),
        F.col("meter").alias("utility_id"),
        F.when(_every("c_custkey", 11), "Y").otherwise("N").alias("vacant_site"),
        F.concat(F.lit("Gate "), F.col("c_nationkey").cast("string")).alias("access_detail"),
        F.lit(1).alias("adh_active_flag"),
    )


def _utility(customer: DataFrame, nation: DataFrame) -> DataFrame:
    return _meters(customer).join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("meter").alias("id"),
        F.col("c_nationkey").alias("utility_network_id"),
        F.col("n_regionkey").alias("jurisdiction_id"),
        F.concat(F.lit("M"), F.col("meter").cast("string")).alias("identifier_all"),
        F.when(_every("c_custkey", 4), "BUS").otherwise("RES").alias("cust_class_code"),
        F.lit(1).alias("adh_active_flag"),
    )


def order_day() -> Column:
    return F.to_date("o_orderdate")


def usage_start() -> Column:
    return F.date_sub(order_day(), (F.col("o_orderkey") % 60).cast("int"))


def _invoices(orders: DataFrame) -> DataFrame:
    reversal = (
        F.when(_every("o_orderkey", 40), F.col("o_orderkey") + 1)
        .when(_every("o_orderkey", 3), F.lit(0).cast("bigint"))
        .when(_every("o_orderkey", 3, 1), F.lit(-1).cast("bigint"))
    )
    total = F.col("o_totalprice").cast("decimal(18,2)")
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("account_id"),
        F.date_add(order_day(), 5).cast("timestamp").alias("posted_date"),
        usage_start().alias("usage_start_date"),
        order_day().alias("usage_end_date"),
        F.date_add(order_day(), 19).alias("due_date"),
        F.when(_every("o_orderkey", 50), "REVERSAL").otherwise("NORMAL").alias("type"),
        reversal.alias("rev_invoice_id"),
        (1 + F.col("o_orderkey") % 4).alias("ppd_adjustment_id"),
        F.when(_every("o_orderkey", 4), total).otherwise(F.lit(0)).cast(MONEY).alias("discount_amount"),
        total.cast(MONEY).alias("allocated_amount"),
        F.lit(1).alias("adh_active_flag"),
    )


def price() -> Column:
    return F.col("l_extendedprice").cast("decimal(18,2)")


def discount_rate() -> Column:
    return F.abs(F.col("l_discount")).cast("decimal(4,2)")


def tax_rate() -> Column:
    return F.abs(F.col("l_tax")).cast("decimal(4,2)")


def _line_items(spark: SparkSession, lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    dated = lineitem.join(
        orders.select("o_orderkey", "o_custkey", usage_start().alias("start_date"), order_day().alias("end_date")),
        F.col("l_orderkey") == F.col("o_orderkey"),
    )
    template = spark.sql(values_sql(CHARGE_TEMPLATES))
    textual = dated.join(
        template, (F.col("l_linenumber") == F.col("line_number")) & (F.col("l_partkey") % 3 == F.col("variant"))
    )
    solar = F.col("l_linenumber") == 5
    net = F.round(price() * (F.lit(1).cast("decimal(4,2)") - discount_rate()), 2)
    part = lambda step: _every("l_partkey", step)
    return textual.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("o_custkey").alias("account_id"),
        F.col("l_orderkey").alias("invoice_id"),
        F.when(part(40) | part(41), 2).when(part(43), 3).otherwise(1).alias("line_item_category_id"),
        F.when(~part(53), F.when(part(40), 36).otherwise(F.col("plan_id"))).alias("plan_item_type_id"),
        F.when((F.col("class_id") == 5) & part(2), 6).otherwise(F.col("class_id")).alias("time_class_id"),
        F.when(part(6), F.col("l_partkey") % 4 + 1).alias("adjustment_id"),
        (1 + F.col("l_partkey") % 6).cast("int").alias("adjustment_type_id"),
        F.when(part(25) | _every("o_custkey", 7), 0).otherwise(1).alias("billable"),
        "description",
        "start_date",
        "end_date",
        F.when(~solar, net).when(part(2), F.lit(0)).otherwise(-net).cast(MONEY).alias("net_amount"),
        F.round(price() * tax_rate(), 2).cast(MONEY).alias("tax_amount"),
        F.round(price() * discount_rate(), 2).cast(MONEY).alias("discount_net"),
        F.when(part(30), F.lit(0)).when(~part(31), F.col("l_quantity")).cast(MONEY).alias("quantity"),
        F.when(F.col("l_linenumber") == 7, F.lit("1.5")).otherwise(F.lit("1")).cast(MONEY).alias("multiplier"),
        (discount_rate() * 10).cast("decimal(18,6)").alias("rate"),
        (F.lit(1).cast("decimal(4,2)") + tax_rate()).cast("decimal(18,6)").alias("loss_factor"),
        F.when(part(29), 0).otherwise(1).alias("adh_active_flag"),
    )


def order_calendar(orders: DataFrame) -> DataFrame:
    """Whole years around the order dates plus one year."""
    bounds = orders.agg(F.min(order_day()).alias("lo"), F.max(order_day()).alias("hi")).select(
        F.trunc("lo", "YEAR").alias("first_day"),
        F.date_sub(F.add_months(F.trunc("hi", "YEAR"), 24), 1).alias("last_day"),
    )
    return day_calendar(bounds)


def billing_sources(spark: SparkSession, sf_dir: str) -> BillingSources:
    customer, nation, region, orders, lineitem = (
        table(spark, sf_dir, name) for name in ("customer", "nation", "region", "orders", "lineitem")
    )
    region_name = F.when(F.col("r_regionkey") == 0, "SA").otherwise(F.col("r_name"))
    current = F.lit(1).alias("adh_active_flag")
    return BillingSources(
        account=_accounts(customer),
        accountutility=_account_utility(customer),
        utility=_utility(customer, nation),
        utilitynetwork=nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("description"), current),
        jurisdiction=region.select(F.col("r_regionkey").alias("id"), region_name.alias("name"), current),
        invoice=_invoices(orders),
        invoicelineitem=_line_items(spark, lineitem, orders),
        dim_date=order_calendar(orders),
        **{name: spark.sql(values_sql(lookup)) for name, lookup in LOOKUPS.items()},
    )
