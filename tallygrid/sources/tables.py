"""Declared source tables and ways to open them."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Columns and types the plans read, one table per line group.
_DDL = {
    "account": "id bigint, service_type_id int, journal_segment_id int, closed_date date, commence_date date, "
    "creation_date timestamp, curr_status_sid int",
    "accountutility": "id bigint, account_id bigint, utility_id bigint, vacant_site string, access_detail string",
    "utility": "id bigint, utility_network_id int, jurisdiction_id int, identifier_all string, cust_class_code string",
    "utilitynetwork": "id int, description string",
    "jurisdiction": "id int, name string",
    "servicetype": "id int, name string",
    "journalaccountsegment": "id int, name string",
    "eventtype": "id int, status_group_id int",
    "statusgroup": "id int, name string",
    "invoice": "id bigint, account_id bigint, posted_date timestamp, usage_start_date date, usage_end_date date, "
    "due_date date, type string, rev_invoice_id bigint, ppd_adjustment_id bigint, "
    "discount_amount decimal(18,4), allocated_amount decimal(18,4)",
    "invoicelineitem": "id bigint, account_id bigint, invoice_id bigint, line_item_category_id int, "
    "plan_item_type_id int, time_class_id int, adjustment_id bigint, adjustment_type_id int, billable int, "
    "description string, start_date date, end_date date, net_amount decimal(18,4), tax_amount decimal(18,4), "
    "discount_net decimal(18,4), quantity decimal(18,4), multiplier decimal(18,4), rate decimal(18,6), "
    "loss_factor decimal(18,6)",
    "lineitemcategory": "id int, name string, description string",
    "planitemtype": "id int, name string",
    "timeclass": "id int, name string, display_grouping_override string",
    "adjustmenttype": "id int, adjustment_group_id int, includes_gst int, name string",
    "adjustmentgroup": "id int, name string",
    "adjustment": "id bigint, invoice_desc string",
}
_CALENDAR_DDL = "date date, year int, month int, first_day_month date, last_day_month date"


def schema_of(table: str) -> StructType:
    if table == "dim_date":
        return StructType.fromDDL(_CALENDAR_DDL)
    return StructType.fromDDL(f"{_DDL[table]}, adh_active_flag int")


def columns_of(table: str) -> list[str]:
    """Declared columns without the flag of the current version."""
    return [name for name in schema_of(table).names if name != "adh_active_flag"]


def declared(frame: DataFrame, table: str) -> DataFrame:
    """The declared columns of ``frame`` in their declared types; any others are left out."""
    return frame.select(*(F.col(field.name).cast(field.dataType) for field in schema_of(table)))


@dataclass(frozen=True)
class BillingSources:
    """One frame per source; field names are the table names."""

    account: DataFrame
    accountutility: DataFrame
    utility: DataFrame
    utilitynetwork: DataFrame
    jurisdiction: DataFrame
    servicetype: DataFrame
    journalaccountsegment: DataFrame
    eventtype: DataFrame
    statusgroup: DataFrame
    invoice: DataFrame
    invoicelineitem: DataFrame
    lineitemcategory: DataFrame
    planitemtype: DataFrame
    timeclass: DataFrame
    adjustmenttype: DataFrame
    adjustmentgroup: DataFrame
    adjustment: DataFrame
    dim_date: DataFrame

    @classmethod
    def names(cls) -> list[str]:
        return [field.name for field in fields(cls)]

    @classmethod
    def from_tables(cls, spark: SparkSession, schema: str, calendar_table: str) -> BillingSources:
        """Catalog tables ``schema.<name>`` plus the calendar by its own name, each with its declared columns."""
        places = {name: f"{schema}.{name}" for name in cls.names()} | {"dim_date": calendar_table}
        return cls(**{name: declared(spark.table(place), name) for name, place in places.items()})

    @classmethod
    def from_files(cls, spark: SparkSession, root: str, fmt: str = "parquet") -> BillingSources:
        """One folder per table below ``root``, read with the declared schemas."""
        return cls(**{
            name: spark.read.format(fmt).schema(schema_of(name)).load(f"{root}/{name}") for name in cls.names()
        })
