"""From invoice lines to per-day measures."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tallygrid.functions import charges, discounts
from tallygrid.functions.calendar import inclusive_days, representative_month
from tallygrid.functions.keys import segment_hash
from tallygrid.functions.numeric import null_rate
from tallygrid.functions.text import charge_description, clean_description
from tallygrid.operators.overlaps import touches
from tallygrid.operators.ranking import latest_in_buckets, ranks_in_buckets, with_dense_ranks
from tallygrid.operators.scd import scd2_current
from tallygrid.params import MonthRange, RunParams
from tallygrid.sources.tables import BillingSources, columns_of

ACCOUNT = ("fuel_type", "market_region", "market_sub_region", "customer_segment")
SERVICE = ("service_sdt", "service_edt")
DAILY = (
    "daily_amt",
    "daily_unit_quantity",
    "daily_unit_quantity_zr",
    "daily_disc_amt",
    "daily_ppd_amt",
    "daily_elig_ppd_amt",
)
MEASURE = ("measure_name", "measure_code", "measure_unit")
BILL = (*ACCOUNT, "seq_product_item_id", *SERVICE, "bill_sdt", "bill_edt", "trans_description")


def _time_class(src: BillingSources) -> DataFrame:
    return scd2_current(
        src.timeclass, F.col("id").alias("time_class_id"), F.col("name").alias("time_class_name"),
        "display_grouping_override",
    )


def posted_lines(src: BillingSources, accounts: DataFrame, params: RunParams, buckets: int | None = None) -> DataFrame:
    """Billable lines of open invoices posted in time, for active accounts.

    Charges and discounts both start here, so a run writes this frame once. The
    invoice lookup is optional in the model, but the posting date test rejects
    lines without an invoice; it is an inner join. With ``buckets`` the lines
    are dealt by account into so many partitions before the accounts join, and
    stay so: with accounts in as many buckets that is the only exchange by account.

    Lines of other accounts or invoices are dropped by runtime Bloom filters at
    their scan, before the first exchange, once that scan is large
    (``spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold``).
    """
    invoices = (
        scd2_current(src.invoice)
        .filter(charges.not_reversed(F.col("rev_invoice_id")))
        .filter(F.to_date("posted_date") <= F.lit(params.period_end))
        .select(
            F.col("id").alias("invoice_id"),
            F.col("account_id").alias("invoice_account_id"),
            "posted_date",
            "usage_start_date",
            "usage_end_date",
            "due_date",
            F.col("type").alias("invoice_type"),
            "rev_invoice_id",
            "ppd_adjustment_id",
            "discount_amount",
            "allocated_amount",
        )
    )
    # Holds for every active account; as a filter over their scan it lets Spark build a Bloom filter of the ids.
    serviced = accounts.filter(F.col("service_edt") >= F.lit(params.month_start))
    owners = serviced.select(
        F.col("account_id").alias("seq_product_item_id"),
        "fuel_type",
        "market_region",
        "market_sub_region",
        F.col("customer_type").alias("customer_segment"),
        *SERVICE,
    )
    lines = (
        scd2_current(src.invoicelineitem, *columns_of("invoicelineitem"))
        .filter(F.col("billable") == 1)
        .drop("billable")
        .withColumnRenamed("account_id", "seq_product_item_id")
        .join(invoices, "invoice_id")
    )
    if buckets:
        lines = lines.repartition(buckets, "seq_product_item_id")
    return lines.join(owners, "seq_product_item_id")


def bill_lines(src: BillingSources, posted: DataFrame) -> DataFrame:
    """Registry lines without the meter columns."""
    categories = scd2_current(
        src.lineitemcategory, F.col("id").alias("line_item_category_id"), "name", F.col("description").alias("category_text")
    )
    plans = scd2_current(
        src.planitemtype, F.col("id").alias("plan_item_type_id"), F.col("id").alias("plan_id"),
        F.col("name").alias("plan_item_name"),
    )
    category = F.col("line_item_category_id")
    return (
        posted.join(categories, "line_item_category_id")
        .join(plans, "plan_item_type_id", "left")
        .join(_time_class(src), "time_class_id", "left")
        .filter((category == 1) | ((category == 2) & (F.col("plan_id") == charges.ADJUSTED_PLAN)))
        .withColumn("trans_description", F.initcap("description"))
        .withColumn(
            "cntrl_load",
            charges.controlled_load_flag(F.col("time_class_name"), F.col("display_grouping_override")),
        )
        .withColumn("market_segment", F.lit("MM"))
    )


def registry(src: BillingSources, lines: DataFrame) -> DataFrame:
    """One row per line and meter of its account."""
    meters = scd2_current(src.accountutility, "account_id", "utility_id", "vacant_site").join(
        scd2_current(src.utility, F.col("id").alias("utility_id"), F.col("identifier_all").alias("meter_id")),
        "utility_id",
    )
    on_account = F.col("seq_product_item_id") == F.col("account_id")
    return lines.join(meters, on_account).select(
        "seq_product_item_id",
        "market_region",
        "market_sub_region",
        "market_segment",
        "customer_segment",
        "fuel_type",
        "meter_id",
        *SERVICE,
        "id",
        "invoice_id",
        "plan_item_type_id",
        "adjustment_id",
        "start_date",
        "end_date",
        "net_amount",
        "quantity",
        "multiplier",
        "rate",
        "loss_factor",
        "discount_net",
        "discount_amount",
        "allocated_amount",
        "due_date",
        "vacant_site",
        "plan_item_name",
        "time_class_name",
        "display_grouping_override",
        "name",
        F.col("category_text").alias("description"),
        "rev_invoice_id",
        "posted_date",
        "trans_description",
        "cntrl_load",
    ).distinct()


def _line_header(*middle: str | Column) -> list[str | Column]:
    """Line columns volume and revenue share; ``in_mth_days`` holds the due date."""
    return [
        *ACCOUNT,
        "cntrl_load",
        *SERVICE,
        "seq_product_item_id",
        "net_amount",
        "trans_description",
        "adjustment_id",
        "meter_id",
        F.col("due_date").alias("in_mth_days"),
        F.col("start_date").alias("bill_sdt"),
        F.col("end_date").alias("bill_edt"),
        F.col("name").alias("trans_type_code"),
        F.col("description").alias("trans_type_desc"),
        F.col("id").alias("invoice_header_id"),
        *middle,
        inclusive_days(F.col("start_date"), F.col("end_date")).alias("billing_days"),
    ]


def invoice_volume(registry_rows: DataFrame) -> DataFrame:
    """Daily quantities per registry line."""
    line = charges.registry_line()
    kept = registry_rows.filter(charges.counts_as_charge(line) & charges.counts_as_volume(line))
    header = _line_header(*charges.volume_measures(line), "solar_zr", "rmp_mth_no")
    return charges.with_charge_parts(kept).select(*header).distinct()


def invoice_revenue(registry_rows: DataFrame) -> DataFrame:
    """Daily amounts per registry line."""
    line = charges.registry_line()
    kept = registry_rows.filter(charges.counts_as_charge(line))
    header = _line_header(*charges.revenue_measures(line), "solar_zr", "rmp_mth_no")
    return charges.with_charge_parts(kept).select(*header).distinct()


def _discount_row(kind: tuple[str, str, str], amount: Column, net: Column) -> Column:
    zero_solar = (F.col("fuel_type") == "ELECTRICITY") & (F.col("display_grouping_override") == "SOLAR") & (net == 0)
    return F.struct(
        F.lit(kind[0]).alias("measure_name"),
        discounts.discount_code(kind, F.col("fuel_type")).alias("measure_code"),
        amount.cast("decimal(34,7)").alias("discount_amount"),
        F.when(zero_solar, "Y").otherwise("N").alias("solar_zr"),
    )


def discount_groups(src: BillingSources, posted: DataFrame, buckets: int | None = None) -> DataFrame:
    """Discount totals per invoice, text and time class, one row per kind of discount.

    All three kinds group by the same keys, so one aggregation computes their
    sums side by side and each group then yields a row per kind it has lines of.
    A line counts once for each fitting lookup row of its kind: the lookups are
    reduced to one row per id with that number, so none can touch another kind.
    Lines are dealt once, by invoice or by the invoice's account into
    ``buckets``: grouping, a later distinct and buckets need no other exchange.
    A line is narrower than its sums, and few lines share a group.
    """
    types = (
        scd2_current(src.adjustmenttype, F.col("id").alias("adjustment_type_id"), "name", "adjustment_group_id")
        .filter(F.col("name").isin(*discounts.GUARANTEED_TYPES))
        .join(scd2_current(src.adjustmentgroup, F.col("id").alias("adjustment_group_id")), "adjustment_group_id")
        .groupBy("adjustment_type_id")
        .agg(F.count(F.lit(1)).alias("guaranteed_times"))
    )
    on_time = (
        scd2_current(src.adjustment, F.col("id").alias("ppd_adjustment_id"), "invoice_desc")
        .filter(F.col("invoice_desc").like(discounts.PAY_ON_TIME_PATTERN))
        .groupBy("ppd_adjustment_id")
        .agg(F.count(F.lit(1)).alias("paid_times"))
    )
    lines = (
        posted.filter(F.col("invoice_type") != "REVERSAL")
        .join(types, "adjustment_type_id", "left")
        .join(on_time, "ppd_adjustment_id", "left")
        .join(_time_class(src), "time_class_id", "left")
        .select(
            "*",
            F.col("guaranteed_times").isNotNull().alias("guaranteed"),
            F.coalesce(F.col("plan_item_type_id") == charges.RETAIL_USAGE_PLAN, F.lit(False)).alias("eligible"),
        )
        .filter("guaranteed OR eligible")
        .withColumn("paid", F.col("eligible") & F.col("paid_times").isNotNull())
    )

    def total(flag: str, value: Column, times: str | None = None) -> Column:
        """Sum over the lines of a kind; the product keeps the scale of ``value``."""
        if times:
            kept = lines.select(value).schema[0].dataType
            value = (value.cast(DecimalType(28, kept.scale)) * F.col(times).cast(DecimalType(9, 0))).cast(kept)
        return F.sum(F.when(F.col(flag), value))

    net, discount = F.col("net_amount"), F.col("discount_net")
    dealt = lines.repartition(buckets, "invoice_account_id") if buckets else lines.repartition("invoice_id")
    grouped = dealt.groupBy(
        "invoice_id",
        "invoice_account_id",
        "posted_date",
        *SERVICE,
        *ACCOUNT,
        "description",
        "due_date",
        "time_class_name",
        "display_grouping_override",
    ).agg(
        F.min("usage_start_date").alias("bill_sdt"),
        F.max("usage_end_date").alias("bill_edt"),
        F.max("guaranteed").alias("has_guaranteed"),
        F.max("eligible").alias("has_eligible"),
        F.max("paid").alias("has_paid"),
        total("guaranteed", discounts.strip_tax(net, F.col("tax_amount")), "guaranteed_times").alias("guaranteed_total"),
        total("guaranteed", net, "guaranteed_times").alias("guaranteed_net"),
        total("eligible", discount).alias("eligible_total"),
        total("eligible", net).alias("eligible_net"),
        total("paid", discount, "paid_times").alias("paid_total"),
        total("paid", net, "paid_times").alias("paid_net"),
    )
    kinds = F.array(
        F.when(
            F.col("has_guaranteed"),
            _discount_row(discounts.GUARANTEED, F.col("guaranteed_total"), F.col("guaranteed_net")),
        ),
        F.when(
            F.col("has_eligible"),
            _discount_row(discounts.ELIGIBLE, discounts.rounded_discount(F.col("eligible_total")), F.col("eligible_net")),
        ),
        F.when(
            F.col("has_paid"),
            _discount_row(discounts.PAID, discounts.rounded_discount(F.col("paid_total")), F.col("paid_net")),
        ),
    )
    return grouped.select(
        *ACCOUNT,
        "invoice_id",
        F.col("invoice_account_id").alias("seq_product_item_id"),
        *SERVICE,
        F.to_date("posted_date").alias("invoice_date"),
        "bill_sdt",
        "bill_edt",
        charges.controlled_load_flag(F.col("time_class_name"), F.col("display_grouping_override")).alias("cntrl_load"),
        F.col("due_date").alias("in_mth_days"),
        F.initcap("description").alias("trans_description"),
        F.inline(kinds),
    ).filter("measure_name IS NOT NULL")


def _daily_discounts(groups: DataFrame) -> DataFrame:
    code, amount, start, end = (F.col(c) for c in ("measure_code", "discount_amount", "bill_sdt", "bill_edt"))
    return groups.select(
        "*",
        F.lit("$").alias("measure_unit"),
        discounts.daily_discount(code, "DIS%", 1, amount, start, end).alias("daily_disc_amt"),
        discounts.daily_discount(code, "EPPD%", -1, amount, start, end).alias("daily_elig_ppd_amt"),
        discounts.daily_discount(code, "PPD%", -1, amount, start, end).alias("daily_ppd_amt"),
        inclusive_days(start, end).alias("discount_days"),
        representative_month(start, end).alias("rmp_mth_no"),
    )


def adjustment_discounts(src: BillingSources, posted: DataFrame) -> DataFrame:
    """Daily discounts; ``in_mth_days`` holds the due date."""
    return _daily_discounts(discount_groups(src, posted)).select(
        *ACCOUNT,
        "invoice_id",
        "seq_product_item_id",
        *SERVICE,
        "invoice_date",
        "bill_sdt",
        "bill_edt",
        "cntrl_load",
        *MEASURE,
        "discount_amount",
        "solar_zr",
        "in_mth_days",
        "trans_description",
        "daily_disc_amt",
        "daily_elig_ppd_amt",
        "daily_ppd_amt",
        "discount_days",
        "rmp_mth_no",
    ).distinct()


def _sparse(rows: DataFrame) -> DataFrame:
    """Bill columns with every daily measure the rows lack set to NULL."""
    present = set(rows.columns)
    return rows.select(
        *BILL,
        "cntrl_load",
        "solar_zr",
        *MEASURE,
        *[F.col(c) if c in present else null_rate().alias(c) for c in DAILY],
        "rmp_mth_no",
    )


def _unique(rows: DataFrame) -> DataFrame:
    """Measured rows once.

    The measures of volume, revenue and discount rows never share a name, so
    one distinct over their union equals a distinct per branch. Rows that are
    dealt by account meet without a further exchange.
    """
    return rows.filter(F.col("measure_name").isNotNull()).distinct()


def _finish_core(unique: DataFrame) -> DataFrame:
    """Clean texts, key by segment."""
    cleaned = unique.withColumn("ex_charge_desc_orion", clean_description(F.col("trans_description")))
    return cleaned.select(
        *BILL,
        "ex_charge_desc_orion",
        "cntrl_load",
        "solar_zr",
        *MEASURE,
        *DAILY,
        "rmp_mth_no",
        F.lit("MM").alias("market_segment"),
        segment_hash(F.col("rmp_mth_no")).alias("record_hash"),
        charge_description(F.col("trans_description"), F.col("ex_charge_desc_orion")).alias("ex_charge_desc"),
    )


def ranked_bills(core: DataFrame, bounded: bool = False) -> DataFrame:
    """Rank the bills of an account by both dates.

    Where the lines of an account are ``bounded``, ``core`` is read once.
    Otherwise it is read twice, so it should be written first.
    """
    rank = ranks_in_buckets if bounded else with_dense_ranks
    return rank(core, "seq_product_item_id", {"bill_sdt": "bill_sdt_rnk", "bill_edt": "bill_edt_rnk"})


def invoice_core(volume: DataFrame, revenue: DataFrame, discount: DataFrame) -> DataFrame:
    """Union of the three kinds of daily measures."""
    return _finish_core(_unique(_sparse(volume).unionByName(_sparse(revenue)).unionByName(_sparse(discount))))


@dataclass(frozen=True)
class Reach:
    """The rows that readers of the daily measures need: those that touch ``months``, and with ``latest`` an account's latest.

    Latest are rows with the last start or end of their kind in an account, charges
    and discounts apart; the account's latest of both kinds are among them. They
    are found in one pass, so the frame must be dealt by account.
    """

    months: MonthRange
    latest: bool = False

    def of(self, rows: DataFrame, start: str, end: str) -> DataFrame:
        touching = touches(self.months, F.col(start), F.col(end))
        return latest_in_buckets(rows, "seq_product_item_id", start, end, also=touching) if self.latest else rows.filter(touching)


def charge_rows(lines: DataFrame, reach: Reach | None = None) -> DataFrame:
    """Volume and revenue rows in one pass over the lines, of all or of those in ``reach``."""
    line = charges.registry_line()
    volume = F.struct(*charges.volume_measures(line), null_rate().alias("daily_amt"))
    revenue = F.struct(
        *charges.revenue_measures(line)[:3],
        null_rate().alias("daily_unit_quantity"),
        null_rate().alias("daily_unit_quantity_zr"),
        charges.revenue_measures(line)[3],
    )
    counted = charges.with_charge_parts(lines.filter(charges.counts_as_charge(line)))
    if reach:
        named = charges.revenue_measures(line)[0].isNotNull() | (charges.counts_as_volume(line) & charges.volume_measures(line)[0].isNotNull())
        counted = reach.of(counted.filter(named), "start_date", "end_date")
    measured = counted.select(
        *ACCOUNT,
        "seq_product_item_id",
        *SERVICE,
        line.start.alias("bill_sdt"),
        line.end.alias("bill_edt"),
        "trans_description",
        "cntrl_load",
        "solar_zr",
        "rmp_mth_no",
        F.when(charges.counts_as_volume(line), volume).alias("volume"),
        revenue.alias("revenue"),
    )
    return measured.select("*", F.inline(F.array("volume", "revenue"))).drop("volume", "revenue")


def invoice_core_from_posted(
    src: BillingSources, posted: DataFrame, buckets: int | None = None, reach: Reach | None = None
) -> DataFrame:
    """Same rows as :func:`invoice_core` without the intermediate models.

    The meter columns of the registry and the distincts between the models
    cannot reach this result, so the lines go through one wide shuffle, not
    four; none if ``posted`` lies in ``buckets`` by account. Discounts belong to
    the account of the invoice, so they are dealt anew before they are summed up.

    With ``reach`` only rows in it come out. Lines are dropped before they are
    measured; discounts when their lines are summed up, since only then their
    dates are known. Equal rows have equal dates, so no distinct changes.
    """
    groups = discount_groups(src, posted, buckets)
    charged = _unique(_sparse(charge_rows(bill_lines(src, posted), reach)))
    discounted = _unique(_sparse(_daily_discounts(reach.of(groups, "bill_sdt", "bill_edt") if reach else groups)))
    return _finish_core(charged.unionByName(discounted))
